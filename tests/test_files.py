import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tests import brute
from trajspark import schemas as S
from trajspark.functions.text import model_from_file
from trajspark.operators import compare as C, expand as P, quality as Q, usage as U
from trajspark.plans import jobs as J
from trajspark.settings import select_models
from trajspark.sinks import writers as W
from trajspark.sources import image_files as I, readers as R


def png(width, height):
    def part(kind, body):
        return (struct.pack(">I", len(body)) + kind + body
                + struct.pack(">I", zlib.crc32(kind + body)))
    return (b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2,
                                                             0, 0, 0)) + part(b"IEND", b""))


def jpeg(width, height):
    app = b"\xff\xe0" + struct.pack(">H", 16) + b"JFIF\0" + b"\0" * 9
    frame = b"\xff\xc2" + struct.pack(">HBHHB", 11, 8, height, width, 1) + b"\0" * 3
    return b"\xff\xd8" + app + b"\xff" + frame + b"\xff\xd9"


def far_jpeg(width, height):
    """The size comes after segments longer than the head that is read first."""
    filler = b"\xff\xe1" + struct.pack(">H", 65_000) + b"\0" * 64_998
    return b"\xff\xd8" + filler * 3 + jpeg(width, height)[2:]


def bmp(width, height):
    return b"BM" + b"\0" * 16 + struct.pack("<ii", width, -height) + b"\0" * 8


def webp(kind, body):
    chunk = kind + struct.pack("<I", len(body)) + body
    return b"RIFF" + struct.pack("<I", len(chunk) + 4) + b"WEBP" + chunk


def test_webp_headers():
    size = (1920, 1080)
    lossless = struct.pack("<I", (size[0] - 1) | (size[1] - 1) << 14)
    for kind, body in ((b"VP8X", b"\0" * 4 + (1919).to_bytes(3, "little")
                        + (1079).to_bytes(3, "little")),
                       (b"VP8L", b"\x2f" + lossless + b"\0" * 5),
                       (b"VP8 ", b"\0\0\0\x9d\x01\x2a" + struct.pack("<HH", *size))):
        assert I.header_size(webp(kind, body)) == size
    assert I.header_size(webp(b"VP8?", b"\0" * 10)) is None


@pytest.fixture(scope="module")
def shots(tmp_path_factory):
    root = tmp_path_factory.mktemp("shots")
    (root / "sub").mkdir()
    for name, content in {
            "a.png": png(1920, 1080), "b.jpg": jpeg(640, 480), "junk.png": b"\x89PNG",
            "sub/c.gif": b"GIF89a" + struct.pack("<HH", 7, 9), "d.bmp": bmp(3, 4),
            "_a.png": png(5, 6), ".a.png": png(6, 5), "far.jpg": far_jpeg(320, 200),
            "empty.png": b"", "zero.png": png(0, 5), "cut.jpg": jpeg(640, 480)[:20],
            "with space.png": png(70000, 3)}.items():
        (root / name).write_bytes(content)
    return str(root)


FOUND = {"a.png": (1920, 1080, "ok"), "b.jpg": (640, 480, "ok"), "sub/c.gif": (7, 9, "ok"),
         "d.bmp": (3, 4, "ok"), "with space.png": (70000, 3, "ok"), "_a.png": (5, 6, "ok"),
         ".a.png": (6, 5, "ok"), "far.jpg": (320, 200, "ok"), "empty.png": (None, None, "corrupt"),
         "junk.png": (None, None, "corrupt"), "zero.png": (None, None, "corrupt"),
         "cut.jpg": (None, None, "corrupt"), "sub": (None, None, "corrupt")}


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_image_headers(spark, shots, scheme):
    """Named files only, and their paths come back as given, however the root is spelled."""
    root = scheme + shots
    names = [*FOUND, "gone.png", "sub/../a.png", "a.png"]
    paths = spark.createDataFrame([(f"{root}/{n}",) for n in names] + [(None,)], "path string")
    rows = I.read_image_dims(paths, partitions=3).collect()
    assert {r.path[len(root) + 1:]: (r.width, r.height, r.status) for r in rows} == {
        **FOUND, "sub/../a.png": (1920, 1080, "ok")}
    assert len(rows) == len(FOUND) + 1


def test_only_heads_are_read(tmp_path):
    from pyarrow import fs
    (tmp_path / "big.png").write_bytes(png(9, 9) + b"x" * 10_000_000)
    assert len(I._head(fs.LocalFileSystem(), str(tmp_path / "big.png"))) == I.HEAD


def test_usage_from_files(spark, shots, tmp_path):
    """Files to prices: trajectories, screenshots, training rows, usage, documents, tables."""
    record = brute.task("t", 4)
    for s, name in zip(record["traj"], ("a.png", "b.jpg", "junk.png", "gone.png")):
        s["image"] = name
    (tmp_path / "traj.jsonl").write_text(json.dumps(record) + "\n{broken\n")
    raw = R.read_trajectories(spark, str(tmp_path / "traj.jsonl"), quarantine=True)
    broken = Q.corrupt_records(raw)
    assert broken.count() == 1 and broken.select(Q.CORRUPT_COLUMN).first()[0] == "{broken"
    rows, bad = J.training_set(raw, image_root=shots)
    assert [(r.reason, r[Q.CORRUPT_COLUMN]) for r in bad.collect()] == [("unreadable", "{broken")]
    with pytest.raises(ValueError, match="unreadable line"):
        J.training_set(raw, image_root=shots, strict=True)
    W.write_training_rows(rows, str(tmp_path / "rows"))
    back = R.read_training_rows(spark, str(tmp_path / "rows"))
    assert sorted(back.drop("conversation_id").collect()) == sorted(rows.collect())
    dims = I.read_image_dims(P.image_rows(back))
    usage = J.row_usage(back, dims, select_models(["gpt-4o", "gpt-4o-mini"]))
    last = usage.filter("prefix_len = 4 and model = 'gpt-4o'").first()
    assert [d.tokens for d in last.image_details] == [1105, 255, 0]
    assert [d.tokens for d in usage.filter("prefix_len = 1 and model = 'gpt-4o-mini'")
            .first().image_details] == [36829]

    W.write_usage(usage, str(tmp_path / "usage"))
    assert spark.read.parquet(str(tmp_path / "usage")).filter("model = 'gpt-4o'").count() == 4
    W.write_usage_csv(usage, str(tmp_path / "csv"), details=True)
    flat = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert flat.count() == 8 and "total_cost" in flat.columns
    details = flat.filter("prefix_len = 1 and model = 'gpt-4o'").first().image_details
    assert json.loads(details)[0]["tokens"] == 1105

    totals = U.usage_totals(usage)
    W.write_result_documents(totals, str(tmp_path / "out"), "rows")
    documents = spark.read.schema(S.RESULT_SET).json(str(tmp_path / "out"))
    assert documents.count() == 2 and documents.first().totals.total_images == 1 + 2 + 3 + 3


def test_broken_training_rows(spark, tmp_path):
    """A broken line fails the read or is kept aside; it is never a priced conversation."""
    line = json.dumps({"messages": [{"role": "user", "content": "a b"}], "images": []})
    (tmp_path / "rows.jsonl").write_text(f"{line}\n{{broken\n{line}\n")
    path, none = str(tmp_path / "rows.jsonl"), spark.createDataFrame([], S.IMAGE_DIMS)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        R.read_training_rows(spark, path).collect()
    rows = R.read_training_rows(spark, path, quarantine=True)
    usage = J.row_usage(rows, none, select_models(["gpt-5"]))
    assert [(r.task_id, r.text_tokens) for r in usage.collect()] == [(None, 3)] * 2
    good, broken = Q.split_readable(rows)
    assert good.count() == 2 and broken.count() == 1
    assert broken.first().reason == "unreadable"


def test_training_rows_from_a_json_array(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text(json.dumps([{"messages": [{"role": "user", "content": f"x{i}"}],
                                 "images": []} for i in range(10)], indent=4))
    rows = R.read_training_rows(spark, str(path), json_array=True, partitions=3)
    assert rows.count() == 10 and rows.rdd.getNumPartitions() == 3
    usage = J.row_usage(rows, spark.createDataFrame([], S.IMAGE_DIMS), select_models(["gpt-5"]),
                        keys=("conversation_id",), limit=9)
    assert sorted(r.conversation_id for r in usage.collect()) == list(range(9))
    assert {r.text_tokens for r in usage.collect()} == {2}


def document(model, conversations, cost):
    totals = {c: 10 for c in S.TOKEN_TOTALS} | {c: cost for c in S.COST_TOTALS}
    return {"model": model, "model_config": dict(zip(S.CONFIG_FIELDS, ("e", True, 1.0, 2.0, 1.0))),
            "input_file": "f", "total_conversations": conversations, "totals": totals,
            "averages": {c: 1.5 for c in S.AVERAGES},
            "per_conversation": [{"conversation_id": 0, "image_details": []}]}


@pytest.fixture()
def results(tmp_path):
    def put(name, doc, **kw):
        (tmp_path / name).write_text(doc if isinstance(doc, str) else json.dumps(doc, **kw))
        return str(tmp_path / name)
    return put


def test_named_result_sets(spark, results):
    paths = [("a", results("a.json", document("x", 3, 1.5), indent=2)),
             ("gone", "/nowhere/x.json"), ("bad", results("bad.json", "{no json")),
             ("empty", results("empty.json", "{}")),
             ("a", results("a2.json", document("x", 9, 0.5)))]
    found, skipped = R.read_result_sets(spark, paths)
    assert {r.model: r.reason for r in skipped.collect()} == {
        "gone": "not found", "bad": "unreadable", "empty": "incomplete"}
    last = found.collect()
    assert [(r.model, r.total_conversations, r.total_cost) for r in last] == [("a", 9, 0.5)]
    assert R.read_result_set(spark, paths[0][1]).first().total_conversations == 3
    with pytest.raises(FileNotFoundError):
        R.read_result_sets(spark, {"gone": "/nowhere/x.json"})


def test_discovered_result_sets(spark, results, tmp_path):
    results("m1_tokens.json", document(None, 1, 1.0))
    results("m2_tokens_accurate.json", document(None, 2, 2.0))
    results("m3_tokens_other.json", document("named", 3, 3.0))
    results("m4_tokens_bad.json", "[")
    results("not_matching.json", document("n", 4, 4.0))
    results("m5_tokens.json", document("m1", 7, 1.0))      # the label of the first file
    found, skipped = R.discover_result_sets(spark, str(tmp_path))
    assert [(r.model, r.reason) for r in skipped.collect()] == [
        ("m4_tokens_bad.json", "unreadable")]
    assert {r.model: r.total_conversations for r in found.collect()} == {
        "m1": 7, "m2": 2, "named": 3}
    assert [r.model for r in C.cost_rank(found).collect()] == ["m1", "m2", "named"]


@pytest.mark.parametrize("name,label", [
    ("/x/gpt-5_tokens.json", "gpt-5"), ("gpt-5_tokens_accurate.json", "gpt-5"),
    ("gpt-5_tokens_v2.json", "gpt-5_tokens_v2.json")])
def test_label_from_file_name(spark, name, label):
    row = spark.range(1).select(model_from_file(F.lit(name)).alias("m")).first()
    assert row.m == label


def test_score_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([brute.task("t", 2)], S.TRAJECTORY).write.parquet(str(tmp_path / "p"))
    data = spark.read.parquet(str(tmp_path / "p"))
    plan = J.training_set(data)[0]._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("GreaterThanOrEqual(alignment_score,5)" in s for s in scans)
    assert all("reflection" not in s and "efficiency_score" not in s for s in scans)


def test_refresh_opens_new_and_changed_files_only(spark, tmp_path):
    import os

    def put(name, content, time=10**18):
        (tmp_path / name).write_bytes(content)
        os.utime(tmp_path / name, ns=(time, time))
        return str(tmp_path / name)
    same, touched, grown, gone = (put(n, png(10, 20)) for n in ("same", "touched", "grown", "gone"))
    empty = spark.createDataFrame([], S.STORED_DIMS)
    names = spark.createDataFrame([(p,) for p in (same, touched, grown, gone, same, None,
                                                  str(tmp_path / "never"))], "name string")

    def keep(frame, name):
        frame.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))
    dims, changes = I.refresh_image_dims(empty, names, "name")
    stored = keep(dims, "first")
    assert {r.path: (r.width, r.height, r.status) for r in stored.collect()} == {
        p: (10, 20, "ok") for p in (same, touched, grown, gone)}
    assert {r.change for r in changes.collect()} == {"new"}

    # Other bytes of the same size and time: whoever opened the file would see them.
    put("same", png(11, 21))
    put("touched", png(30, 40), 2 * 10**18)
    put("grown", png(50, 60) + b"more")
    (tmp_path / "gone").unlink()
    fresh = put("fresh", png(7, 8))
    broken = put("broken", b"")
    dims, changes = I.refresh_image_dims(
        stored, spark.createDataFrame([(fresh,), (broken,)], "path string"))
    assert {r.path: r.change for r in changes.collect()} == {
        same: "unchanged", touched: "changed", grown: "changed", gone: "deleted", fresh: "new",
        broken: "new"}
    again = keep(dims, "second")
    assert {r.path: (r.width, r.height, r.status) for r in again.collect()} == {
        same: (10, 20, "ok"), touched: (30, 40, "ok"), grown: (50, 60, "ok"), fresh: (7, 8, "ok"),
        broken: (None, None, "corrupt")}
    dims, changes = I.refresh_image_dims(again)
    assert {r.change for r in changes.collect()} == {"unchanged"}
    assert sorted(dims.collect(), key=repr) == sorted(again.collect(), key=repr)
    # Rows without size or time, and contradicting ones, are looked at again.
    odd = spark.createDataFrame([(same, 1, 1, "ok", None, None), (touched, 1, 1, "ok", 1, 1),
                                 (touched, 2, 2, "ok", 2, 1)], S.STORED_DIMS)
    dims, _ = I.refresh_image_dims(odd)
    assert {r.path: (r.width, r.height) for r in dims.collect()} == {same: (11, 21), touched: (30, 40)}


def test_usage_of_one_model_is_written_by_many_tasks(spark, tmp_path):
    """With adaptive execution off; files are bounded and every row is there."""
    usage = spark.range(9_000).selectExpr("cast(id as string) AS task_id", "id % 7 AS prefix_len",
                                          "'one' AS model", "map('a', id) AS m")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        W.write_usage(usage, str(tmp_path / "u"), least_rows=100)
        both = usage.unionByName(usage.limit(50).withColumn("model", F.lit("two")))
        W.write_usage(both, str(tmp_path / "b"), rows_per_file=2_000, least_rows=1_000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list((tmp_path / "u" / "model=one").glob("*.parquet"))) == 8
    back = spark.read.parquet(str(tmp_path / "u"))
    assert back.count() == 9_000 and back.select("task_id").distinct().count() == 9_000
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "b" / "model=one").glob("*.parquet")]
    assert sum(sizes) == 9_000 and 5 <= len(sizes) <= 10 and max(sizes) <= 2_000
    assert len(list((tmp_path / "b" / "model=two").glob("*.parquet"))) == 1
    W.write_usage(usage.limit(0), str(tmp_path / "none"))
    slots = W.usage_slots(both, 2_000, 1_000, 8)
    assert slots == {"one": (0, 5), "two": (5, 1)}
