"""Indented JSON arrays, cut into many tasks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from trajspark.operators import quality as Q
from trajspark.operators.sequences import dense_ids
from trajspark.sinks import writers as W
from trajspark.sources import json_array as A, readers as R

TRICKY = ["\n    },\n    {", "\n]", "},\n", "[{\"a\": 1}]", "é漢😀 ", "\\n    },\\n", "", "\t\r\n\"\\", "]"]


def rows(n, last_key="images"):
    draw = random.Random(n)
    out = []
    for k in range(n):
        messages = [{"role": "user", "content": draw.choice(TRICKY) + f" {k} " + draw.choice(TRICKY)}
                    for _ in range(draw.randrange(0, 4))]
        row = {"task_id": f"t{k}", "images": [draw.choice(TRICKY) for _ in range(draw.randrange(3))]}
        row["messages"] = messages
        if last_key == "images":
            row["images"] = row.pop("images")
        out.append(row)
    return out


def plain(frame, key="task_id"):
    return sorted(((r[key], [(m.role, m.content) for m in r.messages or []], list(r.images or []))
                   for r in frame.collect()), key=repr)


def expected(data):
    return sorted(((r["task_id"], [(m["role"], m["content"]) for m in r["messages"]], r["images"])
                   for r in data), key=repr)


@pytest.fixture()
def split(spark):
    """Sets the size of a split for the test."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


@pytest.mark.parametrize("indent,last_key,ascii_only", [(4, "images", True), (2, "messages", False),
                                                        ("\t", "images", False)])
def test_every_cut_gives_every_record(spark, tmp_path, split, indent, last_key, ascii_only):
    data, path = rows(12, last_key), tmp_path / "a.json"
    path.write_text(json.dumps(data, indent=indent, ensure_ascii=ascii_only))
    size = path.stat().st_size
    for bytes_a_split in [*range(7, 60, 4), *range(60, 400, 41), size // 2, size, size * 2]:
        split(bytes_a_split)
        got = R.read_training_rows(spark, str(path), json_array=True)
        assert plain(got) == expected(data), bytes_a_split
    split(size // 6)
    got = R.read_training_rows(spark, str(path), json_array=True)
    assert got.rdd.getNumPartitions() >= 6
    spread = got.select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 3
    ids = dense_ids(got.select("task_id", "conversation_id"), ["conversation_id"], name="n").collect()
    assert [r.task_id for r in sorted(ids, key=lambda r: r.n)] == [r["task_id"] for r in data]


def test_line_ends_of_another_system(spark, tmp_path, split):
    data, path = rows(9), tmp_path / "a.json"
    path.write_bytes(json.dumps(data, indent=4).replace("\n", "\r\n").encode())
    split(200)
    assert plain(R.read_training_rows(spark, str(path), json_array=True)) == expected(data)


def test_other_layouts_and_files_of_several(spark, tmp_path):
    data = rows(20)
    for k, (part, indent) in enumerate(((data[:6], 4), (data[6:9], None), (data[9:14], 2),
                                        (data[14:20], 4), ([], 4))):
        (tmp_path / f"{k}.json").write_text(json.dumps(part, indent=indent))
    assert plain(R.read_training_rows(spark, str(tmp_path), json_array=True)) == expected(data)
    one_line = str(tmp_path / "1.json")
    assert A.record_end(spark, one_line) is None
    assert plain(R.read_training_rows(spark, one_line, json_array=True)) == expected(data[6:9])
    assert R.read_training_rows(spark, str(tmp_path / "4.json"), json_array=True).count() == 0


def test_broken_records(spark, tmp_path):
    path = tmp_path / "a.json"
    good = [json.dumps(r, indent=4).replace("\n", "\n    ") for r in rows(4)]
    path.write_text("[\n    " + ",\n    ".join(
        [good[0], "{\n        \"task_id\": oops\n    }", good[1], "{\n        \"prefix_len\": \"x\"\n    }",
         good[2]]) + "\n]")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        R.read_training_rows(spark, str(path), json_array=True).collect()
    kept, broken = Q.split_readable(R.read_training_rows(spark, str(path), json_array=True,
                                                         quarantine=True))
    assert plain(kept) == expected(rows(4)[:3])
    assert broken.count() == 2 and {r.reason for r in broken.collect()} == {"unreadable"}
    path.write_text(path.read_text()[:-30])                 # cut off inside the last record
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        R.read_training_rows(spark, str(path), json_array=True).collect()


def test_arrays_are_written_as_a_json_library_writes_them(spark, tmp_path):
    data = [{"task_id": f"t{k}", "prefix_len": k, "messages": r["messages"], "images": r["images"],
             "shard": k % 3} for k, r in enumerate(rows(17))]
    frame = spark.createDataFrame(data, "task_id string, prefix_len long, messages array<struct<"
                                  "role: string, content: string>>, images array<string>, shard int")
    W.write_training_arrays(frame.repartition(4), str(tmp_path / "w"), "shard", ["prefix_len"])
    for s in range(3):
        files = list((tmp_path / "w" / f"shard={s}").glob("*.txt"))
        assert len(files) == 1
        wanted = [{c: r[c] for c in ("task_id", "prefix_len", "messages", "images")}
                  for r in data if r["shard"] == s]
        text = files[0].read_text()
        assert json.loads(text) == wanted
        assert text == json.dumps(wanted, indent=4, ensure_ascii=False) + "\n"
    got = R.read_training_rows(spark, str(tmp_path / "w" / "*"), json_array=True)
    assert plain(got) == expected(data)


def test_null_values_are_written(spark, tmp_path):
    frame = spark.createDataFrame([("a", None, None, 1), (None, [None], [], 1)],
                                  "task_id string, images array<string>, n array<int>, shard int")
    W.write_training_arrays(frame, str(tmp_path / "w"), "shard", [F.col("task_id").desc()])
    text = next((tmp_path / "w").glob("*/*.txt")).read_text()
    assert json.loads(text) == [{"task_id": "a", "images": None, "n": None},
                                {"task_id": None, "images": [None], "n": []}]
