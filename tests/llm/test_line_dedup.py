import random
import re

from hypothesis import given, settings, strategies as st

from tests.llm.helpers import MIDDLE, documents, oracle, rows, same_rows
from trajspark.llm import line_dedup, queries

COLUMNS = ("doc_id", "n_lines", "n_dropped", "dropped")


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return row[-1]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def slow(docs):
    """Every line against every earlier one."""
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0, k))
    seen, out = [], []
    for k in order:
        doc_id, text = docs[k]
        lost, count = [], 0
        for n, line in enumerate((text or "").split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", lower(line))
            if not words:
                continue
            count += 1
            if any(words == w or min(len(words), len(w)) >= 8 and abs(len(words) - len(w)) < 2
                   and edit_distance(words, w) <= 1 for w in seen):
                lost.append(n)
            else:
                seen.append(words)
            seen.append(words)
        out.append((doc_id, count, len(lost), ",".join(map(str, lost))))
    return sorted(out, key=repr)


def corpus():
    draw = random.Random(11)
    words = "sun moon sea tree bird wind rain snow day night".split()
    lines = [" ".join(draw.choice(words) for _ in range(draw.randrange(1, 14)))
             for _ in range(60)]
    for _ in range(80):
        line = draw.choice(lines).split()
        at = draw.randrange(len(line))
        line[at:at + draw.randrange(2)] = draw.choice([[], [draw.choice(words)]])
        lines.append(" ".join(line) or "x")
    draw.shuffle(lines)
    docs = [(100 - k, "\n".join(draw.choice(lines) for _ in range(6))) for k in range(40)]
    docs += [(7, None), (8, ""), (9, "\n \n\t"), (None, lines[0] + "\n" + lines[1]),
             (5, "A  b\tc D e f g h\na b c d e f g H\n\nx"), (5000, "one two " * 4000)]
    return docs


def test_whole_table(spark):
    same_rows(queries.op7_line_dedup(spark, MIDDLE).toPandas(),
              oracle(line_dedup.ORACLE_SQL, MIDDLE))


def test_cases(spark, tmp_path):
    docs = corpus()
    path = str(tmp_path / "docs")
    documents(spark, [(i, t, "s") for i, t in docs], "_row line key place").write.parquet(path)
    frame = spark.read.parquet(path)
    assert rows(line_dedup.line_dedup(frame), *COLUMNS) == slow(docs)
    kept = line_dedup.deduped(frame)
    assert kept.columns == frame.columns
    wanted = []
    for doc_id, count, n, lost in slow(docs):
        text = next(t for i, t in docs if i == doc_id)
        if n:
            lost = {int(k) for k in lost.split(",")}
            text = "\n".join(s for k, s in enumerate(text.split("\n")) if k not in lost)
        if n < count or not count:
            wanted.append((doc_id, text, None if text is None else len(text)))
    assert rows(kept, "doc_id", "text", "n_chars") == sorted(wanted, key=repr)


def test_repeated_rows(spark, tmp_path):
    docs = [(1, "a b\nc d"), (1, "a b\nc d"), (1, "a b\nc d"), (2, "c d\ne")]
    documents(spark, [(i, t, "s") for i, t in docs]).write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    assert rows(line_dedup.line_dedup(frame), *COLUMNS) == sorted(
        [(1, 2, 0, ""), (1, 2, 2, "0,1"), (1, 2, 2, "0,1"), (2, 2, 1, "0")])
    assert rows(line_dedup.deduped(frame), "doc_id", "text") == [(1, "a b\nc d"), (2, "e")]


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    assert line_dedup.line_dedup(frame).count() == 0
    assert line_dedup.deduped(frame).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.sampled_from("abc"), max_size=9))
def test_bound_and_shared_keys(a, b):
    near = edit_distance(a, b) <= 1
    assert line_dedup.within_bound(a, b) == near
    a, b = ([w.encode() for w in x] for x in (a, b))
    if near and a != b and a and b:
        assert set(line_dedup.half_keys(a)) & set(line_dedup.half_keys(b))
        keys = [line_dedup.variant_keys(x) for x in (a, b)]
        whole = [{k for k, place in ks if place == -1} for ks in keys]
        assert set(keys[0]) & set(keys[1]) or any(
            whole[i] & {k for k, place in keys[1 - i] if place >= 0} for i in (0, 1))


def test_common_lines_and_others(spark, tmp_path):
    """The same rows whether all, some or none of the repeated lines count as common."""
    docs = [(i, t, "s") for i, t in corpus()] + [(9000 + k, "a b c\nonly " + str(k), "s")
                                                 for k in range(60)]
    documents(spark, docs).write.parquet(str(tmp_path / "d"))
    full = spark.read.parquet(str(tmp_path / "d")).selectExpr("doc_id AS _row", "doc_id", "text")
    full = full.filter("doc_id is not null")
    wanted = [(i, n, [int(k) for k in d.split(",") if k]) for i, n, _, d in slow(
        [(i, t) for i, t, _ in docs if i is not None])]
    for common in (1, 4, 1 << 40):
        got = line_dedup.line_verdicts(full, common)
        assert rows(got, "doc_id", "n_lines", "dropped") == sorted(wanted, key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and sum(len(w[2]) for w in wanted) > 60


def test_keys_of_a_very_long_line():
    """Time is linear in the line: 50,000 words in well under a minute, each variant's key that of
    the line without the word."""
    import time
    words = [b"w%d" % (k % 977) for k in range(50_000)]
    start = time.process_time()
    keys = line_dedup.variant_keys(words)
    assert time.process_time() - start < 5
    assert [place for _, place in keys] == list(range(-1, 50_000))
    for k in (0, 1, 25_000, 49_999):
        assert keys[k + 1][0] == line_dedup.variant_keys(words[:k] + words[k + 1:])[0][0]
    assert len({key for key, _ in keys}) == len(keys)


def test_any_ids_and_any_input(spark, tmp_path):
    from pyspark.sql import functions as F
    line = " ".join(f"w{k}" for k in range(12))
    data = [("b", line + "\nonly here"), ("a", line.replace("w5", "x5")), ("c", line.upper()),
            (None, "only here")]
    docs = spark.createDataFrame(data, "doc_id string, text string")
    wanted = {"a": "", "b": "0", "c": "0", None: "0"}
    assert {r.doc_id: r.dropped for r in line_dedup.line_dedup(docs).collect()} == wanted
    docs.write.parquet(str(tmp_path / "d"))
    files = spark.read.parquet(str(tmp_path / "d"))
    assert line_dedup.is_plain_scan(files.filter("text <> ''").select("doc_id", "text"))
    shuffled = files.repartition(3, F.rand()).union(files.limit(0))
    assert not line_dedup.is_plain_scan(shuffled)
    assert {r.doc_id: r.dropped for r in line_dedup.line_dedup(shuffled).collect()} == wanted
    kept = {r.doc_id: r.text for r in line_dedup.deduped(docs).collect()}
    assert kept == {"a": line.replace("w5", "x5"), "b": "only here"}
