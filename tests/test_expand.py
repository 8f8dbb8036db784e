import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests import brute
from trajspark.operators import expand as P, measure as M, quality as Q
from trajspark.plans import jobs as J
from trajspark.schemas import TRAJECTORY
from trajspark.settings import PROMPTS


def frame(spark, tasks):
    return spark.createDataFrame(tasks, TRAJECTORY)


def built(rows):
    return {(r.task_id, r.prefix_len): ([(m.role, m.content) for m in r.messages], r.images)
            for r in rows.collect()}


def expected(tasks, level, k=3, aligned=False):
    return {(t["task_id"], n): brute.row(t, n, level, PROMPTS[level], k, aligned)
            for t in tasks for n in range(1, len(t["traj"]) + 1)}


@pytest.mark.parametrize("level", ["L1", "L2", "L3"])
@pytest.mark.parametrize("window", [1, 2, 3])
def test_rows_of_every_prefix(spark, level, window):
    tasks = [brute.task(f"t{n}", n) for n in range(0, 8)]
    got = built(P.training_rows(frame(spark, tasks), level, window=window))
    assert got == expected(tasks, level, window)


def test_images_of_four_and_five_steps(spark):
    got = built(P.training_rows(frame(spark, [brute.task("t", 5)])))
    assert got["t", 4][1] == ["t_0.png", "t_2.png", "t_3.png"]
    assert got["t", 5][1] == ["t_1.png", "t_3.png", "t_4.png"]


def test_aligned_images(spark):
    tasks = [brute.task("t", 6)]
    got = built(P.training_rows(frame(spark, tasks), first_image="aligned"))
    assert got == expected(tasks, "L2", aligned=True)


def test_label_follows_index_and_slice_follows_position(spark):
    t = brute.task("t", 5)
    for s in t["traj"]:
        s["index"] += 10
    got = built(P.training_rows(frame(spark, [t])))
    assert got == expected([t], "L2")
    assert got["t", 4][0][2][1].startswith("# Step 11\n")


def test_literal_code_opening(spark):
    messages, _ = built(P.training_rows(frame(spark, [brute.task("t", 1)]), "L1"))["t", 1]
    assert messages[-1][1] == ("# Step 1\n## Action: do it\n\n"
                               "## Code: ```python\\nclick(0)```")


def test_long_tasks_are_split_into_ranges(spark):
    tasks = [brute.task("long", 23), brute.task("edge", 5), brute.task("short", 4)]
    rows = P.training_rows(frame(spark, tasks), split_over=5)
    assert built(rows) == expected(tasks, "L2")
    assert built(P.training_rows(frame(spark, tasks), split_over=None)) == built(rows)


def test_prefix_selection(spark):
    data = frame(spark, [brute.task("a", 4), brute.task("b", 2)])
    assert sorted(built(P.training_rows(data, full_only=True, split_over=3))) == [
        ("a", 4), ("b", 2)]
    assert sorted(built(P.training_rows(data, min_prefix=2))) == [("a", 3), ("a", 4)]
    assert P.prefixes(data, full_only=True).count() == 2


def test_image_root(spark):
    _, images = built(P.training_rows(frame(spark, [brute.task("a", 1)]),
                                      image_root="/shots/"))["a", 1]
    assert images == ["/shots/a_0.png"]


def test_documented_layout(spark):
    rows = built(P.training_rows(frame(spark, [brute.task("t", 4)]), layout="documented"))
    messages, images = rows["t", 4]
    assert messages == [
        ("system", PROMPTS["L2"]),
        ("assistant", "# Step 1\n## Action:\ndo it\n"),
        ("user", "<image>"), ("assistant", "# Step 2\n## Action:\ndo it\n"),
        ("user", "<image>"), ("assistant", "# Step 3\n## Action:\ndo it\n"),
        ("user", "<image>"),
        ("user", "# Task Instruction:\nsort it\n\nPlease generate the next move."),
        ("assistant", "# Step 4\n## Thought:\nhm\n## Action:\ndo it\n## Code:\n"
                      "```python\nclick(3)\n```")]
    assert images == ["t_1.png", "t_2.png", "t_3.png"]


def test_bad_arguments(spark):
    data = frame(spark, [brute.task("a", 1)])
    for kw in ({"level": "L9"}, {"layout": "x"}, {"first_image": "x"}, {"window": 0}):
        with pytest.raises(ValueError):
            P.training_rows(data, **kw)


def test_score_filter_and_quarantine(spark):
    tasks = [brute.task("low", 1, score=4), brute.task("keep", 1, score=5),
             brute.task("none", 1, score=None), brute.task("bad", 2, thought=None)]
    tasks.append({**brute.task("nulltraj", 0), "traj": None})
    data = frame(spark, tasks)
    rows, bad = J.training_set(data, level="L2")
    assert [r.task_id for r in rows.collect()] == ["keep"]
    assert {r.task_id: r.reason for r in bad.collect()} == {
        "bad": "null thought", "nulltraj": "null traj"}
    rows, bad = J.training_set(data, level="L1")
    assert sorted(r.task_id for r in rows.collect()) == ["bad", "bad", "keep"]
    with pytest.raises(ValueError):
        J.training_set(data, level="L2", strict=True)


@pytest.mark.parametrize("change,reason", [
    ({"instruction": None}, "null instruction"),
    ({"traj": [{**brute.step(0), "index": None}]}, "null index"),
    ({"traj": [{**brute.step(0), "image": None}]}, "null image"),
    ({"traj": [{**brute.step(0), "value": None}]}, "null action"),
    ({"traj": [brute.step(0, text=None)]}, "null action"),
])
def test_quarantine_reasons(spark, change, reason):
    ok, bad = Q.split_valid(frame(spark, [{**brute.task("t", 1), **change}]), "L1")
    assert ok.count() == 0 and bad.first().reason == reason


def test_only_emitted_targets_need_a_thought(spark):
    record = brute.task("t", 3)
    record["traj"][1]["value"]["thought"] = None
    data = frame(spark, [record])
    rows, bad = J.training_set(data, level="L2", full_only=True)
    assert [r.prefix_len for r in rows.collect()] == [3] and bad.count() == 0
    assert J.training_set(data, level="L2", min_prefix=2)[0].count() == 1
    assert J.training_set(data, level="L2", min_prefix=1)[1].count() == 1


def test_missing_images_abort_the_strict_job(spark):
    data = frame(spark, [brute.task("t", 3)])
    dims = spark.createDataFrame([("t_0.png", 10, 10, "ok"), ("t_2.png", None, None, "corrupt")],
                                 "path string, width bigint, height bigint, status string")
    needed = P.image_rows(P.training_rows(data))
    assert [r.path for r in Q.missing_images(needed, dims).collect()] == ["t_1.png"]
    with pytest.raises(FileNotFoundError):
        J.training_set(data, dims)
    extra = spark.createDataFrame([("t_1.png", 1, 1, "ok")], dims.schema)
    rows, _ = J.training_set(data, dims.union(extra))
    assert rows.count() == 3
    four = frame(spark, [brute.task("t", 4)])
    # Of the whole trajectory only, the second screenshot is not shown and may be missing.
    last = spark.createDataFrame([("t_3.png", 1, 1, "ok")], dims.schema)
    assert J.training_set(four, dims.union(last), full_only=True)[0].count() == 1
    with pytest.raises(FileNotFoundError):
        J.training_set(four, dims.union(last))


def test_streaming_source_needs_no_state(spark, tmp_path):
    frame(spark, [brute.task("t", 4)]).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(TRAJECTORY).json(str(tmp_path / "in"))
    query = (P.training_rows(stream, split_over=None).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination(60)
    assert built(spark.read.parquet(str(tmp_path / "out"))) == expected(
        [brute.task("t", 4)], "L2")


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lengths=st.lists(st.integers(0, 9), min_size=1, max_size=5))
def test_row_shape(spark, lengths):
    tasks = [brute.task(str(i), n) for i, n in enumerate(lengths)]
    rows = built(P.training_rows(frame(spark, tasks), split_over=4))
    assert len(rows) == sum(lengths)
    for (_, n), (messages, images) in rows.items():
        assert len(images) == min(n, 3)
        assert len(messages) == 2 + 2 * (n > 3) + 2 * min(n, 3) - 1
        assert sum(c.count("<image>") for _, c in messages) == len(images)


def test_flat_image_windows_equal_nested(spark):
    tasks = [brute.task("a", 37), brute.task("b", 3)]
    data = frame(spark, tasks)
    steps = data.select("task_id", F.posexplode("traj")).select("task_id", "pos", "col.image")
    for kind in ("coded", "aligned"):
        for chunk in (5, 8, 4096):
            flat = M.image_windows(steps, chunk=chunk, first_image=kind)
            got = {(r.task_id, r.prefix_len): r.images for r in flat.collect()}
            want = {k: v[1] for k, v in expected(tasks, "L2", aligned=kind == "aligned").items()}
            assert got == want
