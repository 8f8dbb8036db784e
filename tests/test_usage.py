import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Row, functions as F

from tests import brute
from trajspark.functions import images as I
from trajspark.operators import usage as U
from trajspark.operators.expand import training_rows
from trajspark.operators.measure import with_dims
from trajspark.operators.sequences import chunk_sums, dense_ids
from trajspark.plans import jobs as J
from trajspark.schemas import IMAGE_DIMS, TRAINING_ROW, TRAJECTORY
from trajspark.settings import MODELS, PROMPTS, Model, select_models

SIZES = [(1920, 1080), (512, 512), (513, 512), (768, 768), (769, 769), (2048, 2048),
         (2049, 100), (1, 5000), (5000, 1), (100, 2049), (3000, 3000), (1, 1)]


def tile_values(spark, sizes):
    frame = spark.createDataFrame([(i, w, h) for i, (w, h) in enumerate(sizes)],
                                  "i int, w bigint, h bigint")
    rows = frame.select("i", I.tile_tokens("w", "h").alias("t")).orderBy("i")
    return [r.t for r in rows.collect()]


def test_tile_edges(spark):
    got = tile_values(spark, SIZES)
    assert got == [brute.tiles(w, h) for w, h in SIZES]
    assert got[0] == 1105 and got[7] == 85


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.tuples(st.integers(1, 6000), st.integers(1, 6000)), min_size=50,
                      max_size=200))
def test_tiles_of_any_size(spark, sizes):
    assert tile_values(spark, sizes) == [brute.tiles(w, h) for w, h in sizes]


def test_multipliers_and_fallbacks(spark):
    models = {str(m): Model("e", True, 1.0, 1.0, m) for m in (1.0, 1.62, 1.72, 33.33)}
    models["blind"] = Model("e", False, 1.0, 1.0, 33.33)
    frame = spark.createDataFrame([("ok", 1105, "ok"), ("bad", None, "corrupt"),
                                   ("gone", None, "missing")],
                                  "path string, tile_tokens bigint, status string")
    got = {(r.path, r.model): (r.tokens, r.base_tokens)
           for r in U.image_costs(frame, models).collect()}
    assert [got["ok", str(m)] for m in (1.0, 1.62, 1.72, 33.33)] == [
        (1105, 1105), (1790, 1104), (1900, 1104), (36829, 1104)]
    assert got["bad", "33.33"][0] == 8499 and got["bad", "1.0"][0] == 255
    assert got["gone", "33.33"] == (0, 0) and got["ok", "blind"] == (0, 0)


def test_documented_conversation(spark):
    """993 text and three 1105-token images: 12,400 tokens for $0.0917."""
    text = "a" + " a" * 496
    rows = spark.createDataFrame(
        [("c", 1, "L2", [("user", text), ("user", "<image>")], ["x.png"] * 3)], TRAINING_ROW)
    dims = spark.createDataFrame([("x.png", 1920, 1080, "ok")], IMAGE_DIMS)
    row = J.row_usage(rows, dims, select_models(["gpt-4o"])).first()
    assert (row.text_tokens, row.image_tokens, row.image_count) == (993, 3315, 3)
    assert (row.total_input_tokens, row.total_tokens) == (4308, 12400)
    assert round(row.pricing.total_cost, 4) == 0.0917
    assert row.image_details == [Row(path="x.png", tokens=1105, base_tokens=1105,
                                     multiplier=1.0)] * 3


def test_published_totals(spark):
    usage = spark.createDataFrame([("gpt-4o", 3639912, 8605740, 7788)],
                                  "model string, text_tokens long, image_tokens long, "
                                  "image_count long")
    many = usage.unionByName(spark.range(2595).select(
        F.lit("gpt-4o").alias("model"), *[F.lit(0).cast("long").alias(c) for c in (
            "text_tokens", "image_tokens", "image_count")]))
    row = U.usage_totals(many).first()
    assert row.total_conversations == 2596
    assert (row.total_input_tokens, row.total_output_tokens, row.total_tokens) == (
        12245652, 21006832, 33252484)
    assert [round(x, 2) for x in (row.total_input_cost, row.total_output_cost,
                                  row.total_cost)] == [30.61, 210.07, 240.68]
    assert round(row.avg_cost_per_conversation, 4) == 0.0927
    assert row.avg_images_per_conversation == 3.0


def test_no_conversations_give_no_totals(spark):
    usage = spark.createDataFrame([], "model string, text_tokens long, image_tokens long, "
                                      "image_count long")
    assert U.usage_totals(usage).count() == 0


@pytest.fixture(scope="module")
def corpus(spark):
    tasks = [brute.task(f"t{n}", n) for n in (0, 1, 2, 3, 4, 5, 9, 40)]
    for t in tasks:
        for s in t["traj"]:
            s["image"] = "hot.png" if s["index"] % 2 else s["image"]
    dims = [("hot.png", 1920, 1080, "ok"), ("t9_2.png", None, None, "corrupt")]
    dims += [(f"t40_{i}.png", 100 + 90 * i, 3000 - 60 * i, "ok") for i in range(0, 40, 4)]
    data = spark.createDataFrame(tasks, TRAJECTORY)
    return data.cache(), spark.createDataFrame(dims, IMAGE_DIMS).cache()


@pytest.mark.parametrize("window,first_image", [
    (1, "coded"), (2, "aligned"), (3, "coded"), (3, "aligned"), (4, "coded")])
def test_closed_form_totals_equal_summed_rows(spark, corpus, window, first_image):
    data, dims = corpus
    kw = {"window": window, "first_image": first_image}
    built = U.usage_totals(J.row_usage(training_rows(data, "L3", **kw), dims, details=False))
    sized = U.usage_totals(J.trajectory_usage(data, dims, "L3", chunk=9, details=False, **kw))
    closed = J.trajectory_totals(data, dims, "L3", **kw)
    want = sorted(built.collect())
    assert sorted(sized.collect()) == want
    assert sorted(closed.collect()) == want


def test_flat_tables_equal_nested(spark, corpus):
    data, dims = corpus
    steps = data.select("task_id", F.posexplode("traj")).select(
        "task_id", "pos", "col.index", "col.image", "col.value.*")
    want = J.trajectory_usage(data, dims, chunk=6)
    got = J.step_usage(data.select("task_id", "instruction"), steps, dims, chunk=6)
    assert sorted(got.collect()) == sorted(want.collect())
    totals = J.step_totals(data.select("task_id", "instruction", "alignment_score"), steps, dims,
                           by=("alignment_score",))
    assert sorted(totals.drop("alignment_score").collect()) == sorted(
        J.trajectory_totals(data, dims).collect())
    first = J.first_step_usage(data.select("task_id", "instruction"), steps, dims, 4,
                               details=False).select("task_id", "prefix_len").distinct()
    assert sorted(map(tuple, first.collect())) == [("t1", 1), ("t2", 1), ("t2", 2), ("t3", 1)]


def test_one_task_with_most_rows(spark):
    """A task of several chunks: offsets, halo and window together."""
    n = 10_000
    steps = spark.range(n).select(
        F.lit("hot").alias("task_id"), F.col("id").alias("pos"), F.col("id").alias("index"),
        F.concat(F.lit("s"), F.col("id") % 10).alias("image"), F.lit("o").alias("observation"),
        F.lit("t").alias("thought"), F.concat(F.lit("press "), F.col("id")).alias("action"),
        F.lit("c").alias("code"))
    tasks = spark.createDataFrame([("hot", "go")], "task_id string, instruction string")
    dims = spark.createDataFrame([(f"s{i}", 100 * i + 1, 700, "ok") for i in range(9)],
                                 IMAGE_DIMS)
    models = select_models(["gpt-4o-mini"])
    usage = J.step_usage(tasks, steps, dims, models=models, details=False, chunk=1000).cache()
    assert usage.count() == n
    texts = [f"# Step {i + 1}\n## Action: press {i}" for i in range(n)]
    size = [brute.tokens(t) for t in texts]
    row = usage.filter("prefix_len = 10000").first()
    history = sum(s + 1 for s in size[:n - 4]) + size[n - 4]
    last = brute.tokens(f"# Step {n}\n## Thought: t\n\n## Action: press {n - 1}\n\n"
                        "## Code: ```python\\nc```")
    assert row.text_tokens == (brute.tokens(PROMPTS["L2"]) + 1 + history
                               + size[n - 3] + size[n - 2] + last)
    totals = J.step_totals(tasks, steps, dims, models=models).first()
    sums = usage.agg(F.sum("text_tokens"), F.sum("image_tokens"), F.sum("image_count")).first()
    assert (totals.total_text_tokens, totals.total_image_tokens, totals.total_images) == tuple(
        sums)


def test_limits(spark):
    rows = spark.createDataFrame([(i, 1) for i in range(5)], "task_id int, prefix_len int")
    assert U.first_conversations(rows, 0).count() == 5
    assert U.first_conversations(rows, None).count() == 5
    assert [r.task_id for r in U.first_conversations(rows, 2).collect()] == [0, 1]
    with pytest.raises(ValueError):
        U.first_conversations(rows, -1)


def test_sample_shows_base_names(spark):
    rows = spark.createDataFrame(
        [(f"c{i}", 1, "L2", [("user", "x")], [f"/a/b/{i}.png", "/a/b/q.png", "z"])
         for i in range(5)], TRAINING_ROW)
    dims = spark.createDataFrame([], IMAGE_DIMS)
    sample = U.usage_sample(J.row_usage(rows, dims, select_models(["gpt-5"]))).collect()
    assert [r.task_id for r in sample] == ["c0", "c1", "c2"]
    assert [[d.name for d in r.image_details] for r in sample] == [
        [f"{i}.png", "q.png"] for i in range(3)]


def test_models(spark):
    with pytest.raises(ValueError, match="gpt-4o"):
        select_models(["nope"])
    extra = {**MODELS, "mine": Model("o200k_base", True, 1.0, 5.0)}
    assert select_models(["mine"], extra)["mine"].image_token_multiplier == 1.0
    averages = spark.createDataFrame([(4717.0,)], "avg_total_input_tokens double")
    got = {r.model: r.cost_per_conversation
           for r in U.cost_estimates(averages, extra).collect()}
    assert round(got["gpt-4o"], 3) == 0.093 and round(got["gpt-4o-mini"], 3) == 0.006


def test_legacy_delta(spark):
    frame = spark.createDataFrame([(1105,), (255,)], "tile_tokens bigint")
    assert sorted(r.delta for r in U.legacy_delta(frame).collect()) == [-680, 170]


def test_missing_and_null_images(spark):
    rows = spark.createDataFrame([("a",), (None,)], "image string")
    dims = spark.createDataFrame([("b", 1, 1, "ok")], IMAGE_DIMS)
    assert {r.status for r in with_dims(rows, dims).collect()} == {"missing"}


def test_dense_ids(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5000).alias("k"))
    placed = dense_ids(rows.drop("k").select(F.monotonically_increasing_id().alias("n")))
    assert placed.agg(F.max("conversation_id"), F.countDistinct("conversation_id")).first() == (
        4999, 5000)
    got = dense_ids(rows, ["k"])
    assert got.filter("k <> conversation_id").count() == 0 and got.count() == 5000


def test_chunk_sums(spark):
    rows = spark.range(25).select(F.lit("t").alias("task_id"), F.col("id").alias("pos"),
                                  F.when(F.col("id") != 12, F.lit(1)).alias("v"))
    got = {r.chunk: (r.v_before, r.v_gaps, r.n_steps)
           for r in chunk_sums(rows, ["v"], 10).collect()}
    assert got == {0: (0, 0, 25), 1: (10, 0, 25), 2: (19, 1, 25)}
