"""Trajectory-shaped views of the given tables.

Every turn after the first is a step of the task its conversation is. Sizes follow the keys,
states follow the text: steps with little text have no image or an unreadable one.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

MISSING_BELOW = 90      # characters of text
CORRUPT_BELOW = 130
UNCOUNTABLE = "thean" # what the failing counter of some queries stumbles over


# The given tables' columns; declared, so that no job is spent on reading footers.
SCHEMAS = {
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_extendedprice double, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir, name) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def steps(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").filter(F.col("turn") > 0)
    pos = F.col("turn") - 1
    return rows.select(
        F.col("conv_id").alias("task_id"), pos.alias("pos"), pos.alias("index"),
        _text(F.col("conv_id"), "_", pos, ".png").alias("image"),
        _text("screen ", pos).alias("observation"), _text("thought of ", pos).alias("thought"),
        F.col("text").alias("action"), _text("click(", pos, ")").alias("code"))


def tasks(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").filter(F.col("turn") == 0)
    score = F.least(F.lit(10).cast("long"), F.floor(F.length("text") / 25).cast("long"))
    tag = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")),
                       (F.col("conv_id") % 3 + 1).cast("int"))
    return rows.select(F.col("conv_id").alias("task_id"), F.col("text").alias("instruction"),
                       score.alias("alignment_score"), tag.alias("dataset"))


def nested(heads: DataFrame, flat: DataFrame) -> DataFrame:
    """The nested form, one row per task, as a trajectory file has it."""
    step = F.struct("pos", F.struct("index", "image", F.struct(
        "observation", "thought", "action", "code").alias("value")).alias("step"))
    traj = (flat.groupBy("task_id").agg(F.array_sort(F.collect_list(step)).alias("steps"))
            .select("task_id", F.transform("steps", lambda s: s["step"]).alias("traj")))
    return heads.join(traj, "task_id")


def trajectories(spark, sf_dir) -> DataFrame:
    return nested(tasks(spark, sf_dir), steps(spark, sf_dir))


def image_dims(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").filter(F.col("turn") > 0)
    conv, pos, chars = F.col("conv_id"), F.col("turn") - 1, F.length("text")
    return rows.filter(chars >= MISSING_BELOW).select(
        _text(conv, "_", pos, ".png").alias("path"),
        (1 + (conv * 977 + pos * 613) % 4200).alias("width"),
        (1 + (conv * 541 + pos * 389) % 3000).alias("height"),
        F.when(chars < CORRUPT_BELOW, F.lit("corrupt")).otherwise(F.lit("ok")).alias("status"))


def order_steps(spark, sf_dir):
    """(tasks, steps, image_dims) with one task per order, for volume."""
    from pyspark.sql import Window
    lines = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    rows = lines.select(
        F.col("l_orderkey").alias("task_id"), "l_partkey", "l_suppkey",
        (F.row_number().over(order) - 1).cast("long").alias("pos"))
    image = _text(F.col("l_partkey"), "_", F.col("l_suppkey"), ".png")
    flat = rows.select(
        "task_id", "pos", F.col("pos").alias("index"), image.alias("image"),
        _text("screen ", F.col("pos")).alias("observation"),
        _text("thought of ", F.col("pos")).alias("thought"),
        _text("part ", F.col("l_partkey")).alias("action"),
        _text("click(", F.col("pos"), ")").alias("code"))
    heads = lines.select("l_orderkey").distinct().select(
        F.col("l_orderkey").alias("task_id"),
        _text("order ", F.col("l_orderkey")).alias("instruction"))
    dims = lines.select("l_partkey", "l_suppkey").distinct().select(
        image.alias("path"), (1 + F.col("l_partkey") % 4200).alias("width"),
        (1 + F.col("l_suppkey") % 3000).alias("height"), F.lit("ok").alias("status"))
    return heads, flat, dims
