"""Order-dependent steps that stay parallel inside one long sequence.

Positions are dense per task (array positions). Each task is cut into chunks of fixed length;
a chunk also receives a halo, copies of the last rows of the chunk before it, so that look-back
windows never need more than one chunk. A task holding a third of all rows becomes many small
window partitions, at the price of `look_back / chunk` more rows.
"""

from pyspark.sql import DataFrame, Window, functions as F

CHUNK = 4096


def chunk_of(position, chunk):
    return F.expr(f"{position} div {chunk}").cast("long")


def with_halo(rows: DataFrame, look_back, chunk=CHUNK, position="pos") -> DataFrame:
    """Adds `chunk` and `halo`; halo rows are copies and must be dropped after the window.

    The result is partitioned by (task, chunk) on purpose: after a join on the task alone Spark
    would find its partitioning good enough for the window and keep a long task in one place.
    """
    if look_back >= chunk:
        raise ValueError("chunk must be larger than the look-back")
    own = chunk_of(position, chunk)
    tail = F.pmod(F.col(position), F.lit(chunk)) >= chunk - look_back
    places = F.when(tail, F.array(F.struct(own.alias("chunk"), F.lit(False).alias("halo")),
                                  F.struct((own + 1).alias("chunk"), F.lit(True).alias("halo"))))
    places = places.otherwise(F.array(F.struct(own.alias("chunk"), F.lit(False).alias("halo"))))
    return rows.select("*", F.inline(places)).repartition("task_id", "chunk")


def chunk_window(position="pos"):
    return Window.partitionBy("task_id", "chunk").orderBy(position)


def chunk_sums(rows: DataFrame, values, chunk=CHUNK, position="pos") -> DataFrame:
    """One row per task and chunk: n_steps of the whole task and, per value, the sum over all
    earlier chunks (<value>_before) with the number of nulls among them (<value>_gaps).

    Partial sums are taken before the shuffle; the windows run over one row per chunk.
    """
    parts = [F.count(F.lit(1)).alias("_rows")]
    for v in values:
        parts += [F.sum(F.coalesce(v, F.lit(0))).alias(f"{v}_before"),
                  F.count_if(F.col(v).isNull()).alias(f"{v}_gaps")]
    sums = rows.groupBy("task_id", chunk_of(position, chunk).alias("chunk")).agg(*parts)
    task = Window.partitionBy("task_id")
    earlier = task.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        "task_id", "chunk", F.sum("_rows").over(task).alias("n_steps"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n)
          for n in offset_names(values)])


def offset_names(values):
    return [f"{v}_{kind}" for v in values for kind in ("before", "gaps")]


def dense_ids(rows: DataFrame, order=(), name="conversation_id") -> DataFrame:
    """0-based position in the given total order, without a single-partition window. With no
    order it is the position in the input, file by file.

    Sort in ranges, number inside each range, add the size of the ranges before. The placed
    rows are checkpointed because both uses must see the same ranges.
    """
    from trajspark.sources.lineage import cut_lineage
    # monotonically_increasing_id keeps the partition number above bit 33.
    ordered = rows.orderBy(*order) if order else rows
    placed = cut_lineage(ordered
                         .withColumn("_place", F.monotonically_increasing_id())
                         .withColumn("_part", F.shiftright("_place", 33))
                         .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").count()
               .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0))
                       .alias("_before")))
    return (placed.join(offsets, "_part")
            .withColumn(name, F.col("_before") + F.col("_row"))
            .drop("_part", "_row", "_before", "_place"))
