"""Sharded writers; nothing is collected."""

import json

from pyspark.sql import DataFrame, functions as F, types as T

from trajspark import schemas as S


def write_training_rows(rows: DataFrame, path, fmt="json", mode="errorifexists",
                        rows_per_file=0):
    """Training rows as JSONL shards (or parquet), one object per line.

    The rows are many times larger than their trajectories; `rows_per_file` bounds a file.
    """
    rows.write.mode(mode).option("maxRecordsPerFile", rows_per_file).format(fmt).save(path)


def pretty(value, kind, depth=0):
    """JSON text of a column of the given type, indented by four blanks a level; null is `null`."""
    pad, close = "\n" + "    " * (depth + 1), "\n" + "    " * depth
    if isinstance(kind, T.StructType):
        parts = []
        for k, f in enumerate(kind):
            parts += [F.lit(("," if k else "") + f'{pad}{json.dumps(f.name)}: '),
                      pretty(value.getField(f.name), f.dataType, depth + 1)]
        text = F.concat(F.lit("{"), *parts, F.lit(close + "}"))
    elif isinstance(kind, T.ArrayType):
        items = F.array_join(F.transform(
            value, lambda x: pretty(x, kind.elementType, depth + 1)), "," + pad)
        text = F.when(F.size(value) == 0, F.lit("[]")).otherwise(
            F.concat(F.lit("[" + pad), items, F.lit(close + "]")))
    else:
        listed = F.to_json(F.array(value))
        text = F.substring(listed, F.lit(2), F.length(listed) - 2)
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def write_training_arrays(rows: DataFrame, path, shard, order, mode="errorifexists"):
    """Training rows as indented JSON arrays, one file for each value of the column `shard`, in the
    given order of columns; `readers.read_training_rows(json_array=True)` reads them in parallel.
    A file is written by one task: choose shards of a size one task can write."""
    from pyspark.sql import Window
    kind = T.StructType([f for f in rows.schema if f.name != shard])
    record = F.struct(*[F.col(f"`{f.name}`") for f in kind])
    ordered = Window.partitionBy(shard).orderBy(*order)
    numbered = rows.select(shard, F.row_number().over(ordered).alias("_k"),
                           F.lead(F.lit(False), 1, True).over(ordered).alias("_last"),
                           pretty(record, kind, 1).alias("value"))
    text = F.concat(F.when(F.col("_k") == 1, F.lit("[\n    ")).otherwise(F.lit("    ")), "value",
                    F.when(F.col("_last"), F.lit("\n]")).otherwise(F.lit(",")))
    # The rows of a shard lie in one partition already, in order.
    (numbered.withColumn("value", text).sortWithinPartitions(shard, "_k")
     .select(shard, "value").write.mode(mode).partitionBy(shard).text(path))


def usage_slots(usage: DataFrame, rows_per_file, least_rows, cores):
    """{model: (first slot, slots)}: as many files for each model as its counted rows ask for, and
    tasks for all cores if files of `least_rows` allow it. The count reads no text."""
    counts, slots, first = usage.groupBy("model").count().collect(), {}, 0
    for model, n in sorted(counts, key=lambda r: (r[0] is not None, r[0])):
        own = max(-(-n // rows_per_file), min(-(-cores // len(counts)), -(-n // least_rows)), 1)
        slots[model], first = (first, own), first + own
    return slots


def write_usage(usage: DataFrame, path, mode="errorifexists", rebalance=True,
                rows_per_file=1_000_000, least_rows=10_000):
    """Per-conversation usage, one folder per model, so a reader of one model skips the rest.

    The rows of a model are dealt by hash into as many files as their number asks for, each written
    by a task of its own and none above `rows_per_file`; rows that agree in everything lie
    together. Without rebalancing every task writes a file per model.
    """
    rows = usage
    if rebalance:
        slots = usage_slots(usage, rows_per_file, least_rows,
                            usage.sparkSession.sparkContext.defaultParallelism)
        hashed = [f.name for f in usage.schema if not isinstance(f.dataType, T.MapType)]
        salt = F.xxhash64(*[F.col(f"`{c}`") for c in hashed])
        slot = F.lit(0)
        for model, (first, own) in slots.items():
            slot = F.when(F.col("model").eqNullSafe(F.lit(model)),
                          F.lit(first) + F.pmod(salt, F.lit(own))).otherwise(slot)
        total = sum(own for _, own in slots.values())
        rows = usage.repartitionById(max(total, 1), slot.cast("int"))
    (rows.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy("model")
     .parquet(path))


def result_documents(summary: DataFrame, input_file=None) -> DataFrame:
    """Flat summary as documents: model, model_config, input_file, totals, averages."""
    return summary.select(
        "model", F.struct(*S.CONFIG_FIELDS).alias("model_config"),
        F.lit(input_file).cast("string").alias("input_file"), "total_conversations",
        F.struct(*S.TOKEN_TOTALS, *S.COST_TOTALS).alias("totals"),
        F.struct(*S.AVERAGES).alias("averages"))


def write_result_documents(summary: DataFrame, path, input_file=None, mode="errorifexists"):
    """One JSON object per model; the summary has one row per model."""
    result_documents(summary, input_file).write.mode(mode).json(path)


def flat_usage_columns(usage: DataFrame, details=False) -> DataFrame:
    """Usage without nesting; image details become a JSON string on request."""
    plain = [c for c in usage.columns if c not in ("image_details", "pricing")]
    if details:
        plain.append(F.to_json("image_details").alias("image_details"))
    return usage.select(*plain, "pricing.input_cost", "pricing.output_cost",
                        "pricing.total_cost")


def write_usage_csv(usage: DataFrame, path, details=False, mode="errorifexists"):
    (flat_usage_columns(usage, details).write.mode(mode).option("header", True)
     .option("escape", '"').csv(path))
