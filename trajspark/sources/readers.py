"""Readers with declared schemas."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from trajspark import schemas as S
from trajspark.functions.text import model_from_file
from trajspark.operators.compare import last_per_label
from trajspark.operators.quality import CORRUPT_COLUMN
from trajspark.sources.json_array import parse_pieces, read_pieces, record_end


def read_trajectories(spark: SparkSession, path, quarantine=False) -> DataFrame:
    """Trajectory JSONL. With `quarantine` unparsable lines stay, in `_corrupt_record`."""
    schema = S.TRAJECTORY + (f", {CORRUPT_COLUMN} string" if quarantine else "")
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(path))


def read_training_rows(spark: SparkSession, path, json_array=False, partitions=None,
                       quarantine=False) -> DataFrame:
    """Training rows from sharded JSONL, or from JSON arrays, with a `conversation_id`.

    Rows written elsewhere have no task_id and prefix_len; the id is unique for any input and
    follows the order of a single file (`sequences.dense_ids` makes positions of it). An indented
    array is cut between its records into as many tasks as its size asks for; one on a single line
    is read by one task and its rows are spread out again. Arrays of other files at `path` may be
    laid out otherwise, at the price of one task a file. A file that was cut off right after a
    record cannot be told from a whole one.

    A broken line or record fails the read. With `quarantine` it stays, in `_corrupt_record`; the
    jobs leave it out, and `quality.split_readable` tells both apart.
    """
    numbered = F.monotonically_increasing_id()
    end = json_array and record_end(spark, path)
    if end:
        rows = parse_pieces(read_pieces(spark, path, end), S.TRAINING_ROW,
                            CORRUPT_COLUMN if quarantine else None)
        rows = rows.withColumn("conversation_id", numbered)
        return rows.repartition(partitions) if partitions else rows
    schema = S.TRAINING_ROW + (f", {CORRUPT_COLUMN} string" if quarantine else "")
    reader = (spark.read.schema(schema).option("multiLine", json_array)
              .option("mode", "PERMISSIVE" if quarantine else "FAILFAST")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    rows = reader.json(path).withColumn("conversation_id", numbered)
    if not json_array:
        return rows
    return rows.repartition(partitions) if partitions else rows.repartition("conversation_id")


def flat_results(results: DataFrame, *extra) -> DataFrame:
    return results.select(
        "model", *[F.col("model_config")[c].alias(c) for c in S.CONFIG_FIELDS],
        "total_conversations", *[F.col("totals")[c].alias(c)
                                 for c in S.TOKEN_TOTALS + S.COST_TOTALS],
        *[F.col("averages")[c].alias(c) for c in S.AVERAGES], *extra)


def _raw_results(spark, path):
    return (spark.read.schema(f"{S.RESULT_SET}, {CORRUPT_COLUMN} string")
            .option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .json(path))


def _problem():
    broken = F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("unreadable"))
    return broken.when(F.col("totals").isNull() | F.col("averages").isNull()
                       | F.col("model_config").isNull() | F.col("total_conversations").isNull(),
                       F.lit("incomplete"))


def read_result_set(spark: SparkSession, path) -> DataFrame:
    """Summary part of one result document; its per-conversation array is never parsed."""
    return flat_results(_raw_results(spark, path))


def read_result_sets(spark: SparkSession, paths):
    """(results, skipped) from {label: path} or [(label, path)]; a later label replaces an
    earlier one. Missing, unreadable and incomplete documents are listed in `skipped`; it is
    an error if no path can be opened at all. One small read per named document.
    """
    pairs = list(paths.items()) if isinstance(paths, dict) else list(paths)
    found, absent = None, []
    for place, (label, path) in enumerate(pairs):
        try:
            one = _raw_results(spark, path)
        except AnalysisException:
            absent.append((label, path, "not found"))
            continue
        one = (one.withColumn("model", F.lit(label)).withColumn("path", F.lit(path))
               .withColumn("input_ord", F.lit(place).cast("long")).withColumn("reason", _problem()))
        found = one if found is None else found.unionByName(one)
    if found is None:
        raise FileNotFoundError(f"no valid result sets in {[p for _, p in pairs]}")
    skipped = found.filter(F.col("reason").isNotNull()).select("model", "path", "reason")
    if absent:
        skipped = skipped.unionByName(spark.createDataFrame(
            absent, "model string, path string, reason string"))
    return last_per_label(flat_results(found.filter(F.col("reason").isNull()), "input_ord")), skipped


def discover_result_sets(spark: SparkSession, folder, pattern="*_tokens*.json"):
    """(results, skipped) of all result documents of a folder. The label is the `model` field,
    else the file name; a repeated label keeps the document that comes last by file name.

    `input_ord` follows the file names. Unreadable and incomplete documents are in `skipped`.
    """
    raw = _raw_results(spark, f"{folder.rstrip('/')}/{pattern}")
    found = raw.select("*", F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_name").alias("_file"), _problem().alias("reason"))
    found = found.withColumn("model", F.coalesce("model", model_from_file(F.col("path"))))
    skipped = found.filter(F.col("reason").isNotNull()).select("model", "path", "reason")
    results = flat_results(found.filter(F.col("reason").isNull()), F.col("_file").alias("input_ord"))
    return last_per_label(results), skipped
