"""Queries that write the library's own files to the shared folder and read them back."""

from pyspark.sql import functions as F

from checks import views as V
from trajspark.operators import expand as P
from trajspark.plans import jobs as J
from trajspark.sinks import writers as W
from trajspark.sources import readers as R
from trajspark.sources.lineage import new_folder


def _rows(s, d):
    return P.training_rows(V.trajectories(s, d), keep=()).withColumn(
        "task_id", F.col("task_id").cast("string"))


def _messages(rows):
    return P.message_rows(rows.withColumn("task_id", F.col("task_id").cast("long")))


def _tables(s, d):
    return V.tasks(s, d), V.steps(s, d), V.image_dims(s, d)


def written_training_rows(s, d):
    """JSONL shards."""
    path = new_folder(s, "rows")
    W.write_training_rows(_rows(s, d), path, rows_per_file=100_000)
    return _messages(R.read_training_rows(s, path))


def array_training_rows(s, d):
    """Indented JSON arrays of a hundred tasks each, read in pieces."""
    path = new_folder(s, "arrays")
    shard = F.floor(F.col("task_id").cast("long") / 100)
    W.write_training_arrays(_rows(s, d).withColumn("shard", shard), path, "shard",
                            [F.col("task_id").cast("long"), "prefix_len"])
    return _messages(R.read_training_rows(s, f"{path}/*", json_array=True))


def written_usage(s, d):
    """Parquet, one folder per model."""
    path = new_folder(s, "usage")
    W.write_usage(J.step_usage(*_tables(s, d), details=False), path)
    return W.flat_usage_columns(s.read.parquet(path))


def written_usage_csv(s, d):
    path = new_folder(s, "csv")
    usage = J.step_usage(*_tables(s, d), details=False)
    W.write_usage_csv(usage, path)
    schema = W.flat_usage_columns(usage).schema
    return s.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def discovered_result_sets(s, d):
    """One result document a file, found again by pattern and labelled by its model."""
    path = new_folder(s, "results")
    documents = W.result_documents(J.step_totals(*_tables(s, d)))
    documents.write.option("maxRecordsPerFile", 1).json(path)
    found, _ = R.discover_result_sets(s, path, "part-*.json")
    return found.select("model", "total_conversations", "total_text_tokens",
                        "total_image_tokens", "total_images", "total_cost")


QUERIES = {f.__name__: f for f in (written_training_rows, array_training_rows, written_usage,
                                   written_usage_csv, discovered_result_sets)}
