"""Helpers that several operators share."""

import uuid

from pyspark.sql import DataFrame, functions as F

SPACES = r"[\x20\x09-\x0D]+"          # what parts words, as a pattern of Spark's


def shared_folder(spark):
    """The folder that driver and executors share: `spark.checkpoint.dir`, or, where a session
    does not name one, a folder in its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def cut(frame: DataFrame) -> DataFrame:
    """Eager reliable checkpoint in the shared folder, for narrow rows."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def stored(frame: DataFrame) -> DataFrame:
    """The rows, written as a table in the shared folder and read again; compressed, so better
    than a checkpoint for wide rows. The folder's owner clears old tables."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def numbered(docs: DataFrame, name="_row") -> DataFrame:
    """Adds a number of its own to every row, repeated rows too. It depends on how the input is
    split, so cut or store the result before it is used more than once."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def free_name(frame: DataFrame, name):
    """`name`, or with underscores before it until the frame has no such column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value, body):
    """`body` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def broadcast_if_small(frame: DataFrame, row_bytes, limit=32 << 20, entries=None,
                       entry_bytes=0) -> DataFrame:
    """A broadcast of a stored or checkpointed frame whose counted rows, and counted entries of
    its array column `entries`, stay under `limit` bytes; above it the plain frame, which Spark
    joins by a shuffle with the same rows."""
    held = F.greatest(F.size(entries), F.lit(0)) if entries else F.lit(0)
    count = frame.agg(F.count("*").alias("n"), F.coalesce(F.sum(held), F.lit(0)).alias("m")).first()
    return F.broadcast(frame) if count.n * row_bytes + count.m * entry_bytes <= limit else frame
