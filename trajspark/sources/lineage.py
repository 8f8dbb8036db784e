"""Reliable checkpoints and files in the folder the cluster names."""

import uuid

from pyspark.sql import DataFrame


def shared_folder(spark):
    """The folder that driver and executors share: `spark.checkpoint.dir`, or, where a session does
    not name one, a folder in its warehouse. A warehouse on the local disk is shared in local mode
    only and refused otherwise."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = spark.sparkContext.master.startswith("local")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    on_disk = warehouse.startswith("file:") or ("://" not in warehouse and default.startswith("file:"))
    if on_disk and not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_checkpoints"


def new_folder(spark, name):
    """A path of its own in the shared folder; whoever owns the folder clears old ones."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Eager reliable checkpoint; survives the loss of executors."""
    spark = frame.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return frame.checkpoint()
