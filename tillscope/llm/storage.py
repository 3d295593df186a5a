"""Shared storage for intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point Spark at the shared folder the cluster names.

    A folder of this machine is made only where none is named and the session is a local one,
    as in tests; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoints-")
    context.setCheckpointDir(folder)


def checkpointed(frame: DataFrame) -> DataFrame:
    """``frame`` computed once and kept in the shared folder, safe from lost executors."""
    use_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def compact(frame: DataFrame) -> DataFrame:
    """``frame`` in as many partitions as the cluster has cores, for tables of narrow rows.

    A shuffle writes files for every task before it; few bytes need no more tasks than cores.
    """
    return frame.coalesce(max(2, frame.sparkSession.sparkContext.defaultParallelism))


def free_name(frame: DataFrame, stem: str) -> str:
    """A column name that ``frame`` has not got, whatever the case of its letters."""
    taken = {name.lower() for name in frame.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as Parquet to a new place in the shared folder, and read again."""
    spark = frame.sparkSession
    use_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(place)
    return spark.read.parquet(place)
