"""Shared storage for intermediate results that a job must not lose."""

from __future__ import annotations

import gc
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a folder of the warehouse where that isn't set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.scratch"


def session_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/tallylake/{spark.sparkContext.applicationId}"


_owner: ContextVar[str | None] = ContextVar("owner", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{_owner.get() or session_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and continue from the written files.

    Cuts the lineage, survives the loss of executors, and gives the planner the
    real size of the data, so that its own broadcast threshold decides joins.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(staged: DataFrame) -> None:
    """Delete what ``stage`` has written for a frame; it, and what is made from it, can't be used any more."""
    for folder in {path.rpartition("/")[0] for path in staged.inputFiles()}:
        delete(staged.sparkSession, folder)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Its cleaner does so when the driver's JVM collects garbage, by default every half hour; a job that
    shuffles much in several steps would hold the files of all steps until then. The latest plan run is still referred to.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Delete everything this application has staged; frames that read it can't be used any more."""
    delete(spark, session_dir(spark))


@contextmanager
def owned(spark: SparkSession):
    """What is staged inside is deleted on leaving; for a load whose results lie elsewhere."""
    folder = f"{session_dir(spark)}/owned-{uuid.uuid4().hex}"
    token = _owner.set(folder)
    try:
        yield folder
    finally:
        _owner.reset(token)
        delete(spark, folder)
