"""Session settings the operators rely on, and the place for materialised steps."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Settings for large runs. Joins carry no broadcast hints: Spark broadcasts a
#: side only when its measured size is below the threshold, and splits skewed
#: partitions of every other join at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tracemill", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**RECOMMENDED, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tracemill-"))
    return context.getCheckpointDir()


#: Folders of steps written inside :func:`temporary_steps`.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written steps", default=None)


@contextmanager
def temporary_steps(spark: SparkSession):
    """Delete the steps written inside the block when it ends.

    Write the result inside the block: what reads a step later does not find it.
    """
    written: list[str] = []
    token = _WRITTEN.set(written)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        context = spark.sparkContext
        for path in written:
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def _new_step(spark: SparkSession) -> str:
    path = f"{shared_dir(spark)}/step-{uuid.uuid4().hex}"
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write a step to the shared folder and go on from the written table.

    The step runs once however often it is used, losing executors afterwards
    loses nothing, and Spark knows its size when it plans the joins.
    """
    path = _new_step(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by(df: DataFrame, key: str) -> str:
    """Write a step with a folder for each value of ``key``, for tasks that look one up; returns where it stands."""
    path = _new_step(df.sparkSession)
    df.repartition(key).write.partitionBy(key).parquet(path)
    return path


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done, which it does once the driver has forgotten their plans."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
