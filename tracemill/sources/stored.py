"""Frames kept as a bucketed table, so that joins by episode never move them.

A table of frames that is written once and joined many times is stored in buckets by (dataset,
recording_id), sorted by episode and frame inside a bucket. Joins and counts by episode then read
a bucket per task: the small side is dealt to the buckets, or broadcast if Spark measures it as
small, and the frames stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.operators.relabel import EPISODE

#: Frames that a bucket should hold on average.
PER_BUCKET = 4_000_000


def bucket_count(rows: int, per_bucket: int = PER_BUCKET) -> int:
    """The power of two that keeps buckets near ``per_bucket`` rows; powers of two join with each other."""
    wanted = max(1, -(-rows // per_bucket))
    return 1 << (wanted - 1).bit_length()


def store_frames(frames: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``frames`` as the bucketed table ``name``, in ``path`` or in the warehouse, and read it back.

    One shuffle, by the bucket; an episode lies in one bucket, as it lies in one file.
    """
    spark = frames.sparkSession
    dealt = frames.repartition(buckets, *[F.col(c) for c in EPISODE])
    order = [*EPISODE, *[c for c in ("frame_index",) if c in frames.columns]]
    writer = dealt.write.bucketBy(buckets, *EPISODE).sortBy(*order).mode("errorifexists").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return stored_frames(spark, name)


def stored_frames(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
