"""A bitmap index of recordings by tag.

For each tag and each range of 32,768 recording ids one bitmap of 4 KiB says which recordings have the
tag. *Any* of several tags is the OR of their bitmaps, *all* is the AND, and a tag's count is the number
of its bits, so none of these reads the tags of the recordings again. The index is much smaller than
the recordings; a recording is looked up by the bitmap of its own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_index(recordings: DataFrame, tags: str = "tags", key: str = "recording_id") -> DataFrame:
    """(tag, bucket, bits) from an array column; null ids have no place in it."""
    rows = recordings.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.explode(tags).alias("tag"))
    return rows.groupBy("tag", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits"))


def any_of(index: DataFrame, tags) -> DataFrame:
    """(bucket, bits): recordings with at least one of the tags."""
    return index.filter(F.col("tag").isin(list(tags))).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def all_of(index: DataFrame, tags) -> DataFrame:
    """(bucket, bits): recordings with every one of the tags. Ranges that lack one of them drop out."""
    wanted = sorted(set(tags))
    found = index.filter(F.col("tag").isin(wanted)).groupBy("bucket").agg(
        F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    return found.filter((F.col("n") == len(wanted)) & (F.bitmap_count("bits") > 0)).select("bucket", "bits")


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def having(recordings: DataFrame, chosen: DataFrame, key: str = "recording_id") -> DataFrame:
    """The recordings whose bit is set in ``chosen``; ranges without any bit drop out in the join."""
    bits = chosen.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    joined = recordings.withColumn("_bucket", F.bitmap_bucket_number(key)).join(bits, "_bucket")
    return joined.filter(_is_set(F.col("_bits"), F.bitmap_bit_position(key))).drop("_bucket", "_bits")


def tag_totals(index: DataFrame) -> DataFrame:
    """Recordings of each tag, counted on the bitmaps; a tag given twice to one recording counts once."""
    return index.groupBy("tag").agg(F.sum(F.bitmap_count("bits")).alias("episodes"))
