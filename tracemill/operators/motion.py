"""Speed, acceleration, lag and distribution of motion signals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.operators.positions import shifted

LAG_STEPS = 8
JITTER_LIMIT = 0.03
STATIC_LIMIT = 0.01
BINS = 30


def motion_profile(signal: DataFrame, keys, columns, fps: float, position: str = "frame_index") -> DataFrame:
    """Speed and acceleration of each column: first and second difference times fps."""
    keys = list(keys)
    shifts = {f"_{c}_{k}": (c, -k) for c in columns for k in (1, 2)}
    out = shifted(signal, keys, position, shifts)
    rate = F.lit(float(fps))
    for c in columns:
        now, one, two = F.col(c), F.col(f"_{c}_1"), F.col(f"_{c}_2")
        out = out.withColumn(f"{c}_speed", (now - one) * rate).withColumn(
            f"{c}_acceleration", ((now - one) - (one - two)) * rate * rate
        )
    return out.drop(*shifts)


def tool_speed(profile: DataFrame, axes, name: str) -> DataFrame:
    """Length of the velocity vector over several axes of one arm."""
    total = reduce(lambda a, b: a + b, [F.col(f"{a}_speed") * F.col(f"{a}_speed") for a in axes])
    return profile.withColumn(name, F.sqrt(total))


def aligned(
    signal: DataFrame, keys, cmd: str = "cmd", state: str = "state", position: str = "frame_index",
    steps: int = LAG_STEPS, jitter: float = JITTER_LIMIT, static: float = STATIC_LIMIT,
) -> DataFrame:
    """Command next to the state ``steps`` frames later, with static and jitter flags.

    Static: the command moves less than ``static``. Jitter: not static and the
    aligned state is more than ``jitter`` away.
    """
    rows = shifted(signal, keys, position, {"aligned_state": (state, steps), "_before": (cmd, -1)})
    is_static = F.coalesce(F.abs(F.col(cmd) - F.col("_before")) < static, F.lit(False))
    off = F.coalesce(F.abs(F.col(cmd) - F.col("aligned_state")) > jitter, F.lit(False))
    return rows.withColumn("static", is_static).withColumn("jitter", ~is_static & off).drop("_before")


def jitter_rate(rows: DataFrame, keys) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if("static").alias("static_frames"),
        F.count_if("jitter").alias("jitter_frames"),
    ).withColumn("jitter_rate", F.col("jitter_frames") / F.col("frames"))


def signal_range(signal: DataFrame, keys, value: str) -> DataFrame:
    return signal.groupBy(*keys).agg(
        F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean")
    )


def bin_of(value: Column, low: Column, high: Column, bins: int = BINS) -> Column:
    """Bin of a value; the last bin includes its upper end, a flat signal has width 1."""
    raw = (high - low) / F.lit(float(bins))
    width = F.when(raw == 0, 1.0).otherwise(raw)
    return F.greatest(F.least(F.floor((value - low) / width), F.lit(bins - 1)), F.lit(0)).cast("bigint")


def histogram(signal: DataFrame, keys, value: str, bins: int = BINS) -> DataFrame:
    """Count per non-empty bin of the signal of each key."""
    keys = list(keys)
    rows = signal.filter(F.col(value).isNotNull())
    ranges = rows.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return (
        rows.select(*keys, value).join(ranges, keys)
        .groupBy(*keys, bin_of(F.col(value), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"), F.min("low").alias("low"), F.max("high").alias("high"))
    )


def _bin_of_place(rows: DataFrame, ranges: DataFrame, keys, value: str, bins: int) -> DataFrame:
    """Per key the bin between ``low`` and ``high`` that holds ``place``, as a narrower range."""
    inside = rows.join(ranges, keys).filter(F.col(value).between(F.col("low"), F.col("high")))
    counts = inside.groupBy(*keys, bin_of(F.col(value), F.col("low"), F.col("high"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("low"), F.max(value).alias("high"), F.min("place").alias("place"))
    earlier = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    return (
        counts.withColumn("_before", before)
        .filter((F.col("_before") <= F.col("place")) & (F.col("place") < F.col("_before") + F.col("_n")))
        .select(*keys, "low", "high", (F.col("place") - F.col("_before")).alias("place"))
    )


def upper_median(signal: DataFrame, keys, value: str, bins: int = 1024) -> DataFrame:
    """Value at place n // 2 of the sorted signal of each key.

    Twice the values are counted per bin, and only the bin that holds the place goes on;
    the distinct values of the last bin, about a millionth of them, are ordered. Nothing
    is written, and a long signal is never sorted.
    """
    keys = list(keys)
    rows = signal.filter(F.col(value).isNotNull()).select(*keys, value)
    ranges = rows.groupBy(*keys).agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.floor(F.count(F.lit(1)) / 2).alias("place"))
    for _ in range(2):
        ranges = _bin_of_place(rows, ranges, keys, value, bins)
    last = rows.join(ranges, keys).filter(F.col(value).between(F.col("low"), F.col("high"))).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n"), F.min("place").alias("place"))
    earlier = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    return (
        last.withColumn("_before", before)
        .filter((F.col("_before") <= F.col("place")) & (F.col("place") < F.col("_before") + F.col("_n")))
        .select(*keys, F.col(value).alias("median"))
    )
