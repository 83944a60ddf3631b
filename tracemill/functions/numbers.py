"""Durations, shares, frame ranges, hashes and version numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FPS = 30


def frames_to_hours(frames: Column, fps: int = FPS) -> Column:
    return frames / F.lit(float(fps)) / F.lit(3600.0)


def hms(frames: Column, fps: int = FPS) -> Column:
    """Duration as HH:MM:SS, each part rounded down."""
    seconds = F.floor(frames / F.lit(float(fps)))
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600),
        F.floor(seconds % 3600 / 60),
        seconds % 60,
    )


def minutes(frames: Column, fps: int = FPS) -> Column:
    return F.bround(frames / F.lit(float(fps)) / F.lit(60.0), 1)


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0 or absent."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def pct(ratio: Column) -> Column:
    """Whole percent, halves to the even neighbour."""
    return F.bround(ratio * F.lit(100.0), 0).cast("bigint")


def frames_of(ratio: Column, total: Column) -> Column:
    return (ratio * total).cast("bigint")


def first_frame(start_time: Column, fps: Column) -> Column:
    return F.floor(start_time * fps).cast("bigint")


def last_frame(end_time: Column, fps: Column) -> Column:
    """Last frame of an action; it belongs to the action."""
    return F.ceil(end_time * fps).cast("bigint")


def length_bucket(frames: Column) -> Column:
    """Episode length class, each class closed on the left."""
    return (
        F.when(frames < 900, "<900")
        .when(frames < 1100, "900-1100")
        .when(frames < 1300, "1100-1300")
        .when(frames < 1500, "1300-1500")
        .otherwise(">1500")
    )


def features_hash(features: Column) -> Column:
    """Key of a feature map that does not depend on entry order."""
    return F.sha2(F.to_json(F.array_sort(F.map_entries(features))), 256)


def hash32(*parts: Column) -> Column:
    """An evenly spread integer in [0, 2^32) that any engine can recompute."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("bigint")


def version_number(version: Column) -> Column:
    """n of ``vn``; null when the rest is not a number."""
    digits = F.regexp_extract(version, r"^v*(\d+)$", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def following_version(version: Column, step: Column | None = None) -> Column:
    """``v(n+1)``; a name that is no number gets ``.1`` appended. ``step`` counts further than 1."""
    step = F.lit(1) if step is None else step
    number = version_number(version)
    return F.when(
        number.isNotNull(), F.concat(F.lit("v"), (number + step).cast("string"))
    ).otherwise(F.concat(version, F.lit("."), step.cast("string")))
