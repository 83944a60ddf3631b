"""Selecting and summarising lake recordings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.numbers import frames_to_hours, minutes
from tracemill.operators.positions import nth_smallest, sorted_position


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def tag_filter(tags: Column, wanted, mode: str = "any") -> Column:
    """Rows with at least one (``any``) or every (``all``) wanted tag."""
    if mode == "any":
        return F.arrays_overlap(tags, F.array(*[F.lit(t) for t in wanted]))
    if mode == "all":
        return _all(F.array_contains(tags, t) for t in wanted)
    raise ValueError(f"tag mode {mode!r} is neither 'any' nor 'all'")


def day_range(at: Column, first: str | None = None, last: str | None = None) -> Column:
    """Days from first to last, both included.

    Written as bounds on the timestamp itself so that the scan can skip data.
    """
    conditions = []
    if first:
        conditions.append(at >= F.lit(first).cast("date"))
    if last:
        conditions.append(at < F.date_add(F.lit(last).cast("date"), 1))
    return _all(conditions)


def time_range(at: Column, from_time=None, to_time=None, from_date=None, to_date=None) -> Column:
    """An exact timestamp wins over a date at each end; a last date counts whole."""
    conditions = []
    if from_time or from_date:
        conditions.append(at >= F.lit(from_time or from_date).cast("timestamp_ntz"))
    if to_time:
        conditions.append(at <= F.lit(to_time).cast("timestamp_ntz"))
    elif to_date:
        conditions.append(at < F.date_add(F.lit(to_date).cast("date"), 1))
    return _all(conditions)


def query_recordings(
    recordings: DataFrame, *, tasks=None, tags=None, tag_mode="any", device=None,
    operators=None, types=None, qas=None, first_day=None, last_day=None,
) -> DataFrame:
    """All given filters together; a filter that is empty or None is off."""
    conditions = []
    if tasks:
        conditions.append(F.col("task").isin(list(tasks)))
    if tags:
        conditions.append(tag_filter(F.col("tags"), tags, tag_mode))
    if device:
        conditions.append(F.col("device") == device)
    if operators:
        conditions.append(F.col("operator").isin(list(operators)))
    if types:
        conditions.append(F.col("type").isin(list(types)))
    if qas:
        conditions.append(F.col("qa").isin(list(qas)))
    if first_day or last_day:
        conditions.append(day_range(F.col("collected_at"), first_day, last_day))
    return recordings.filter(_all(conditions))


def numeric_and_recent(
    recordings: DataFrame, *, min_frames=None, as_of=None, days=None, task=None, device=None,
    operator=None, qa=None,
) -> DataFrame:
    """frames > n, collected within ``days`` before ``as_of``, plain equalities."""
    conditions = []
    if min_frames is not None:
        conditions.append(F.col("frames") > min_frames)
    if days is not None:
        start = F.date_sub(F.lit(as_of).cast("date") if as_of else F.current_date(), days)
        conditions.append(F.col("collected_at") >= start)
    for name, value in (("task", task), ("device", device), ("operator", operator), ("qa", qa)):
        if value is not None:
            conditions.append(F.col(name) == value)
    return recordings.filter(_all(conditions))


def export_selection(
    recordings: DataFrame, *, collections=None, tasks=None, devices=None, operators=None,
    annotated_only=False, invalid_only=False, include_unchecked=False, passed=("pass",),
    **times,
) -> DataFrame:
    """Recordings an export takes. By default only those that passed the check.

    ``include_unchecked`` adds unchecked recordings that are not marked as a
    collection mistake; ``invalid_only`` turns the choice round.
    """
    checked = F.coalesce(F.col("qa").isin(list(passed)), F.lit(False))
    if invalid_only:
        keep = ~checked & F.col("qa").isNotNull()
    elif include_unchecked:
        keep = checked | (F.col("qa").isNull() & ~F.coalesce(F.col("mistake"), F.lit(False)))
    else:
        keep = checked
    conditions = [keep]
    for name, values in (("collection_id", collections), ("task", tasks),
                         ("device", devices), ("operator", operators)):
        if values:
            conditions.append(F.col(name).isin(list(values)))
    if annotated_only:
        conditions.append(F.col("annotated"))
    conditions.append(time_range(F.col("collected_at"), **times))
    return recordings.filter(_all(conditions))


def recording_limit(recordings: DataFrame, n: int) -> DataFrame:
    """The first n recordings by id; of rows that share the last id taken, any."""
    last, before = nth_smallest(recordings, "recording_id", n)
    if last is None:
        return recordings if n > 0 else recordings.limit(0)
    at_end = recordings.filter(F.col("recording_id") == last).limit(n - before)
    return recordings.filter(F.col("recording_id") < last).unionByName(at_end)


def newest_first(df: DataFrame, at: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(at), F.asc(tie))


def page(df: DataFrame, number: int, at: str, tie: str, size: int = 20) -> DataFrame:
    """One page (from 0) of the newest-first result."""
    return newest_first(df, at, tie).offset(number * size).limit(size)


def with_page(df: DataFrame, at: str, tie: str, size: int = 20) -> DataFrame:
    """Every row of the result with the page it stands on."""
    placed = sorted_position(df, [], [F.desc(at), F.asc(tie)], "place")
    return placed.withColumn("page", F.floor(F.col("place") / size).cast("bigint"))


def _key_at(df: DataFrame, at: str, tie: str, place: int):
    """The composite key (time, tie) of the row at a place from 1, newest first; null beyond the last row."""
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    falling, before = nth_smallest(df.select((-micros).alias("key")), "key", place)
    if falling is None:
        return None
    same = df.filter(F.col(at) == F.timestamp_micros(F.lit(-falling)).cast(df.schema[at].dataType))
    return -falling, nth_smallest(same.select(tie), tie, place - before)[0]


def keyset_page(df: DataFrame, number: int, at: str, tie: str, size: int = 20) -> DataFrame:
    """One page (from 0) of the newest-first result, as a range of the composite key (time, tie).

    The keys of its first and last row are found by counting rows per bin of time, and of the tie where many
    rows share one time, so the last page costs what the first one does: nothing is sorted but the page
    itself, and its time range reaches the scan. ``tie`` is a unique integer; rows without a time are on
    no page. Starts a few jobs, each of which brings bounded counts to the driver.
    """
    first = _key_at(df, at, tie, number * size + 1)
    if first is None:
        return df.limit(0)
    last = _key_at(df, at, tie, (number + 1) * size)
    kind = df.schema[at].dataType

    def moment(key):
        return F.timestamp_micros(F.lit(key[0])).cast(kind)

    inside = (F.col(at) < moment(first)) | ((F.col(at) == moment(first)) & (F.col(tie) >= first[1]))
    kept = df.filter((F.col(at) <= moment(first)) & inside)
    if last is not None:
        kept = kept.filter((F.col(at) >= moment(last)) & ((F.col(at) > moment(last)) | (F.col(tie) <= last[1])))
    # at most one page is left, or the rest of the last one
    return newest_first(kept, at, tie).limit(size)


def latest_annotation(annotations: DataFrame, keys, version: str, pinned=None) -> DataFrame:
    """The newest annotation per recording, or the pinned version where given.

    An aggregate, not a window: partial results shrink each recording to one row
    before the shuffle.
    """
    rows = annotations if pinned is None else annotations.filter(F.col(version) == pinned)
    others = [c for c in annotations.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(version)).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in others])


def facet_counts(recordings: DataFrame, by: str) -> DataFrame:
    return recordings.groupBy(by).agg(F.count(F.lit(1)).alias("episodes"))


def tag_counts(recordings: DataFrame, tags: str = "tags") -> DataFrame:
    """Episodes per tag; tags nobody carries do not appear."""
    return (
        recordings.select(F.explode(F.array_distinct(tags)).alias("tag"))
        .groupBy("tag").agg(F.count(F.lit(1)).alias("episodes"))
    )


def scope_summary(recordings: DataFrame, fps: int = 30) -> DataFrame:
    """One row: size of a selection, its duration and its check results."""
    return recordings.agg(
        F.count(F.lit(1)).alias("episodes"),
        F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"),
        F.count_if(F.col("qa") == "pass").alias("n_pass"),
        F.count_if(F.col("qa") == "warn").alias("n_warn"),
        F.count_if(F.col("qa") == "fail").alias("n_fail"),
    ).withColumn("minutes", minutes(F.col("frames"), fps)).withColumn(
        "hours", frames_to_hours(F.col("frames"), fps)
    )


def scope_values(recordings: DataFrame) -> DataFrame:
    """The collections, tasks and tags of a selection, one sorted row per value."""
    kinds = F.array(
        F.struct(F.lit("collection").alias("kind"), F.col("collection_id").cast("string").alias("value")),
        F.struct(F.lit("task").alias("kind"), F.col("task").alias("value")),
    )
    tagged = F.transform("tags", lambda t: F.struct(F.lit("tag").alias("kind"), t.alias("value")))
    return (
        recordings.select(F.explode(F.concat(kinds, tagged)).alias("v"))
        .select("v.kind", "v.value").distinct().orderBy("kind", "value")
    )
