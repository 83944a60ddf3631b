"""Data checks and the doctor report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.functions.text import contains_chinese, find_chinese
from tracemill.operators.positions import shifted
from tracemill.operators.relabel import EPISODE

# Files every dataset must have.
REQUIRED_FILES = ("dataset.json", "meta/info.json", "meta/tasks.jsonl", "meta/episodes.jsonl", "meta/episodes_stats.jsonl")

# Severity of a check result, and the verdict it leads to.
SEVERITY = {"pass": 0, "warn": 1, "fail": 2}
VERDICT = {"pass": "may train", "warn": "partly failing", "fail": "must fix"}

# Percentage shown for a rule that gives no count.
PCT_WITHOUT_COUNT = {"fail": 82, "warn": 96}


def frame_integrity(manifest: DataFrame, episodes: DataFrame, frames: DataFrame) -> DataFrame:
    """Metadata frame count against data rows, per dataset of the manifest.

    ``skipped`` without episode metadata, else ``ok`` or ``problem``.
    """
    meta = episodes.groupBy("dataset").agg(F.sum("length").alias("meta_frames"))
    data = frames.groupBy("dataset").agg(F.count(F.lit(1)).alias("data_frames"))
    rows = manifest.select("dataset").join(meta, "dataset", "left").join(data, "dataset", "left")
    found = F.coalesce("data_frames", F.lit(0))
    status = F.when(F.col("meta_frames").isNull(), "skipped").when(
        F.col("meta_frames") == found, "ok").otherwise("problem")
    return rows.withColumn("data_frames", found).withColumn("status", status)


def episode_lengths(episodes: DataFrame, frames: DataFrame) -> DataFrame:
    """Recorded against actual length of every episode that has frames."""
    actual = frames.groupBy(*EPISODE).agg(F.count(F.lit(1)).alias("actual"))
    return episodes.select(*EPISODE, "length").join(actual, list(EPISODE)).withColumn(
        "matches", F.col("actual") == F.col("length")
    )


def length_mismatches(episodes: DataFrame, frames: DataFrame) -> DataFrame:
    return episode_lengths(episodes, frames).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("episodes"), F.count_if(~F.col("matches")).alias("mismatches")
    )


def file_count_check(episodes: DataFrame, frames: DataFrame) -> DataFrame:
    """Episodes with data against metadata rows; a difference is a failure."""
    files = frames.select(*EPISODE).distinct().groupBy("dataset").agg(F.count(F.lit(1)).alias("files"))
    rows = episodes.groupBy("dataset").agg(F.count(F.lit(1)).alias("metadata_rows"))
    return rows.join(files, "dataset", "full").fillna(0, ["files", "metadata_rows"]).withColumn(
        "ok", F.col("files") == F.col("metadata_rows")
    )


def chinese_tasks(tasks: DataFrame) -> DataFrame:
    """Task lines with Chinese text: dataset, line, task_index, task, its runs."""
    return tasks.filter(contains_chinese(F.col("task"))).withColumn("chinese", find_chinese(F.col("task")))


def parse_task_lines(lines: DataFrame) -> DataFrame:
    """Task rows from (dataset, line, value); blank and malformed lines drop out."""
    parsed = F.from_json("value", "task_index bigint, task string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    broken = F.expr("try_parse_json(value)").isNull()
    return (
        lines.filter((F.trim("value") != "") & ~broken)
        .withColumn("_t", parsed)
        .select("dataset", "line", "_t.task_index", F.coalesce("_t.task", F.lit("")).alias("task"))
    )


def unreadable_datasets(lines: DataFrame) -> DataFrame:
    """Datasets with a line that is no valid UTF-8."""
    broken = lines.groupBy("dataset").agg(F.count_if(~F.is_valid_utf8("value")).alias("broken"))
    return broken.filter(F.col("broken") > 0).select("dataset")


def chinese_report(manifest: DataFrame, tasks: DataFrame, unreadable: DataFrame | None = None) -> DataFrame:
    """Per dataset ``has_chinese``, ``no_chinese``, ``not_found`` or ``error``, with the count."""
    found = tasks.groupBy("dataset").agg(F.count_if(contains_chinese(F.col("task"))).alias("chinese_tasks"))
    rows = manifest.select("dataset").join(found, "dataset", "left")
    status = F.when(F.col("chinese_tasks").isNull(), "not_found").when(
        F.col("chinese_tasks") > 0, "has_chinese").otherwise("no_chinese")
    if unreadable is not None:
        rows = rows.join(unreadable.select("dataset", F.lit(True).alias("_broken")), "dataset", "left")
        status = F.when(F.col("_broken"), "error").otherwise(status)
    return rows.withColumn("status", status).drop("_broken").fillna(0, ["chinese_tasks"])


def chinese_summary(report: DataFrame) -> DataFrame:
    """One row with the counts of the report and whether it passes."""
    return report.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("no_chinese", "has_chinese", "not_found", "error")],
    ).withColumn("passed", F.col("has_chinese") == 0)


def first_offenders(offending: DataFrame, n: int = 3) -> DataFrame:
    """The first n offending lines per dataset and how many more there are.

    Spark keeps only n rows per dataset and task before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("dataset").orderBy("line"))
    first = offending.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= n)
    counts = offending.groupBy("dataset").agg(F.count(F.lit(1)).alias("_n"))
    return first.join(counts, "dataset").withColumn(
        "more", F.greatest(F.col("_n") - n, F.lit(0)).cast("bigint")
    ).drop("_n")


def missing_files(datasets: DataFrame, files: DataFrame, required=REQUIRED_FILES) -> DataFrame:
    """(dataset, path) for every required file that is absent."""
    wanted = datasets.select("dataset", F.explode(F.array(*[F.lit(p) for p in required])).alias("path"))
    return wanted.join(files.select("dataset", "path"), ["dataset", "path"], "left_anti")


def missing_fields(rows: DataFrame, required) -> DataFrame:
    """Per dataset and required field the number of rows where it is null."""
    counts = rows.groupBy("dataset").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("missing")) for c in required])
    return counts.select("dataset", F.explode(entries).alias("e")).select("dataset", "e.*")


def time_steps(frames: DataFrame, keys, position: str, seconds: str, fps: Column | float) -> DataFrame:
    """Per episode: time stamps that do not rise, and jumps above 1.5 frames."""
    step = F.col(seconds) - F.col("_previous")
    return (
        shifted(frames, keys, position, {"_previous": (seconds, -1)})
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("frames"),
            F.count_if(step <= 0).alias("not_rising"),
            F.count_if(step > F.lit(1.5) / fps).alias("jumps"),
        )
    )


def frozen_dimensions(vectors: DataFrame, keys, vector: str, exempt=(), limit: float = 1e-6) -> DataFrame:
    """Spread of every dimension per group, and whether it never moves."""
    values = vectors.select(*keys, F.posexplode(vector).alias("dim", "value"))
    spread = values.groupBy(*keys, "dim").agg(F.stddev_pop(F.col("value").cast("double")).alias("spread"))
    exempted = F.col("dim").isin([int(d) for d in exempt]) if exempt else F.lit(False)
    return spread.withColumn("frozen", (F.col("spread") < limit) & ~exempted)


def camera_resolution(features: DataFrame, height: int = 240, width: int = 320) -> DataFrame:
    """Per dataset: distinct camera sizes, and whether all equal the expected one.

    ``features`` is (dataset, camera, height, width).
    """
    return features.groupBy("dataset").agg(
        F.count_distinct("height", "width").alias("sizes"),
        F.count_if((F.col("height") != height) | (F.col("width") != width)).alias("unexpected"),
    ).withColumn("ok", (F.col("sizes") == 1) & (F.col("unexpected") == 0))


def rule_pct(status: Column, bad: Column, n: Column) -> Column:
    """Percentage of good episodes; a fixed one where no count is known."""
    known = F.greatest(F.lit(0.0), F.bround((n - bad) / F.greatest(n, F.lit(1)) * 100.0, 0))
    fallback = F.when(status == "fail", float(PCT_WITHOUT_COUNT["fail"])).otherwise(float(PCT_WITHOUT_COUNT["warn"]))
    return F.when(status == "pass", 100.0).when(bad.isNotNull(), known).otherwise(fallback).cast("bigint")


def pct_colour(value: Column) -> Column:
    return F.when(value >= 99, "ok").when(value >= 85, "warn").otherwise("bad")


def doctor_report(checks: DataFrame) -> DataFrame:
    """Percentage and colour per rule. ``checks`` is (dataset, rule, status, bad, n)."""
    pct = rule_pct(F.col("status"), F.col("bad"), F.col("n"))
    return checks.withColumn("pct", pct).withColumn("colour", pct_colour(F.col("pct")))


def doctor_verdict(checks: DataFrame) -> DataFrame:
    """Worst status per dataset and what follows from it."""
    order = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    words = F.create_map(*[F.lit(x) for kv in VERDICT.items() for x in kv])
    return (
        checks.groupBy("dataset")
        .agg(F.max_by("status", F.element_at(order, F.col("status"))).alias("status"))
        .withColumn("verdict", F.element_at(words, F.col("status")))
    )


def _rule(rows: DataFrame, name: str, otherwise: str) -> DataFrame:
    """(dataset, rule, status, bad, n) from rows with ``bad`` and ``n``."""
    status = F.when(F.col("bad") == 0, "pass").otherwise(otherwise)
    return rows.select("dataset", F.lit(name).alias("rule"), status.alias("status"),
                       F.col("bad").cast("bigint").alias("bad"), F.col("n").cast("bigint").alias("n"))


def sensor_checks(
    manifest: DataFrame, *, files: DataFrame | None = None, stamps: DataFrame | None = None,
    vectors: DataFrame | None = None, cameras: DataFrame | None = None, exempt=(), required=REQUIRED_FILES,
) -> DataFrame:
    """The rules on files and sensor data, for the tables that are given.

    ``files`` is (dataset, path); ``stamps`` (dataset, recording_id, frame_index, seconds, fps);
    ``vectors`` (dataset, vector); ``cameras`` (dataset, camera, height, width).
    """
    found = []
    if files is not None:
        absent = missing_files(manifest.select("dataset"), files, required).groupBy("dataset").agg(F.count(F.lit(1)).alias("bad"))
        found.append(_rule(manifest.select("dataset").join(absent, "dataset", "left").fillna(0, ["bad"]).withColumn(
            "n", F.lit(len(required))), "required_files", "fail"))
    if stamps is not None:
        steps = time_steps(stamps, ["dataset", "recording_id"], "frame_index", "seconds", F.col("fps"))
        found.append(_rule(steps.groupBy("dataset").agg(
            F.count_if((F.col("not_rising") > 0) | (F.col("jumps") > 0)).alias("bad"), F.count(F.lit(1)).alias("n")),
            "time_steps", "warn"))
    if vectors is not None:
        found.append(_rule(frozen_dimensions(vectors, ["dataset"], "vector", exempt).groupBy("dataset").agg(
            F.count_if(F.col("frozen")).alias("bad"), F.count(F.lit(1)).alias("n")), "frozen_action", "warn"))
    if cameras is not None:
        sizes = camera_resolution(cameras).select("dataset", "unexpected", "ok")
        counts = cameras.groupBy("dataset").agg(F.count(F.lit(1)).alias("n")).join(sizes, "dataset")
        found.append(_rule(counts.withColumn(
            "bad", F.when(F.col("ok"), 0).otherwise(F.greatest("unexpected", F.lit(1)))), "camera_resolution", "fail"))
    if not found:
        raise ValueError("no table to check")
    return reduce(DataFrame.unionByName, found)


def doctor_checks(
    manifest: DataFrame, episodes: DataFrame, frames: DataFrame, tasks: DataFrame, sensors: DataFrame | None = None,
) -> DataFrame:
    """All rules as (dataset, rule, status, bad, n); ``sensors`` are the rows of :func:`sensor_checks`."""
    counts = episode_lengths(episodes, frames).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("matches")).alias("bad")
    )
    lengths = manifest.select("dataset").join(counts, "dataset", "left").fillna(0, ["n", "bad"]).select(
        "dataset", F.lit("frame_integrity").alias("rule"),
        F.when(F.col("bad") == 0, "pass").otherwise("warn").alias("status"), "bad", "n",
    )
    files = file_count_check(episodes, frames).select(
        "dataset", F.lit("file_count").alias("rule"),
        F.when(F.col("ok"), "pass").otherwise("fail").alias("status"),
        F.abs(F.col("files") - F.col("metadata_rows")).alias("bad"),
        F.col("metadata_rows").alias("n"),
    )
    text = chinese_report(manifest, tasks).select(
        "dataset", F.lit("english_tasks").alias("rule"),
        F.when(F.col("chinese_tasks") == 0, "pass").otherwise("warn").alias("status"),
        F.lit(None).cast("bigint").alias("bad"), F.lit(None).cast("bigint").alias("n"),
    )
    own = lengths.unionByName(files).unionByName(text)
    return own if sensors is None else own.unionByName(sensors)
