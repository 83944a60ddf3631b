"""Build a dataset from the lake, and the two standard runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.paths import match_group
from tracemill.operators import compose, lake, quality, sampling, split, stats
from tracemill.operators.positions import keyed
from tracemill.operators.relabel import EPISODE
from tracemill.session import materialise
from tracemill.sources import readers
from tracemill.sources.snapshots import GateError, Staged, write_snapshot

# What a snapshot has for every dataset, and the types of camera features.
SNAPSHOT_FILES = ("meta/info.json", "meta/tasks.jsonl", "meta/episodes.jsonl")
CAMERA_TYPES = ("video", "image")


def build_dataset(
    recordings: DataFrame, episodes: DataFrame, frames: DataFrame, tasks: DataFrame,
    evaluation: DataFrame, info: DataFrame, *, n: int | None, ratio: float, seed: int = 42, quotas: DataFrame | None = None,
    by: str = "task", sensors: DataFrame | None = None, **filters,
) -> dict[str, DataFrame]:
    """Filter, sample by recipe, remove evaluation data, split, check.

    Without ``n`` and ``quotas`` all that is left goes into the build.
    Returns the tables of the new snapshot and the doctor's report; :func:`publish`
    writes them and checks what was written.
    """
    chosen = lake.query_recordings(recordings, **filters)
    clean = compose.without_leaks(chosen, evaluation)
    if quotas is not None:
        clean = split.recipe_sample_by_class(clean, quotas, by, seed)
    elif n is not None:
        clean = split.recipe_sample(clean, n, seed)
    sample = clean.select("recording_id")
    mine = materialise(episodes.join(sample, "recording_id", "left_semi"))
    numbered = split.split_episodes(split.split_by_hash(mine, ratio, seed))
    rows = frames.join(keyed(numbered.select(*EPISODE)), list(EPISODE), "left_semi")
    names = mine.select("dataset").distinct()
    checks = quality.doctor_checks(
        names, mine, rows, tasks, None if sensors is None else sensors.join(names, "dataset", "left_semi"))
    return {
        "episodes": numbered,
        "info": split.split_metadata(numbered, info),
        "frames": split.split_frames(rows, numbered),
        "tasks": tasks.join(names, "dataset", "left_semi"),
        "doctor": quality.doctor_report(checks),
        "verdict": quality.doctor_verdict(checks),
    }


def require_pass(verdict: DataFrame, strict: bool = False) -> None:
    """Stop when a dataset fails the doctor, or only warns where that is asked; names the first ones."""
    failing = verdict.filter(F.col("status").isin("fail", *(["warn"] if strict else []))).orderBy("dataset").limit(5)
    names = [r["dataset"] for r in failing.select("dataset").collect()]
    if names:
        raise GateError(f"datasets must be fixed before they can be used, the first ones are {', '.join(names)}")


def doctor_staged(staged: Staged, seconds: str = "timestamp", action: str = "action", exempt=()) -> DataFrame:
    """All rules as (dataset, rule, status, bad, n), on the files of a version that is not committed yet.

    Time stamps and actions are checked where the frames have those columns, cameras where the
    info of a dataset lists any. Each rule reads only the columns it needs.
    """
    spark, root = staged.spark, staged.root
    info, episodes = readers.read_info(spark, root), readers.read_episodes(spark, root)
    manifest = info.select("dataset")
    features = info.select("dataset", "fps", F.explode("features").alias("feature", "f"))
    present = {r[0] for r in features.filter(F.col("feature").isin(seconds, action)).select("feature").distinct().collect()}
    columns = ["recording_id", *[c for c in (seconds, action) if c in present]]
    frames = readers.read_frames(spark, root, columns, info)
    stamps = vectors = None
    if seconds in present:
        stamps = frames.select("dataset", "recording_id", "frame_index", F.col(seconds).alias("seconds")).join(
            info.select("dataset", "fps"), "dataset").filter(F.col("seconds").isNotNull())
    if action in present:
        vectors = frames.select("dataset", F.col(action).alias("vector")).filter(F.col("vector").isNotNull())
    cameras = features.filter(F.col("f.dtype").isin(*CAMERA_TYPES)).select(
        "dataset", F.col("feature").alias("camera"), F.get("f.shape", F.lit(0)).alias("height"), F.get("f.shape", F.lit(1)).alias("width"))
    sensors = quality.sensor_checks(
        manifest, files=readers.read_file_names(spark, root, "meta", "*.json*"), stamps=stamps, vectors=vectors, cameras=cameras,
        exempt=exempt, required=SNAPSHOT_FILES)
    return quality.doctor_checks(manifest, episodes, frames, readers.read_tasks(spark, root), sensors)


def publish(tables: dict[str, DataFrame], path: str, strict: bool = False, **doctor) -> dict:
    """Write the tables of a build as a snapshot and commit it only if the doctor lets it pass.

    The doctor looks at the files that were written, not at the plan again. Rules that warn
    stop a commit only if ``strict``. Frames and episodes counted while writing must agree with the info.
    """
    def gate(staged: Staged) -> None:
        stated = readers.read_info(staged.spark, staged.root).agg(F.count(F.lit(1)), F.sum("total_episodes")).first()
        if (staged.counts["datasets"], staged.counts["episodes"]) != (stated[0], stated[1] or 0):
            raise GateError(f"written {staged.counts}, but the info states {stated[0]} datasets and {stated[1]} episodes")
        if not staged.counts["frames"]:
            raise GateError("the snapshot has no frames")
        require_pass(quality.doctor_verdict(doctor_staged(staged, **doctor)), strict)

    return write_snapshot({k: tables[k] for k in ("frames", "episodes", "info", "tasks", "episode_stats") if k in tables}, path, gate)


def standard_run(
    manifest: DataFrame, episodes: DataFrame, frames: DataFrame, tasks: DataFrame, info: DataFrame, rules, config,
    ratio: float = 0.95, seed: int = 42,
) -> dict[str, DataFrame]:
    """Split, weights, verification, integrity and text check, one table per stage."""
    sided = split.split_by_hash(episodes, ratio, seed)
    grouped = sampling.frames_per_dataset(frames).withColumn("grp", match_group(F.col("dataset"), rules))
    weights = sampling.sampling_weights(grouped, config)
    return {
        "split": split.split_metadata(sided, info),
        "weights": weights,
        "verify": sampling.verify_weights(grouped, weights, config),
        "integrity": quality.frame_integrity(manifest, episodes, frames),
        "text": quality.chinese_report(manifest, tasks),
    }


def dagger_run(manifest: DataFrame, episodes: DataFrame, frames: DataFrame, tasks: DataFrame, info: DataFrame, rules) -> dict[str, DataFrame]:
    """Integrity check, then the profile of the task folders."""
    counted = stats.episode_task_frames(frames)
    return {
        "integrity": quality.frame_integrity(manifest, episodes, frames),
        "profile": stats.folder_profile(info, counted, tasks, rules),
    }
