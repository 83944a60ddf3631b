"""Frames and recordings by prompt, task folder and group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.numbers import FPS, frames_to_hours, hms, share
from tracemill.functions.paths import OTHER, match_group, task_folder
from tracemill.operators.relabel import EPISODE


def episode_task_frames(frames: DataFrame) -> DataFrame:
    """Frames per dataset, recording and task index.

    All profiles start from this one pass over the frames. It shrinks every
    episode to a few rows before the shuffle, so a large task is no hot key.
    """
    return frames.groupBy(*EPISODE, "task_index").agg(F.count(F.lit(1)).alias("frames"))


def with_prompt(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    """Prompt of each task index; ``unknown_{index}`` where the vocabulary lacks it."""
    missing = F.concat(F.lit("unknown_"), F.col("task_index").cast("string"))
    return rows.join(tasks, ["dataset", "task_index"], "left").withColumn(
        "prompt", F.coalesce("task", missing)
    ).drop("task")


def frames_per_task(frames: DataFrame) -> DataFrame:
    return frames.groupBy("dataset", "task_index").agg(F.count(F.lit(1)).alias("frames"))


def prompt_recordings(counted: DataFrame, tasks: DataFrame) -> DataFrame:
    """Distinct recordings per task folder and prompt, one row each.

    One row per pair instead of a list: a common prompt occurs in too many
    recordings for one value.
    """
    return (
        with_prompt(counted, tasks)
        .select(task_folder(F.col("dataset")).alias("task_folder"), "prompt", "recording_id")
        .distinct()
    )


def folder_members(manifest: DataFrame) -> DataFrame:
    """Sub-datasets of each task folder, one row each."""
    return manifest.select(task_folder(F.col("dataset")).alias("task_folder"), "dataset").distinct()


def folder_totals(info: DataFrame, rules) -> DataFrame:
    """Total frames and sub-datasets per task folder; the sub-datasets are listed where there are several.

    ``info`` is (dataset, frames); the frames of a dataset that could not be read
    are null and count 0, the dataset itself still counts. The group is matched
    on the folder, not on the dataset path.
    """
    folder = task_folder(F.col("dataset")).alias("task_folder")
    members = F.concat_ws(", ", F.sort_array(F.collect_list("dataset")))
    return (
        info.groupBy(folder)
        .agg(
            F.count(F.lit(1)).alias("subdataset_count"),
            F.when(F.count(F.lit(1)) > 1, members).otherwise("").alias("subdatasets"),
            F.coalesce(F.sum("frames"), F.lit(0)).alias("total_frames"),
        )
        .withColumn("grp", match_group(F.col("task_folder"), rules))
    )


def with_duration(df: DataFrame, frames: str = "total_frames", fps: int = FPS) -> DataFrame:
    return df.withColumn("hours", F.bround(frames_to_hours(F.col(frames), fps), 4)).withColumn(
        "duration", hms(F.col(frames), fps)
    )


def prompt_counts(counted: DataFrame, tasks: DataFrame) -> DataFrame:
    """Frames and distinct recordings, with their ids, per task folder and prompt."""
    return (
        with_prompt(counted, tasks)
        .groupBy(task_folder(F.col("dataset")).alias("task_folder"), "prompt", "recording_id")
        .agg(F.sum("frames").alias("frames"))
        .groupBy("task_folder", "prompt")
        .agg(
            F.sum("frames").alias("prompt_frames"),
            F.count("recording_id").alias("recording_count"),
            F.concat_ws(", ", F.sort_array(F.collect_list("recording_id"))).alias("recording_ids"),
        )
    )


def folder_profile(info: DataFrame, counted: DataFrame, tasks: DataFrame, rules, fps: int = FPS) -> DataFrame:
    """One row per task folder and prompt; a folder without prompts has one row.

    prompt_ratio compares frames in the data with frames in the metadata, so it
    can exceed 1. Sub-datasets and recordings are listed as the report has them;
    :func:`folder_members` and :func:`prompt_recordings` give them as rows.
    """
    joined = folder_totals(info, rules).join(prompt_counts(counted, tasks), "task_folder", "left")
    return with_duration(
        joined.withColumn(
            "prompt_ratio", F.bround(share(F.col("prompt_frames"), F.col("total_frames")), 4)
        ).fillna({"prompt": "", "prompt_frames": 0, "recording_count": 0, "recording_ids": ""}),
        fps=fps,
    )


def group_order() -> list[Column]:
    """Groups by name with the unmatched ones last."""
    return [F.col("grp") == OTHER, F.col("grp")]


def profile_order(profile: DataFrame) -> DataFrame:
    return profile.orderBy(*group_order(), "task_folder", F.desc("prompt_frames"), "prompt")


def folder_summary(info: DataFrame, counted: DataFrame, tasks: DataFrame, rules, fps: int = FPS) -> DataFrame:
    """A row per folder, a subtotal per group and the grand total."""
    prompts = prompt_counts(counted, tasks).groupBy("task_folder").agg(
        F.count(F.lit(1)).alias("num_prompts"),
        F.min_by("prompt", F.struct(-F.col("prompt_frames"), F.col("prompt"))).alias("top_prompt"),
    )
    folders = folder_totals(info, rules).join(prompts, "task_folder", "left")
    rolled = folders.rollup("grp", "task_folder").agg(
        F.grouping_id().alias("_level"),
        F.sum("total_frames").alias("total_frames"),
        F.sum("subdataset_count").alias("subdataset_count"),
        F.max("num_prompts").alias("num_prompts"),
        F.max("top_prompt").alias("top_prompt"),
    )
    per_folder = F.col("_level") == 0
    return with_duration(
        rolled.select(
            F.when(per_folder, "folder").when(F.col("_level") == 1, "group").otherwise("total").alias("level"),
            F.coalesce("grp", F.lit("")).alias("grp"),
            F.coalesce("task_folder", F.lit("")).alias("task_folder"),
            F.when(per_folder, F.col("subdataset_count")).alias("subdataset_count"),
            "total_frames",
            F.when(per_folder, F.coalesce("num_prompts", F.lit(0))).alias("num_prompts"),
            F.when(per_folder, F.coalesce("top_prompt", F.lit(""))).otherwise("").alias("top_prompt"),
        ),
        fps=fps,
    )


def group_summary(info: DataFrame, rules, fps: int = FPS) -> DataFrame:
    """Frames, folders, datasets and share of all frames per group."""
    folders = folder_totals(info, rules)
    whole = folders.agg(F.sum("total_frames")).scalar()
    groups = folders.groupBy("grp").agg(
        F.count(F.lit(1)).alias("folders"),
        F.sum("subdataset_count").alias("datasets"),
        F.sum("total_frames").alias("total_frames"),
    )
    return with_duration(groups.withColumn("ratio", share(F.col("total_frames"), whole)), fps=fps)
