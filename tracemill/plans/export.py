"""Export a selection of recordings as datasets in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.operators import relabel
from tracemill.operators.indices import dagger_subset, dataset_info, episode_starts, fix_indices, reindex_episodes
from tracemill.operators.lake import latest_annotation, recording_limit
from tracemill.operators.positions import keyed
from tracemill.operators.relabel import EPISODE
from tracemill.session import materialise


def export_dataset(
    selected: DataFrame, episodes: DataFrame, frames: DataFrame, *, mode: str = "base",
    info: DataFrame, annotations: DataFrame | None = None, dagger_type: str | None = None,
    prefer: str = "action_english", annotation_version=None, version: str = "version", limit: int | None = None,
) -> dict[str, DataFrame]:
    """Tables of the exported datasets: info, tasks, episodes, frames.

    ``selected`` holds the recording ids an export takes. Mode ``base`` labels
    frames by prompt, ``annotated`` by the annotations, ``dagger`` keeps one
    DAgger type and labels by the first task. ``info`` has fps, chunks_size and cameras
    of each dataset. Of several annotations of an episode the newest ``version`` is used,
    or the pinned ``annotation_version``; ``limit`` takes the first recordings by id.
    """
    ids = selected.select("recording_id").distinct()
    if limit is not None:
        ids = recording_limit(ids, limit)
    if annotations is not None and version in annotations.columns:
        annotations = latest_annotation(annotations, list(EPISODE), version, annotation_version)
    mine = episodes.join(ids, "recording_id", "left_semi")
    rows = frames.join(ids, "recording_id", "left_semi")
    if mode == "dagger":
        return dagger_subset(rows, mine, dagger_type, info)
    numbered = materialise(reindex_episodes(mine))
    if mode == "annotated":
        named = relabel.episode_tasks_from_annotation(numbered, annotations, prefer)
    elif mode == "base":
        named = numbered
    else:
        raise ValueError(f"export mode {mode!r} is none of base, annotated, dagger")
    words = relabel.task_vocabulary(named.select("dataset", F.explode("tasks").alias("task")))
    starts = episode_starts(rows, named)  # the frames are counted once, for the numbering and the labels
    if mode == "annotated":
        labelled = relabel.relabel_by_annotation(
            rows, annotations.join(ids, "recording_id", "left_semi"), words, info, prefer, starts
        )
    else:
        labelled = relabel.relabel_by_prompt(rows, named, words)
    total = words.groupBy("dataset").agg(F.count(F.lit(1)).alias("total_tasks"))
    return {
        "info": dataset_info(named, info).join(total, "dataset"),
        "tasks": words,
        "episodes": named,
        "frames": fix_indices(labelled, named, starts=starts),
    }


def concatenate(collections: DataFrame, frames: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Episodes of several collections as one dataset with continuous numbers.

    Episodes are ordered by recording id.
    """
    episodes = reindex_episodes(
        collections.withColumn("dataset", F.lit(name)).withColumn("episode_index", F.col("recording_id"))
    )
    rows = frames.withColumn("dataset", F.lit(name))
    return episodes, fix_indices(rows.join(keyed(episodes.select(*EPISODE)), list(EPISODE), "left_semi"), episodes)
