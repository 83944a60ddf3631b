"""Episode and frame numbering, and choosing episodes by DAgger type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.paths import episode_from_path, episode_path
from tracemill.functions.text import english_only_all
from tracemill.operators.positions import dense_position, keyed, running_start
from tracemill.operators.relabel import EPISODE, relabel_first_task, task_vocabulary
from tracemill.session import materialise


def reindex_episodes(episodes: DataFrame, keys=("dataset",), keep_old: bool = False) -> DataFrame:
    """Gap-free 0-based episode_index in the old order."""
    out = dense_position(episodes, keys, ["episode_index"], "_new")
    if keep_old:
        out = out.withColumnRenamed("episode_index", "old_episode_index")
    else:
        out = out.drop("episode_index")
    return out.withColumnRenamed("_new", "episode_index")


def episode_starts(frames: DataFrame, episodes: DataFrame, keys=("dataset",)) -> DataFrame:
    """Number of the first frame of each episode that has frames.

    Counted on the data, not on the metadata, as the numbering follows the rows.
    The lengths are written once, as both steps of the running sum need them.
    """
    lengths = frames.groupBy(*EPISODE).agg(F.count(F.lit(1)).alias("n_frames"))
    placed = keyed(episodes.select(*{*keys, *EPISODE}, "episode_index")).join(lengths, list(EPISODE))
    placed = materialise(placed)
    return keyed(running_start(placed, keys, "episode_index", "n_frames", "first_index"), placed.count())


def fix_indices(frames: DataFrame, episodes: DataFrame, keys=("dataset",), starts: DataFrame | None = None) -> DataFrame:
    """Set ``episode_index`` and the running frame number ``index``.

    The running sum is taken over episodes, one row each; a frame adds its
    position in the episode, so frames are joined once and never sorted.
    ``starts`` is what :func:`episode_starts` gave, where a caller needs it too.
    """
    starts = episode_starts(frames, episodes, keys) if starts is None else starts
    kept = frames.drop("episode_index", "index", *[k for k in keys if k not in EPISODE])
    return (
        kept.join(starts.drop("n_frames"), list(EPISODE))
        .withColumn("index", (F.col("first_index") + F.col("frame_index")).cast("bigint"))
        .drop("first_index")
    )


def numbering_check(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Per dataset: episodes with data, metadata rows, length mismatches, verdict.

    A different number of files and metadata rows fails; a wrong length does not.
    """
    lengths = frames.groupBy(*EPISODE).agg(F.count(F.lit(1)).alias("actual"))
    both = episodes.select(*EPISODE, "length").withColumn("_meta", F.lit(1)).join(
        lengths, list(EPISODE), "full"
    )
    return both.groupBy("dataset").agg(
        F.count("actual").alias("files"),
        F.count("_meta").alias("metadata_rows"),
        F.count_if(F.col("actual") != F.col("length")).alias("mismatches"),
    ).withColumn("ok", F.col("files") == F.col("metadata_rows"))


def filter_dagger(episodes: DataFrame, dagger_type: str) -> DataFrame:
    """Episodes of one DAgger type. No match at all is an error."""
    kept = episodes.filter(F.col("dagger_type") == dagger_type)
    if kept.isEmpty():
        raise ValueError(f"no episode has dagger_type {dagger_type!r}")
    return kept


def files_of(files: DataFrame, episodes: DataFrame) -> DataFrame:
    """Files whose path names a kept episode."""
    keyed = files.withColumn("episode_index", episode_from_path(F.col("path")))
    return keyed.join(episodes.select("dataset", "episode_index"), ["dataset", "episode_index"], "left_semi")


def renumber_files(files: DataFrame, renumbered: DataFrame, info: DataFrame) -> DataFrame:
    """New path and URL for every file of a kept episode.

    ``renumbered`` maps old_episode_index to episode_index per dataset; ``info`` has the
    ``chunks_size`` of each dataset.
    """
    keyed = files.withColumn("old_episode_index", episode_from_path(F.col("path")))
    sizes = info.select("dataset", F.col("chunks_size").alias("_size"))
    moved = keyed.join(renumbered, ["dataset", "old_episode_index"]).join(sizes, "dataset")
    for column in ("path", "download_url"):
        if column in files.columns:
            moved = moved.withColumn(column, episode_path(F.col(column), F.col("episode_index"), F.col("_size")))
    return moved.drop("old_episode_index", "_size")


def dataset_info(episodes: DataFrame, info: DataFrame, keys=("dataset",), length: str = "length") -> DataFrame:
    """Recomputed counts of a dataset, from its episode rows.

    The ``chunks_size``, ``fps`` and ``cameras`` of each dataset are those of ``info``.
    """
    counts = episodes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_episodes"),
        F.coalesce(F.sum(length), F.lit(0)).alias("total_frames"),
    )
    return (
        counts.join(info.select("dataset", "chunks_size", "fps", "cameras"), "dataset")
        .withColumn("total_chunks", F.ceil(F.col("total_episodes") / F.col("chunks_size")).cast("bigint"))
        .withColumn("total_videos", F.col("total_episodes") * F.col("cameras"))
        .drop("cameras")
    )


def dagger_subset(
    frames: DataFrame, episodes: DataFrame, dagger_type: str, info: DataFrame
) -> dict[str, DataFrame]:
    """Episodes of one DAgger type as a dataset of their own.

    Kept episodes are renumbered, their tasks turned into English, the
    vocabulary rebuilt, all frames given the first task of their episode and
    numbered anew, and the counts taken from the frames that exist.
    """
    kept = filter_dagger(episodes, dagger_type)
    renumbered = materialise(
        reindex_episodes(kept).withColumn("tasks", english_only_all(F.col("tasks")))
    )
    names = renumbered.select("dataset", F.explode("tasks").alias("task"))
    vocabulary = task_vocabulary(names)
    mine = frames.join(keyed(renumbered.select(*EPISODE)), list(EPISODE), "left_semi")
    numbered = fix_indices(relabel_first_task(mine, renumbered, vocabulary), renumbered)
    counts = numbered.groupBy(*EPISODE).agg(F.count(F.lit(1)).alias("n_frames"))
    present = renumbered.join(keyed(counts), list(EPISODE), "left").fillna(0, ["n_frames"])
    words = vocabulary.groupBy("dataset").agg(F.count(F.lit(1)).alias("total_tasks"))
    counted = (
        dataset_info(present, info, length="n_frames")
        .join(words, "dataset")
        .withColumn("dagger_type", F.lit(dagger_type))
    )
    return {"info": counted, "tasks": vocabulary, "episodes": renumbered, "frames": numbered}


