"""What a dataset consists of: prompts, tags, sources, folders, leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracemill.functions.numbers import frames_of, pct, share
from tracemill.operators.lake import export_selection
from tracemill.operators.positions import sorted_position


def dataset_recordings(datasets: DataFrame, recordings: DataFrame) -> DataFrame:
    """Recordings of each dataset with their place; unknown ids are dropped."""
    kept = [c for c in datasets.columns if c != "recordings"]
    members = datasets.select(*kept, F.posexplode("recordings").alias("place", "recording_id"))
    return members.join(recordings, "recording_id")


def _with_share(groups: DataFrame, totals: DataFrame, keys) -> DataFrame:
    return groups.join(totals, list(keys)).withColumn(
        "ratio", share(F.col("frames"), F.col("total"))
    )


def dataset_totals(members: DataFrame) -> DataFrame:
    return members.groupBy("dataset_id").agg(F.sum("frames").alias("total"))


def prompt_composition(members: DataFrame) -> DataFrame:
    """Share of frames per task, largest first."""
    groups = members.groupBy("dataset_id", "task").agg(F.sum("frames").alias("frames"))
    return _with_share(groups, dataset_totals(groups), ["dataset_id"]).orderBy(
        "dataset_id", F.desc("frames"), "task"
    )


def tag_frames(members: DataFrame) -> DataFrame:
    """Frames per dataset and tag. An episode counts once for every tag it has."""
    return (
        members.select("dataset_id", "frames", F.explode("tags").alias("tag"))
        .groupBy("dataset_id", "tag").agg(F.sum("frames").alias("frames"))
    )


def tag_composition(members: DataFrame) -> DataFrame:
    """Share of frames per tag. Tags overlap, so the shares may exceed 1."""
    return _with_share(tag_frames(members), dataset_totals(members), ["dataset_id"]).orderBy(
        "dataset_id", F.desc("frames"), "tag"
    )


def tag_tree(members: DataFrame, tag_defs: DataFrame, dimensions) -> DataFrame:
    """Dimension -> tags with shares. Dimensions keep the given order, others are hidden."""
    order = F.array_position(F.array(*[F.lit(d) for d in dimensions]), F.col("dimension"))
    rank = Window.partitionBy("dataset_id", "dimension").orderBy(F.desc("frames"), "tag")
    return (
        tag_composition(members)
        .join(tag_defs, "tag")
        .withColumn("dimension_order", order)
        .filter(F.col("dimension_order") > 0)
        .withColumn("tag_order", F.row_number().over(rank).cast("bigint"))
        .withColumn("pct", pct(F.col("ratio")))
        .withColumn("tag_frames", frames_of(F.col("ratio"), F.col("total")))
        .orderBy("dataset_id", "dimension_order", "tag_order")
    )


def tag_pies(members: DataFrame, tag_defs: DataFrame) -> DataFrame:
    """Share of each tag inside its own dimension."""
    rows = tag_frames(members).join(tag_defs, "tag")
    totals = rows.groupBy("dataset_id", "dimension").agg(F.sum("frames").alias("total"))
    return _with_share(rows, totals, ["dataset_id", "dimension"]).withColumn(
        "pct", pct(F.col("ratio"))
    )


def upstream_sources(members: DataFrame) -> DataFrame:
    """Recordings of each dataset per collection and type."""
    return members.groupBy("dataset_id", "collection_id", "type").agg(
        F.count(F.lit(1)).alias("recordings"), F.sum("frames").alias("frames")
    )


def upstream_members(members: DataFrame) -> DataFrame:
    """The recordings behind ``upstream_sources``, one row each."""
    return members.select("dataset_id", "collection_id", "type", "place", "recording_id")


def downstream_usage(datasets: DataFrame, versions: DataFrame, kind) -> DataFrame:
    """Jobs using each dataset; job i refers to version i modulo the published ones.

    ``versions`` is (dataset_id, version, place) with place 0 for the newest
    published version. The match is a plain join on the computed place.
    """
    counts = versions.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    jobs = datasets.select("dataset_id", F.posexplode("used_by").alias("i", "job"))
    return (
        jobs.join(counts, "dataset_id", "left")
        .withColumn("place", F.when(F.col("n") > 0, F.col("i") % F.col("n")))
        .join(versions, ["dataset_id", "place"], "left")
        .select("dataset_id", "i", "job", kind(F.col("job")).alias("kind"), "version")
    )


def leaked_recordings(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Training recordings that an evaluation dataset also holds."""
    return train.join(evaluation.select("recording_id").distinct(), "recording_id", "left_semi")


def without_leaks(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    return train.join(evaluation.select("recording_id").distinct(), "recording_id", "left_anti")


def folder_datasets(folders: DataFrame, datasets: DataFrame) -> DataFrame:
    """Folder tree. Unknown dataset ids are dropped, empty folders stay."""
    wanted = folders.select("folder", F.explode("dataset_ids").alias("dataset_id"))
    known = wanted.join(datasets, "dataset_id")
    return folders.select("folder").join(known, "folder", "left")


def union_of_values(df: DataFrame, keys, values: str, name: str) -> DataFrame:
    """Distinct members of an array column per key, one row each."""
    return df.select(*keys, F.explode(values).alias(name)).distinct()


def feature_groups(collections: DataFrame, hashed) -> DataFrame:
    """Collections sharing one feature set, one row per collection.

    An empty feature set is left out, as an export skips it.
    """
    rows = collections.filter(F.size("features") > 0).withColumn("features_hash", hashed(F.col("features")))
    return rows.select("features_hash", F.size("features").cast("bigint").alias("n_features"), "collection_id").distinct()


def feature_group_recordings(groups: DataFrame, recordings: DataFrame, **filters) -> DataFrame:
    """Recordings an export of each feature group takes: (features_hash, n_features, collection_id, recording_id).

    A group names whole collections; the filters of an export (devices, operators, dates and the rest of
    ``export_selection``) are applied to their recordings again, so no collection is taken whole by itself.
    """
    chosen = export_selection(recordings, **filters).select("collection_id", "recording_id")
    return groups.select("features_hash", "n_features", "collection_id").join(chosen, "collection_id")


def feature_group_names(groups: DataFrame) -> DataFrame:
    """One export directory per feature set: ``dataset_{i}_{n}_{hash}``.

    The feature sets are few (one per robot layout), the collections are not.
    """
    sets = groups.groupBy("features_hash", "n_features").agg(F.count(F.lit(1)).alias("collections"))
    numbered = sorted_position(sets, [], ["features_hash"], "i")
    return numbered.withColumn(
        "name", F.concat_ws("_", F.lit("dataset"), F.col("i"), F.col("n_features"), F.col("features_hash"))
    )
