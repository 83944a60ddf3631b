"""Train/validation split, its metadata and manifests, and recipe sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.numbers import hash32, share
from tracemill.operators.indices import dataset_info, fix_indices, reindex_episodes
from tracemill.operators.positions import smallest
from tracemill.operators.relabel import EPISODE


def _checked(ratio: float) -> float:
    if not 0.0 < ratio < 1.0:
        raise ValueError(f"train ratio must lie strictly between 0 and 1, got {ratio}")
    return ratio


def _side(is_train: Column) -> Column:
    return F.when(is_train, "train").otherwise("val")


def split_by_hash(episodes: DataFrame, ratio: float, seed: int = 42) -> DataFrame:
    """Independent draw per episode from a hash of dataset, episode and seed.

    No shuffle, and the side of an episode never depends on other episodes.
    """
    draw = hash32(F.col("dataset"), F.col("episode_index").cast("string"), F.lit(str(seed)))
    return episodes.withColumn("split", _side(draw < F.lit(_checked(ratio) * 2**32)))


def split_episodes(sided: DataFrame) -> DataFrame:
    """Episodes of both sides, numbered anew on each side."""
    return reindex_episodes(sided, ("dataset", "split"), keep_old=True)


def split_metadata(sided: DataFrame, info: DataFrame) -> DataFrame:
    """Counts and split range of each side. A side without episodes has no row."""
    return dataset_info(sided, info, ("dataset", "split")).withColumn(
        "range", F.concat(F.lit("0:"), F.col("total_episodes").cast("string"))
    )


def split_frames(frames: DataFrame, numbered: DataFrame) -> DataFrame:
    """Frames of each side with their new episode and frame numbers."""
    return fix_indices(frames, numbered, ("dataset", "split"))


def split_info(sided: DataFrame, ratio: float) -> DataFrame:
    """Counts per dataset. The recording ids stay one row each, in ``sided``."""
    return sided.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("original_total_episodes"),
        F.count_if(F.col("split") == "train").alias("train_episodes_count"),
        F.count_if(F.col("split") == "val").alias("val_episodes_count"),
    ).withColumn("train_ratio", F.lit(ratio))


def split_manifest(manifest: DataFrame, sided: DataFrame) -> DataFrame:
    """``X`` becomes ``X_split/train`` and ``X_split/val`` with the same weight.

    A side without episodes gets no entry.
    """
    sides = sided.select("dataset", "split").distinct()
    return manifest.join(sides, "dataset").select(
        F.concat("dataset", F.lit("_split/"), "split").alias("dataset"), "split", "weight"
    )


def pending(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Manifest entries that have not been split yet."""
    return manifest.join(done.select("dataset"), "dataset", "left_anti")


def recipe_shares(counts: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Target share of each class: count times weight (0 to 2, default 1), normalised."""
    pairs = [F.lit(x) for k, w in weights.items() for x in (k, float(min(2.0, max(0.0, w))))]
    table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    weighted = counts.withColumn(
        "scaled", F.col("available") * F.coalesce(F.try_element_at(table, F.col("class")), F.lit(1.0))
    )
    whole = weighted.agg(F.sum("scaled")).scalar()
    return weighted.withColumn("share", share(F.col("scaled"), whole)).drop("scaled")


def recipe_total(shares: DataFrame) -> DataFrame:
    """Largest result the scarcest class allows; 0 without any class."""
    limits = shares.filter(F.col("share") > 0.001)
    return limits.agg(
        F.coalesce(F.floor(F.min(F.col("available") / F.col("share"))), F.lit(0)).cast("bigint").alias("total")
    )


def recipe_plan(prompts: DataFrame, tags: DataFrame, weights: dict[str, dict[str, float]]) -> DataFrame:
    """Quota per prompt and per tag class for the largest feasible recipe."""
    sides = {
        "prompt": recipe_shares(prompts, weights.get("prompt", {})),
        "tag": recipe_shares(tags, weights.get("tag", {})),
    }
    final = F.least(recipe_total(sides["prompt"]).scalar(), recipe_total(sides["tag"]).scalar())
    rows = [s.withColumn("side", F.lit(n)) for n, s in sides.items()]
    return (
        rows[0].unionByName(rows[1])
        .withColumn("total", final)
        .withColumn("quota", F.round(F.col("share") * F.col("total")).cast("bigint"))
    )


def recipe_sample(recordings: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n recordings at random, the same ones for the same seed."""
    drawn = recordings.withColumn("_draw", hash32(F.col("recording_id").cast("string"), F.lit(str(seed))))
    return smallest(drawn, "_draw", "recording_id", n).drop("_draw")


def recipe_sample_by_class(recordings: DataFrame, quotas: DataFrame, by: str, seed: int = 42) -> DataFrame:
    """As many random recordings of each class as its quota says."""
    drawn = recordings.withColumn(
        "_draw", hash32(F.col("recording_id").cast("string"), F.lit(str(seed)))
    ).join(quotas.select(F.col("class").alias(by), F.col("quota").alias("_quota")), by)
    return smallest(drawn, "_draw", "recording_id", F.col("_quota"), [by]).drop("_draw", "_quota")


def split_recordings(sided: DataFrame) -> DataFrame:
    """Recording ids of each side, one row each."""
    return sided.select(*EPISODE, "split")
