"""Sampling weights per dataset and the reports that verify them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.numbers import share
from tracemill.functions.paths import OTHER, category, is_dual, match_group, subcategory


def frames_per_dataset(frames: DataFrame) -> DataFrame:
    return frames.groupBy("dataset").agg(F.count(F.lit(1)).alias("frames"))


def attach_info(manifest: DataFrame, info: DataFrame, on_missing: str = "error") -> DataFrame:
    """Manifest entries with the frame count of their dataset.

    A dataset without info fails (``error``), counts 0 frames (``zero``) or is
    left out (``skip``).
    """
    if on_missing == "skip":
        return manifest.join(info, "dataset")
    joined = manifest.join(info, "dataset", "left")
    if on_missing == "zero":
        return joined.withColumn("frames", F.coalesce("frames", F.lit(0).cast("bigint")))
    if on_missing == "error":
        message = F.concat(F.lit("no info for dataset "), "dataset")
        return joined.withColumn(
            "frames", F.coalesce("frames", F.raise_error(message).cast("bigint"))
        )
    raise ValueError(f"on_missing {on_missing!r} is none of error, zero, skip")


def match_group_table(datasets: DataFrame, rules: DataFrame) -> DataFrame:
    """First matching rule per dataset, with the rules given as a table.

    ``rules`` is (rule_order, grp, keyword), a configuration of a few kilobytes.
    It enters the plan as one array value, so each dataset is tested in place and
    no pairs of datasets and rules are formed.
    """
    table = rules.agg(F.collect_list(F.struct("rule_order", "grp", "keyword"))).scalar()
    hits = F.filter("_rules", lambda r: F.col("dataset").contains(r["keyword"]))
    best = F.array_min(F.transform(hits, lambda r: F.struct(r["rule_order"], r["grp"].alias("grp"))))
    return (
        datasets.withColumn("_rules", table)
        .withColumn("grp", F.coalesce(best["grp"], F.lit(OTHER)))
        .drop("_rules")
    )


def group_targets(config: dict[str, tuple]) -> dict[str, float]:
    """Share of all sampled frames each configured group is meant to get.

    Fixed ratios hold as they are; the others divide what is left. A group that
    turns out to have no dataset still keeps its part.
    """
    for name, entry in config.items():
        if len(entry) not in (2, 3):
            raise ValueError(f"config of group {name!r} must be (ratio, alpha[, fixed])")
    fixed = {g: e[0] for g, e in config.items() if len(e) == 3 and e[2]}
    relative = {g: e[0] for g, e in config.items() if g not in fixed}
    taken, parts = sum(fixed.values()), sum(relative.values())
    if taken > 1.0 + 1e-9 or taken < 0:
        raise ValueError(f"fixed ratios must sum to 0..1, got {taken}")
    if relative and parts <= 0:
        raise ValueError(f"relative ratios must sum to more than 0, got {parts}")
    return fixed | {g: r / parts * (1.0 - taken) for g, r in relative.items()}


def _lookup(table: dict[str, float], key: Column) -> Column:
    pairs = [F.lit(x) for k, v in table.items() for x in (k, float(v))]
    entries = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    return F.try_element_at(entries, key)


def sampling_weights(grouped: DataFrame, config: dict[str, tuple]) -> DataFrame:
    """Weight per dataset so that each group gets its target share of frames.

    ``grouped`` is (dataset, frames, grp). Inside a group a dataset's share grows
    with frames^(1-alpha). Ungrouped datasets and groups with target 0 get no
    weight. A tiny smallest weight scales all weights by a power of ten.
    """
    targets = group_targets(config)
    alphas = {g: e[1] for g, e in config.items()}
    unset = F.concat(F.lit("no config for group "), F.col("grp"))
    empty = F.concat(F.lit("dataset without frames: "), F.col("dataset"))
    target = F.coalesce(_lookup(targets, F.col("grp")), F.raise_error(unset).cast("double"))
    sized = (
        grouped.filter(F.col("grp") != OTHER)
        .withColumn("target", target)
        .filter(F.col("target") != 0)
        .withColumn(
            "power",
            F.when(F.col("frames") > 0, F.pow(F.col("frames").cast("double"), 1.0 - _lookup(alphas, F.col("grp"))))
            .otherwise(F.raise_error(empty).cast("double")),
        )
    )
    powers = sized.groupBy("grp").agg(F.sum("power").alias("group_power"))
    raw = sized.join(powers, "grp").withColumn(
        "raw", F.col("target") * F.col("power") / F.col("group_power") / F.col("frames")
    )
    least = raw.agg(F.min("raw")).scalar()
    scale = F.when(
        (least > 0) & (least < 0.01), F.pow(F.lit(10.0), F.ceil(F.lit(-2.0) - F.log10(least)).cast("double"))
    ).otherwise(F.lit(1.0))
    return raw.withColumn("weight", F.col("raw") * scale).select("dataset", "grp", "frames", "target", "weight")


def _weighted(datasets: DataFrame) -> DataFrame:
    return datasets.withColumn("weighted_frames", F.col("frames") * F.col("weight"))


def sampling_shares(datasets: DataFrame) -> DataFrame:
    """Share of weight, of frames and of really sampled frames per dataset."""
    rows = _weighted(datasets)
    totals = rows.agg(
        F.struct(F.sum("weight").alias("w"), F.sum("frames").alias("f"), F.sum("weighted_frames").alias("wf"))
    ).scalar()
    return (
        rows.withColumn("_t", totals)
        .withColumn("weight_share", F.col("weight") / F.col("_t.w"))
        .withColumn("frame_share", share(F.col("frames"), F.col("_t.f")))
        .withColumn("sampled_share", share(F.col("weighted_frames"), F.col("_t.wf")))
        .drop("_t")
    )


def describe_paths(datasets: DataFrame, rules, dual_prefix: str | None = None) -> DataFrame:
    """The attributes of a dataset path that reports group by."""
    path = F.col("dataset")
    dual = is_dual(path) if dual_prefix is None else is_dual(path, dual_prefix)
    return (
        datasets.withColumn("dual", F.when(dual, "dual").otherwise("other"))
        .withColumn("category", category(path))
        .withColumn("grp", match_group(path, rules))
        .withColumn("subcategory", subcategory(path))
    )


def shares_by_level(described: DataFrame) -> DataFrame:
    """The three shares by dual, category, group, subcategory and in total.

    One pass with grouping sets for all five sections.
    """
    sets = ["dual", "category", "grp", "subcategory"]
    totals = described.transform(_weighted).groupingSets([[s] for s in sets] + [[]], *sets).agg(
        F.grouping_id().alias("_level"),
        F.count(F.lit(1)).alias("datasets"),
        F.sum("weight").alias("weight"),
        F.sum("frames").alias("frames"),
        F.sum("weighted_frames").alias("weighted_frames"),
    )
    whole = described.transform(_weighted).agg(
        F.struct(F.sum("weight").alias("w"), F.sum("frames").alias("f"), F.sum("weighted_frames").alias("wf"))
    ).scalar()
    level = F.when(F.col("_level") == 0b0111, "dual").when(F.col("_level") == 0b1011, "category").when(
        F.col("_level") == 0b1101, "group").when(F.col("_level") == 0b1110, "subcategory").otherwise("total")
    return (
        totals.withColumn("_t", whole)
        .select(
            level.alias("level"),
            F.coalesce(*sets, F.lit("")).alias("name"),
            "datasets", "weight", "frames", "weighted_frames",
            (F.col("weight") / F.col("_t.w")).alias("weight_share"),
            share(F.col("frames"), F.col("_t.f")).alias("frame_share"),
            share(F.col("weighted_frames"), F.col("_t.wf")).alias("sampled_share"),
        )
    )


def group_report(grouped: DataFrame, weights: DataFrame) -> DataFrame:
    """Per group: datasets taken and left out, and the share of sampled frames."""
    rows = grouped.join(weights.select("dataset", "weight"), "dataset", "left").withColumn(
        "sampled", F.coalesce(F.col("frames") * F.col("weight"), F.lit(0.0))
    )
    whole = rows.agg(F.sum("sampled")).scalar()
    return (
        rows.groupBy("grp")
        .agg(
            F.count("weight").alias("included"),
            F.count_if(F.col("weight").isNull()).alias("excluded"),
            F.sum("sampled").alias("sampled"),
        )
        .withColumn("frame_share", share(F.col("sampled"), whole))
        .drop("sampled")
    )


def verify_weights(grouped: DataFrame, weights: DataFrame, config: dict[str, tuple], tolerance: float = 1e-6) -> DataFrame:
    """Share of sampled frames per group against its configured target."""
    target = F.coalesce(_lookup(group_targets(config), F.col("grp")), F.lit(0.0))
    return (
        group_report(grouped, weights)
        .withColumn("target", target)
        .withColumn("difference", F.abs(F.col("frame_share") - F.col("target")))
        .withColumn("ok", F.col("difference") <= tolerance)
    )
