"""Pipelines, their operators and runs, and the tag taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.recordings import param_keys

NOBODY = "—"


def pipelines_using(pipelines: DataFrame, operator: str | None = None) -> DataFrame:
    return pipelines.filter(F.array_contains("stages", operator)) if operator else pipelines


def pipeline_operators(pipelines: DataFrame, operators: DataFrame) -> DataFrame:
    """Stages of each pipeline in order; unknown operators are dropped."""
    stages = pipelines.select("pipeline_id", F.posexplode("stages").alias("stage", "operator_id"))
    return stages.join(operators, "operator_id")


def pipeline_param_keys(pipelines: DataFrame, operators: DataFrame) -> DataFrame:
    """Distinct parameter names of each pipeline with the place they first occur."""
    rows = pipeline_operators(pipelines, operators)
    keys = rows.select("pipeline_id", "stage", F.posexplode(param_keys(F.col("params"))).alias("place", "key"))
    return keys.groupBy("pipeline_id", "key").agg(
        F.min(F.struct("stage", "place")).alias("first")
    ).select("pipeline_id", "key", F.col("first.stage").alias("stage"), F.col("first.place").alias("place"))


def runs_with_creator(runs: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Who started a run: the user of a manual run, else the pipeline's creator."""
    creators = pipelines.select(F.col("pipeline_id").alias("pipeline"), "creator")
    who = F.when(F.col("trigger") == "manual", F.col("by")).otherwise(F.col("creator"))
    return runs.join(creators, "pipeline", "left").withColumn(
        "started_by", F.coalesce(who, F.lit(NOBODY))
    ).drop("creator")


def filter_runs(runs: DataFrame, *, pipeline=None, statuses=None, trigger=None, text=None) -> DataFrame:
    out = runs
    if pipeline:
        out = out.filter(F.col("pipeline") == pipeline)
    if statuses:
        out = out.filter(F.col("status").isin(list(statuses)))
    if trigger:
        out = out.filter(F.col("trigger") == trigger)
    if text:
        out = out.filter(F.col("name").contains(text) | F.col("target").contains(text))
    return out


def run_counts(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "running").alias("running"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "done").alias("done"),
    )


def flatten_tags(dimensions: DataFrame) -> DataFrame:
    """(dimension, level2, level3) from dimensions with leaves or with groups.

    A dimension has either ``leaves`` (array of names) or ``groups`` (array of
    category and items); an empty category keeps a row without items.
    """
    leaves = dimensions.select("dimension", F.explode("leaves").alias("level2")).withColumn(
        "level3", F.lit(None).cast("string")
    )
    groups = dimensions.select("dimension", F.explode("groups").alias("g")).select(
        "dimension", F.col("g.category").alias("level2"), F.explode_outer("g.items").alias("level3")
    )
    return leaves.unionByName(groups)


def taxonomy_counts(tags: DataFrame) -> DataFrame:
    """Number of dimensions, second-level and third-level nodes."""
    nodes = tags.groupBy("dimension", "level2").agg(F.count("level3").alias("items"))
    return nodes.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("level2"), F.sum("items").alias("level3")
    ).agg(
        F.count(F.lit(1)).alias("dimensions"), F.sum("level2").alias("level2"), F.sum("level3").alias("level3")
    )


def taxonomy_children(tags: DataFrame) -> DataFrame:
    """Number of children of every dimension and category."""
    nodes = tags.groupBy("dimension", "level2").agg(F.count("level3").alias("children"))
    tops = nodes.groupBy("dimension").agg(F.count(F.lit(1)).alias("children"))
    return tops.select("dimension", F.lit("").alias("level2"), "children").unionByName(nodes)
