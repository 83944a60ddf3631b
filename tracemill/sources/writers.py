"""Write manifests and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def seed_manifest(datasets: DataFrame) -> DataFrame:
    """Weight 1 for every exported dataset."""
    return datasets.select("dataset", F.lit(1.0).alias("weight"))


def merge_manifests(*manifests: DataFrame) -> DataFrame:
    """All entries of several manifests; the last manifest naming a dataset wins."""
    rows = None
    for place, manifest in enumerate(manifests):
        part = manifest.select("dataset", "weight", F.lit(place).alias("_place"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("dataset").agg(F.max_by("weight", "_place").alias("weight"))


def manifest_lines(manifest: DataFrame) -> DataFrame:
    """Lines which, joined in order, are one JSON object {dataset: weight}.

    The sorted table stays distributed: only its first and last name are looked
    up, to place the braces.
    """
    ends = manifest.agg(F.struct(F.min("dataset").alias("first"), F.max("dataset").alias("last"))).scalar()
    entry = F.to_json(F.create_map("dataset", "weight"))
    pair = F.substring(entry, F.lit(2), F.length(entry) - 2)
    return (
        manifest.withColumn("_ends", ends)
        .select(
            "dataset",
            F.concat(
                F.when(F.col("dataset") == F.col("_ends.first"), "{").otherwise(","),
                pair,
                F.when(F.col("dataset") == F.col("_ends.last"), "}").otherwise(""),
            ).alias("value"),
        )
        .orderBy("dataset")
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The part files, concatenated by name, form the JSON object."""
    manifest_lines(manifest).select("value").write.mode("errorifexists").text(path)


def write_report(report: DataFrame, path: str, form: str = "csv", bom: bool = False) -> None:
    """A report table as CSV with header or as JSON lines.

    ``bom`` marks the CSV header so that spreadsheets read it as UTF-8.
    """
    writer = report.write.mode("errorifexists")
    if form == "json":
        writer.json(path)
    elif form == "csv":
        if bom:
            first = report.columns[0]
            writer = report.withColumnRenamed(first, "﻿" + first).write.mode("errorifexists")
        writer.option("header", True).csv(path)
    else:
        raise ValueError(f"report form {form!r} is neither csv nor json")
