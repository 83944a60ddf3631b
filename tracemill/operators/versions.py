"""Dataset versions: history, publishing, rollback, processing.

``versions`` is an append-only table (dataset, seq, version, status, recordings,
note, creator); a higher seq is newer. Requests are tables too, so one job
changes any number of datasets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.functions.numbers import following_version, version_number

# States of a version.
DRAFT, ACTIVE, ARCHIVED = "draft", "active", "archived"


def version_history(events: DataFrame) -> DataFrame:
    """Latest state of each version from the append-only table of its changes."""
    rest = [c for c in events.columns if c not in ("dataset", "version")]
    last = events.groupBy("dataset", "version").agg(F.max_by(F.struct(*rest), "seq").alias("_l"))
    return last.select("dataset", "version", "_l.*")


def publish(versions: DataFrame, requests: DataFrame) -> DataFrame:
    """Make the requested draft the active version of its dataset.

    A request that names no draft changes nothing. Otherwise every active version
    of the dataset is archived, so at most one stays active. Of several requested
    drafts the newest becomes active.
    """
    drafts = versions.filter(F.col("status") == DRAFT).select("dataset", F.col("version").alias("_wanted"), "seq")
    valid = drafts.join(
        requests.select("dataset", F.col("version").alias("_wanted")), ["dataset", "_wanted"], "left_semi"
    )
    chosen = valid.groupBy("dataset").agg(F.max_by("_wanted", "seq").alias("_wanted"))
    status = (
        F.when(F.col("_wanted").isNull(), F.col("status"))
        .when((F.col("version") == F.col("_wanted")) & (F.col("status") == DRAFT), ACTIVE)
        .when(F.col("status") == ACTIVE, ARCHIVED)
        .otherwise(F.col("status"))
    )
    return versions.join(chosen, "dataset", "left").withColumn("status", status).drop("_wanted")


def next_versions(versions: DataFrame) -> DataFrame:
    """v(max + 1) per dataset, v1 when no version has a number."""
    return versions.groupBy("dataset").agg(
        F.concat(F.lit("v"), (F.coalesce(F.max(version_number(F.col("version"))), F.lit(0)) + 1).cast("string")).alias("version"),
        (F.max("seq") + 1).alias("seq"),
    )


def _numbered(requests: DataFrame, *order: str) -> DataFrame:
    """Requests of a dataset numbered from 0 in the column ``_turn``; a dataset has a handful."""
    turns = Window.partitionBy("dataset").orderBy(*order)
    return requests.withColumn("_turn", F.row_number().over(turns) - 1)


def rollback(versions: DataFrame, requests: DataFrame, creator: str) -> DataFrame:
    """Append a draft v(max + 1) that copies the requested version.

    Several requests for one dataset give one draft each, the older version first.
    """
    source = requests.select("dataset", F.col("version").alias("_from")).join(
        versions.select("dataset", F.col("version").alias("_from"), F.col("seq").alias("_old"), "recordings"),
        ["dataset", "_from"],
    )
    added = _numbered(source, "_old").join(next_versions(versions), "dataset").select(
        "dataset", (F.col("seq") + F.col("_turn")).alias("seq"), _later("version", "_turn").alias("version"),
        F.lit(DRAFT).alias("status"), "recordings",
        F.concat(F.lit("rolled back from "), "_from").alias("note"), F.lit(creator).alias("creator"),
    )
    return versions.unionByName(added)


def _later(version: str, turn: str) -> Column:
    """The version ``turn`` steps after ``v<number>``."""
    number = version_number(F.col(version)) + F.col(turn)
    return F.concat(F.lit("v"), number.cast("string"))


def newest(versions: DataFrame) -> DataFrame:
    return versions.groupBy("dataset").agg(
        F.max_by("version", "seq").alias("version"), F.max("seq").alias("seq")
    )


def process(versions: DataFrame, runs: DataFrame, requests: DataFrame, creator: str, at) -> tuple[DataFrame, DataFrame]:
    """Run an operator on datasets: a new draft each, and a run record each.

    ``requests`` is (dataset, operator, recordings, note). Several requests for one
    dataset give a draft each, in the order of operator, recordings and note.
    """
    drafted = _numbered(requests, "operator", "recordings", "note").join(newest(versions), "dataset").withColumn(
        "version", following_version(F.col("version"), F.col("_turn") + 1)
    )
    note = F.coalesce(F.nullif(F.trim("note"), F.lit("")), F.concat(F.lit("processed by "), "operator"))
    added = drafted.select(
        "dataset", (F.col("seq") + 1 + F.col("_turn")).alias("seq"), "version", F.lit(DRAFT).alias("status"),
        "recordings", note.alias("note"), F.lit(creator).alias("creator"),
    )
    records = drafted.select(
        F.concat_ws("_", F.lit("proc"), "dataset", "version").alias("run_id"),
        F.lit("").alias("pipeline"), F.col("operator").alias("name"),
        F.concat_ws(" ", "dataset", "version").alias("target"), F.lit("done").alias("status"),
        F.lit("manual").alias("trigger"), F.lit(creator).alias("by"), F.lit(at).cast("timestamp_ntz").alias("at"),
    )
    return versions.unionByName(added), runs.unionByName(records)


def published(versions: DataFrame) -> DataFrame:
    """Versions a job can refer to: all but drafts."""
    return versions.filter(F.col("status") != DRAFT)


def accepted_changes(versions: DataFrame, changes: DataFrame) -> DataFrame:
    """The changes that were made on the state they found, each with the ``seq`` it gets.

    ``changes`` is (dataset, arrival, based_on, ...): ``based_on`` is the last seq its author had seen. In the
    order of arrival a change is taken if that still is the last one, and becomes the next; any other
    is stale and refused, its author has to look again. A dataset has a handful of changes.
    """
    heads = versions.groupBy("dataset").agg(F.max("seq").alias("_head"))
    listed = changes.groupBy("dataset").agg(F.array_sort(F.collect_list(F.struct("arrival", "based_on"))).alias("_changes"))
    none = F.struct(F.lit(0).cast("bigint").alias("taken"), F.array().cast("array<bigint>").alias("arrivals"))

    def look(state, change):
        fits = change["based_on"] == F.col("_head") + state["taken"]
        return F.struct(
            (state["taken"] + F.when(fits, 1).otherwise(0)).alias("taken"),
            F.when(fits, F.array_append(state["arrivals"], change["arrival"].cast("bigint"))).otherwise(state["arrivals"]).alias("arrivals"))

    taken = listed.join(heads, "dataset").select(
        "dataset", "_head", F.posexplode(F.aggregate("_changes", none, look)["arrivals"]).alias("_place", "arrival"))
    return changes.join(taken, ["dataset", "arrival"]).withColumn("seq", F.col("_head") + 1 + F.col("_place")).drop("_head", "_place")


def replay(versions: DataFrame, changes: DataFrame, creator: str) -> DataFrame:
    """The versions after all accepted changes, which a (kind, version) column pair describes.

    ``publish`` makes a draft active and archives the version that was; the last accepted one wins, so at most
    one is active. ``rollback`` appends a draft that copies a version. Stale changes leave no trace.
    """
    taken = accepted_changes(versions, changes)
    drafts = versions.filter(F.col("status") == DRAFT).select("dataset", "version")
    done = taken.filter(F.col("kind") == "publish").join(drafts, ["dataset", "version"], "left_semi")
    last = done.groupBy("dataset").agg(F.max_by("version", "seq").alias("_active"))
    once = done.select("dataset", "version", F.lit(True).alias("_published")).distinct()
    status = (
        F.when(F.col("version") == F.col("_active"), ACTIVE)
        .when(F.col("_published") | (F.col("_active").isNotNull() & (F.col("status") == ACTIVE)), ARCHIVED)
        .otherwise(F.col("status"))
    )
    kept = versions.join(last, "dataset", "left").join(once, ["dataset", "version"], "left").withColumn("status", status)
    copied = taken.filter(F.col("kind") == "rollback").select("dataset", "version", "seq").join(
        versions.select("dataset", "version", "recordings"), ["dataset", "version"])
    numbered = _numbered(copied, "seq").join(next_versions(versions).withColumnRenamed("version", "_first").drop("seq"), "dataset")
    added = numbered.select(
        "dataset", "seq", _later("_first", "_turn").alias("version"), F.lit(DRAFT).alias("status"), "recordings",
        F.concat(F.lit("rolled back from "), "version").alias("note"), F.lit(creator).alias("creator"))
    names = ["dataset", "seq", "version", "status", "recordings", "note", "creator"]
    return kept.select(*names).unionByName(added.select(*names))
