"""Read manifests, metadata, frames and annotations of many datasets at once.

The dataset of a row is the directory its file lies in, relative to the root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill import schemas
from tracemill.functions.paths import chunk_from_path, episode_from_path
from tracemill.operators.positions import dense_position
from tracemill.sources.snapshots import ROWS as FILE_ROWS
from tracemill.sources.snapshots import committed_root

# Fixed value: the annotation format with a flat list of actions.
ANNOTATION_VERSION = "3.0.0"


def manifest_entries(documents: DataFrame) -> DataFrame:
    """(dataset, weight) from manifest documents in column ``value``.

    A document is an object {dataset: weight} or a bare list of datasets.
    """
    as_map = F.from_json("value", schemas.MANIFEST)
    names = F.from_json("value", "array<string>")
    as_list = F.map_from_arrays(names, F.array_repeat(F.lit(1.0), F.size(names)))
    is_list = F.startswith(F.trim("value"), F.lit("["))
    return documents.select(F.explode(F.when(is_list, as_list).otherwise(as_map)).alias("dataset", "weight"))


def read_manifest(spark: SparkSession, path) -> DataFrame:
    return manifest_entries(spark.read.text(path, wholetext=True))


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """A manifest written by ``write_manifest``, read entry by entry."""
    pair = F.regexp_replace("value", r"^[{,]|\}$", "")
    entry = F.from_json(F.concat(F.lit("{"), pair, F.lit("}")), schemas.MANIFEST)
    return spark.read.text(path).select(F.explode(entry).alias("dataset", "weight"))


def _plain(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _dataset(root: str, inner: str) -> Column:
    """Part of the file path between the root and the inner part of a dataset."""
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    below = F.substring_index(_plain(F.col("_metadata.file_path")), base + "/", -1)
    return F.regexp_replace(below, inner + "$", "")


def _found(reader, pattern: str):
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def read_info(spark: SparkSession, root: str) -> DataFrame:
    """One row per ``meta/info.json``. Combine with ``attach_info`` for the missing ones."""
    root = committed_root(spark, root)
    rows = _found(spark.read.schema(schemas.INFO).option("multiLine", True), "info.json").json(root)
    return rows.select(_dataset(root, "/meta/info.json").alias("dataset"), "*")


def _read_lines_as(spark, root, name, schema, skip_malformed) -> DataFrame:
    """Lines of a metadata file; a long one goes on in ``<name>-1.jsonl`` and so on."""
    mode = "DROPMALFORMED" if skip_malformed else "FAILFAST"
    root = committed_root(spark, root)
    rows = _found(spark.read.schema(schema).option("mode", mode), f"{name}{{,-[0-9]*}}.jsonl").json(root)
    return rows.select(_dataset(root, f"/meta/{name}(-[0-9]+)?[.]jsonl").alias("dataset"), "*")


def read_tasks(spark: SparkSession, root: str, skip_malformed: bool = False) -> DataFrame:
    return _read_lines_as(spark, root, "tasks", schemas.TASK, skip_malformed)


def read_episodes(spark: SparkSession, root: str, skip_malformed: bool = False) -> DataFrame:
    return _read_lines_as(spark, root, "episodes", schemas.EPISODE, skip_malformed)


def read_episode_stats(spark: SparkSession, root: str, skip_malformed: bool = False) -> DataFrame:
    return _read_lines_as(spark, root, "episodes_stats", schemas.EPISODE_STATS, skip_malformed)


def read_file_names(spark: SparkSession, root: str, folder: str, names: str = "*") -> DataFrame:
    """(dataset, path): files in one folder of every dataset; their contents are not read."""
    root = committed_root(spark, root)
    rows = _found(spark.read.format("binaryFile"), names).load(root).select(F.col("path"))
    below = F.substring_index(_plain(F.col("path")), root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/", -1)
    pattern = rf"^(.*)/({folder}/[^/]+)$"
    return rows.filter(below.rlike(pattern)).select(
        F.regexp_extract(below, pattern, 1).alias("dataset"), F.regexp_extract(below, pattern, 2).alias("path"))


def read_numbered_lines(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(dataset, line, value) with the physical line number from 1.

    A large file is read in several splits. Each line is numbered inside its
    split, and the line counts of the earlier splits of the file are added.
    """
    raw = _found(spark.read, name).text(root).select(
        _dataset(root, f"/meta/{name}").alias("dataset"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seq"),
        "value",
    )
    placed = dense_position(raw, ["dataset"], ["_seq"], "line", block=F.col("_start"))
    return placed.select("dataset", (F.col("line") + 1).alias("line"), "value")


class FeatureConflict(ValueError):
    """Datasets state different types for one feature."""


def feature_conflicts(info: DataFrame) -> DataFrame:
    """(feature, kinds): features whose type differs, each type with a dataset that states it.

    Sizes may differ, types may not. Taken from the info of the datasets, so no data file is opened.
    """
    stated = info.select("dataset", F.explode("features").alias("feature", "f")).groupBy("feature", "f.dtype").agg(
        F.min("dataset").alias("dataset"))
    kinds = stated.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("dtype", "dataset"))).alias("kinds"))
    return kinds.filter(F.size("kinds") > 1)


def read_frames(spark: SparkSession, root: str, columns=(), info: DataFrame | None = None) -> DataFrame:
    """Frames of all episode files, only the columns asked for.

    ``episode_index`` and ``chunk`` come from the file name, ``frame_index`` is the row position in
    the episode. Datasets may have different features: the footers of all files are read by parallel
    tasks, and a column that a file lacks is null there. Columns of different types raise
    :class:`FeatureConflict`, which names the datasets that ``info`` (or their info files) state.
    """
    root = committed_root(spark, root)
    try:
        rows = _found(spark.read.option("mergeSchema", True), "episode_*.parquet").parquet(root)
    except Exception as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        found = feature_conflicts(read_info(spark, root) if info is None else info).orderBy("feature").limit(20).collect()
        stated = "; ".join(f"{r['feature']}: " + ", ".join(f"{k['dtype']} in {k['dataset']}" for k in r["kinds"]) for r in found)
        raise FeatureConflict(f"features of different types: {stated or error}") from error
    path = _plain(F.col("_metadata.file_path"))
    part = F.coalesce(F.nullif(F.regexp_extract(path, r"-(\d+)\.parquet$", 1), F.lit("")).cast("bigint"), F.lit(0))
    wanted = [c for c in columns if c not in ("episode_index", "frame_index")]
    return rows.select(
        _dataset(root, r"/data/chunk-\d+/[^/]*").alias("dataset"),
        chunk_from_path(path).alias("chunk"),
        episode_from_path(path).alias("episode_index"),
        (F.col("_metadata.row_index") + part * FILE_ROWS).alias("frame_index"),
        *wanted,
    )


def read_bundles(spark: SparkSession, root: str) -> DataFrame:
    """One row per ``dataset.json``."""
    rows = _found(spark.read.schema(schemas.BUNDLE).option("multiLine", True), "dataset.json").json(root)
    return rows.select(_dataset(root, "/dataset.json").alias("dataset"), "*")


def bundle_episodes(bundles: DataFrame) -> DataFrame:
    """Episodes of each bundle with the recording id at the same place."""
    pairs = F.arrays_zip(F.col("episodes").alias("e"), F.col("recording_ids").alias("recording_id"))
    rows = bundles.select("dataset", F.posexplode(pairs).alias("position", "p"))
    return rows.filter(F.col("p.e").isNotNull()).select(
        "dataset", "position", F.col("p.recording_id").alias("recording_id"), "p.e.*"
    )


def bundle_files(bundles: DataFrame) -> DataFrame:
    return bundles.select("dataset", F.explode("files").alias("f")).select("dataset", "f.*")


def _actions(text: Column) -> Column:
    """Actions of either format as one array; null when there is no annotation."""
    flat = F.from_json(text, schemas.ANNOTATION_V3)
    nested = F.transform(
        F.from_json(text, schemas.ANNOTATION_LEGACY)["annotation"]["actionAnnotationList"],
        lambda a: F.struct(
            a["start"].alias("start_time"),
            a["end"].alias("end_time"),
            a["description"].alias("action"),
            F.lit(None).cast("string").alias("action_english"),
        ),
    )
    none = F.array().cast(schemas.ACTIONS)
    return F.when(flat["version"] == ANNOTATION_VERSION, flat["data"]).otherwise(F.coalesce(nested, none))


def parse_annotations(documents: DataFrame, text: str = "annotation", empty_is_none: bool = True) -> DataFrame:
    """Replace annotation documents of either version by one ``actions`` array.

    A fetched annotation without any action counts as no annotation.
    """
    rows = documents.filter(F.col(text).isNotNull()).withColumn("actions", _actions(F.col(text))).drop(text)
    return rows.filter(F.size("actions") > 0) if empty_is_none else rows.filter(F.col("actions").isNotNull())


def read_annotations(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, recording_id, actions) from every ``annotations.json``."""
    files = _found(spark.read.option("wholetext", True), "annotations.json").text(root).select(
        _dataset(root, "/annotations.json").alias("dataset"), "value"
    )
    entries = files.select("dataset", F.explode(F.from_json("value", "map<string,string>")).alias("id", "annotation"))
    return parse_annotations(
        entries.select("dataset", F.col("id").cast("bigint").alias("recording_id"), "annotation")
    )


def embedded_annotations(episodes: DataFrame) -> DataFrame:
    """Annotations carried by episode rows, one row per annotated episode.

    None unless ``annotation_data`` is an object with ``version`` and ``data``.
    The id and time of the annotation are copied; its own annotator name is used
    where the data has none. An empty action list still is an annotation.
    """
    text = F.col("annotation.annotation_data")
    keys = F.json_object_keys(text)
    valid = F.array_contains(keys, "version") & F.array_contains(keys, "data")
    inner = F.from_json(text, "id bigint, created_at string, annotator_name string")
    return episodes.filter(F.coalesce(valid, F.lit(False))).select(
        "dataset",
        "recording_id",
        F.coalesce(F.col("annotation.id"), inner["id"]).alias("id"),
        F.coalesce(F.col("annotation.created_at"), inner["created_at"]).alias("created_at"),
        F.coalesce(inner["annotator_name"], F.col("annotation.annotator_name")).alias("annotator_name"),
        _actions(text).alias("actions"),
    )
