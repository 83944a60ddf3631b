"""Committed snapshots: dataset directories that appear all at once or not at all.

Below the folder of a snapshot every write has a version folder of its own, ``v-<id>``, with one
directory per dataset as training tools expect it::

    <dataset>/meta/info.json, tasks.jsonl, episodes.jsonl, episodes_stats.jsonl
    <dataset>/data/chunk-000/episode_000000.parquet

A dataset that has been split has a directory ``<dataset>_split/<side>`` per side. The file
``COMMIT`` names the version that counts. It is written last, under another name, and renamed, so
a job that dies leaves the former version in force, and a folder no commit names is never read.

An episode of more than ``ROWS`` frames, and metadata of more than ``ROWS`` lines, continue in
further files (``episode_000000-1.parquet``, ``episodes-1.jsonl``): no task writes more than that.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Names inside a dataset directory, and the pattern its info states.
INFO, TASKS, EPISODES, STATS = "info.json", "tasks.jsonl", "episodes.jsonl", "episodes_stats.jsonl"
DATA_PATH = "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet"

COMMIT = "_COMMITTED"
#: Frames of a data file and lines of a metadata file at most.
ROWS = 1 << 20
#: Renames under way at a time.
RENAMES = 32


class NotCommitted(ValueError):
    """A folder has versions, but none of them was committed."""


class GateError(ValueError):
    """What was staged must not be published."""


class _Store:
    """The file system of a folder; classes are looked up once, as each look-up asks the JVM."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._jvm = context._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self.system = self._path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(name)

    def uri(self, name: str) -> str:
        return self._path(name).makeQualified(self.system.getUri(), self.system.getWorkingDirectory()).toUri().toString()

    def read_text(self, name: str) -> str | None:
        if not self.system.exists(self._path(name)):
            return None
        stream = self.system.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str, over: bool = True) -> None:
        stream = self.system.create(self._path(name), over)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create_text(self, name: str, text: str) -> None:
        """Write a file that must not be there; fails if it is."""
        self.write_text(name, text, over=False)

    def files(self, folder: str) -> Iterator[str]:
        """Files below a folder, one folder after another; nothing but names is asked for."""
        if not self.system.exists(self._path(folder)):
            return
        waiting = [self._path(folder)]
        while waiting:
            for found in self.system.listStatus(waiting.pop()):
                if found.isDirectory():
                    waiting.append(found.getPath())
                else:
                    yield found.getPath().toString()

    def versions(self, folder: str) -> list[str]:
        if not self.system.exists(self._path(folder)):
            return []
        names = [s.getPath().getName() for s in self.system.listStatus(self._path(folder)) if s.isDirectory()]
        return [n for n in names if n.startswith("v-")]

    def make(self, folder: str) -> None:
        self.system.mkdirs(self._path(folder))

    def delete(self, name: str) -> None:
        self.system.delete(self._path(name), True)

    def rename(self, source: str, target: str) -> None:
        if not self.system.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def replace(self, source: str, target: str) -> None:
        """Rename over what is there. Where a file system cannot do it in one step, the old file goes first."""
        if not self.system.rename(self._path(source), self._path(target)):
            self.delete(target)
            self.rename(source, target)


def commit_of(spark: SparkSession, path: str) -> dict | None:
    """What the commit file of a snapshot says, null without one."""
    text = _Store(spark, path).read_text(f"{path.rstrip('/')}/{COMMIT}")
    return None if text is None else json.loads(text)


def committed_root(spark: SparkSession, path: str) -> str:
    """The folder to read: the committed version of a snapshot, or the folder itself if it is none.

    A folder that has versions without a commit is refused.
    """
    path = path.rstrip("/")
    if any(c in path for c in "*?[{"):
        return path
    commit = commit_of(spark, path)
    if commit is not None:
        return f"{path}/{commit['version']}"
    if _Store(spark, path).versions(path):
        raise NotCommitted(f"{path} has no committed version")
    return path


def remove_uncommitted(spark: SparkSession, path: str) -> int:
    """Delete the versions that no commit names; not while a write is under way. Their number."""
    commit, store = commit_of(spark, path), _Store(spark, path)
    gone = [n for n in store.versions(path) if commit is None or n != commit["version"]]
    for name in gone:
        store.delete(f"{path.rstrip('/')}/{name}")
    return len(gone)


def _folder(columns) -> Column:
    return F.concat("dataset", F.lit("_split/"), "split") if "split" in columns else F.col("dataset")


def _keys(columns) -> list[str]:
    return [c for c in ("dataset", "split") if c in columns]


def feature_types(frames: DataFrame) -> dict[str, tuple[str, list[int]]]:
    """Type and shape of every feature column, as the info of a dataset states them."""
    out = {}
    for field in frames.schema.fields:
        if field.name not in ("dataset", "split"):
            kind = field.dataType.simpleString()
            out[field.name] = (kind.removeprefix("array<").removesuffix(">"), [] if kind.startswith("array<") else [1])
    return out


def _features(frames: DataFrame) -> Column:
    entries = [F.struct(F.lit(n).alias("key"), F.struct(F.lit(t).alias("dtype"), F.lit(s).cast("array<bigint>").alias("shape")).alias("value"))
               for n, (t, s) in feature_types(frames).items()]
    return F.map_from_entries(F.array(*entries))


def _lines(table: DataFrame, name: str, order: Column) -> DataFrame:
    """(folder, file, part, seq, value): the rows of a table as the lines of its files."""
    fields = [c for c in table.columns if c not in ("dataset", "split")]
    stem, end = name.rsplit(".", 1)
    part = F.floor(order / ROWS)
    file = F.when(part == 0, F.lit(name)).otherwise(F.concat(F.lit(stem + "-"), part.cast("string"), F.lit("." + end)))
    return table.select(_folder(table.columns).alias("folder"), file.alias("file"), order.cast("bigint").alias("seq"),
                        F.to_json(F.struct(*fields)).alias("value"))


def metadata_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """All metadata files as one table of lines.

    ``info`` has one row per dataset (and side); tasks are those of the dataset on both sides.
    """
    info = tables["info"].drop("data_path")
    if "range" in info.columns and "splits" not in info.columns and "split" in info.columns:
        info = info.withColumn("splits", F.create_map("split", "range")).drop("range")
    if "features" not in info.columns:
        info = info.withColumn("features", _features(tables["frames"]))
    kinds = [_lines(info.withColumn("data_path", F.lit(DATA_PATH)), INFO, F.lit(0)),
             _lines(tables["episodes"], EPISODES, F.col("episode_index"))]
    if "tasks" in tables:
        tasks = tables["tasks"].join(info.select(*_keys(info.columns)), "dataset")
        kinds.append(_lines(tasks, TASKS, F.col("task_index")))
    if "episode_stats" in tables:
        kinds.append(_lines(tables["episode_stats"], STATS, F.col("episode_index")))
    return reduce(DataFrame.unionByName, kinds)


def _move_all(store: _Store, moves: Iterator[tuple[str, str]]) -> int:
    """Rename files inside one file system, ``RENAMES`` at a time; nothing is held of those that are done."""
    made: set[str] = set()
    count, running = 0, set()
    with ThreadPoolExecutor(RENAMES) as pool:
        for source, target in moves:
            parent = target.rsplit("/", 1)[0]
            if parent not in made:
                if len(made) > 100_000:
                    made.clear()
                store.make(parent)
                made.add(parent)
            if len(running) >= 2 * RENAMES:
                done, running = wait(running, return_when=FIRST_COMPLETED)
                for each in done:
                    each.result()
            running.add(pool.submit(store.rename, source, target))
            count += 1
        for each in running:
            each.result()
    return count


def _parts(path: str, names) -> dict[str, str]:
    """The values of partition directories in a path."""
    found = dict(p.split("=", 1) for p in path.split("/") if "=" in p and p.split("=", 1)[0] in names)
    return {k: unquote(v) for k, v in found.items()}


def _observed(counted: Observation, names) -> dict[str, int]:
    """What was counted; a plan that Spark knows to be empty is cut away and counts nothing."""
    try:
        return {k: int(v) for k, v in counted.get.items()}
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


PLACE = ("__folder", "__chunk", "__episode", "__part")


def _episode_writer(base: str, names: list[str]):
    """Write the sorted rows of a task as episode files in their final place; one row with what was written."""
    def write(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem, FileType

        system, root = FileSystem.from_uri(base)
        made, done = set(), {"frames": 0, "unplaced": 0, "files": 0}
        place = writer = None

        def finish():
            folder, chunk, episode, part = place
            name = f"episode_{episode:06d}.parquet" if part == 0 else f"episode_{episode:06d}-{part}.parquet"
            target = f"{root}/{folder}/data/chunk-{chunk:03d}/{name}"
            writer.close()
            if system.get_file_info(target).type == FileType.File:  # an earlier attempt of the task
                system.delete_file(target)
            system.move(hidden, target)
            done["files"] += 1

        for batch in batches:
            folders, others = batch.column(PLACE[0]).dictionary_encode(), [batch.column(c) for c in PLACE[1:]]
            done["unplaced"] += others[2].null_count
            codes = [folders.indices.to_numpy(), *(c.fill_null(-1).to_numpy() for c in others)]
            cuts = np.concatenate([[0], np.flatnonzero(np.any([np.diff(c) != 0 for c in codes], axis=0)) + 1, [batch.num_rows]])
            rows = batch.select(names)
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                at = (folders[low].as_py(), *(c[low].as_py() for c in others))
                done["frames"] += high - low
                if high == low or at[3] is None:
                    continue
                if at != place:
                    if writer is not None:
                        finish()
                    place, parent = at, f"{root}/{at[0]}/data/chunk-{at[1]:03d}"
                    if parent not in made:
                        system.create_dir(parent, recursive=True)
                        made.add(parent)
                    hidden = f"{parent}/.{uuid.uuid4().hex}"
                    writer = pq.ParquetWriter(hidden, rows.schema, filesystem=system, compression="zstd")
                writer.write_batch(rows.slice(low, high - low))
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_pylist([done], schema=pa.schema([(k, pa.int64()) for k in done]))

    return write


def _write_frames(frames: DataFrame, info: DataFrame, base: str) -> dict[str, int]:
    """All episode files, written by the tasks that hold their rows, and what was counted.

    Nothing is renamed or listed by the driver, as there is a file per episode. A file gets its name once it is whole.
    """
    keys = _keys(frames.columns)
    sizes = info.select(*_keys(info.columns), F.col("chunks_size").alias("__size"))
    joined = frames.join(sizes, [k for k in keys if k in sizes.columns], "left")
    size = F.coalesce("__size", F.raise_error(F.concat(F.lit("no chunks_size for dataset "), F.col("dataset"))).cast("bigint"))
    placed = (
        joined.withColumn("__folder", _folder(frames.columns))
        .withColumn("__chunk", F.floor(F.col("episode_index") / size))
        .withColumn("__episode", F.col("episode_index").cast("bigint"))
        .withColumn("__part", F.floor(F.col("frame_index") / ROWS))
        .drop("__size", *keys)
    )
    # a file is one task's: rows are dealt by file, and files are small
    dealt = placed.repartition("__folder", "__episode", "__part").sortWithinPartitions(*PLACE, "frame_index")
    names = [c for c in placed.columns if c not in PLACE]
    found = dealt.mapInArrow(_episode_writer(base, names), "frames long, unplaced long, files long").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("frames", "unplaced", "files")]).first()
    return found.asDict()


def _stage_metadata(lines: DataFrame, staged: str, observed: Observation) -> None:
    kinds = {"datasets": INFO, "episodes": "episodes", "tasks": "tasks"}
    counted = lines.observe(observed, *[
        F.coalesce(F.count_if((F.col("file") == n) | F.rlike("file", F.lit(f"^{n}(-[0-9]+)?[.]jsonl$"))), F.lit(0)).alias(k)
        for k, n in kinds.items()])
    dealt = counted.repartition("folder", "file").sortWithinPartitions("folder", "file", "seq")
    dealt.drop("seq").write.partitionBy("folder", "file").text(f"{staged}/meta")


def _moves(store: _Store, staged: str, version: str) -> Iterator[tuple[str, str]]:
    for source in store.files(f"{staged}/meta"):
        if source.endswith(".txt"):
            at = _parts(source, ("folder", "file"))
            yield source, f"{version}/{at['folder']}/meta/{at['file']}"


@dataclass
class Staged:
    """A version that is written but not committed, for a gate to look at."""

    spark: SparkSession
    root: str
    #: Counted while the version was written: frames, unplaced (frames without a place), datasets, episodes, tasks.
    counts: dict[str, int]


def write_snapshot(tables: dict[str, DataFrame], path: str, gate: Callable[[Staged], None] | None = None) -> dict:
    """Write a new version of a snapshot and commit it.

    ``tables`` holds frames (dataset, episode_index, frame_index, features), episodes, info with the
    ``chunks_size`` of each dataset and, where there are any, tasks and episode_stats; frames,
    episodes and info may be split by a column ``split``. The ``gate`` sees the staged version, with
    what was counted while it was written, and raises to refuse it; the former version then stays.
    Returns what the commit file says.
    """
    spark = tables["frames"].sparkSession
    path = path.rstrip("/")
    name = f"v-{uuid.uuid4().hex}"
    version, staged = f"{path}/{name}", f"{path}/{name}/_staged"
    metadata, store = Observation(), _Store(spark, path)
    written = _write_frames(tables["frames"], tables["info"], store.uri(version))
    _stage_metadata(metadata_lines(tables), staged, metadata)
    counts = {"frames": written["frames"], "unplaced": written["unplaced"], **_observed(metadata, ("datasets", "episodes", "tasks"))}
    if counts["unplaced"]:
        raise GateError(f"{counts['unplaced']} frames have no frame_index")
    files = written["files"] + _move_all(store, _moves(store, staged, version))
    store.delete(staged)
    if gate is not None:
        gate(Staged(spark, version, counts))
    commit = {"version": name, "files": files, **counts}
    store.write_text(f"{path}/{COMMIT}-{name}", json.dumps(commit))
    store.replace(f"{path}/{COMMIT}-{name}", f"{path}/{COMMIT}")
    return commit
