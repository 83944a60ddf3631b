"""Snapshots written and read back, refused, interrupted and replaced."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracemill.sources import readers, snapshots
from tracemill.sources.snapshots import GateError, NotCommitted, write_snapshot

FRAMES = "dataset string, split string, recording_id bigint, episode_index bigint, frame_index bigint, task_index bigint, state array<double>"
LENGTHS = {("desk/a & b", "train"): [3, 1, 4], ("desk/a & b", "val"): [2], ("c+d", "train"): [5]}


@pytest.fixture
def tables(table):
    frames = [(d, s, 100 * e, e, f, f % 2, [float(f), 1.0]) for (d, s), n in LENGTHS.items() for e, k in enumerate(n) for f in range(k)]
    episodes = [(d, s, e, k, ["擦 it", "x"]) for (d, s), n in LENGTHS.items() for e, k in enumerate(n)]
    info = [(d, s, len(n), sum(n), 2 if d == "c+d" else 1, f"0:{len(n)}", 30) for (d, s), n in LENGTHS.items()]
    words = [(d, i, t) for d in ("desk/a & b", "c+d") for i, t in enumerate(["unknown", "擦 it"])]
    return {
        "frames": table(frames, FRAMES).repartition(4),
        "episodes": table(episodes, "dataset string, split string, episode_index bigint, length bigint, tasks array<string>").repartition(3),
        "info": table(info, "dataset string, split string, total_episodes bigint, total_frames bigint, chunks_size bigint, range string, fps bigint"),
        "tasks": table(words, "dataset string, task_index bigint, task string"),
    }


def test_round_trip_and_layout(spark, tables, tmp_path):
    path = str(tmp_path / "snap")
    commit = write_snapshot(tables, path)
    assert {k: commit[k] for k in ("frames", "episodes", "datasets", "tasks", "files")} == {
        "frames": 15, "episodes": 5, "datasets": 3, "tasks": 6, "files": 5 + 9}
    found = sorted(os.path.relpath(f, f"{path}/{commit['version']}") for f in glob.glob(f"{path}/{commit['version']}/**/*.*", recursive=True)
                   if not f.endswith(".crc"))
    side = "desk/a & b_split/train"
    assert [f for f in found if f.startswith(side)] == sorted(
        [f"{side}/data/chunk-00{e}/episode_00000{e}.parquet" for e in range(3)]
        + [f"{side}/meta/{n}" for n in ("info.json", "tasks.jsonl", "episodes.jsonl")])
    assert "c+d_split/train/data/chunk-000/episode_000000.parquet" in found
    info = json.load(open(f"{path}/{commit['version']}/{side}/meta/info.json", encoding="utf-8"))
    assert info["total_frames"] == 8 and info["splits"] == {"train": "0:3"} and info["data_path"] == snapshots.DATA_PATH
    assert info["features"]["state"] == {"dtype": "double", "shape": []} and "dataset" not in info["features"]
    lines = [json.loads(x) for x in open(f"{path}/{commit['version']}/{side}/meta/episodes.jsonl", encoding="utf-8")]
    assert [x["episode_index"] for x in lines] == [0, 1, 2] and lines[0]["tasks"] == ["擦 it", "x"]

    folder = lambda d, s: f"{d}_split/{s}"
    back = readers.read_frames(spark, path, ["recording_id", "task_index", "state"])
    wanted = [(folder(d, s), e // (2 if d == "c+d" else 1), e, f, 100 * e, f % 2, [float(f), 1.0])
              for (d, s), n in LENGTHS.items() for e, k in enumerate(n) for f in range(k)]
    assert sorted(tuple(r) for r in back.collect()) == sorted(wanted)
    assert rows(readers.read_info(spark, path), "dataset", "total_episodes") == sorted((folder(*k), len(n)) for k, n in LENGTHS.items())
    assert rows(readers.read_episodes(spark, path), "dataset", "episode_index", "length") == sorted(
        (folder(*k), e, x) for k, n in LENGTHS.items() for e, x in enumerate(n))
    assert readers.read_tasks(spark, path).count() == 6


def test_unsplit_tables_and_long_episodes_go_on_in_further_files(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "ROWS", 4)
    monkeypatch.setattr(readers, "FILE_ROWS", 4)
    frames = table([("d", 7, f, f * f) for f in range(11)], "dataset string, episode_index bigint, frame_index bigint, mark bigint").repartition(5)
    episodes = table([("d", e, 11) for e in range(10)], "dataset string, episode_index bigint, length bigint")
    path = str(tmp_path / "snap")
    commit = write_snapshot({"frames": frames, "episodes": episodes, "info": table([("d", 5)], "dataset string, chunks_size int")}, path)
    names = sorted(os.path.basename(f) for f in glob.glob(f"{path}/{commit['version']}/d/*/**", recursive=True) if os.path.isfile(f) and not f.endswith("crc"))
    assert names == ["episode_000007-1.parquet", "episode_000007-2.parquet", "episode_000007.parquet", "episodes-1.jsonl",
                     "episodes-2.jsonl", "episodes.jsonl", "info.json"]
    assert rows(readers.read_frames(spark, path, ["mark"]), "chunk", "episode_index", "frame_index", "mark") == sorted(
        [(1, 7, f, f * f) for f in range(11)], key=repr)
    assert rows(readers.read_episodes(spark, path), "dataset", "episode_index") == [("d", e) for e in range(10)]


def test_a_write_that_dies_leaves_the_former_version(spark, tables, tmp_path, monkeypatch):
    path = str(tmp_path / "snap")
    moved = []
    real = snapshots._Store.rename

    def dies(store, source, target):
        if len(moved) == 4:
            raise KeyboardInterrupt("killed")
        moved.append(target)
        real(store, source, target)

    monkeypatch.setattr(snapshots._Store, "rename", dies)
    with pytest.raises(KeyboardInterrupt):
        write_snapshot(tables, path)
    assert len(moved) == 4 and glob.glob(f"{path}/v-*")
    for read in (readers.read_info, readers.read_frames, readers.read_episodes, readers.read_tasks):
        with pytest.raises(NotCommitted):
            read(spark, path)
    monkeypatch.setattr(snapshots._Store, "rename", real)
    first = write_snapshot(tables, path)
    assert readers.read_frames(spark, path).count() == 15

    monkeypatch.setattr(snapshots, "_move_all", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt("killed")))
    with pytest.raises(KeyboardInterrupt):
        write_snapshot({**tables, "frames": tables["frames"].filter("frame_index = 0")}, path)
    assert snapshots.commit_of(spark, path) == first and readers.read_frames(spark, path).count() == 15
    assert snapshots.remove_uncommitted(spark, path) == 2 and readers.read_frames(spark, path).count() == 15


def test_the_gate_decides(spark, tables, tmp_path):
    path = str(tmp_path / "snap")
    seen = []

    def refuse(staged):
        seen.append((staged.counts, readers.read_frames(spark, staged.root).count()))
        raise GateError("no")

    with pytest.raises(GateError):
        write_snapshot(tables, path, refuse)
    assert seen == [({"frames": 15, "unplaced": 0, "datasets": 3, "episodes": 5, "tasks": 6}, 15)]
    with pytest.raises(NotCommitted):
        readers.read_frames(spark, path)
    first = write_snapshot(tables, path)
    second = write_snapshot({**tables, "frames": tables["frames"].filter("frame_index = 0")}, path)
    assert first["version"] != second["version"] and readers.read_frames(spark, path).count() == 5


def test_frames_need_a_place_and_a_chunk_size(spark, tables, tmp_path):
    with pytest.raises(GateError, match="frame_index"):
        write_snapshot({**tables, "frames": tables["frames"].withColumn("frame_index", F.nullif("frame_index", F.lit(4)))}, str(tmp_path / "a"))
    with pytest.raises(Exception, match="no chunks_size for dataset"):
        write_snapshot({**tables, "info": tables["info"].filter("dataset = 'c+d'")}, str(tmp_path / "b"))


def test_datasets_with_different_features(spark, table, tmp_path):
    info, episodes = "dataset string, chunks_size int", "dataset string, episode_index bigint, length bigint"
    place = "dataset string, episode_index bigint, frame_index bigint"

    def put(name, frames):
        root = str(tmp_path / "lake" / name)
        write_snapshot({"frames": frames, "episodes": table([(name, 0, 2)], episodes), "info": table([(name, 10)], info)}, root)
        version = snapshots.commit_of(spark, root)["version"]
        os.rename(f"{root}/{version}/{name}", str(tmp_path / "plain" / name))

    os.makedirs(tmp_path / "plain")
    put("a", table([("a", 0, f, float(f), f) for f in range(2)], place + ", gripper double, n bigint"))
    put("b", table([("b", 0, f, f) for f in range(2)], place + ", n bigint"))
    root = str(tmp_path / "plain")
    assert rows(readers.read_frames(spark, root, ["gripper", "n"]), "dataset", "gripper", "n") == [
        ("a", 0.0, 0), ("a", 1.0, 1), ("b", None, 0), ("b", None, 1)]
    assert readers.feature_conflicts(readers.read_info(spark, root)).count() == 0
    put("c", table([("c", 0, f, "x") for f in range(2)], place + ", gripper string"))
    with pytest.raises(readers.FeatureConflict, match="gripper: double in a, string in c"):
        readers.read_frames(spark, root, ["gripper"])


def test_driver_moves_no_episode_files(spark, monkeypatch):
    """There is a file per episode, so the tasks that write them also put them in their place."""
    from tracemill.sources import snapshots
    from workload import q_files

    moved, real = [], snapshots._move_all
    monkeypatch.setattr(snapshots, "_move_all", lambda store, moves: real(store, (m for m in moves if not moved.append(m))))
    path = q_files.stored(spark, "/root/testdata/sf0.001")
    assert moved and not [target for _, target in moved if "/data/" in target]
    assert snapshots.commit_of(spark, path)["files"] > len(moved)
