"""Readers and writers against directories made by hand."""

import glob
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracemill.operators.quality import (
    chinese_report, chinese_summary, chinese_tasks, parse_task_lines, unreadable_datasets,
)
from tracemill.operators.sampling import attach_info
from tracemill.sources import readers, writers

DATASETS = ("desk/a & b/dataset_1", "desk/c+d")


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def root(tmp_path):
    base = str(tmp_path / "data")
    for n, name in enumerate(DATASETS):
        meta = f"{base}/{name}/meta"
        put(f"{meta}/info.json", json.dumps({
            "total_episodes": 2, "total_frames": 5 + n, "fps": 30, "chunks_size": 1,
            "features": {"cam": {"dtype": "video", "shape": [240, 320]}}, "splits": {"train": "0:2"}}, indent=2))
        put(f"{meta}/tasks.jsonl", '{"task_index": 0, "task": "unknown"}\n\n{"task_index": 1, "task": "擦 it"}\n')
        put(f"{meta}/episodes.jsonl", "\n".join(json.dumps({
            "episode_index": e, "length": 2 + e, "tasks": ["x"], "annotation": {
                "recording_id": 10 * n + e, "id": 4, "annotator_name": "me",
                "annotation_data": {"version": "3.0.0", "data": []}}}) for e in range(2)))
        put(f"{meta}/episodes_stats.jsonl", '{"episode_index": 0, "stats": {"a": {"max": [1]}}}\n')
        for e in range(2):
            path = f"{base}/{name}/data/chunk-{e:03d}/episode_{e:06d}.parquet"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            pd.DataFrame({"episode_index": [7] * (2 + e), "task_index": range(2 + e), "state": [[1.0, 2.0]] * (2 + e)}).to_parquet(path)
        put(f"{base}/{name}/annotations.json", json.dumps({
            "1": {"version": "3.0.0", "data": [{"start_time": 0, "end_time": 1, "action": "n", "action_english": "e"}]},
            "2": {"annotation": {"actionAnnotationList": [{"start": 1, "end": 2.5, "description": "old"}]}},
            "3": None, "4": {"version": "3.0.0", "data": []}}))
        put(f"{base}/{name}/dataset.json", json.dumps({
            "task_name": "a+b", "info": {"fps": 30}, "tasks": [], "recording_ids": [5, 6],
            "episodes": [{"episode_index": 0, "length": 2}, {"episode_index": 1, "length": 3}],
            "files": [{"path": "data/chunk-000/episode_000000.parquet", "type": "data", "download_url": ""}]}))
    return base


def test_manifests(spark, tmp_path):
    put(str(tmp_path / "m1.json"), '{"x/a": 2,\n "x/b": 0.5}')
    put(str(tmp_path / "m2.json"), '["x/c", "x/d"]')
    assert rows(readers.read_manifest(spark, str(tmp_path))) == [("x/a", 2.0), ("x/b", 0.5), ("x/c", 1.0), ("x/d", 1.0)]


def test_written_manifest_is_one_json_object(spark, table, tmp_path):
    entries = {f'ds "{i}" 桌': i / 4 for i in range(50)}
    manifest = table(list(entries.items()), "dataset string, weight double").repartition(7)
    path = str(tmp_path / "out")
    writers.write_manifest(manifest, path)
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*")))
    assert json.loads(text) == entries
    assert rows(readers.read_manifest_lines(spark, path)) == rows(manifest)


def test_metadata(spark, root):
    info = readers.read_info(spark, root)
    assert rows(info, "dataset", "total_frames", "fps") == [(DATASETS[0], 5, 30), (DATASETS[1], 6, 30)]
    assert info.select(F.col("features")["cam"]["shape"][0]).first()[0] == 240
    manifest = info.select("dataset", F.lit(1.0).alias("weight"))
    assert attach_info(manifest, info.select("dataset", F.col("total_frames").alias("frames"))).count() == 2
    assert rows(readers.read_tasks(spark, root), "task_index", "task") == [(0, "unknown")] * 2 + [(1, "擦 it")] * 2
    assert rows(readers.read_episodes(spark, root), "length") == [(2,), (2,), (3,), (3,)]
    assert json.loads(readers.read_episode_stats(spark, root).first().stats) == {"a": {"max": [1]}}


def test_malformed_lines(spark, root):
    put(f"{root}/{DATASETS[1]}/meta/tasks.jsonl", '{"task_index": 0, "task": "ok"}\n{oops\n\n{"task_index": 2, "task": "擦"}\n')
    with pytest.raises(Exception):
        readers.read_tasks(spark, root).collect()
    assert readers.read_tasks(spark, root, skip_malformed=True).count() == 4
    lines = readers.read_numbered_lines(spark, root, "tasks.jsonl")
    found = chinese_tasks(parse_task_lines(lines))
    assert rows(found, "dataset", "line", "task_index", "chinese") == [
        (DATASETS[0], 3, 1, ["擦"]), (DATASETS[1], 4, 2, ["擦"])]


def test_unreadable_file_is_reported(spark, root, table):
    path = f"{root}/{DATASETS[1]}/meta/tasks.jsonl"
    with open(path, "ab") as f:
        f.write(b'{"task_index": 5, "task": "\xff\xfe"}\n')
    lines = readers.read_numbered_lines(spark, root, "tasks.jsonl")
    manifest = table([(DATASETS[0],), (DATASETS[1],), ("gone",)], "dataset string")
    report = chinese_report(manifest, parse_task_lines(lines), unreadable_datasets(lines))
    assert rows(report, "dataset", "status") == [(DATASETS[0], "has_chinese"), (DATASETS[1], "error"), ("gone", "not_found")]
    assert chinese_summary(report).first().asDict() == {
        "total": 3, "no_chinese": 0, "has_chinese": 1, "not_found": 1, "error": 1, "passed": False}


def test_line_numbers_run_over_file_splits(spark, tmp_path):
    put(str(tmp_path / "d/meta/tasks.jsonl"), "".join(f"line {i}\n" for i in range(1, 2001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = readers.read_numbered_lines(spark, str(tmp_path), "tasks.jsonl")
        assert spark.read.text(str(tmp_path / "d/meta")).rdd.getNumPartitions() > 3
        got = lines.orderBy("line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", opened)
    assert [(r.line, r.value) for r in got] == [(i, f"line {i}") for i in range(1, 2001)]


def test_frames(spark, root):
    frames = readers.read_frames(spark, root, ["task_index"])
    assert frames.columns == ["dataset", "chunk", "episode_index", "frame_index", "task_index"]
    assert rows(frames.filter(F.col("dataset") == DATASETS[0]), "chunk", "episode_index", "frame_index", "task_index") == [
        (0, 0, 0, 0), (0, 0, 1, 1), (1, 1, 0, 0), (1, 1, 1, 1), (1, 1, 2, 2)]
    plan = frames._jdf.queryExecution().executedPlan().toString()
    assert "task_index" in plan.split("ReadSchema")[1] and "state" not in plan.split("ReadSchema")[1]


def test_annotations(spark, root):
    got = readers.read_annotations(spark, root).filter(F.col("dataset") == DATASETS[1])
    assert {r.recording_id: [tuple(a) for a in r.actions] for r in got.collect()} == {
        1: [(0.0, 1.0, "n", "e")], 2: [(1.0, 2.5, "old", None)]}


def test_embedded_annotations(table):
    data = [
        (1, (9, "now", "me", '{"version": "3.0.0", "data": [{"start_time": 0, "end_time": 1, "action": "n"}]}')),
        (2, (9, None, "me", '{"version": "3.0.0", "data": [], "annotator_name": "you", "id": 3}')),
        (3, (9, "now", "me", '{"version": "3.0.0"}')), (4, (9, "now", "me", '"text"')), (5, (9, "now", "me", None)), (6, None),
        (7, (None, None, None, '{"version": "1", "data": 5}')),
    ]
    episodes = table([("d", r, a) for r, a in data], """dataset string, recording_id bigint,
        annotation struct<id: bigint, created_at: string, annotator_name: string, annotation_data: string>""")
    got = readers.embedded_annotations(episodes).select("recording_id", "id", "created_at", "annotator_name", F.size("actions").alias("n"))
    assert rows(got) == [(1, 9, "now", "me", 1), (2, 9, None, "you", 0), (7, None, None, None, 0)]


def test_bundles_pair_by_position(spark, root):
    bundles = readers.read_bundles(spark, root)
    first = readers.bundle_episodes(bundles).filter(F.col("dataset") == DATASETS[0])
    assert rows(first, "position", "recording_id", "length") == [(0, 5, 2), (1, 6, 3)]
    assert rows(readers.bundle_files(bundles), "type") == [("data",), ("data",)]


def test_reports(spark, table, tmp_path):
    report = table([("桌", 1)], "name string, n bigint").coalesce(1)
    writers.write_report(report, str(tmp_path / "csv"), bom=True)
    text = "".join(open(p, "rb").read().decode() for p in glob.glob(str(tmp_path / "csv/part-*")))
    assert text == "﻿name,n\n桌,1\n"
    writers.write_report(report, str(tmp_path / "json"), "json")
    assert rows(spark.read.schema("name string, n bigint").json(str(tmp_path / "json"))) == [("桌", 1)]
    with pytest.raises(ValueError):
        writers.write_report(report, str(tmp_path / "x"), "xml")


def test_merging_manifests(table):
    a = table([("x", 1.0), ("y", 1.0)], "dataset string, weight double")
    b = table([("y", 5.0)], "dataset string, weight double")
    assert rows(writers.merge_manifests(a, b)) == [("x", 1.0), ("y", 5.0)]
    assert rows(writers.seed_manifest(b)) == [("y", 1.0)]


def test_steps_are_deleted_with_their_block(spark):
    import os

    from tracemill.session import materialise, shared_dir, temporary_steps

    def steps():
        return {f for f in os.listdir(shared_dir(spark).removeprefix("file:")) if f.startswith("step-")}

    before = steps()
    with temporary_steps(spark):
        assert materialise(spark.range(5)).count() == 5
        assert len(steps() - before) == 1
    assert steps() == before
    materialise(spark.range(1))
    assert len(steps() - before) == 1
