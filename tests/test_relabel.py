"""Labels and numbering against the rule written out in Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracemill.operators import indices, relabel

FRAMES = "dataset string, recording_id bigint, frame_index bigint, task_index bigint"
NOTES = """dataset string, recording_id bigint,
    actions array<struct<start_time: double, end_time: double, action: string, action_english: string>>"""
EPISODES = """dataset string, recording_id bigint, episode_index bigint, length bigint, tasks array<string>,
    task_id_map map<string,string>, dagger_type string"""


INFO = "dataset string, fps int, chunks_size int, cameras int"


def by_hand(frames, notes, words, fps):
    out = {}
    for (d, r, f, t) in frames:
        label = t
        if (d, r) in notes:
            label = 0
            for start, end, name in notes[d, r]:
                if math.floor(start * fps) <= f <= math.ceil(end * fps):
                    label = words.get(name, 0)
        out[d, r, f] = label
    return sorted((*k, v) for k, v in out.items())


@pytest.mark.parametrize("spread", [4, 4096])
def test_relabel_by_annotation(table, monkeypatch, spread):
    monkeypatch.setattr(relabel, "SPREAD", spread)
    rng = random.Random(spread)
    frames, notes = [], {}
    for rec, n in enumerate([60, 1, 25, 40, 300]):
        frames += [("d", rec, f, 9) for f in range(n)]
        if rec != 2:
            notes["d", rec] = [] if rec == 3 else [
                (s := rng.uniform(0, n / 10), s + rng.uniform(0, 4), rng.choice("abcx")) for _ in range(12)]
    notes["d", 4].append((-1.0, 0.35, "b"))
    notes["d", 4].append((29.0, 1e7, "a"))
    words = [("d", 0, "unknown"), ("d", 1, "a"), ("d", 2, "b"), ("d", 3, "c")]
    docs = [(d, r, [(s, e, "native", name) for s, e, name in a]) for (d, r), a in notes.items()]
    out = relabel.relabel_by_annotation(
        table(frames, FRAMES), table(docs, NOTES), table(words, "dataset string, task_index bigint, task string"),
        table([("d", 10, 1, 1)], INFO))
    wanted = by_hand(frames, notes, {"a": 1, "b": 2, "c": 3, "unknown": 0}, 10)
    assert sorted(tuple(r) for r in out.select("dataset", "recording_id", "frame_index", "task_index").collect()) == wanted


def test_vocabulary_puts_unknown_first_once(table):
    names = table([("d", "b"), ("d", "unknown"), ("d", "a"), ("d", "b"), ("e", "unknown")], "dataset string, task string")
    assert rows(relabel.task_vocabulary(names)) == [
        ("d", 0, "unknown"), ("d", 1, "a"), ("d", 2, "b"), ("e", 0, "unknown")]


WORDS = [("d", 0, "unknown"), ("d", 1, "a"), ("d", 2, "b")]
VOCABULARY = "dataset string, task_index bigint, task string"


def test_relabel_by_prompt(table):
    frames = table([("d", 1, 0, 7), ("d", 1, 1, 8), ("d", 1, 2, 5), ("d", 2, 0, 7)], FRAMES)
    episodes = table([
        ("d", 1, 0, 3, ["a", "b"], {"7": "b", "8": "zzz"}, None), ("d", 2, 1, 1, ["a"], None, None)], EPISODES)
    out = relabel.relabel_by_prompt(frames, episodes, table(WORDS, VOCABULARY))
    assert rows(out, "recording_id", "frame_index", "task_index") == [(1, 0, 2), (1, 1, 0), (1, 2, 0), (2, 0, 1)]


def test_relabel_by_prompt_needs_one_task_without_map(table):
    frames = table([("d", 1, 0, 7)], FRAMES)
    episodes = table([("d", 1, 0, 1, ["a", "b"], {}, None)], EPISODES)
    with pytest.raises(Exception, match="no task_id_map"):
        relabel.relabel_by_prompt(frames, episodes, table(WORDS, VOCABULARY)).collect()


def test_episode_tasks_from_annotation(table):
    episodes = table([("d", 1, 0, 3, ["x"], None, None), ("d", 2, 1, 1, ["y"], None, None)], EPISODES)
    notes = table([("d", 1, [(0.0, 1.0, "n", "b"), (1.0, 2.0, "n2", "")])], NOTES)
    out = relabel.episode_tasks_from_annotation(episodes, notes)
    assert rows(out, "recording_id", "tasks") == [(1, ["b", "n2"]), (2, ["unknown"])]


def test_fix_indices_runs_over_episodes_with_frames(table):
    frames = table([("d", r, f, 0) for r, n in ((5, 3), (9, 2), (2, 1)) for f in range(n)], FRAMES)
    episodes = table([("d", 5, 0, 3), ("d", 7, 1, 4), ("d", 9, 2, 2), ("d", 2, 3, 1)],
                     "dataset string, recording_id bigint, episode_index bigint, length bigint")
    out = indices.fix_indices(frames, episodes)
    assert rows(out, "index", "episode_index", "recording_id", "frame_index") == [
        (0, 0, 5, 0), (1, 0, 5, 1), (2, 0, 5, 2), (3, 2, 9, 0), (4, 2, 9, 1), (5, 3, 2, 0)]
    check = indices.numbering_check(frames, episodes).first()
    assert (check.files, check.metadata_rows, check.mismatches, check.ok) == (3, 4, 0, False)


def test_dagger_subset(table):
    frames = table([("d", r, f, 9) for r in (1, 2, 3) for f in range(r)], FRAMES)
    episodes = table([
        ("d", 1, 0, 1, ["擦: wipe"], None, "teleop"), ("d", 2, 1, 2, ["x"], None, "policy"),
        ("d", 3, 2, 9, ["move", "unknown"], None, "teleop")], EPISODES)
    out = indices.dagger_subset(frames, episodes, "teleop", table([("d", 30, 1, 2)], INFO))
    assert rows(out["tasks"], "task_index", "task") == [(0, "unknown"), (1, "move"), (2, "wipe")]
    assert rows(out["frames"], "index", "episode_index", "recording_id", "task_index") == [
        (0, 0, 1, 2), (1, 1, 3, 1), (2, 1, 3, 1), (3, 1, 3, 1)]
    info = out["info"].first()
    assert (info.total_episodes, info.total_frames, info.total_tasks, info.dagger_type) == (2, 4, 3, "teleop")
    assert (info.total_chunks, info.total_videos, info.fps) == (2, 4, 30)
    with pytest.raises(ValueError, match="no episode"):
        indices.filter_dagger(episodes, "other")


def test_files_follow_their_episode(table):
    files = table([("d", f"data/chunk-000/episode_{e:06d}.parquet", f"http://x/chunk-000/episode_{e:06d}") for e in (0, 3, 4)],
                  "dataset string, path string, download_url string")
    kept = table([("d", 3, 1), ("d", 0, 0)], "dataset string, old_episode_index bigint, episode_index bigint")
    out = indices.renumber_files(files, kept, table([("d", 30, 1, 2)], INFO))
    assert rows(out, "path", "download_url") == [
        ("data/chunk-000/episode_000000.parquet", "http://x/chunk-000/episode_000000"),
        ("data/chunk-001/episode_000001.parquet", "http://x/chunk-001/episode_000001")]
    semi = indices.files_of(files, kept.withColumn("episode_index", F.col("old_episode_index")))
    assert semi.count() == 2


def test_each_dataset_has_its_own_rate(table):
    """The same second is another frame where the camera runs at half the rate."""
    frames = table([(d, 1, f, 0) for d in "ab" for f in range(40)], FRAMES)
    notes = table([(d, 1, [(1.0, 1.1, "", "x")]) for d in "ab"], NOTES)
    info = table([("a", 30, 10, 1), ("b", 15, 10, 1)], INFO)
    out = relabel.frame_actions(frames, relabel.annotation_actions(notes), info).filter("task = 'x'")
    assert rows(out, "dataset", "frame_index") == [("a", f) for f in (30, 31, 32, 33)] + [("b", f) for f in (15, 16, 17)]


def test_relabel_reads_the_frames_once(spark, table):
    frames = table([("a", 1, 0, 0)], FRAMES).withColumn("mark", F.lit("only here"))
    info = table([("a", 30, 10, 1)], INFO)
    notes = table([("a", 1, [(0.0, 1.0, "", "x")])], NOTES)
    words = table([("a", 1, "x")], "dataset string, task_index bigint, task string")
    plan = relabel.relabel_by_annotation(frames, notes, words, info)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("only here") == 1


def test_far_ends_make_no_more_rows_than_the_episode_has_blocks(table, monkeypatch):
    monkeypatch.setattr(relabel, "SPREAD", 4)
    actions = table([("d", 1, p, 1.0, 1e12, f"w{p}") for p in range(50)] + [("d", 1, 50, 0.5, 1.0, "late"), ("d", 2, 0, -3.0, 1e300, "x"),
                     ("d", 3, 0, 0.0, 1.0, "no frames"), ("d", 1, 51, 9.0, 2.0, "ends before it starts")],
                    "dataset string, recording_id bigint, pos int, start_time double, end_time double, task string")
    info, lengths = table([("d", 10, 1, 1)], INFO), table([("d", 1, 22), ("d", 2, 3)], "dataset string, recording_id bigint, n_frames bigint")
    blocks = relabel.block_intervals(relabel.with_rate(actions, info), relabel.EPISODE, "task", lengths)
    got = {(r.recording_id, r._block): [(s["first"], s["last"], s["value"]) for s in r._spans] for r in blocks.collect()}
    assert got == {(1, 1): [(5, 7, "late")], (1, 2): [(8, 10, "late"), (11, 11, "w49")], (1, 3): [(12, 15, "w49")],
                   (1, 4): [(16, 19, "w49")], (1, 5): [(20, 21, "w49")], (2, 0): [(0, 2, "x")]}
    frames = table([("d", 1, f, 0) for f in range(22)], FRAMES)
    labelled = relabel.frame_actions(frames, actions, info, lengths=lengths)
    assert {r.frame_index: r.task for r in labelled.collect()} == {
        f: None if f < 5 else "late" if f < 11 else "w49" for f in range(22)}
