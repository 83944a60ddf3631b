"""Builds that pass the gate, and one failing fixture for each of its rules."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracemill.plans import build
from tracemill.sources import readers
from tracemill.sources.snapshots import GateError, NotCommitted

KINDS = "features map<string, struct<dtype: string, shape: array<bigint>>>"


def tables(table, **change):
    """Two datasets with a good and a questionable episode each; ``change`` spoils one thing in ``bad``."""
    frames, episodes = [], []
    for d in ("bad", "good"):
        for e, n in enumerate((4, 6)):
            spoilt = d == "bad"
            for f in range(n):
                stamp = f / 10 + (0.3 if spoilt and change.get("jump") and f == n - 1 else 0.0)
                move = [float(f % 3), 1.0 if spoilt and change.get("frozen") else float(f % 2)]
                if not (spoilt and change.get("lost") and e == 1):
                    frames.append((d, 10 * e, e, f, stamp, move))
            episodes.append((d, 10 * e, e, n + (2 if spoilt and change.get("length") else 0)))
    size = lambda d: [480, 640, 3] if d == "bad" and change.get("camera") else [240, 320, 3]
    info = [(d, 2, 10, 5, 10, {"timestamp": ("double", [1]), "action": ("double", [2]), "cam": ("video", size(d))}) for d in ("bad", "good")]
    words = [(d, i, t) for d in ("bad", "good") for i, t in enumerate(["unknown", "擦" if d == "bad" and change.get("chinese") else "wipe"])
             if not (d == "bad" and change.get("no_tasks"))]
    return {
        "frames": table(frames, "dataset string, recording_id bigint, episode_index bigint, frame_index bigint, timestamp double, action array<double>"),
        "episodes": table(episodes, "dataset string, recording_id bigint, episode_index bigint, length bigint"),
        "info": table(info, "dataset string, total_episodes bigint, total_frames bigint, chunks_size bigint, fps bigint, " + KINDS),
        "tasks": table(words, "dataset string, task_index bigint, task string"),
    }


def test_good_tables_are_committed(spark, table, tmp_path):
    path = str(tmp_path / "snap")
    commit = build.publish(tables(table), path, strict=True)
    assert commit["frames"] == 20 and readers.read_frames(spark, path).count() == 20
    assert rows(readers.read_info(spark, path), "dataset", "total_frames") == [("bad", 10), ("good", 10)]


RULES = [("length", "frame_integrity", "warn"), ("lost", "file_count", "fail"), ("chinese", "english_tasks", "warn"), ("no_tasks", "required_files", "fail"),
         ("jump", "time_steps", "warn"), ("frozen", "frozen_action", "warn"), ("camera", "camera_resolution", "fail")]


@pytest.mark.parametrize("change, rule, status", RULES)
def test_each_rule_sees_its_fault_and_the_gate_acts(spark, table, tmp_path, monkeypatch, change, rule, status):
    path, seen = str(tmp_path / "snap"), []
    real = build.doctor_staged

    def noted(staged, **options):
        checks = real(staged, **options).cache()
        seen.extend(checks.filter("status <> 'pass'").select("dataset", "rule", "status").collect())
        return checks

    monkeypatch.setattr(build, "doctor_staged", noted)
    spoilt = tables(table, **{change: True})
    with pytest.raises(GateError, match="the first ones are bad"):
        build.publish(spoilt, path, strict=True)
    assert ("bad", rule, status) in [tuple(r) for r in seen] and {r.dataset for r in seen} == {"bad"}
    with pytest.raises(NotCommitted):
        readers.read_info(spark, path)
    if status == "warn":
        assert build.publish(spoilt, path)["datasets"] == 2
    else:
        with pytest.raises(GateError):
            build.publish(spoilt, path)


def test_counts_must_agree_with_the_info(table, tmp_path):
    some = tables(table)
    with pytest.raises(GateError, match="but the info states"):
        build.publish({**some, "episodes": some["episodes"].filter("episode_index = 0")}, str(tmp_path / "a"))
    with pytest.raises(GateError, match="no frames"):
        build.publish({**some, "frames": some["frames"].filter(F.lit(False))}, str(tmp_path / "b"))


def test_gate_looks_at_every_clean_recording(spark):
    """Every dataset of the lake gets a verdict, and one with a recording without frames fails; no quota hides it."""
    import __spark_entry__ as entry

    found = [r["status"] for r in entry.queries()["VER6_gate"](spark, "/root/testdata/sf0.001").collect()]
    assert (found.count("fail"), found.count("warn"), len(found)) == (12, 12, 24)
