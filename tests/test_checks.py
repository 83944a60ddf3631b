"""Quality checks and motion analysis on hand-made signals."""

import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tracemill.operators import motion, quality

EPISODES = "dataset string, recording_id bigint, length bigint"


def test_integrity(table):
    manifest = table([("a", 1.0), ("b", 1.0), ("c", 1.0)], "dataset string, weight double")
    episodes = table([("a", 1, 2), ("b", 2, 2)], EPISODES)
    frames = table([("a", 1), ("a", 1), ("b", 2)], "dataset string, recording_id bigint")
    assert rows(quality.frame_integrity(manifest, episodes, frames), "dataset", "status") == [("a", "ok"), ("b", "problem"), ("c", "skipped")]
    assert rows(quality.length_mismatches(episodes, frames)) == [("a", 1, 0), ("b", 1, 1)]
    lost = quality.file_count_check(episodes, frames.filter("dataset = 'a'"))
    assert rows(lost, "dataset", "ok") == [("a", True), ("b", False)]


def test_first_offenders(table):
    tasks = table([("a", i, i, "擦" * (i + 1)) for i in range(5)] + [("b", 0, 0, "桌")], "dataset string, line bigint, task_index bigint, task string")
    out = quality.first_offenders(quality.chinese_tasks(tasks))
    assert rows(out, "dataset", "rank", "more") == [("a", 1, 2), ("a", 2, 2), ("a", 3, 2), ("b", 1, 0)]
    out.collect()
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_time_steps(table):
    times = [0.0, 1 / 30, 2 / 30, 2 / 30, 5 / 30]
    frames = table([(1, i, t) for i, t in enumerate(times)], "episode bigint, frame_index bigint, t double")
    out = quality.time_steps(frames, ["episode"], "frame_index", "t", 30).first()
    assert (out.frames, out.not_rising, out.jumps) == (5, 1, 1)


def test_frozen_dimensions(table):
    vectors = table([("a", [float(i), 5.0, 0.0]) for i in range(4)], "k string, v array<double>")
    out = quality.frozen_dimensions(vectors, ["k"], "v", exempt=[2])
    assert rows(out, "dim", "frozen") == [(0, False), (1, True), (2, False)]


def test_cameras(table):
    features = table([("a", "c1", 240, 320), ("a", "c2", 240, 320), ("b", "c1", 480, 640)], "dataset string, camera string, height int, width int")
    assert rows(quality.camera_resolution(features), "dataset", "ok") == [("a", True), ("b", False)]


def test_doctor(table):
    checks = table([
        ("a", "r1", "pass", 0, 10), ("a", "r2", "warn", 1, 8), ("b", "r1", "warn", None, None), ("b", "r2", "fail", None, None),
        ("c", "r1", "pass", None, None), ("c", "r2", "pass", 0, 0)], "dataset string, rule string, status string, bad bigint, n bigint")
    assert rows(quality.doctor_report(checks), "dataset", "rule", "pct", "colour") == [
        ("a", "r1", 100, "ok"), ("a", "r2", 88, "warn"), ("b", "r1", 96, "warn"), ("b", "r2", 82, "bad"),
        ("c", "r1", 100, "ok"), ("c", "r2", 100, "ok")]
    assert rows(quality.doctor_verdict(checks)) == [("a", "warn", "partly failing"), ("b", "fail", "must fix"), ("c", "pass", "may train")]


def test_required_files(table):
    sets = table([("a",), ("b",)], "dataset string")
    files = table([("a", p) for p in quality.REQUIRED_FILES] + [("b", "meta/info.json")], "dataset string, path string")
    assert quality.missing_files(sets, files).count() == 4


def test_lag_alignment(table):
    """A state that is the command eight steps late never jitters."""
    cmd = [0.05 * i for i in range(40)] + [2.0] * 10
    data = [(1, i, c, cmd[max(0, i - 8)]) for i, c in enumerate(cmd)]
    out = motion.aligned(table(data, "e bigint, frame_index bigint, cmd double, state double"), ["e"])
    rate = motion.jitter_rate(out, ["e"]).first()
    assert (rate.frames, rate.jitter_frames) == (50, 0)
    assert rate.static_frames == 9
    off = motion.aligned(table([(e, i, c, s + 1) for e, i, c, s in data], "e bigint, frame_index bigint, cmd double, state double"), ["e"])
    assert motion.jitter_rate(off, ["e"]).first().jitter_frames == 41


def test_motion_profile(table):
    data = [(1, i, float(i * i)) for i in range(5)]
    out = motion.motion_profile(table(data, "e bigint, frame_index bigint, x double"), ["e"], ["x"], 10)
    assert rows(out, "frame_index", "x_speed", "x_acceleration") == [
        (0, None, None), (1, 10.0, None), (2, 30.0, 200.0), (3, 50.0, 200.0), (4, 70.0, 200.0)]
    assert motion.tool_speed(out, ["x"], "speed").filter("frame_index = 2").first().speed == 30.0


def test_histogram_and_median(table):
    rng = random.Random(2)
    data = [("hot", rng.choice([1.0, 2.0, rng.random() * 9])) for _ in range(500)] + [("flat", 4.0)] * 6 + [("two", 1.0), ("two", 3.0)]
    df = table(data, "k string, v double")
    medians = {r.k: r.median for r in motion.upper_median(df, ["k"], "v").collect()}
    for key in ("hot", "flat", "two"):
        values = sorted(v for k, v in data if k == key)
        assert medians[key] == values[len(values) // 2]
    counts = motion.histogram(df, ["k"], "v").groupBy("k").agg(F.sum("count").alias("n"), F.max("bin").alias("last"))
    assert rows(counts) == [("flat", 6, 0), ("hot", 500, 29), ("two", 2, 29)]
