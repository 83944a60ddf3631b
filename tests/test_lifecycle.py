"""Lake filters, versions, registry, exports and builds."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracemill.operators import compose, lake, registry, versions
from tracemill.plans import build, export

VERSIONS = "dataset string, seq bigint, version string, status string, recordings bigint, note string, creator string"


def history(table):
    return table([
        ("d", 1, "v1", "archived", 3, "", "x"), ("d", 2, "v2", "active", 4, "", "x"), ("d", 3, "v3", "draft", 5, "", "x"),
        ("e", 1, "beta", "active", 1, "", "x")], VERSIONS)


def test_publish(table):
    ask = lambda *pairs: table(list(pairs), "dataset string, version string")
    out = versions.publish(history(table), ask(("d", "v3")))
    assert rows(out.filter("dataset = 'd'"), "version", "status") == [("v1", "archived"), ("v2", "archived"), ("v3", "active")]
    same = versions.publish(history(table), ask(("d", "v1"), ("e", "nothing")))
    assert rows(same) == rows(history(table))


def test_process_then_publish_leaves_one_active(table):
    runs = table([], "run_id string, pipeline string, name string, target string, status string, trigger string, by string, at timestamp_ntz")
    wanted = table([("d", "split", 9, ""), ("e", "split", 9, "why")], "dataset string, operator string, recordings bigint, note string")
    after, records = versions.process(history(table), runs, wanted, "me", "2026-01-01 00:00:00")
    assert rows(after.filter("status = 'draft'"), "dataset", "version", "note") == [
        ("d", "v3", ""), ("d", "v4", "processed by split"), ("e", "beta.1", "why")]
    assert rows(records, "trigger", "by", "status") == [("manual", "me", "done")] * 2
    live = versions.publish(after, table([("d", "v4"), ("e", "beta.1")], "dataset string, version string"))
    assert rows(live.filter("status = 'active'"), "dataset", "version") == [("d", "v4"), ("e", "beta.1")]


def test_rollback(table):
    out = versions.rollback(history(table), table([("d", "v1"), ("e", "gone")], "dataset string, version string"), "me")
    assert rows(out.filter("creator = 'me'"), "version", "status", "recordings", "seq") == [("v4", "draft", 3, 4)]
    assert rows(versions.next_versions(history(table)), "dataset", "version") == [("d", "v4"), ("e", "v1")]


def test_version_events(table):
    events = table([("d", "v1", 1, "draft"), ("d", "v1", 2, "active")], "dataset string, version string, seq bigint, status string")
    assert rows(versions.version_history(events), "version", "status") == [("v1", "active")]


def test_tag_modes(table):
    df = table([(1, ["a", "b"]), (2, ["a"]), (3, [])], "id bigint, tags array<string>")
    ids = lambda mode: rows(df.filter(lake.tag_filter(F.col("tags"), ["a", "b"], mode)), "id")
    assert ids("any") == [(1,), (2,)]
    assert ids("all") == [(1,)]
    with pytest.raises(ValueError):
        lake.tag_filter(F.col("tags"), ["a"], "some")


def at(day, hour=0):
    return datetime.datetime(2026, 5, day, hour)


def test_last_day_counts_whole(table):
    df = table([(1, at(20, 23)), (2, at(21, 12)), (3, at(22, 23)), (4, at(23))], "id bigint, at timestamp_ntz")
    assert rows(df.filter(lake.day_range(F.col("at"), "2026-05-21", "2026-05-22")), "id") == [(2,), (3,)]
    exact = lake.time_range(F.col("at"), from_time="2026-05-21 13:00:00", from_date="2026-05-01", to_date="2026-05-22")
    assert rows(df.filter(exact), "id") == [(3,)]
    ends = lake.time_range(F.col("at"), to_time="2026-05-21 12:00:00", to_date="2026-05-30")
    assert rows(df.filter(ends), "id") == [(1,), (2,)]


def test_export_selection(table):
    df = table([(1, "pass", False), (2, "fail", False), (3, None, False), (4, None, True)], "recording_id bigint, qa string, mistake boolean")
    df = df.withColumn("collected_at", F.lit("2026-01-01").cast("timestamp_ntz"))
    ids = lambda **k: rows(lake.export_selection(df, **k), "recording_id")
    assert ids() == [(1,)]
    assert ids(include_unchecked=True) == [(1,), (3,)]
    assert ids(invalid_only=True) == [(2,)]


def test_limits_and_pages(spark):
    df = spark.range(100).select(F.col("id").alias("recording_id"), F.lit("2026-01-01").cast("timestamp_ntz").alias("at"))
    assert rows(lake.recording_limit(df, 3)) == rows(df.filter("recording_id < 3"))
    many = spark.range(25_000).select(((F.col("id") * 92_233_720_368_547) - 2**60).alias("recording_id"))
    for n in (0, 1, 30, 9_999, 10_001, 24_999, 25_000, 30_000):
        got = lake.recording_limit(many, n)
        assert got.agg(F.count("recording_id"), F.max("recording_id")).first() == (
            min(n, 25_000), (min(n, 25_000) - 1) * 92_233_720_368_547 - 2**60 if n else None)
    ties = spark.range(10).select(F.lit(7).cast("bigint").alias("recording_id"))
    assert lake.recording_limit(ties, 4).count() == 4
    assert [r.recording_id for r in lake.page(df, 2, "at", "recording_id").collect()] == list(range(40, 60))
    assert rows(lake.with_page(df, "at", "recording_id").groupBy("page").count()) == [(p, 20) for p in range(5)]


def test_pinned_annotation(table):
    df = table([(1, "v1", "a"), (1, "v2", "b"), (2, "v1", "c")], "recording_id bigint, version string, text string")
    assert rows(lake.latest_annotation(df, ["recording_id"], "version"), "text") == [("b",), ("c",)]
    assert rows(lake.latest_annotation(df, ["recording_id"], "version", pinned="v1"), "text") == [("a",), ("c",)]


def test_empty_scope(table):
    none = table([], "qa string, frames bigint")
    assert lake.scope_summary(none).first().asDict() == {
        "episodes": 0, "frames": 0, "n_pass": 0, "n_warn": 0, "n_fail": 0, "minutes": 0.0, "hours": 0.0}


def test_taxonomy(table):
    dims = table([
        ("action", ["take", "put"], None), ("object", None, [("tool", ["pen", "saw"]), ("none", [])])],
        "dimension string, leaves array<string>, groups array<struct<category: string, items: array<string>>>")
    flat = registry.flatten_tags(dims)
    assert tuple(registry.taxonomy_counts(flat).first()) == (2, 4, 2)
    assert rows(registry.taxonomy_children(flat)) == [
        ("action", "", 2), ("action", "put", 0), ("action", "take", 0), ("object", "", 2), ("object", "none", 0), ("object", "tool", 2)]


def test_feature_directories(table):
    from tracemill.functions.numbers import features_hash

    df = table([(1, {"a": "x"}), (2, {"a": "x"}), (3, {"a": "x", "b": "y"}), (4, {})], "collection_id bigint, features map<string,string>")
    names = compose.feature_group_names(compose.feature_groups(df, features_hash)).collect()
    assert sorted(n.collections for n in names) == [1, 2]
    assert sorted(n.name.split("_")[1] for n in names) == ["0", "1"]


FRAMES = "dataset string, recording_id bigint, frame_index bigint, task_index bigint"
EPISODES = """dataset string, recording_id bigint, episode_index bigint, length bigint, tasks array<string>,
    task_id_map map<string,string>, dagger_type string"""


def lab(table):
    episodes = table([("d", r, r, 2, ["b"] if r % 2 else ["a"], None, "teleop") for r in range(1, 9)], EPISODES)
    frames = table([("d", r, f, 0) for r in range(1, 9) for f in range(2)], FRAMES)
    return episodes, frames


def test_export_modes(table):
    episodes, frames = lab(table)
    chosen = episodes.filter("recording_id > 4").select("recording_id")
    info = table([("d", 30, 3, 2)], "dataset string, fps int, chunks_size int, cameras int")
    out = export.export_dataset(chosen, episodes, frames, info=info)
    assert rows(out["frames"], "index", "recording_id", "task_index") == [(i, 5 + i // 2, 2 if i // 2 % 2 == 0 else 1) for i in range(8)]
    assert out["info"].first().total_tasks == 3
    assert out["info"].first().total_chunks == 2
    two = export.export_dataset(chosen, episodes, frames, info=info, limit=2)
    assert rows(two["episodes"], "recording_id") == [(5,), (6,)]
    dagger = export.export_dataset(chosen, episodes, frames, mode="dagger", dagger_type="teleop", info=info)
    assert rows(dagger["frames"], "index", "task_index") == rows(out["frames"], "index", "task_index")
    with pytest.raises(ValueError):
        export.export_dataset(chosen, episodes, frames, mode="other", info=info)


def test_build_gate(table):
    episodes, frames = lab(table)
    recordings = episodes.select("recording_id", F.lit("pass").alias("qa"), F.lit("t").alias("task"))
    tasks = table([("d", 0, "unknown")], "dataset string, task_index bigint, task string")
    leaked = table([(3,)], "recording_id bigint")
    info = table([("d", 30, 3, 2)], "dataset string, fps int, chunks_size int, cameras int")
    built = build.build_dataset(recordings, episodes, frames, tasks, leaked, info, n=7, ratio=0.5, qas=["pass"])
    assert built["episodes"].filter("recording_id = 3").isEmpty()
    assert built["episodes"].count() == 7
    build.require_pass(built["verdict"])
    lost = build.build_dataset(recordings, episodes, frames.filter("recording_id <> 5"), tasks, leaked, info, n=7, ratio=0.5)
    with pytest.raises(build.GateError):
        build.require_pass(lost["verdict"])


def test_several_requests_for_one_dataset(table):
    history = table([("d", 8, "v8", "active", 1, "", "u"), ("d", 9, "v9", "draft", 2, "", "u"), ("d", 10, "v10", "draft", 3, "", "u"),
                     ("e", 1, "first", "active", 1, "", "u")], VERSIONS)
    wanted = table([("d", "v9"), ("d", "v10"), ("e", "none")], "dataset string, version string")
    states = {r.version: r.status for r in versions.publish(history, wanted).collect()}
    assert states == {"v8": "archived", "v9": "draft", "v10": "active", "first": "active"}
    back = versions.rollback(history, wanted, "me").filter("creator = 'me'")
    assert rows(back, "seq", "version", "recordings") == [(11, "v11", 2), (12, "v12", 3)]
    runs = table([], "run_id string, pipeline string, name string, target string, status string, trigger string, by string, at timestamp_ntz")
    jobs = table([("d", "split", 4, ""), ("d", "filter", 5, ""), ("e", "split", 6, "n"), ("e", "zip", 7, "n")],
                 "dataset string, operator string, recordings bigint, note string")
    drafts, records = versions.process(history, runs, jobs, "me", "2026-01-01 00:00:00")
    made = drafts.filter("creator = 'me'")
    assert rows(made, "dataset", "seq", "version", "recordings") == [
        ("d", 11, "v11", 5), ("d", 12, "v12", 4), ("e", 2, "first.1", 6), ("e", 3, "first.2", 7)]
    assert records.select("run_id").distinct().count() == 4


def test_keyset_pages_equal_pages_with_ties(table):
    """Many rows share a time; every page, the short last one and pages beyond it."""
    import datetime

    moments = [datetime.datetime(2024, 1, 1 + (n * n) % 3, (n % 5) // 4) for n in range(95)]
    df = table([(n * 7 % 95, t) for n, t in enumerate(moments)] + [(200, None)], "recording_id bigint, at timestamp_ntz").repartition(4)
    known = df.filter("at IS NOT NULL")
    for number in (0, 1, 4, 5, 9, 10):
        got = [tuple(r) for r in lake.keyset_page(df, number, "at", "recording_id", 10).collect()]
        assert got == [tuple(r) for r in lake.page(known, number, "at", "recording_id", 10).collect()]
        assert len(got) == (10 if number < 9 else 5 if number == 9 else 0)
    plan = lake.keyset_page(df, 9, "at", "recording_id", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "GlobalLimit" in plan and "Window" not in plan
