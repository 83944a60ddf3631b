"""Splits, recipes and sampling weights."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracemill.functions.paths import match_group
from tracemill.operators import sampling, split

EPISODES = "dataset string, recording_id bigint, episode_index bigint, length bigint"


def episodes(table):
    return table([(d, 1000 * i + e, e, 10 + e) for i, (d, n) in enumerate([("a", 300), ("b", 40), ("c", 1)]) for e in range(n)], EPISODES)


def test_split_is_complete_disjoint_and_renumbered(table):
    sided = split.split_by_hash(episodes(table), 0.8)
    assert sided.count() == 341
    assert rows(sided) == rows(split.split_by_hash(episodes(table), 0.8))
    numbered = split.split_episodes(sided)
    for key, group in _grouped(numbered):
        assert sorted(r.episode_index for r in group) == list(range(len(group))), key
        ordered = sorted(group, key=lambda r: r.episode_index)
        assert [r.old_episode_index for r in ordered] == sorted(r.old_episode_index for r in group)
    share = sided.filter("split = 'train'").count() / 341
    assert 0.7 < share < 0.9


def _grouped(df):
    found = {}
    for r in df.collect():
        found.setdefault((r.dataset, r.split), []).append(r)
    return found.items()


@pytest.mark.parametrize("ratio", [0.0, 1.0, -0.1])
def test_ratio_must_lie_between(table, ratio):
    with pytest.raises(ValueError):
        split.split_by_hash(episodes(table), ratio)


def test_split_manifest_skips_empty_sides_and_done_datasets(table):
    manifest = table([("x/a", 2.0), ("x/b", 1.0)], "dataset string, weight double")
    sided = table([("x/a", "train"), ("x/a", "val"), ("x/b", "train")], "dataset string, split string")
    assert rows(split.split_manifest(manifest, sided), "dataset", "weight") == [
        ("x/a_split/train", 2.0), ("x/a_split/val", 2.0), ("x/b_split/train", 1.0)]
    done = table([("x/a",)], "dataset string")
    assert rows(split.pending(manifest, done), "dataset") == [("x/b",)]


def test_recipe(table):
    prompts = table([("p", 60), ("q", 30)], "class string, available bigint")
    tags = table([("s", 50), ("t", 50)], "class string, available bigint")
    plan = split.recipe_plan(prompts, tags, {"prompt": {"p": 1.0, "q": 2.0}, "tag": {"t": 0.0}})
    assert rows(plan, "side", "class", "total", "quota") == [
        ("prompt", "p", 50, 25), ("prompt", "q", 50, 25), ("tag", "s", 50, 50), ("tag", "t", 50, 0)]


def test_recipe_without_classes_gives_nothing(table):
    none = table([], "class string, available bigint")
    plan = split.recipe_plan(table([("p", 60)], "class string, available bigint"), none, {})
    assert rows(plan, "class", "total", "quota") == [("p", 0, 0)]


def test_recipe_samples_are_exact(spark, table):
    recordings = spark.range(3000).select(F.col("id").alias("recording_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise("x").alias("task"))
    assert split.recipe_sample(recordings, 123).count() == 123
    assert split.recipe_sample(recordings, 99999).count() == 3000
    quotas = table([("hot", 700), ("x", 10)], "class string, quota bigint")
    got = split.recipe_sample_by_class(recordings, quotas, "task").groupBy("task").count()
    assert rows(got) == [("hot", 700), ("x", 10)]


GROUPED = "dataset string, frames bigint, grp string"


def test_targets_of_the_worked_example():
    got = sampling.group_targets({"a": (0.1, 1.0, True), "b": (2, 0.7), "c": (1, 0.7)})
    assert got == pytest.approx({"a": 0.1, "b": 0.6, "c": 0.3})


@pytest.mark.parametrize("config", [
    {"a": (0.7, 1, True), "b": (0.4, 1, True)}, {"a": (-0.1, 1, True)}, {"a": (0, 1)}, {"a": (1,)}])
def test_bad_configs(config):
    with pytest.raises(ValueError):
        sampling.group_targets(config)


def test_weights_reach_their_targets(table):
    data = [("p1", 100, "a"), ("p2", 900, "a"), ("q", 5000, "b"), ("r", 10, "c"), ("s", 77, "_other")]
    config = {"a": (2.0, 0.5), "b": (1.0, 1.0), "c": (0.0, 1.0), "empty": (1.0, 1.0)}
    weights = {r.dataset: r.weight for r in sampling.sampling_weights(table(data, GROUPED), config).collect()}
    assert set(weights) == {"p1", "p2", "q"}
    sampled = {d: f * weights[d] for d, f, _ in data if d in weights}
    total = sum(sampled.values())
    assert (sampled["p1"] + sampled["p2"]) / total == pytest.approx(2 / 3)
    assert sampled["p2"] / sampled["p1"] == pytest.approx(3.0)
    assert 0.01 <= min(weights.values()) < 0.1


def test_weight_errors(table):
    with pytest.raises(Exception, match="no config for group"):
        sampling.sampling_weights(table([("p", 1, "a")], GROUPED), {"b": (1, 1)}).collect()
    with pytest.raises(Exception, match="without frames"):
        sampling.sampling_weights(table([("p", 0, "a")], GROUPED), {"a": (1, 1)}).collect()


def test_missing_info(table):
    manifest = table([("a", 1.0), ("b", 1.0)], "dataset string, weight double")
    info = table([("a", 5)], "dataset string, frames bigint")
    assert rows(sampling.attach_info(manifest, info, "zero"), "dataset", "frames") == [("a", 5), ("b", 0)]
    assert rows(sampling.attach_info(manifest, info, "skip"), "dataset") == [("a",)]
    with pytest.raises(Exception, match="no info"):
        sampling.attach_info(manifest, info, "error").collect()
    with pytest.raises(ValueError):
        sampling.attach_info(manifest, info, "else")


def test_shares_of_nothing(table):
    out = sampling.sampling_shares(table([("a", 1.0, 0), ("b", 3.0, 0)], "dataset string, weight double, frames bigint"))
    assert rows(out, "dataset", "weight_share", "frame_share", "sampled_share") == [("a", 0.25, 0.0, 0.0), ("b", 0.75, 0.0, 0.0)]


def test_rules_as_table_and_as_expression_agree(table):
    sets = table([("x/PickPlace",), ("x/Wipe_drawer",), ("x/none",)], "dataset string")
    rules = [("pick", ["PickPlace", "Wipe"]), ("late", ["Wipe", "drawer"])]
    listed = table([(i, g, k) for i, (g, ks) in enumerate(rules) for k in ks], "rule_order int, grp string, keyword string")
    assert rows(sampling.match_group_table(sets, listed)) == rows(sets.withColumn("grp", match_group(F.col("dataset"), rules)))
