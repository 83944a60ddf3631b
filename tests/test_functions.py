"""Expressions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from tracemill.functions import numbers, paths, recordings, text


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()[0]


@pytest.mark.parametrize("path, wanted", [
    ("desk/1000_Pick&Place_WB_moz1-k02/dataset_0_30_b3", "desk/1000_Pick&Place_WB"),
    ("desk/1000_task_HRPI2-ab1", "desk/1000_task"), ("desk/1000_task_MOZ1-K02", "desk/1000_task"),
    ("desk/plain", "desk/plain"), ("alone_moz1-k02", "alone_moz1-k02"),
])
def test_subcategory(spark, path, wanted):
    assert one(spark, paths.subcategory(F.lit(path))) == wanted


@pytest.mark.parametrize("path, wanted", [
    ("desk/xxx/dataset_0_30_xxx", "desk/xxx"), ("demo/xxx", "demo/xxx"), ("dataset_1", ""), ("a/dataset_1/b", "a/dataset_1/b"),
])
def test_task_folder(spark, path, wanted):
    assert one(spark, paths.task_folder(F.lit(path))) == wanted


def test_match_group_takes_the_first_rule_and_is_literal(spark):
    rules = {"one": "a_b", "two": ["zzz", "a"]}
    assert [one(spark, paths.match_group(F.lit(p), rules)) for p in ("xa_bx", "xaXbx", "A_B", "q")] == ["one", "two", "_other", "_other"]
    assert one(spark, paths.match_group(F.lit("x"), {})) == "_other"


def test_numbers_in_paths(spark):
    path = F.lit("videos/chunk-001/cam/episode_000123.mp4")
    assert one(spark, paths.episode_from_path(path)) == 123
    assert one(spark, paths.chunk_from_path(path)) == 1
    assert one(spark, paths.episode_from_path(F.lit("x/readme"))) is None
    assert one(spark, paths.episode_path(path, F.lit(2345), 1000)) == "videos/chunk-002/cam/episode_002345.mp4"


@pytest.mark.parametrize("task, wanted", [
    ("擦白板: wipe: it ", "wipe: it"), (" no colon ", " no colon "), ("a:", ""), ("中文：full width", "中文：full width"),
])
def test_english_only(spark, task, wanted):
    assert one(spark, text.english_only(F.lit(task))) == wanted


def test_action_name(spark):
    lit = lambda v: F.lit(v).cast("string")
    name = lambda a, e, **k: one(spark, text.action_name(lit(a), lit(e), **k))
    assert name("native", "english") == "english"
    assert name("native", "english", prefer="action") == "native"
    assert name("native", "") == "native"
    assert name(None, "") == "unknown"
    assert name("", "") == ""


def test_chinese(spark):
    assert one(spark, text.find_chinese(F.lit("a擦白b桌"))) == ["擦白", "桌"]
    assert not one(spark, text.contains_chinese(F.lit("é：ñ")))


def test_task_prefix(spark):
    assert one(spark, text.checked_task_prefix(F.lit("ab_1+ab_2"), "ab")) == "ab_1+ab_2"
    with pytest.raises(Exception, match="lacks prefix"):
        one(spark, text.checked_task_prefix(F.lit("ab_1+x"), "ab"))


def test_durations_and_rounding(spark):
    assert one(spark, numbers.hms(F.lit(30 * 3661 + 29))) == "01:01:01"
    assert one(spark, numbers.hms(F.lit(30 * 360000))) == "100:00:00"
    assert one(spark, numbers.pct(F.lit(0.125))) == 12
    assert one(spark, numbers.pct(F.lit(0.375))) == 38
    assert one(spark, numbers.share(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, numbers.first_frame(F.lit(0.99), F.lit(10.0))) == 9
    assert one(spark, numbers.last_frame(F.lit(0.91), F.lit(10.0))) == 10


@pytest.mark.parametrize("version, wanted", [("v3", "v4"), ("7", "v8"), ("beta", "beta.1"), ("v2x", "v2x.1")])
def test_following_version(spark, version, wanted):
    assert one(spark, numbers.following_version(F.lit(version))) == wanted


def test_length_buckets(spark):
    got = [one(spark, numbers.length_bucket(F.lit(n))) for n in (899, 900, 1100, 1300, 1500)]
    assert got == ["<900", "900-1100", "1100-1300", "1300-1500", ">1500"]


def test_features_hash_ignores_order(spark):
    a = F.create_map(F.lit("x"), F.lit(1), F.lit("y"), F.lit(2))
    b = F.create_map(F.lit("y"), F.lit(2), F.lit("x"), F.lit(1))
    assert one(spark, numbers.features_hash(a)) == one(spark, numbers.features_hash(b))


def test_recording_attributes(spark):
    tags = lambda task, qa: one(spark, recordings.tags(F.lit(task), F.lit(qa), {"t1": ["a"]}))
    assert tags("t1", "pass") == ["a", "q_high"]
    assert tags("t9", "warn") == ["q_review"]
    assert one(spark, recordings.device(F.lit(3), "even", "odd")) == "odd"
    assert one(spark, recordings.operator(F.lit(5), ["x", "y", "z"])) == "z"
    assert one(spark, recordings.param_keys(F.lit("--a 1 / --b / --a 2 / IN"))) == ["--a", "--b", "IN"]
