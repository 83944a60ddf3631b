"""Blocked positions, sums and shifts against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tracemill.operators.positions import dense_position, running_start, shifted, smallest, sorted_position


def skewed(n=400, seed=3):
    """A third of all rows has the same key."""
    rng = random.Random(seed)
    ids = rng.sample(range(5000), n)
    return [("hot" if i % 3 == 0 else f"k{i % 7}", x, rng.randrange(9)) for i, x in enumerate(ids)]


def by_key(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    return {k: sorted(v, key=lambda r: r[1]) for k, v in groups.items()}


def test_dense_position(table):
    data = skewed()
    out = dense_position(table(data, "k string, x bigint, v bigint"), ["k"], ["x"], "p", size=64)
    wanted = sorted((k, r[1], i) for k, g in by_key(data).items() for i, r in enumerate(g))
    assert sorted(tuple(r) for r in out.select("k", "x", "p").collect()) == wanted


def test_running_start(table):
    data = skewed()
    out = running_start(table(data, "k string, x bigint, v bigint"), ["k"], "x", "v", "s", size=64)
    wanted = sorted((k, r[1], sum(q[2] for q in g[:i])) for k, g in by_key(data).items() for i, r in enumerate(g))
    assert sorted(tuple(r) for r in out.select("k", "x", "s").collect()) == wanted


def test_sorted_position_of_names(table):
    data = [(k, f"name {x:05d}", v) for k, x, v in skewed()]
    out = sorted_position(table(data, "k string, x string, v bigint"), ["k"], ["x"], "p")
    wanted = sorted((k, r[1], i) for k, g in by_key(data).items() for i, r in enumerate(g))
    assert sorted(tuple(r) for r in out.select("k", "x", "p").collect()) == wanted


def test_sorted_position_over_everything(table):
    data = skewed()
    out = sorted_position(table(data, "k string, x bigint, v bigint"), [], [F.desc("x")], "p")
    wanted = sorted((r[1], i) for i, r in enumerate(sorted(data, key=lambda r: -r[1])))
    assert sorted(tuple(r) for r in out.select("x", "p").collect()) == wanted


def test_shifted_crosses_block_edges(table):
    data = [(k, p, p * p) for k, n in (("a", 100), ("b", 7), ("c", 33)) for p in range(n)]
    lengths = {"a": 100, "b": 7, "c": 33}
    out = shifted(table(data, "k string, p bigint, v bigint"), ["k"], "p", {"m1": ("v", -1), "m3": ("v", -3), "p8": ("v", 8)}, size=10)
    at = lambda k, p: p * p if 0 <= p < lengths[k] else None
    wanted = sorted(((k, p, at(k, p - 1), at(k, p - 3), at(k, p + 8)) for k, p, _ in data), key=repr)
    assert rows(out, "k", "p", "m1", "m3", "p8") == wanted


def test_shift_must_fit_a_block(table):
    with pytest.raises(ValueError):
        shifted(table([("a", 0)], "k string, p bigint"), ["k"], "p", {"x": ("p", 10)}, size=10)


def test_smallest_is_exact(table):
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else "cold", i, rng.randrange(2**32)) for i in range(500)]
    df = table(data, "k string, i bigint, h bigint")
    best = sorted((h, i) for _, i, h in data)[:77]
    assert sorted(r.i for r in smallest(df, "h", "i", 77).collect()) == sorted(i for _, i in best)
    per_key = smallest(df, "h", "i", F.when(F.col("k") == "hot", 10).otherwise(25), ["k"], bits=4)
    for key, n in (("hot", 10), ("cold", 25)):
        wanted = sorted(i for _, i in sorted((h, i) for k, i, h in data if k == key)[:n])
        assert sorted(r.i for r in per_key.filter(F.col("k") == key).collect()) == wanted


def test_sparse_ids(spark):
    """Ids spread over 2^60: every row is a block of its own."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        (F.xxhash64("id") / 8).cast("bigint").alias("x"), (F.col("id") % 5).alias("v"))
    placed = {(r.k, r.x): r.place for r in dense_position(df, ["k"], ["x"], "place").collect()}
    started = {(r.k, r.x): (r.v, r.start) for r in running_start(df, ["k"], "x", "v", "start").collect()}
    groups = {}
    for k, x in placed:
        groups.setdefault(k, []).append(x)
    for k, xs in groups.items():
        total = 0
        for place, x in enumerate(sorted(xs)):
            assert placed[k, x] == place and started[k, x][1] == total
            total += started[k, x][0]


def test_tasks_of_a_dealt_table_do_not_grow_with_it(spark, monkeypatch):
    """Sorted, joined and counted by episode in as many tasks as its rows ask for, in one move."""
    from workload import views as v
    from workload.q_domain import dom7

    sf = "/root/testdata/sf0.001"
    lines = v.table(spark, sf, "lineitem").count()
    wanted = sorted(map(tuple, dom7(spark, sf).collect()))
    monkeypatch.setattr("tracemill.operators.positions.TASK_ROWS", lines // 9)
    frames = v.by_episode(spark, sf, v.frames(spark, sf))
    assert frames.rdd.getNumPartitions() == 10
    assert frames.groupBy("dataset", "recording_id").count().rdd.getNumPartitions() == 10
    assert sorted(map(tuple, dom7(spark, sf).collect())) == wanted
