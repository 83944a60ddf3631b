"""Hard negatives against brute force, and the bounds they are filtered with."""

import math
import random

import numpy as np
import pytest

from tests.conftest import rows
from tracemill.llm import hard_negatives as hn
from tests.llm.conftest import CLASHING

SPEC = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def by_hand(vectors, every):
    once = {}
    for i, v, label in vectors:
        if i is None or v is None or label is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        row = (label, [max(-hn.BOUND, min(hn.BOUND, math.floor(x * 256))) for x in v])
        once[i] = min(once.get(i, row), row)
    out = []
    for a, (label, q) in once.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, m == label) for i, (m, p) in once.items() if i != a)
        for s, positive, _ in [r for r in scored if r[2]][:5]:
            fit = [(i, -n) for n, i, same in scored if not same and 30 * -s <= 100 * -n <= 90 * -s][:10]
            out += [(a, positive, rank, i, -s, n) for rank, (i, n) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def clustered(rng, count, dims, spread):
    out = []
    for i in range(count):
        middle = random.Random(i % 7)
        steps = [middle.gauss(0, 1) for _ in range(-(-dims // 4))]
        out.append((i, [steps[d // 4] + rng.gauss(0, spread) for d in range(dims)], i % 3))
    return out


@pytest.mark.parametrize("dims, spread, every, chunk", [(64, 0.1, 10, 4096), (16, 1.0, 7, 8), (5, 0.5, 10, 3)])
def test_same_as_brute_force(table, monkeypatch, dims, spread, every, chunk):
    monkeypatch.setattr(hn, "BLOCK", 37)
    monkeypatch.setattr(hn, "STRIPE", 5)
    vectors = clustered(random.Random(dims), 300, dims, spread)
    out = hn.mine(table(vectors, SPEC).repartition(3), every=every, chunk_size=chunk)
    got = rows(out, *COLUMNS)
    assert got == by_hand(vectors, every) and len(got) > 100


def test_edge_rows(table):
    rng = random.Random(5)
    vectors = clustered(rng, 60, 8, 0.3)
    vectors += [(60 + i, [1.0] * 8, i % 2) for i in range(80)]  # ties of one common vector
    vectors += [(3, vectors[3][1], 1), vectors[4], (10, [0.0] * 8, 0), (None, [1.0] * 8, 1), (200, None, 1), (201, [1.0] * 8, None),
                (202, [1.0] * 7 + [None], 1), (203, [float("nan")] * 8, 1), (204, [float("-inf")] * 8, 1), (210, [], 1), (220, [1.0] * 3, 1),
                (230, [1e300] * 8, 2), (240, [-0.001] * 8, 2), (-10, [0.9] * 8, 1)]
    assert rows(hn.mine(table(vectors, SPEC), every=10), *COLUMNS) == by_hand([(i, None if v is None else [
        None if x is None else x for x in v], m) for i, v, m in vectors], 10)


def test_no_rows_no_anchors_and_clashing_names(spark, table):
    assert hn.mine(table([], SPEC)).columns == COLUMNS and hn.mine(table([], SPEC)).count() == 0
    assert hn.mine(table([(1, [1.0], 1)], SPEC)).count() == 0 and hn.mine(table([(0, [1.0], 1)], SPEC)).count() == 0
    names = [n for n in CLASHING if n != "label"] + ["q", "chunk", "rank"]
    spec = SPEC + ", " + ", ".join(f"`{c}` string" for c in names)
    out = hn.mine(spark.createDataFrame([(i, [1.0 + i % 5, 1.0], i % 2, *["x"] * len(names)) for i in range(30)], spec), every=10)
    assert out.columns == COLUMNS and out.count() > 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (4, 16)).repeat(4, axis=1)
    q = centres[rng.integers(0, 4, 400)] + rng.integers(-6, 7, (400, 64))
    means, devs = hn.summaries(q)
    block = {"ids": np.arange(400).astype("<i8").tobytes(), "labels": np.zeros(400, "<i8").tobytes(), "vectors": q.astype("<i2").tobytes(),
             "means": means.tobytes(), "devs": devs.tobytes()}
    v = hn.Vectors([block], 64)
    products = q @ q.T
    every = np.arange(400)
    left = []
    for level in range(len(hn.LEVELS)):
        middle, width = hn.bounds(v, v, every, every, level)
        slack = 0.5 + 1e-6 * v.norm ** 2
        assert (middle - width - slack <= products).all() and (products <= middle + width + slack).all()
        left.append((middle + width >= np.sort(products, 1)[:, [-20]]).mean())
    assert left[2] < left[1] < left[0] and left[2] < 0.5  # finer segments leave fewer pairs
    i, j, scores = hn.scored_pairs(v, v, every, every, np.ones((400, 400), bool), np.full(400, 10_000), np.full(400, 900_000))
    wanted = {(a, b) for a, b in zip(*np.nonzero((products >= 10_000) & (products <= 900_000)))}
    assert set(zip(i, j)) == wanted and (scores == products[i, j]).all()
