"""Clustering against the rule in plain Python, and the curve and boxes it prunes with."""

import hashlib
import math
import random

import numpy as np

from tests.conftest import rows
from tracemill.llm import centroid_clustering as cc
from tests.llm.conftest import CLASHING

SPEC = "vec_id long, embedding array<double>"


def by_hand(vectors, dims, k=8, rounds=10):
    kept = [(i, [max(-cc.BOUND, min(cc.BOUND, math.floor(x * 1024))) if abs(x) < 1e300 else int(math.copysign(cc.BOUND, x)) for x in v])
            for i, v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [q for _, q in order[:k]]

    def place(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(place(q)[1], []).append(q)
        for n, members in groups.items():
            centroids[n] = [sum(column) // len(members) for column in zip(*members)]
    out = [(i, *place(q)) for i, q in kept]
    sums = {n: sum(d for _, d, m in out if m == n) for _, _, n in out}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, sums[n], sum(sums.values()), digest[n]) for i, d, n in out), key=repr)


COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_match_the_rule(table):
    rng = random.Random(1)
    vectors = [(i, [rng.gauss(i % 5, 0.2) for _ in range(6)]) for i in range(300)]
    vectors += [(300 + i, [0.5] * 6) for i in range(200)]  # one very common vector
    vectors += [(7, vectors[7][1]), (7, [9.0] * 6), (None, [1.0] * 6), (501, None), (502, []), (503, [1.0] * 5), (504, [1.0] * 5 + [None]),
                (505, [1.0] * 5 + [float("nan")]), (506, [float("inf")] * 6), (507, [1e305, -1e305, 0.0, 0.0, 0.0, 0.0])]
    out = cc.cluster(table(vectors, SPEC).repartition(5), dims=6, block=16)
    assert rows(out, *COLUMNS) == by_hand(vectors, 6)


def test_ties_go_to_the_smaller_number(table):
    vectors = [(i, [float(i % 4), 0.0]) for i in range(40)]
    out = cc.cluster(table(vectors, SPEC), dims=2, k=3, rounds=4, block=8)
    assert rows(out, *COLUMNS) == by_hand(vectors, 2, 3, 4)


def test_fewer_vectors_than_centroids_and_none(table):
    vectors = [(1, [0.0, 1.0]), (2, [5.0, 5.0]), (3, None)]
    assert rows(cc.cluster(table(vectors, SPEC), dims=2), *COLUMNS) == by_hand(vectors, 2)
    assert cc.cluster(table([], SPEC)).columns == COLUMNS and cc.cluster(table([(1, None)], SPEC)).count() == 0


def test_other_columns_may_have_any_name(spark, table):
    names = [*CLASHING, "cluster", "distance", "q", "tie", "vector", "unnamed"]
    spec = "vec_id long, embedding array<float>, " + ", ".join(f"`{c}` string" for c in names)
    out = cc.cluster(spark.createDataFrame([(i, [float(i), 1.0], *["x"] * len(names)) for i in range(20)], spec), dims=2)
    assert out.columns == COLUMNS and out.count() == 20


def test_the_curve_visits_neighbours():
    side = 4
    cells = np.array([(x, y) for x in range(side) for y in range(side)])
    keys = [k.tobytes() for k in cc.hilbert_keys(cells, 2)]
    assert len(set(keys)) == side * side
    walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_boxes_leave_out_only_what_cannot_be_nearest():
    rng = np.random.default_rng(3)
    dropped = 0
    for _ in range(200):
        q = rng.integers(-50, 50, (1, 4)) + rng.integers(-8, 8, (30, 4))
        centroids = rng.integers(-60, 60, (8, 4))
        low, high = q.min(0), q.max(0)
        some = cc.box_candidates(low, high, centroids)
        dropped += 8 - len(some)
        squares = ((q[:, None] - centroids) ** 2).sum(2)
        assert set(squares.argmin(1)) <= set(some)
        number, distance = cc.nearest(q, low, high, centroids)
        assert (number == squares.argmin(1)).all() and (distance == squares.min(1)).all()
        big = (q * 200_000, low * 200_000, high * 200_000, centroids * 200_000)  # beyond what doubles hold exactly
        assert (cc.nearest(*big)[1] == squares.min(1) * 40_000_000_000).all()
    assert dropped > 200


def test_neighbours_share_blocks(table):
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(10 * (i % 4), 0.1) for _ in range(4)]) for i in range(256)]
    blocks = cc.zone_maps(cc.kept(table(vectors, SPEC), "vec_id", "embedding", 4, 1024), 4, 16).collect()
    widths = [np.ptp(np.frombuffer(b["vectors"], "<i4").reshape(-1, 4), axis=0).max() for b in blocks]
    assert sum(len(b["ids"]) for b in blocks) == 256 * 8 and np.median(widths) < 2000  # one group each, not several
