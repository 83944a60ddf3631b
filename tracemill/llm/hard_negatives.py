"""Hard-negative mining with bounds from segment summaries.

A vector is cut into segments, and of each segment its mean and its deviation are
stored. For two vectors a and b, a segment of n components adds between
n * (mean a * mean b - dev a * dev b) and n * (mean a * mean b + dev a * dev b) to their
product. Pairs whose bound cannot reach what an anchor has already found drop out at one
segment, the others at four, then at sixteen, and only what is left is multiplied exactly.

Rows are written once as blocks with their summaries. Anchors are taken in chunks of
``ANCHORS``: a chunk, of bounded size, is sent to all tasks, each task goes through its
blocks once and keeps the best rows of each anchor, and these are merged. Before it starts,
a task scores the chunk's anchors with each other; their best scores, a subset of all, are
floors from below, so tasks send little that cannot win.

Defined cases: rows with a null id, label or vector, or any null or non-finite component
take no part; rows that share an id enter once, with the smallest label and components;
shorter vectors are filled with zeros; components beyond ``BOUND`` after scaling count as
``BOUND``; anchors without positives, and positives without negatives, give no rows; an
empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracemill.llm.common import table
from tracemill.llm.vectors import finite, in_blocks, matrix, scaled
from tracemill.session import materialise

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 10
#: A negative scores between these percentages of the positive.
LOWEST, HIGHEST = 30, 90
#: Largest size of a whole component: a hundred times the product of 64 of them stays below 2^63.
BOUND = 1 << 24
#: Up to this size all sums of products are exact in doubles.
EXACT = 1 << 22
#: Segments of a vector at each level.
LEVELS = (1, 4, 16)
#: Vectors of a block, anchors compared with it at a time, and anchors sent to the tasks at once.
BLOCK, STRIPE, ANCHORS = 1024, 512, 16_384
#: Below this share of pairs left, they are refined one by one instead of all together.
FEW = 0.02

NONE = np.iinfo(np.int64).min
BLOCKS = "ids binary, labels binary, vectors binary, means binary, devs binary"


def taking_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, q): one row per id that takes part."""
    used = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(F.col(vector_col)))
    rows = used.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       scaled(F.col(vector_col), scale, BOUND).alias("q"))
    once = rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("row"))
    return once.select("id", "row.label", "row.q")


def summaries(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments of all levels, side by side."""
    means, devs = [], []
    for segments in LEVELS:
        cut = q.reshape(len(q), segments, -1).astype(float)
        means.append(cut.mean(2))
        devs.append(cut.std(2))
    return np.concatenate(means, 1).astype("<f4"), np.concatenate(devs, 1).astype("<f4")


def _blocked(dims: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_blocks(frames, BLOCK):
            frame = frame.sort_values("label", kind="stable")
            q = matrix(frame["q"], dims)
            kind = "<i2" if len(q) and np.abs(q).max() < 1 << 15 else "<i4"
            means, devs = summaries(q)
            yield pd.DataFrame({"ids": [frame["id"].to_numpy("<i8").tobytes()], "labels": [frame["label"].to_numpy("<i8").tobytes()],
                                "vectors": [q.astype(kind).tobytes()], "means": [means.tobytes()], "devs": [devs.tobytes()]})

    return run


class Vectors:
    """The vectors of one or more blocks with their summaries."""

    def __init__(self, blocks, dims: int):
        blocks = list(blocks)
        self.dims = dims
        self.ids = np.concatenate([np.frombuffer(b["ids"], "<i8") for b in blocks])
        self.labels = np.concatenate([np.frombuffer(b["labels"], "<i8") for b in blocks])
        self.q = np.concatenate([self._whole(b) for b in blocks])
        width = sum(LEVELS)
        self.means = np.concatenate([np.frombuffer(b["means"], "<f4").reshape(-1, width) for b in blocks]).astype(float)
        self.devs = np.concatenate([np.frombuffer(b["devs"], "<f4").reshape(-1, width) for b in blocks]).astype(float)
        largest = np.abs(self.q).max(initial=0)
        self.exact = largest <= EXACT
        if self.exact:
            self.q = self.q.astype(float)
        self.norm = float(dims) ** 0.5 * float(largest)

    def _whole(self, block) -> np.ndarray:
        count = len(block["ids"]) // 8
        kind = "<i2" if len(block["vectors"]) == 2 * count * self.dims else "<i4"
        return np.frombuffer(block["vectors"], kind).reshape(count, self.dims).astype(np.int64)


def bounds(a: Vectors, b: Vectors, rows, columns, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Middle and half width of the range of every product of ``rows`` of a and ``columns`` of b."""
    first = sum(LEVELS[:level])
    part = slice(first, first + LEVELS[level])
    size = a.dims // LEVELS[level]
    return (size * (a.means[rows, part] @ b.means[columns, part].T), size * (a.devs[rows, part] @ b.devs[columns, part].T))


def _pair_bounds(a, b, i, j, level):
    first = sum(LEVELS[:level])
    part = slice(first, first + LEVELS[level])
    size = a.dims // LEVELS[level]
    return (size * (a.means[i, part] * b.means[j, part]).sum(1), size * (a.devs[i, part] * b.devs[j, part]).sum(1))


def scored_pairs(a: Vectors, b: Vectors, rows, columns, alive, least, most) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``rows`` and ``columns`` and the exact products of pairs from ``alive`` between ``least`` and ``most`` of their row.

    Segments are refined level by level; every pair in range is returned.
    """
    # the summaries are rounded to 24 bits; products are whole numbers
    slack = 0.5 + 1e-6 * a.norm * b.norm
    level = 0
    while level < len(LEVELS):
        middle, width = bounds(a, b, rows, columns, level)
        width += slack
        alive &= (middle + width >= least[:, None]) & (middle - width <= most[:, None])
        level += 1
        if np.count_nonzero(alive) < FEW * alive.size:
            break
    dense = np.count_nonzero(alive) >= FEW * alive.size
    if dense and a.exact and b.exact:
        products = (a.q[rows] @ b.q[columns].T).astype(np.int64)
        i, j = np.nonzero(alive & (products >= least[:, None]) & (products <= most[:, None]))
        return i, j, products[i, j]
    i, j = np.nonzero(alive)
    for finer in range(level, len(LEVELS)):
        middle, width = _pair_bounds(a, b, rows[i], columns[j], finer)
        stay = (middle + width + slack >= least[i]) & (middle - width - slack <= most[i])
        i, j = i[stay], j[stay]
    products = np.empty(len(i), np.int64)
    for start in range(0, len(i), 1 << 16):  # bounded memory
        part = slice(start, start + (1 << 16))
        products[part] = (a.q[rows[i[part]]].astype(np.int64) * b.q[columns[j[part]]].astype(np.int64)).sum(1)
    stay = (products >= least[i]) & (products <= most[i])
    return i[stay], j[stay], products[stay]


class Best:
    """The ``size`` best (score, id) of each target: higher scores first, then smaller ids."""

    def __init__(self, targets: int, size: int):
        self.size = size
        self.scores = np.full((targets, size), NONE)
        self.ids = np.zeros((targets, size), np.int64)
        self.floor = np.full(targets, NONE)

    def least(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.floor)

    def add(self, target: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(target):
            return
        met = np.unique(target)
        target = np.concatenate([np.repeat(met, self.size), target])
        scores = np.concatenate([self.scores[met].ravel(), scores])
        ids = np.concatenate([self.ids[met].ravel(), ids])
        order = np.lexsort((ids, ~scores, target))  # ~x falls as x rises, without overflow
        target, scores, ids = target[order], scores[order], ids[order]
        first = np.searchsorted(target, met)
        rank = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        top = rank < self.size
        self.scores[target[top], rank[top]] = scores[top]
        self.ids[target[top], rank[top]] = ids[top]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        target, place = np.nonzero(self.scores != NONE)
        return target, self.ids[target, place], self.scores[target, place]


def add_positives(best: Best, anchors: Vectors, rows: Vectors) -> None:
    """Put the rows of an anchor's own label, other than itself, among its best."""
    for label in np.intersect1d(anchors.labels, rows.labels):
        mine, columns = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
        for start in range(0, len(mine), STRIPE):
            stripe = mine[start:start + STRIPE]
            alive = anchors.ids[stripe][:, None] != rows.ids[columns]
            most = np.full(len(stripe), np.iinfo(np.int64).max)
            i, j, scores = scored_pairs(anchors, rows, stripe, columns, alive, best.least()[stripe], most)
            best.add(stripe[i], rows.ids[columns[j]], scores)


def add_negatives(best: Best, anchors: Vectors, rows: Vectors, low: np.ndarray, high: np.ndarray) -> None:
    """Put rows of other labels among the best of each (anchor, positive) in whose range they score.

    ``low`` and ``high`` have a line per anchor and a column per positive; no range: ``low`` over ``high``.
    """
    columns = np.arange(len(rows.ids))
    slots = low.shape[1]
    for start in range(0, len(anchors.ids), STRIPE):
        stripe = np.arange(start, min(len(anchors.ids), start + STRIPE))
        wanted = np.maximum(low[stripe], best.least().reshape(-1, slots)[stripe])
        open_ = wanted <= high[stripe]
        if not open_.any():
            continue
        least = np.where(open_, wanted, np.iinfo(np.int64).max).min(1)
        most = np.where(open_, high[stripe], NONE).max(1)
        alive = anchors.labels[stripe][:, None] != rows.labels
        i, j, scores = scored_pairs(anchors, rows, stripe, columns, alive, least, most)
        for slot in range(slots):
            fit = (scores >= wanted[i, slot]) & (scores <= high[stripe][i, slot])
            best.add(stripe[i[fit]] * slots + slot, rows.ids[j[fit]], scores[fit])


def _ranges(positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest negative score of each positive score; missing ones get an empty range."""
    there = positives != NONE
    score = np.where(there, positives, 0)
    return np.where(there, -(-LOWEST * score // 100), 1), np.where(there, HIGHEST * score // 100, 0)


def _positives(chunk, dims: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = Vectors(chunk.value, dims)
        seed = Best(len(anchors.ids), POSITIVES)
        add_positives(seed, anchors, anchors)
        best = Best(len(anchors.ids), POSITIVES)
        best.floor = seed.scores[:, -1]
        for frame in frames:
            for block in frame.to_dict("records"):
                add_positives(best, anchors, Vectors([block], dims))
        target, ids, scores = best.found()
        yield pd.DataFrame({"anchor_id": anchors.ids[target], "positive_id": ids, "positive_score": scores})

    return run


def _negatives(chunk, positives, dims: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = Vectors(chunk.value, dims)
        names, scores = positives.value
        low, high = _ranges(scores)
        seed = Best(scores.size, NEGATIVES)
        add_negatives(seed, anchors, anchors, low, high)
        best = Best(scores.size, NEGATIVES)
        best.floor = seed.scores[:, -1]
        for frame in frames:
            for block in frame.to_dict("records"):
                add_negatives(best, anchors, Vectors([block], dims), low, high)
        target, ids, found = best.found()
        anchor, slot = target // scores.shape[1], target % scores.shape[1]
        yield pd.DataFrame({"anchor_id": anchors.ids[anchor], "positive_id": names[anchor, slot], "negative_id": ids,
                            "positive_score": scores[anchor, slot], "negative_score": found})

    return run


def _first(rows: DataFrame, keys: list[str], score: str, name: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), name)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def mine(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    scale: int = SCALE, every: int = EVERY, chunk_size: int = ANCHORS,
) -> DataFrame:
    """For each anchor and positive, its first negatives; one chunk of anchors after another."""
    spark = vectors.sparkSession
    rows = materialise(taking_part(vectors, id_col, vector_col, label_col, scale))
    dims = rows.agg(F.max(F.size("q"))).first()[0] or 0
    dims = max(LEVELS[-1], -(-dims // LEVELS[-1]) * LEVELS[-1])
    blocks = materialise(rows.mapInPandas(_blocked(dims), BLOCKS))
    anchors = rows.filter(F.col("id") % every == 0)
    count = anchors.count()
    chunks = -(-count // chunk_size) or 1
    # dealt by a hash, a chunk stays close to its size
    dealt = materialise(anchors.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")))
    result = None
    for number in range(chunks):
        sent = dealt.filter(F.col("chunk") == number).select("id", "label", "q").coalesce(1)
        held = [r.asDict() for r in sent.mapInPandas(_blocked(dims), BLOCKS).collect()]
        if not held:
            continue
        chunk = spark.sparkContext.broadcast(held)
        ids = Vectors(held, dims).ids
        places = {int(v): p for p, v in enumerate(ids)}
        best = _first(blocks.mapInPandas(_positives(chunk, dims), "anchor_id long, positive_id long, positive_score long"),
                      ["anchor_id"], "positive_score", "positive_id", POSITIVES)
        names, scores = np.zeros((len(ids), POSITIVES), np.int64), np.full((len(ids), POSITIVES), NONE)
        for r in best.collect():  # at most POSITIVES rows per anchor of the chunk
            names[places[r["anchor_id"]], r["rank"] - 1] = r["positive_id"]
            scores[places[r["anchor_id"]], r["rank"] - 1] = r["positive_score"]
        positives = spark.sparkContext.broadcast((names, scores))
        found = blocks.mapInPandas(
            _negatives(chunk, positives, dims),
            "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
        part = materialise(_first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", NEGATIVES))
        chunk.unpersist()
        positives.unpersist()
        result = part if result is None else result.unionByName(part)
    if result is None:
        result = spark.createDataFrame(
            [], "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long, rank int")
    return result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved))


ORACLE = f"""
WITH v AS MATERIALIZED (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF isfinite(x)]) = len(embedding)),
a AS MATERIALIZED (SELECT * FROM v WHERE id % {EVERY} = 0),
s AS MATERIALIZED (SELECT a.id AS anchor_id, v.id AS other, a.label = v.label AS same,
    CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score FROM a JOIN v ON a.id <> v.id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.positive_id, s.other AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {LOWEST} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGHEST} * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
