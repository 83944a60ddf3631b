"""Centroid clustering of vectors with zone maps along a space-filling curve.

Vectors are sorted along a Hilbert curve and cut into blocks of neighbours, each with
the smallest and largest value of every component. The distance from such a box to a
centroid bounds the distances of all its vectors from both sides, so a block compares
exactly only with centroids that may be nearest to one of its vectors. Each round sends
the sums of a task's vectors by centroid, and the driver sees one sum per centroid.

Everything is counted in whole numbers, so the result does not depend on blocks,
partitions or the order of additions.

Defined cases: vectors that are null, have another number of components, or any null or
non-finite one take no part; an empty table, or one without such vectors, gives an empty
result; with fewer vectors than centroids each vector starts one; repeated rows and equal
vectors each count; a null id is hashed as the empty text and stays null; components
beyond ``BOUND`` after scaling count as ``BOUND``; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.llm.common import table
from tracemill.llm.vectors import finite, in_blocks, matrix, scaled
from tracemill.session import materialise

DIMS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, "3:"
#: Largest size of a whole component: squared distances of 64 of them stay below 2^63.
BOUND = 1 << 26
#: Up to this size all sums of products are exact in doubles.
EXACT = 1 << 22
#: Vectors of a block, which is one unit of comparison.
BLOCK = 512
#: Vectors sorted by one task.
PER_TASK = 1 << 17
#: Bits of each component's place on the curve.
BITS = 2

BLOCKS = "ids binary, unnamed binary, vectors binary, low binary, high binary"


def kept(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, q): vectors that take part, as whole numbers."""
    vector = F.col(vector_col)
    return vectors.filter((F.size(vector) == dims) & finite(vector)).select(
        F.col(id_col).cast("long").alias("id"), scaled(vector, scale, BOUND).alias("q"))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The places of grid cells on the Hilbert curve through all dimensions, as byte strings that sort like them.

    The usual exchange and inversion of axes, one bit level after another, then Gray decoding;
    each step works on all cells at once.
    """
    axes = cells.T.astype(np.uint32).copy()
    dims = len(axes)
    level = 1 << (bits - 1)
    while level > 1:
        low = np.uint32(level - 1)
        for d in range(dims):
            inverted = (axes[d] & np.uint32(level)) != 0
            swapped = np.where(inverted, 0, (axes[0] ^ axes[d]) & low).astype(np.uint32)
            axes[0] ^= np.where(inverted, low, swapped).astype(np.uint32)
            axes[d] ^= swapped
        level >>= 1
    for d in range(1, dims):
        axes[d] ^= axes[d - 1]
    flip = np.zeros(axes.shape[1], np.uint32)
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((axes[-1] & np.uint32(level)) != 0, np.uint32(level - 1), np.uint32(0))
        level >>= 1
    axes ^= flip
    planes = [(axes[d] >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1) for d in range(dims)]
    return np.packbits(np.array(planes, np.uint8).T, axis=1)


def _moments(dims: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            q = matrix(frame["q"], dims).astype(float)
            yield pd.DataFrame({"pos": range(dims), "n": len(q), "total": q.sum(0), "squares": (q * q).sum(0)})

    return run


def grid(vectors: DataFrame, dims: int) -> np.ndarray:
    """Borders of four cells per dimension, about a quarter of evenly spread vectors in each; a bounded table."""
    sums = vectors.mapInPandas(_moments(dims), "pos int, n long, total double, squares double")
    rows = sums.groupBy("pos").agg(F.sum("n").alias("n"), F.sum("total").alias("s"), F.sum("squares").alias("q")).collect()
    borders = np.zeros((dims, 3))
    for r in rows:
        mean = r["s"] / r["n"]
        spread = 0.6745 * max(r["q"] / r["n"] - mean * mean, 0.0) ** 0.5
        borders[r["pos"]] = mean - spread, mean, mean + spread
    return borders


def _keyed(borders: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            q = matrix(frame["q"], len(borders))
            cells = (q[:, :, None] > borders).sum(2)
            yield pd.DataFrame({"id": frame["id"], "unnamed": frame["unnamed"], "key": [k.tobytes() for k in hilbert_keys(cells, BITS)],
                                "vector": [v.tobytes() for v in q.astype("<i4")]})

    return run


def _blocked(dims: int, block: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_blocks(frames, block):
            raw = b"".join(frame["vector"])
            q = np.frombuffer(raw, "<i4").reshape(-1, dims)
            yield pd.DataFrame({"ids": [frame["id"].to_numpy("<i8").tobytes()], "unnamed": [frame["unnamed"].to_numpy(bool).tobytes()],
                                "vectors": [raw], "low": [q.min(0).tobytes()], "high": [q.max(0).tobytes()]})

    return run


def zone_maps(vectors: DataFrame, dims: int = DIMS, block: int = BLOCK) -> DataFrame:
    """Blocks of neighbours on the curve with their boxes, written once.

    Rows are dealt by place and then by a hash of the id, so equal vectors, however many, spread.
    """
    rows = vectors.count()
    named = vectors.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("unnamed"), "q")
    keyed = named.mapInPandas(_keyed(grid(vectors, dims)), "id long, unnamed boolean, key binary, vector binary")
    parts = max(1, -(-rows // PER_TASK), min(rows // block, vectors.sparkSession.sparkContext.defaultParallelism))
    spread = keyed.withColumn("tie", F.xxhash64("id"))
    sorted_ = spread.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie")
    return materialise(sorted_.drop("tie").mapInPandas(_blocked(dims, block), BLOCKS))


def box_candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers, ascending, of the centroids that may be nearest to a vector in the box."""
    under, over = low - centroids, centroids - high
    outside = np.maximum(np.maximum(under, over), 0)
    farthest = np.maximum(np.abs(under), np.abs(over))
    return np.flatnonzero((outside ** 2).sum(1) <= (farthest ** 2).sum(1).min())


def nearest(q: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each vector; of equals the smaller number."""
    few = box_candidates(low, high, centroids)
    some = centroids[few]
    if max(np.abs(low).max(), np.abs(high).max(), np.abs(some).max()) <= EXACT:
        x, c = q.astype(float), some.astype(float)
        squares = ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    else:
        squares = np.stack([((q - c) ** 2).sum(1) for c in some], axis=1)
    best = squares.argmin(1)
    return few[best], squares[np.arange(len(q)), best]


def _read(block, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(block.vectors, "<i4").reshape(-1, dims).astype(np.int64),
            np.frombuffer(block.low, "<i4").astype(np.int64), np.frombuffer(block.high, "<i4").astype(np.int64))


def _sums(centroids: np.ndarray):
    k, dims = centroids.shape

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
            for block in frame.itertuples(index=False):
                q, low, high = _read(block, dims)
                cluster, _ = nearest(q, low, high, centroids)
                counts += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    sums[c] += q[cluster == c].sum(0)
            met = np.flatnonzero(counts)
            yield pd.DataFrame({"cluster": met.astype("int32"), "n": counts[met], "sums": list(sums[met])})

    return run


def _assigned(centroids: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block in frame.itertuples(index=False):
                cluster, distance = nearest(*_read(block, centroids.shape[1]), centroids)
                yield pd.DataFrame({"id": np.frombuffer(block.ids, "<i8"), "unnamed": np.frombuffer(block.unnamed, bool),
                                    "cluster": cluster.astype("int32"), "distance": distance})

    return run


def start(vectors: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The vectors with the smallest hashed ids; those that share an id go by their components."""
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r["q"] for r in vectors.select(hashed.alias("h"), "q").orderBy("h", "q").limit(k).collect()], np.int64)


def improve(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid with vectors moves to the floor of their mean."""
    parts = blocks.mapInPandas(_sums(centroids), "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "value"))
    # a total over all vectors may need more than 64 bits
    totals = each.groupBy("cluster", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
    moved = centroids.copy()
    for r in totals.collect():
        moved[r["cluster"], r["pos"]] = int(r["total"]) // r["n"]
    return moved


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE,
    k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, block: int = BLOCK,
) -> DataFrame:
    """One row per vector that takes part: its cluster, squared distance, inertias and its centroid's digest."""
    rows = kept(vectors, id_col, vector_col, dims, scale)
    spark = vectors.sparkSession
    centroids = start(rows, k, seed)
    named = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
                          T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    blocks = zone_maps(rows, dims, block)
    for _ in range(rounds):
        centroids = improve(blocks, centroids)
    found = materialise(blocks.mapInPandas(_assigned(centroids), "id long, unnamed boolean, cluster int, distance long"))
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(c, s, total, digests[c]) for c, s in sums.items()], named)
    return found.join(facts, "cluster").select(
        F.when(~F.col("unnamed"), F.col("id")).alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clustering(spark, sf_dir):
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    steps = [f"""
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE len(embedding) = {DIMS} AND len([x FOR x IN embedding IF isfinite(x)]) = {DIMS}),
x AS MATERIALIZED (SELECT r, generate_subscripts(q, 1) AS i, unnest(q) AS x FROM v),
c0 AS MATERIALIZED (SELECT k, generate_subscripts(q, 1) AS i, unnest(q) AS c FROM (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}' || CAST(vec_id AS VARCHAR))) - 1 AS k, q FROM v
  ORDER BY sha256('{SEED}' || CAST(vec_id AS VARCHAR)) LIMIT {CENTROIDS}) s)"""]
    for n in range(ROUNDS + 1):
        steps.append(f"""
d{n} AS MATERIALIZED (SELECT r, k, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c{n} USING (i) GROUP BY r, k),
a{n} AS MATERIALIZED (SELECT r, k, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if n < ROUNDS:
            steps.append(f"""
c{n + 1} AS MATERIALIZED (SELECT o.k, o.i, coalesce(m.c, o.c) AS c FROM c{n} o LEFT JOIN (
  SELECT k, i, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS c FROM a{n} JOIN x USING (r) GROUP BY k, i) m ON m.k = o.k AND m.i = o.i)""")
    return "WITH " + ",".join(steps) + f"""
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.s AS centroid_sha256 FROM a{ROUNDS} a JOIN v USING (r)
JOIN (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS s FROM c{ROUNDS} GROUP BY k) h ON h.k = a.k"""


ORACLE = _oracle()
