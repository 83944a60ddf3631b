"""N-gram Jaccard join by MinHash banding, verified on whole n-gram sets.

Documents with equal n-gram sets are one class and go on as one row. Band hashes
of equal value tie classes to the smallest one of the bucket; the components of
these ties hold every candidate pair. Components are cut into blocks, and a task
compares two blocks (or many small components) exactly, by counting common n-grams
with a matrix product. It returns per class the number of documents linked, and ties
to one class of each linked set, so that no list of pairs is ever written.

The number of bands and rows is chosen so that a pair at the threshold shares a
bucket with at least the probability ``recall``.

Defined cases: a null text is empty; documents without words have no links and stand
alone; a text of fewer words than ``n`` has one n-gram, all its words; repeated rows
count as documents, and share one text if they share an id; a row with a null id is
not linked and gets class null; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.bloom import only_ids, without_ids
from tracemill.llm.common import spread_join, table
from tracemill.llm.components import connected_components
from tracemill.llm.words import batches, mix, shingle_sets
from tracemill.session import materialise

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Hash functions a signature may use.
HASHES = 128
#: Classes of one block; a task compares at most two blocks.
BLOCK = 256


def choose_bands(threshold: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows for which enough bands fit into ``hashes`` functions."""
    for rows in range(hashes, 0, -1):
        shared = threshold ** rows
        bands = 1 if shared == 1 else math.ceil(math.log1p(-recall) / math.log1p(-shared))
        if bands * rows <= hashes:
            return bands, rows
    raise ValueError("no number of rows reaches this recall; allow more hash functions")


def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:count] | np.uint64(1), seeds[count:]


def band_keys(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    factor, shift = _family(bands * rows)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        part = shingles[i:i + 4096, None] * factor
        part += shift
        part ^= part >> np.uint64(32)
        np.minimum(least, part.min(0), out=least)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        keys = mix(keys * np.uint64(0x100000001B3) + column)
    return keys.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """``id``, the identity of the n-gram set (null without words) and its band keys."""

    def sign(frames):
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            ids, sets, keys = frame["id"].tolist(), [], []
            for a, b in batches(texts):
                for grams in shingle_sets(texts[a:b], words):
                    sets.append(hashlib.blake2b(grams.tobytes(), digest_size=16).hexdigest() if len(grams) else None)
                    keys.append(band_keys(grams, bands, rows) if len(grams) else None)
            yield pd.DataFrame({"id": pd.array(ids, "Int64"), "grams": sets, "bands": keys})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(
        sign, "id long, grams string, bands array<long>")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    column = np.cumsum(np.concatenate([[0], (np.diff(grams) != 0).astype(np.int64)]))
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    total = np.zeros((len(sets), len(sets)), np.float32)
    if not len(column):
        return total
    column = np.cumsum(np.concatenate([[0], (np.diff(column) != 0).astype(np.int64)]))
    for low in range(0, column[-1] + 1, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        dense = np.zeros((len(sets), min(4096, column[-1] + 1 - low)), np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        total += dense @ dense.T
    return total


def linked_pairs(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """The symmetric matrix of pairs at least ``threshold`` alike."""
    common, sizes = _common(sets), np.array([len(s) for s in sets], np.float64)
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index each index is connected with."""
    root = np.arange(len(linked))
    while True:
        new = np.where(linked, root[None, :], len(root)).min(1, initial=len(root))
        new = np.minimum(root, new)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(words: int, threshold: float):
    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        frame = frame.sort_values(["component", "rep"], kind="stable")
        grams = []
        texts = frame["text"].tolist()
        for a, b in batches(texts):
            grams += shingle_sets(texts[a:b], words)
        component = frame["component"].to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], component[1:] != component[:-1], [True]]))
        reps, copies, blocks = (frame[c].to_numpy() for c in ("rep", "copies", "block"))
        two = frame["low"].iloc[0] != frame["high"].iloc[0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            linked = linked_pairs(grams[a:b], threshold)
            if two:  # pairs within a block are counted where the block meets itself
                linked &= blocks[a:b, None] != blocks[None, a:b]
            links = linked @ copies[a:b]
            root = reps[a:b][_roots(linked)]
            out += [(int(r), int(n), int(t)) for r, n, t in zip(reps[a:b], links, root) if n]
        return pd.DataFrame(out, columns=["rep", "links", "root"])

    return compare


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
         threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Per document: ``class_id``, the smallest id it is linked with over any number of
    links; ``n_links``, how many other documents are at least ``threshold`` alike."""
    bands, rows = choose_bands(threshold, recall)
    signed = materialise(signatures(docs, id_col, text_col, words, bands, rows))
    worded = signed.filter("grams IS NOT NULL AND id IS NOT NULL")
    classes = materialise(worded.groupBy("grams").agg(
        F.min(F.struct(F.col("id").alias("rep"), "bands")).alias("least"),
        F.count(F.lit(1)).alias("copies")).select("grams", "least.rep", "least.bands", "copies"))
    keyed = classes.select("rep", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    ties = spread_join(keyed, buckets, ["key"], "rep").select("first", "rep")
    parts = connected_components(ties, "first", "rep")
    sizes = parts.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = spread_join(parts, sizes, ["root"], "node").join(
        classes.select(F.col("rep").alias("node"), "copies"), "node")
    members = members.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = only_ids(docs, id_col, members, "node").select(
        F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text")).dropDuplicates(["node"])
    members = materialise(members.join(texts, "node"))
    total = members.count()
    small = max(1, math.ceil(total / block))
    dealt = members.select(
        F.col("root").alias("component"), F.col("node").alias("rep"), "copies", "block", "text", "blocks",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumns({
        "low": F.least("block", "other"), "high": F.greatest("block", "other"),
        "task": F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(small))).otherwise(
            F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")))}).drop("other", "blocks")
    found = materialise(dealt.groupBy("task", "low", "high").applyInPandas(
        _compare(words, threshold), "rep long, links long, root long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "root", "rep").select(F.col("node").alias("rep"), "root")
    known = (classes.select("grams", "rep", "copies").join(links, "rep", "left").join(roots, "rep", "left")
             .select("grams", F.coalesce("root", "rep").alias("class_id"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    placed = spread_join(worded.select("id", "grams"), known, ["grams"], "id").select(
        F.col("id").alias("doc_id"), "class_id", "n_links")
    alone = signed.filter("grams IS NULL OR id IS NULL").select(
        F.col("id").alias("doc_id"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return placed.unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that are linked with a smaller id over any number of links."""
    gone = materialise(join(docs, id_col, text_col).filter("doc_id <> class_id").select("doc_id"))
    return without_ids(docs, id_col, gone, "doc_id")


def op3_ngram_jaccard_join(spark, sf_dir):
    return join(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE common.n >= 0.8 * (p.n + q.n - common.n)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, least(d.doc_id, (SELECT min(y) FROM reach WHERE x = d.doc_id)) AS class_id,
       (SELECT count(*) FROM links WHERE x = d.doc_id) AS n_links
FROM documents d
"""
