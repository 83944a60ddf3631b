"""Removal of byte strings that an earlier document has, by suffix arrays over shards.

1. Equal texts enter once, under the smallest id. Every window of ``width`` bytes chooses
   an anchor. The anchor and the bytes that follow (or precede) it in all windows that begin
   near (or far) before it must be found in two documents; other windows are set aside.
2. The runs of windows that share an anchor go to the shard of the anchor, equal runs only
   once with the smallest id. The windows of an anchor with very many different runs are
   compared one by one instead, by an aggregate that counts before it moves rows.
3. A shard joins the runs of anchors that have different runs to one text, builds its suffix
   array by induced sorting and the permuted common prefixes. Neighbours that share ``width``
   bytes are one group, and each window learns the smallest id of its group. The only run of
   an anchor shares no window with another run, so its own smallest id is known.
4. Runs report to the documents they stand in; windows whose smallest id is smaller than the
   document's own are removed.

Defined cases: a null or empty text has no windows; rows that share an id share one text
and are not compared with each other; a row with a null id is left as it is and removes
nothing; an empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.anchors import Runs
from tracemill.llm.bloom import only_ids
from tracemill.llm.common import spread_join, table
from tracemill.llm.exact_dedup import drop_copies
from tracemill.llm.shared import ASKED, PER_PART, Answers, asked, common_answers
from tracemill.llm.suffix_array import common_prefixes, suffix_array
from tracemill.llm.words import batches
from tracemill.session import materialise, release

WIDTH = 50
#: Bytes of runs that one shard's suffix array holds, and runs of one anchor from which it is spread.
SHARD = 1 << 20
SPREAD = 8192
#: Characters of texts that ask together which of their keys others have.
TOGETHER = 1 << 22
#: Never part of UTF-8.
END = 255


def _encoded(frame: pd.DataFrame, width: int):
    """The texts of a batch in groups that ask together, each a list of ids, joined bytes, where each text ends, and runs."""
    texts, ids = frame["text"].tolist(), frame["id"].to_numpy()
    for low, high in batches(texts, TOGETHER):
        group = []
        for a, b in batches(texts[low:high]):
            raw = [t.encode("utf-8", "replace") for t in texts[low + a:low + b]]
            data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])
            group.append((ids[low + a:low + b], data, ends, Runs(data, ends, width)))
        yield group


def _keys(group):
    """The keys of the runs of a group and the texts they stand in."""
    keys, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for ids, _, _, runs in group:
        for key, has in ((runs.left, runs.has_left), (runs.right, runs.has_right)):
            keys.append(key[has])
            owners.append(ids[runs.owner[has]])
    return np.concatenate(keys), np.concatenate(owners)


def _asked(width: int, parts: int):
    def emit(frames):
        for frame in frames:
            for group in _encoded(frame, width):
                yield asked(*_keys(group), parts)

    return emit


def _runs(width: int, answers: str):
    """Runs of windows with a common anchor; equal runs of a part of a batch carry their bytes once."""
    kept: dict = {}

    def emit(frames):
        for frame in frames:
            known = kept.get("answers") or kept.setdefault("answers", Answers(answers))
            for group in _encoded(frame, width):
                common, at = known(_keys(group)[0]), 0
                for ids, data, ends, runs in group:
                    sides = []
                    for has in (runs.has_left, runs.has_right):
                        side, n = np.zeros(len(has), bool), int(has.sum())
                        side[has] = common[at:at + n]
                        sides.append(side)
                        at += n
                    anchors, first, last, owner, content = runs.keep(*sides)
                    begins = ends - np.diff(ends, prepend=0)
                    carries = np.zeros(len(anchors), bool)
                    carries[np.unique(content, return_index=True)[1]] = True
                    raw = data.tobytes()
                    yield pd.DataFrame({
                        "run": content, "anchor": anchors, "doc_id": ids[owner], "start": first - begins[owner],
                        "bytes": [raw[a:b + width] if c else None for a, b, c in zip(first.tolist(), last.tolist(), carries)]})

    return emit


def smallest_ids(runs: list[bytes], ids: np.ndarray, width: int) -> list[np.ndarray]:
    """For each window of each run the smallest of ``ids`` whose run has an equal window."""
    text = np.frombuffer(bytes([END]).join(runs) + bytes([END]), np.uint8)
    order = suffix_array(text)
    common = common_prefixes(text, order)[order]
    sizes = np.array([len(r) for r in runs]) + 1
    owner = np.repeat(ids, sizes)
    starts = np.flatnonzero(common < width)
    least = np.minimum.reduceat(owner[order], starts)
    by_place = np.empty(len(text), owner.dtype)
    by_place[order] = np.repeat(least, np.diff(np.append(starts, len(order))))
    at = np.concatenate([[0], np.cumsum(sizes)])
    return [by_place[a:b - width] for a, b in zip(at[:-1], at[1:])]


def _shard(width: int):
    """Intervals of windows of each run with the same smallest id, where that is not the only one."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        alone = ~frame["anchor"].duplicated(keep=False)
        known = frame[alone & (frame["docs"] > 1)]
        out = list(zip(known["run"], [0] * len(known), known["bytes"].map(len) - width, known["doc_id"]))
        frame = frame[~alone].sort_values("run")
        found = smallest_ids([bytes(b) for b in frame["bytes"]], frame["doc_id"].to_numpy(), width) if len(frame) else []
        for run, own, docs, least in zip(*(frame[c].tolist() for c in ("run", "doc_id", "docs")), found):
            if docs == 1 and (least >= own).all():
                continue
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1, [len(least)]])
            out += [(run, int(a), int(b) - 1, int(least[a])) for a, b in zip(cuts[:-1], cuts[1:])]
        return pd.DataFrame(out, columns=["run", "low", "high", "least"])

    return solve


def _by_window(runs: DataFrame, width: int) -> DataFrame:
    """What :func:`_shard` gives, for runs of hot anchors: one row per window, the smallest id by an aggregate."""
    places = F.sequence(F.lit(0).cast("long"), F.octet_length("bytes").cast("long") - width)
    windows = runs.select("run", "doc_id", "docs", "bytes", F.explode(places).alias("low")).select(
        "run", "doc_id", "docs", "low", F.expr(f"substring(bytes, int(low) + 1, {width})").alias("window"))
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    return spread_join(windows, least, ["window"], "run").filter("docs > 1 OR least < doc_id").select(
        "run", "low", F.col("low").alias("high"), "least")


def _union(starts: np.ndarray, ends: np.ndarray):
    """Maximal runs covered by the intervals; touching ones are one run."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(starts)]]) - 1
    return list(zip(starts[new].tolist(), reach[last].tolist()))


def _cut(frames):
    for frame in frames:
        out = []
        for doc_id, text, spans in zip(frame["doc_id"], frame["text"], frame["spans"]):
            raw = (text or "").encode("utf-8", "replace")
            whole = _union(*np.array([(s["low"], s["high"]) for s in spans], np.int64).T)
            left = [raw[a:b] for a, b in zip([0, *(e for _, e in whole)], [*(s for s, _ in whole), len(raw)])]
            out.append((doc_id, whole, b"".join(left)))
        yield pd.DataFrame(out, columns=["doc_id", "spans", "kept"])


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                  shard: int = SHARD, spread: int = SPREAD) -> DataFrame:
    """``doc_id, low, high``: byte intervals to remove, one row per window interval, of documents
    that are the smallest of their group of equal texts."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    once = drop_copies(named.filter("id IS NOT NULL"), "id", "text", smallest=True)
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / 10 / PER_PART))
    answers = common_answers(once.mapInPandas(_asked(width, parts), ASKED))
    release(docs.sparkSession)
    placed = materialise(once.mapInPandas(
        _runs(width, answers), "run long, anchor long, doc_id long, start long, bytes binary"))
    distinct = materialise(placed.groupBy("run").agg(
        F.min("anchor").alias("anchor"), F.min("doc_id").alias("doc_id"), F.max("bytes").alias("bytes"),
        F.when(F.min("doc_id") == F.max("doc_id"), 1).otherwise(2).alias("docs")))
    release(docs.sparkSession)
    hot = materialise(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > spread).select("anchor"))
    marked = distinct.join(hot.withColumn("hot", F.lit(True)), "anchor", "left")
    total = distinct.agg(F.sum(F.octet_length("bytes") + 1)).first()[0] or 0
    shards = max(1, math.ceil(total / shard))
    solved = marked.filter("hot IS NULL").drop("hot").withColumn(
        "shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(
        _shard(width), "run long, low long, high long, least long").unionByName(_by_window(marked.filter("hot"), width))
    answered = materialise(solved.groupBy("run").agg(F.collect_list(F.struct("low", "high", "least")).alias("answers")))
    release(docs.sparkSession)
    told = placed.select("run", "doc_id", "start").join(answered, "run")  # hot runs: Spark splits skewed partitions
    return told.select("doc_id", "start", F.explode("answers").alias("a")).filter("a.least < doc_id").select(
        "doc_id", (F.col("start") + F.col("a.low")).alias("low"), (F.col("start") + F.col("a.high") + width).alias("high"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, shard: int = SHARD,
          spread: int = SPREAD) -> DataFrame:
    """Documents that lose bytes and are the smallest of their equals: ``doc_id``, removed
    byte ``spans`` and the ``kept`` bytes."""
    spans = removed_spans(docs, id_col, text_col, width, shard, spread).groupBy("doc_id").agg(
        F.collect_list(F.struct("low", "high")).alias("spans"))
    spans = materialise(spans)
    release(docs.sparkSession)
    texts = only_ids(docs, id_col, spans, "doc_id").select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).dropDuplicates(["doc_id"])
    return texts.join(spans, "doc_id").mapInPandas(
        _cut, "doc_id long, spans array<struct<low: long, high: long>>, kept binary")


def op10_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha")))
    cut = materialise(dedup(docs).select(
        "doc_id", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["high"] - s["low"]).alias("lost"),
        F.size("spans").cast("long").alias("spans"), F.sha2("kept", 256).alias("kept")))
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("first"))
    known = spread_join(rows, first, ["sha"], "doc_id").join(cut, "doc_id", "left")
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= WIDTH)
    return known.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("lost", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


ORACLE = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM bytes)),
lost AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) WHERE first < doc_id),
islands AS (
  SELECT doc_id, i, sum(CASE WHEN i <= p + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) AS p FROM lost)),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM islands GROUP BY doc_id, k),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT s.doc_id, max(s.b), any_value(n) FROM spans s JOIN bytes USING (doc_id) GROUP BY s.doc_id),
kept AS (
  SELECT doc_id, sha256(unhex(string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b))) AS sha
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       coalesce(sha, sha256(unhex(h))) AS kept_sha256
FROM bytes LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
