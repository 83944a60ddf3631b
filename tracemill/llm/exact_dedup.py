"""Exact deduplication by two-pass Bloom filtering, with built-in functions only.

Pass one hashes every text into the cells of a blocked Bloom filter and keeps
the cells that were hit at least twice. Pass two probes each text: if one of its
cells was hit only once, no other text is equal, and the row passes straight
through. Only the rest, by SHA-256, is shuffled and grouped.

Defined cases: a null text counts as empty; rows with equal id and equal text are
all ``kept`` in :func:`decisions` (they share the id that stays) and become one
row in :func:`drop_copies`; a null id never wins against another id; an empty
table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.bloom import BLOCKS, cells_hit, flag_repeats, probe
from tracemill.llm.common import fresh, spread_join, table
from tracemill.session import materialise


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """One row per document: which id of its group of equal texts stays."""
    keyed = docs.select(F.col(id_col).alias("id"), _text(text_col).alias("text"))
    keyed = keyed.withColumn("hashed", F.xxhash64("text"))
    digests = materialise(flag_repeats(keyed, "hashed", "maybe", blocks)
                          .select("id", F.sha2("text", 256).alias("sha"), "maybe"))
    alone = digests.filter(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    again = digests.filter("maybe").select("id", "sha")
    groups = again.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    grouped = spread_join(again, groups, ["sha"], "id").select("id", "keep_id", "group_size", "sha")
    return alone.unionByName(grouped).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS,
                smallest: bool = False) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest (or smallest) id.

    Rows whose text is surely alone pass straight through each time the result is read; those
    that stay of the others are written once, and so is the filter.
    """
    hashed, maybe, sha, keep = fresh(docs, "_hashed", "_maybe", "_sha", "_keep")
    keyed = docs.withColumn(hashed, F.xxhash64(_text(text_col)))
    flagged = probe(keyed, hashed, materialise(cells_hit(keyed, hashed, 2, blocks)), maybe, blocks)
    again = flagged.filter(F.col(maybe)).withColumn(sha, F.sha2(_text(text_col), 256))
    groups = again.groupBy(sha).agg((F.min if smallest else F.max)(id_col).alias(keep))
    stay = spread_join(again, groups, [sha], id_col).filter(F.col(id_col).eqNullSafe(F.col(keep))).dropDuplicates([sha])
    return flagged.filter(~F.col(maybe)).select(*docs.columns).unionByName(materialise(stay.select(*docs.columns)))


def op6_exact_dedup(spark, sf_dir):
    return decisions(table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
