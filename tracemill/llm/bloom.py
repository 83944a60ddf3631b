"""A blocked Bloom filter made and probed with built-in functions.

A hash falls into one block and sets two of its cells. The filter is a table of
at most ``BLOCKS`` rows of 4 KiB, which bounds what is broadcast; when more hashes
come in than it separates, it lets more rows pass and loses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import fresh

#: Cells of one block; the built-in bitmap functions fix this number.
CELLS = 32768
#: Blocks of the filter: 8 MiB in all.
BLOCKS = 2048


def _cells(hashed: Column) -> list[Column]:
    return [F.pmod(F.shiftrightunsigned(hashed, shift), F.lit(CELLS)).cast("int") for shift in (16, 40)]


def cells_hit(hashes: DataFrame, hashed: str, least: int, blocks: int = BLOCKS, by: str | None = None) -> DataFrame:
    """One row ``block, cells`` per block, and for each value of ``by``; ``cells`` marks those hit ``least`` times or more."""
    keys = ["block"] if by is None else [by, "block"]
    hit = hashes.select(*keys[:-1], F.pmod(F.col(hashed), F.lit(blocks)).alias("block"),
                        F.explode(F.array(*_cells(F.col(hashed)))).alias("cell"))
    often = hit.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return often.groupBy(*keys).agg(F.expr("bitmap_construct_agg(cell)").alias("cells"))


def _is_set(bits: Column, cell: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(cell / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, F.pmod(cell, F.lit(8))) == 1


def probe(df: DataFrame, hashed: str, filters: DataFrame, flag: str, blocks: int = BLOCKS) -> DataFrame:
    """Add the boolean ``flag``: false means that ``hashed`` is surely not in the filter."""
    block, cells = fresh(df, "_block", "_cells")
    filters = filters.select(F.col("block").alias(block), F.col("cells").alias(cells))
    probed = df.withColumn(block, F.pmod(F.col(hashed), F.lit(blocks))).join(F.broadcast(filters), block, "left")
    first, second = (_is_set(F.col(cells), cell) for cell in _cells(F.col(hashed)))
    return probed.withColumn(flag, F.coalesce(first & second, F.lit(False))).drop(block, cells)


def flag_repeats(df: DataFrame, hashed: str, flag: str, blocks: int = BLOCKS) -> DataFrame:
    """Add ``flag``: false means that no other row of ``df`` has the same ``hashed``."""
    return probe(df, hashed, cells_hit(df, hashed, 2, blocks), flag, blocks)


def _probe_ids(df: DataFrame, id_col: str, ids: DataFrame, ids_col: str, hashed: str, flag: str) -> DataFrame:
    wanted = cells_hit(ids.select(F.xxhash64(F.col(ids_col).cast("long")).alias("h")), "h", 1)
    return probe(df.withColumn(hashed, F.xxhash64(F.col(id_col).cast("long"))), hashed, wanted, flag).drop(hashed)


def only_ids(df: DataFrame, id_col: str, ids: DataFrame, ids_col: str = "id") -> DataFrame:
    """Rows of ``df`` whose id may be among ``ids``, found without moving ``df``; a join by id must follow."""
    hashed, flag = fresh(df, "_hashed", "_flag")
    return _probe_ids(df, id_col, ids, ids_col, hashed, flag).filter(F.col(flag)).drop(flag)


def without_ids(df: DataFrame, id_col: str, ids: DataFrame, ids_col: str) -> DataFrame:
    """Rows of ``df`` whose id is not among ``ids``; only those that may be are shuffled. Null ids stay."""
    hashed, flag, key = fresh(df, "_hashed", "_flag", "_key")
    probed = _probe_ids(df, id_col, ids, ids_col, hashed, flag)
    maybe = probed.filter(F.col(flag)).drop(flag)
    gone = ids.select(F.col(ids_col).alias(key))
    stay = maybe.join(gone, F.col(id_col) == F.col(key), "left_anti")
    return probed.filter(~F.col(flag)).drop(flag).unionByName(stay)
