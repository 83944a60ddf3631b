"""Small helpers the corpus operators share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts that the rows of one key are dealt into before a join.
SALTS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_memory() -> None:
    """Give memory that earlier work of this Python worker no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def spread_join(rows: DataFrame, by_key: DataFrame, keys: list[str], spread: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to one row per key, however many rows a key has.

    The rows of a key are dealt over ``SALTS`` parts by their column ``spread``; the one
    row of the key is first given to each part that exists, a small table.
    """
    salt, = fresh(rows, "_salt")
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    parts = dealt.select(*keys, salt).distinct().join(by_key, keys)
    return dealt.join(parts, [*keys, salt], how).drop(salt)
