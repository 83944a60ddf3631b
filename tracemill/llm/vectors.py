"""Vectors of whole numbers in blocks, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True if ``vector`` is there and has neither null nor infinite components nor NaN."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def scaled(vector: Column, scale: int, bound: int) -> Column:
    """Each component x as floor(scale * x); what lies beyond ``bound`` becomes ``bound``."""
    def whole(x):
        return F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(bound))), F.lit(-float(bound)))).cast("int")

    return F.transform(vector, whole)


def matrix(column: pd.Series, dims: int) -> np.ndarray:
    """The arrays of a column as the rows of a matrix, filled with zeros up to ``dims``."""
    out = np.zeros((len(column), dims), np.int64)
    for row, values in enumerate(column):
        out[row, : len(values)] = values
    return out


def in_blocks(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The rows of all frames in frames of ``rows``, the last one shorter."""
    held: list[pd.DataFrame] = []
    count = 0
    for frame in frames:
        held.append(frame)
        count += len(frame)
        if count >= rows:
            whole = pd.concat(held, ignore_index=True)
            cut = count - count % rows
            for start in range(0, cut, rows):
                yield whole.iloc[start:start + rows]
            held, count = [whole.iloc[cut:]], count - cut
    if count:
        yield pd.concat(held, ignore_index=True)
