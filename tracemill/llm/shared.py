"""Which hashes two documents or more have in common, found without a row per hash.

Every batch sends its sorted distinct hashes in one block of bytes per part, so a hash
that very many documents have arrives once per batch. A task compares one part. What it finds
comes back as a Bloom filter of fixed size, which lets more pass the fuller it is, or as one bit
for each hash that a batch sent, which a later pass over the same batches reads.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tracemill.llm.bloom import BLOCKS, CELLS, cells_hit
from tracemill.llm.words import mix
from tracemill.session import write_by

#: Hashes that one task compares.
PER_PART = 1 << 20
#: Bytes of a hash that are sent; the part stands for the highest ones. Two hashes that only
#: differ in the others both pass, which costs work and loses nothing.
KEPT = 5
BLOBS = "part int, hashes binary"
#: Blobs of batches that are answered, and the answers.
ASKED = "batch long, part int, hashes binary"
ANSWERS = "batch long, part int, n int, bits binary"


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _short(part: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What a filter holds of a hash: its part and its ``KEPT`` lowest bytes, spread over 64 bits."""
    return mix((part.astype(np.uint64) << np.uint64(8 * KEPT)) | low).view(np.int64)


def _name(distinct: np.ndarray) -> int:
    """A number for a batch, from its sorted distinct hashes."""
    return int.from_bytes(hashlib.blake2b(distinct.tobytes(), digest_size=8).digest(), "little", signed=True)


def asked(hashes: np.ndarray, owners: np.ndarray, parts: int) -> pd.DataFrame:
    """:func:`blobs` with the name of the batch, to be answered."""
    return blobs(hashes, owners, parts).assign(batch=_name(np.unique(hashes.view(np.uint64) & ~np.uint64(1))))


def blobs(hashes: np.ndarray, owners: np.ndarray, parts: int) -> pd.DataFrame:
    """The hashes of a batch by part; the lowest bit tells that two owners of the batch have it."""
    hashes = hashes.view(np.uint64) & ~np.uint64(1)
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    if not len(hashes):
        return pd.DataFrame({"part": pd.Series([], dtype="int32"), "hashes": pd.Series([], dtype=object)})
    starts = np.flatnonzero(np.concatenate([[True], np.diff(hashes) != 0]))
    several = np.minimum.reduceat(owners, starts) != np.maximum.reduceat(owners, starts)
    hashes = hashes[starts] | several.astype(np.uint64)
    part = _part(hashes, parts)
    low = hashes.view(np.uint8).reshape(-1, 8)[:, :KEPT]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    return pd.DataFrame({"part": part[cuts[:-1]].astype("int32"),
                         "hashes": [low[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]})


def _sent(frame: pd.DataFrame) -> np.ndarray:
    raw = np.frombuffer(b"".join(frame["hashes"]), np.uint8).reshape(-1, KEPT)
    every = np.zeros((len(raw), 8), np.uint8)
    every[:, :KEPT] = raw
    return every.view(np.uint64).ravel()


def _in_several(frame: pd.DataFrame) -> pd.DataFrame:
    every = np.sort(_sent(frame))
    bare = every >> np.uint64(1)
    starts = np.flatnonzero(np.concatenate([[True], np.diff(bare) != 0]))
    count = np.diff(np.append(starts, len(bare)))
    several = np.bitwise_or.reduceat(every & np.uint64(1), starts).astype(bool)
    low = bare[starts[(count > 1) | several]] << np.uint64(1)
    return pd.DataFrame({"hash": _short(np.full(len(low), frame["part"].iloc[0]), low)})


def _answers(frame: pd.DataFrame) -> pd.DataFrame:
    """For each blob of a part a bit for each of its hashes: whether two owners or more have it."""
    every = _sent(frame)
    order = np.argsort(every)
    bare = every[order] >> np.uint64(1)
    starts = np.flatnonzero(np.concatenate([[True], bare[1:] != bare[:-1]]))
    count = np.diff(np.append(starts, len(bare)))
    several = (count > 1) | np.bitwise_or.reduceat(every[order] & np.uint64(1), starts).astype(bool)
    common = np.empty(len(every), bool)
    common[order] = np.repeat(several, count)
    sizes = frame["hashes"].map(len).to_numpy() // KEPT
    ends = np.cumsum(sizes).tolist()
    return pd.DataFrame({"batch": frame["batch"].to_numpy(), "part": frame["part"].to_numpy(), "n": sizes.astype("int32"),
                         "bits": [np.packbits(common[a:b]).tobytes() for a, b in zip([0, *ends], ends)]})


def common_answers(batches_asked: DataFrame) -> str:
    """Where :class:`Answers` finds which hashes of each batch two owners or more have."""
    return write_by(batches_asked.groupBy("part").applyInPandas(_answers, ANSWERS), "batch")


class Answers:
    """Tells which hashes of a batch two owners or more have. A batch that did not ask, as where texts come in other
    batches than before, hears that all may be: that costs work and loses nothing."""

    def __init__(self, folder: str):
        from pyarrow.fs import FileSystem

        self.system, self.root = FileSystem.from_uri(folder)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        bare = hashes.view(np.uint64) & ~np.uint64(1)
        order = np.argsort(bare)
        ascending = bare[order]
        new = np.concatenate([[True], ascending[1:] != ascending[:-1]])[:len(bare)]
        common = self._bits(_name(ascending[new]))
        found = np.ones(len(hashes), bool)
        if common is not None:
            found[order] = common[np.cumsum(new) - 1]
        return found

    def _bits(self, batch: int) -> np.ndarray | None:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSelector

        files = self.system.get_file_info(FileSelector(f"{self.root}/batch={batch}", allow_not_found=True))
        for file in sorted((f for f in files if f.path.endswith(".parquet")), key=lambda f: f.path):
            with self.system.open_input_file(file.path) as source:
                rows = pq.ParquetFile(source).read(["part", "n", "bits"]).sort_by("part").to_pydict()
            parts, first = np.unique(rows["part"], return_index=True)  # two batches with the same hashes have the same answers
            return np.concatenate([np.unpackbits(np.frombuffer(rows["bits"][i], np.uint8), count=rows["n"][i])
                                   for i in first.tolist()]).astype(bool)
        return None


def common_filters(batch_blobs: DataFrame, kinds: int) -> list[Broadcast]:
    """:func:`common_filter` for each ``kind`` of blobs, from one pass."""
    common = batch_blobs.groupBy("kind", "part").applyInPandas(
        lambda frame: _in_several(frame).assign(kind=frame["kind"].iloc[0]), "hash long, kind int")
    rows = cells_hit(common, "hash", 1, by="kind").collect()
    return [batch_blobs.sparkSession.sparkContext.broadcast(
        [(r["block"], bytes(r["cells"])) for r in rows if r["kind"] == kind]) for kind in range(kinds)]


def any_filter(hashes: DataFrame, hashed: str) -> Broadcast:
    """A Bloom filter of bounded size with all ``hashed``, on all executors."""
    rows = [(r["block"], bytes(r["cells"])) for r in cells_hit(hashes, hashed, 1).collect()]
    return hashes.sparkSession.sparkContext.broadcast(rows)


class Filter:
    """Probes the filter of :func:`common_filter`, or by ``has`` that of :func:`any_filter`, for whole arrays of hashes."""

    def __init__(self, rows, parts: int = 1):
        self.parts = parts
        self.bits = np.zeros((BLOCKS, CELLS // 8), np.uint8)
        for block, cells in rows:
            self.bits[block] = np.frombuffer(cells, np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        bare = hashes.view(np.uint64) & ~np.uint64(1)
        return self.has(_short(_part(bare, self.parts), bare & np.uint64((1 << 8 * KEPT) - 1)))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        block = np.mod(hashes, BLOCKS)
        found = np.ones(len(hashes), bool)
        for shift in (16, 40):
            cell = ((hashes.view(np.uint64) >> np.uint64(shift)) % np.uint64(CELLS)).astype(np.int64)
            found &= (self.bits[block, cell // 8] >> (cell % 8).astype(np.uint8)) & 1 == 1
        return found
