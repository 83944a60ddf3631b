"""Best-fit packing of documents into token sequences, improved by swap-based local search.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt at random
into groups of bounded size; in each group they are placed best-fit from the longest
down, and then a local search takes the emptiest bin and hands its pieces to other
bins: a piece moves into a gap, one piece is exchanged for a smaller one, or two
pieces for one smaller than both together. Each step raises the sum of squared fills,
until the bin is empty. Bins that stay less than ``settle`` full are pooled over all
groups and packed again in the next round, until one group is left. Only lengths are
shuffled, never tokens or texts.

Defined cases: a null or empty text is the end token alone; repeated rows are packed
each for itself; a null id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import free_memory, table
from tracemill.session import materialise

CAPACITY = 2048
END = 0
#: Pieces that one task packs together.
GROUP = 4096
#: Bins filled to this share are final in the rounds before the last.
SETTLE = 0.995
#: Victims in a row that cannot be emptied before a group's search ends.
PATIENCE = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", settled boolean, sequence_id long, offset long"

#: Texts of these characters alone split alike with the pattern below and with the tokenizer's own.
_UNUSUAL = re.compile("[^\n\t\r -~À-ÖØ-öø-ɏ]")
#: White space where parts do not simply begin at a space or line end; looked for one by one, which is faster than a pattern.
_SPACED = ("  ", "\n\n", " \n", "\n ", "\t")
#: A space between two words.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Characters that the tokenizer gets at once, about; bytes of remembered words.
PART = 1 << 16
REMEMBER = 32 << 20
_SPLIT = re.compile(r"'(?:[st]|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one visible character."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Token ids of texts as little-endian unsigned 32-bit numbers, remembered by word.

    A text of usual characters is split at spaces and line ends, where a token always
    begins, and each part not met before is encoded with the vocabulary's ranks. Any
    other text, and one that holds an added token, goes through the tokenizer itself,
    which is loaded when the first such text comes; long ones in parts that end at words.
    """

    def __init__(self, path: str, remember: int = REMEMBER):
        import tiktoken

        self.path, self.whole = path, None
        symbols = _byte_of_symbol()
        with open(path, encoding="utf-8") as source:
            file = json.load(source)
        added = {t["content"] for t in file.get("added_tokens", [])}
        self.added = re.compile("|".join(map(re.escape, sorted(added))) or r"(?!)")
        ranks = {bytes(symbols[c] for c in token): rank for token, rank in file["model"]["vocab"].items() if token not in added}
        del file
        merge = tiktoken.Encoding("bytes", pat_str=_SPLIT.pattern, mergeable_ranks=ranks,
                                  special_tokens={})._encode_single_piece

        def encode(text):
            return b"".join(array("I", merge(part)).tobytes() for part in _SPLIT.findall(text))

        class Parts(dict):
            """By text between spaces; a part that begins a line keeps its line end, any other had a space before it."""

            held = 0

            def __missing__(self, part):
                ids = encode(part if part[0] == "\n" else " " + part)
                self.held += len(part) + len(ids) + 200  # about what an entry takes
                if self.held > remember:
                    self.clear()
                    self.held = 0
                self[part] = ids
                return ids

        self.parts, self.part = Parts(), encode

    def _by_tokenizer(self, text: str) -> bytes:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        ids, start = [], 0
        while start < len(text):
            # before a single space between two words every split of the tokenizer has a border
            border = _BETWEEN.search(text, start + PART) if len(text) - start > PART else None
            end = border.start() if border else len(text)
            ids.append(np.array(self.whole.encode(text[start:end], add_special_tokens=False).ids, "<u4").tobytes())
            start = end
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        if _UNUSUAL.search(text) or self.added.search(text):
            return self._by_tokenizer(text)
        if text[:1].isspace() or text[-1:] == " " or any(map(text.__contains__, _SPACED)):
            return self.part(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.part(first) + b"".join(map(self.parts.__getitem__, rest))


@lru_cache(maxsize=2)
def _encoder(path: str) -> ByteBpe:
    return ByteBpe(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` tokens; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of every document; ``with_ids`` adds their token ids."""
    path = tokenizer or default_tokenizer()
    end = np.array([END], "<u4").tobytes()

    def encode(batches):
        free_memory()
        encoder = _encoder(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.encode(text or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start: 4 * (start + length)]
                    row = (None if pd.isna(doc_id) else doc_id, k, start, length, zlib.crc32(own))
                    out.append((*row, np.frombuffer(own, "<u4").astype("int64")) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        encode, PIECES + (", ids array<long>" if with_ids else ""))


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices: each piece, from the longest, goes to the fullest bin that holds it."""
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps, bins = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = open_gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps &= ~(1 << gap)
            bins[b].append(i)
        else:
            gap, b = capacity, len(bins)
            bins.append([i])
        if gap - size:
            by_gap[gap - size].append(b)
            open_gaps |= 1 << (gap - size)
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int, patience: int = PATIENCE) -> list[list[int]]:
    """Empty the least filled bins one after the other; bins that are full take no part."""
    fill = [int(lengths[b].sum()) for b in bins]
    done = [b for b, f in zip(bins, fill) if f == capacity]
    part = [list(b) for b, f in zip(bins, fill) if f < capacity]
    if len(part) < 2:
        return done + part
    item = np.array([i for b in part for i in b])
    home = np.repeat(np.arange(len(part)), [len(b) for b in part])
    size = lengths[item].astype(np.int64)
    gap = capacity - np.bincount(home, size, len(part)).astype(np.int64)
    alive, stuck, failures = np.ones(len(part), bool), np.zeros(len(part), bool), 0
    while failures < patience and (gap * alive).sum() >= capacity:
        rest = np.where(alive & ~stuck, gap, -1)
        victim = int(rest.argmax())
        if rest[victim] < 0:
            break
        before = (home.copy(), gap.copy())
        while True:
            own = np.flatnonzero(home == victim)
            if not len(own):
                alive[victim], gap[victim], failures = False, 0, 0
                break
            if not _shrink(victim, own, size, home, gap, alive):
                home, gap = before
                stuck[victim] = True
                failures += 1
                break
    order = np.argsort(home, kind="stable")
    cuts = np.flatnonzero(np.diff(home[order])) + 1
    return done + [part_.tolist() for part_ in np.split(item[order], cuts)]


def _shrink(victim, own, size, home, gap, alive) -> bool:
    """One step that takes tokens out of ``victim``: a move, else the best exchange."""
    own = own[np.argsort(-size[own], kind="stable")]
    others = alive.copy()
    others[victim] = False
    for i in own:
        room = np.where(others & (gap >= size[i]), gap, np.iinfo(np.int64).max)
        target = int(room.argmin())
        if others[target] and gap[target] >= size[i]:
            _carry(i, target, size, home, gap)
            return True
    outside = np.flatnonzero(home != victim)
    slack = gap[home[outside]]
    offers = [(i,) for i in own] + [(own[a], own[b]) for a in range(min(len(own), 12)) for b in range(a)]
    best, chosen = 0, None
    for offer in offers:
        gain = size[list(offer)].sum() - size[outside]
        gain[(gain <= 0) | (gain > slack)] = 0
        k = int(gain.argmax())
        if gain[k] > best:
            best, chosen = int(gain[k]), (offer, outside[k])
    if chosen is None:
        return False
    offer, back = chosen
    target = home[back]
    _carry(back, victim, size, home, gap)
    for i in offer:
        _carry(i, target, size, home, gap)
    return True


def _carry(i, target, size, home, gap) -> None:
    gap[home[i]] += size[i]
    gap[target] -= size[i]
    home[i] = target


def _pack_group(capacity: int, settle: float, last: bool, round_: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["group"].iloc[0])
        group = group.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True])
        lengths = group["length"].to_numpy()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        settled, sequence, offset = (np.zeros(len(group), kind) for kind in (bool, np.int64, np.int64))
        for k, b in enumerate(bins):
            ends = np.cumsum(lengths[b])
            sequence[b], offset[b] = (round_ << 48) | (number << 20) | k, ends - lengths[b]
            settled[b] = last or ends[-1] >= settle * capacity
        return group.drop(columns="group").assign(settled=settled, sequence_id=sequence, offset=offset)

    return pack


def pack(cut_docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, settle: float = SETTLE) -> DataFrame:
    """Give each piece its sequence and its place there."""
    waiting, packed, round_, before = materialise(cut_docs), None, 0, None
    while True:
        n = waiting.count()
        groups = max(1, math.ceil(n / group))
        last = groups == 1 or (before is not None and n > 0.9 * before)
        dealt = waiting.withColumn("group", F.pmod(
            F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(round_)), F.lit(groups)).cast("int"))
        out = materialise(dealt.groupBy("group").applyInPandas(_pack_group(capacity, settle, last, round_), PACKED))
        final = out.filter("settled").drop("settled")
        packed = final if packed is None else packed.unionByName(final)
        if last:
            return packed
        waiting, round_, before = out.filter("NOT settled").select(*cut_docs.columns), round_ + 1, n


def op8_best_fit_packing(spark, sf_dir):
    return pack(pieces(table(spark, sf_dir, "documents")))
