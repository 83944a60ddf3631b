import random
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from tests.llm.conftest import ROWS
from tracemill.llm import packing

ODD = ["", " ", "  a", "a  b\n\n c", "\n", "a\n", "don't we'll\n\n\nx", "tab\tx \t y", "a_b __ 12ab 3.5%%", "\r\n x", "é1²",
       "x <|endoftext|> y", "'s 'S it's", "\x1c\x85 x", "ÀÖ×÷ øɏ", "a\n b", "　x", "１２3 x½"]


def reference(texts):
    """The ids of the tokenizer as it comes, text by text."""
    whole = Tokenizer.from_file(packing.default_tokenizer())
    return [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_equal_the_tokenizers(spark):
    rng = random.Random(5)
    texts = ODD + [t or "" for _, t, _ in ROWS] + [
        "".join(rng.choice("ab é\n\t '’1_.!ßsStTre日") for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    texts += ["<|endoftext|>", "a<|endoftext|>b <|endoftext|> c", " <|endoftext|>\n", "<|endoftext|", "日 <|endoftext|> x"]
    encoder = packing.ByteBpe(packing.default_tokenizer(), remember=5000)
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == reference(texts)


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "PART", 7)
    rng = random.Random(6)
    texts = ["日" + "".join(rng.choice("ab é\n\t 日1_.!ß  <|\x1c\x85 ") for _ in range(400)) + " <|endoftext|> x" for _ in range(300)]
    encoder = packing.ByteBpe(packing.default_tokenizer())
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == reference(texts)


def test_cut():
    for n in (1, 5, 10, 11, 20, 25):
        parts = packing.cut(n, 10)
        assert sum(x for _, x in parts) == n and all(x == 10 for _, x in parts[1:])
        assert [a for a, _ in parts] == np.cumsum([0] + [x for _, x in parts])[:-1].tolist()


def test_search_empties_bins():
    lengths = np.array([6, 6, 4, 4, 5, 5, 3, 7])
    start = [[0, 2], [1, 3], [4], [5], [6, 7]]
    bins = packing.local_search(start, lengths, 10)
    assert len(bins) == 4 and sorted(sum(bins, [])) == list(range(8)) and all(lengths[b].sum() <= 10 for b in bins)
    # only an exchange of two for one makes room: 8 takes the place of 4 and 3
    lengths = np.array([8, 1, 4, 3, 2, 2])
    bins = packing.local_search([[0, 1], [2, 3], [4], [5]], lengths, 10)
    assert len(bins) == 2


def test_never_worse_than_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = rng.integers(1, 60, 200)
        first = packing.best_fit(lengths, 100)
        bins = packing.local_search(first, lengths, 100)
        assert sorted(sum(bins, [])) == list(range(200)) and max(lengths[b].sum() for b in bins) <= 100
        assert -(-lengths.sum() // 100) <= len(bins) <= len(first)


def test_edge_rows(edge, empty):
    got = packing.pack(packing.pieces(edge, capacity=64), capacity=64, group=50).collect()
    ids = {t: i for t, i in zip([t or "" for _, t, _ in ROWS], reference([t or "" for _, t, _ in ROWS]))}
    wanted = Counter()
    for doc_id, text, _ in ROWS:
        own = ids[text or ""] + [0]
        for k, (start, length) in enumerate(packing.cut(len(own), 64)):
            wanted[doc_id, k, start, length, zlib.crc32(np.array(own[start:start + length], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(packing.pieces(empty)).count() == 0


def test_sequences_are_near_the_bound(spark):
    """No packing has fewer sequences than the tokens fill."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    packed = packing.pack(packing.pieces(docs))
    found, tokens = packed.agg(F.count_distinct("sequence_id"), F.sum("length")).first()
    assert -(-tokens // packing.CAPACITY) <= found <= 1.005 * tokens / packing.CAPACITY + 1
