"""Benchmark decontamination: BM25 with block-max WAND, then a check of question and answer.

The question of each test item is cut into units of at most ``UNIT`` words, which overlap so that
each of its n-grams stands in one unit, and indexed with BM25 weights over the unit's score for
itself. The index is dealt into shards of bounded size, and every document is searched against each.

The threshold of a unit is derived from ``OVERLAP``, the share of the question's n-grams that makes
a leak: a text with that share has it of some unit too, and ``c`` n-grams cover at least ``c + n - 1``
words of the unit, so its score is at least the sum of that many of the unit's lightest words. So the
search loses no leak: a question without its answer or half an item is found as well as a whole one.

A document is asked by the words of those passages that may hold an n-gram of an item: runs of
``n`` words each two neighbours of which are neighbours in some question. All its passages are one query,
so that n-grams in different places count together. Postings are cut into blocks of units with the
largest weight of each, and block-max WAND returns all units at or above their thresholds.

What it returns is verified by n-grams: a leak has ``OVERLAP`` of those of the question. The answer is
verified the same way: ``answer_overlap`` is its share and ``answer_found`` tells whether it reaches
``OVERLAP``; an item is leaked without it too. A question of fewer than ``NGRAM`` words says nothing alone: its item is
indexed whole, and both the n-grams of the whole item and the question's must reach ``OVERLAP``.
``score`` is the largest share of a unit's own score that one passage has, two blocks of ``UNIT`` words from
``passage_start`` on, so that any run of ``UNIT`` words lies in one passage.

Defined cases: a null text, a text without words and an item without words match nothing; an
item of one sentence is all question and has no answer (overlap and ``answer_found`` null); items with equal id
are found each for itself and reported once with the larger overlap; repeated rows of
documents give one row for each item; a null id is reported as null; empty tables give an
empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.bloom import without_ids
from tracemill.llm.common import table
from tracemill.llm.words import batches, shingle_hashes, word_hashes
from tracemill.session import materialise

UNIT = 64
NGRAM = 5
K1, B = 1.2, 0.75
#: Share of the question's n-grams that a leak must have; the thresholds of the search follow from it.
OVERLAP = 0.5
#: Units of one posting block, and of one shard of the index; a shard has at most SHARD * UNIT postings.
POSTING_BLOCK = 2
SHARD = 4096
LEAKS = ("doc_id long, item_id long, passage_start long, score double, question_overlap double, "
         "answer_overlap double, answer_found boolean")


def question_and_answer(text: str) -> tuple[str, str]:
    """All sentences but the last, and the last; a single sentence is the question."""
    parts = re.split(r"(?<=[.!?])\s+", text.strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def asked_words(text: str) -> np.ndarray:
    """Word hashes of an item's question, or of the whole item where the question has fewer than ``NGRAM`` words."""
    words, _ = word_hashes([question_and_answer(text)[0]])
    return words if len(words) >= NGRAM else word_hashes([text])[0]


def unit_starts(n_words: int) -> range:
    """Where the units of a question begin; each of its n-grams lies in one unit."""
    return range(0, max(n_words - NGRAM, 0) + 1 if n_words else 0, UNIT - NGRAM + 1)


def _unit_terms(frames):
    for frame in frames:
        out = []
        for key, text in zip(frame["key"], frame["text"]):
            hashes = asked_words(text or "")
            for unit, start in enumerate(unit_starts(len(hashes))):
                words = hashes[start:start + UNIT]
                terms, counts = np.unique(words, return_counts=True)
                out += [(key, unit, t, n, len(words)) for t, n in zip(terms.view(np.int64).tolist(), counts.tolist())]
        yield pd.DataFrame(out, columns=["key", "unit", "term", "tf", "length"])


def index_postings(items: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """``key, unit, term, weight``: BM25 weights over the unit's score for itself."""
    terms = materialise(items.select("key", "text").mapInPandas(
        _unit_terms, "key string, unit int, term long, tf int, length int"))
    units = terms.groupBy("key", "unit").agg(F.first("length").alias("length"))
    n, mean = units.agg(F.count(F.lit(1)), F.avg("length")).first()
    found_in = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighed = terms.join(found_in, "term").withColumn(
        "raw", F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (k1 + 1)
        / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.lit(mean or 1.0))))
    own = weighed.groupBy("key", "unit").agg(F.sum("raw").alias("own"))
    return weighed.join(own, ["key", "unit"]).select("key", "unit", "term", (F.col("raw") / F.col("own")).alias("weight"))


def grams_of(words: np.ndarray) -> tuple[int, np.ndarray]:
    """``n`` and the distinct n-grams of some words; fewer than ``NGRAM`` words are one n-gram."""
    n = min(NGRAM, len(words))
    return n, np.unique(shingle_hashes(words, n)) if n else words


class Known:
    """A set of hashes, asked for many at once."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.hashes & np.uint64(0xFFFFF)] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = self.maybe[hashes & np.uint64(0xFFFFF)]
        place = np.flatnonzero(out)
        out[place] = _inside(self.hashes, hashes[place])
        return out


def _inside(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Which of ``asked`` stand in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(asked), bool)
    return known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] == asked


class Index:
    """One shard: postings by term in the order of their units, with block maxima.

    ``share`` is a posting's part of its unit's own score; ``weight`` is the same over the unit's threshold, so that
    the search has the threshold 1 for all units.
    """

    def __init__(self, postings: pd.DataFrame, items: pd.DataFrame, least: float = OVERLAP):
        self.least, self.opened = least, {}
        names = postings[["key", "unit"]].drop_duplicates().sort_values(["key", "unit"]).reset_index(drop=True)
        number = {(k, u): i for i, (k, u) in enumerate(zip(names["key"], names["unit"]))}
        unit = np.array([number[k, u] for k, u in zip(postings["key"], postings["unit"])], np.int64)
        term, share = postings["term"].to_numpy(np.int64).view(np.uint64), postings["weight"].to_numpy()
        self.unit_key, self.n_units = names["key"].tolist(), len(names)
        order = np.lexsort((unit, term))
        self.unit, self.share, term = unit[order], share[order], term[order]
        self.terms, first = np.unique(term, return_index=True)
        self.at = np.append(first, len(term))
        # postings by unit, and the units of each item
        self.by_unit = np.argsort(self.unit, kind="stable")
        self.unit_at = np.searchsorted(self.unit[self.by_unit], np.arange(self.n_units + 1))
        self.units_of: dict[str, list[int]] = {}
        for u, k in enumerate(self.unit_key):
            self.units_of.setdefault(k, []).append(u)
        self._read_items(items)
        self.weight = self.share / self.floor[self.unit] if len(self.unit) else self.share
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)

    def _read_items(self, items: pd.DataFrame) -> None:
        """What verification compares, the threshold of each unit, and the pairs of neighbours in the questions by ``n``."""
        self.items, self.floor, pairs = {}, np.full(self.n_units, np.inf), {}
        for key, item, text in zip(items["key"], items["item_id"], items["text"]):
            question, answer = (grams_of(word_hashes([t])[0]) for t in question_and_answer(text or ""))
            words = asked_words(text or "")
            n, whole = grams_of(words)
            self.items[key] = item, question, answer, (n, whole)
            if not n:
                continue
            pairs.setdefault(n, []).append(shingle_hashes(words, min(n, 2)))
            _, starts = np.unique(shingle_hashes(words, n), return_index=True)  # an n-gram counts where it stands first
            for unit, start in zip(self.units_of[key], unit_starts(len(words))):
                count = int(((starts >= start) & (starts < start + UNIT - NGRAM + 1)).sum())
                if count:
                    self.floor[unit] = self._least_score(unit, words[start:start + UNIT], math.ceil(self.least * count - 1e-9) + n - 1)
        self.pairs = {n: Known(np.concatenate(p)) for n, p in pairs.items()}

    def _least_score(self, unit: int, words: np.ndarray, covered: int) -> float:
        """Share of the unit's score that a text with at least ``covered`` places of these words has for certain."""
        entries = self.by_unit[self.unit_at[unit]:self.unit_at[unit + 1]]
        terms = self.terms[np.searchsorted(self.at, entries, side="right") - 1]
        _, place, times = np.unique(words, return_inverse=True, return_counts=True)
        # a word standing several times in the unit is paid for once, so each place bears a part of it
        cost = self.share[entries][np.argsort(terms)][place] / times[place]
        return float(np.sort(cost)[:covered].sum())

    def asking(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of all words that may be in an n-gram of an item, texts beginning at ``at``."""
        covered = np.zeros(len(words) + 1, np.int64)
        for n, known in self.pairs.items():
            if len(words) < n:
                continue
            near = known.has(shingle_hashes(words, min(n, 2)))
            if n > 1:
                edges = at[1:-1] - 1
                near[edges[(edges >= 0) & (edges < len(near))]] = False  # neighbours in different texts
                run = np.concatenate([[0], np.cumsum(near)])
                near = run[n - 1:] - run[:len(run) - n + 1] == n - 1
            begin = np.flatnonzero(near)
            covered[begin] += 1
            covered[begin + n] -= 1
        return np.flatnonzero(np.cumsum(covered[:-1]) > 0)

    def best_passage(self, key: str, term: np.ndarray) -> tuple[float, int]:
        """Largest score of a unit of the item in a passage of a text of these terms, and where the passage begins."""
        best = (0.0, 0)
        block = np.arange(len(term)) // UNIT
        for unit in self.units_of.get(key, []):
            entries = self.by_unit[self.unit_at[unit]:self.unit_at[unit + 1]]
            own = np.searchsorted(self.at, entries, side="right") - 1  # ascends, as postings are in the order of terms
            slot = np.minimum(np.searchsorted(own, term), len(own) - 1)
            has = np.zeros((-(-len(term) // UNIT) + 1, len(own)), bool)
            hit = own[slot] == term
            has[block[hit], slot[hit]] = True
            scores = (has[:-1] | has[1:]) @ self.share[entries]
            if len(scores) and scores.max() > best[0]:
                best = (float(scores.max()), int(scores.argmax()) * UNIT)
        return best

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Number of each word's term, or -1."""
        if not len(self.terms):
            return np.full(len(words), -1)
        found = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[found] == words, found, -1)

    def postings(self, term: int):
        """Units, weights, block maxima and the largest weight of a term, as plain lists."""
        if term not in self.opened:
            a, b = self.at[term], self.at[term + 1]
            units, weights = self.unit[a:b].tolist(), self.weight[a:b].tolist()
            tops: dict[int, float] = {}
            for u, w in zip(units, weights):
                tops[u // POSTING_BLOCK] = max(w, tops.get(u // POSTING_BLOCK, 0.0))
            self.opened[term] = units, weights, tops, float(self.most[term])
        return self.opened[term]

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """All units that the distinct ``terms`` bring to their thresholds, by block-max WAND."""
        lists = [[0, *self.postings(t)] for t in terms.tolist()]
        found, goal = [], 1 - 1e-9
        while True:
            lists = [x for x in lists if x[0] < len(x[1])]
            lists.sort(key=lambda x: x[1][x[0]])
            total, pivot = 0.0, None
            for i, x in enumerate(lists):
                total += x[4]
                if total >= goal:
                    pivot = x[1][x[0]]
                    break
            if pivot is None:
                return found
            while i + 1 < len(lists) and lists[i + 1][1][lists[i + 1][0]] == pivot:
                i += 1
            block = pivot // POSTING_BLOCK
            if sum(x[3].get(block, 0.0) for x in lists[:i + 1]) < goal:
                # no unit up to the block's end, nor before the next list begins, can reach the goal
                target = (block + 1) * POSTING_BLOCK
                if i + 1 < len(lists):
                    target = min(target, lists[i + 1][1][lists[i + 1][0]])
                self._skip(lists[:i + 1], max(target, pivot + 1))
            elif lists[0][1][lists[0][0]] == pivot:
                score = sum(x[2][x[0]] for x in lists[:i + 1])
                if score >= goal:
                    found.append((pivot, score))
                self._skip(lists[:i + 1], pivot + 1)
            else:
                self._skip([x for x in lists[:i + 1] if x[1][x[0]] < pivot], pivot)

    @staticmethod
    def _skip(lists, target: int) -> None:
        for x in lists:
            while x[0] < len(x[1]) and x[1][x[0]] < target:
                x[0] += 1


class Grams:
    """The n-grams of one document, made when first asked for."""

    def __init__(self, words: np.ndarray):
        self.words, self.made = words, {}

    def overlap(self, n: int, grams: np.ndarray) -> float | None:
        """Share of ``grams`` that stand in the document; none if there are none."""
        if not n:
            return None
        if n not in self.made:
            self.made[n] = np.unique(shingle_hashes(self.words, n))
        return float(_inside(self.made[n], grams).mean())


def find_leaks(index: Index, ids: list, texts: list[str]) -> list[tuple]:
    """The leaks of some documents, one tuple per document and item."""
    words, at = word_hashes(texts)
    place = index.asking(words, at)
    doc, term = np.searchsorted(at, place, side="right") - 1, index.lookup(words[place])
    once = np.unique(doc[term >= 0] * (len(index.terms) + 1) + term[term >= 0])
    doc, term = once // (len(index.terms) + 1), once % (len(index.terms) + 1)
    able = np.flatnonzero(np.bincount(doc, index.most[term], len(ids)) >= 1 - 1e-9)  # all others stay below any threshold
    out = []
    for d, low, high in zip(able.tolist(), np.searchsorted(doc, able), np.searchsorted(doc, able, side="right")):
        own, grams = words[at[d]:at[d + 1]], Grams(words[at[d]:at[d + 1]])
        for key in dict.fromkeys(index.unit_key[unit] for unit, _ in index.search(term[low:high])):
            item, question, answer, whole = index.items[key]
            asked = grams.overlap(*question)
            if asked is None or min(asked, grams.overlap(*whole)) < index.least - 1e-9:
                continue
            replied = grams.overlap(*answer)
            score, start = index.best_passage(key, index.lookup(own))
            out.append((ids[d], item, start, score, asked, replied, None if replied is None else replied >= index.least - 1e-9))
    return out


def _searcher(shared, least: float):
    kept: dict = {}

    def search(frames):
        for frame in frames:
            index = kept.get("index") or kept.setdefault("index", Index(*shared.value, least))
            texts, ids, out = [t or "" for t in frame["text"]], frame["id"].astype("Int64").tolist(), []
            for a, b in batches(texts):
                out += find_leaks(index, [None if i is pd.NA else i for i in ids[a:b]], texts[a:b])
            yield pd.DataFrame(out, columns=[f.split()[0] for f in LEAKS.split(", ")]).astype(
                {"doc_id": "Int64", "item_id": "Int64", "answer_overlap": "float64", "answer_found": "boolean"})

    return search


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", least: float = OVERLAP, shard: int = SHARD) -> DataFrame:
    """One row per document and test item that it has leaked."""
    spark = docs.sparkSession
    named = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).withColumn(
        "key", F.concat_ws(":", F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.sha1(F.coalesce("text", F.lit("")))))
    named = materialise(named.dropDuplicates(["key"]))
    postings = materialise(index_postings(named))
    shards = max(1, math.ceil(postings.select("key", "unit").distinct().count() / shard))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = None
    for number in range(shards):
        mine = F.pmod(F.xxhash64("key"), F.lit(shards)) == number
        shared = spark.sparkContext.broadcast((postings.filter(mine).toPandas(), named.filter(mine).toPandas()))
        part = rows.mapInPandas(_searcher(shared, least), LEAKS)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        "question_overlap", "answer_overlap", "answer_found", "score", "passage_start")).alias("best")).select(
        "doc_id", "item_id", "best.passage_start", "best.score", "best.question_overlap", "best.answer_overlap",
        "best.answer_found")


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that have leaked a test item."""
    found = materialise(leaks(docs, items, id_col, text_col).select("doc_id").distinct())
    return without_ids(docs, id_col, found, "doc_id")


def op5_benchmark_decontamination(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
