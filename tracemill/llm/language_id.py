"""Language identification: script ranges, word scores, and Viterbi with a switching penalty.

A model counts, per language of the labelled documents, byte trigrams inside words (hashed to
``BUCKETS`` numbers) and the scripts of the words, over all of them. A word's scores are the
sums of its trigrams' log probabilities; its script, told from the ranges of its UTF-8 lead
bytes, leaves only languages that use that script. Viterbi finds the best sequence of
languages, where a change costs ``SWITCH``; runs of one language are the spans of a text. The
language with the most letters is the text's language, its share of letters the score.

Defined cases: a text that is null or has no letter is ``und`` with score 0; equal scores go to
the language first in order; without any labelled document every text is ``und``; a null id is
not held out and not learned from; repeated rows are predicted and learned each for itself.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import table
from tracemill.llm.words import batches

#: Numbers that trigrams are hashed to. A model has at most languages times this many counts.
BUCKETS = 1 << 16
#: Cost of a change of language, in nats.
SWITCH = 12.0
#: Share of a language's words from which a script counts as its own.
SCRIPT_SHARE = 0.001
#: Characters labelled in one go.
CHUNK = 1 << 23
_ASCII_LETTER = re.compile("[A-Za-z]")
SCRIPTS = 12


def _codes() -> tuple[np.ndarray, np.ndarray]:
    """Per byte a letter code (0: none) and a script told from lead bytes (0: Latin)."""
    code = np.zeros(256, np.uint32)
    code[97:123] = np.arange(1, 27)
    code[128:] = np.arange(27, 155)
    script = np.zeros(256, np.uint8)
    ranges = [(0xCA, 0xCD), (0xCE, 0xCF), (0xD0, 0xD3), (0xD4, 0xD7), (0xD8, 0xDF), (0xE0, 0xE0), (0xE1, 0xE1),
              (0xE3, 0xE3), (0xE4, 0xE9), (0xEA, 0xED), (0xF0, 0xF4)]
    for number, (low, high) in enumerate(ranges, 1):
        script[low:high + 1] = number
    return code, script


_CODE, _SCRIPT = _codes()


def _features(texts: list[str]):
    """Trigram number per byte, word starts, their scripts and lengths, and where texts begin among the words."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"  " + b"  ".join(raw) + b" ", np.uint8)
    code = _CODE[data]
    before, last = code[1:-1].copy(), code[:-2].copy()
    now = code[2:]
    last[before == 0] = 0
    gram = (last * np.uint32(155) + before) * np.uint32(155) + now
    number = ((gram * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    number[(now == 0) & (before == 0)] = BUCKETS
    inside = now > 0
    starts = np.flatnonzero(inside & (before == 0))
    at = np.searchsorted(starts, np.cumsum([0] + [len(r) + 2 for r in raw]))
    if not len(starts):
        return number, starts, np.zeros(0, np.uint8), np.zeros(0, np.int64), at
    script = np.maximum.reduceat(_SCRIPT[data[2:]], starts)
    letters = np.add.reduceat(inside.astype(np.int64), starts)
    return number, starts, script, letters, at


def _count(languages: list[str]):
    index = {name: i for i, name in enumerate(languages)}

    def count(frames):
        total = np.zeros((len(languages), BUCKETS + SCRIPTS), np.int64)
        for frame in frames:
            frame = frame[frame["lang"].notna()]
            texts = [t or "" for t in frame["text"]]
            langs = [index[x] for x in frame["lang"]]
            for name in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == name]
                for a, b in batches(own):
                    number, _, script, _, _ = _features(own[a:b])
                    total[name, :BUCKETS] += np.bincount(number, minlength=BUCKETS + 1)[:BUCKETS]
                    total[name, BUCKETS:] += np.bincount(script, minlength=SCRIPTS)
        lang, bucket = np.nonzero(total)
        yield pd.DataFrame({"lang": lang.astype("int32"), "bucket": bucket.astype("int32"), "n": total[lang, bucket]})

    return count


class Model:
    def __init__(self, languages: list[str], counts: pd.DataFrame):
        self.languages = languages
        total = np.zeros((len(languages), BUCKETS + SCRIPTS))
        total[counts["lang"], counts["bucket"]] = counts["n"]
        grams, scripts = total[:, :BUCKETS], total[:, BUCKETS:]
        logs = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * BUCKETS))
        self.scores = np.vstack([logs.T, np.zeros((1, len(languages)))]).astype(np.float32)
        self.fits = (scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)).T & (scripts.T > 0)
        self.fits[~self.fits.any(1)] = True
        self.first = int(scripts.sum(1).argmax()) if len(languages) else 0

    def word_scores(self, texts: list[str]):
        """Scores, letters and where each text's words begin."""
        scores, letters, at = [], [], [np.zeros(1, np.int64)]
        for a, b in batches(texts):
            number, starts, script, count, own = _features(texts[a:b])
            if len(starts):
                summed = np.add.reduceat(self.scores[number], starts, axis=0)
                scores.append(np.where(self.fits[script], summed, np.float32(-1e4)))
                letters.append(count)
            at.append(own[1:] + at[-1][-1])
        width = len(self.languages)
        return (np.concatenate(scores) if scores else np.zeros((0, width), np.float32),
                np.concatenate(letters) if letters else np.zeros(0, np.int64), np.concatenate(at))


def viterbi(scores: np.ndarray, at: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word; texts are ``scores[at[i]:at[i + 1]]`` and run side by side."""
    lengths = np.diff(at)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = at[:-1][order], lengths[order]
    back = np.zeros(scores.shape, np.uint8 if scores.shape[1] <= 256 else np.int32)
    own = np.arange(scores.shape[1])
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right") if len(lengths) and lengths[0] else []
    value = None
    finals = np.zeros(len(lengths), np.int64)
    for t, n in enumerate(alive):
        rows = starts[:n] + t
        if t == 0:
            value = scores[rows].astype(np.float64)
            continue
        ended = value[n:]
        if len(ended):
            finals[n:len(value)] = ended.argmax(1)
        value = value[:n]
        best = value.argmax(1)
        top = value[np.arange(n), best] - switch
        stay = value >= top[:, None]
        back[rows] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, top[:, None]) + scores[rows]
    if value is not None and len(value):
        finals[:len(value)] = value.argmax(1)
    path = np.zeros(len(scores), np.int64)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        rows = starts[:n] + t
        path[rows] = finals[:n]
        if t:
            finals[:n] = back[rows, finals[:n]]
    return path


def _predict(model: Model, switch: float, with_spans: bool):
    def label(texts: list[str]):
        scores, letters, at = model.word_scores(texts)
        path = viterbi(scores, at, switch)
        width = len(model.languages)
        doc = np.repeat(np.arange(len(texts)), np.diff(at))
        shares = np.bincount(doc * width + path, letters, len(texts) * width).reshape(len(texts), width)
        total = shares.sum(1)
        best = np.where(total > 0, shares.argmax(1), model.first)
        share = shares[np.arange(len(texts)), best] / np.maximum(total, 1)
        spans = None
        if with_spans:
            spans = []
            for a, b in zip(at[:-1], at[1:]):
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(path[a:b])) + 1, [b - a]]) if b > a else [0]
                spans.append([(int(x), int(y), model.languages[path[a + x]]) for x, y in zip(cuts[:-1], cuts[1:])])
        return best, share, spans

    def predict(frames):
        for frame in frames:
            texts = frame["text"].tolist()
            out = []
            for a, b in batches([t or "" for t in texts], CHUNK):
                part = [t or "" for t in texts[a:b]]
                lettered = [bool(_ASCII_LETTER.search(t)) or any(map(str.isalpha, t)) for t in part]
                if not model.languages:
                    out += [("und", 0.0, [])] * (b - a)
                    continue
                best, share, spans = label(part)
                for i, has in enumerate(lettered):
                    found = (model.languages[best[i]], float(share[i])) if has else ("und", 0.0)
                    out.append((*found, spans[i] if with_spans and has else []))
            result = frame.drop(columns="text")
            result["lang_pred"], result["score"] = [o[0] for o in out], [o[1] for o in out]
            if with_spans:
                result["spans"] = [[{"low": x, "high": y, "lang": z} for x, y, z in o[2]] for o in out]
            yield result

    return predict


def fold(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5, F.lit(1))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count all of ``labelled``."""
    named = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    languages = sorted(r["lang"] for r in named.groupBy("lang").agg(F.count("text")).collect())
    counts = named.mapInPandas(_count(languages), "lang int, bucket int, n long")
    return Model(languages, counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH,
             with_spans: bool = True) -> DataFrame:
    """``doc_id, lang_pred, score`` and the spans of each text, as ranges of its words."""
    spans = ", spans array<struct<low: int, high: int, lang: string>>" if with_spans else ""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        _predict(model, switch, with_spans), f"doc_id {dict(docs.dtypes)[id_col]}, lang_pred string, score double" + spans)


def keep_known(docs: DataFrame, least: float = 0.25, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """``docs`` without those of no language, or with less than ``least`` of their letters in one.

    Texts of two or three languages stay; a text scattered over more has no language to be used in.
    """
    model = fit(docs.filter(fold(id_col) != 0), text_col, lang_col)
    label = _predict(model, SWITCH, False)
    place = docs.columns.index(text_col)

    def keep(record_batches):
        for batch in record_batches:
            known = pd.concat(label([pd.DataFrame({"text": batch.column(place).to_pylist()})]))
            yield batch.filter(pa.array(((known["lang_pred"] != "und") & (known["score"] >= least)).to_numpy(bool)))

    return docs.mapInArrow(keep, docs.schema)


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(fold() != 0))
    found = identify(docs, model, with_spans=False)
    return found.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")
