import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import ROWS
from tracemill.llm import recurrent_lm as lm
from tracemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def vocabulary(n=40):
    token = np.concatenate([np.arange(1, n, dtype=np.uint64), [lm.END]])
    return lm.Vocabulary(token, np.arange(n, 0, -1), 900, n + 7, size=20)


def test_probabilities_sum_to_one():
    words = vocabulary()
    weights = lm.initial(words)
    weights["classes"] += 0.3
    every = np.arange(len(words.word_class))
    state = np.random.default_rng(1).normal(size=lm.HIDDEN).astype(np.float32)
    logs, _ = lm._output(np.tile(state, (len(every), 1)), every, weights, words)
    assert abs(np.exp(logs.astype(np.float64)).sum() - 1) < 1e-4


def test_gradients():
    words = vocabulary()
    weights = {k: v.astype(np.float64) * 3 for k, v in lm.initial(words).items()}
    rng = np.random.default_rng(2)
    target = rng.integers(0, len(words.word_class), (3, 5))
    given = rng.integers(0, len(words.word_class), (3, 5))
    fresh, counted = rng.random((3, 5)) < 0.2, rng.random((3, 5)) < 0.9
    start = rng.normal(size=(3, lm.HIDDEN))

    def loss(w):
        state, total = start, 0.0
        for t in range(5):
            state = lm._cell(w["embed"][given[:, t]] @ w["into"] + w["bias"], state * ~fresh[:, t, None], w)[-1]
            total -= lm._output(state, target[:, t], w, words)[0][counted[:, t]].sum()
        return total / counted.sum()

    gradients, _ = lm._window(given, target, fresh, counted, start, weights, words)
    for name in weights:
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in weights[name].shape)
            up, down = ({k: v.copy() for k, v in weights.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - gradients[name][at]) < 1e-5, name


def test_state_runs_through_the_whole_document():
    words = vocabulary()
    weights = lm.initial(words)
    numbers = np.random.default_rng(4).integers(0, len(words.word_class), 300)
    whole = lm.log_likelihood(numbers, np.array([0, 300]), weights, words)
    beside = lm.log_likelihood(np.concatenate([numbers[:7], numbers, numbers[:90]]), np.array([0, 7, 307, 397]), weights, words)
    assert np.allclose(whole, beside[7:307], atol=1e-4)


def test_base_score_and_held_out_gain(spark):
    got = {r.doc_id: r for r in QUERIES["op7_recurrent_lm"](spark, SF).collect()}
    docs = {r.doc_id: r.text.encode().lower().split() + [b"\0end"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, words in docs.items() if not held(i) for w in words)
    n, v = sum(counts.values()), len(counts)
    assert got.keys() == docs.keys()
    for i, words in docs.items():
        r = got[i]
        wanted = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(words), sum(w in counts for w in words), n)
        assert abs(r.base_score - wanted) < 1e-6 * abs(wanted)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > 0.97 * sum(r.base_score for r in unseen)  # both are negative


def test_edge_rows(edge, empty, monkeypatch):
    got = lm.score_documents(edge, F.col("doc_id") > 2).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted(
        (str(i), len((t or "").encode().split()) + 1) for i, t, _ in ROWS)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm.score_documents(empty, F.lit(True)).count() == 0
    untrained = lm.score_documents(edge.limit(4), F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in untrained)
    # few frequent tokens: most counts come by the join, and the scores stay the same
    monkeypatch.setattr(lm, "FREQUENT", 2100)
    less = lm.score_documents(edge, F.col("doc_id") > 2).collect()
    key = lambda rows: sorted((str(r.doc_id), r.n_known, round(r.base_score, 6)) for r in rows)
    assert key(less) == key(got)
