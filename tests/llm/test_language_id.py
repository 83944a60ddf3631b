import itertools
import zlib

import numpy as np

from tests.llm.conftest import ROWS
from tracemill.llm import language_id
from tracemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    lengths = [1, 4, 0, 6, 2, 6]
    at = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=(at[-1], 3)).astype(np.float32)
    path = language_id.viterbi(scores, at, 1.3)
    value = lambda s, p: sum(s[i][x] for i, x in enumerate(p)) - 1.3 * sum(a != b for a, b in zip(p, p[1:]))
    for a, b in zip(at[:-1], at[1:]):
        best = max((value(scores[a:b], p) for p in itertools.product(range(3), repeat=b - a)), default=0)
        assert abs(value(scores[a:b], path[a:b].tolist()) - best) < 1e-4


def test_held_out_accuracy(spark):
    wanted = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op2_language_id"](spark, SF).collect()
    assert len(got) == len(wanted)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == wanted[r.doc_id] for r in held) / len(held) > 0.97


def model(spark, *more):
    rows = [(1, "the thing with the other", "en"), (2, "der Hund und die Katze", "de"), (3, "Это большая собака и кошка", "ru"), *more]
    return language_id.fit(spark.createDataFrame(rows * 3, "doc_id long, text string, lang string"))


def test_spans_and_scripts(spark):
    mixed = "the thing with the other thing with the Hund und die Katze und der Hund собака и кошка большая"
    docs = spark.createDataFrame([(1, mixed), (2, "кошка"), (3, "..! ² ½ Ⅷ 7"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(docs, model(spark), switch=2.0).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "de", "ru"]
    assert got[1].spans[0].low == 0 and got[1].spans[-1].high == len(mixed.split())
    assert got[2].lang_pred == "ru"
    assert (got[3].lang_pred, got[3].score, got[4].lang_pred) == ("und", 0.0, "und")


def test_edge_rows(edge, empty, spark):
    fitted = language_id.fit(edge.filter(language_id.fold() != 0))
    got = language_id.identify(edge, fitted).collect()
    assert len(got) == len(ROWS)
    assert {str(r.doc_id) for r in got if r.lang_pred == "und"} == {"None", "3", "4", "5", "6"}
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.identify(empty, fitted).count() == 0
    assert {r.lang_pred for r in language_id.identify(edge, language_id.fit(empty)).collect()} == {"und"}
    kept = language_id.keep_known(edge)
    assert kept.schema.names == edge.columns and 3 not in {r.doc_id for r in kept.collect()}
    assert language_id.keep_known(empty).count() == 0
