import re

import corpus_pipeline
from tests.llm.conftest import ROWS
from tests.llm.test_jaccard_join import by_hand
from tracemill.llm.packing import cut

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    kept, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r.doc_id: r for r in kept.collect()}
        kept = stage(spark, kept, SF)
        assert kept.columns == columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        after = {r.doc_id: r for r in kept.collect()}
        assert all(after[i] == before[i] for i in after)
        if name == "language ID":
            assert len(after) > 0.98 * len(before)
        elif name == "exact dedup":
            last = {r.text: max(r2.doc_id for r2 in before.values() if r2.text == r.text) for r in before.values()}
            assert set(after) == set(last.values())
        elif name == "n-gram Jaccard join":
            assert set(after) == {c for c, _ in by_hand([(i, r.text) for i, r in before.items()]).values()}
        else:
            words = lambda t: " " + " ".join(re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower())) + " "
            items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {i for i, r in before.items() if not any(x in words(r.text) for x in items)}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == set(after)


def test_edge_rows(edge, empty, spark):
    docs = edge
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), edge.schema)
        assert stage(spark, empty, SF).count() == 0
    ids = {r.doc_id for r in docs.collect()}
    assert 2 in ids and 1 not in ids and 8 in ids and 9 not in ids and 3 not in ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == ids and cut(3, 2) == [(0, 1), (1, 2)]
    assert len(ROWS) > len(ids)
