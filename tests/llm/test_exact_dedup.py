import hashlib

from tests.llm.conftest import ROWS
from tracemill.llm.exact_dedup import decisions, drop_copies


def test_edge_rows(edge):
    got = decisions(edge).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for doc_id, text, _ in ROWS:
        groups.setdefault(text or "", []).append(doc_id)
    for r in got:
        text = next(t or "" for i, t, _ in ROWS if i == r.doc_id and hashlib.sha256((t or "").encode()).hexdigest() == r.text_sha256)
        ids = [i for i in groups[text] if i is not None]
        assert r.group_size == len(groups[text])
        assert r.keep_id == (max(ids) if ids else None)
        assert r.kept == (r.doc_id == r.keep_id)


def test_full_filter_loses_nothing(edge):
    """With one block the filter is as good as full; the rows are the same."""
    key = lambda df: sorted((str(r.doc_id), r.text_sha256, str(r.keep_id), r.group_size) for r in df.collect())
    assert key(decisions(edge, blocks=1)) == key(decisions(edge))


def test_drop_copies(edge, empty):
    largest, smallest = drop_copies(edge), drop_copies(edge, smallest=True)
    assert largest.columns == edge.columns
    texts = sorted({t or "" for _, t, _ in ROWS})
    for kept, chosen in ((largest, max), (smallest, min)):
        rows = kept.collect()
        assert sorted(r.text or "" for r in rows) == texts
        same = next(r for r in rows if r.text == "the thing is what it is")
        assert same.doc_id == chosen(1, 2)
    assert drop_copies(empty).count() == decisions(empty).count() == 0


def test_hot_group(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', CAST(id AS STRING)) AS text")
    got = decisions(rows)
    assert got.filter("group_size = 1000 AND keep_id = 2997").count() == 1000
    assert got.filter("kept").count() == 2001
