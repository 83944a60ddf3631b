import random
import re

import pytest

from tests.llm.conftest import ROWS
from tracemill.llm import jaccard_join
from tracemill.llm.components import connected_components
from tracemill.llm.jaccard_join import choose_bands, join, keep_one


def by_hand(rows, threshold=0.8):
    sets = {}
    for i, text in rows:
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    links = {a: {b for b in sets if a != b and sets[a] and sets[b]
                 and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])} for a in sets}
    out = {}
    for a in sets:
        seen, todo = {a}, [a]
        while todo:
            todo += [x for x in links[todo.pop()] if x not in seen and not seen.add(x)]
        out[a] = (min(seen), len(links[a]))
    return out


def near_copies(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 20, 80, 150]))]
        rows.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [256, 4])
def test_equals_all_pairs(spark, block):
    """Small blocks split every group over several tasks."""
    rows = near_copies(block, 60)
    got = join(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == by_hand(rows)


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = choose_bands(threshold, 0.999)
        assert bands * rows <= jaccard_join.HASHES and 1 - (1 - threshold ** rows) ** bands >= 0.999
    with pytest.raises(ValueError):
        choose_bands(0.01, 0.9999)


def test_edge_rows(edge, empty):
    got = join(edge).collect()
    assert len(got) == len(ROWS)
    one = {r.doc_id: r for r in got if r.doc_id is not None}
    assert one[1].class_id == 1 and one[2].class_id == 1 and one[1].n_links == 2
    assert one[9].class_id == 8 and one[9].n_links == 1
    assert (one[3].class_id, one[3].n_links) == (3, 0)
    assert all(r.class_id is None and r.n_links == 0 for r in got if r.doc_id is None)
    kept = sorted(str(r.doc_id) for r in keep_one(edge).collect())
    assert kept == sorted(str(i) for i, _, _ in ROWS if i not in (2, 9))
    assert join(empty).count() == keep_one(empty).count() == 0


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1040)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    neighbours = {}
    for a, b in edges:
        if a != b:
            neighbours.setdefault(a, set()).add(b)
            neighbours.setdefault(b, set()).add(a)
    assert set(found) == set(neighbours)
    for node in neighbours:
        seen, todo = {node}, [node]
        while todo:
            todo += [x for x in neighbours[todo.pop()] if x not in seen and not seen.add(x)]
        assert found[node] == min(seen)
