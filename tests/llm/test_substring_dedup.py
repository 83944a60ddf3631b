import hashlib
import random
import time

import numpy as np
import pytest

from tests.llm.conftest import ROWS
from tracemill.llm import shared
from tracemill.llm import suffix_array as sa
from tracemill.llm.anchors import Runs, leftmost_min
from tracemill.llm.shared import ASKED, Answers, asked, common_answers
from tracemill.llm.substring_dedup import dedup, smallest_ids
from tracemill.session import release


@pytest.mark.parametrize(("small", "alphabet"), [(4, 2), (4, 8), (4, 1024), (1 << 20, 1024)])
def test_suffix_array_and_common_prefixes(monkeypatch, small, alphabet):
    monkeypatch.setattr(sa, "SMALL", small)
    monkeypatch.setattr(sa, "ALPHABET", alphabet)
    rng = random.Random(small + alphabet)
    for turn in range(120):
        data = bytes(rng.randrange(rng.choice([1, 2, 3, 10, 200])) for _ in range(rng.randint(0, 250))) * (1 + turn % 3)
        order = sa.suffix_array(np.frombuffer(data, np.uint8))
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        common = sa.common_prefixes(np.frombuffer(data, np.uint8), order)
        for x, y in zip(order[:-1], order[1:]):
            n = 0
            while max(x, y) + n < len(data) and data[x + n] == data[y + n]:
                n += 1
            assert common[y] == n


def test_smallest_ids():
    rng = random.Random(3)
    runs = [bytes(rng.randrange(97, 99) for _ in range(rng.randint(6, 30))) for _ in range(40)]
    ids = np.array([rng.randrange(100) for _ in runs])
    least = {}
    for run, own in zip(runs, ids):
        for i in range(len(run) - 5):
            least[run[i:i + 6]] = min(own, least.get(run[i:i + 6], 999))
    for run, got in zip(runs, smallest_ids(runs, ids, 6)):
        assert got.tolist() == [least[run[i:i + 6]] for i in range(len(run) - 5)]


def by_hand(rows, width=50):
    first, out = {}, {}
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    for i in sorted(texts):
        gone = np.zeros(len(texts[i]), bool)
        for k in range(len(texts[i]) - width + 1):
            if first.setdefault(texts[i][k:k + width], i) != i:
                gone[k:k + width] = True
        out[i] = bytes(b for b, g in zip(texts[i], gone) if not g)
    return out, texts


@pytest.mark.parametrize("spread", [8192, 3])
def test_equals_brute_force(spark, spread):
    """With a small limit most anchors are spread over windows."""
    rng = random.Random(7)
    parts = ["".join(rng.choice("ab é") for _ in range(rng.randint(20, 160))) for _ in range(25)]
    rows = [(i, "".join(rng.choice(parts)[rng.randrange(30):] for _ in range(rng.randint(0, 5)))) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(10)]
    wanted, texts = by_hand(rows)
    got = {r.doc_id: r for r in dedup(spark.createDataFrame(rows, "doc_id long, text string"), shard=2000, spread=spread).collect()}
    seen = set()
    for i, text in texts.items():
        if text in seen and len(text) >= 50:
            assert wanted[i] == b"" and i not in got  # equal texts enter once
            continue
        seen.add(text)
        assert (bytes(got[i].kept) if i in got else text) == wanted[i]
        if i in got:
            assert sum(s.high - s.low for s in got[i].spans) == len(text) - len(wanted[i])
            assert all(a.high < b.low for a, b in zip(got[i].spans, got[i].spans[1:]))


def test_leftmost_min_does_not_depend_on_the_place():
    rng = np.random.default_rng(9)
    values = rng.integers(0, 3, 13000).astype(np.uint64) << np.uint64(12)
    values[4000:4300] = values[8100:8300] = 0
    for width in (2, 12, 35):
        assert leftmost_min(values, width).tolist() == [i + int(values[i:i + width].argmin()) for i in range(len(values) - width + 1)]


def test_equal_windows_have_equal_keys_wherever_they_stand():
    """Repeated bytes around the places where the low bits of a place start anew."""
    region = b"abc" + b"=" * 60 + bytes(range(97, 122)) + b"* * * * * * * * * * * * * * * * * * * * * * * * * * * * * *"
    keys = []
    for before in (0, 4000, *range(4010, 4100, 7), 8150):
        data = np.frombuffer(b"\xff" * before + region, np.uint8)
        runs = Runs(data, np.array([before, before + len(region)]), 50)
        mine = runs.owner == 1
        keys.append([(int(a - before), int(f - before), int(last - before)) for a, f, last in
                     zip(runs.at[mine], runs.first[mine], runs.last[mine])])
    assert all(k == keys[0] for k in keys)


def test_repeated_bytes_equal_brute_force(spark):
    rng = random.Random(10)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    runs = ["=" * 60, "* " * 40, "0" * 90, "-+-" * 25, " " * 60]
    rows = []
    for k in range(60):  # each region once near the start of a text, once around a multiple of 4096 of it
        region = letters(3) + runs[k % 5] + letters(30)
        rows += [(k, letters(rng.randrange(40)) + region + letters(20)),
                 (100 + k, letters(4096 * rng.randint(1, 2) - rng.randrange(len(region))) + region + letters(20))]
    wanted, texts = by_hand(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(60, "doc_id")
    got = {r.doc_id: bytes(r.kept) for r in dedup(table, shard=20000).collect()}
    assert {i: got.get(i, text) for i, text in texts.items()} == wanted


def test_no_filter_of_fixed_size_stands_between(spark, monkeypatch):
    """Such a filter lets every run pass once the table is large enough, and all runs are written."""
    monkeypatch.setattr(shared, "any_filter", lambda *_: pytest.fail("a filter of fixed size"))
    rows = [(i, f"{i * 7919:05d} begins here, " + "a passage that two documents have, word for word, in full" * (i < 2)) for i in range(9)]
    wanted, texts = by_hand(rows)
    got = {r.doc_id: bytes(r.kept) for r in dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got.get(i, text) for i, text in texts.items()} == wanted and 1 in got


def test_answers_tell_exactly_what_others_have(spark):
    rng = np.random.default_rng(4)
    common = rng.integers(-1 << 62, 1 << 62, 500) * 2
    keys = [np.concatenate([rng.integers(-1 << 62, 1 << 62, 3000) * 2, common[rng.random(500) < 0.6]]) for _ in range(4)]
    keys[3] = np.concatenate([keys[3], keys[3][:7]])  # twice in one batch: of one owner, or of two
    owners = [np.full(len(k), i) for i, k in enumerate(keys)]
    owners[3][-3:] = 9
    holders = {}
    for k, o in zip(keys, owners):
        for key, owner in zip(k.tolist(), o.tolist()):
            holders.setdefault(key, set()).add(owner)

    def ask(frames):
        for frame in frames:
            for i in frame["id"]:
                yield asked(keys[i], owners[i], 5)

    answers = Answers(common_answers(spark.range(4).repartition(3).mapInPandas(ask, ASKED)))
    for k in keys:
        order = rng.permutation(len(k))
        assert answers(k[order]).tolist() == [len(holders[key]) > 1 for key in k[order].tolist()]
    assert answers(keys[0][1:]).all()  # did not ask
    assert answers(np.zeros(0, np.int64)).tolist() == []


def test_shuffle_files_of_finished_jobs_go(spark, tmp_path):
    """Spark deletes them once the plans are forgotten, else whenever the driver happens to collect."""
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def left():
        seen = [-1, manager.getAllFiles().size()]
        while seen[-1] != seen[-2]:
            release(spark)
            time.sleep(0.5)
            seen.append(manager.getAllFiles().size())
        return seen[-1]

    before = left()
    for i in range(3):
        spark.range(20000).repartition(7, "id").write.parquet(str(tmp_path / f"{i}"))
    assert manager.getAllFiles().size() > before
    assert left() <= before


def test_edge_rows(edge, empty):
    wanted, _ = by_hand([(i, t) for i, t, _ in ROWS])
    got = {r.doc_id: hashlib.sha256(r.kept).digest() for r in dedup(edge).collect()}
    assert got == {9: hashlib.sha256(wanted[9]).digest()}
    assert dedup(empty).count() == 0
