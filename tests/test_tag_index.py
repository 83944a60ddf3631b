"""The bitmap index against the tags themselves."""

import random

from tests.conftest import rows
from tracemill.operators import tag_index as ti


def test_any_all_and_counts(table):
    rng = random.Random(3)
    ids = [0, 1, 32767, 32768, 32769, 65536, 10**12, -5, -32768, *range(100, 400)]
    tags = {i: sorted(set(rng.choices("abcde", k=rng.randrange(0, 5)))) for i in ids}
    data = [(i, t) for i, t in tags.items()] + [(7 * 10**9, ["a", "a", None]), (None, ["a"]), (5, None)]
    df = table(data, "recording_id bigint, tags array<string>").repartition(4)
    index = ti.tag_index(df)
    tags |= {7 * 10**9: ["a"], 5: []}
    for wanted in (["a"], ["a", "b"], ["c", "d", "e"], ["zz"], ["a", "zz"]):
        got = rows(ti.having(df, ti.any_of(index, wanted)), "recording_id")
        assert got == sorted([(i,) for i, t in tags.items() if set(t) & set(wanted)], key=repr)
        got = rows(ti.having(df, ti.all_of(index, [*wanted, wanted[0]])), "recording_id")
        assert got == sorted([(i,) for i, t in tags.items() if set(wanted) <= set(t)], key=repr)
    counts = {r.tag: r.episodes for r in ti.tag_totals(index).collect() if r.tag}
    assert counts == {x: sum(x in t for t in tags.values()) for x in "abcde"}
