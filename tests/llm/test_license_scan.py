import random
import re

from tests.llm.conftest import ROWS
from tracemill.llm import license_scan
from tracemill.llm.license_scan import BASE, TEMPLATES, Automaton, Scanner

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def by_hand(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    places = []
    for phrase, label in BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    first, last = (min(places)[0], max(places)[0]) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted({x for _, x in places}))


def test_matching_statistics():
    rng = random.Random(2)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 4))]
        runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        text = [rng.randrange(4) for _ in range(40)]
        automaton = Automaton(sequences)
        for i, (state, length) in enumerate(automaton.statistics(text)):
            best = max((k for k in range(i + 2) if tuple(text[i + 1 - k:i + 1]) in runs), default=0)
            assert length == best
            if length:
                shown = {(n, e) for n, s in enumerate(sequences) for e in range(length, len(s) + 1)
                         if s[e - length:e] == text[i + 1 - length:i + 1]}
                assert {x for x in automaton.ends[state] if x[1] >= length} == shown


def test_base_phrases_by_brute_force():
    rng = random.Random(4)
    words = sorted({w for t, _ in BASE + TEMPLATES for w in t.split()})
    few = [w for t, _ in BASE for w in t.split()]
    texts = ["", "MIT License", "mit  LICENSE.", "cc by cc-by", "ÉMIT license", "mit licenseé", "KMIT license", "cc by" * 3]
    texts += [" ".join(rng.choice(words if k % 2 else few) for _ in range(rng.randint(1, 40))) for k in range(1500)]
    for text, got in zip(texts, Scanner().scan(texts)):
        assert got[:5] == by_hand(text), text


def test_spans_of_notices():
    gpl = TEMPLATES[4][0]
    broken = gpl.replace("you can redistribute", "you may well redistribute")
    texts = [f"x y {gpl} z", f"{broken}", "licensed under the apache license version 2 0", "the terms of the house", "all rights are reserved"]
    got = Scanner().scan(texts)
    assert got[0][5] == "gpl,gpl-notice" and got[0][6] == 1.0
    assert {"low": 2, "high": 2 + len(gpl.split()), "label": "gpl-notice"} in got[0][7]
    assert got[1][5] == "gpl,gpl-notice" and 0.8 < got[1][6] <= 1.0
    assert got[2][5] == "apache,apache-2.0"
    assert got[3][5] == "" and got[3][6] < 0.5
    assert got[4][1] == 0


def test_edge_rows(edge, empty):
    got = license_scan.scan_licenses(edge).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(i), by_hand(t or "")[0]) for i, t, _ in ROWS)
    assert all(r.first_word is None for r in got if not r.n_base)
    assert license_scan.scan_licenses(empty).count() == 0
