"""License scan: a generalised suffix automaton of license tokens, and chained long matches.

The automaton holds every run of tokens of all templates. A text is streamed through it, and
its matching statistics tell at each token the longest run ending there that some template
has. Matches that cannot be extended and have at least ``MIN_MATCH`` tokens are placed on
their templates, and matches in the order of a template with at most ``GAP`` tokens between
them are chained. A chain that covers the share ``COVER`` of its template is a span with the
template's label. Only stretches whose neighbouring tokens also are neighbours in a template
need the automaton; they are found for whole batches at once.

The base phrases are templates too; each place where one stands whole counts.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows and
rows with a null id are scanned each for itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import table
from tracemill.llm.words import batches, word_hashes

#: Phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Notices that licenses ask to be placed in files, in lower case without punctuation.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit-notice"),
    ("released under the mit license", "mit-notice"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl-notice"),
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("all rights reserved", "all-rights-reserved"),
]
MIN_MATCH = 2
GAP = 6
COVER = 0.8


class Automaton:
    """Generalised suffix automaton over lists of token numbers."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]  # (sequence, place after its last token)
        for number, sequence in enumerate(sequences):
            last = 0
            for place, token in enumerate(sequence, 1):
                last = self._extend(last, token)
                self.ends[last].add((number, place))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, like: int | None = None) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else 0)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, parent: int, token: int) -> int:
        """The state reached by ``token`` whose longest run is one token more than ``parent``'s."""
        child = self.next[parent][token]
        if self.length[child] == self.length[parent] + 1:
            return child
        clone = self._state(self.length[parent] + 1, like=child)
        while parent >= 0 and self.next[parent].get(token) == child:
            self.next[parent][token] = clone
            parent = self.link[parent]
        self.link[child] = clone
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        new, parent = self._state(self.length[last] + 1), last
        while parent >= 0 and token not in self.next[parent]:
            self.next[parent][token] = new
            parent = self.link[parent]
        self.link[new] = self._split(parent, token) if parent >= 0 else 0
        return new

    def statistics(self, tokens):
        """``state, length`` of the longest known run ending at each token."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            yield state, length


class Scanner:
    def __init__(self, base=BASE, templates=TEMPLATES):
        texts = [t for t, _ in base] + [t for t, _ in templates]
        self.labels, self.n_base = [label for _, label in base] + [label for _, label in templates], len(base)
        hashes, at = word_hashes(texts)
        self.words = np.unique(hashes)
        sequences = [np.searchsorted(self.words, hashes[a:b]) for a, b in zip(at[:-1], at[1:])]
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton([s.tolist() for s in sequences])
        # a row and a column more stand for all other words
        self.pairs = np.zeros((len(self.words) + 1, len(self.words) + 1), bool)
        for s in sequences:
            self.pairs[s[:-1], s[1:]] = True

    def stretches(self, tokens: np.ndarray, at: np.ndarray):
        """``text, first, last`` of stretches of tokens that follow one another in templates."""
        linked = self.pairs[tokens[:-1], tokens[1:]]
        linked[at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(tokens))] - 1] = False
        edge = np.diff(linked.astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        keep = last - first + 1 >= MIN_MATCH
        return np.searchsorted(at, first[keep], side="right") - 1, first[keep], last[keep]

    def matches(self, tokens: list[int], offset: int):
        """Places of base phrases and ``template, text start, template start, length`` of matches that go no further."""
        phrases, found = [], []
        stats = list(self.automaton.statistics(tokens))
        for i, (state, length) in enumerate(stats):
            if length < MIN_MATCH:
                continue
            goes_on = i + 1 < len(stats) and stats[i + 1][1] == length + 1
            for template, end in self.automaton.ends[state]:
                size = self.sizes[template]
                if template < self.n_base and end == size <= length:
                    phrases.append((offset + i + 1 - size, template))
                if not goes_on:
                    fit = min(length, end)
                    found.append((template, offset + i + 1 - fit, end - fit, fit))
                elif end == size:  # the match goes on, but not in this template
                    found.append((template, offset + i + 1 - min(length, end), max(0, end - length), min(length, end)))
            parent = self.automaton.link[state]
            while parent > 0:  # shorter phrases that end here and are no part of the longest run's places
                for template, end in self.automaton.ends[parent] - self.automaton.ends[state]:
                    size = self.sizes[template]
                    if template < self.n_base and end == size <= self.automaton.length[parent]:
                        phrases.append((offset + i + 1 - size, template))
                    if end == size:
                        fit = min(self.automaton.length[parent], end)
                        found.append((template, offset + i + 1 - fit, end - fit, fit))
                state, parent = parent, self.automaton.link[parent]
        return phrases, found

    def spans(self, found):
        """``template, first token, end, share covered`` of the best chain that ends in each match."""
        out = []
        by_template: dict[int, list] = {}
        for template, start, place, size in set(found):
            by_template.setdefault(template, []).append((start, place, size))
        for template, matches in by_template.items():
            matches.sort()
            best = []
            for i, (start, place, size) in enumerate(matches):
                covered, begin, j = size, start, i - 1
                while j >= 0 and matches[j][0] + self.sizes[template] + GAP >= start:
                    before, at, length = matches[j]
                    ahead, further = start - (before + length), place - (at + length)
                    lap = max(0, -ahead, -further)  # tokens that both matches claim
                    if before < start and at < place and ahead <= GAP and lap < size:
                        if best[j][0] + size - lap > covered:
                            covered, begin = best[j][0] + size - lap, best[j][1]
                    j -= 1
                best.append((covered, begin))
                out.append((template, begin, start + size, min(1.0, covered / self.sizes[template])))
        return out

    def scan(self, texts: list[str]) -> list[tuple]:
        """Per text: words, base places, first and last of them, base labels, labels, score and spans."""
        hashes, at = word_hashes(texts, ascii_case=True)
        place = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        tokens = np.where(self.words[place] == hashes, place, len(self.words))
        phrases: dict[int, list] = {}
        found: dict[int, list] = {}
        if len(tokens) > 1:
            for text, first, last in zip(*(x.tolist() for x in self.stretches(tokens, at))):
                own, more = self.matches(tokens[first:last + 1].tolist(), first - int(at[text]))
                phrases.setdefault(text, []).extend(own)
                found.setdefault(text, []).extend(more)
        out = []
        for text in range(len(texts)):
            places = sorted(set(phrases.get(text, [])))
            spans = self.spans(found.get(text, []))
            good = sorted({(a, b, self.labels[t]) for t, a, b, share in spans if share >= COVER})
            base = sorted({self.labels[t] for _, t in places})
            labels = sorted({*base, *(label for _, _, label in good)})
            score = max([share for *_, share in spans], default=0.0)
            out.append((int(at[text + 1] - at[text]), len(places), places[0][0] if places else None,
                        places[-1][0] if places else None, ",".join(base), ",".join(labels), score,
                        [{"low": a, "high": b, "label": label} for a, b, label in good]))
        return out


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """Per document the counts, labels, score and ``spans`` (ranges of words with a label)."""

    def scan(frames):
        scanner = Scanner(templates=templates)
        for frame in frames:
            texts, out = [t or "" for t in frame["text"]], []
            for a, b in batches(texts):
                out += scanner.scan(texts[a:b])
            names = [c.split()[0] for c in COLUMNS.split(", ")] + ["spans"]
            scanned = pd.DataFrame(out, columns=names).astype({"first_word": "Int64", "last_word": "Int64"})
            scanned.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield scanned

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        scan, f"doc_id {kind}, {COLUMNS}, spans array<struct<low: int, high: int, label: string>>")


def op1_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")
