import math
import random

import numpy as np
import pandas as pd
import pytest

from tests.llm.conftest import ROWS
from tracemill.llm import decontaminate
from tracemill.llm.decontaminate import Index, drop_leaks, index_postings, leaks, question_and_answer
from tracemill.llm.words import word_hashes


def corpus(seed=1, n=40):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(4000)]
    word = lambda: rng.choice(common if rng.random() < 0.5 else rare)
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 40))) + ". " + " ".join(word() for _ in range(8)) + ".") for i in range(n)]
    items.append((n, " ".join(word() for _ in range(300)) + "."))
    docs = []
    for i in range(120):
        text = [word() for _ in range(rng.randint(0, 400))]
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = items[rng.randrange(len(items))][1].split()
        docs.append((i, " ".join(text)))
    return items, docs


def test_finds_what_brute_force_finds(spark):
    items, docs = corpus()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = leaks(table, spark.createDataFrame(items, "item_id long, text string"), shard=8).collect()
    squeeze = lambda t: " " + " ".join(t.replace(".", " ").split()) + " "
    wanted = {(d, i) for d, text in docs for i, item in items if squeeze(item) in squeeze(text)}
    assert {(r.doc_id, r.item_id) for r in got} == wanted and wanted
    assert all(r.question_overlap == 1.0 and r.score >= 0.6 for r in got)
    kept = drop_leaks(table, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _ in docs} - {d for d, _ in wanted})


def test_finds_questions_alone_and_halves(spark):
    """What has half of the question's n-grams is a leak, whatever it scores; checked against brute force."""
    rng = random.Random(8)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(4000)]
    some = lambda n, p: [rng.choice(common if rng.random() < p else rare) for _ in range(n)]
    items = [(i, " ".join(some(rng.randint(10, 90), 0.8)) + ". " + " ".join(some(rng.randint(3, 60), 0.1)) + ".") for i in range(30)]
    items.append((30, " ".join(some(200, 0.5)) + "."))
    short = "why so? " + " ".join(some(20, 0.1)) + "."  # two words alone are no leak
    texts = ["", "why", "why so", "so why so many", " ".join(short.split()[:15])]
    for _, item in items:
        question = question_and_answer(item)[0].split()
        whole = item.split()
        half = len(question) // 2 + 4
        parts = [question, whole[:len(whole) // 2], question[:half], question[-half:]]
        parts.append(question[:half // 2] + some(400, 0.5) + question[half // 2:half + 4])  # in two places
        texts += [" ".join(some(rng.randint(0, 150), 0.5) + p + some(rng.randint(0, 150), 0.5)) for p in parts]
    docs = list(enumerate(texts))

    def grams(words, n):
        return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}

    bare = lambda t: t.replace(".", " ").replace("?", " ").split()
    wanted = {}
    for d, text in docs:
        for i, item in items:
            question = bare(question_and_answer(item)[0])
            own = grams(question, min(5, len(question)))
            share = len(own & grams(bare(text), min(5, len(question)))) / len(own)
            if share >= 0.5:
                wanted[d, i] = share
    wanted[4, 31] = 1.0
    items.append((31, short))
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                shard=8).collect()
    found = {(r.doc_id, r.item_id): r for r in got}
    assert found.keys() == wanted.keys() and len(got) == len(found)
    assert all(abs(found[p].question_overlap - share) < 1e-9 for p, share in wanted.items())
    assert min(r.score for r in got) < 0.5 and all(0 < r.score <= 1 + 1e-9 for r in got)


def test_score_is_that_of_the_best_passage(spark):
    """Score and place of each leak against all passages, two blocks from each block's start."""
    items, docs = corpus(4)
    frame = pd.DataFrame(items, columns=["item_id", "text"]).assign(key=lambda f: f["item_id"].astype(str))
    postings = index_postings(spark.createDataFrame(frame)).toPandas()
    found = decontaminate.find_leaks(Index(postings, frame), [d for d, _ in docs], [t for _, t in docs])
    units = {k: dict(zip(g["term"], g["weight"])) for k, g in postings.groupby(["key", "unit"])}
    for doc, item, start, score, *_ in found:
        words = word_hashes([docs[doc][1]])[0].view(np.int64).tolist()
        passages = {a: set(words[a:a + 2 * decontaminate.UNIT]) for a in range(0, len(words), decontaminate.UNIT)}
        scores = {a: max(sum(w for t, w in own.items() if t in passage) for (key, _), own in units.items() if key == str(item))
                  for a, passage in passages.items()}
        assert abs(score - max(scores.values())) < 1e-9 and abs(scores[start] - score) < 1e-9
    assert found


@pytest.mark.parametrize("block", [1, 2, 16])
def test_search_returns_all_that_reach_their_thresholds(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "POSTING_BLOCK", block)
    items, _ = corpus(2)
    frame = pd.DataFrame(items, columns=["item_id", "text"]).assign(key=lambda f: f["item_id"].astype(str))
    postings = index_postings(spark.createDataFrame(frame)).toPandas()
    index = Index(postings, frame, 0.3)
    rng, several = np.random.default_rng(3), 0
    for _ in range(200):
        terms = np.unique(rng.integers(0, len(index.terms), rng.integers(1, 120)))
        scores = np.zeros(index.n_units)
        for t in terms:
            scores[index.unit[index.at[t]:index.at[t + 1]]] += index.share[index.at[t]:index.at[t + 1]]
        wanted = {int(u): scores[u] for u in np.flatnonzero(scores >= index.floor * (1 - 1e-9))}
        got = dict(index.search(terms))
        assert got.keys() == wanted.keys()
        assert all(abs(got[u] * index.floor[u] - wanted[u]) < 1e-9 for u in got)
        several += len(wanted) > 1
    assert several


@pytest.mark.parametrize("least", [0.2, 0.5, 1.0])
def test_no_text_with_enough_ngrams_is_below_the_threshold(spark, least):
    """Random sets of n-grams of random items, the rest of the text unknown: the threshold holds for some unit."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]  # few words, so that items repeat words and n-grams
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 180)))) for i in range(60)]
    frame = pd.DataFrame(items, columns=["item_id", "text"]).assign(key=lambda f: f["item_id"].astype(str))
    index = Index(index_postings(spark.createDataFrame(frame)).toPandas(), frame, least)
    assert index.n_units > 90
    texts, wanted = [], []
    for i, text in items:
        own = text.split()
        n = min(5, len(own))
        starts = {tuple(own[a:a + n]): a for a in range(len(own) - n + 1)}
        some = rng.sample(sorted(starts), math.ceil(least * len(starts)))
        texts.append(" stop ".join(" ".join(gram) for gram in some))
        wanted.append(i)
    got = {(d, i) for d, i, *_ in decontaminate.find_leaks(index, wanted, texts)}
    assert {(i, i) for i in wanted} <= got


def test_answers_are_verified(spark):
    question = "one two three four five six seven eight nine ten. "
    items = spark.createDataFrame([(1, question + "alpha beta gamma delta epsilon zeta eta theta iota kappa.")], "item_id long, text string")
    docs = [(1, question + "alpha beta gamma delta epsilon zeta eta theta."), (2, question + "alpha beta gamma delta epsilon."),
            (3, question), (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {r.doc_id: (r.answer_found, round(r.answer_overlap, 3)) for r in got} == {1: (True, 0.667), 2: (False, 0.167), 3: (False, 0.0)}


def test_question_and_answer():
    assert question_and_answer("What is it? It is this.") == ("What is it?", "It is this.")
    assert question_and_answer("alone") == ("alone", "")


def test_edge_rows(edge, empty, spark):
    items = spark.createDataFrame([(1, "the thing is what it is"), (1, "the thing is what it is"), (2, None), (3, ""), (None, "no id here but some words in it"), (4, "..")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(edge, items).collect()}
    assert got == {(1, 1), (2, 1), (None, None)}
    assert {r.doc_id for r in drop_leaks(edge, items).collect()} == {i for i, _, _ in ROWS} - {1, 2}
    assert leaks(empty, items).count() == leaks(edge, items.limit(0)).count() == 0
