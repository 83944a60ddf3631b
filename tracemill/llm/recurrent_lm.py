"""Language-model scoring with a gated recurrent network in numpy.

Counts of all training tokens give the base score and the vocabulary, the ``VOCABULARY`` most
frequent tokens; every other token is predicted as "another word" and then by its count among
those. The output is factored: the class of a word first, then the word in its class.

Training passes over all training documents once, in ``ROUNDS`` disjoint parts. In each round
every task goes on from the common weights, by truncated backpropagation over windows of
``STEPS`` tokens with the state carried from window to window, and the weights of the tasks
are averaged by the tokens they have seen. Scoring carries the state through each whole
document. Rare tokens are looked up by a join; the most frequent ``FREQUENT`` ones are known
to all tasks, so no key of the join is hot.

Defined cases: a null or empty text is the end token alone; repeated rows are counted and
scored each for itself; a row with a null id is scored, but neither held out nor learned from;
without training documents all counts are 0 and both scores use one unseen token.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import table
from tracemill.llm.words import batches, word_hashes
from tracemill.operators.positions import nth_smallest
from tracemill.session import materialise

#: Words the network knows by name, classes they fall into, and the size of its state.
VOCABULARY = 2048
CLASSES = 48
HIDDEN = 16
#: Tokens of a window, lanes that run side by side, rounds of averaging, and the step size.
STEPS = 16
LANES = 512
ROUNDS = 2
RATE = 0.01
#: Tokens whose counts all tasks know, 12 bytes each.
FREQUENT = 1 << 18
#: Hash that stands for the end of a document.
END = np.uint64(0xE0D)
#: Characters scored in one go.
CHUNK = 1 << 23
_TOKEN = np.ones(256, bool)
_TOKEN[[32, 9, 10, 11, 12, 13]] = False
LN10 = math.log(10)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end, and where each text begins."""
    hashes, at = word_hashes(texts, ascii_case=True, in_word=_TOKEN)
    ends = at[1:] + np.arange(len(texts))
    out = np.empty(len(hashes) + len(texts), np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word], out[ends] = hashes, END
    return out, np.concatenate([[0], ends + 1])


def _count(frames):
    for frame in frames:
        texts = [t or "" for t in frame["text"]]
        for a, b in batches(texts, CHUNK):
            seen, n = np.unique(tokens(texts[a:b])[0], return_counts=True)
            yield pd.DataFrame({"token": seen.view(np.int64), "n": n})


class Vocabulary:
    """The frequent tokens with their counts, and the classes of the words known by name."""

    def __init__(self, token: np.ndarray, n: np.ndarray, total: int, distinct: int, size: int = VOCABULARY):
        order = np.argsort(token)
        self.token, self.n = token[order], n[order]
        self.total, self.distinct = total, distinct
        by_count = np.lexsort((self.token, -self.n))[:size - 2]
        named = np.unique(np.concatenate([by_count, np.flatnonzero(self.token == END)]))
        self.named = named[np.lexsort((self.token[named], -self.n[named]))]
        # number 0 is any other word; then the named ones by count
        self.number = np.zeros(len(self.token) + 1, np.int64)
        self.number[self.named] = np.arange(1, len(self.named) + 1)
        self.end = int(self.number[np.searchsorted(self.token, END)]) if len(named) else 0
        self.others = total - int(self.n[self.named].sum()) + distinct - len(self.named) + 1
        mass = np.concatenate([[self.others], self.n[self.named] + 1]).astype(np.float64)
        share = np.cumsum(np.sqrt(mass)) / np.sqrt(mass).sum()
        self.word_class = np.minimum((share * CLASSES - 1e-9).astype(np.int64), CLASSES - 1)
        self.word_class = np.unique(self.word_class, return_inverse=True)[1]
        self.class_at = np.searchsorted(self.word_class, np.arange(self.word_class[-1] + 2))
        self.log_mass = np.log(mass / mass.sum())

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each token, 0 for those not known by name."""
        if not len(self.named):
            return np.zeros(len(hashes), np.int64)
        own = np.sort(self.named)
        place = np.minimum(np.searchsorted(self.token[own], hashes), len(own) - 1)
        return np.where(self.token[own][place] == hashes, self.number[own][place], 0)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each token among the frequent ones, or their number if it is not there."""
        if not len(self.token):
            return np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.token, hashes), len(self.token) - 1)
        return np.where(self.token[place] == hashes, place, len(self.token))


def initial(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    rng, size, classes = np.random.default_rng(7), len(vocabulary.word_class), len(vocabulary.class_at) - 1
    class_mass = np.log(np.add.reduceat(np.exp(vocabulary.log_mass), vocabulary.class_at[:-1]))
    normal = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "embed": normal(size, HIDDEN), "into": normal(HIDDEN, 3 * HIDDEN), "bias": np.zeros(3 * HIDDEN, np.float32),
        "state": normal(HIDDEN, 3 * HIDDEN), "classes": normal(HIDDEN, classes), "class_bias": class_mass.astype(np.float32),
        "words": normal(size, HIDDEN), "word_bias": (vocabulary.log_mass - class_mass[vocabulary.word_class]).astype(np.float32),
    }


def _sigmoid(x):
    """Of an array that may be overwritten."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _cell(from_input, state, weights):
    """One step: gates and the new state. Arrays are held column by column, so a gate is one piece of memory."""
    from_state = (weights["state"].T @ state.T).T
    gates = _sigmoid(from_input[:, :2 * HIDDEN] + from_state[:, :2 * HIDDEN])
    keep, reset, inner = gates[:, :HIDDEN], gates[:, HIDDEN:], from_state[:, 2 * HIDDEN:]
    new = np.tanh(from_input[:, 2 * HIDDEN:] + reset * inner)
    return keep, reset, new, inner, new + keep * (state - new)


def _bounded(weights, names: tuple[str, str], axis: int) -> bool:
    """Whether no score of a state, whose parts are between -1 and 1, overflows when raised."""
    return bool((np.abs(weights[names[0]]).sum(axis) + np.abs(weights[names[1]])).max() < 60)


def _softmax_at(scores, column, bounded):
    """Log probability of one column per row, and all probabilities; overwrites ``scores``."""
    if not bounded:
        scores -= scores.max(1, keepdims=True)
    chosen = scores[np.arange(len(scores)), column]
    np.exp(scores, out=scores)
    total = scores @ np.ones(scores.shape[1], scores.dtype)
    return chosen - np.log(total), scores, total


def _error(exponents, total, column):
    """Gradient of the negative log probability by the scores."""
    exponents /= total[:, None]
    exponents[np.arange(len(exponents)), column] -= 1
    return exponents


def _by_class(target, vocabulary):
    return np.argsort(vocabulary.word_class[target].astype(np.uint16), kind="stable")


def _output(states, target, weights, vocabulary, gradients=None):
    """Log probability of each target; adds to ``gradients`` and returns those of the states too.
    Targets in the order of their classes need no sorting here."""
    which = vocabulary.word_class[target]
    if (which[1:] < which[:-1]).any():
        order = _by_class(target, vocabulary)
        ordered = _output(states[order], target[order], weights, vocabulary, gradients)
        back_to = np.argsort(order)
        return tuple(None if x is None else x[back_to] for x in ordered)
    logs, exponents, total = _softmax_at(states @ weights["classes"] + weights["class_bias"], which,
                                         _bounded(weights, ("classes", "class_bias"), 0))
    back = None
    if gradients is not None:
        error = _error(exponents, total, which)
        gradients["classes"] += states.T @ error
        gradients["class_bias"] += np.ones(len(error), error.dtype) @ error
        back = error @ weights["classes"].T
    bounded = _bounded(weights, ("words", "word_bias"), 1)
    cuts = np.searchsorted(which, np.arange(len(vocabulary.class_at)))
    for c in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = vocabulary.class_at[c], vocabulary.class_at[c + 1]
        if b - a == 1:
            continue
        own = slice(cuts[c], cuts[c + 1])
        held, word = states[own], target[own] - a
        in_class, exponents, total = _softmax_at(
            held @ weights["words"][a:b].T + weights["word_bias"][a:b], word, bounded)
        logs[own] += in_class
        if gradients is not None:
            error = _error(exponents, total, word)
            gradients["words"][a:b] += error.T @ held
            gradients["word_bias"][a:b] += error.sum(0)
            back[own] += error @ weights["words"][a:b]
    return logs, back


def _window(given, target, fresh, counted, state, weights, vocabulary):
    """Forward and backward over one window; returns gradients and the last state."""
    (lanes, steps), kind = given.shape, state.dtype
    table = np.ascontiguousarray((weights["embed"] @ weights["into"] + weights["bias"]).T)
    going, kept, states = ~fresh, [], np.empty((steps, HIDDEN, lanes), kind)
    for t in range(steps):
        before = state * going[:, t, None]
        *gates, state = _cell(table[:, given[:, t]].T, before, weights)
        kept.append((before, *gates))
        states[t] = state.T
    gradients = {k: np.zeros_like(v) for k, v in weights.items()}
    flat, goal = states.transpose(0, 2, 1).reshape(-1, HIDDEN), target.T.ravel()
    used = np.flatnonzero(counted.T.ravel())
    used = used[_by_class(goal[used], vocabulary)]
    back = np.zeros_like(flat)
    back[used] = _output(np.take(flat, used, axis=0), goal[used], weights, vocabulary, gradients)[1]
    back = np.ascontiguousarray(back.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1))
    ahead, d_input = np.zeros_like(state), np.empty((steps, 3 * HIDDEN, lanes), kind)
    d_state = np.empty((3 * HIDDEN, lanes), kind).T
    for t in range(steps - 1, -1, -1):
        before, keep, reset, new, inner = kept[t]
        error, d = back[t].T + ahead, d_input[t].T
        d_new = error * (1 - keep) * (1 - new * new)
        d[:, :HIDDEN] = error * (before - new) * keep * (1 - keep)
        d[:, HIDDEN:2 * HIDDEN] = d_new * inner * reset * (1 - reset)
        d[:, 2 * HIDDEN:] = d_new
        d_state[:, :2 * HIDDEN] = d[:, :2 * HIDDEN]
        d_state[:, 2 * HIDDEN:] = d_new * reset
        gradients["state"] += before.T @ d_state
        ahead = (error * keep + (weights["state"] @ d_state.T).T) * going[:, t, None]
    d_input, words = d_input.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN), given.T.ravel().astype(np.uint16)
    gradients["bias"] += np.ones(len(d_input), kind) @ d_input
    # sums by word serve both the embedding and what follows it
    order = np.argsort(words, kind="stable")
    words = words[order]
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    seen, by_word = words[first], np.add.reduceat(np.take(d_input, order, axis=0), first, axis=0)
    gradients["into"] += weights["embed"][seen].T @ by_word
    gradients["embed"][seen] = by_word @ weights["into"].T
    return {k: g / max(1, len(used)) for k, g in gradients.items()}, state


class Trainer:
    """Adam over the windows of one task."""

    def __init__(self, weights: dict[str, np.ndarray], vocabulary: Vocabulary, rate: float = RATE):
        self.weights = {k: v.copy() for k, v in weights.items()}
        self.vocabulary, self.rate, self.step, self.seen = vocabulary, rate, 0, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def learn(self, numbers: np.ndarray, at: np.ndarray) -> None:
        """Pass once over texts that stand one after the other, cut into lanes of equal length."""
        lanes = min(LANES, len(numbers))
        length = -(-len(numbers) // lanes)
        n = lanes * length
        target = np.zeros(n, np.int64)
        target[:len(numbers)] = numbers
        given = np.concatenate([[self.vocabulary.end], target[:-1]])
        counted, fresh = np.arange(n) < len(numbers), np.zeros(n, bool)
        fresh[at[:-1]] = True
        given, target, counted, fresh = (x.reshape(lanes, length) for x in (given, target, counted, fresh))
        state = np.zeros((HIDDEN, lanes), np.float32).T
        for t in range(0, length, STEPS):
            part = slice(t, t + STEPS)
            gradients, state = _window(given[:, part], target[:, part], fresh[:, part], counted[:, part], state,
                                       self.weights, self.vocabulary)
            self._update(gradients)
        self.seen += len(numbers)

    def _update(self, gradients) -> None:
        self.step += 1
        rate = self.rate * math.sqrt(1 - 0.999 ** self.step) / (1 - 0.9 ** self.step)
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.weights[k] -= rate * self.mean[k] / (np.sqrt(self.square[k]) + 1e-8)


def log_likelihood(numbers: np.ndarray, at: np.ndarray, weights, vocabulary: Vocabulary) -> np.ndarray:
    """Natural log probability of each token; the state runs through each whole text."""
    given = np.concatenate([[vocabulary.end], numbers[:-1]])
    given[at[:-1]] = vocabulary.end
    from_input = np.ascontiguousarray((weights["embed"] @ weights["into"] + weights["bias"]).T)
    lengths = np.diff(at)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = at[:-1][order], lengths[order]
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right") if len(lengths) else []
    state = np.zeros((HIDDEN, len(lengths)), np.float32).T
    logs, rows_kept, states_kept, held = np.empty(len(numbers), np.float32), [], [], 0
    for t, n in enumerate(alive):
        rows = starts[:n] + t
        state = _cell(np.take(from_input, given[rows], axis=1).T, state[:n], weights)[-1]
        rows_kept.append(rows)
        states_kept.append(state)
        held += n
        if held >= 1 << 16 or t == len(alive) - 1:
            rows = np.concatenate(rows_kept)
            order = _by_class(numbers[rows], vocabulary)
            rows, states = rows[order], np.take(np.concatenate(states_kept), order, axis=0)
            logs[rows] = _output(states, numbers[rows], weights, vocabulary)[0]
            rows_kept, states_kept, held = [], [], 0
    return logs


def _pack(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def _unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _learner(shared):
    def learn(frames):
        weights, vocabulary = shared.value
        trainer = Trainer(weights, vocabulary)
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for a, b in batches(texts, CHUNK):
                hashes, at = tokens(texts[a:b])
                trainer.learn(vocabulary.numbers(hashes), at)
        if trainer.seen:
            yield pd.DataFrame({"seen": [float(trainer.seen)], "weights": [_pack(trainer.weights)]})

    return learn


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights learned from all of ``docs`` (``id, text``), each in one of the rounds."""
    weights, context = initial(vocabulary), docs.sparkSession.sparkContext
    for number in range(rounds):
        part = docs.filter(F.pmod(F.xxhash64("id"), F.lit(rounds)) == number).select("text")
        shared = context.broadcast((weights, vocabulary))
        learned = materialise(part.mapInPandas(_learner(shared), "seen double, weights array<float>"))
        total = learned.agg(F.sum("seen")).first()[0]
        if total:
            summed = (learned.select("seen", F.posexplode("weights").alias("place", "weight")).groupBy("place")
                      .agg(F.sum(F.col("weight") * F.col("seen")).alias("sum")).toPandas())
            flat = np.empty(len(summed))
            flat[summed["place"]] = summed["sum"] / total
            weights = _unpack(flat, weights)
    return weights


def _scorer(shared):
    names = ["row", "doc_id", "n_tokens", "n_known", "base", "score", "rare"]

    def score(frames):
        weights, vocabulary = shared.value
        row = TaskContext.get().partitionId() << 33
        logs = np.append(np.log10(vocabulary.n + 1.0), 0.0)
        known = np.append(vocabulary.n > 0, False)
        for frame in frames:
            texts, ids = [t or "" for t in frame["text"]], frame["id"].tolist()
            for a, b in batches(texts, CHUNK):
                hashes, at = tokens(texts[a:b])
                place = vocabulary.places(hashes)
                numbers = vocabulary.number[place]
                by_model = log_likelihood(numbers, at, weights, vocabulary).astype(np.float64) / LN10
                by_model += np.where(numbers == 0, logs[place] - math.log10(vocabulary.others), 0)
                rare = place == len(vocabulary.token)
                sums = [np.add.reduceat(x, at[:-1]) for x in (known[place].astype(np.int64), logs[place], by_model)]
                out = pd.DataFrame({
                    "row": row + np.arange(b - a), "doc_id": pd.array([None if pd.isna(i) else int(i) for i in ids[a:b]], "Int64"),
                    "n_tokens": np.diff(at), "n_known": sums[0], "base": sums[1], "score": sums[2],
                    "rare": [hashes[x:y][rare[x:y]].view(np.int64) for x, y in zip(at[:-1], at[1:])]}, columns=names)
                row += b - a
                yield out

    return score


def score_documents(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and model log10 probability of every document, learned from those where ``training`` holds."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), training.alias("training"))
    learned_from = rows.filter("training").select("id", "text")
    counts = materialise(learned_from.mapInPandas(_count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    total, distinct = counts.agg(F.sum("n"), F.count("n")).first()
    total = total or 0
    # all tokens more frequent than the one at place FREQUENT; a top-k would bring one list per task to the driver
    place, _ = nth_smallest(counts.select((-F.col("n")).alias("place")), "place", FREQUENT)
    top = (counts if place is None else counts.filter(F.col("n") > -place)).toPandas()
    vocabulary = Vocabulary(top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), total, distinct)
    weights = train(learned_from, vocabulary)
    shared = context.broadcast((weights, vocabulary))
    scored = materialise(rows.select("id", "text").mapInPandas(
        _scorer(shared), "row long, doc_id long, n_tokens long, n_known long, base double, score double, rare array<long>"))
    found = scored.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(
        F.count(F.lit(1)).alias("times")).join(counts, "token")
    extra = found.groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    more, logs = F.coalesce("more", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return scored.drop("rare").join(extra, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"),
        (F.col("score") + logs).alias("score"))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2


def op7_recurrent_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, F.coalesce(~held_out(), F.lit(False)))
    return scored.withColumn("held_out", F.coalesce(held_out(), F.lit(False))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
