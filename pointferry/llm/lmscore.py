"""Masked pseudo-likelihood: a window network predicts every word from the words on both sides.

Neighbours are the most frequent words of all documents, and hash buckets for the rest. The network sums one vector per
neighbour and place, takes the hyperbolic tangent, and scores the classes of the hidden word. Tasks train copies of it
on their own documents, and Spark averages the copies, row by row, after each round.

The output is open: P(word | neighbours) = P(class | neighbours) P(word | class). The most frequent words are classes of
their own; other listed words share classes, within which they have their shares of the corpus' counts; all words that
are not listed are one class, and are spelled byte by byte from counts of their byte pairs over the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pointferry.llm.textkit import SPACES, documents, id_and_text, row_of, slices, with_doc_id, word_bounds, word_codes
from pointferry.operators.sizing import stored

FREQUENT = 4096  # words with a number of their own
BUCKETS = 256  # numbers of all other words
LISTED = 16384  # words predicted as such; others are spelled
OWN_CLASSES, BUCKET_CLASSES = 192, 64  # of the predicted word; the last is that of words not listed
SIDE = 2  # words on either side
HIDDEN = 16
ROUNDS = 2
STRIDE = ROUNDS  # words of a document between two targets of a round; the rounds together take every word once
BATCH = 2048
BLOCK = 512  # words whose classes are held at once
RATE = 0.1
SMOOTHING = 0.5  # of the counts of byte pairs
_SYMBOLS, _BORDER = 257, 256  # bytes, and the border of a word
_INPUTS = FREQUENT + BUCKETS + 1  # the last stands beyond an end of the text
_CLASSES = OWN_CLASSES + BUCKET_CLASSES
_WIDTH = 2 * SIDE * HIDDEN
_ONES = np.ones(_CLASSES, np.float32)
_CONTEXT = [-k for k in range(SIDE, 0, -1)] + list(range(1, SIDE + 1))


class Network:
    """Rows of one table: the inputs, then one row per class (weights and bias), then the hidden bias."""

    def __init__(self, rows: np.ndarray):
        self.inputs = rows[:_INPUTS].reshape(_INPUTS, 2 * SIDE, HIDDEN).transpose(1, 0, 2).copy()
        self.out = rows[_INPUTS : _INPUTS + _CLASSES, :HIDDEN].T.copy()
        self.out_bias = rows[_INPUTS : _INPUTS + _CLASSES, HIDDEN].copy()
        self.bias = rows[-1, :HIDDEN].copy()

    @staticmethod
    def fresh(seed: int = 7) -> np.ndarray:
        rows = np.random.default_rng(seed).normal(0, 0.1, (_INPUTS + _CLASSES + 1, _WIDTH)).astype(np.float32)
        rows[_INPUTS : _INPUTS + _CLASSES, HIDDEN:] = 0
        rows[-1] = 0
        return rows

    def rows(self) -> np.ndarray:
        rows = np.zeros((_INPUTS + _CLASSES + 1, _WIDTH), np.float32)
        rows[:_INPUTS] = self.inputs.transpose(1, 0, 2).reshape(_INPUTS, _WIDTH)
        rows[_INPUTS : _INPUTS + _CLASSES, :HIDDEN] = self.out.T
        rows[_INPUTS : _INPUTS + _CLASSES, HIDDEN] = self.out_bias
        rows[-1, :HIDDEN] = self.bias
        return rows

    def hidden(self, context: np.ndarray) -> np.ndarray:
        h = np.take(self.inputs[0], context[0], axis=0)
        for k in range(1, 2 * SIDE):
            h += np.take(self.inputs[k], context[k], axis=0)
        h += self.bias
        return np.tanh(h, out=h)

    def logits(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hidden layer and the logits, less the greatest where an exponential could overflow."""
        h = self.hidden(context)
        logits = h @ self.out
        logits += self.out_bias
        if (np.abs(self.out).sum(axis=0) + np.abs(self.out_bias)).max() < 60:
            return h, logits
        logits -= logits.max(axis=1, keepdims=True)
        return h, logits

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        found = np.empty(len(target), np.float32)
        for i in range(0, len(target), BLOCK):
            part = slice(i, i + BLOCK)
            _, logits = self.logits(context[:, part])
            own = logits[np.arange(len(logits)), target[part]]
            np.exp(logits, out=logits)
            found[part] = own - np.log(logits @ _ONES)
        return found


class Trainer:
    """Adaptive gradient steps on one copy of the network."""

    def __init__(self, net: Network):
        self.net = net
        self.seen = np.zeros(_INPUTS, np.int64)
        self.targets = np.zeros(_CLASSES, np.int64)
        self.steps = [np.full(p.shape, 1e-6, np.float32) for p in (net.inputs, net.out, net.out_bias, net.bias)]

    def learn(self, context: np.ndarray, target: np.ndarray) -> None:
        net, n = self.net, len(target)
        dh, out, out_bias = np.empty((n, HIDDEN), np.float32), np.zeros_like(net.out), np.zeros_like(net.out_bias)
        for i in range(0, n, BLOCK):
            part = slice(i, i + BLOCK)
            h, p = net.logits(context[:, part])
            np.exp(p, out=p)
            p *= (1 / (n * (p @ _ONES)))[:, None]
            p[np.arange(len(p)), target[part]] -= np.float32(1 / n)
            out += h.T @ p
            out_bias += p.sum(axis=0)
            np.multiply(p @ net.out.T, 1 - h * h, out=dh[part])
        for value, grad, step in ((net.out, out, self.steps[1]), (net.out_bias, out_bias, self.steps[2]), (net.bias, dh.sum(axis=0), self.steps[3])):
            step += grad * grad
            value -= RATE * grad / np.sqrt(step)
        for k in range(2 * SIDE):
            order = np.argsort(context[k].astype(np.uint16), kind="stable")  # a radix sort
            ids = context[k][order]
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            grad, ids = np.add.reduceat(dh[order], first, axis=0), ids[first]
            step = self.steps[0][k][ids] + grad * grad
            self.steps[0][k][ids] = step
            net.inputs[k][ids] -= RATE * grad / np.sqrt(step)
            self.seen[ids] += np.diff(np.append(first, n))
        self.targets += np.bincount(target, minlength=_CLASSES)


def frequent_words(docs: DataFrame, n: int = LISTED) -> np.ndarray:
    """Codes of the most frequent words of all documents, the first being the most frequent; counts are exact."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def merge():
            found, index = np.unique(np.concatenate([codes, *waiting]), return_inverse=True)
            return found, np.bincount(index, weights=np.concatenate([counts, np.ones(size)]), minlength=len(found)).astype(np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], names=["code", "n"])

        for batch in batches:
            for _, _, data, at in slices(batch.column("text")):
                starts, ends, _ = word_bounds(data, at, SPACES)
                waiting.append(word_codes(data, starts, ends))
                size += len(starts)
                if size > 1_000_000:
                    codes, counts = merge()
                    waiting, size = [], 0
                    if len(codes) > 2_000_000:  # hand over what was counted and go on
                        yield rows()
                        codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        codes, counts = merge()
        yield rows()

    counted = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    # A task merges what the partitions offer, not the driver.
    top = stored(counted.orderBy(F.desc("n"), "code").limit(n), "frequent-words")
    return np.array([r["code"] for r in top.orderBy(F.desc("n"), "code").collect()], np.int64).view(np.uint64)


class Numbers:
    """Input numbers and classes of word codes, and their places in the list; -1 of words not listed."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.argsort(frequent)
        self.codes = frequent[self.order]

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bucket = (codes >> np.uint64(40)).astype(np.int64)
        place = np.full(len(codes), -1)
        if len(self.codes):
            spot = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            place = np.where(self.codes[spot] == codes, self.order[spot], -1)
        number = np.where((place >= 0) & (place < FREQUENT), place, FREQUENT + bucket % BUCKETS)
        shared = np.where(place < 0, _CLASSES - 1, OWN_CLASSES + bucket % (BUCKET_CLASSES - 1))
        return number, np.where((place >= 0) & (place < OWN_CLASSES), place, shared), place


def _pairs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the byte pairs of words one after the other, from the border before a word to that after it."""
    long = ends - starts + 1
    at = np.repeat(starts - (np.cumsum(long) - long), long) + np.arange(long.sum())
    last = np.cumsum(long) - 1
    now = np.append(data, 0)[at].astype(np.int64)
    now[last] = _BORDER
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[:1] = _BORDER
    return before * _SYMBOLS + now


@dataclass(frozen=True)
class Words:
    """Log-probabilities within classes: of each listed word in its class, and of a byte after another in other words."""

    listed: np.ndarray
    spelling: np.ndarray

    @staticmethod
    def counted(frequent: np.ndarray, counts: np.ndarray) -> Words:
        """From counts of the listed words, then of byte pairs. A listed word counts as one at least."""
        n = np.maximum(counts[: len(frequent)], 1)
        classes = Numbers(frequent).of(frequent)[1]
        listed = np.log(n / np.bincount(classes, weights=n, minlength=_CLASSES)[classes])
        pairs = counts[len(frequent) :].reshape(_SYMBOLS, _SYMBOLS) + SMOOTHING
        return Words(listed, np.log(pairs / pairs.sum(axis=1, keepdims=True)).ravel())

    def terms(self, place: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log P(word | class) of every word."""
        found = np.zeros(len(place))
        known = place >= 0
        found[known] = self.listed[place[known]]
        other = np.flatnonzero(~known)
        if len(other):
            first = np.cumsum(ends[other] - starts[other] + 1)
            found[other] = np.add.reduceat(self.spelling[_pairs(data, starts[other], ends[other])], np.append(0, first[:-1]))
        return found


def count_words(docs: DataFrame, frequent: np.ndarray) -> Words:
    """``Words`` of all documents; counts are exact."""
    size = len(frequent) + _SYMBOLS * _SYMBOLS
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering, counts = Numbers(sent.value), np.zeros(size, np.int64)
        for batch in batches:
            for _, _, data, at in slices(batch.column("text")):
                starts, ends, _ = word_bounds(data, at, SPACES)
                place = numbering.of(word_codes(data, starts, ends))[2]
                counts[: size - _SYMBOLS * _SYMBOLS] += np.bincount(place[place >= 0], minlength=size - _SYMBOLS * _SYMBOLS)
                pairs = _pairs(data, starts[place < 0], ends[place < 0])
                counts[size - _SYMBOLS * _SYMBOLS :] += np.bincount(pairs, minlength=_SYMBOLS * _SYMBOLS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some])], names=["spot", "n"])

    counts = np.zeros(size, np.int64)
    for r in docs.select("text").mapInArrow(count, "spot long, n long").groupBy("spot").agg(F.sum("n").alias("n")).collect():  # at most one row per count
        counts[r["spot"]] = r["n"]
    return Words.counted(frequent, counts)


def _contexts(numbers: np.ndarray, words_at: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The numbers around some places; beyond the ends of a text stands the last number."""
    found = np.empty((2 * SIDE, len(at)), np.int64)
    first, last = words_at[rows[at]], words_at[rows[at] + 1]
    for k, step in enumerate(_CONTEXT):
        spot = at + step
        ok = (spot >= first) & (spot < last)
        found[k] = np.where(ok, numbers[np.where(ok, spot, at)], _INPUTS - 1)
    return found


def targets_of(words_at: np.ndarray, shift: int, stride: int) -> np.ndarray:
    """Every ``stride``-th word of each text from the word ``shift`` on."""
    total = words_at[-1]
    return np.flatnonzero((np.arange(total) - np.repeat(words_at[:-1], np.diff(words_at))) % stride == shift)


def train(docs: DataFrame, frequent: np.ndarray, rounds: int = ROUNDS, stride: int = STRIDE) -> np.ndarray:
    """The table of the trained network. Copies are averaged by how often each row was used.

    A round's targets are every ``stride``-th word of each document, from another word in each round;
    with as many rounds as ``stride`` every word of every document is a target once.
    """
    context = docs.sparkSession.sparkContext
    rows = Network.fresh()
    for round_ in range(rounds):
        sent = context.broadcast((frequent, rows))

        def copy(batches, sent=sent, shift=round_ * stride // max(rounds, 1)):
            words, table = sent.value
            numbering, trainer = Numbers(words), Trainer(Network(table))
            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            for batch in batches:
                for _, _, data, at in slices(batch.column("text")):
                    starts, ends, words_at = word_bounds(data, at, SPACES)
                    numbers, classes, _ = numbering.of(word_codes(data, starts, ends))
                    targets = targets_of(words_at, shift, stride)
                    waiting.append((_contexts(numbers, words_at, targets, row_of(words_at)), classes[targets]))
                    if sum(len(t) for _, t in waiting) >= BATCH:
                        _learn(trainer, waiting)
                        waiting = []
            if waiting:
                _learn(trainer, waiting)
            table = trainer.net.rows()
            used = np.concatenate([trainer.seen, trainer.targets, [trainer.targets.sum()]])
            touched = np.flatnonzero(used)
            values = pa.array((table[touched] * used[touched, None]).astype(np.float64).ravel())
            yield pa.RecordBatch.from_arrays([pa.array(touched, pa.int32()), pa.array(used[touched]), pa.FixedSizeListArray.from_arrays(values, _WIDTH).cast(pa.list_(pa.float64()))], names=["row", "n", "w"])

        copies = docs.select("text").mapInArrow(copy, "row int, n long, w array<double>")
        sums = copies.groupBy("row").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("w")[i]) for i in range(_WIDTH))).alias("w"))
        rows = rows.copy()
        for r in sums.collect():  # at most one row per row of the network
            rows[r["row"]] = np.asarray(r["w"]) / r["n"]
        sent.unpersist()
    return rows


def _learn(trainer: Trainer, waiting: list[tuple[np.ndarray, np.ndarray]]) -> None:
    context = np.concatenate([c for c, _ in waiting], axis=1)
    target = np.concatenate([t for _, t in waiting])
    for i in range(0, len(target), BATCH):
        if len(target[i : i + BATCH]):
            trainer.learn(context[:, i : i + BATCH], target[i : i + BATCH])


def score(df: DataFrame, frequent: np.ndarray, rows: np.ndarray, id_col: str = "doc_id", text_col: str = "text", known: Words | None = None) -> DataFrame:
    """Per document: words, and the sum and the mean of the log-probability of each word given the others around it.

    ``known`` has the corpus' counts; without it those of the documents scored are taken. A null or empty text has no words, the sum 0 and no mean. Repeated rows give repeated results;
    long texts are scored whole.
    """
    docs = id_and_text(df, id_col, text_col)
    known = count_words(docs, frequent) if known is None else known
    sent = df.sparkSession.sparkContext.broadcast((frequent, rows, known.listed, known.spelling))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table, *within = sent.value
        numbering, net, known = Numbers(words), Network(table), Words(*within)
        for batch in batches:
            counts, sums = [np.empty(0, np.int64)], [np.empty(0)]
            for _, _, data, at in slices(batch.column("text")):
                starts, ends, words_at = word_bounds(data, at, SPACES)
                numbers, classes, place = numbering.of(word_codes(data, starts, ends))
                owner = row_of(words_at)
                total = np.append(0, known.terms(place, data, starts, ends))
                for i in range(0, len(numbers), BATCH):
                    at = np.arange(i, min(i + BATCH, len(numbers)))
                    total[at + 1] += net.log_probabilities(_contexts(numbers, words_at, at, owner), classes[at])
                np.cumsum(total, out=total)
                counts.append(np.diff(words_at))
                sums.append(np.round(total[words_at[1:]] - total[words_at[:-1]], 3))
            n, s = np.concatenate(counts), np.concatenate(sums)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(s), pa.array(s / np.maximum(n, 1), mask=n == 0)], names=["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"])

    return with_doc_id(docs.mapInArrow(run, "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double"), id_col)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on all of them."""
    docs = documents(spark, sf_dir)
    frequent = frequent_words(docs)
    return score(docs, frequent, train(docs, frequent), known=count_words(id_and_text(docs), frequent))


ENTRIES = {"op10_lm_scoring": (op10_lm_scoring, None)}
