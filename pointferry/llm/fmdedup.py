"""Exact removal of repeated word windows, found by backward search on a compressed FM-index in each shard.

A shard's text is its segments of words, each followed by an end of its own. Its Burrows-Wheeler transform is kept as
a wavelet matrix of packed bits with counts per 64. Windows are searched backwards, all at once: a step narrows each
window's suffix interval by one word, and what is left after the last step are all places where the window occurs.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pointferry.llm import oracle
from pointferry.llm.anchors import RepeatedWindows, Units, word_units
from pointferry.llm.textkit import SPACES, covered, documents, id_and_text, with_doc_id, word_bounds, word_codes

WINDOW = 20
ANCHOR = 6
SEARCHED = 1 << 16  # windows searched at once
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first:long,n:long>>"


class Bits:
    """A bit vector with the number of set bits before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int32)
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Index:
    """The FM-index of a text of symbols from 1; every 0 ends a segment and is a symbol of its own."""

    def __init__(self, symbols: np.ndarray):
        self.suffixes = suffix_order(symbols)
        last = symbols[self.suffixes - 1]  # of the first suffix the text's last symbol, an end
        n_symbols = int(symbols.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.levels: list[Bits] = []
        self.depth = max(1, int(n_symbols - 1).bit_length())
        row = last
        for level in range(self.depth - 1, -1, -1):
            bits = (row >> level & 1).astype(bool)
            self.levels.append(Bits(bits))
            row = np.concatenate([row[~bits], row[bits]])
        self.base = self._down(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in zip(range(self.depth - 1, -1, -1), self.levels):
            ones = bits.ones(at)
            at = np.where(symbol >> level & 1, bits.zeros + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of suffixes that begin with the symbol and go on as those of the intervals given."""
        shift = self.first[symbol] - self.base[symbol]
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return both[: len(low)] + shift, both[len(low) :] + shift


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """All suffixes in order, by doubling; a 0 differs from every other 0, in the order of places."""
    n = len(symbols)
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, symbols.astype(np.int64) + int(ends.sum()))
    step = 1
    while True:
        next_ = np.zeros(n, np.int64)
        next_[: n - step] = rank[step:] + 1
        key = rank * (n + int(rank.max()) + 2) + next_
        order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all() or step >= n:
            return order
        step *= 2


def matching_lengths(index: Index, symbols: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matching statistics of patterns read backwards from before ``ends``: how far, up to ``most``, and the last interval."""
    low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(index.suffixes), np.int64)
    length = np.zeros(len(ends), np.int64)
    going = np.arange(len(ends))
    for k in range(1, most + 1):
        spot = ends[going] - k
        symbol = np.where(spot >= 0, symbols[np.maximum(spot, 0)], 0)
        going, symbol = going[symbol > 0], symbol[symbol > 0]
        a, b = index.step(symbol, low[going], high[going])
        there = b > a
        going = going[there]
        low[going], high[going], length[going] = a[there], b[there], k
        if not len(going):
            break
    return length, low, high


def least_owners(data: np.ndarray, size: np.ndarray, long: np.ndarray, n: int, owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``n`` words of the segments the least owner, by document and start, of an equal one."""
    at = np.concatenate([[0], np.cumsum(size)])
    starts, ends, words_at = word_bounds(data, at, SPACES)
    codes = word_codes(data, starts, ends)
    _, symbols = np.unique(codes, return_inverse=True)
    segments = len(size)
    text = np.zeros(len(symbols) + segments, np.int64)
    place = np.arange(len(symbols)) + np.repeat(np.arange(segments), np.diff(words_at))
    text[place] = symbols + 1
    index = Index(text)
    windows = long - n + 1
    first = words_at[:-1] + np.arange(segments)  # of each segment in the text
    begin = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    window_at = np.full(len(text), -1, np.int64)
    window_at[begin] = np.arange(len(begin))
    # Owners in suffix order; places where no window begins have none.
    order = np.lexsort((start, owner))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    holder = window_at[index.suffixes]
    in_order = np.where(holder >= 0, rank[holder], len(order))
    best = np.empty(len(begin), np.int64)
    for a in range(0, len(begin), SEARCHED):
        mine = slice(a, a + SEARCHED)
        length, low, high = matching_lengths(index, text, begin[mine] + n, n)
        low, back = np.unique(low, return_inverse=True)  # equal windows have one interval, different ones are apart
        tops = np.empty(len(low), np.int64)
        tops[back] = high
        cuts = np.stack([low, tops], axis=1).ravel()
        least = np.minimum.reduceat(np.append(in_order, len(order)), cuts)[::2]
        best[mine] = least[back]
        assert (length == n).all()
    return owner[order[best]], start[order[best]]


def _result(docs: pa.Table, units: Units, copies: np.ndarray, starts: np.ndarray, window: int) -> pa.Table:
    flags = covered(starts, window, len(units.codes))
    texts = docs.column("text")
    columns: list[list] = [[] for _ in range(5)]
    for i, doc_id in enumerate(docs.column("doc_id").to_pylist()):
        raw = texts[i].as_py().encode()
        words = raw.split()  # ASCII white space, as the separators are
        n, spans = len(words), []
        if copies[i]:
            if n >= window:
                words, spans = [], [{"first": 0, "n": n}]
        else:
            mine = flags[units.units_at[i] : units.units_at[i + 1]]
            if mine.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                spans = [{"first": int(s), "n": int(e - s)} for s, e in zip(edges[::2], edges[1::2])]
                words = [w for w, gone in zip(words, mine.tolist()) if not gone]
        for column, value in zip(columns, (doc_id, n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest(), spans)):
            column.append(value)
    kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])


def remove_repeated_windows(df: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: words, removed words, their maximal runs (``spans``, in words), and the digest of what stays.

    A word goes if a window of ``window`` words over it also starts earlier: in a document with a
    smaller id, or earlier in the same one. A null or empty text has no words. Every row gives
    its own result; between rows with one id only the start counts, and a null id is greater than all others.
    A window's first place always stays. An empty table gives none.
    """
    job = RepeatedWindows(word_units, window, anchor, within=True, resolve=least_owners)
    return with_doc_id(job.run(id_and_text(df, id_col, text_col), RESULT, partial(_result, window=window)), id_col)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in windows that repeat from earlier, over all documents."""
    return remove_repeated_windows(documents(spark, sf_dir)).drop("spans")


ENTRIES = {"op8_substring_dedup": (op8_substring_dedup, oracle.OP8)}
