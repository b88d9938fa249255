"""Exact removal of repeated byte strings, found by blockwise suffix sorting with a difference cover.

A shard's suffixes are sorted one bucket of leading bytes at a time, by their first 32 bytes. Suffixes that still tie
are told apart by ranks of the cover sample, which were made before: for any two positions there is a distance below
the period at which both meet the sample, so one comparison of two ranks ends every tie, and the memory is that of one
bucket and the sample's ranks.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pointferry.llm import oracle
from pointferry.llm.anchors import RepeatedWindows, Units, byte_units
from pointferry.llm.textkit import covered, documents, id_and_text, with_doc_id, word_bounds

LENGTH = 50
ANCHOR = 20
BUCKET = 1 << 17  # suffixes sorted at once
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # every difference modulo the period is one of two members
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first:long,n:long>>"


def _distances() -> np.ndarray:
    """For two residues the least distance at which both meet the cover."""
    member = np.isin(np.arange(2 * PERIOD) % PERIOD, COVER)
    found = np.full((PERIOD, PERIOD), -1, np.int64)
    for d in range(PERIOD - 1, -1, -1):
        both = member[(np.arange(PERIOD) + d)[:, None] % PERIOD] & member[(np.arange(PERIOD) + d)[None, :] % PERIOD]
        found[both] = d
    return found


def _word(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one big-endian number; ``text`` is padded."""
    return np.ndarray(len(text) - 7, ">u8", text, strides=(1,))[at].astype(np.uint64)


def _word_of(text: np.ndarray, at: np.ndarray, i: int, depth: int) -> np.ndarray:
    """The i-th eight of the first ``depth`` bytes, fewer if it is the last."""
    word = _word(text, at + 8 * i)
    return word >> np.uint64(max(0, 64 * (i + 1) - 8 * depth))


def by_leading_bytes(text: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` bytes, and which differ there from the one before.

    Eight bytes are sorted first; only suffixes that tie in them are read on and sorted by the next eight.
    """
    word = _word_of(text, at, 0, depth)
    order = np.argsort(word, kind="stable")
    at, word = at[order], word[order]
    new = np.ones(len(at), bool)
    new[1:] = word[1:] != word[:-1]
    for i in range(1, -(-depth // 8)):
        tied = ~new
        tied[:-1] |= ~new[1:]
        open_ = np.flatnonzero(tied)
        if not len(open_):
            break
        mine, name = at[open_], np.cumsum(new)[open_]
        word = _word_of(text, mine, i, depth)
        move = np.lexsort((word, name))
        at[open_], word = mine[move], word[move]
        differs = np.zeros(len(open_), bool)
        differs[1:] = word[1:] != word[:-1]
        new[open_] |= differs
    return at, new


def cover_ranks(text: np.ndarray, n: int, depth: int) -> np.ndarray:
    """The rank of every sample position's first ``depth`` bytes among all of them; -1 elsewhere."""
    at, new = by_leading_bytes(text, np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER)), depth)
    ranks = np.full(n, -1, np.int32)
    ranks[at] = np.cumsum(new) - 1
    return ranks


def sort_bucket(text: np.ndarray, at: np.ndarray, ranks: np.ndarray, distances: np.ndarray) -> np.ndarray:
    """Suffixes in order: by 32 bytes, then by cover ranks."""
    at, new = by_leading_bytes(text, at, 32)
    # A tied run is named by the place of its first suffix; runs keep their places while they are split.
    first = np.flatnonzero(new)
    run = np.repeat(first, np.diff(np.append(first, len(at))))
    open_ = np.flatnonzero(np.repeat(np.diff(np.append(first, len(at))) > 1, np.diff(np.append(first, len(at)))))
    while len(open_):
        # The first suffix of each run is the pivot; all others are compared with it at once.
        mine, name = at[open_], run[open_]
        pivot = at[name]
        d = distances[mine % PERIOD, pivot % PERIOD]
        sign = np.sign(ranks[mine + d].astype(np.int64) - ranks[pivot + d])
        move = np.argsort(3 * name + sign, kind="stable")
        at[open_] = mine[move]
        sign, name = sign[move], name[move]
        change = np.ones(len(name), bool)
        change[1:] = (name[1:] != name[:-1]) | (sign[1:] != sign[:-1])
        begin = np.flatnonzero(change)
        size = np.diff(np.append(begin, len(name)))
        run[open_] = np.repeat(open_[begin], size)
        open_ = open_[(sign != 0) & np.repeat(size > 1, size)]
    return at


def least_owners(data: np.ndarray, size: np.ndarray, long: np.ndarray, n: int, owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``n`` bytes of the segments the least owner of an equal one."""
    text = np.concatenate([data, np.zeros(n + PERIOD + 64, np.uint8)])
    windows = size - n + 1
    seg_at = np.cumsum(size) - size
    at = np.repeat(seg_at - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    number = np.full(len(data) + 1, -1, np.int64)
    number[at] = np.arange(len(at))
    ranks, distances = cover_ranks(text, len(data) + PERIOD, n), _distances()
    best = owner.copy()
    lead = (text[at].astype(np.int64) << 8) | text[at + 1]
    by_lead = np.argsort(lead, kind="stable")
    bounds = np.cumsum(np.bincount(lead, minlength=1 << 16))
    a = 0
    while a < len(at):  # one bucket at a time: whole runs of equal leading bytes
        b = int(bounds[max(np.searchsorted(bounds, a + BUCKET, "right") - 1, np.searchsorted(bounds, a, "right"))])
        order = sort_bucket(text, at[by_lead[a:b]], ranks, distances)
        equal = np.arange(1, len(order))  # to the suffix before, as far as they are read
        for i in range(-(-n // 8)):
            equal = equal[_word_of(text, order[equal], i, n) == _word_of(text, order[equal - 1], i, n)]
        new = np.ones(len(order), bool)
        new[equal] = False
        first = np.flatnonzero(new)
        mine = number[order]
        best[mine] = np.repeat(np.minimum.reduceat(owner[mine], first), np.diff(np.append(first, len(mine))))
        a = b
    return best, start


def _result(docs: pa.Table, units: Units, copies: np.ndarray, starts: np.ndarray, length: int) -> pa.Table:
    flags = covered(starts, length, len(units.codes))
    first, end, spans_at = word_bounds(flags.view(np.uint8), units.at, np.array([True, False]))
    n_spans, n_bytes = np.diff(spans_at), np.diff(units.at)
    first, n = first - np.repeat(units.at[:-1], n_spans), end - first
    kept = units.data[~flags]
    gone_at = np.concatenate([[0], np.cumsum(n)])[spans_at]
    kept_at = units.at - gone_at
    digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(kept_at[:-1].tolist(), kept_at[1:].tolist())]
    n_removed = np.diff(gone_at)
    texts = docs.column("text")
    for i in np.flatnonzero(copies).tolist():  # empty so far
        raw = texts[i].as_py().encode()
        n_bytes[i] = len(raw)
        if len(raw) < length:
            digests[i] = hashlib.sha256(raw).hexdigest()
        else:
            n_removed[i], n_spans[i] = len(raw), 1
    spans_at = np.concatenate([[0], np.cumsum(n_spans)])
    found = np.ones(spans_at[-1], bool)
    found[spans_at[:-1][copies & (n_spans > 0)]] = False
    spans = np.zeros((2, len(found)), np.int64)
    spans[0, found], spans[1, found] = first, n
    spans[1, ~found] = n_bytes[copies & (n_spans > 0)]
    spans = pa.ListArray.from_arrays(pa.array(spans_at, pa.int32()), pa.StructArray.from_arrays([pa.array(x) for x in spans], names=["first", "n"]))
    columns = [docs.column("doc_id").combine_chunks(), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(digests, pa.string()), spans]
    return pa.table(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def remove_repeats(df: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs (``spans``, in bytes), and the digest of what stays.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller id.
    A null or empty text has no bytes. Every row gives its own result; rows with one id have no smaller
    ids among them, so they take nothing from one another, and a null id is greater than all others. An
    empty table gives none.
    """
    job = RepeatedWindows(byte_units, length, anchor, within=False, resolve=least_owners)
    return with_doc_id(job.run(id_and_text(df, id_col, text_col), RESULT, partial(_result, length=length)), id_col)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that repeat from earlier documents, over all documents."""
    return remove_repeats(documents(spark, sf_dir)).drop("spans")


ENTRIES = {"op1_suffix_array_dedup": (op1_suffix_array_dedup, oracle.OP1)}
