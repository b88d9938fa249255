"""Benchmark decontamination on a positional inverted index of the training tokens, one index per shard of documents.

A shard is a slice of whole texts. Its index holds, for every term a benchmark uses, the ordered list of the term's
positions. A phrase is found from its rarest term there: that term's list, shifted by the term's place in the phrase,
is intersected with the lists of the others, rarest first. Documents never move; only the benchmark is sent around, in
parts of a checked size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pointferry.llm import oracle
from pointferry.llm.textkit import LOWER, NO_ID, NOT_ALNUM, covered, counts_in_rows, documents, id_and_text, slices, small_batches, text_bytes, with_doc_id, word_bounds, word_codes

WINDOW = 10
PART_BYTES = 16 << 20  # benchmark text that is sent to the tasks at once
NEAR_SLACK = 3
NEAR_SHARE = 0.8
NEAR_BLOCK = 1 << 20  # places looked at together, but for a phrase with more
_NEAR = pa.struct([("item", pa.int64()), ("first", pa.int64()), ("n", pa.int64())])
FOUND = "doc_id long, row long, n_words long, hit_spans array<struct<first:long,n:long>>, items array<long>, near array<struct<item:long,first:long,n:long>>"


@dataclass(frozen=True)
class Phrases:
    """Phrases of one length: their term numbers, and for each the number of its item."""

    terms: np.ndarray
    items: np.ndarray

    @property
    def length(self) -> int:
        return self.terms.shape[1]


@dataclass(frozen=True)
class Benchmark:
    """Sorted codes of the terms in use, and the phrases by length."""

    vocabulary: np.ndarray
    phrases: tuple[Phrases, ...]


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    small = LOWER[data]
    starts, ends, words_at = word_bounds(small, at, NOT_ALNUM)
    return word_codes(small, starts, ends), words_at


def phrases_of(ids: list[int], texts: list[str], window: int = WINDOW) -> Benchmark:
    """The windows of each item; an item of fewer words is one window, one without words none."""
    codes, at = _words(*text_bytes(pa.array(texts, pa.large_string())))
    vocabulary, terms = np.unique(codes, return_inverse=True)
    sizes = np.diff(at)
    found = []
    for n in np.unique(np.minimum(sizes, window)):
        rows = np.flatnonzero((sizes == n) if n < window else (sizes >= n))
        if n:
            first = np.concatenate([np.arange(at[r], at[r + 1] - n + 1) for r in rows])
            items = np.repeat(np.asarray(ids, np.int64)[rows], sizes[rows] - n + 1)
            found.append(Phrases(terms[first[:, None] + np.arange(n)].astype(np.int64), items))
    return Benchmark(vocabulary, tuple(found))


class Index:
    """Position lists of the terms in use, over one slice of texts."""

    def __init__(self, codes: np.ndarray, words_at: np.ndarray, vocabulary: np.ndarray):
        spot = np.minimum(np.searchsorted(vocabulary, codes), len(vocabulary) - 1)
        self.term_at = np.where(vocabulary[spot] == codes, spot, -1)
        used = np.flatnonzero(self.term_at >= 0)
        order = np.argsort(self.term_at[used], kind="stable")
        self.positions = used[order]
        self.counts = np.bincount(self.term_at[used], minlength=len(vocabulary))
        self.first = np.cumsum(self.counts) - self.counts
        self.words_at = words_at
        self.row_of = np.repeat(np.arange(len(words_at) - 1), np.diff(words_at))

    def shifted(self, phrases: Phrases, phrase: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) for every position of the term at a place of each phrase."""
        term = phrases.terms[phrase, place]
        n = self.counts[term]
        which = np.repeat(np.arange(len(phrase)), n)
        within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return phrase[which], self.positions[self.first[term][which] + within] - place[which]

    def _inside(self, start: np.ndarray, length: int) -> np.ndarray:
        total = len(self.row_of)
        ok = (start >= 0) & (start + length <= total)
        ok[ok] = self.row_of[start[ok]] == self.row_of[start[ok] + length - 1]
        return ok

    def exact(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of every occurrence."""
        rarity = self.counts[phrases.terms]
        order = np.argsort(rarity, axis=1, kind="stable")
        phrase = np.flatnonzero(rarity.min(axis=1) > 0)
        phrase, start = self.shifted(phrases, phrase, order[phrase, 0])
        keep = self._inside(start, phrases.length)
        phrase, start = phrase[keep], start[keep]
        for k in range(1, phrases.length):
            place = order[phrase, k]
            keep = self.term_at[start + place] == phrases.terms[phrase, place]
            phrase, start = phrase[keep], start[keep]
        return phrase, start

    def sketch(self, before: int, after: int) -> np.ndarray:
        """For every place the bits of the terms in use that stand from ``before`` words before it to ``after`` behind it."""
        width = before + after + 1
        bits = np.zeros(len(self.term_at) + width - 1, np.uint64)
        used = self.positions
        bits[used + before] = _bits(self.term_at[used])
        done = 1
        while done < width:
            step = min(done, width - done)
            bits = bits[:-step] | bits[step:]
            done += step
        return bits

    def near(self, phrases: Phrases, slack: int, share: float) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) where enough terms stand within ``slack`` of their places, at least one of them in its place.

        A match lacks at most ``n - needed`` terms, so it holds one of any ``n - needed + 1``: the
        places it is looked for are those of that many of the phrase's rarest terms, each within
        ``slack``. What else the slice holds changes the work only. A term has one of 64 bits; places
        around which more than ``n - needed`` bits of the phrase are missing can't be matches and are left out first.
        """
        n = phrases.length
        needed = int(np.ceil(share * n - 1e-9))
        counts = self.counts[phrases.terms]
        order = np.argsort(counts, axis=1, kind="stable")
        able = np.flatnonzero((counts > 0).sum(axis=1) >= needed)
        anchors = n - needed + 1
        work = np.cumsum(np.take_along_axis(counts, order, axis=1)[able, :anchors].sum(axis=1) * (2 * slack + 1)) // NEAR_BLOCK
        bits = np.bitwise_or.reduce(_bits(phrases.terms), axis=1)
        around = [self.sketch(reach, n - 1 + reach) for reach in (2 * slack, slack)]
        found = [self._near(phrases, block, order, anchors, slack, bits, around) for block in np.split(able, np.flatnonzero(np.diff(work)) + 1)]
        return np.concatenate([p for p, _ in found]), np.concatenate([s for _, s in found])

    def _near(
        self, phrases: Phrases, able: np.ndarray, order: np.ndarray, anchors: int, slack: int, bits: np.ndarray, around: list[np.ndarray],
    ) -> tuple[np.ndarray, np.ndarray]:
        """The matches of some phrases from their first ``anchors`` terms in the given order.

        ``bits`` are those of each phrase, ``around`` those that stand within twice ``slack`` and within ``slack`` of a phrase's places.
        """
        n, total = phrases.length, len(self.row_of)
        keys = [np.empty(0, np.int64)]
        for k in range(anchors):
            phrase, start = self.shifted(phrases, able, order[able, k])
            keep = np.bitwise_count(bits[phrase] & ~around[0][np.clip(start, 0, total - 1)]) < anchors
            phrase, start = phrase[keep], start[keep]
            for s in range(-slack, slack + 1):
                moved = start - s
                keep = np.flatnonzero(self._inside(moved, n))
                keep = keep[np.bitwise_count(bits[phrase[keep]] & ~around[1][moved[keep]]) < anchors]
                keys.append(phrase[keep] * total + moved[keep])
        key = np.sort(np.concatenate(keys))
        phrase, start = np.divmod(key[np.diff(key, prepend=-1) != 0], max(total, 1))
        row = self.row_of[start]
        missed, exact = np.zeros(len(phrase), np.int64), np.zeros(len(phrase), bool)
        for k in range(n):
            place = order[phrase, k]
            term = phrases.terms[phrase, place]
            there = np.zeros(len(phrase), bool)
            for s in range(-slack, slack + 1):
                spot = start + place + s
                inside = (spot >= self.words_at[row]) & (spot < self.words_at[row + 1])
                there |= inside & (self.term_at[np.where(inside, spot, start)] == term)
            exact |= self.term_at[start + place] == term
            missed += ~there
            keep = missed < anchors
            phrase, start, row, missed, exact = phrase[keep], start[keep], row[keep], missed[keep], exact[keep]
        return phrase[exact], start[exact]


def _bits(terms: np.ndarray) -> np.ndarray:
    """One of 64 bits for each term number."""
    return np.uint64(1) << (terms % 64).astype(np.uint64)


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [{"first": int(a), "n": int(b - a)} for a, b in zip(edges[::2], edges[1::2])]


def _search(batch: pa.RecordBatch, benchmark: Benchmark, slack: int, share: float) -> pa.RecordBatch:
    n_words, spans, items, near = [], [], [], []
    for first, last, data, at in slices(batch.column("text")):
        codes, words_at = _words(data, at)
        n = last - first
        n_words.append(np.diff(words_at))
        row_items: list[set[int]] = [set() for _ in range(n)]
        flags = np.zeros(len(codes), bool)
        row_near: list[set[tuple]] = [set() for _ in range(n)]
        if len(codes) and len(benchmark.vocabulary):
            index = Index(codes, words_at, benchmark.vocabulary)
            for phrases in benchmark.phrases:
                phrase, start = index.exact(phrases)
                flags |= covered(start, phrases.length, len(codes))
                for row, item in np.unique(np.stack([index.row_of[start], phrases.items[phrase]]), axis=1).T.tolist():
                    row_items[row].add(item)
                phrase, start = index.near(phrases, slack, share)
                row = index.row_of[start]
                for r, item, first_word in zip(row.tolist(), phrases.items[phrase].tolist(), (start - words_at[row]).tolist()):
                    row_near[r].add((item, first_word, phrases.length))
        hits = counts_in_rows(flags, words_at)
        spans += [_runs(flags[words_at[r] : words_at[r + 1]]) if hits[r] else [] for r in range(n)]
        items += [sorted(x) for x in row_items]
        near += [[{"item": i, "first": f, "n": long} for i, f, long in sorted(x)] for x in row_near]
    join = lambda parts: pa.array(np.concatenate(parts), pa.int64())
    carried = [c for c in ("text", "rest") if "rest" in batch.schema.names]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("row"), join(n_words), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))), pa.array(items, pa.list_(pa.int64())), pa.array(near, pa.list_(_NEAR)), *map(batch.column, carried)],
        names=["doc_id", "row", "n_words", "hit_spans", "items", "near", *carried],
    )


def benchmark_parts(benchmark: DataFrame, item_col: str, text_col: str, part_bytes: int = PART_BYTES) -> Iterator[list]:
    """Items in parts of about ``part_bytes`` of text each; a null id is ``NO_ID``."""
    items = benchmark.select(F.coalesce(benchmark[item_col].cast("long"), F.lit(NO_ID)).alias("item_id"), F.coalesce(benchmark[text_col], F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // part_bytes) + 1
    for k in range(n):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()


def find_contamination(
    df: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = NEAR_SLACK, near_share: float = NEAR_SHARE,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", part_bytes: int = PART_BYTES,
    carry: bool = False,
) -> DataFrame:
    """Per document: runs of hit words (``hit_spans``), the items found, and proximity matches (``near``, ``n_near``).

    ``near`` lists item, first word and words of every place where at least ``near_share`` of a
    window's terms stand within ``slack`` words of their places, one at its place; exact matches are
    among them. ``n_near`` counts its different places. Neither depends on other documents.

    A null or empty text has no words. Repeated documents give repeated results; a repeated item
    counts once. Items without an id hit as others do and are together one null in ``items``. An empty
    benchmark hits nothing. A benchmark above ``part_bytes`` is searched in
    parts, a scan of the documents for each, and the parts' results are merged per document. ``carry``
    adds ``text`` and ``rest``, the document's other columns.
    """
    docs = id_and_text(df, id_col, text_col, carry).withColumn("row", F.monotonically_increasing_id())
    schema = StructType.fromDDL(FOUND)
    if carry:
        schema = schema.add("text", "string").add(docs.schema["rest"])
    context = df.sparkSession.sparkContext
    found = []
    for part in benchmark_parts(benchmark, item_col, item_text_col, part_bytes):
        made = phrases_of([r["item_id"] for r in part], [r["text"] for r in part], window)
        sent = context.broadcast((made.vocabulary, [(p.terms, p.items) for p in made.phrases]))

        def run(batches, sent=sent):
            vocabulary, phrases = sent.value
            wanted = Benchmark(vocabulary, tuple(Phrases(*p) for p in phrases))
            for batch in batches:
                for part in small_batches(batch):
                    yield _search(part, wanted, slack, near_share)

        found.append(docs.mapInArrow(run, schema))
    if len(found) == 1:
        return with_doc_id(with_n_near(found[0].drop("row")), id_col)
    merged = found[0]
    for other in found[1:]:
        merged = merged.unionAll(other)
    merged = merged.groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hit_spans")).alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
        *(F.first(c).alias(c) for c in ("text", "rest") if carry),
    )
    return with_doc_id(with_n_near(merged.drop("row")), id_col)


def with_n_near(df: DataFrame) -> DataFrame:
    """Restores null item ids, and adds the number of different first words of proximity matches."""
    known = lambda item: F.when(item != NO_ID, item)
    df = df.withColumn("items", F.transform("items", known)).withColumn("near", F.transform("near", lambda x: x.withField("item", known(x["item"]))))
    return df.withColumn("n_near", F.size(F.array_distinct(F.col("near.first"))).cast("long"))


def n_hit(spans: str = "hit_spans"):
    """The number of places in the union of runs."""
    ordered = F.array_sort(spans)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def add(done, span):
        end = span["first"] + span["n"]
        new = F.greatest(end - F.greatest(span["first"], done["upto"]), F.lit(0).cast("long"))
        return F.struct((done["n"] + new).alias("n"), F.greatest(end, done["upto"]).alias("upto"))

    return F.aggregate(ordered, start, add, lambda done: done["n"])


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    found = find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    hit = found.withColumn("n_hit", n_hit())
    return hit.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ENTRIES = {"op7_benchmark_decontamination": (op7_benchmark_decontamination, oracle.OP7)}
