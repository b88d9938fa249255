"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous supersteps.

Sizes are whole numbers up to the capacity, so the range-sorted documents and the range-sorted gaps are runs of equal
size. A superstep takes the documents of one size, the largest first, and sweeps the gaps upwards from the successor of
that size; of all documents that want the same gap, the one with the lower rank gets it, and the gaps shrink before the
next superstep. The sweep needs only the length of each run, at most one number per size; the ranks are given to the
documents themselves by a distributed sort within runs, which are salted, so that no run is sorted by one task.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from codecs import charmap_decode
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pointferry.llm.textkit import Kept, documents, id_and_text, in_process, small_batches, with_doc_id
from pointferry.session import scratch_dir

CAPACITY = 4096
END_ID = 1
WORDS = 500_000  # entries of each generation of a worker's cache
RUN_ROWS = 2_000  # rows of one size that one task ranks
# Latin letters, and after them a run of ASCII marks without apostrophes: two pre-tokens.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
# How byte-level models write a byte: those that are no visible characters by letters of their own.
_BYTE_CHARS = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}
_VISIBLE = "".join(chr(_BYTE_CHARS.get(b, b)) for b in range(256))
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Packed little-endian ids of texts, by way of their words.

    The tokenizer drops white space and never joins over it, so the ids of a text are those of its
    words. A plain word is letters, taken in lower case as the tokenizer does, and the marks after
    them; all other words go through the whole tokenizer. Most words of a text that are new are plain
    and in lower case, so the parts of a word are kept among the words, each once.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenize = self.tokenizer.model.tokenize
        self.words = Kept(self._word, WORDS)

    def _word(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return pack_ids(self.tokenizer.encode(word, add_special_tokens=False).ids)
        core, mark = plain.groups()
        if mark:
            return self.words[core] + self.words[mark]
        lower = core.lower()
        if lower != core:
            return self.words[lower]
        # One pre-token; the model reads its bytes as characters.
        return pack_ids([t.id for t in self.tokenize(charmap_decode(core.encode(), "strict", _VISIBLE)[0])])

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


def token_pieces(
    df: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut only where longer than the capacity."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        words = in_process(f"word ids of {tokenizer}", lambda: WordIds(public_tokenizers.path(tokenizer)))
        for batch in (part for whole in batches for part in small_batches(whole)):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = words.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<i4") if with_ids else None))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in PIECES.split(", ")])

    return id_and_text(df, id_col, text_col).mapInArrow(run, PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(size, first rank, first rank after, first sequence, documents a sequence, first offset) of every match.

    One superstep per size. Gaps of equal size are kept as runs of neighbouring sequences.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, sequences)
    sizes_of_gaps: list[int] = []
    matches, opened = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps or not gaps[gap]:
                insort(sizes_of_gaps, gap)
            gaps[gap].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            successor = bisect_left(sizes_of_gaps, size)
            if successor < len(sizes_of_gaps):
                gap = sizes_of_gaps[successor]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    sizes_of_gaps.pop(successor)
            else:
                gap, first, n = capacity, opened, -(-left // (capacity // size))
                opened += n
            each = gap // size
            used = min(n, -(-left // each))
            placed = min(left, used * each)
            matches.append((size, rank, rank + placed, first, each, capacity - gap))
            full, rest = divmod(placed, each)
            put(gap - each * size, first, full)
            if rest:
                put(gap - rest * size, first + full, 1)
            put(gap, first + used, n - used)
            rank, left = rank + placed, left - placed
    return matches


def pack(pieces: DataFrame, capacity: int = CAPACITY, size_col: str = "length") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a whole size from 1 to the capacity.

    ``pieces`` must give the same rows each time it is read, as a stored table does. Equal rows get
    places of their own. An empty table stays empty.
    """
    spark = pieces.sparkSession
    counts = {r[size_col]: r["n"] for r in pieces.groupBy(size_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 1 <= size <= capacity for size in counts):
        raise ValueError(f"sizes must lie between 1 and {capacity}")
    # Each size's salts, by size: its documents over RUN_ROWS.
    salts = F.split(F.lit(",".join(str(max(1, -(-counts.get(size, 0) // RUN_ROWS))) for size in range(1, capacity + 1))), ",").cast("array<int>")
    keys = [c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.element_at(salts, F.col(size_col).cast("int"))).cast("int"))
    by_run = Window.partitionBy(size_col, "_salt").orderBy(*keys)
    before = Window.partitionBy(size_col).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    runs = salted.groupBy(size_col, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    runs = runs.select(size_col, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(by_run) - 1).join(runs, [size_col, "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    matches = best_fit(counts, capacity)
    schema = f"{size_col} long, _from long, _to long, _first long, _each long, _offset long"
    # Bounded by the capacity: a superstep splits few runs of gaps, whatever the number of documents.
    plan = F.broadcast(spark.createDataFrame(matches, schema))
    placed = ranked.join(plan, (ranked[size_col] == plan[size_col]) & (ranked["_rank"] >= plan["_from"]) & (ranked["_rank"] < plan["_to"])).drop(plan[size_col])
    within = F.col("_rank") - F.col("_from")
    return placed.select(
        *pieces.columns,
        (F.col("_first") + F.floor(within / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (within % F.col("_each")) * F.col(size_col)).cast("long").alias("offset"),
    )


def pack_documents(
    df: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per piece of a document: where it begins there, its length, checksum and ids, its sequence and offset.

    A null or empty text is the end id alone. Repeated rows are packed each for itself. Without
    ``with_ids`` the ids are null. Pieces are written once to the shared scratch folder, since ranks
    need the same rows on every read.
    """
    folder = scratch_dir(df.sparkSession, "pieces")
    token_pieces(df, tokenizer, capacity, end_id, with_ids, id_col, text_col).write.parquet(folder)
    return with_doc_id(pack(df.sparkSession.read.schema(PIECES).parquet(folder), capacity), id_col)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place."""
    return pack_documents(documents(spark, sf_dir)).drop("ids")


ENTRIES = {"op2_best_fit_packing": (op2_best_fit_packing, None)}
