"""Byte-pair encoding and decoding of whole texts with a byte-level vocabulary.

All distinct pre-tokens of a slice that the worker does not know yet are encoded together: an index
maps each pair of neighbouring symbols to all its positions, the ranks that occur are applied in
ascending order, each to all of its positions at once, and the lists of the pairs that this makes
are updated. A pair's rank is above those that made its symbols, so one ascending pass is complete.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from pointferry.llm.textkit import documents, give_back, in_process, slices

VOCABULARY = "byte_bpe_50k.json"
SLICE_BYTES = 1 << 21  # texts that are split and encoded together
# What a worker keeps of encoded pre-tokens; beyond one of these it begins anew.
MAX_KNOWN, MAX_KNOWN_CHARS, MAX_KNOWN_IDS = 800_000, 1 << 25, 1 << 24


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}
    return [others.get(b, chr(b)) for b in range(256)]


class Splitter:
    """Texts to pre-tokens: contractions, then letters, digits or other signs with a space before them, then white space.

    Letters and digits that are newer than the tokenizer library's Unicode tables are other signs.
    """

    def __init__(self):
        named = regex.compile(r"[\p{L}\p{N}]")
        new = np.array([i for i in range(0x110000) if unicodedata.category(chr(i)) == "Cn" and named.match(chr(i))], np.int64)
        breaks = np.flatnonzero(np.diff(new) > 1)
        runs = zip(new[np.r_[0, breaks + 1]].tolist(), new[np.r_[breaks, len(new) - 1]].tolist()) if len(new) else []
        listed = "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in runs)
        self.usual = self._pattern(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
        self.new = regex.compile(f"[{listed}]" if listed else r"(?!)")
        self.careful = self._pattern(rf"[\p{{L}}--[{listed}]]", rf"[\p{{N}}--[{listed}]]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{listed}])") if listed else self.usual

    @staticmethod
    def _pattern(letter: str, digit: str, sign: str) -> regex.Pattern:
        return regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{digit}+| ?{sign}+|\s+(?!\S)|\s+")


class Vocabulary:
    """Pairs with their ranks and what they make, and the bytes of each id."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            data = json.load(f)
        ids, merges = data["model"]["vocab"], data["model"]["merges"]
        letters = byte_letters()
        self.first = np.array([ids[c] for c in letters], np.int64)
        self.ranks: dict[int, int] = {}
        self.pairs: list[tuple[int, int, int]] = []
        made_at = {int(i): -1 for i in self.first}
        for rank, merge in enumerate(merges):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = ids[left], ids[right], ids[left + right]
            if max(made_at.get(a, rank), made_at.get(b, rank)) >= rank or c in made_at:
                raise ValueError("one ascending pass needs a vocabulary whose symbols are each made by one pair, of symbols made before")
            made_at[c] = rank
            self.ranks[a << 32 | b] = rank
            self.pairs.append((a, b, c))
        first = self.first.tolist()
        self.byte_pair_ranks = np.array([[self.ranks.get(a << 32 | b, -1) for b in first] for a in first], np.int32)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_strings = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        byte_of = {c: b for b, c in enumerate(letters)}
        spelled = {i: bytes(byte_of[c] for c in word) for word, i in ids.items() if word not in self.special}
        spelled |= {i: word.encode() for word, i in self.special.items()}
        in_order = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.lengths = np.array([len(b) for b in in_order], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(in_order), np.uint8)

    def merged(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens that a run of bytes consists of, and how many each has; ``ends`` are their ends."""
        n = len(data)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        ranks = np.full(n, -1, np.int32)
        ranks[:-1] = self.byte_pair_ranks[data[:-1], data[1:]]
        ranks[ends - 1] = -1
        places = np.flatnonzero(ranks >= 0)
        places = places[np.argsort(ranks[places], kind="stable")]
        present, counts = np.unique(ranks[places], return_counts=True)
        index = {r: p.tolist() for r, p in zip(present.tolist(), np.split(places, np.cumsum(counts)[:-1]))}
        symbols = self._merge(self.first[data].tolist(), after.tolist(), before.tolist(), index)
        kept = np.array(symbols, np.int64)
        total = np.concatenate([[0], np.cumsum(kept >= 0)])
        at = total[np.concatenate([[0], ends])]
        return kept[kept >= 0].astype(np.int32), np.diff(at)

    def _merge(self, symbols: list[int], after: list[int], before: list[int], index: dict[int, list[int]]) -> list[int]:
        """Symbols after all merges, -1 in the place of those that their left neighbour took in.

        ``index`` has the positions of every rank's pair. A position may have changed since it was
        listed, so it is looked at again when its rank's turn comes.
        """
        get, pairs = self.ranks.get, self.pairs
        active = sorted(index)
        while active:
            rank = heapq.heappop(active)
            left, right, new = pairs[rank]
            for i in sorted(index.pop(rank)):  # of overlapping pairs the left one is merged
                j = after[i]
                if j < 0 or symbols[i] != left or symbols[j] != right:
                    continue
                symbols[i], symbols[j] = new, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    r = get(new << 32 | symbols[k])
                    if r is not None:
                        if r in index:
                            index[r].append(i)
                        else:
                            index[r] = [i]
                            heapq.heappush(active, r)
                h = before[i]
                if h >= 0:
                    r = get(symbols[h] << 32 | new)
                    if r is not None:
                        if r in index:
                            index[r].append(h)
                        else:
                            index[r] = [h]
                            heapq.heappush(active, r)
        return symbols

    def spelled(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of lists of ids with n + 1 offsets, and the offsets of the bytes; unknown ids have none."""
        known = (ids >= 0) & (ids < len(self.lengths))
        ids = np.where(known, ids, 0)
        lengths = np.where(known, self.lengths[ids], 0)
        sizes = np.concatenate([[0], np.cumsum(lengths)])
        return self.bytes[ragged(self.starts[ids], lengths)], sizes[at]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of runs of neighbouring elements, one run after the other."""
    some = lengths > 0
    starts, lengths = starts[some], lengths[some]
    if not len(starts):
        return np.empty(0, np.int64)
    steps = np.ones(int(lengths.sum()), np.int64)
    steps[0] = starts[0]
    steps[np.cumsum(lengths)[:-1]] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(steps)


class Encoder:
    """Ids of texts; encoded pre-tokens stay in the worker until there are too many."""

    def __init__(self, file: str):
        self.vocabulary = in_process(f"vocabulary {file}", lambda: Vocabulary(file))
        self.splitter = in_process("pre-token splitter", Splitter)
        self._begin()

    def _begin(self) -> None:
        self.slots: dict[str, int] = {}
        self.starts, self.lengths, self.pool = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
        self.chars = 0

    def split(self, text: str, pattern: regex.Pattern) -> list[str]:
        """Pre-tokens; special strings stay whole, which no pre-token is."""
        special = self.vocabulary.special
        if not any(s in text for s in special):
            return pattern.findall(text)
        return list(chain.from_iterable([p] if p in special else pattern.findall(p) for p in self.vocabulary.special_strings.split(text)))

    def _learn(self, tokens: list[str]) -> None:
        """Encode pre-tokens that are not known, all at once."""
        special = self.vocabulary.special
        plain = [t for t in tokens if t not in special]
        data = [t.encode() for t in plain]
        ids, lengths = np.empty(0, np.int32), np.empty(0, np.int64)
        if data:
            ids, lengths = self.vocabulary.merged(np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(b) for b in data]))
        whole = [t for t in tokens if t in special]
        ids = np.concatenate([ids, np.array([special[t] for t in whole], np.int32)])
        lengths = np.concatenate([lengths, np.ones(len(whole), np.int64)])
        self.slots.update(zip(plain + whole, range(len(self.slots), len(self.slots) + len(tokens))))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.pool = np.concatenate([self.pool, ids])
        self.chars += sum(map(len, tokens))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and the n + 1 offsets of each text's."""
        if len(self.slots) > MAX_KNOWN or self.chars > MAX_KNOWN_CHARS or len(self.pool) > MAX_KNOWN_IDS:
            self._begin()
        parts = [self.split(t, self.splitter.usual) for t in texts]
        unknown = [t for t in dict.fromkeys(chain.from_iterable(parts)) if t not in self.slots]
        if unknown and self.splitter.new.search("".join(unknown)):
            return self._encode_careful(texts)
        if unknown:
            self._learn(unknown)
        return self._gather(parts)

    def _encode_careful(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As encode, with letters that are too new; nothing of it is kept, so that such texts are always noticed."""
        kept = self.slots, self.starts, self.lengths, self.pool, self.chars
        self._begin()
        parts = [self.split(t, self.splitter.careful) for t in texts]
        self._learn(list(dict.fromkeys(chain.from_iterable(parts))))
        made = self._gather(parts)
        self.slots, self.starts, self.lengths, self.pool, self.chars = kept
        return made

    def _gather(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.array([len(p) for p in parts], np.int64)
        slots = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        lengths = self.lengths[slots]
        at = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return self.pool[ragged(self.starts[slots], lengths)], at


def encode(df: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's id column, ``n_tokens`` and ``ids``, as the tokenizer library's own encoding gives them.

    No special tokens are added; special strings inside a text are special tokens. A null or empty
    text has no ids. Ids of rows may be null, repeated and of any type; other columns do not matter. Very
    long texts are encoded whole. Nothing is shuffled.
    """
    file = _path(vocabulary)
    docs = df.select(df[id_col].alias("_id"), F.coalesce(df[text_col], F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = in_process(f"encoder {file}", lambda: Encoder(file))
        for batch in batches:
            texts = batch.column("_text")
            for first, last, _, _ in slices(texts, SLICE_BYTES):
                ids, at = encoder.encode(texts.slice(first, last - first).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))
                columns = [batch.column("_id").slice(first, last - first), pa.array(np.diff(at), pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "n_tokens", "ids"])
            give_back()

    made = docs.mapInArrow(run, f"_id {docs.schema['_id'].dataType.simpleString()}, n_tokens long, ids array<int>")
    return made.withColumnRenamed("_id", id_col)


def decode(df: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The table with the text of its ids; special tokens are spelled out, bytes that are no UTF-8 replaced.

    A null list is null again, an empty one an empty text. Ids that the vocabulary lacks give nothing.
    """
    file = _path(vocabulary)
    names = [c for c in df.columns if c != text_col]
    schema = df.select(*[df[f"`{c}`"] for c in names]).schema.add(text_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = in_process(f"vocabulary {file}", lambda: Vocabulary(file))
        for batch in batches:
            lists = batch.column(ids_col)
            counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            values = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(counts)
            first = 0
            while first < batch.num_rows:
                base = ends[first] - counts[first]
                last = max(first + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
                at = np.concatenate([[base], ends[first:last]])
                data, places = known.spelled(values[base : at[-1]], at - base)
                texts = _texts(data, places, lists.slice(first, last - first).is_null())
                columns = [batch.column(c).slice(first, last - first) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, texts], names=[*names, text_col])
                first = last
            give_back()

    return df.select(*[df[f"`{c}`"] for c in names]).mapInArrow(run, schema)


def _texts(data: np.ndarray, at: np.ndarray, missing: pa.Array) -> pa.Array:
    """Bytes with n + 1 offsets as texts."""
    raw = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
    try:
        texts = raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:  # not all of it is UTF-8
        texts = pa.array([b.decode(errors="replace") for b in raw.to_pylist()], pa.string())
    return pa.compute.if_else(missing, pa.scalar(None, pa.string()), texts)


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    found = decode(encode(documents(spark, sf_dir)))
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return found.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


ENTRIES = {"op13_bpe_codec": (op13_bpe_codec, None)}
