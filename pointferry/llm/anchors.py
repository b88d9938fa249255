"""Finding equal windows of a corpus by local anchors, with every document chunk read from one shuffle.

A window of n units (bytes or words) has an anchor: the k-unit string inside it whose code is smallest. Equal windows have
equal anchors, so windows are compared where their anchors meet. Neighbouring windows with one anchor form a segment.

1. Each chunk of documents sends the codes of its anchors, once each, to shards by code.
2. A shard tells each chunk which of its codes other chunks have too. Most text ends here.
3. A chunk sends the segments of those anchors, equal ones once, to shards again by the anchor's code.
4. A shard finds equal windows among its segments by an exact method, and replies with the first owner of each window
   where that differs from the owner the segment came with.
5. A chunk sets each window's first owner and returns a row for each document.

What is frequent in a chunk is sent once by it. A passage in many different surroundings still has many segments with one
anchor. Chunks tell with each code how many different segments it has; the shard adds them up and names anchors with more
than ``HOT``. Their windows are sent one by one, equal ones once, to the shard of the window's own code, so no anchor makes a
shard hot, and equal windows still meet. Whole-document copies are found first, by their digest, and stay out of steps 1
to 4. The chunks' shuffle is used by steps 1, 3 and 5 of one plan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pointferry.llm.textkit import BLOCK, SPACES, mix, powers, text_bytes, tidy, window_codes, word_bounds, word_codes

CHUNK_BYTES = 2 << 20  # text a task holds at once, but for longer documents
HOT = 8192  # different segments of one anchor in one shard
COPY, REPLY, WINDOW = 0, 1, 2
_SENT = "shard long, chunk long, payload binary"
_BACK = "chunk long, kind int, number long, payload binary"


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """One-dimensional arrays as compressed bytes."""
    head = np.asarray([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), a.nbytes))], np.int64)
    raw = head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_arrays(payload: bytes) -> list[np.ndarray]:
    raw = pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    arrays, at = [], 8 + 16 * n
    for code, size in head.reshape(n, 2).tolist():
        kind = np.dtype(chr(code))
        arrays.append(np.frombuffer(raw, kind, size // kind.itemsize, at))
        at += size
    return arrays


def smallest_in_windows(codes: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring codes."""
    made = np.empty(max(0, len(codes) - width + 1), codes.dtype)
    for i in range(0, len(made), BLOCK):
        least, have = codes[i : i + BLOCK + width - 1], 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        made[i : i + BLOCK] = least
    return made


@dataclass
class Units:
    """The documents of a chunk in ascending order of id, as units with codes."""

    doc_ids: np.ndarray
    data: np.ndarray  # UTF-8 bytes
    at: np.ndarray  # offsets of documents in the bytes
    codes: np.ndarray  # one per unit
    units_at: np.ndarray  # offsets of documents in the units
    starts: np.ndarray | None = None  # of words in the bytes
    ends: np.ndarray | None = None

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_ids)), np.diff(self.units_at))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def byte_units(doc_ids: np.ndarray, texts: pa.Array) -> Units:
    data, at = text_bytes(texts)
    return Units(doc_ids, data, at, _BYTE_CODES[data], at)


def word_units(doc_ids: np.ndarray, texts: pa.Array) -> Units:
    data, at = text_bytes(texts)
    starts, ends, units_at = word_bounds(data, at, SPACES)
    return Units(doc_ids, data, at, word_codes(data, starts, ends), units_at, starts, ends)


@dataclass
class Segments:
    """Runs of neighbouring windows of one document with one anchor."""

    first: np.ndarray  # the first window's first unit
    windows: np.ndarray  # how many windows
    anchor: np.ndarray  # code of the anchor
    code: np.ndarray  # code of all the segment's units
    row: np.ndarray  # the document


def close_anchors(units: Units, n: int, k: int) -> np.ndarray:
    """Codes, as in ``Segments``, of anchors that one document has twice so close that one segment may hold both."""
    grams = window_codes(units.codes, k)
    wide = n - k + 1
    if len(grams) < wide:
        return np.empty(0, np.uint64)
    least = np.pad(smallest_in_windows(grams, wide), wide - 1)
    # A gram is an anchor where some window over it has nothing smaller.
    at = np.flatnonzero(~smallest_in_windows(~least, wide) == grams)
    at = at[np.argsort(grams[at], kind="stable")]
    row = units.row[at]
    close = (grams[at[1:]] == grams[at[:-1]]) & (row[1:] == row[:-1]) & (at[1:] - at[:-1] <= wide)
    return np.unique(mix(grams[at[1:][close]]))


def _codes_of(grams: np.ndarray, first: np.ndarray, length: np.ndarray, k: int) -> np.ndarray:
    """Codes of runs of units, by their first unit and length.

    Of the grams' codes, not of the units': a sum of few different values times powers is 0 for unlike long runs.
    """
    sums, by = np.zeros(len(grams) + 1, np.uint64), powers(len(grams))
    for i in range(0, len(grams), BLOCK):
        part = grams[i : i + BLOCK] * by[i : i + BLOCK]
        part[0] += sums[i]
        np.cumsum(part, dtype=np.uint64, out=sums[i + 1 : i + 1 + BLOCK])
    return mix((sums[first + length - k + 1] - sums[first]) * powers(len(grams), True)[first] + length.astype(np.uint64))


def windows_of(units: Units, n: int, k: int, first: np.ndarray) -> Segments:
    """The windows that begin at some units, as segments of their own that meet by their own codes."""
    grams = window_codes(units.codes, k)
    codes = _codes_of(grams, first, np.full(len(first), n), k) if len(first) else np.empty(0, np.uint64)
    return Segments(first, np.ones(len(first), np.int64), codes, codes, units.row[first])


def segments_of(units: Units, n: int, k: int) -> Segments:
    total = len(units.codes)
    if total < n:
        empty = np.empty(0, np.int64)
        return Segments(empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty)
    grams = window_codes(units.codes, k)
    least = smallest_in_windows(grams, n - k + 1)  # by window
    change = np.ones(total, bool)
    change[1 : len(least)] = least[1:] != least[:-1]
    change[units.units_at[:-1][units.units_at[:-1] < total]] = True
    short = np.minimum(np.diff(units.units_at), n - 1)  # a document's last units, at which no window begins
    change[np.repeat(units.units_at[1:] - np.cumsum(short), short) + np.arange(short.sum())] = False
    first = np.flatnonzero(change)
    row = np.searchsorted(units.units_at, first, "right") - 1
    # A segment ends where the next begins or its document has no further window.
    last_of_row = np.maximum(units.units_at[1:] - n + 1, units.units_at[:-1])[row]
    after = np.append(first[1:], len(least))
    windows = np.minimum(after, last_of_row) - first
    code = _codes_of(grams, first, windows + n - 1, k)
    return Segments(first, windows, mix(least[first]), code, row)


def _sorted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of codes, and where in it the runs of equal ones begin."""
    order = np.argsort(codes)
    run = codes[order]
    new = np.ones(len(run), bool)
    new[1:] = run[1:] != run[:-1]
    return order, np.flatnonzero(new)


def _numbers(order: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The number of each code's run."""
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
    return numbers


def _shards_of(codes: np.ndarray, shards: int) -> np.ndarray:
    return ((codes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal numbers in an ascending array."""
    if len(shard):
        first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        for a, b in zip(first, np.append(first[1:], len(shard))):
            yield int(shard[a]), slice(int(a), int(b))


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table({n: pa.array(c, kinds[s.split()[1]]) for n, c, s in zip(names, columns, schema.split(", "))})


class RepeatedWindows:
    """The five steps for one kind of unit, window and owner.

    ``within`` tells whether a repeat inside one document counts; then a window's owner is its
    document and start, else its document alone. ``resolve`` is the exact method of step 4: it takes
    the units' bytes of all segments of a shard and gives each window's least owner.
    """

    def __init__(self, units: Callable, n: int, k: int, within: bool, resolve: Callable):
        self.units, self.n, self.k, self.within, self.resolve, self.hot = units, n, k, within, resolve, HOT

    def _load(self, left: pa.Table, right: pa.Table) -> tuple[Units, np.ndarray, list[tuple[int, bytes]]]:
        left = left.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        texts = left.column("text").combine_chunks()
        kinds = right.column("kind").to_pylist()
        numbers = right.column("number").to_pylist()
        payloads = right.column("payload").to_pylist()
        replies = sorted((n, p) for k, n, p in zip(kinds, numbers, payloads) if k == REPLY)
        ids = left.column("doc_id").to_numpy()
        known = {(n, p) for k, n, p in zip(kinds, numbers, payloads) if k == COPY}
        copies = np.zeros(len(ids), bool)
        if known:  # a copy counts as empty here; it needs no comparing
            maybe = np.flatnonzero(np.isin(ids, [n for n, _ in known]))  # unlike texts may have one id
            copies[maybe] = [(int(ids[i]), hashlib.sha256(texts[int(i)].as_buffer()).digest()) in known for i in maybe]
            texts = pc.if_else(pa.array(~copies), texts, pa.scalar("", texts.type))
        return self.units(ids, texts), copies, replies

    def _anchor_codes(self, units: Units, seg: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different anchor codes, 48 bits each and ascending, which of them repeat inside the chunk, and each segment's place among them."""
        codes = seg.anchor >> np.uint64(16)
        order, begin = _sorted(codes)
        found, place = codes[order[begin]], _numbers(order, begin)
        if self.within:
            twice = np.diff(np.append(begin, len(order))) > 1
            return found, twice | np.isin(found, close_anchors(units, self.n, self.k) >> np.uint64(16)), place
        rows = seg.row[order]
        return found, np.minimum.reduceat(rows, begin) != np.maximum.reduceat(rows, begin) if len(rows) else np.empty(0, bool), place

    def _ask(self, shards: int) -> Callable:
        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return _rows(_SENT, [])
            chunk = left.column("chunk")[0].as_py()
            units, _, _ = self._load(left, right)
            seg = segments_of(units, self.n, self.k)
            codes, _, place = self._anchor_codes(units, seg)
            order, begin = _sorted(seg.code)
            counts = np.bincount(place[order[begin]], minlength=len(codes))
            rows = []
            for shard, run in _by_shard(_shards_of(codes << np.uint64(16), shards)):
                many = np.flatnonzero(counts[run] > 1)
                short = codes[run].view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                several = np.concatenate([many, counts[run][many]]).astype("<u4").tobytes()  # codes not named have one segment
                rows.append((shard, chunk, (run.stop - run.start).to_bytes(4, "little") + short + several))
            return _rows(_SENT, rows)

        return ask

    def _met(self, table: pa.Table) -> pa.Table:
        payloads = table.column("payload").to_pylist()
        sizes = [int.from_bytes(p[:4], "little") for p in payloads]
        codes = np.zeros((sum(sizes), 8), np.uint8)
        codes[:, :6] = np.frombuffer(b"".join(p[4 : 4 + 6 * n] for p, n in zip(payloads, sizes)), np.uint8).reshape(-1, 6)
        codes = codes.reshape(-1).view(np.uint64)
        counts, at = np.ones(len(codes), np.int64), 0
        for p, n in zip(payloads, sizes):
            many, count = np.frombuffer(p, "<u4", offset=4 + 6 * n).reshape(2, -1)
            counts[at + many] = count
            at += n
        order = np.argsort(codes, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], codes[order][1:] != codes[order][:-1]]))
        size = np.diff(np.append(first, len(codes)))
        met, hot = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
        met[order] = np.repeat(size > 1, size)
        hot[order] = np.repeat(np.add.reduceat(counts[order], first) > self.hot, size)
        shard = table.column("shard")[0].as_py()
        rows, at = [], 0
        for chunk, n in zip(table.column("chunk").to_pylist(), sizes):
            split = np.flatnonzero(hot[at : at + n]).astype("<u4").tobytes()
            rows.append((chunk, REPLY, shard, np.packbits(met[at : at + n]).tobytes() + split))
            at += n
        return _rows(_BACK, rows)

    def _own(self, units: Units, seg: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different segment codes, where each is first, its owner's document and first unit there, and each segment's number."""
        order, begin = _sorted(seg.code)
        codes, inverse = seg.code[order[begin]], _numbers(order, begin)
        first = np.minimum.reduceat(order, begin) if len(order) else order
        # Documents ascend by id and segments by place, so the first of equal segments has the least owner,
        # unless a row with the same id has one nearer to its start.
        if self.within and len(codes) and (units.doc_ids[1:] == units.doc_ids[:-1]).any():
            order = np.lexsort((seg.first - units.units_at[seg.row], units.doc_ids[seg.row], inverse))
            first = order[np.searchsorted(inverse[order], np.arange(len(codes)))]
        return codes, first, units.doc_ids[seg.row[first]], inverse

    def _send(self, anchor_shards: int, shards: int) -> Callable:
        def send(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return _rows(_SENT, [])
            chunk = left.column("chunk")[0].as_py()
            units, _, replies = self._load(left, right)
            seg = segments_of(units, self.n, self.k)
            codes, live, place = self._anchor_codes(units, seg)
            hot = np.zeros(len(codes), bool)
            by_shard = dict(_by_shard(_shards_of(codes << np.uint64(16), anchor_shards)))
            for shard, payload in replies:
                run = by_shard[shard]
                bits = -(-(run.stop - run.start) // 8)
                live[run] |= np.unpackbits(np.frombuffer(payload, np.uint8, bits), count=run.stop - run.start).view(bool)
                hot[run.start + np.frombuffer(payload, "<u4", offset=bits).astype(np.int64)] = True
            found, first, owner, _ = self._own(units, seg)
            keep = (live & ~hot)[place[first]]
            shard = _shards_of(mix(seg.anchor[first[keep]] >> np.uint64(16)), shards)
            rows = self._sent(chunk, units, seg, shard, found[keep], first[keep], owner[keep], np.empty(0, bool))
            split = np.flatnonzero((live & hot)[place])
            if len(split):
                count = seg.windows[split]
                at = np.repeat(seg.first[split] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                single = windows_of(units, self.n, self.k, at)
                found, first, owner, inverse = self._own(units, single)
                # What the chunk has twice it must be told of in any case: its documents don't know which windows were split.
                rows += self._sent(chunk, units, single, _shards_of(mix(found), shards), found, first, owner, np.bincount(inverse) > 1)
            return _rows(_SENT, rows)

        return send

    def _sent(self, chunk: int, units: Units, seg: Segments, shard: np.ndarray, codes: np.ndarray, first: np.ndarray, owner: np.ndarray, always: np.ndarray) -> list[tuple]:
        """Rows of segments for their shards; single windows have flags ``always``, whether a reply is due in any case."""
        order = np.argsort(shard, kind="stable")
        rows = []
        for number, run in _by_shard(shard[order]):
            at = order[run]
            begin, units_long = seg.first[first[at]], seg.windows[first[at]] + self.n - 1
            start = begin - units.units_at[seg.row[first[at]]]
            flags = always[at] if len(always) else always
            rows.append((number, chunk, pack_arrays(codes[at], units_long.astype(np.int32), owner[at], start.astype(np.int64), *self._text(units, begin, units_long), flags.view(np.uint8))))
        return rows

    def _text(self, units: Units, begin: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of each segment one after the other, and how many each has."""
        if units.starts is None:
            a, b = begin, begin + long
        else:
            a, b = units.starts[begin], units.ends[begin + long - 1]
        size = b - a
        at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return units.data[at], size.astype(np.int32)

    def _answer(self, table: pa.Table) -> pa.Table:
        parts = [unpack_arrays(p) for p in table.column("payload").to_pylist()]
        chunks = table.column("chunk").to_pylist()
        counts = [len(p[0]) for p in parts]
        flags = [p[6].view(bool) for p in parts]
        codes, long, owner, start, data, size = (np.concatenate([p[i] for p in parts]) for i in range(6))
        # Equal segments of several chunks are resolved once, with the least owner.
        order = np.lexsort((start, owner, codes))
        new = np.concatenate([[True], codes[order][1:] != codes[order][:-1]])
        rep = order[new]
        number = np.empty(len(codes), np.int64)
        number[order] = np.cumsum(new) - 1
        byte_at = np.concatenate([[0], np.cumsum(size)])
        pick = np.repeat(byte_at[rep] - (np.cumsum(size[rep]) - size[rep]), size[rep]) + np.arange(size[rep].sum())
        windows = (long[rep] - self.n + 1).astype(np.int64)
        w_at = np.concatenate([[0], np.cumsum(windows)])
        w_seg = np.repeat(np.arange(len(rep)), windows)
        w_start = start[rep][w_seg] + np.arange(w_at[-1]) - w_at[w_seg]
        best_owner, best_start = self.resolve(data[pick], size[rep].astype(np.int64), long[rep].astype(np.int64), self.n, owner[rep][w_seg], w_start)
        rows, at = [], 0
        shard = table.column("shard")[0].as_py()
        for chunk, n, always in zip(chunks, counts, flags):
            mine = np.arange(at, at + n)
            at += n
            seg = number[mine]
            # The segment's own windows, one after the other, as the chunk knows them.
            count = windows[seg]
            of = np.repeat(np.arange(n), count)
            place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            got_owner, got_start = best_owner[w_at[seg][of] + place], best_start[w_at[seg][of] + place]
            differs = (got_owner != owner[mine][of]) | (self.within & (got_start != start[mine][of] + place))
            tell = always.copy() if len(always) else np.zeros(n, bool)
            tell[of[differs]] = True
            if tell.any():
                told = tell[of]
                rows.append((chunk, WINDOW if len(always) else REPLY, shard, pack_arrays(codes[mine][tell], count[tell].astype(np.int32), got_owner[told], got_start[told])))
        return _rows(_BACK, rows)

    def _finish(self, result: Callable) -> Callable:
        def finish(left: pa.Table, right: pa.Table) -> pa.Table:
            units, copies, replies = self._load(left, right)
            seg = segments_of(units, self.n, self.k)
            codes, first, owner, inverse = self._own(units, seg)
            start = seg.first - units.units_at[seg.row]
            doc = units.doc_ids[seg.row]
            replies = [unpack_arrays(payload) for _, payload in replies]
            heard = np.zeros(len(codes), bool)
            for told, *_ in replies:
                heard[np.searchsorted(codes, told)] = True
            # Only segments with a reply, or with an earlier equal in the chunk, can hold a repeat.
            equal = owner[inverse] < doc if len(doc) else np.empty(0, bool)
            if self.within:
                equal |= (owner[inverse] == doc) & (start[first][inverse] < start)
            taken = np.flatnonzero(heard[inverse] | equal) if len(doc) else np.empty(0, np.int64)
            needed = np.zeros(len(codes), bool)
            needed[inverse[taken]] = True
            windows = np.where(needed, seg.windows[first], 0)
            w_at = np.concatenate([[0], np.cumsum(windows)]).astype(np.int64)
            w_seg = np.repeat(np.arange(len(first)), windows)
            w_owner = owner[w_seg] if len(first) else np.empty(0, np.int64)
            w_start = start[first][w_seg] + np.arange(len(w_seg)) - w_at[w_seg]
            for told, count, got_owner, got_start in replies:
                spot = w_at[np.searchsorted(codes, told)]
                at = np.repeat(spot - (np.cumsum(count) - count), count) + np.arange(len(got_owner))
                w_owner[at], w_start[at] = got_owner, got_start
            # Every taken segment's windows take what its kind was told.
            count = seg.windows[taken]
            of = np.repeat(taken, count)
            step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            at = w_at[inverse[of]] + step
            unit = seg.first[of] + step
            earlier = w_owner[at] < doc[of]
            if self.within:
                earlier |= (w_owner[at] == doc[of]) & (w_start[at] < start[of] + step)
            starts = np.concatenate([unit[earlier], self._of_split(units, right)])
            return result(left.sort_by([("doc_id", "ascending"), ("text", "ascending")]), units, copies, starts)

        return finish

    def _of_split(self, units: Units, right: pa.Table) -> np.ndarray:
        """First units of repeated windows, of those that were sent one by one."""
        told = [unpack_arrays(p) for k, p in zip(right.column("kind").to_pylist(), right.column("payload").to_pylist()) if k == WINDOW]
        if not told:
            return np.empty(0, np.int64)
        codes, _, owner, start = (np.concatenate([t[i] for t in told]) for i in range(4))
        order = np.argsort(codes)
        codes, owner, start = codes[order], owner[order], start[order]
        row = units.row
        at = np.flatnonzero(row[: len(row) - self.n + 1] == row[self.n - 1 :])
        own = windows_of(units, self.n, self.k, at)
        spot = np.minimum(np.searchsorted(codes, own.code), len(codes) - 1)
        doc = units.doc_ids[own.row]
        earlier = owner[spot] < doc
        if self.within:
            earlier |= (owner[spot] == doc) & (start[spot] < at - units.units_at[own.row])
        return at[earlier & (codes[spot] == own.code)]

    def sent(self, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The documents by chunk, the copies among them, and the segments that go to the shards."""
        spark = docs.sparkSession
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        chunks = max(1, -(-total // CHUNK_BYTES))
        chunk = lambda text: F.pmod(F.xxhash64("doc_id", text), F.lit(chunks)).alias("chunk")  # noqa: E731  # an id may have many texts
        dealt = docs.select(chunk(F.xxhash64("text")), "doc_id", "text").repartition(partitions, "chunk")
        copies = copies_of(docs).select(chunk("text_hash"), F.lit(COPY).alias("kind"), F.col("doc_id").alias("number"), F.col("digest").alias("payload"))
        anchor_shards, shards = max(1, chunks // 4), chunks
        sent = dealt.groupBy("chunk").cogroup(copies.groupBy("chunk")).applyInArrow(tidy(self._ask(anchor_shards)), _SENT)
        met = sent.groupBy("shard").applyInArrow(tidy(self._met), _BACK)
        segments = dealt.groupBy("chunk").cogroup(copies.unionAll(met).groupBy("chunk")).applyInArrow(tidy(self._send(anchor_shards, shards)), _SENT)
        return dealt, copies, segments

    def run(self, docs: DataFrame, schema: str, result: Callable) -> DataFrame:
        """``result(documents, units, copies, starts)`` makes the rows of a chunk; ``starts`` are repeated windows' first units."""
        dealt, copies, segments = self.sent(docs)
        owners = segments.groupBy("shard").applyInArrow(tidy(self._answer), _BACK)
        return dealt.groupBy("chunk").cogroup(copies.unionAll(owners).groupBy("chunk")).applyInArrow(tidy(self._finish(result)), schema)


def copies_of(docs: DataFrame, salts: int = 4) -> DataFrame:
    """Id, digest and hash of texts that are whole texts of documents with a smaller id too.

    Copies of one text may be many: they are dealt over salts, to which the texts that have copies
    are replicated. Both sides are then shuffled for the join itself, so adaptive execution can
    split what is still large.
    """
    digests = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.xxhash64("text").alias("text_hash"))
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first")
    first = first.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = digests.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(salts)).cast("int"))
    return salted.join(first, ["digest", "salt"]).where("doc_id > first").select("doc_id", "digest", "text_hash").distinct()
