"""Exact Jaccard join of word-shingle sets in metric space: pivots, Voronoi regions, windows of the triangle inequality.

Equal sets are joined first, by a digest; one document stands for each. The rest is metric, with d = 1 - Jaccard and
t = 1 - threshold:

* Sampled documents are no pivots for a whole corpus: nearly every document lies at distance 1 from all of them. So
  pivots are found by content. A set's elements are dealt into parts by their codes. Sets within t differ in fewer
  elements than there are parts, so they agree in at least one; documents that share a part choose its least document
  as pivot. A document enters the region of each of its pivots, which makes regions overlap as far as a link can reach.
* In a region every document is measured against the pivot. Those within t are linked to it, and so to one another's
  component; nothing more is asked of their pairs. The others become pivots in turn, each for the documents inside
  its window: d(x, p) and d(y, p) may differ by t at most, and so may, summed over 64 code classes, the numbers of
  elements (that sum is never above the sets' difference).
* Regions are dealt over salts by size. The documents of a salted region that are not within t of its pivot are
  replicated to its other salts, in blocks. So no region, however hot, is held by one task, and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointferry.llm import oracle
from pointferry.llm.anchors import CHUNK_BYTES, pack_arrays, unpack_arrays
from pointferry.llm.anchors import _by_shard, _rows, _shards_of
from pointferry.llm.components import components
from pointferry.llm.textkit import LOWER, NO_ID, SPACES, documents, id_and_text, mix, row_of, slices, small_batches, text_bytes, tidy, with_doc_id, word_bounds, word_codes, window_codes
from pointferry.operators.sizing import broadcast_if_small, maybe_members, measured
from pointferry.session import scratch_dir

SHINGLE, THRESHOLD = 5, Fraction(8, 10)
REGION = 256  # documents of a region in one task
BLOCK = 1024  # replicated documents in one task
CLASSES = 64
SALTS = 4  # over which equal sets are dealt; adaptive execution splits what is still large
COPY, REPLY = 0, 1
_SENT = "shard long, chunk long, payload binary"
_BACK = "chunk long, kind int, number long, payload binary"
_MEMBER = "pivot long, salt int, salts int, doc long, codes binary"
_FOUND = "kind int, pivot long, salt int, salts int, a long, b long, gap double, codes binary"
_DIGESTS = "doc_id long, mark long, n_shingles long, digest_a long, digest_b long"
EDGE, FAR = 0, 1


def shingle_sets(data: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle codes of each text, ascending, and the offsets of the texts in them."""
    small = LOWER[data]
    starts, ends, words_at = word_bounds(small, at, SPACES)
    words = word_codes(small, starts, ends)
    codes, rows = window_codes(words, n), row_of(words_at)
    inside = np.flatnonzero(rows[: len(codes)] == rows[n - 1 :]) if len(codes) else np.empty(0, np.int64)
    codes, owner = codes[inside], rows[inside]
    short = np.flatnonzero((np.diff(words_at) > 0) & (np.diff(words_at) < n))
    if len(short):  # the whole sequence is the one shingle
        extra = np.array([window_codes(words[words_at[r] : words_at[r + 1]], words_at[r + 1] - words_at[r])[0] for r in short], np.uint64)
        codes, owner = np.concatenate([codes, mix(extra + np.diff(words_at)[short].astype(np.uint64))]), np.concatenate([owner, short])
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    codes, owner = codes[new], owner[new]
    return codes, np.searchsorted(owner, np.arange(len(at)))


APART = 1 << 62  # keys from here on are those of rows that their id does not tell apart


def row_mark(id_col: str | Column = "doc_id", text: str | Column = "text") -> Column:
    """A number of 60 bits of a row's id and text, from their SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", F.col(id_col) if isinstance(id_col, str) else id_col, text), 256), 1, 15), 16, 10).cast("long")


def row_key(repeated: DataFrame | None, docs: DataFrame) -> DataFrame:
    """Adds ``key``: the id, or a number of the row's own where the id is null, stands for unlike texts, or is as large as such numbers."""
    apart = F.col("doc_id") >= APART
    if repeated is not None:
        docs = docs.join(broadcast_if_small(repeated.withColumn("_repeated", F.lit(True)), "ids of unlike texts"), "doc_id", "left")
        apart = apart | F.col("_repeated").isNotNull()
    return docs.withColumn("key", F.when(apart, F.lit(APART) + F.col("mark")).otherwise(F.col("doc_id"))).drop("_repeated")


def set_digests(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, mark, n_shingles, digest a and b): equal sets have equal digests."""

    def run(batches):
        for batch in (part for whole in batches for part in small_batches(whole)):
            size, a, b = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for _, _, data, at in slices(batch.column("text")):
                codes, sets_at = shingle_sets(data, at, n)
                for found, values in ((a, codes), (b, mix(codes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))):
                    sums = np.zeros(len(codes) + 1, np.uint64)
                    np.cumsum(values, dtype=np.uint64, out=sums[1:])
                    found.append(sums[sets_at[1:]] - sums[sets_at[:-1]])
                size.append(np.diff(sets_at))
            columns = [batch.column("doc_id"), batch.column("mark"), *(pa.array(np.concatenate(x).view(np.int64)) for x in (size, a, b))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n_shingles", "digest_a", "digest_b"])

    return docs.mapInArrow(run, _DIGESTS)


class Parts:
    """The parts in which sets within the threshold must agree."""

    def __init__(self, threshold: Fraction):
        self.num, self.den = threshold.numerator, threshold.denominator

    def differences(self, size: np.ndarray) -> np.ndarray:
        """In how many elements a set may differ from one as large or larger that it is linked to."""
        return size * (self.den - self.num) // self.num

    def level(self, size: np.ndarray) -> np.ndarray:
        """The binary logarithm of the number of parts, from the smaller set of a pair."""
        wanted = -(-5 * (self.differences(size) + 1) // 4)
        return np.ceil(np.log2(np.maximum(wanted, 1))).astype(np.int64)

    def signatures(self, codes: np.ndarray, sets_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of a part, number of its set), for all parts that may have to agree."""
        size = np.diff(sets_at)
        least = -(-size * self.num // self.den)
        own, lower = self.level(size), self.level(least)
        found = [self._at_level(codes, sets_at, np.flatnonzero(self.differences(size) > 0), own, self.differences(size))]
        two = np.flatnonzero((lower < own) & (self.differences(size) > 0) & (size > 0))
        if len(two):
            found.append(self._at_level(codes, sets_at, two, lower, np.minimum(self.differences(size), (1 << lower) * 4 // 5)))
        return np.concatenate([s for s, _ in found]), np.concatenate([r for _, r in found])

    def _at_level(self, codes: np.ndarray, sets_at: np.ndarray, rows: np.ndarray, level: np.ndarray, differences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(sets_at)[rows]
        parts = 1 << level[rows]
        first = np.cumsum(parts) - parts
        at = np.repeat(sets_at[:-1][rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        element = codes[at]
        which = np.repeat(np.arange(len(rows)), size)
        part = (element & (parts[which] - 1).astype(np.uint64)).astype(np.int64)
        key = first[which] + part
        total = int(parts.sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, key, mix(element ^ np.uint64(0x5851F42D4C957F2D)))
        counts = np.bincount(key, minlength=total)
        owner = np.repeat(np.arange(len(rows)), parts)
        # Of P parts at least P - D agree, so the P - D - 1 smallest need not be sent. A bound on their size is
        # the same for equal parts, so what one set leaves out of the agreeing parts, the stricter of both does.
        allowed = parts - differences[rows] - 1
        order = np.lexsort((counts, owner))
        sorted_counts = counts[order]
        bound = np.full(len(rows), -1, np.int64)
        some = allowed > 0
        # The size of the first part past the allowed ones: strictly smaller parts may go.
        bound[:] = sorted_counts[first + np.minimum(np.maximum(allowed, 0), parts - 1)]
        keep = counts >= bound[owner]
        short = (bound == 0) | ~some & (np.minimum.reduceat(counts, first) == 0) if len(rows) else np.empty(0, bool)
        keep &= counts > 0
        index = np.flatnonzero(keep)
        salt = (level[rows][owner[index]].astype(np.uint64) << np.uint64(32)) + (index - first[owner[index]]).astype(np.uint64)
        signature = mix(sums[index] + mix(salt + np.uint64(1)) + counts[index].astype(np.uint64))
        rows_found = [rows[owner[index]]]
        found = [signature]
        # Where too many parts are empty, agreement may lie in those only; then both sets are like that, and the
        # first elements in the order of codes must meet.
        for r in np.flatnonzero(short):
            n = int(size[r])
            prefix = codes[sets_at[rows[r]] : sets_at[rows[r]] + n - (-(-n * self.num // self.den)) + 1]
            found.append(mix(prefix ^ np.uint64(0x94D049BB133111EB)))
            rows_found.append(np.full(len(prefix), rows[r]))
        return np.concatenate(found), np.concatenate(rows_found)


class _Chunk:
    """The sets of a chunk's documents that stand for their equals."""

    def __init__(self, left: pa.Table, right: pa.Table, n: int, threshold: Fraction):
        left = left.sort_by("key")
        ids = left.column("key").to_numpy()
        kinds, numbers = right.column("kind").to_pylist(), right.column("number").to_pylist()
        out = {i for k, i in zip(kinds, numbers) if k == COPY}
        self.replies = sorted((i, p) for k, i, p in zip(kinds, numbers, right.column("payload").to_pylist()) if k == REPLY)
        keep = [i for i, x in enumerate(ids.tolist()) if x not in out]
        keep = [i for j, i in enumerate(keep) if j == 0 or ids[i] != ids[keep[j - 1]]]
        self.ids = ids[keep]
        data, at = text_bytes(left.column("text").combine_chunks().take(pa.array(keep, pa.int64())))
        self.codes, self.at = shingle_sets(data, at, n)
        signatures, rows = Parts(threshold).signatures(self.codes, self.at)
        order = np.lexsort((rows, signatures))
        self.signatures, self.rows = signatures[order] >> np.uint64(16), rows[order]
        order = np.lexsort((self.rows, self.signatures))
        self.signatures, self.rows = self.signatures[order], self.rows[order]
        self.first = np.flatnonzero(np.concatenate([[True], self.signatures[1:] != self.signatures[:-1]])) if len(order) else np.empty(0, np.int64)
        self.different = self.signatures[self.first]
        self.counts = np.diff(np.append(self.first, len(self.signatures)))
        self.least = self.ids[self.rows[self.first]] if len(self.first) else np.empty(0, np.int64)  # rows ascend by id


def _ask(n: int, threshold: Fraction, shards: int) -> Callable:
    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _rows(_SENT, [])
        chunk = left.column("chunk")[0].as_py()
        own = _Chunk(left, right, n, threshold)
        rows = []
        for shard, run in _by_shard(_shards_of(own.different << np.uint64(16), shards)):
            short = own.different[run].view(np.uint8).reshape(-1, 8)[:, :6].ravel()
            rows.append((shard, chunk, pack_arrays(short, own.least[run], own.counts[run].astype(np.int32))))
        return _rows(_SENT, rows)

    return ask


def _met(table: pa.Table) -> pa.Table:
    parts = [unpack_arrays(p) for p in table.column("payload").to_pylist()]
    codes = np.zeros((sum(len(p[1]) for p in parts), 8), np.uint8)
    codes[:, :6] = np.concatenate([p[0] for p in parts]).reshape(-1, 6)
    codes = codes.reshape(-1).view(np.uint64)
    least, counts = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    order = np.lexsort((least, codes))
    first = np.flatnonzero(np.concatenate([[True], codes[order][1:] != codes[order][:-1]]))
    size = np.diff(np.append(first, len(codes)))
    met, pivot, total = np.zeros(len(codes), bool), np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
    met[order] = np.repeat(size > 1, size)
    pivot[order] = np.repeat(least[order][first], size)
    total[order] = np.repeat(np.add.reduceat(counts[order].astype(np.int64), first), size)
    shard = table.column("shard")[0].as_py()
    rows, at = [], 0
    for chunk, part in zip(table.column("chunk").to_pylist(), parts):
        mine = slice(at, at + len(part[1]))
        at = mine.stop
        told = met[mine]
        if told.any():
            rows.append((chunk, REPLY, shard, pack_arrays(np.packbits(told), pivot[mine][told], total[mine][told])))
    return _rows(_BACK, rows)


def _send(n: int, threshold: Fraction, shards: int) -> Callable:
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _rows(_MEMBER, [])
        own = _Chunk(left, right, n, threshold)
        pivot, total = own.least.copy(), own.counts.astype(np.int64)
        runs = dict(_by_shard(_shards_of(own.different << np.uint64(16), shards)))
        for shard, payload in own.replies:
            bits, pivots, totals = unpack_arrays(payload)
            run = runs[shard]
            told = run.start + np.flatnonzero(np.unpackbits(bits, count=run.stop - run.start))
            pivot[told], total[told] = pivots, totals
        live = np.repeat(total > 1, own.counts)
        row = own.rows[live]
        pivot, salts = np.repeat(pivot, own.counts)[live], -(-np.repeat(total, own.counts)[live] // REGION)
        order = np.lexsort((-salts, pivot, row))
        row, pivot, salts = row[order], pivot[order], salts[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (pivot[1:] != pivot[:-1])
        rows = []
        for r, p, s in zip(row[new].tolist(), pivot[new].tolist(), salts[new].tolist()):
            doc = int(own.ids[r])
            codes = own.codes[own.at[r] : own.at[r + 1]].tobytes()
            if doc == p:
                rows += [(p, salt, s, doc, codes) for salt in range(s)]
            else:
                rows.append((p, int(mix(np.array([doc], np.int64).view(np.uint64))[0] % np.uint64(s)), s, doc, codes))
        return _rows(_MEMBER, rows)

    return send


class Region:
    """The sets of some documents, and exact links between them."""

    def __init__(self, docs: list[int], sets: list[bytes], threshold: Fraction):
        self.docs, self.sets = docs, [np.frombuffer(s, np.uint64) for s in sets]
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.flat = np.concatenate(self.sets) if self.sets else np.empty(0, np.uint64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.num, self.den = threshold.numerator, threshold.denominator
        owner = np.repeat(np.arange(len(docs)), self.size)
        classes = (self.flat >> np.uint64(58)).astype(np.int64)
        self.classes = np.bincount(owner * CLASSES + classes, minlength=len(docs) * CLASSES).reshape(len(docs), CLASSES).astype(np.int32)

    def shared(self, codes: np.ndarray) -> np.ndarray:
        """The number of elements each set has in common with an ascending one."""
        spot = np.minimum(np.searchsorted(codes, self.flat), len(codes) - 1)
        total = np.zeros(len(self.flat) + 1, np.int64)
        np.cumsum(codes[spot] == self.flat, out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]

    def linked(self, shared: np.ndarray, size: int) -> np.ndarray:
        return self.den * shared >= self.num * (self.size + size - shared)

    def gap(self, shared: np.ndarray, size: int) -> np.ndarray:
        return 1.0 - shared / (self.size + size - shared)

    def near(self, classes: np.ndarray, size: int, gap: float, gaps: np.ndarray) -> np.ndarray:
        """The documents in the window of one: linked at most those."""
        slack = 1.0 - self.num / self.den + 1e-9
        # |x - y| <= (1 - J) |x + y| <= (1 - J) / J times the smaller size.
        most = np.minimum(self.size, size) * (self.den - self.num) // self.num
        some = np.flatnonzero((np.abs(gaps - gap) <= slack) & (np.abs(self.size - size) <= most))
        return some[np.abs(self.classes[some] - classes).sum(axis=1) <= most[some]]

    def links_of(self, codes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        found = []
        for c in candidates.tolist():
            shared = len(np.intersect1d(self.sets[c], codes, assume_unique=True))
            if self.den * shared >= self.num * (len(codes) + len(self.sets[c]) - shared):
                found.append(c)
        return np.array(found, np.int64)


def _join_region(table: pa.Table, threshold: Fraction) -> pa.Table:
    """Links inside one salt of a region: to the pivot first, then of what is farther, by pivots of its own."""
    pivot, salt = table.column("pivot")[0].as_py(), table.column("salt")[0].as_py()
    docs = table.column("doc").to_pylist()
    region = Region(docs, table.column("codes").to_pylist(), threshold)
    salts = max(table.column("salts").to_pylist())
    centre = region.sets[docs.index(pivot)]
    shared = region.shared(centre)
    home, gaps = region.linked(shared, len(centre)), region.gap(shared, len(centre))
    rows = [(EDGE, pivot, salt, salts, pivot, docs[i], None, None) for i in np.flatnonzero(home).tolist() if docs[i] != pivot]
    group = np.where(home, -1, np.arange(len(docs)))  # who is known to be connected
    for y in np.flatnonzero(~home).tolist():
        near = region.near(region.classes[y], int(region.size[y]), gaps[y], gaps)
        near = near[group[near] != group[y]]
        for x in region.links_of(region.sets[y], near).tolist():
            if group[x] != group[y]:
                rows.append((EDGE, pivot, salt, salts, docs[x], docs[y], None, None))
                group[group == group[y]] = group[x]
        if salts > 1:
            rows.append((FAR, pivot, salt, salts, docs[y], None, float(gaps[y]), region.sets[y].tobytes()))
    return _found(rows)


def _found(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.binary()]
    columns = list(zip(*rows)) if rows else [()] * 8
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in _FOUND.split(", ")])


def _join_far(left: pa.Table, right: pa.Table, threshold: Fraction) -> pa.Table:
    """Links between one salt's documents and a block of those replicated from other salts."""
    rows = []
    if left.num_rows and right.num_rows:
        docs = left.column("doc").to_pylist()
        pivot = left.column("pivot")[0].as_py()
        region = Region(docs, left.column("codes").to_pylist(), threshold)
        centre = region.sets[docs.index(pivot)]
        shared = region.shared(centre)
        home, gaps = region.linked(shared, len(centre)), region.gap(shared, len(centre))
        far = Region(right.column("a").to_pylist(), right.column("codes").to_pylist(), threshold)
        for j, gap in enumerate(right.column("gap").to_pylist()):
            near = region.near(far.classes[j], int(far.size[j]), gap, gaps)
            # One link to what is connected through the pivot is enough.
            inner, outer = near[home[near]], near[~home[near]]
            for x in inner.tolist():
                if len(region.links_of(far.sets[j], np.array([x]))):
                    rows.append((EDGE, pivot, 0, 0, docs[x], far.docs[j], None, None))
                    break
            rows += [(EDGE, pivot, 0, 0, docs[x], far.docs[j], None, None) for x in region.links_of(far.sets[j], outer).tolist() if docs[x] < far.docs[j]]
    return _found(rows)


def jaccard_components(df: DataFrame, n: int = SHINGLE, threshold: Fraction = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", rows: bool = False) -> DataFrame:
    """Per document: the size of its set of ``n``-word shingles and the least id reachable by links.

    Two documents link when the Jaccard similarity of their sets is the threshold or more. A text of
    fewer words has its whole sequence as its one shingle; without words (a null or empty text) the
    set is empty and links with nothing. A row is known by its id and text: unlike texts under one id, or
    without an id, are documents of their own, and equal rows are one, each with its result. A component
    is null where none of its documents has an id. An empty table gives none. ``rows`` adds ``mark``
    (``row_mark`` of the row) and ``stays``: true for one row of each component, the one with the least id.
    """
    docs = id_and_text(df, id_col, text_col).withColumn("mark", row_mark())
    spark = docs.sparkSession
    folder = scratch_dir(spark, "jaccard")
    set_digests(docs, n).write.parquet(f"{folder}/digests")
    digests = spark.read.schema(_DIGESTS).parquet(f"{folder}/digests")
    ids = digests.groupBy("doc_id").agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    ids.where(f"low < high AND doc_id < {APART}").select("doc_id").write.parquet(f"{folder}/repeated")
    repeated = spark.read.schema("doc_id long").parquet(f"{folder}/repeated")
    repeated = None if repeated.isEmpty() else repeated
    digests = row_key(repeated, digests)
    # Without a set a document stands for itself. Equal sets: the least key stands for all.
    sets = ["n_shingles", "digest_a", "digest_b"]
    first = digests.where("n_shingles > 0").groupBy(*sets).agg(F.min("key").alias("first"), F.max("key").alias("last")).where("last > first")
    first = first.select(*sets, "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = digests.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    equal = salted.join(first, [*sets, "salt"]).where("key > first").groupBy("key").agg(F.min("first").alias("first"))
    equal.write.parquet(f"{folder}/equal")
    equal = spark.read.schema("key long, first long").parquet(f"{folder}/equal")

    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // CHUNK_BYTES))
    shards = max(1, chunks // 4)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunk = F.pmod(F.xxhash64("key"), F.lit(chunks)).alias("chunk")
    dealt = row_key(repeated, docs).select(chunk, "key", "text").repartition(partitions, "chunk")
    copies = equal.select(chunk, F.lit(COPY).alias("kind"), F.col("key").alias("number"), F.lit(None).cast("binary").alias("payload"))
    sent = dealt.groupBy("chunk").cogroup(copies.groupBy("chunk")).applyInArrow(tidy(_ask(n, threshold, shards)), _SENT)
    met = sent.groupBy("shard").applyInArrow(tidy(_met), _BACK)
    members = dealt.groupBy("chunk").cogroup(copies.unionAll(met).groupBy("chunk")).applyInArrow(tidy(_send(n, threshold, shards)), _MEMBER)
    members.write.parquet(f"{folder}/members")
    members = spark.read.schema(_MEMBER).parquet(f"{folder}/members")

    joined = members.groupBy("pivot", "salt").applyInArrow(tidy(lambda table: _join_region(table, threshold)), _FOUND)
    joined.write.parquet(f"{folder}/joined")
    joined = spark.read.schema(_FOUND).parquet(f"{folder}/joined")
    far = joined.where(F.col("kind") == FAR)
    hot = far.groupBy("pivot").agg(F.max("salts").alias("all_salts"), F.count(F.lit(1)).alias("n_far"))
    hot, small = measured(hot.withColumn("blocks", F.ceil(F.col("n_far") / BLOCK).cast("int")).drop("n_far"), "hot-regions")
    # A hot region has over REGION documents, so there are few; sets of all other regions stay where they are.
    of_hot = members if small else maybe_members(members, hot, "pivot")
    hot = F.broadcast(hot) if small else hot
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block")
    replicated = far.join(hot, "pivot").select("pivot", spread("all_salts").alias("to"), F.col("salt").alias("own"), block, "a", "gap", "codes").where("own <> to")
    held = of_hot.join(hot, "pivot").select("pivot", F.col("salt").alias("to"), spread("blocks").alias("block"), "doc", "codes")
    key = ["pivot", "to", "block"]
    crossed = held.groupBy(*key).cogroup(replicated.select(*key, "a", "gap", "codes").groupBy(*key)).applyInArrow(tidy(lambda left, right: _join_far(left, right, threshold)), _FOUND)
    edges = joined.where(F.col("kind") == EDGE).select("a", "b").unionAll(crossed.select("a", "b"))
    labels = components(edges).withColumnRenamed("node", "first")
    placed = digests.join(equal, "key", "left").select("doc_id", "mark", "key", "n_shingles", F.coalesce("first", "key").alias("first"))
    placed = placed.join(labels, "first", "left").withColumn("least", F.coalesce("component", "first"))
    component, stays = F.when(F.col("least") < APART, F.col("least")), F.col("key") == F.col("least")
    if not digests.where(F.col("key") >= APART).isEmpty():
        # A row with a key of its own may have its component's least id.
        known = placed.where(F.col("key") >= APART).groupBy("least").agg(F.min(F.struct("doc_id", "mark")).alias("known"))
        placed = placed.join(known, "least", "left")
        known_id = F.col("known.doc_id")
        component = F.least(component, F.when(known_id != NO_ID, known_id))  # nulls are skipped
        by_known = known_id.isNotNull() & ((F.col("least") >= APART) | (known_id < F.col("least")))
        stays = F.when(by_known, (F.col("doc_id") == known_id) & (F.col("mark") == F.col("known.mark"))).otherwise(stays)
    more = ["mark", stays.alias("stays")] if rows else []
    return with_doc_id(placed.select("doc_id", "n_shingles", component.alias("component_id"), *more), id_col)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word shingles and a similarity of 0.9."""
    return jaccard_components(documents(spark, sf_dir), 3, Fraction(9, 10))


ENTRIES = {"op3_ngram_jaccard_join": (op3_ngram_jaccard_join, oracle.OP3)}
