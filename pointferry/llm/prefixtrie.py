"""A trie of conversations: every distinct run of first turns, with its members, children, leaves and savings.

A count-min sketch of prefix digests screens the turns: a cell that no other prefix touches proves a
prefix to be of one conversation alone, and then so is all that follows it; such tails are nodes as
they stand. Only prefixes that may be shared are shuffled and grouped, exactly, by their digests.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pointferry.llm.oracle import OP11
from pointferry.llm.ranks import changes, ranked, stored
from pointferry.llm.textkit import mix

MAX_HEAD = 5  # turns that a rebuilt conversation takes from another at most
BLOCK = 1024  # turns of a conversation that one task orders at a time
MIN_WIDTH, MAX_WIDTH = 1 << 12, 1 << 27  # cells of each of the sketch's two rows; at most 32 MB are broadcast
CELLS_A_ROW = 8
SKETCH_BLOCK = 1 << 18  # cells that one task merges
SKETCH_ROWS = 1 << 21  # prefixes that a partial sketch covers
HOT_NODES = 4096  # nodes that hold more than this share of all rows, so fewer than this number
TEXT_PIECE = 1 << 20  # characters of joined ids in one row
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def read_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns as conv_id, digest, chars and rank: a turn's place from 0 in its conversation.

    Turns stand by turn number, null first; equal numbers by the SHA-256 of role and text. A null
    role or text is empty. Rows without a conv_id belong to no conversation. Texts are read once
    and not shuffled; a conversation of any length is ranked by a sort over many tasks.
    """
    role, text = (F.coalesce(df[c], F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = df.select(df[conv_col].cast("long").alias("conv_id"), df[turn_col].alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    return ranked(stored(turns.where("conv_id IS NOT NULL"), "trie-turns"), ["conv_id"], ["turn", "digest"], "trie-ranks").drop("turn")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: their turns (conv_id, block, depth, digest, chars, len, n_own), and all of them (conv_id, len).

    The first h turns are those of conversation c - c % 100, h = crc32(c) % 6; c's own follow from
    place h. A conversation's facts meet its turns block by block, so a long one is no large group.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % (MAX_HEAD + 1)).cast("long")
    base = F.col("conv_id") - F.col("conv_id") % 100
    heads = turns.where(f"conv_id % 100 = 0 AND rank < {MAX_HEAD}").select(F.col("conv_id").alias("base"), "rank", "digest", "chars")
    n_base = heads.groupBy("base").agg(F.count(F.lit(1)).alias("n_base"))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own")).withColumn("h", h).withColumn("base", base)
    n_head = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(n_base, "base", "left").withColumn("n_head", n_head).withColumn("len", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "base", "h", "n_own", "n_head", "len"), "trie-conversations")
    columns = ["conv_id", "block", "depth", "digest", "chars", "len", "n_own"]
    taken = convs.where("n_head > 0").join(heads, "base").where("rank < h")
    taken = taken.withColumn("block", F.lit(0).cast("long")).withColumn("depth", F.col("rank") + 1).select(*columns)
    blocks = convs.where("n_own > h").withColumn("block", F.explode(F.expr(f"sequence(0L, (n_own - 1) div {BLOCK}L)")))
    kept = turns.where(F.col("rank") >= h).withColumn("block", F.expr(f"rank div {BLOCK}L")).join(blocks, ["conv_id", "block"])
    kept = kept.withColumn("depth", F.col("rank") - F.col("h") + F.col("n_head") + 1).select(*columns)
    return taken.unionByName(kept), convs


def running(df: DataFrame, made: dict[str, tuple], combine, backwards: bool = False) -> DataFrame:
    """Running values along every conversation, each row included: local to a block, then over the blocks before it.

    ``made`` maps a new column to an aggregate function and its column; ``combine`` puts two results
    together. Only conversations of more than a block (``n_own``) have anything to add.
    """
    depth, block = (F.col(c).desc() if backwards else F.col(c) for c in ("depth", "block"))
    near = Window.partitionBy("conv_id", "block").orderBy(depth).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.select("*", *[fn(c).over(near).alias(f"_{name}") for name, (fn, c) in made.items()])
    far = Window.partitionBy("conv_id").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.where(f"n_own > {BLOCK}").groupBy("conv_id", "block").agg(*[fn(c).alias(name) for name, (fn, c) in made.items()])
    before = totals.select("conv_id", "block", *[fn(name).over(far).alias(f"_far_{name}") for name, (fn, _) in made.items()])
    out = out.join(before, ["conv_id", "block"], "left")
    return out.select(*df.columns, *[combine(F.col(f"_{name}"), F.coalesce(F.col(f"_far_{name}"), F.lit(0))).alias(name) for name in made])


def prefix_digests(rebuilt: DataFrame) -> DataFrame:
    """Rebuilt turns with ``p1`` and ``p2``, 120 bits that stand for all turns up to this one.

    They are the exclusive or of SHA-256 digests of each turn with its place, which blocks of a
    conversation can be joined by. The digests are keyed by a random number of this run, so that no
    text can be made to collide; results do not depend on it.
    """
    one = F.sha2(F.concat_ws(":", F.lit(secrets.token_hex(16)), F.col("depth"), F.col("digest")), 256)
    lane = lambda at: F.conv(F.substring("_one", at, 15), 16, 10).cast("long")
    lanes = rebuilt.withColumn("_one", one).withColumn("_e1", lane(1)).withColumn("_e2", lane(16)).drop("_one", "digest")
    out = running(lanes, {"p1": (F.bit_xor, "_e1"), "p2": (F.bit_xor, "_e2")}, lambda a, b: a.bitwiseXOR(b))
    return stored(out.drop("_e1", "_e2"), "trie-prefixes")


def _cells(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A prefix's cell in each row of the sketch; rows follow each other."""
    one, two = (mix(batch.column(c).to_numpy().astype(np.uint64)) & np.uint64(width - 1) for c in ("p1", "p2"))
    return one.astype(np.int64), two.astype(np.int64) + width


def sketch(prefixes: DataFrame, width: int) -> np.ndarray:
    """One bit for each cell, in bytes: whether it was counted more than once.

    Partial sketches list the cells they touch; a block of cells is merged by one task, which takes
    the partial ones one after another. A count is never too low, so a cell counted once proves its prefix single.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.extend(_cells(batch, width))
            n += batch.num_rows
            if n >= SKETCH_ROWS:
                yield from _offer(held)
                held, n = [], 0
        yield from _offer(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, block = np.zeros(SKETCH_BLOCK, np.uint8), None
        for batch in batches:
            for b, cells, twice in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "twice"))):
                at = np.frombuffer(cells, np.uint32)
                more = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at))
                counts[at] = np.minimum(counts[at] + 1 + more, 2)
                block = b
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], names=["block", "bits"])

    merge.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    partials = prefixes.select("p1", "p2").mapInArrow(partial, "block long, cells binary, twice binary")
    merged = partials.groupBy("block").applyInArrow(merge, "block long, bits binary")
    bits = np.zeros(-(-2 * width // SKETCH_BLOCK) * SKETCH_BLOCK // 8, np.uint8)
    for r in merged.toLocalIterator():
        at = r["block"] * SKETCH_BLOCK // 8
        bits[at : at + SKETCH_BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _offer(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The cells touched, by block, and which of them more than once."""
    if not held:
        return
    cells, counts = np.unique(np.concatenate(held), return_counts=True)
    blocks = cells // SKETCH_BLOCK
    ends = np.flatnonzero(np.diff(blocks, append=-1)) + 1
    for first, last in zip([0, *ends[:-1]], ends):
        at = (cells[first:last] % SKETCH_BLOCK).astype(np.uint32)
        columns = [pa.array([int(blocks[first])], pa.int64()), pa.array([at.tobytes()], pa.binary()), pa.array([np.packbits(counts[first:last] > 1).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "cells", "twice"])


def screened(prefixes: DataFrame) -> DataFrame:
    """Prefixes with ``alone``, proven to be of one conversation, and ``after_alone``, whose prefix before it was seen to be so.

    What follows a proven prefix within a batch needs no proof of its own.
    """
    spark = prefixes.sparkSession
    n = prefixes.count()
    width = min(max(1 << (CELLS_A_ROW * n - 1).bit_length(), MIN_WIDTH), MAX_WIDTH)
    bits = spark.sparkContext.broadcast(sketch(prefixes, width).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(bits.value, np.uint8)
        last = (None, None, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            shared = np.ones(batch.num_rows, bool)
            for cells in _cells(batch, width):
                shared &= (twice[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
            conv, depth = batch.column("conv_id").to_numpy(), batch.column("depth").to_numpy()
            follows = np.zeros(batch.num_rows, bool)  # the row before holds the turn before
            follows[1:] = (conv[1:] == conv[:-1]) & (depth[1:] == depth[:-1] + 1)
            follows[0] = last[:2] == (conv[0], depth[0] - 1)
            proven = ~shared
            proven[0] |= follows[0] and last[2]
            starts = np.flatnonzero(~follows)
            # Within a run of neighbouring turns: proven from the first proven one on.
            order = np.where(proven, np.arange(len(proven)), -1)
            latest = np.maximum.accumulate(order)
            begin = np.zeros(len(proven), np.int64)
            begin[starts] = starts
            begin = np.maximum.accumulate(begin)
            alone = latest >= begin
            after = np.zeros(len(alone), bool)
            after[1:] = alone[:-1]
            after[0] = last[2]
            after &= follows
            last = (conv[-1], depth[-1], bool(alone[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alone), pa.array(after)], names=[*batch.schema.names, "alone", "after_alone"])

    schema = ", ".join(f"{c} {t}" for c, t in prefixes.dtypes) + ", alone boolean, after_alone boolean"
    return stored(prefixes.mapInArrow(run, schema), "trie-screened")  # once, so that every use sees the same proofs


def _meet(rows: DataFrame, nodes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with their node's columns; nodes of a large share of all rows, of which there are few, are broadcast."""
    n = rows.count()
    hot = nodes.where(F.col("n_convs") * HOT_NODES > n)
    found = rows.join(F.broadcast(hot.select(*keys, *columns)), keys)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(nodes.where(F.col("n_convs") * HOT_NODES <= n).select(*keys, *columns), keys)
    return found.unionByName(others)


def sha_of_lists(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """For every key, SHA-256 of its whole-number values in ascending order, joined by commas.

    Values are sorted by range over all tasks and packed into pieces of text; a digest then reads a
    key's pieces in order, one at a time, which SHA-256 leaves no way around.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = ", ".join(f"{c} {t}" for c, t in df.select(*keys).dtypes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(value).to_pylist()
            starts = np.union1d(np.flatnonzero(changes(batch, keys)), np.arange(0, len(values), TEXT_PIECE // 20))
            ends = [*starts[1:], len(values)]
            texts = [",".join(map(str, values[a:b])) for a, b in zip(starts, ends)]
            columns = [batch.column(c).take(pa.array(starts)) for c in [*keys, value]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*keys, value, "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[: len(keys)] != held:
                    if held is not None:
                        done.append((*held, state.hexdigest()))
                    held, state = row[: len(keys)], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(row[-1].encode())
            yield _rows(done, batch, keys, name)
        if held is not None:
            yield _rows([(*held, state.hexdigest())], batch, keys, name)

    pieces = df.select(*keys, value).repartitionByRange(parts, *keys, value).sortWithinPartitions(*keys, value)
    pieces = pieces.mapInArrow(pack, f"{kinds}, {value} long, piece string")
    in_order = pieces.repartition(parts, *keys).sortWithinPartitions(*keys, value).select(*keys, "piece")
    return in_order.mapInArrow(digest, f"{kinds}, {name} string")


def _rows(rows: list[tuple], like: pa.RecordBatch, keys: list[str], name: str) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], like.schema.field(c).type) for i, c in enumerate(keys)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([r[-1] for r in rows], pa.string())], names=[*keys, name])


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """All nodes of the trie of rebuilt conversations.

    A node is named by its smallest member and its depth, and parents by theirs. The root (depth 0)
    has no parent and no text. Repeated rows are turns each; a conversation without turns is a
    member of the root alone; an empty table has no nodes. Rows without a conv_id are left out.

    What a node sums over its subtree is summed along conversations instead: a node at or below it
    has its smallest member among the node's own members. So each member brings, from its depth on,
    the characters of turns where it is not the smallest, and the children but one of nodes where
    it is; one aggregate with map-side sums then gives saved tokens and leaves.
    """
    spark = df.sparkSession
    rebuilt, convs = rebuild(read_turns(df, conv_col, turn_col, role_col, text_col))
    prefixes = prefix_digests(rebuilt)
    facts = convs.agg(F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n")).first()
    if not facts["n"]:
        return spark.createDataFrame([], NODES)
    tested = screened(prefixes)
    maybe = stored(tested.where("NOT alone").drop("alone", "after_alone"), "trie-maybe-shared")

    by_digest = ["depth", "p1", "p2"]
    nodes = stored(maybe.groupBy(*by_digest).agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("len").alias("longest")), "trie-nodes")
    members = _meet(maybe, nodes, by_digest, ["rep"]).drop("p1", "p2")
    members = stored(members, "trie-members")

    # Nodes below other nodes; a parent that is not found is the same conversation's own.
    alone = tested.where("alone").select("conv_id", "depth", "len", "after_alone")
    own = members.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent"))
    below = nodes.where("depth > 1").select(F.col("rep").alias("conv_id"), "depth")
    first_alone = alone.where("depth > 1 AND NOT after_alone").select("conv_id", "depth")
    kids = stored(below.unionByName(first_alone).join(own, ["conv_id", "depth"], "left"), "trie-children")
    n_children = kids.where("parent IS NOT NULL").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    n_children = stored(n_children, "trie-child-counts")

    brought = members.join(n_children, ["conv_id", "depth"], "left")
    is_rep = F.col("conv_id") == F.col("rep")
    brought = brought.withColumn("brings_tokens", F.when(is_rep, 0).otherwise(F.col("chars")))
    brought = brought.withColumn("brings_leaves", F.when(is_rep, F.coalesce(F.col("n_children"), F.lit(1)) - 1).otherwise(0)).drop("n_children")
    summed = running(brought, {"tokens": (F.sum, "brings_tokens"), "leaves": (F.sum, "brings_leaves")}, lambda a, b: a + b, backwards=True)
    sums = summed.groupBy("rep", "depth").agg(F.sum("tokens").alias("saved_tokens"), (F.sum("leaves") + 1).alias("n_leaves"))

    turnless = convs.where("len = 0").select(F.lit(facts["low"]).alias("rep"), F.lit(0).cast("long").alias("depth"), "conv_id")
    ends = members.where("depth = len").select("rep", "depth", "conv_id").unionByName(turnless)
    ends = stored(sha_of_lists(ends, ["rep", "depth"], "conv_id", "ends_sha256"), "trie-ends")

    parents = kids.select(F.col("conv_id").alias("rep"), "depth", "parent")
    counts = n_children.withColumnRenamed("conv_id", "rep")
    shared = nodes.select("rep", "depth", "n_convs").join(sums, ["rep", "depth"]).join(counts, ["rep", "depth"], "left").join(parents, ["rep", "depth"], "left")
    parent = F.when(F.col("depth") == 1, F.lit(facts["low"])).otherwise(F.coalesce("parent", "rep"))
    shared = shared.withColumn("parent_conv_id", parent).withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    shared = stored(shared.drop("parent"), "trie-shared-nodes")

    top = shared.where("depth = 1").agg(F.count(F.lit(1)).alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
    alone_below = prefixes.where("depth = 1").count() - maybe.where("depth = 1").count()
    children = top["n"] + alone_below
    root = (facts["low"], 0, facts["n"], top["saved"] or 0, max(1, (top["leaves"] or 0) + alone_below), children, None)
    root = spark.createDataFrame([root], "rep long, depth long, n_convs long, saved_tokens long, n_leaves long, n_children long, parent_conv_id long")
    several = shared.unionByName(root).join(ends, ["rep", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
    several = several.withColumnRenamed("rep", "conv_id").select(*_names())

    return several.unionByName(_tails(alone, kids, facts["low"]))


def _names() -> list[str]:
    return [c.split()[0] for c in NODES.split(", ")]


def _tails(alone: DataFrame, kids: DataFrame, root: int) -> DataFrame:
    """Nodes of one conversation alone, as they stand but for the parent of a tail's first one."""
    last = F.col("depth") == F.col("len")
    made = lambda df, parent: df.select(
        "conv_id", "depth", F.when(F.col("depth") == 1, F.lit(root)).otherwise(parent).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY_SHA).alias("ends_sha256"),
    )
    within = made(alone.where("depth = 1 OR after_alone"), F.col("conv_id"))
    first = alone.where("depth > 1 AND NOT after_alone").join(kids, ["conv_id", "depth"], "left")
    return within.unionByName(made(first, F.coalesce("parent", "conv_id")))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie over all conversations."""
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ENTRIES = {"op11_conversation_prefix_trie": (op11_conversation_prefix_trie, OP11)}
