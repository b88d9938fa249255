"""A Merkle manifest of a table: digests of rows, runs and trees, with proofs from every row to the root.

Nodes are nested-interval labels: each carries the interval of leaf ranks it covers. An ancestor of
a node is found by containment, within the bucket of ranks that its level fixes; a node's siblings
are its parent's interval without its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointferry.llm.oracle import OP12
from pointferry.llm.ranks import ranked, stored
from pointferry.llm.textkit import documents

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The only node of its level in its tree: a run of one child that begins at rank 0.
_LONE = "size(children) = 1 AND children[0].lo = 0"
_STEPS = "array<struct<before:array<string>,after:array<string>>>"


def row_digest(fields: list[Column]) -> Column:
    """SHA-256 of values in their order; a null is ``-``, any other value stands behind its UTF-8 length."""
    parts = []
    for value in fields:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _joined(digests: Column) -> Column:
    return F.sha2(F.concat_ws("", digests), 256)


@dataclass
class Tree:
    """Runs of nodes by level, for any number of trees.

    ``levels[l]`` holds a row per run of level-l nodes: tree, lo, hi, children (lo, hi, digest), and
    ``lone``, true where the run is a tree's only node of that level, which ends that tree.
    """

    levels: list[DataFrame]
    fan: int

    def tops(self) -> DataFrame:
        """What remains of every tree: tree, level, lo, hi, digest."""
        found = [
            runs.where("lone").select("tree", F.lit(level).alias("level"), "lo", "hi", F.col("children")[0]["digest"].alias("digest"))
            for level, runs in enumerate(self.levels)
        ]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    def nodes(self) -> DataFrame:
        """All nodes: tree, level (leaves are 0), lo, hi (exclusive), digest."""
        found = [
            runs.select("tree", F.lit(level).alias("level"), F.explode("children").alias("c")).select("tree", "level", "c.lo", "c.hi", "c.digest")
            for level, runs in enumerate(self.levels)
        ]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    def paths(self, tops: DataFrame) -> DataFrame:
        """Runs of leaves with ``above``: the steps from the run's own node to the root.

        ``tops`` gives each tree's top (tree, level, lo, hi), the steps above it, and what it passes on
        (subroot). Ancestors are attached from the top down, a level at a time, by containment in
        buckets of ranks; a parent has at most ``fan`` runs below it, so no key is large.
        """
        passed = ["above", "subroot"]
        above = None
        for level in reversed(range(len(self.levels))):
            ends = tops.where(F.col("level") == level).select(
                "tree", "lo", "hi", F.lit(True).alias("is_top"), F.lit(None).cast("array<struct<lo:bigint,hi:bigint,digest:string>>").alias("children"), *passed
            )
            parents = ends if above is None else ends.unionByName(above.withColumn("is_top", F.expr(_LONE)))
            runs = self.levels[level]
            above = _under(runs.select("tree", "lo", "hi", "children"), parents, self.fan ** (level + 2)).select("tree", "lo", "hi", "children", *passed)
        return above


def _siblings(children: Column, lo: Column, hi: Column) -> Column:
    """The parent's interval without the node's own, in two parts."""
    before = F.transform(F.filter(children, lambda c: c["hi"] <= lo), lambda c: c["digest"])
    after = F.transform(F.filter(children, lambda c: c["lo"] >= hi), lambda c: c["digest"])
    return F.struct(before.alias("before"), after.alias("after"))


def _under(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """Nodes with the steps above them: their parent's, after their own step unless they are a tree's top."""
    n = nodes.select("*", F.expr(f"lo div {width}").alias("_bucket")).alias("n")
    p = parents.select("*", F.expr(f"lo div {width}").alias("_bucket")).alias("p")
    inside = (F.col("n.tree") == F.col("p.tree")) & (F.col("n._bucket") == F.col("p._bucket")) & (F.col("p.lo") <= F.col("n.lo")) & (F.col("n.hi") <= F.col("p.hi"))
    step = F.array(_siblings(F.col("p.children"), F.col("n.lo"), F.col("n.hi")))
    above = F.when(F.col("p.is_top"), F.col("p.above")).otherwise(F.concat(step, F.col("p.above")))
    return n.join(p, inside).select(*[F.col(f"n.{c}") for c in nodes.columns], above.alias("above"), F.col("p.subroot").alias("subroot"))


def build_trees(leaves: DataFrame, label: str, fan: int = FAN) -> Tree:
    """Trees over leaves (tree, rank, digest); ranks of a tree are 0 to n - 1.

    One job a level, each an ``fan``-th of the one before; a group is a run of at most ``fan``
    nodes. A tree stops when its only node of a level is found to stand alone.
    """
    below = leaves.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest")
    levels: list[DataFrame] = []
    while True:
        width = fan ** (len(levels) + 1)
        children = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        runs = below.groupBy("tree", F.expr(f"lo div {width}").alias("run")).agg(children.alias("children"))
        runs = runs.select("tree", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"), "children")
        levels.append(stored(runs.withColumn("lone", F.expr(_LONE)), f"{label}-{len(levels)}"))
        nodes = levels[-1].where("NOT lone")
        if nodes.isEmpty():
            return Tree(levels, fan)
        below = nodes.select("tree", "lo", "hi", _joined(F.col("children")["digest"]).alias("digest"))


@dataclass
class Manifest:
    """Leaves (tree, rank, digest and what was carried), the trees over them, and the tree over their tops."""

    leaves: DataFrame
    trees: Tree
    top: Tree
    tops: DataFrame
    root: str | None

    def proofs(self) -> DataFrame:
        """Every leaf with ``steps``, the siblings before and after it by level up to the root, and its subroot."""
        at_root = self.top.tops().select("tree", "level", "lo", "hi", F.array().cast(_STEPS).alias("above"), F.lit(self.root).alias("subroot"))
        own = self.tops.select(F.lit("").alias("tree"), F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), F.struct("tree", "level", "lo", "hi", "digest").alias("own"))
        tops = _leaf_steps(own, self.top.paths(at_root), self.top.fan)
        tops = tops.select("own.tree", "own.level", "own.lo", "own.hi", "above", F.col("own.digest").alias("subroot"))
        leaves = self.leaves.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank") + 1)
        return _leaf_steps(leaves, self.trees.paths(tops), self.trees.fan).drop("lo", "hi").withColumnRenamed("above", "steps")


def _leaf_steps(leaves: DataFrame, runs: DataFrame, fan: int) -> DataFrame:
    """Leaves with their steps; a run of one leaf that is its whole tree adds none."""
    return _under(leaves, runs.withColumn("is_top", F.expr(_LONE)), fan)


def build_manifest(
    df: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", fields: tuple[str, ...] = FIELDS, altered: dict[str, Column] | None = None, fan: int = FAN
) -> Manifest:
    """Digests of all rows, a tree for each value of ``tree_col``, and a tree over those trees.

    A row is a leaf; nulls and empty texts have digests of their own, and rows that are repeated are
    leaves each. Leaves stand by id, null first; rows with the same id by digest. Rows with a null in
    ``tree_col`` are a tree. Texts are read once, and only digests are shuffled. Leaves carry
    ``altered_digest``, of the row with some columns put in place of its own (the row's own digest by
    default). An empty table has no leaves and no root.
    """
    tree = F.coalesce(F.concat(F.lit("="), df[tree_col].cast("string")), F.lit("-"))  # null sorts first
    plain = row_digest([df[c] for c in fields])
    changed = row_digest([(altered or {}).get(c, df[c]) for c in fields])
    own = df.select(tree.alias("tree"), df[id_col].alias("id"), plain.alias("digest"), changed.alias("altered_digest"))
    leaves = ranked(stored(own, "merkle-leaves"), ["tree"], ["id", "digest"], "merkle-ranks")
    trees = build_trees(leaves, "merkle-trees", fan)
    tops = ranked(trees.tops(), [], ["tree"], "merkle-tops")
    top = build_trees(tops.select(F.lit("").alias("tree"), "rank", "digest"), "merkle-top", fan)
    found = top.tops().select("digest").first()
    return Manifest(leaves, trees, top, tops, found["digest"] if found else None)


def proof_digest(steps: Column) -> Column:
    """SHA-256 of all siblings, level by level to the root, each level from left to right."""
    return _joined(F.flatten(F.transform(steps, lambda s: F.concat(s["before"], s["after"]))))


def folded(digest: Column, steps: Column) -> Column:
    """The root that a leaf's digest gives with its siblings."""
    return F.aggregate(steps, digest, lambda acc, s: _joined(F.concat(s["before"], F.array(acc), s["after"])))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and root, and whether the root still follows from it after tampering."""
    docs = documents(spark, sf_dir)
    tampered = F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 3 == 0, F.lit(False))
    text = F.when(tampered, F.translate(docs["text"], UPPER, LOWER)).otherwise(docs["text"])
    manifest = build_manifest(docs, altered={"text": text})
    proofs = manifest.proofs()
    root = F.lit(manifest.root).cast("string")
    folded_root = folded(F.col("altered_digest"), F.col("steps"))
    out = proofs.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof_digest(F.col("steps")).alias("proof_sha256"), folded_root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ENTRIES = {"op12_merkle_manifest": (op12_merkle_manifest, OP12)}
