"""Conversation trie, Merkle manifest and byte-pair coding against plain versions, the library, and round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pointferry.llm import bpecodec, merkle, prefixtrie, ranks
from pointferry.llm.registry import ENTRIES
from tests.conftest import SF_DIR
from tests.llm import brute

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, source string, lang string, n_chars long, text string"
TRIE_COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
MANIFEST_COLUMNS = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


def _trie(spark, rows):
    got = prefixtrie.conversation_trie(spark.createDataFrame(rows, TURNS).repartition(3)).select(*TRIE_COLUMNS).collect()
    assert len({tuple(r) for r in got}) == len(got)
    return {tuple(r) for r in got}


def _conversations(seed: int, n: int) -> list[tuple]:
    """Conversations that share first turns, some with the same number or none; ids with gaps, so that some find no turns to take."""
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-120, 500), n):
        turns = [r.choice("abc") * r.randrange(1, 3) for _ in range(r.randrange(1, 9))]
        for i, text in enumerate(turns):
            rows.append((c, r.choice([i, i, i, None, 2]), r.choice(["user", "bot", None]) if i > 2 else "user", text if r.random() < 0.9 else r.choice([None, ""])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 3)
    monkeypatch.setattr(prefixtrie, "HOT_NODES", 20)
    rows = _conversations(seed, 150)
    assert _trie(spark, rows) == brute.trie(rows)


def test_trie_with_a_sketch_that_proves_little(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "MIN_WIDTH", 64)
    monkeypatch.setattr(prefixtrie, "MAX_WIDTH", 64)
    rows = _conversations(3, 120)
    assert _trie(spark, rows) == brute.trie(rows)


def test_trie_of_one_long_conversation_and_its_copies(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 64)
    long = [(c, i, "user", f"turn {i % 50} {'x' if i == 900 and c == 705 else ''}") for c in (700, 705, 711) for i in range(1000)]
    rows = long + [(c, 0, "user", "turn 0 ") for c in range(800, 1400)]
    assert _trie(spark, rows) == brute.trie(rows)


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = ENTRIES["op11_conversation_prefix_trie"][0](spark, SF_DIR)
    assert {tuple(r) for r in got.select(*TRIE_COLUMNS).collect()} == brute.trie(rows)


def test_trie_edges(spark):
    assert prefixtrie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert _trie(spark, [(None, 1, "user", "x")]) == set()
    rows = [(None, 1, "user", "x"), (100, None, None, None), (5, 1, "user", "é" * 40000), (5, 1, "user", "é" * 40000), (9, 1, "user", "y")]
    assert _trie(spark, rows) == brute.trie(rows)
    clashing = spark.createDataFrame([(1, 0, "u", "a", 3, 4)], "c long, t int, r string, x string, depth long, conv_id long")
    assert prefixtrie.conversation_trie(clashing, "c", "t", "r", "x").count() == len(brute.trie([(1, 0, "u", "a")]))


def test_sketch_proves_only_what_is_single(spark):
    rows = [(i, 0, 1, i % 700, (i % 700) * 7919, 1, 1, 1) for i in range(1000)]
    prefixes = spark.createDataFrame(rows, "conv_id long, block long, depth long, p1 long, p2 long, chars long, len long, n_own long").repartition(4)
    tested = prefixtrie.screened(prefixes)
    alone = {r["p1"] for r in tested.where("alone").collect()}
    assert alone <= set(range(300, 700)) and len(alone) > 350


def test_digest_of_lists_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "TEXT_PIECE", 200)
    rows = [("a", i) for i in range(500, -500, -1)] + [(None, 7), ("b", 1)]
    got = prefixtrie.sha_of_lists(spark.createDataFrame(rows, "k string, v long").repartition(5), ["k"], "v", "sha")
    assert {tuple(r) for r in got.collect()} == {("a", brute.sha(",".join(map(str, range(-499, 501))))), (None, brute.sha("7")), ("b", brute.sha("1"))}


def test_ranks_over_many_partitions(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "a", "a", "b", None, "c"]), r.randrange(50)) for _ in range(900)]
    got = ranks.ranked(spark.createDataFrame(rows, "g string, v long").repartition(6), ["g"], ["v"], "test").collect()
    for g in {"a", "b", "c", None}:
        mine = sorted((x["rank"], x["v"]) for x in got if x["g"] == g)
        assert [k for k, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for h, v in rows if h == g)


def _documents(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    return [
        (r.choice([i, i, i, None, 4]), r.choice(["web", None, ""]), r.choice(["de", "de", "de", "de", "fr", None, "é", "z"]), r.choice([i, None]), r.choice([f"Text {i} ÄB", None, "", "Same TEXT"]))
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [0, 1, 9, 65, 600])
def test_manifest_against_brute_force(spark, tmp_path, n):
    rows = _documents(n, n)
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = merkle.op12_merkle_manifest(spark, str(tmp_path)).select(*MANIFEST_COLUMNS)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute.merkle(rows)))


def test_manifest_of_many_trees(spark):
    rows = [(i, "s", f"l{i % 77}" if i % 5 else None, 1, "t") for i in range(300)]
    got = merkle.build_manifest(spark.createDataFrame(rows, DOCS))
    assert got.root == brute.merkle(rows)[0][3]
    nodes = got.trees.nodes()
    assert nodes.where("level = 0").count() == 300 and nodes.where("hi <= lo").count() == 0
    proved = got.proofs().select(merkle.folded(F.col("digest"), F.col("steps")).alias("root")).distinct().collect()
    assert [r[0] for r in proved] == [got.root]


def test_manifest_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "x", 5, 6, "a"), (2, "y", 5, 6, "a")], "key int, body string, digest long, rank long, tree string")
    got = merkle.build_manifest(df, "key", "tree", ("key", "body"))
    assert got.leaves.count() == 2 and got.proofs().count() == 2


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(bpecodec._path(bpecodec.VOCABULARY))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _coded(df, **names):
    return bpecodec.decode(bpecodec.encode(df, **names))


def test_bpe_against_the_library(spark, library):
    r = random.Random(6)
    letters = [chr(c) for c in range(1, 0x250)] + [chr(c) for c in (0x558, 0x88F, 0x3000, 0x2028, 0x85, 0xA0, 0x1F600, 0x4E00, 0x660, 0xB2, 0x10940, 0x301, 0xFEFF)]
    letters += ["'s", "'ll", "'S", "  ", "\n\n", " \n", "aaaa", " the", "<|endoftext|>", "<|endof", "text|>"]
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 777, "é" * 999, "x " * 1000 + "\r\n\t  y", "<|endoftext|>" * 3, "", *[t for t in brute.hard_texts() if t]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    decoded = library.decode_batch(want, skip_special_tokens=False)
    for row in _coded(docs).collect():
        assert row["ids"] == want[row["doc_id"]] and row["n_tokens"] == len(row["ids"]), texts[row["doc_id"]]
        assert row["decoded"] == decoded[row["doc_id"]]


def test_bpe_when_nothing_is_kept(monkeypatch, library):
    monkeypatch.setattr(bpecodec, "MAX_KNOWN", 5)
    encoder = bpecodec.Encoder(bpecodec._path(bpecodec.VOCABULARY))
    texts = [t for t in brute.hard_texts() if t]
    for t in texts:
        ids, at = encoder.encode([t, ""])
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids and at.tolist() == [0, len(ids), len(ids)]


def test_bpe_query_against_the_library(spark, library):
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    for r in ENTRIES["op13_bpe_codec"][0](spark, SF_DIR).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        want = (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids, skip_special_tokens=False)))
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want


def test_bpe_edges(spark):
    assert _coded(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, None, 1), ("k", "Hello  world", 2), ("k", "Hello  world", 2), ("e", "", 3)]
    got = _coded(spark.createDataFrame(rows, "key string, body string, ids int"), id_col="key", text_col="body").collect()
    assert sorted((r["key"] or "", r["n_tokens"], r["decoded"]) for r in got) == [("", 0, ""), ("e", 0, ""), ("k", 3, "Hello  world"), ("k", 3, "Hello  world")]
    lists = spark.createDataFrame([(1, None), (2, []), (3, [15496, -4, 99999, 50256]), (4, [128, 72])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in bpecodec.decode(lists).collect()} == {1: None, 2: "", 3: "Hello<|endoftext|>", 4: by_library(128, 72)}


def by_library(*ids):
    return Tokenizer.from_file(bpecodec._path(bpecodec.VOCABULARY)).decode(list(ids), skip_special_tokens=False)


def test_ragged():
    assert bpecodec.ragged(np.array([5, 9, 2, 7]), np.array([2, 0, 3, 1])).tolist() == [5, 6, 2, 3, 4, 7]
    assert bpecodec.ragged(np.array([3]), np.array([0])).tolist() == []
