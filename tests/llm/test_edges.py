"""Empty tables, null ids, repeated rows, other column names; the index structures; language model; the pipeline."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pointferry.llm import anchors, components, decontam, fmdedup, jaccard, licenses, lmscore, packing, quality, secrets, suffixdedup, textkit, tokencount
from tests.conftest import SF_DIR
from tests.llm import brute


def contaminated(docs, **names):
    items = docs.sparkSession.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    return decontam.find_contamination(docs, items, **names)


def lm(docs, **names):
    own = docs.select(docs[names.get("id_col", "doc_id")].alias("doc_id"), F.coalesce(docs[names.get("text_col", "text")], F.lit("")).alias("text"))
    frequent = lmscore.frequent_words(own)
    return lmscore.score(docs, frequent, lmscore.train(own, frequent), **names)


OPERATORS = {
    "suffix": suffixdedup.remove_repeats, "packing": packing.pack_documents, "jaccard": jaccard.jaccard_components, "licenses": licenses.scan_licenses,
    "tokens": tokencount.count_tokens, "quality": quality.judge_documents, "contamination": contaminated, "windows": fmdedup.remove_repeated_windows,
    "secrets": secrets.scan_secrets, "lm": lm,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    empty = spark.createDataFrame([], brute.CLASHING)
    assert OPERATORS[name](empty).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_null_ids_repeats_and_other_names(spark, name):
    text = " ".join(f"word{i}" for i in range(70))
    rows = [(None, text, "x"), (None, None, None), (7, text, "x"), (7, text, "x"), (8, "", None), (9, None, "y")]
    docs = spark.createDataFrame(rows, "key int, body string, text string")
    got = OPERATORS[name](docs, id_col="key", text_col="body")
    assert "key" in got.columns and sorted((r["key"] is None, r["key"] or 0) for r in got.collect()) == [(False, 7), (False, 7), (False, 8), (False, 9), (True, 0), (True, 0)]


def test_only_nulls(spark):
    docs = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    for operator in OPERATORS.values():
        assert operator(docs).count() == 3


def test_fm_index_against_counting():
    r = np.random.default_rng(3)
    segments = [r.integers(1, 6, n) for n in (40, 1, 25, 60)]
    text = np.concatenate([np.append(s, 0) for s in segments])
    index = fmdedup.Index(text)
    assert sorted(index.suffixes) == list(range(len(text)))
    patterns = [text[i : i + n] for i, n in ((0, 3), (5, 7), (45, 2), (70, 5))] + [np.array([5, 5, 5, 5, 5, 5])]
    for p in patterns:
        length, low, high = fmdedup.matching_lengths(index, p, np.array([len(p)]), len(p))
        count = sum(list(text[i : i + len(p)]) == list(p) for i in range(len(text)))
        assert (int(high[0] - low[0]) == count) if length[0] == len(p) else count == 0


def test_suffix_buckets_against_sorting():
    r = np.random.default_rng(4)
    data = np.concatenate([r.integers(97, 99, 3000), np.full(400, 97), np.tile(r.integers(97, 123, 70), 9)]).astype(np.uint8)
    text = np.concatenate([data, np.zeros(200, np.uint8)])
    ranks, distances = suffixdedup.cover_ranks(text, len(data) + suffixdedup.PERIOD, 50), suffixdedup._distances()
    assert (distances >= 0).all()
    at = np.arange(0, len(data) - 50, 1)
    order = suffixdedup.sort_bucket(text, at, ranks, distances)
    keys = [text[i : i + 50].tobytes() for i in order]
    assert sorted(order) == list(at) and keys == sorted(keys)


def test_anchors_are_the_same_for_equal_windows():
    words = np.random.default_rng(1).integers(0, 50, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    codes = np.concatenate([words[:200], words[50:150], words[200:]])
    units = anchors.Units(np.array([1]), np.empty(0, np.uint8), np.array([0, 0]), codes, np.array([0, len(codes)]))
    seg = anchors.segments_of(units, 20, 6)
    anchor = {int(f + k): int(a) for f, n, a in zip(seg.first, seg.windows, seg.anchor) for k in range(n)}
    assert len(anchor) == len(codes) - 19 == seg.windows.sum()
    assert all(anchor[50 + i] == anchor[200 + i] for i in range(81))
    packed = anchors.unpack_arrays(anchors.pack_arrays(codes, np.arange(3, dtype=np.int32), np.empty(0, np.int64)))
    assert (packed[0] == codes).all() and packed[1].tolist() == [0, 1, 2] and len(packed[2]) == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (301, 300)]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 300, 301: 300}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_model_prefers_the_language_it_saw(spark):
    import random

    r = random.Random(2)
    subjects, verbs, objects = "cat dog bird fish".split(), "sees hears likes".split(), "milk bread corn water".split()
    sentence = lambda: f"the {r.choice(subjects)} {r.choice(verbs)} the {r.choice(objects)} ."
    seen = spark.createDataFrame([(i, " ".join(sentence() for _ in range(60))) for i in range(300)], "doc_id long, text string").repartition(2)
    frequent = lmscore.frequent_words(seen)
    rows = lmscore.train(seen, frequent, rounds=2, stride=2)
    held_out = [" ".join(sentence() for _ in range(60)) for _ in range(20)]
    shuffled = [" ".join(r.sample(t.split(), len(t.split()))) for t in held_out]
    docs = spark.createDataFrame(list(enumerate(held_out + shuffled)), "doc_id long, text string")
    score = {x["doc_id"]: x["mean_log_likelihood"] for x in lmscore.score(docs, frequent, rows).collect()}
    untrained = {x["doc_id"]: x["mean_log_likelihood"] for x in lmscore.score(docs, frequent, lmscore.Network.fresh()).collect()}
    assert min(score[i] for i in range(20)) > max(score[20 + i] for i in range(20))
    assert np.mean([score[i] for i in range(20)]) > np.mean([untrained[i] for i in range(20)]) + 2


def test_rounds_take_every_word_as_a_target_once():
    words_at = np.array([0, 3, 4, 4, 11, 112])
    taken = [lmscore.targets_of(words_at, r * lmscore.STRIDE // lmscore.ROUNDS, lmscore.STRIDE) for r in range(lmscore.ROUNDS)]
    assert sorted(np.concatenate(taken).tolist()) == list(range(112))


def test_language_model_learns_from_short_documents(spark):
    import random

    r = random.Random(4)
    sentence = lambda: f"the {r.choice(['cat', 'dog'])} {r.choice(['sees', 'hears'])} a {r.choice(['bird', 'fish'])}"
    seen = spark.createDataFrame([(i, sentence()) for i in range(3000)], "doc_id long, text string").repartition(300).coalesce(2)
    frequent = lmscore.frequent_words(seen)
    rows = lmscore.train(seen, frequent)
    docs = spark.createDataFrame([(1, "the cat sees a fish"), (2, "fish a the sees cat")], "doc_id long, text string")
    score = {x["doc_id"]: x["mean_log_likelihood"] for x in lmscore.score(docs, frequent, rows).collect()}
    assert score[1] > -3 and score[1] > score[2]


def test_language_model_tells_every_word_apart(spark):
    """Log-probabilities within classes against counting; words of one class differ, listed or spelled."""
    n = lmscore.OWN_CLASSES + 4 * lmscore.BUCKET_CLASSES
    listed = [f"word{i}" for i in range(n)]
    text = " ".join(" ".join([w] * (2 * n - i)) for i, w in enumerate(listed)) + " né rare rarer"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    frequent = lmscore.frequent_words(docs, n)
    known = lmscore.count_words(docs, frequent)
    classes = lmscore.Numbers(frequent).of(frequent)[1]
    counts = 2 * n - np.arange(n)
    want = [np.log(counts[i] / counts[classes == classes[i]].sum()) for i in range(n)]
    assert np.allclose(known.listed, want) and len(set(classes.tolist())) == lmscore._CLASSES - 1
    pairs = np.full((257, 257), lmscore.SMOOTHING)
    for w in ("né", "rare", "rarer"):
        for a, b in zip([256, *w.encode()], [*w.encode(), 256]):
            pairs[a, b] += 1
    spelled = lambda w: sum(np.log(pairs[a, b] / pairs[a].sum()) for a, b in zip([256, *w.encode()], [*w.encode(), 256]))
    same = [w for w, c in zip(listed, classes) if c == classes[n - 1]]
    variants = [f"word0 word1 {w} word2" for w in [*same, "né", "rare", "rarer", "neverseen"]]
    rows = lmscore.Network.fresh()
    scored = spark.createDataFrame(list(enumerate(variants)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["log_likelihood"] for r in lmscore.score(scored, frequent, rows, known=known).collect()}
    assert len(set(got.values())) == len(variants) > 5
    last = [got[len(same) + i] for i in range(4)]
    for i, w in enumerate(("rare", "rarer", "neverseen"), 1):  # neighbours see buckets, so only near
        assert abs(last[i] - last[0] - (spelled(w) - spelled("né"))) < 1


def test_frequent_words_are_counted_exactly(spark):
    docs = spark.createDataFrame([(1, "b a a c"), (2, "a c c c c")], "doc_id long, text string").repartition(2)
    data, at = lmscore.slices.__globals__["text_bytes"](__import__("pyarrow").array(["c a b"]))
    starts, ends, _ = lmscore.word_bounds(data, at, lmscore.SPACES)
    assert lmscore.frequent_words(docs).tolist() == lmscore.word_codes(data, starts, ends).tolist()


def test_pipeline_stages_on_hard_texts(spark, tmp_path):
    docs = brute.hard_table(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF_DIR)
        assert got.columns == columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema], name
        path = str(tmp_path / name.replace(" ", "-"))
        got.write.parquet(path)
        docs = spark.read.parquet(path)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count() > 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_on_an_empty_table(spark, name):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, SF_DIR).count() == 0


def test_pipeline_against_brute_force(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    rules = quality.LineRules()
    kept = []
    for d, t in docs:
        lines = t.split("\n")
        bad = {i for i, x in enumerate(lines) if brute.SPACED.search(x) and rules.failure(x, len(brute.SPACED.findall(x)))}
        lost = sum(len(brute.SPACED.findall(lines[i])) for i in bad)
        if not brute.quality_base(t)[-1] and lost <= rules.max_lost_share * len(brute.SPACED.findall(t)):
            kept.append((d, "\n".join(x for i, x in enumerate(lines) if i not in bad)))
    groups = brute.jaccard_groups(kept, 5, 4, 5)
    kept = [(d, t) for d, t in kept if groups[d][1] == d]
    hits = brute.contamination(kept, items)
    kept = {d: t for d, t in kept if not hits[d][-1]}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in rows} == kept.keys()
    from tests.llm.test_against_brute_force import check_packing

    secret = {d for d, t in kept.items() if brute.secret_base(t)[:3] != (0, 0, 0)}
    clean = {d: t for d, t in kept.items() if d not in secret}
    used, least = check_packing([r for r in rows if r["doc_id"] in kept], {d: secrets_removed(spark, d, t) if d in secret else t for d, t in kept.items()})
    assert clean and used <= 1.05 * least + 1


def secrets_removed(spark, doc_id, text):
    docs = spark.createDataFrame([(doc_id, text)], "doc_id long, text string")
    return secrets.scan_secrets(docs).select(secrets.redacted().alias("t")).first()["t"]


def unlike_texts():
    """Rows of which ids are null or repeated, with texts of their own and texts of others."""
    words = lambda a, n: " ".join(f"{a}{i}word" for i in range(n))
    one, two, three, four = words("a", 60), words("b", 60), words("c", 70), words("d", 64)
    return [
        (1, one), (None, one), (None, two), (2, one), (2, three), (2, three + " " + one), (3, four), (3, words("e", 30)), (None, four + " x"),
        (None, words("f", 40)), (4, words("f", 40)), (None, words("g", 90)), (None, words("g", 90) + " y"), (5, ""), (5, None), (None, None),
    ]


@pytest.mark.parametrize("chunk_bytes", [300, 1 << 22])
@pytest.mark.parametrize("unit", ["bytes", "words"])
def test_unlike_texts_under_null_and_repeated_ids_are_kept(spark, monkeypatch, chunk_bytes, unit):
    monkeypatch.setattr(anchors, "CHUNK_BYTES", chunk_bytes)
    rows = unlike_texts()
    within, n = unit == "words", 20 if unit == "words" else 50
    cut = [(brute.SPACED.findall(t or "") if within else (t or "").encode()) for _, t in rows]
    owner = lambda r, i: (float("inf") if rows[r][0] is None else rows[r][0], i if within else 0)
    first: dict = {}
    for r, u in enumerate(cut):
        for i in range(len(u) - n + 1):
            key = tuple(u[i : i + n])
            first[key] = min(first.get(key, owner(r, i)), owner(r, i))
    want = []
    for r, u in enumerate(cut):
        gone = {j for i in range(len(u) - n + 1) if first[tuple(u[i : i + n])] < owner(r, i) for j in range(i, i + n)}
        left = [x for j, x in enumerate(u) if j not in gone]
        want.append((rows[r][0], len(u), len(gone), brute.sha(" ".join(left)) if within else brute.sha(bytes(left))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = fmdedup.remove_repeated_windows(docs) if within else suffixdedup.remove_repeats(docs)
    got = [tuple(r) for r in got.select("doc_id", "n_words" if within else "n_bytes", "n_removed", "kept_sha256").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("region", [2, 256])
def test_near_duplicates_of_rows_with_null_and_repeated_ids(spark, monkeypatch, region):
    monkeypatch.setattr(jaccard, "REGION", region)
    rows = [*unlike_texts(), (1 << 62, "some text here"), ((1 << 62) + 5, "some text here")]
    groups = brute.jaccard_groups(list(enumerate(t for _, t in rows)), 5, 4, 5)
    least: dict = {}
    for r, (doc_id, _) in enumerate(rows):
        least.setdefault(groups[r][1], []).extend([] if doc_id is None else [doc_id])
    want = [(doc_id, groups[r][0], min(least[groups[r][1]], default=None)) for r, (doc_id, _) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.jaccard_components(docs, rows=True).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
    stay = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, SF_DIR).collect()
    kept = [rows.index((r["doc_id"], r["text"])) for r in stay]
    assert sorted(groups[r][1] for r in kept) == sorted({g for _, g in groups.values()})
    assert all(rows[r][0] == min(least[groups[r][1]], default=None) for r in kept)


def test_texts_of_very_many_secrets(spark):
    """Places and redaction over several blocks of matches, against brute force."""
    r = np.random.default_rng(9)
    hexes = ["".join(r.choice(list("0123456789abcdef"), 40)) for _ in range(700)]
    texts = [" é\n".join(hexes), " ".join(f"token={h}xyz é {h[:30]}AKIA{h[:20].upper()}" for h in hexes[:300]), "token=" + hexes[0], " ".join(hexes[:secrets.BLOCK])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secrets.scan_secrets(docs).withColumn("redacted", secrets.redacted()).collect():
        text = texts[row["doc_id"]]
        base = brute.secret_base(text)
        spans = row["spans"]
        listed = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if s["kind"] != "markov")
        assert (*(sum(s["kind"] == k for s in spans) for k in secrets.KINDS[:3]), brute.sha(listed)) == base[:4]
        out, at = [], 0
        for s in spans:
            if s["start"] >= at:
                out += [text[at : s["start"]], secrets.MARK]
            at = max(at, s["end"])
        assert row["redacted"] == "".join(out) + text[at:]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_unlike_long_words_are_told_apart(spark, n):
    one = thue_morse(n)
    other = one.translate(str.maketrans("ab", "ba"))
    common = [f"w{i}" for i in range(19)]
    texts = [" ".join([*common, one]), " ".join([*common, other])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["n_removed"] for r in fmdedup.remove_repeated_windows(docs).collect()] == [0, 0]
    assert by_component(jaccard.jaccard_components(docs, 20)) == {0: 0, 1: 1}
    items = spark.createDataFrame([(1, " ".join([*common[-9:], one]))], "item_id long, text string")
    assert {r["doc_id"]: len(r["hit_spans"]) for r in decontam.find_contamination(docs, items).collect()} == {0: 1, 1: 0}
    twice = spark.createDataFrame([(1, f"x y {one} x y {other}"), (2, f"x y {one} x y {one}")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_repeat_words"] for r in quality.judge_documents(twice).collect()} == {1: 0, 2: 6}


@pytest.mark.parametrize("n", [1024, 4096])
def test_unlike_long_texts_of_two_words_are_told_apart(spark, n):
    one = thue_morse(n)
    words = [" ".join(t) for t in (one, one.translate(str.maketrans("ab", "ba")))]
    docs = list(enumerate(words))
    want = brute.removed_words(docs)
    got = fmdedup.remove_repeated_windows(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()} == want


def by_component(df):
    return {r["doc_id"]: r["component_id"] for r in df.collect()}


def test_items_without_an_id_hit(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "nothing"), (3, "x y z")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "A b c d e f g h i j"), (None, "x y"), (4, "y z"), (None, None)], "item_id long, text string")
    for part_bytes in (5, 1 << 20):
        got = {r["doc_id"]: (r["items"], r["hit_spans"] != [], [m["item"] for m in r["near"]]) for r in decontam.find_contamination(docs, items, part_bytes=part_bytes).collect()}
        assert got == {1: ([None], True, [None]), 2: ([], False, []), 3: ([4, None], True, [4, None])}


def surrounded(n, seed=3):
    """Documents with one passage in surroundings of their own; a few have it twice, or share more than it."""
    import random

    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(2, 4)))
    passage = " ".join(f"p{i}assage" for i in range(30))
    texts = []
    for i in range(n):
        left, right = (" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(2))
        texts.append(f"{left} {passage} {right}" + (f" {passage} {left}" if i % 7 == 0 else ""))
    return texts + texts[:3]


@pytest.mark.parametrize("unit", ["bytes", "words"])
def test_windows_of_an_anchor_with_many_segments_are_split(spark, monkeypatch, unit):
    monkeypatch.setattr(anchors, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(anchors, "HOT", 5)
    rows = list(enumerate(surrounded(60)))
    within = unit == "words"
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = fmdedup.remove_repeated_windows(docs) if within else suffixdedup.remove_repeats(docs)
    want = brute.removed_words(rows) if within else brute.removed_bytes(rows)
    names = ["n_words", "n_removed"] if within else ["n_bytes", "n_removed", "n_spans"]
    assert {r["doc_id"]: (*(r[n] for n in names), r["kept_sha256"]) for r in got.collect()} == want


def test_a_passage_of_very_many_documents_makes_no_hot_shard(spark, monkeypatch):
    monkeypatch.setattr(anchors, "CHUNK_BYTES", 1 << 16)
    rows = [(i, t) for i, t in enumerate(surrounded(4000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def largest(hot):
        monkeypatch.setattr(anchors, "HOT", hot)
        job = anchors.RepeatedWindows(anchors.word_units, 20, 6, within=True, resolve=fmdedup.least_owners)
        n = job.sent(docs)[2].groupBy("shard").agg(F.sum(F.octet_length("payload")).alias("n")).toPandas()["n"]
        return n.max() / n.median(), len(n)

    whole, split = largest(1 << 30), largest(64)
    assert split[0] < 4 and split[0] < whole[0]


def test_a_plain_word_is_kept_once():
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    words = packing.WordIds(file)
    plain = [f"{a}{b}é" for a in ("straße", "ndin", "hÿort") for b in ("an", "bis", "corzu", "d" * 70)]
    text = " ".join(plain) + "\n" + " ".join(w.upper() + "!?" for w in plain) + "\tDon't état  µ ªº İx Ǆ 12a a12   " + " ".join(w + "." for w in plain)
    want = Tokenizer.from_file(file).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words.encode(text), "<u4").tolist() == want == np.frombuffer(words.encode(text), "<u4").tolist()
    kept = [key for cache in vars(words).values() if isinstance(cache, packing.Kept) for key in cache]
    assert all(kept.count(w) == (len(w) <= 64) for w in plain)


def test_codes_of_long_chunks_are_made_in_blocks():
    n = 5 * textkit.BLOCK + 77
    codes = textkit.mix(np.random.default_rng(3).integers(0, 9, n).astype(np.uint64))
    whole = np.array([sum(int(c) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(codes[a : a + 20])) % (1 << 64) for a in range(0, n - 19, 997)], np.uint64)
    least = np.lib.stride_tricks.sliding_window_view(codes, 31).min(1)
    for made, want in ((lambda: textkit.window_codes(codes, 20), None), (lambda: anchors.smallest_in_windows(codes, 31), least), (lambda: textkit.mix(codes), None)):
        made()  # tables that are kept
        tracemalloc.start()
        got = made()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert want is None or (got == want).all()
        assert peak < got.nbytes + 6 * 8 * (textkit.BLOCK + 100)  # the result, and a few blocks
    assert (textkit.window_codes(codes, 20)[::997] == textkit.mix(whole)).all()
    assert len(textkit.window_codes(codes[:19], 20)) == 0 == len(anchors.smallest_in_windows(codes[:30], 31))


def test_only_tied_suffixes_are_read_on(monkeypatch):
    data = np.random.default_rng(6).integers(97, 123, 20_000).astype(np.uint8)
    data[5_000:5_060] = data[9_000:9_060] = data[100:160]
    text = np.concatenate([data, np.zeros(200, np.uint8)])
    read, word = [], suffixdedup._word
    monkeypatch.setattr(suffixdedup, "_word", lambda text, at: read.append(len(at)) or word(text, at))
    order, new = suffixdedup.by_leading_bytes(text, np.arange(19_000), 50)
    keys = [text[i : i + 50].tobytes() for i in order]
    assert keys == sorted(keys) and new.tolist() == [True, *(a != b for a, b in zip(keys, keys[1:]))]
    assert (~new).sum() == 22 and sum(read) < 19_000 + 6 * 200


def test_segments_end_with_their_documents():
    texts = pa.array(["", "a" * 49, "b" * 50, "", "c" * 130 + "d" * 3, "e", "abc" * 40, "f" * 49, ""])
    units = anchors.byte_units(np.arange(len(texts)), texts)
    seg = anchors.segments_of(units, 50, 20)
    windows = [[] for _ in texts]
    for first, n, row in zip(seg.first.tolist(), seg.windows.tolist(), seg.row.tolist()):
        windows[row] += range(first - int(units.at[row]), first - int(units.at[row]) + n)
    assert windows == [list(range(max(0, len(t.as_py()) - 49))) for t in texts]
    assert len(anchors.segments_of(anchors.byte_units(np.arange(3), pa.array(["x" * 49, "", "y" * 30])), 50, 20).first) == 0
