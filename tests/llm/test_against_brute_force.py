"""Operators on hard texts and on the smallest tables, against plain versions of their contracts."""

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pointferry.llm import decontam, fmdedup, jaccard, licenses, packing, quality, secrets, suffixdedup, tokencount
from pointferry.llm.registry import ENTRIES
from tests.conftest import SF_DIR
from tests.llm import brute

TEXTS = brute.hard_texts()
DOCS = list(enumerate(TEXTS))


@pytest.fixture(scope="module")
def hard(spark):
    return brute.hard_table(spark).cache()


def by_id(df, *columns):
    rows = df.select("doc_id", *columns).collect()
    found = {r[0]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def sf_docs(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def test_suffix_dedup(hard):
    assert by_id(suffixdedup.remove_repeats(hard), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed_bytes(DOCS)


def test_suffix_dedup_query(spark):
    assert by_id(ENTRIES["op1_suffix_array_dedup"][0](spark, SF_DIR), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed_bytes(sf_docs(spark))


def test_window_dedup(hard):
    assert by_id(fmdedup.remove_repeated_windows(hard), "n_words", "n_removed", "kept_sha256") == brute.removed_words(DOCS)


def test_window_dedup_query(spark):
    assert by_id(ENTRIES["op8_substring_dedup"][0](spark, SF_DIR), "n_words", "n_removed", "kept_sha256") == brute.removed_words(sf_docs(spark))


@pytest.mark.parametrize("chunk_bytes", [2000, 1 << 22])
def test_dedup_does_not_depend_on_the_chunks(hard, monkeypatch, chunk_bytes):
    from pointferry.llm import anchors

    monkeypatch.setattr(anchors, "CHUNK_BYTES", chunk_bytes)
    some = hard.where(F.length("text") < 5000)
    few = [(d, t) for d, t in DOCS if t is not None and len(t) < 5000]
    assert by_id(suffixdedup.remove_repeats(some), "n_removed") == {d: v[1:2] for d, v in brute.removed_bytes(few).items()}
    assert by_id(fmdedup.remove_repeated_windows(some), "n_removed") == {d: v[1:2] for d, v in brute.removed_words(few).items()}


@pytest.mark.parametrize("n,threshold", [(3, Fraction(9, 10)), (5, Fraction(4, 5)), (1, Fraction(1, 2))])
def test_jaccard(hard, n, threshold):
    want = brute.jaccard_groups(DOCS, n, threshold.numerator, threshold.denominator)
    assert by_id(jaccard.jaccard_components(hard, n, threshold), "n_shingles", "component_id") == want


def test_jaccard_with_salted_regions(hard, monkeypatch):
    monkeypatch.setattr(jaccard, "REGION", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    want = brute.jaccard_groups(DOCS, 2, 4, 5)
    assert by_id(jaccard.jaccard_components(hard, 2, Fraction(4, 5)), "n_shingles", "component_id") == want


def test_jaccard_query(spark):
    got = by_id(ENTRIES["op3_ngram_jaccard_join"][0](spark, SF_DIR), "n_shingles", "component_id")
    assert got == brute.jaccard_groups(sf_docs(spark), 3, 9, 10)


def test_licenses(hard):
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    rows = licenses.scan_licenses(hard).select("doc_id", *columns, "labels", "score").collect()
    for r in rows:
        assert tuple(r[c] for c in columns) == brute.license_base(TEXTS[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert r["labels"] == ",".join(sorted(set(filter(None, r["labels"].split(","))))) and 0 <= r["score"] <= 1
    labels = {label for r in rows for label in r["labels"].split(",")}
    assert {"apache-2.0", "cc-by-4.0", "gpl-3.0-or-later", "reserved", "copyright"} <= labels


def test_license_rules_suppress_what_they_contain():
    signatures = licenses.Signatures()
    assert 200 < len(licenses.rules())
    found = licenses.detect("under the gnu lesser general public license version 2 1 or later and mit license", signatures)
    assert [f[0] for f in found] == ["lgpl-2.1-or-later", "mit"] and found[0][1:3] == (2, 10)


def test_quality(hard):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in quality.judge_documents(hard).collect():
        assert tuple(r[c] for c in columns) == brute.quality_base(TEXTS[r["doc_id"]]), TEXTS[r["doc_id"]]
        assert not (r["base_failed"] and r["kept"])


def test_quality_removes_failing_lines_and_keeps_clean_documents(spark):
    clean = "\n".join(" ".join(f"word{12 * i + k}" for k in range(12)) + "." for i in range(8))
    menu = clean + "\nHome | About us | Contact us\n### *** ### ***"
    junk = "\n".join("<%s> | # $ %% & * <%s>" % (i, i) for i in range(40))
    rows = {r["doc_id"]: r for r in quality.judge_documents(spark.createDataFrame([(1, clean), (2, menu), (3, junk)], "doc_id long, text string")).collect()}
    assert rows[1]["kept"] and rows[1]["clean_text"] == clean
    assert rows[2]["kept"] and rows[2]["clean_text"] == clean and rows[2]["n_bad_lines"] == 2
    assert not rows[3]["kept"]


ITEMS = [(1, " ".join(brute.ALNUM.findall(TEXTS[20])[:14])), (2, "W1, w2"), (3, None), (4, "..."), (10, TEXTS[21]), (11, TEXTS[21])]


@pytest.mark.parametrize("part_bytes", [1 << 24, 100])
def test_contamination(spark, hard, part_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontam.find_contamination(hard, items, part_bytes=part_bytes)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    shown = found.select("doc_id", "n_words", decontam.n_hit().alias("n_hit"), F.size("items").alias("n"), F.sha2(F.concat_ws(",", names), 256).alias("h"), (F.size("hit_spans") > 0).alias("c"))
    assert by_id(shown, "n_words", "n_hit", "n", "h", "c") == brute.contamination(DOCS, ITEMS)


def test_contamination_finds_a_reworded_passage(spark):
    item = "the quick brown fox jumps over a lazy dog near old stone bridges"
    text = "yes the quick brown fox leaps over a lazy dog near old stone bridges indeed"
    docs = spark.createDataFrame([(1, text), (2, "nothing of that kind at all here")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in decontam.find_contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert rows[1]["hit_spans"] == [] and rows[1]["n_near"] > 0 and rows[2]["n_near"] == 0


@pytest.mark.parametrize("part_bytes", [1 << 24, 100])
def test_proximity_matches_do_not_depend_on_neighbours(spark, part_bytes):
    """One slice holds all documents; a word that a reworded passage lacks stands in its neighbours."""
    item = "the quick brown fox jumps over a lazy dog near old stone bridges"
    text = "yes the quick brown fox leaps over a lazy dog near old old stone bridges indeed"
    texts = [text, "jumps", "jumps " * 9 + text, "one jumps and stone bridges", "", item]
    items = [(1, item), (2, "quick brown fox over dog"), (3, "stone bridges")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = decontam.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"), part_bytes=part_bytes)
    rows = {r["doc_id"]: r for r in found.collect()}
    for d, t in enumerate(texts):
        words, want = t.split(), set()
        for i, body in items:
            terms = body.split()
            n = min(len(terms), decontam.WINDOW)
            for phrase in (terms[k : k + n] for k in range(len(terms) - n + 1)):
                for at in range(len(words) - n + 1):
                    near = [w in words[max(0, at + p - decontam.NEAR_SLACK) : at + p + decontam.NEAR_SLACK + 1] for p, w in enumerate(phrase)]
                    if 10 * sum(near) >= 8 * n and any(words[at + p] == w for p, w in enumerate(phrase)):
                        want.add((i, at, n))
        assert [tuple(x) for x in rows[d]["near"]] == sorted(want)
        assert rows[d]["n_near"] == len({at for _, at, _ in want})
    assert rows[0]["n_near"] > 0


def test_proximity_search_tests_few_places(monkeypatch):
    """Most places of a phrase's rarest terms are left out before their starts are tried; no match is."""
    r, share, slack = random.Random(5), decontam.NEAR_SHARE, decontam.NEAR_SLACK
    vocabulary = [f"w{i}" for i in range(100)]
    items = [[r.choice(vocabulary) for _ in range(n)] for n in (40, 40, 13, 10, 4, 1)]
    texts = [[r.choice(vocabulary) for _ in range(300)] for _ in range(20)]
    for k, text in enumerate(texts):
        source = list(items[k % 4])
        source[r.randrange(len(source))] = "other"
        if k % 3:
            source.insert(r.randrange(len(source)), "more")
        texts[k] = text[: 40 * (k % 8)] + source + text[40 * (k % 8) :]
    made = decontam.phrases_of(list(range(len(items))), [" ".join(x) for x in items])
    codes, words_at = decontam._words(*decontam.text_bytes(pa.array([" ".join(x) for x in texts])))
    index = decontam.Index(codes, words_at, made.vocabulary)
    tried = []
    inside = decontam.Index._inside
    monkeypatch.setattr(decontam.Index, "_inside", lambda self, start, length: (tried.append(len(start)), inside(self, start, length))[1])
    got, listed = set(), 0
    for phrases in made.phrases:
        phrase, start = index.near(phrases, slack, share)
        row = index.row_of[start]
        got |= set(zip(phrases.items[phrase].tolist(), row.tolist(), (start - words_at[row]).tolist()))
        counts = np.sort(index.counts[phrases.terms], axis=1)
        listed += counts[:, : phrases.length - int(np.ceil(share * phrases.length - 1e-9)) + 1].sum()
    want = set()
    for i, item in enumerate(items):
        n = min(len(item), decontam.WINDOW)
        for phrase in (item[k : k + n] for k in range(len(item) - n + 1)):
            for d, words in enumerate(texts):
                for at in range(len(words) - n + 1):
                    near = [w in words[max(0, at + p - slack) : at + p + slack + 1] for p, w in enumerate(phrase)]
                    if 10 * sum(near) >= 8 * n and any(words[at + p] == w for p, w in enumerate(phrase)):
                        want.add((i, d, at))
    assert got == want and len(want) > 50
    assert sum(tried) < listed, (sum(tried), listed)


def test_contamination_query(spark):
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = by_id(ENTRIES["op7_benchmark_decontamination"][0](spark, SF_DIR), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination(sf_docs(spark), items)


def test_secrets(hard):
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind))
    samples = secrets.labelled_samples(hard.sparkSession.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text"))
    found = secrets.scan_secrets(hard, samples=samples)
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    shown = found.select("doc_id", *(count(k).alias(k) for k in secrets.KINDS[:3]), F.sha2(secrets._listed(base), 256).alias("h"))
    assert by_id(shown, *secrets.KINDS[:3], "h") == {d: brute.secret_base(t) for d, t in DOCS}
    rows = {r["doc_id"]: r for r in found.withColumn("clean", secrets.redacted()).collect()}
    key = next(d for d, t in DOCS if t and "sk_live" in t)
    assert "markov" in [s["kind"] for s in rows[key]["spans"]] and "9aZ4bQ7xT1mK8vR2pL5wD0cF" not in rows[key]["clean"]
    for d, t in DOCS:
        assert rows[d]["spans"] or rows[d]["clean"] == (t or "")


def test_secret_models_on_held_out_strings(spark):
    import hashlib

    random = [hashlib.sha256(f"held out {i}".encode()).hexdigest()[:32] for i in range(60)] + [__import__("base64").b64encode(hashlib.sha256(f"b {i}".encode()).digest()).decode() for i in range(60)]
    plain = ["get_document_by_identifier_2024_v2", "spark_sql_shuffle_partitions_200_x2", "InternationalOrganization2020and2021", "the-quick-brown-fox-jumps-over-12-34", "chapter_12_section_34_introduction"]
    rows = [(i, f"value {t} end") for i, t in enumerate(random + plain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    english = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(["user_name file_path document_identifier the_quick_brown_fox configuration international organization section chapter introduction partition shuffle internal get by over jumps"] * 200)], "doc_id long, text string")
    samples = secrets.labelled_samples(words.select("doc_id", "text").unionAll(english))
    found = {r["doc_id"] for r in secrets.scan_secrets(docs, samples=samples).where(F.size("spans") > 0).collect()}
    assert len([i for i in range(120) if i in found]) >= 114
    assert not [i for i in range(120, len(rows)) if i in found]


def test_secret_models_on_short_tokens_and_letters_only(spark):
    import random
    import string

    r = random.Random(11)
    alphabets = [string.ascii_letters + string.digits + "+/", string.ascii_letters]
    random_tokens = ["".join(r.choices(a, k=n)) for a in alphabets for n in (20, 22, 24) for _ in range(60)]
    plain = ["get_document_by_identifier_version", "spark_sql_shuffle_partitions", "InternationalOrganizationForStandards", "the-quick-brown-fox-jumps-over", "AbstractSingletonProxyFactoryBean", "-" * 30, "=" * 30, "_" * 30, "src/main/java/org/apache/spark", "12345678901234567890", "Donaudampfschifffahrtsgesellschaft"]
    docs = spark.createDataFrame([(i, f"value {t} end") for i, t in enumerate(random_tokens + plain)], "doc_id long, text string")
    # The next larger table has as many documents as a sample takes; 200 documents make a poorer model.
    large = spark.read.parquet(f"{SF_DIR}/../sf0.01/documents.parquet").select("doc_id", "text")
    assert large.count() == secrets.SAMPLE_DOCUMENTS
    samples = secrets.labelled_samples(large)
    found = {x["doc_id"] for x in secrets.scan_secrets(docs, samples=samples).where(F.size("spans") > 0).collect()}
    for part in range(2):
        assert sum(i in found for i in range(180 * part, 180 * (part + 1))) >= 171
    assert not [plain[i - 360] for i in found if i >= 360]


def test_secret_scan_is_native(hard):
    plan = secrets.scan_secrets(hard)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_token_counts(hard):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: (len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for d, t in DOCS}
    assert by_id(tokencount.count_tokens(hard), "n_bytes", "n_tokens", "over_limit") == want


def check_packing(rows, texts, capacity=4096):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == texts.keys()
    for d, t in texts.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[d], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in own] == [(i, i * capacity, min(capacity, len(ids) - i * capacity)) for i in range(-(-len(ids) // capacity))]
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    return len(places), -(-total // capacity)


def test_packing(hard):
    used, least = check_packing(packing.pack_documents(hard).collect(), dict(DOCS))
    assert used <= least + 1


def test_packing_query(spark):
    used, least = check_packing(ENTRIES["op2_best_fit_packing"][0](spark, SF_DIR).collect(), dict(sf_docs(spark)))
    assert used <= 1.02 * least + 1


def test_packing_gives_its_ids_back(spark):
    docs = spark.createDataFrame([(1, "one two three " * 2000), (2, "four")], "doc_id long, text string")
    rows = packing.pack_documents(docs, with_ids=True).orderBy("doc_id", "piece").collect()
    assert [len(r["ids"]) for r in rows] == [r["length"] for r in rows] and rows[-1]["ids"][-1] == 1


@pytest.mark.parametrize("counts", [{}, {4096: 3}, {1: 10000}, {2048: 5, 2049: 3, 1024: 9, 7: 1000}, {n: n % 5 + 1 for n in range(1, 4097, 13)}])
def test_best_fit_places_everything_once(counts):
    used: dict = {}
    for size, a, b, first, each, offset in packing.best_fit(counts, 4096):
        for rank in range(a, b):
            used.setdefault(first + (rank - a) // each, []).append((offset + (rank - a) % each * size, size))
    assert sum(map(len, used.values())) == sum(counts.values())
    for place in used.values():
        at = 0
        for offset, size in sorted(place):
            assert offset == at
            at += size
        assert at <= 4096
    total = sum(n * c for n, c in counts.items())
    assert len(used) <= 1.1 * total / 4096 + 2
