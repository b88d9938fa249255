"""Secret scans with Spark's own functions: fixed patterns, and character Markov models for strings of unknown form.

A bigram model of random strings and one of ordinary identifiers give every long token a log-likelihood ratio per
character step; tokens above the threshold are secrets. Both models are counted by Spark from labelled samples.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointferry.llm.textkit import documents, id_and_text, with_doc_id

# Fixed patterns of the base kinds; letters of assignments in either case (ASCII).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
FIRST_CHAR, N_CHARS = 43, 80  # '+' to 'z', the characters of candidates
SAMPLE_DOCUMENTS = 1_000  # documents whose words are the sample of ordinary identifiers
SAMPLE_RANDOM = 20_000  # random strings of each alphabet in the other sample
THRESHOLD = 1.0  # log-likelihood ratio per step, in nats
PLAIN_THRESHOLD = 1.5  # of tokens without letters or with fewer than two digits, as ordinary identifiers are
MARK = "[SECRET]"
BLOCK = 128  # matches of a text that are placed or cut together


def _steps(tokens: DataFrame) -> DataFrame:
    """Counts of neighbouring characters, as number of the first times N_CHARS plus number of the second."""
    steps = tokens.select("label", "token", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i"))
    code = lambda i: F.ascii(F.substring("token", i, 1)) - FIRST_CHAR
    return steps.select("label", (code(F.col("i")) * N_CHARS + code(F.col("i") + 1)).alias("step")).groupBy("label", "step").agg(F.count(F.lit(1)).alias("n"))


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(label, token): 1 for random strings in hexadecimal and base 64, 0 for words and identifiers of documents.

    The bound is ``SAMPLE_DOCUMENTS`` documents, chosen by a hash of their id, and ``SAMPLE_RANDOM``
    strings per alphabet; the sample only fits the classifier.
    """
    spark = docs.sparkSession
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS).distinct()
    words = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select(F.explode(F.split("text", r"[^A-Za-z0-9+/_=-]+")).alias("token"))
    digest = F.sha2(F.concat(F.lit("random"), F.col("id").cast("string")), 256)
    dense = F.regexp_replace(F.base64(F.unhex(digest)), "[\r\n]", "")
    seeds = spark.range(0, SAMPLE_RANDOM, 1, 2)
    random = seeds.select(F.explode(F.array(F.substring(digest, 1, 40), dense, F.translate(F.upper(digest), "01", "YZ"))).alias("token"))
    both = random.select(F.lit(1).alias("label"), "token").unionAll(words.select(F.lit(0).alias("label"), "token"))
    return both.where(F.length("token") >= 2)


def ratios(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """The log-likelihood ratio of every step, from at most 2 x 6400 counts."""
    counts = [[smoothing] * (N_CHARS * N_CHARS) for _ in range(2)]
    for row in _steps(samples).where(F.col("step").between(0, N_CHARS * N_CHARS - 1)).collect():
        counts[row["label"]][row["step"]] += row["n"]
    logs = []
    for table in counts:
        totals = [sum(table[a * N_CHARS : (a + 1) * N_CHARS]) for a in range(N_CHARS)]
        logs.append([math.log(n / totals[i // N_CHARS]) for i, n in enumerate(table)])
    return [round(r - o, 5) for o, r in zip(*logs)]


def _found(df: DataFrame, text: str, pattern: str, name: str, group: int = 0, worth: Column | None = None) -> DataFrame:
    """Adds ``name``: an array of (start, end, value) of leftmost matches, by code points.

    The texts between the matches give the places: a split and an extraction by one pattern alternate.
    """
    none_s, none_l = F.array().cast("array<string>"), F.array().cast("array<struct<start:int,end:int,value:string>>")
    worth = F.col(text).rlike(pattern) if worth is None else worth
    df = df.withColumn("_worth", worth)
    df = df.withColumn("_hits", F.when(F.col("_worth"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none_s))
    df = df.withColumn("_values", F.when(F.col("_worth"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none_s) if group else F.col("_hits"))
    df = df.withColumn("_gaps", F.when(F.size("_hits") > 0, F.transform(F.split(text, pattern, -1), F.length)).otherwise(F.array().cast("array<int>")))
    # Places are running sums. They are taken over blocks first, so no array grows by one match at a time.
    long = lambda i: F.element_at("_gaps", i) + F.length(F.element_at("_hits", i))
    df = df.withColumn("_blocks", F.when(F.size("_hits") > 0, F.sequence(F.lit(1), F.size("_hits"), F.lit(BLOCK))).otherwise(F.array().cast("array<int>")))
    in_block = lambda first: F.sequence(first, F.least(first + BLOCK - 1, F.size("_hits")))
    df = df.withColumn("_sums", F.transform("_blocks", lambda first: F.aggregate(in_block(first), F.lit(0), lambda done, i: done + long(i))))
    none_i = F.array().cast("array<int>")
    df = df.withColumn("_at", F.aggregate("_sums", F.struct(F.lit(0).alias("at"), none_i.alias("out")), lambda done, n: F.struct((done["at"] + n).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")), lambda done: done["out"]))

    def place(done, i):
        begin = done["at"] + F.element_at("_gaps", i)
        end = begin + F.length(F.element_at("_hits", i))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), F.element_at("_values", i).alias("value")))).alias("out"))

    placed = F.transform("_blocks", lambda first, k: F.aggregate(in_block(first), F.struct(F.element_at("_at", k + 1).alias("at"), none_l.alias("out")), place, lambda done: done["out"]))
    return df.withColumn(name, F.when(F.size("_hits") > 0, F.flatten(placed)).otherwise(none_l)).drop("_worth", "_hits", "_values", "_gaps", "_blocks", "_sums", "_at")


def _overlaps(start: Column, end: Column, spans: str) -> Column:
    """Whether a range meets one of the spans, which are ordered and apart: a binary search for the first that ends after its start."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))

    def halve(at, _):
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        after = F.element_at(spans, F.least(middle, F.size(spans)))["end"] > start
        going = at["low"] < at["high"]
        return F.struct(F.when(going & ~after, middle + 1).otherwise(at["low"]).alias("low"), F.when(going & after, middle).otherwise(at["high"]).alias("high"))

    first = F.aggregate(steps, F.struct(F.lit(1).alias("low"), (F.size(spans) + 1).alias("high")), halve, lambda at: at["low"])
    meets = F.transform(F.array(first), lambda i: F.when(i <= F.size(spans), F.element_at(spans, F.least(i, F.size(spans)))["start"] < end).otherwise(F.lit(False)))
    return F.when(F.size(spans) == 0, F.lit(False)).otherwise(F.element_at(meets, 1))


def _ratio(token: Column, table: Column) -> Column:
    """The mean ratio over the steps of a token."""
    code = lambda i: F.ascii(F.substring(token, i, 1)) - FIRST_CHAR
    total = F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda s, i: s + F.element_at(table, code(i) * N_CHARS + code(i + F.lit(1)) + 1))
    return total / (F.length(token) - 1)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, plain_threshold: float = PLAIN_THRESHOLD, samples: DataFrame | None = None, carry: bool = False) -> DataFrame:
    """Per document: ``text`` and ``spans``, an array of (start, order, end, kind) in the order of places.

    Places are code points, the end is exclusive; ``order`` numbers the kinds. A null or empty text
    has no spans. Repeated rows give repeated results. A token that overlaps a base span is no
    further span; of all others the ratio decides, by ``plain_threshold`` for those without letters or
    with fewer than two digits. ``carry`` adds ``rest``, the document's other columns.
    """
    docs = id_and_text(df, id_col, text_col, carry)
    table = F.split(F.lit(",".join(map(str, ratios(samples if samples is not None else labelled_samples(docs))))), ",").cast("array<double>")
    found = _found(docs, "text", ASSIGN, "assign", 2)
    found = _found(found, "text", ACCESS, "access")
    # A run of fewer hexadecimal characters is no match of the longer pattern either; whole runs are taken in both.
    found = _found(found, "text", HEX.removesuffix("+") + f"{{{MIN_HEX},}}", "hex")
    found = _found(found, "text", CANDIDATE, "candidates")
    found = found.withColumn("assign", F.filter("assign", lambda m: F.length(m["value"]) >= MIN_VALUE))
    found = found.withColumn("access", F.filter("access", lambda m: F.length(m["value"]) >= MIN_ACCESS))

    def spans(name: str) -> Column:
        order = KINDS.index("markov" if name == "candidates" else name)
        return F.transform(name, lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(KINDS[order]).alias("kind")))

    found = found.withColumn("base", F.array_sort(F.concat(spans("assign"), spans("access"), spans("hex"))))
    mixed = lambda v: v.rlike("[0-9].*[0-9]") & v.rlike("[A-Za-z]")
    apart = lambda m: ~(_overlaps(m["start"], m["end"], "assign") | _overlaps(m["start"], m["end"], "access") | _overlaps(m["start"], m["end"], "hex"))
    least = lambda v: F.when(mixed(v), F.lit(threshold)).otherwise(F.lit(max(threshold, plain_threshold)))
    found = found.withColumn("candidates", F.filter("candidates", apart))
    found = found.withColumn("candidates", F.filter("candidates", lambda m: _ratio(m["value"], table) > least(m["value"])))
    found = found.withColumn("spans", F.array_sort(F.concat("base", spans("candidates"))))
    return with_doc_id(found.select("doc_id", "text", "spans", *["rest"] * carry), id_col)


def redacted(text: str = "text", spans: str = "spans", mark: str = MARK) -> Column:
    """The text with every maximal secret replaced by a mark.

    Spans are taken in blocks of ``BLOCK``, each with its own part of the text, and the pieces are joined once.
    """
    size = F.size(spans)
    upto = lambda first: F.least(first + BLOCK - 1, size)
    blocks = F.when(size > 0, F.sequence(F.lit(1), size, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    # (first span, where the block's text begins), for every block, and where the last one ends.
    farthest = lambda first, at: F.aggregate(F.slice(spans, first, BLOCK), at, lambda done, s: F.greatest(done, s["end"]))
    none_b, none_s = F.array().cast("array<struct<first:int,at:int>>"), F.array().cast("array<string>")
    begin = F.struct(F.lit(0).alias("at"), none_b.alias("out"))
    step = lambda done, first: F.struct(farthest(first, done["at"]).alias("at"), F.concat(done["out"], F.array(F.struct(first.alias("first"), done["at"].alias("at")))).alias("out"))
    starts = F.aggregate(blocks, begin, step)

    def pieces(block):
        part = F.substring(text, block["at"] + 1, F.greatest(F.element_at(spans, upto(block["first"]))["start"] - block["at"], F.lit(0)))

        def cut(done, s):
            fresh = s["start"] >= done["at"]
            before = F.substring(done["part"], done["at"] - block["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
            return F.struct(F.greatest(s["end"], done["at"]).alias("at"), done["part"].alias("part"), F.when(fresh, F.concat(done["out"], F.array(before, F.lit(mark)))).otherwise(done["out"]).alias("out"))

        return F.aggregate(F.slice(spans, block["first"], BLOCK), F.struct(block["at"].alias("at"), part.alias("part"), none_s.alias("out")), cut, lambda done: done["out"])

    whole = F.transform(F.array(starts), lambda found: F.concat_ws("", F.flatten(F.transform(found["out"], pieces)), F.substring(text, found["at"] + 1, F.length(text))))
    return F.when(size > 0, F.element_at(whole, 1)).otherwise(F.col(text))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and further spans of every document."""
    found = scan_secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


ENTRIES = {"op9_secret_scans": (op9_secret_scans, None)}
