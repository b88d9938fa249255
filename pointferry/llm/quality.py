"""Line-first cleaning: rules judge every line, failing lines go, and a document that loses too much text goes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pointferry.llm.textkit import SPACES, counts_in_rows, documents, id_and_text, per_batch, row_of, slices, window_codes, with_doc_id, word_bounds, word_codes

MIN_WORDS = 50
MAX_REPEAT_SHARE = 0.5
_SPACE = " \t\n\v\f\r"
_WORD = re.compile("[^\\x20\\x09-\\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
COLUMNS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_bad_lines long, lost_share double, clean_text string"

# Fixed phrases of navigation and of boilerplate, in lower case.
NAVIGATION = (
    "home", "about us", "contact us", "site map", "sitemap", "log in", "login", "sign in", "sign up", "register", "subscribe", "next page",
    "previous page", "read more", "click here", "back to top", "skip to content", "menu", "search", "share this", "print this page",
)
BOILERPLATE = (
    "javascript", "cookie policy", "use cookies", "privacy policy", "terms of use", "terms of service", "all rights reserved", "lorem ipsum",
    "powered by", "subscribe to our newsletter", "enable cookies", "this site uses cookies",
)


@dataclass(frozen=True)
class LineRules:
    """What makes a line fail, and how much of a document's words may go with failing lines."""

    max_lost_share: float = 0.6
    max_symbol_share: float = 0.3
    min_letter_share: float = 0.4
    boilerplate_words: int = 15
    require_end_mark: bool = True
    navigation: tuple[str, ...] = field(default=NAVIGATION)
    boilerplate: tuple[str, ...] = field(default=BOILERPLATE)

    def failure(self, line: str, n_words: int) -> str | None:
        """The name of the first rule a line with words breaks."""
        marks = len(_SYMBOL.findall(line))
        if marks and marks > self.max_symbol_share * len(line.strip(_SPACE)):
            return "symbols"
        if not line.isascii():
            letters = sum(map(str.isalpha, line))
        else:
            letters = len(line) - len(line.translate(_NO_LETTERS))
        visible = len(line) - sum(map(line.count, _SPACE))
        if letters < self.min_letter_share * visible:
            return "letters"
        if n_words <= self.boilerplate_words:
            low = line.strip(_SPACE).lower()
            if low.rstrip(".!>: ") in self.navigation or ("|" in low and all(p.strip() in self.navigation for p in low.split("|"))):
                return "navigation"
            if any(p in low for p in self.boilerplate):
                return "boilerplate"
        if self.require_end_mark and line.rstrip(_SPACE)[-1:] not in _END_MARKS:
            return "end mark"
        return None


_END_MARKS = frozenset(".!?\"'”’»:;…)]。！？")
_NO_LETTERS = {c: None for c in [*range(0x41, 0x5B), *range(0x61, 0x7B)]}


def _repeat_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, code points in words, and words in repeated 3-word windows, of each text."""
    n_words, chars, repeats = [], [], []
    for _, _, data, at in slices(texts):
        starts, ends, words_at = word_bounds(data, at, SPACES)
        n_words.append(np.diff(words_at))
        chars.append(counts_in_rows(~SPACES[data] & ((data & 0xC0) != 0x80), at))
        codes = window_codes(word_codes(data, starts, ends), 3)
        rows = row_of(words_at)
        inside = np.flatnonzero(rows[: len(codes)] == rows[2:]) if len(codes) else np.empty(0, np.int64)
        # The row is folded into the code: windows are compared inside one text only.
        keys = codes[inside] + rows[inside].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = inside[order[twice]]
        flags = np.zeros(len(starts), bool)
        for k in range(3):
            flags[found + k] = True
        repeats.append(counts_in_rows(flags, words_at))
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return join(n_words), join(chars), join(repeats)


def _judge(text: str, rules: LineRules) -> tuple[int, int, int, float, str]:
    """Repeated lines, lines, failing lines, the share of words lost, and the text without failing lines."""
    lines = text.split("\n")
    seen: set[str] = set()
    repeated = n = bad = words = lost = 0
    kept = []
    for line in lines:
        n_words = len(_WORD.findall(line))
        if n_words:
            n += 1
            words += n_words
            repeated += line in seen
            seen.add(line)
            if rules.failure(line, n_words):
                bad += 1
                lost += n_words
                continue
        kept.append(line)
    return repeated, n, bad, lost / words if words else 0.0, "\n".join(kept)


def judge_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules | None = None, with_text: bool = True, carry: bool = False) -> DataFrame:
    """Per document: its counts, the verdict, and the text without failing lines.

    A null or empty text has no words, so it fails. A repeated row gives a repeated result; an
    empty table gives none. ``clean_text`` is null unless ``with_text``; ``carry`` adds ``rest``, the
    document's other columns. There is no shuffle.
    """
    rules = rules or LineRules()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text")
        n_words, chars, repeats = _repeat_words(texts)
        values = texts.to_pylist()
        symbols = [len(_SYMBOL.findall(t)) for t in values]
        judged = [_judge(t, rules) for t in values]
        failed = (n_words < MIN_WORDS) | (repeats > MAX_REPEAT_SHARE * n_words)
        share = np.array([j[3] for j in judged])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(chars, pa.int64()), pa.array(symbols, pa.int64()),
                pa.array([j[0] for j in judged], pa.int64()), pa.array(repeats, pa.int64()), pa.array(failed), pa.array(~failed & (share <= rules.max_lost_share)),
                pa.array([j[1] for j in judged], pa.int64()), pa.array([j[2] for j in judged], pa.int64()), pa.array(share),
                pa.array([j[4] for j in judged], pa.string()) if with_text else pa.nulls(len(judged), pa.string()),
                *([batch.column("rest")] if carry else []),
            ],
            names=[c.split()[0] for c in COLUMNS.split(", ")] + ["rest"] * carry,
        )

    docs = id_and_text(df, id_col, text_col, carry)
    schema = StructType.fromDDL(COLUMNS)
    if carry:
        schema = schema.add(docs.schema["rest"])
    return with_doc_id(docs.mapInArrow(per_batch(run), schema), id_col)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and verdict of the line rules for every document."""
    return judge_documents(documents(spark, sf_dir), with_text=False).drop("clean_text")


ENTRIES = {"op6_quality_rules": (op6_quality_rules, None)}
