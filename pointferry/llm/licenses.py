"""License detection by ordered signature rules: a keyword prefilter opens regular expressions, overlaps go by priority.

A text becomes its lower-case words joined by one space, so a signature is written over words. Of detections whose word
intervals lie one inside the other, the one with the higher priority stays; intervals that only touch or cross both stay.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pointferry.llm.textkit import NOT_ALNUM, documents, id_and_text, small_batches, with_doc_id

COLUMNS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,first_word:long,n_words:long,priority:int>>"
)
# Every byte that is no word byte becomes a space; capitals become small.
_TO_WORDS = bytes(0x20 if NOT_ALNUM[b] and not 0x41 <= b <= 0x5A else (b + 32 if 0x41 <= b <= 0x5A else b) for b in range(256))

# Fixed phrases and their labels: the base detections, one per place.
BASE = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))


@dataclass(frozen=True)
class Rule:
    """A signature over lower-case words: it is only tried on texts that hold its keyword."""

    priority: int
    label: str
    keyword: str
    pattern: str


# Names of license families, hand-written: label, keyword, pattern of the name, known versions.
_VERSIONED = (
    ("apache", "apache", r"apache (?:software )?licen[sc]e", "1.0 1.1 2.0"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", "1.0 2.0 3.0"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public licen[sc]e", "2.1 3.0"),
    ("lgpl", "library general", r"(?:gnu )?library general public licen[sc]e", "2.0"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", "1.0 3.0"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", "1.1 1.2 1.3"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "1.0 1.1 2.0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", "1.0 2.0"),
    ("cpl", "common public", r"common public licen[sc]e", "1.0"),
    ("cddl", "common development", r"common development and distribution licen[sc]e", "1.0 1.1"),
    ("eupl", "european union public", r"european union public licen[sc]e", "1.0 1.1 1.2"),
    ("ofl", "sil open font", r"sil open font licen[sc]e", "1.0 1.1"),
    ("artistic", "artistic", r"artistic licen[sc]e", "1.0 2.0"),
    ("afl", "academic free", r"academic free licen[sc]e", "1.1 1.2 2.0 2.1 3.0"),
    ("osl", "open software", r"open software licen[sc]e", "1.0 1.1 2.0 2.1 3.0"),
    ("apsl", "apple public", r"apple public source licen[sc]e", "1.0 1.1 1.2 2.0"),
    ("bsl", "boost", r"boost software licen[sc]e", "1.0"),
    ("cecill", "cecill", r"cecill(?: free software licen[sc]e)?", "1.0 1.1 2.0 2.1"),
    ("ecl", "educational community", r"educational community licen[sc]e", "1.0 2.0"),
    ("efl", "eiffel forum", r"eiffel forum licen[sc]e", "1.0 2.0"),
    ("lppl", "latex project", r"latex project public licen[sc]e", "1.0 1.1 1.2 1.3"),
    ("oclc", "oclc research", r"oclc research public licen[sc]e", "2.0"),
    ("php", "php", r"php licen[sc]e", "3.0 3.01"),
    ("psf", "python software", r"python software foundation licen[sc]e", "2.0"),
    ("qpl", "q public", r"q public licen[sc]e", "1.0"),
    ("rpsl", "realnetworks", r"realnetworks public source licen[sc]e", "1.0"),
    ("rpl", "reciprocal public", r"reciprocal public licen[sc]e", "1.1 1.5"),
    ("sissl", "sun industry", r"sun industry standards source licen[sc]e", "1.1 1.2"),
    ("spl", "sun public", r"sun public licen[sc]e", "1.0"),
    ("zpl", "zope", r"zope public licen[sc]e", "1.1 2.0 2.1"),
    ("odbl", "open database", r"open database licen[sc]e", "1.0"),
    ("odc-by", "open data commons attribution", r"open data commons attribution licen[sc]e", "1.0"),
    ("osl-d", "database contents", r"database contents licen[sc]e", "1.0"),
    ("sspl", "server side public", r"server side public licen[sc]e", "1.0"),
    ("busl", "business source", r"business source licen[sc]e", "1.0 1.1"),
    ("elastic", "elastic", r"elastic licen[sc]e", "1.0 2.0"),
    ("ms-pl", "microsoft public", r"microsoft public licen[sc]e", "1.0"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[sc]e", "1.0"),
    ("npl", "netscape", r"netscape public licen[sc]e", "1.0 1.1"),
    ("nposl", "non profit open", r"non profit open software licen[sc]e", "3.0"),
    ("ogl", "open government", r"open government licen[sc]e", "1.0 2.0 3.0"),
    ("w3c", "w3c", r"w3c software (?:notice and )?licen[sc]e", "1.0"),
    ("upl", "universal permissive", r"universal permissive licen[sc]e", "1.0"),
    ("mulan", "mulan", r"mulan (?:permissive software licen[sc]e|psl)", "1.0 2.0"),
)
# Kinds of the attribution license: label, pattern of the conditions after "attribution".
_CC_KINDS = (
    ("cc-by", ""), ("cc-by-sa", r" share ?alike"), ("cc-by-nc", r" non ?commercial"), ("cc-by-nd", r" no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc-sa", r" non ?commercial share ?alike"), ("cc-by-nc-nd", r" non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
_CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
# Sentences and short forms, hand-written.
_PHRASES = (
    Rule(95, "mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Rule(90, "mit", "mit", r"(?:released|licensed|available|distributed) under (?:the )?(?:terms of (?:the )?)?mit licen[sc]e"),
    Rule(60, "mit", "mit", r"mit licen[sc]e"),
    Rule(95, "isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose"),
    Rule(60, "isc", "isc", r"isc licen[sc]e"),
    Rule(95, "bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    Rule(60, "bsd", "bsd", r"bsd licen[sc]e"),
    Rule(85, "bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[sc]e)?"),
    Rule(85, "bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[sc]e)?"),
    Rule(85, "bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?"),
    Rule(95, "zlib", "as is without any express", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    Rule(60, "zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    Rule(95, "unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    Rule(60, "unlicense", "unlicense", r"unlicense"),
    Rule(90, "wtfpl", "what the", r"do what the [a-z]+ you want to public licen[sc]e"),
    Rule(90, "cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    Rule(90, "cc0", "creative commons zero", r"creative commons zero"),
    Rule(80, "pddl", "public domain dedication", r"(?:open data commons )?public domain dedication(?: and licen[sc]e)?"),
    Rule(50, "public-domain", "public domain", r"(?:in|into|to) the public domain"),
    Rule(95, "apache-2.0", "you may not use this file", r"you may not use this file except in compliance with the licen[sc]e"),
    Rule(95, "gpl", "free software foundation", r"under the terms of the gnu general public licen[sc]e as published by the free software foundation"),
    Rule(95, "lgpl", "free software foundation", r"under the terms of the gnu (?:lesser|library) general public licen[sc]e as published by the free software foundation"),
    Rule(95, "agpl", "free software foundation", r"under the terms of the gnu affero general public licen[sc]e as published by the free software foundation"),
    Rule(95, "mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    Rule(85, "reserved", "all rights reserved", r"(?:copyright )?(?:c )?(?:\d{4} )?(?:[^ ]+ ){0,4}all rights reserved"),
    Rule(40, "copyright", "copyright", r"copyright (?:c )?\d{4}"),
    Rule(45, "proprietary", "proprietary", r"proprietary and confidential|confidential and proprietary"),
    Rule(45, "no-copying", "copying of this", r"unauthori[sz]ed copying of this file"),
    Rule(40, "licensed", "licensed under", r"licensed under the [^ ]+(?: [^ ]+)? licen[sc]e"),
    Rule(40, "source-license", "source code", r"source code is (?:licensed|released|available) under"),
    Rule(70, "cc-by", "cc by", r"cc by"),
)
# Short forms, "<code> <version>", as package metadata writes them.
_SHORT = "apache gpl lgpl agpl gfdl mpl epl cddl eupl ofl artistic afl osl bsl cecill ecl lppl zpl odbl sspl busl".split()


def _version(v: str) -> str:
    """A version as words; a minor version of zero may be left out."""
    major, minor = v.split(".")
    tail = f" {minor}" if minor.strip("0") else f"(?: {minor})?"
    return rf"v?{major}{tail}(?! \d)"


def rules() -> tuple[Rule, ...]:
    """All signatures, the highest priority first; versions and kinds are spelled out by rule."""
    found = list(_PHRASES)
    for label, keyword, name, versions in _VERSIONED:
        found.append(Rule(60, label, keyword, name))
        for v in versions.split():
            exact = f"{label}-{v}"
            found.append(Rule(80, exact, keyword, rf"{name}(?: version)? {_version(v)}"))
            found.append(Rule(85, f"{exact}-or-later", keyword, rf"{name}(?: version)? {_version(v)} or (?:at your option )?(?:any )?later(?: version)?"))
            if label in _SHORT:
                found.append(Rule(75, exact, label, rf"{label} {_version(v)}"))
    for label, conditions in _CC_KINDS:
        short = label.replace("-", " ")
        found.append(Rule(70, label, "creative commons", f"creative commons attribution{conditions}"))
        found.append(Rule(72, label, short, short))
        for v in _CC_VERSIONS.split():
            found.append(Rule(82, f"{label}-{v}", "creative commons", rf"creative commons attribution{conditions}(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?(?: version)? {_version(v)}"))
            found.append(Rule(82, f"{label}-{v}", short, rf"{short} {_version(v)}"))
    return tuple(sorted(dict.fromkeys(found), key=lambda r: (-r.priority, r.label, r.pattern)))


class Signatures:
    """The keyword automaton, and for each keyword the compiled signatures it opens; built once a task."""

    def __init__(self):
        import ahocorasick

        self.by_keyword: dict[str, list[tuple[int, Rule, re.Pattern]]] = {}
        for place, rule in enumerate(rules()):
            self.by_keyword.setdefault(rule.keyword, []).append((place, rule, re.compile(rf"(?<![^ ])(?:{rule.pattern})(?![^ ])")))
        self.machine = ahocorasick.Automaton()
        for keyword in self.by_keyword:
            self.machine.add_word(keyword, keyword)
        self.machine.make_automaton()

    def opened(self, words: str) -> set[str]:
        return {keyword for _, keyword in self.machine.iter(words)}


def detect(words: str, signatures: Signatures) -> list[tuple[str, int, int, int]]:
    """(label, first word, words, priority) of what stays after suppression, by place."""
    hits = [
        (place, m.start(), m.end(), rule)
        for keyword in signatures.opened(words)
        for place, rule, pattern in signatures.by_keyword[keyword]
        for m in pattern.finditer(words)
    ]
    hits.sort(key=lambda h: (-h[3].priority, h[1] - h[2], h[1], h[0]))
    hits = _outer(hits)
    result, at, seen = [], 0, 0
    for _, first, last, rule in sorted(hits, key=lambda h: (h[1], h[2])):
        seen += words.count(" ", at, first)
        at = first
        result.append((rule.label, seen, words.count(" ", first, last) + 1, rule.priority))
    return result


def _outer(hits: list) -> list:
    """Hits that lie in no earlier hit's interval; kept hits are looked up by where they begin."""
    from bisect import bisect_right, insort

    kept, order = [], []  # order: (start, end), with ends growing, of kept hits no other kept one holds
    for hit in hits:
        i = bisect_right(order, (hit[1], float("inf"))) - 1
        if i >= 0 and order[i][1] >= hit[2]:
            continue
        kept.append(hit)
        j = bisect_right(order, (hit[1], -1))
        while j < len(order) and order[j][1] <= hit[2]:
            order.pop(j)
        insort(order, (hit[1], hit[2]))
    return kept


def _base(words: bytes) -> tuple[list[int], set[str]]:
    """Where each base phrase begins, in words, and the labels found."""
    starts, labels = [], set()
    for phrase, label in BASE:
        needle = b" " + phrase + b" "
        at, seen, i = 0, 0, words.find(needle)
        while i >= 0:
            seen += words.count(b" ", at, i)
            at = i
            starts.append(seen)
            labels.add(label)
            i = words.find(needle, i + 1)
    return starts, labels


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: base phrases and their places, all labels, the detections kept, and a score.

    The score is the highest priority found, over 100; 0 without any. A null or empty text has no
    words and no label. Repeated rows give repeated results. There is no shuffle.
    """

    def run(batches):
        signatures = Signatures()
        for batch in batches:
            for part in small_batches(batch):
                yield _scan(part, signatures)

    return with_doc_id(id_and_text(df, id_col, text_col).mapInArrow(run, COLUMNS), id_col)


def _scan(batch: pa.RecordBatch, signatures: Signatures) -> pa.RecordBatch:
    rows = []
    for text in batch.column("text").to_pylist():
        tokens = text.encode().translate(_TO_WORDS).split()
        joined = b" ".join(tokens)
        plain = joined.decode()
        starts, base, spans = [], set(), []
        if signatures.opened(plain):
            starts, base = _base(b" " + joined + b" ")
            spans = detect(plain, signatures)
        labels = base | {s[0] for s in spans}
        score = max([s[3] for s in spans] + [70 for _ in starts[:1]], default=0) / 100
        rows.append((len(tokens), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, [dict(zip(("label", "first_word", "n_words", "priority"), s)) for s in spans]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("priority", pa.int32())]))]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))],
        names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
    )


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places and all license labels of every document."""
    return scan_licenses(documents(spark, sf_dir))


ENTRIES = {"op4_license_scans": (op4_license_scans, None)}
