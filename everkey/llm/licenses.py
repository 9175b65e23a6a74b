"""Licence scan: ordered signature rules behind a keyword prefilter.

A signature is written word by word: ``gnu? (general|lesser) public license``.  ``?`` makes a word optional, ``(a|b)``
gives choices.  Texts are scanned as their words, each between two blanks of its own, so a signature never starts or
ends inside a word.  A cheap pattern over the raw text lets most documents pass untouched; in the others a rule runs
only if its keyword is there.  Of overlapping detections, one inside a longer one goes, and of two over the same words
the rule that comes first stays.  All of it happens within the row: no document moves, whatever its length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .urls import LOWER, UPPER

#: The phrases of the contract and their labels.
BASE_PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Fixed value: what stands between words, once A-Z is in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The words of the raw text, where A-Z may still be there.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Signature:
    label: str
    keyword: str
    words: str
    confidence: float

    @property
    def regex(self) -> str:
        out = ""
        for word in self.words.split():
            optional, body = word.endswith("?"), word.removesuffix("?")
            if not re.fullmatch(r"[0-9a-z]+|\([0-9a-z]+(\|[0-9a-z]+)*\)", body):
                raise ValueError(f"signature {self.words!r} holds {word!r}")
            unit = f" (?:{body[1:-1]}) " if body[0] == "(" else f" {body} "
            out += f"(?:{unit})?" if optional else unit
        return out


LIC = "(license|licence)"
LICD = "(licensed|licenced|released|distributed|available|provided|published|covered)"
LATER = "or at? your? option? any? (later|newer|above)"

#: (label stem, names by which it goes, versions).  With the phrasings below they make up the versioned signatures.
FAMILIES = [
    ("gpl", ["gnu? general public (license|licence)", "gnu gpl", "gpl"], ["1", "2", "3"]),
    ("lgpl", ["gnu? (lesser|library) general public (license|licence)", "gnu? lgpl"], ["2", "2 1", "3"]),
    ("agpl", ["gnu? affero general public (license|licence)", "gnu? agpl"], ["1", "3"]),
    ("fdl", ["gnu? free documentation (license|licence)", "gfdl"], ["1 1", "1 2", "1 3"]),
    ("apache", ["apache software? (license|licence)", "apache"], ["1 0", "1 1", "2 0", "2"]),
    ("mpl", ["mozilla public (license|licence)", "mpl"], ["1 0", "1 1", "2 0"]),
    ("epl", ["eclipse public (license|licence)", "epl"], ["1 0", "2 0"]),
    ("eupl", ["european union public (license|licence)", "eupl"], ["1 0", "1 1", "1 2"]),
    ("cddl", ["common development and distribution (license|licence)", "cddl"], ["1 0", "1 1"]),
    ("cpl", ["common public (license|licence)"], ["1 0"]),
    ("osl", ["open software (license|licence)"], ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", ["academic free (license|licence)"], ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("artistic", ["artistic (license|licence)"], ["1 0", "2 0"]),
    ("boost", ["boost software (license|licence)"], ["1 0"]),
    ("ofl", ["(sil|open) open? font (license|licence)", "ofl"], ["1 0", "1 1"]),
    ("cecill", ["cecill"], ["1 0", "1 1", "2 0", "2 1"]),
    ("odbl", ["open (database|data) commons? open? database? (license|licence)"], ["1 0"]),
    ("upl", ["universal permissive (license|licence)"], ["1 0"]),
    ("zpl", ["zope public (license|licence)"], ["1 1", "2 0", "2 1"]),
    ("php", ["php (license|licence)"], ["3 0", "3 01"]),
    ("python", ["python (license|licence)", "psf (license|licence)"], ["2", "2 0"]),
    ("lppl", ["latex project public (license|licence)"], ["1 0", "1 1", "1 2", "1 3"]),
    ("ms-pl", ["microsoft public (license|licence)"], ["1 0"]),
    ("nposl", ["non profit open software (license|licence)"], ["3 0"]),
]
CREATIVE = [("by", ["by", "attribution"]), ("by-sa", ["by sa", "attribution (sharealike|share) alike?"]),
            ("by-nc", ["by nc", "attribution (noncommercial|non) commercial?"]), ("by-nd", ["by nd", "attribution (noderivatives|noderivs|no) (derivatives|derivs)?"]),
            ("by-nc-sa", ["by nc sa", "attribution (noncommercial|non) commercial? (sharealike|share) alike?"]),
            ("by-nc-nd", ["by nc nd", "attribution (noncommercial|non) commercial? (noderivatives|noderivs|no) (derivatives|derivs)?"])]
SINGLE = [
    ("mit", "license", f"{LICD} under the? terms? of? the? mit {LIC}", 0.95), ("mit", "license", f"the? mit x11? {LIC}", 0.85),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 0.95),
    ("isc", "permission", "permission to use copy modify and or? distribute this software for any purpose with or without fee", 0.95),
    ("isc", "license", f"isc {LIC}", 0.8), ("bsd-2-clause", "license", f"(simplified|2|two) clause? bsd {LIC}", 0.85),
    ("bsd-3-clause", "license", f"(new|revised|modified|3|three) clause? bsd {LIC}", 0.85), ("bsd-4-clause", "license", f"(original|4|four) clause? bsd {LIC}", 0.85),
    ("bsd-2-clause", "bsd", "bsd (2|two) clause", 0.85), ("bsd-3-clause", "bsd", "bsd (3|three) clause", 0.85), ("bsd-4-clause", "bsd", "bsd (4|four) clause", 0.85),
    ("bsd", "bsd", f"bsd (style|like)? {LIC}", 0.7), ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 0.95),
    ("zlib", "license", f"zlib libpng? {LIC}", 0.85), ("unlicense", "unlicense", "the? unlicense", 0.8),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 0.95),
    ("wtfpl", "wtfpl", "wtfpl", 0.85), ("beerware", "beerware", f"(the|beer)? beerware {LIC}", 0.8), ("postgresql", "license", f"postgresql {LIC}", 0.8),
    ("openssl", "license", f"openssl {LIC}", 0.8), ("ruby", "license", f"ruby {LIC}", 0.7), ("vim", "license", f"vim {LIC}", 0.7),
    ("curl", "license", f"curl {LIC}", 0.7), ("x11", "license", f"x11 {LIC}", 0.8), ("json", "license", f"json {LIC}", 0.7),
    ("cc0", "cc0", "cc0", 0.85), ("cc0", "creative", "creative commons zero", 0.9), ("public-domain", "domain", "(placed|released|dedicated|belongs)? (in|into|to)? the? public domain", 0.7),
    ("creative-commons", "creative", f"creative commons {LIC}?", 0.5), ("cc-by", "cc", "cc by", 0.6),
    ("proprietary", "proprietary", "proprietary and confidential", 0.8), ("proprietary", "permission", "without the? prior? (express|written)? written? permission", 0.6),
    ("proprietary", "reproduction", "unauthorized (reproduction|copying|use|distribution) is? (strictly|expressly)? prohibited", 0.7),
    ("reserved", "reserved", "all rights reserved", 0.4), ("reserved", "reserved", "no rights reserved", 0.4), ("some-reserved", "reserved", "some rights reserved", 0.4),
    ("gpl", "license", f"general public {LIC}", 0.6), ("copyleft", "copyleft", "copyleft", 0.4), ("no-warranty", "warranty", "without warranty of any kind", 0.4),
    ("no-warranty", "warranties", "without warranties or conditions of any kind", 0.4), ("copyright", "copyright", "copyright c? (19|20)? (by|the)?", 0.3),
]


def keyword_of(words: str) -> str:
    """The longest plain word of a signature; it is there whenever the signature is."""
    plain = [w for w in words.split() if re.fullmatch("[0-9a-z]+", w)]
    return max(plain, key=len)


def signatures() -> list[Signature]:
    """All rules, the most specific first."""
    out = []
    for stem, names, versions in FAMILIES:
        for name in names:
            gate = "license" if "(license|licence)" in name else keyword_of(name)
            for v in versions:
                label = f"{stem}-{v.replace(' ', '.')}"
                first, rest = v.split(" ")[0], " ".join(v.split(" ")[1:])
                number = f"({first}|v{first}) {rest}".strip() + ("" if rest else " 0?")
                out.append(Signature(f"{label}-or-later", gate, f"{name} (version|v)? {number} {LATER}", 1.0))
                out.append(Signature(label, gate, f"{name} (version|v)? {number}", 0.9))
            out.append(Signature(stem, gate, f"{LICD} under the? terms? of? the? {name}", 0.7))
    for kind, names in reversed(CREATIVE):
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            label = f"cc-{kind}-{v.replace(' ', '.')}"
            out.append(Signature(label, "cc", f"cc {names[0]} {v}", 0.95))
            out.append(Signature(label, "creative", f"creative commons {names[1]} {v} international?", 0.95))
            out.append(Signature(label, "creative", f"creative commons {names[1]} {v} (unported|generic)? {LIC}", 0.95))
        out.append(Signature(f"cc-{kind}", "cc", f"cc {names[0]}", 0.65))
        out.append(Signature(f"cc-{kind}", "creative", f"creative commons {names[1]}", 0.65))
    return out + [Signature(*row) for row in SINGLE]


def gate_of(keywords: list[str]) -> str:
    """One pattern over raw text that finds every document holding a keyword; it tries only where a word may begin."""
    return "(?i)(?<![0-9A-Za-z])(?:" + "|".join(sorted({("licen[cs]e" if k in ("license", "licence") else k) for k in keywords})) + ")"


def keywords_of(rules: list[Signature]) -> dict[str, list[int]]:
    """Rule numbers by keyword.  ``license`` also stands for ``licence``."""
    out: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        for k in ("license", "licence") if r.keyword == "license" else (r.keyword,):
            out.setdefault(k, []).append(i)
    return out


def as_words(text: Column) -> Column:
    """The words of a text, each between two blanks of its own."""
    spaced = F.regexp_replace(F.translate(text, UPPER, LOWER), F.lit(BETWEEN), F.lit("  "))
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))


def word_count(spaced: Column) -> Column:
    """Words in a piece of such a text: half its blanks."""
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def intervals(norm: Column, rule: Column) -> Column:
    """Each place where a rule's pattern stands, as structs (from, back, rule): start, negated end, rule number."""
    lengths = F.transform(F.split(norm, rule["regex"], -1), F.length)
    matches = F.transform(F.regexp_extract_all(norm, rule["regex"], F.lit(0)), F.length)
    steps = F.filter(F.zip_with(lengths, matches, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))), lambda s: s["hit"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,back:int,rule:int>>").alias("out"))
    return F.aggregate(steps, start, lambda acc, s: F.struct(
        (acc["at"] + s["gap"] + s["hit"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + s["gap"]).alias("from"), (-(acc["at"] + s["gap"] + s["hit"])).alias("back"), rule["rule"].alias("rule")))).alias("out"),
    ), lambda acc: acc["out"])


def outermost(found: Column) -> Column:
    """Detections that no other contains.  Sorted by start, longest first, then by rule: one look at the furthest end so far is enough."""
    start = F.struct(F.lit(-1).alias("end"), F.array().cast("array<int>").alias("rules"))
    return F.aggregate(F.array_sort(found), start, lambda acc, d: F.when(-d["back"] <= acc["end"], acc).otherwise(F.struct(
        (-d["back"]).alias("end"), F.concat(acc["rules"], F.array(d["rule"])).alias("rules"))), lambda acc: acc["rules"])


def scan(documents: DataFrame, rules: list[Signature] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, score`` for each row.

    ``labels`` joins those of the base phrases and of the rules that are left after suppression; ``score`` is the
    highest confidence among these, 0.5 for a base phrase alone, 0 without any.  A null or empty text has no words and
    no labels.  Rows are scanned one by one, at full length: repeats get equal results, an empty table gives no rows.
    """
    rules = signatures() if rules is None else rules
    named = keywords_of(rules)
    base_words = [f" {'  '.join(p.split())} " for p, _ in BASE_PHRASES]
    any_base = "|".join(base_words)
    packed = {k: F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(rules[i].regex).alias("regex")) for i in numbers]) for k, numbers in named.items()}
    by_keyword = F.create_map(*[x for k, v in packed.items() for x in (F.lit(k), v)])
    labels = F.array(*[F.lit(r.label) for r in rules])
    sure = F.array(*[F.lit(float(r.confidence)) for r in rules])
    none = F.array().cast("array<string>")
    norm = F.col("_norm")
    gate = gate_of([*named, "cc", "license", "reserved"])
    d = (
        documents.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .select("_key", F.regexp_count("_text", F.lit(RAW_WORD)).cast("long").alias("_n"),
                F.when(F.regexp(F.col("_text"), F.lit(gate)), as_words(F.col("_text"))).alias("_norm"))
        .withColumn("_keywords", F.filter(F.array(*[F.lit(k) for k in named]), lambda k: F.contains(norm, F.concat(F.lit(" "), k, F.lit(" ")))))
        .withColumn("_found", F.when(norm.isNotNull(), F.flatten(F.transform("_keywords", lambda k: F.flatten(
            F.transform(F.element_at(by_keyword, k), lambda r: intervals(norm, r)))))))
        .withColumn("_kept", F.when(F.size("_found") > 0, F.array_distinct(outermost(F.col("_found")))))
        .withColumn("_hits", F.when(norm.isNotNull(), F.regexp_extract_all(norm, F.lit(any_base), F.lit(0))))
        .withColumn("_gaps", F.when(F.size("_hits") > 0, F.split(norm, any_base, -1)))
    )
    base = F.array_compact(F.array(*[F.when(F.contains(norm, F.lit(w)), F.lit(label)) for w, (_, label) in zip(base_words, BASE_PHRASES)]))
    d = d.withColumn("_base", F.when(F.size("_hits") > 0, F.array_sort(base)).otherwise(none))
    found = F.coalesce(F.transform("_kept", lambda i: F.element_at(labels, i + 1)), none)
    score = F.greatest(F.coalesce(F.array_max(F.transform("_kept", lambda i: F.element_at(sure, i + 1))), F.lit(0.0)),
                       F.when(F.size("_base") > 0, 0.5).otherwise(0.0))
    last = F.col("_n") - word_count(F.element_at("_gaps", -1)) - word_count(F.element_at("_hits", -1))
    return d.select(
        F.col("_key").alias(key), F.col("_n").alias("n_words"),
        F.when(F.size("_hits") > 0, F.size("_hits")).otherwise(0).cast("long").alias("n_base"),
        F.when(F.size("_hits") > 0, word_count(F.element_at("_gaps", 1))).alias("first_word"),
        F.when(F.size("_hits") > 0, last).alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("_base", found))), ",").alias("labels"),
        score.alias("score"),
    )
