"""Secrets in texts: fixed formats, and values in credential contexts that are costly to guess.

Fixed formats (``assign``, ``access``, ``hex``) are found by their patterns and always stay.  Beyond these, a value that
stands where a credential is given (a key with a credential's name, the password of a URL, a bearer token) is taken as
``guess`` if its guess cost (``guesses``) reaches ``LEAST`` bits.  Values made of words, dates, repeats and keyboard walks
stay below that, and so do placeholders.  The ranked words are common passwords, then the most frequent words of all
texts at hand, ``WORDS`` at most: a parameter of the model and the bound of what is sent to the tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import guesses
from .batches import batch, pieces
from .shipping import ship

WORDS = 20_000
#: Bits from which a value counts as a secret; about ten billion guesses have 33.
LEAST = 40.0
#: Fixed values of the contract: kinds in their order, patterns, shortest accepted group 2, and shortest access and hex.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGNED, ACCESSED = 12, 18
#: Names of credentials, in the languages of the texts.
NAMES = """passphrase password passwd passwort kennwort contraseña clave pwd pass secret token apikey api_key api-key access_key
access-key accesskey private_key private-key privatekey credential credentials authorization auth""".split()
_ORDERED = "|".join(sorted(NAMES, key=lambda w: (-len(w), w)))
KEYED = re.compile(rf"""(?<![A-Za-z0-9])(?:[A-Za-z0-9]{{1,32}}[_-]){{0,4}}(?:{_ORDERED})(?:[_-][A-Za-z0-9]{{1,32}}){{0,4}}["']?[ \t]*(?::=|=>|[:=])[ \t]*["']?([!-~]+)""", re.I)
IN_URL = re.compile(r"://[^\s/:@]*:([^\s/@]+)@")
BEARER = re.compile(r"(?<![A-Za-z0-9])bearer[ \t]+([A-Za-z0-9._~+/=-]+)", re.I | re.A)
#: A text without any of these has no context that one of the patterns could find.
HINTS = ("passw", "pwd", "pass", "secret", "token", "key", "kennwort", "contrase", "clave", "credential", "auth", "bearer", "://")
SHORTEST = 6


def base(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the fixed formats."""
    low = text.lower()
    found = []
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        found += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESSED]
    return found + [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]


def contexts(text: str) -> list[tuple[int, int]]:
    """Spans of values that stand where a credential is given; leftmost first, and none overlaps another."""
    low = text.lower()
    if not any(w in low for w in HINTS):
        return []
    found = []
    for pattern in (KEYED, IN_URL, BEARER):
        for m in pattern.finditer(text):
            start, value = m.start(1), m[1]
            if pattern is KEYED:
                value = re.split(r"[\"'<>]", value, maxsplit=1)[0].rstrip(".,;:!?)]}")
            if len(value) >= SHORTEST:
                found.append((start, start + len(value)))
    chosen: list[tuple[int, int]] = []
    for start, end in sorted(found, key=lambda s: (s[0], -s[1])):
        if not chosen or start >= chosen[-1][1]:
            chosen.append((start, end))
    return chosen


def spans(text: str, ranked: dict[str, int], least: float = LEAST) -> tuple[list[tuple[int, int, str]], float | None]:
    """(start, end, kind) of all secrets in order, and the bits of the costliest value in a credential context."""
    fixed = base(text)
    values = [(s, e) for s, e, kind, _ in fixed if kind == "assign"]
    bits = [guesses.guess_bits(v, ranked) for _, _, kind, v in fixed if kind == "assign"]
    found = [(s, e, kind) for s, e, kind, _ in fixed]
    for start, end in contexts(text):
        # What a fixed assignment covers has its span already.
        if not any(s < end and start < e for s, e in values):
            cost = guesses.guess_bits(text[start:end], ranked)
            bits.append(cost)
            if cost >= least:
                found.append((start, end, "guess"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]))), max(bits, default=None)


def frequent(documents: DataFrame, words: int = WORDS) -> list[str]:
    """The most frequent words of plain letters in all texts, ties by code point."""
    rows = F.split(F.lower("text"), "[^a-z]+")
    fits = F.filter(rows, lambda w: F.length(w).between(guesses.SHORT, guesses.LONGEST))
    counts = documents.select(F.explode(fits).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(words).collect()]


def _told(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def scan(documents: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """For each row ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, then ``n_guess`` and ``bits``.

    Spans are ``kind:start:end`` in code points.  Null and empty texts have none; ``bits``, the cost of the costliest value
    in a credential context, is null without such values.  Repeated rows are looked at one by one; ids are passed through.
    An empty table gives no rows; other columns are not touched.
    """
    spark = documents.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(frequent(documents, words))
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "bits"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
    schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = guesses.ranks(known.value)
        for piece in pieces(batches):
            out: list[list] = [[] for _ in names]
            for id, text in zip(*(c.to_pylist() for c in piece.columns)):
                found, bits = spans(text or "", ranked, least)
                fixed = [s for s in found if s[2] != "guess"]
                counts = [sum(s[2] == kind for s in found) for kind in KINDS]
                for column, value in zip(out, [id, *counts[:3], hashlib.sha256(_told(fixed).encode()).hexdigest(), _told(found), counts[3], bits]):
                    column.append(value)
            yield batch(schema, *out)

    ddl = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, bits double"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ddl)
