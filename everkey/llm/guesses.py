"""Guess costs of passwords: the cheapest way to put a value together, in bits.

A value is cut into segments: words of a ranked list, dates, repeats, keyboard walks and brute-force spans.  Every
segment costs ``KIND`` bits for naming its kind and the bits for finding it among its like.  The cheapest segmentation is
found by dynamic programming over the ends of prefixes, in time that grows with the length of the value.
"""

from __future__ import annotations

import re
from math import comb, log2

# Words that passwords are commonly made of, the most common first.
COMMON = """password admin welcome letmein qwerty dragon monkey master login princess sunshine football shadow superman
iloveyou baseball trustno michael jordan hunter buster soccer harley batman andrew tigger charlie robert thomas hockey
ranger daniel starwars klaster george computer michelle jessica pepper freedom maggie ginger joshua cheese amanda
summer winter spring autumn love secret access test default changeme example guest root user pass system server oracle
mysql public private demo temp sample dummy placeholder abc hello world google apple orange banana coffee flower
passwort hallo schatz motdepasse bonjour soleil amour azerty contrasena hola amor clave""".split()

KIND = log2(5)
LONGEST = 24
#: Longest unit of a repeat, and shortest repeats and walks.
UNIT, SHORT = 8, 3
#: Characters that stand in for letters, and keyboard rows with how far each is moved to the right.
LEET = str.maketrans("4@3015$7", "aaeoisst")
ROWS = (("`1234567890-=", "~!@#$%^&*()_+", 0.0), ("qwertyuiop[]\\", "QWERTYUIOP{}|", 1.5), ("asdfghjkl;'", "ASDFGHJKL:\"", 1.75), ("zxcvbnm,./", "ZXCVBNM<>?", 2.25))
DATE = re.compile(r"(?=((?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\2(?:0[1-9]|[12]\d|3[01])))|(?=((?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|[12]\d|3[01])\4(?:19|20)\d\d))", re.A)
YEAR = re.compile(r"(?=(?:19|20)\d\d)", re.A)
DAYS, YEARS = 366, 200

_PLACES = {c: (x + shift, y) for y, (plain, shifted, shift) in enumerate(ROWS) for row in (plain, shifted) for x, c in enumerate(row)}
_SHIFTED = {c for _, shifted, _ in ROWS for c in shifted}
_CLASSES = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))


def ranks(words: list[str]) -> dict[str, int]:
    """Rank of each word, from 1; the common ones come before those given."""
    out: dict[str, int] = {}
    for word in [*COMMON, *words]:
        if SHORT <= len(word) <= LONGEST:
            out.setdefault(word, len(out) + 1)
    return out


def alphabet(value: str) -> int:
    """Characters an attacker has to try at each place: those of the classes the value uses."""
    size = sum(n for test, n in _CLASSES if any(c.isascii() and test(c) for c in value))
    size += 33 if any(c.isascii() and not c.isalnum() for c in value) else 0
    return size + (128 if any(not c.isascii() for c in value) else 0)


def word_bits(segment: str, ranked: dict[str, int]) -> float | None:
    """Bits of a segment that is a word but for case and look-alikes, else None."""
    low = segment.lower()
    plain = low.translate(LEET)
    rank, swaps = ranked.get(low), 0
    if rank is None and plain != low:
        rank, swaps = ranked.get(plain), sum(x != y for x, y in zip(low, plain))
    if rank is None:
        return None
    upper = sum(c.isupper() for c in segment)
    letters = sum(c.isalpha() for c in segment)
    if upper == 0:
        case = 0.0
    elif upper == letters or (upper == 1 and segment[0].isupper()):
        case = 1.0
    else:
        case = log2(sum(comb(letters, k) for k in range(1, min(upper, letters - upper) + 1)) + 1)
    return log2(rank) + case + swaps


def dates(value: str) -> list[tuple[int, int, float]]:
    """(first, end, bits) of each date and year."""
    out = [(m.start(), m.start() + 4, log2(YEARS)) for m in YEAR.finditer(value)]
    for m in DATE.finditer(value):
        text, mark = (m[1], m[2]) if m[1] else (m[3], m[4])
        out.append((m.start(), m.start() + len(text), log2(DAYS * YEARS) + (2.0 if mark else 0.0)))
    return out


def repeats(value: str, bits: float) -> list[tuple[int, int, float]]:
    """(first, end, bits) of the longest repeats of each unit length."""
    out, n = [], len(value)
    for unit in range(1, min(UNIT, n // 2) + 1):
        first = 0
        while first + unit < n:
            end = first
            while end + unit < n and value[end] == value[end + unit]:
                end += 1
            times = (end - first) // unit + 1
            if times > 1 and times * unit >= SHORT:
                out.append((first, first + times * unit, unit * bits + log2(times)))
            first = end + 1
    return out


def _step(a: str, b: str) -> tuple[float, int] | None:
    """Direction from one key to a neighbour of it."""
    if a not in _PLACES or b not in _PLACES:
        return None
    (xa, ya), (xb, yb) = _PLACES[a], _PLACES[b]
    if (ya == yb and abs(xa - xb) == 1) or (abs(ya - yb) == 1 and abs(xa - xb) < 1):
        return (1 if xb > xa else -1, yb - ya)
    return None


def walks(value: str) -> list[tuple[int, int, float]]:
    """(first, end, bits) of the longest walks over neighbouring keys."""
    out, first, turns, last = [], 0, 0, None
    for i in range(1, len(value) + 1):
        step = _step(value[i - 1], value[i]) if i < len(value) else None
        if step is None:
            if i - first >= SHORT:
                shifted = sum(c in _SHIFTED for c in value[first:i])
                mixed = log2(comb(i - first, shifted)) + 1 if shifted else 0.0
                out.append((first, i, log2(len(_PLACES) / 2) + log2(i - first) + turns * log2(6) + mixed))
            first, turns, last = i, 0, None
        elif step != last:
            turns, last = turns + 1, step
    return out


def guess_bits(value: str, ranked: dict[str, int]) -> float:
    """Bits of the cheapest segmentation; an empty value costs nothing."""
    n, each = len(value), log2(max(alphabet(value), 1))
    ending: dict[int, list[tuple[int, float]]] = {}
    for first, end, bits in [*dates(value), *repeats(value, each), *walks(value)]:
        ending.setdefault(end, []).append((first, bits))
    best, brute = [0.0] + [0.0] * n, float("inf")
    for end in range(1, n + 1):
        brute = min(brute, best[end - 1] + KIND) + each
        least = brute
        for first, bits in ending.get(end, ()):
            least = min(least, best[first] + bits + KIND)
        for first in range(max(0, end - LONGEST), end - SHORT + 1):
            bits = word_bits(value[first:end], ranked)
            if bits is not None:
                least = min(least, best[first] + bits + KIND)
        best[end] = least
    return best[n]
