"""Operators on conversations, against brute force."""

import hashlib
import math
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from everkey.llm import auction, repair, tour, trie

SCHEMA = "conv_id long, turn long, role string, text string, _conv long, depth int, _part int, _size int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


# ---- prefix trie


def plain_trie(rows):
    held = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        held.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c in held:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        paths[c] = tuple(held.get(base, [])[:h] + held[c][h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = {}
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ending = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        out[min(who), len(node)] = (min(members[node[:-1]]) if node else None, len(who), len(kids), len(leaves), saved, hashlib.sha256(ending.encode()).hexdigest())
    return out


def compare_trie(spark, rows, **options):
    got = trie.trie(conversations(spark, rows), **options).collect()
    assert {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in got} == plain_trie(rows)
    assert sorted(x for r in got for x in (r["enter_at"], r["exit_at"])) == list(range(2 * len(got)))
    assert len(got) == len({(r["conv_id"], r["depth"]) for r in got})


def random_conversations(rng, n, deep):
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.randrange(1, deep)):
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", "", None]), rng.choice(["a", "a b", "", None, "x\ty  z w"])))
    return rows


@pytest.mark.parametrize("block", [1 << 16, 12])
def test_trie_against_brute_force(spark, block):
    rng = random.Random(block)
    rows = random_conversations(rng, 60, 6)
    # One conversation with a third of all turns, copies of one conversation, rows without id, a repeated row.
    rows += [(7, t, "user", f"w {t % 5}") for t in range(100)] + [(c, t, "user", "same") for c in range(200, 240) for t in range(3)]
    rows += [(None, 1, "user", "lost"), (9, 1, "user", "a"), (9, 1, "user", "a"), (-25, 0, "user", "a"), (-20, 3, "user", "b"), (61, 0, "user", "word " * 20_000)]
    compare_trie(spark, rows, block=block, chunk=16)


def test_trie_of_nothing_and_of_turnless(spark):
    assert trie.trie(conversations(spark, [])).count() == 0
    # h of 1 is 3 and there is no conversation 0, so nothing is left of a single turn.
    assert zlib.crc32(b"1") % 4 == 3
    compare_trie(spark, [(1, 0, "user", "a")])


@pytest.mark.parametrize("shape", ["mixed", "ordered"])
def test_rank_of_a_list_in_any_order(spark, shape):
    rng = random.Random(5)
    n = 3000
    order = rng.sample(range(10 * n), n)
    if shape == "ordered":
        order.sort()
    weight = {a: rng.randrange(9) for a in order}
    rows = [(a, b, weight[a], 1) for a, b in zip(order, [*order[1:], None])]
    arcs = spark.createDataFrame(rows, "_arc long, _next long, w long, one long").withColumn("_part", F.floor(F.col("_arc") / 1000).cast("int"))
    got = {r["_arc"]: (r["w"], r["one"]) for r in tour.rank(arcs, ["w", "one"], 100).collect()}
    sums = np.cumsum([0] + [weight[a] for a in order])
    assert got == {a: (sums[i], i) for i, a in enumerate(order)}


# ---- repair


def plain_edits(turns):
    """(cost, letters) of the cheapest edits by trying all, never more than three insertions in a row."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, left):
        ways = []
        if i == len(turns):
            if state in ("", "a"):
                ways.append((0, ""))
        else:
            initial, goes, cut = turns[i]
            rest = best(i + 1, state, 3)
            ways.append((2 + rest[0], "D" + rest[1]))
            for to in ([] if goes else ["s", "u", "a"]):
                if to == after[state] or (to == "s" and state == ""):
                    rest = best(i + 1, to, 3)
                    ways += [(cost + 5 * cut + rest[0], letter + rest[1]) for letter, cost, fits in (("K", 0, initial == to), ("R", 1, to != "s")) if fits]
        if left:
            rest = best(i, after[state], left - 1)
            ways.append((5 + rest[0], "I" + rest[1]))
        return min(ways, default=(math.inf, ""))

    return best(0, "", 3)


def plain_repair(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        held = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            blank = lambda v: " " if v is None else v
            fault = zlib.crc32(f"{blank(c)}:{blank(turn)}".encode()) % 20
            role, text = blank(role), blank(text)
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            row = (turn is not None, turn or 0, "user" if fault == 4 else role, text)
            held += [] if fault == 0 else [row] * (2 if fault == 3 else 1)
        held.sort()
        turns = [r[1] for r in held if r[0]]
        counts, judged, seen = [0, 0, 0], [], set()
        for _, _, role, text in held:
            bare = text.strip(" \t\n\x0b\x0c\r")
            k = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if k is not None:
                counts[k] += 1
            judged.append((role[:1], k in (0, 1), k == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, letters = plain_edits(tuple(judged))
        fixed, i, state = [], 0, ""
        for letter in letters:
            want = "a" if state == "u" else "u"
            name = {"u": "user", "a": "assistant"}[want]
            if letter == "I":
                fixed.append(name + ":")
            elif letter == "K":
                fixed.append(held[i][2] + ":" + held[i][3])
                want = held[i][2][0]
            elif letter == "R":
                fixed.append(name + ":" + held[i][3])
            i += letter != "I"
            state = state if letter == "D" else want
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(fixed).encode()).hexdigest())
    return out


def compare_repair(spark, rows, **options):
    got = repair.repair(conversations(spark, rows), **options).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in got} == plain_repair(rows)
    assert len(got) == len({r[0] for r in rows})


turn_kinds = st.tuples(st.sampled_from("suax "), st.booleans(), st.booleans()).map(lambda t: (t[0].strip(), t[1], t[2] and not t[1]))


@settings(max_examples=400, deadline=None)
@given(st.lists(turn_kinds, max_size=12))
def test_auction_against_all_edits(turns):
    lattice = auction.Lattice(turns, auction.WHOLE)
    assert (lattice.settle(auction.NEW), lattice.trace(auction.NEW)[0]) == plain_edits(tuple(turns))


@settings(max_examples=200, deadline=None)
@given(st.lists(turn_kinds, min_size=1, max_size=12), st.integers(1, 4))
def test_stretches_give_the_same_edits(turns, width):
    parts = [turns[i: i + width] for i in range(0, len(turns), width)]
    ends = auction.Chain([auction.transitions(p) for p in parts]).costs_after()
    state, letters, costs = auction.NEW, "", []
    for part, end in zip(parts, ends):
        lattice = auction.Lattice(part, end)
        costs.append(lattice.settle(state))
        some, state = lattice.trace(state)
        letters += some
    assert (costs[0], letters) == plain_edits(tuple(turns))


@pytest.mark.parametrize("stretch", [repair.STRETCH, 3])
def test_repair_against_brute_force(spark, stretch):
    rng = random.Random(stretch)
    texts = ["a.", "b!", "cut", "", " \t", None, "é?\n", "a.", "two words."]
    roles = ["user", "assistant", "system", None, "", "tool"]
    rows = [(c, rng.choice([t, t, t, None, t + 3]), rng.choice(roles[: rng.choice([2, 3, 6])]), rng.choice(texts)) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(50, t, ["user", "assistant"][t % 2], f"turn {t}{'.' if t % 7 else ''}") for t in range(300)]
    rows += [(51, t, "user", f"again {t}.") for t in range(60)] + [(52, 1, "user", "same.")] * 40 + [(None, 1, "user", "a."), (None, None, None, None), (53, 0, "user", "long " * 20_000)]
    alone = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((alone, 0, "user", "dropped."))
    compare_repair(spark, rows, stretch=stretch)
    assert plain_repair(rows)[alone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_of_nothing(spark):
    assert repair.repair(conversations(spark, [])).count() == 0
