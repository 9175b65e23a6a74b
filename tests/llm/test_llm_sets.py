"""Operators on sets of documents and vectors, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from everkey.llm import components, copies, lines, matroska, mixing, neighbours, simhash

EXTRA = ", size long, _id long, gone long, _row int, _place long"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], "doc_id long, text string, source string" + EXTRA)


def words_of(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 6))) for _ in range(n))


# ---- components


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {n: find(n) for n in parent if find(n) != n}
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_stop_as_soon_as_all_hang_on_roots(spark, monkeypatch):
    """Every step writes a table; none is taken that only shows that nothing changes."""
    steps, write = [], components.written

    def kept(df, label):
        out = write(df, label)
        steps.append((label, out.count()))
        return out

    monkeypatch.setattr(components, "written", kept)
    stars = [(n, n % 3) for n in range(3, 60)]
    found = components.components(spark.createDataFrame(stars + [(0, 3), (4, 4), (None, 1)], "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted(stars)
    assert steps == [("links", 57), ("large-star", 57)]
    steps.clear()
    # Leaves of two roots: no link moves in the first step, and yet they are not done.
    found = components.components(spark.createDataFrame([(n, r) for n in (8, 9) for r in (1, 2)], "a long, b long")).collect()
    assert sorted(map(tuple, found)) == [(2, 1), (8, 1), (9, 1)]
    assert [label for label, _ in steps] == ["links", "large-star", "small-star", "large-star"]


# ---- fingerprints


def plain_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i: i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=100, deadline=None)
@given(st.one_of(st.none(), st.text(max_size=80), st.text(alphabet="aB \n\x1c\x85éÀ", max_size=80)))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


def test_fingerprint_of_a_long_text(monkeypatch):
    text = words_of(random.Random(2), 3000)
    monkeypatch.setattr(simhash, "SLICE", 100)
    assert simhash.fingerprint(text) == plain_print(text)


def brute_components(prints):
    """Smallest id of each row's component, ids and prints given as lists."""
    n = len(prints)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, (id, _) in enumerate(prints):
        if id is not None:
            low[find(i)] = min(low.get(find(i), id), id)
    return [low.get(find(i)) for i in range(n)]


@pytest.mark.parametrize("crowd", [simhash.CROWD, 3])
def test_links_and_components(spark, crowd):
    rng = random.Random(4)
    some = [rng.getrandbits(64) for _ in range(30)]
    prints = set(some)
    for base in some[:6]:
        for _ in range(25):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "_print long"), crowd=crowd).collect()
    at = {p: i for i, p in enumerate(signed)}
    for r in found:
        assert bin(prints[at[r["a"]]] ^ prints[at[r["b"]]]).count("1") <= 4
    root = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(found, "a long, b long")).collect()}
    mine, want = {}, {}
    for p, w in zip(signed, brute_components(list(enumerate(prints)))):
        mine.setdefault(root.get(p, p), set()).add(p)
        want.setdefault(w, set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_thresholds_add_up():
    for n in (1, 100, 10**6, 10**12):
        both = np.full((64, 64), n / 4)
        np.fill_diagonal(both, n / 2)
        for skew in (0, 1):
            both[0, 1] = both[1, 0] = n / 2 if skew else n / 4
            chosen = simhash.allocate(n, both)
            assert sum(t + 1 for _, t in chosen) == 5
            assert all(not set(a) & set(b) for k, (a, _) in enumerate(chosen) for b, _ in chosen[:k])


def test_near_duplicates(spark):
    rng = random.Random(6)
    base = words_of(rng, 200)
    rows = [(5, base, "a"), (3, base, "a"), (9, base.replace(" ", " \n "), "b"), (8, None, None), (7, "", "a"), (6, " \n", "a"), (None, base, "a"), (None, "alone here now then", "a"),
            (11, words_of(rng, 100), "c"), (11, words_of(rng, 90), "c"), (12, "x", "c"), (12, "x", "c")]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    prints = [(r[0], plain_print(r[1])) for r in rows]
    want = sorted((id, format(p, "016x"), c) for (id, p), c in zip(prints, brute_components(prints)) if id is not None)
    assert sorted(tuple(r) for r in got if r["doc_id"] is not None) == want
    assert len(got) == len(rows)
    kept = simhash.one_of_each(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 6, 11, 12]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


# ---- near copies


def plain_shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(rows):
    """(id, text) of the smallest row of each component of five-word Jaccard 0.8 or more."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    own, root = [plain_shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((rows[i] for i in range(len(rows)) if root[i] == i), key=str)


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = "z" + words[at]
    return " ".join(words)


def test_near_copies_of_five_words_and_four_fifths(spark):
    rng = random.Random(21)
    rows, far = [(None, "without id here now then"), (None, None), (900, " "), (901, "")], 0
    for k in range(30):
        base = words_of(rng, 200)
        near, other = edited(rng, base, 1 + k % 4), edited(rng, base, 12)
        far += bin(simhash.fingerprint(base) ^ simhash.fingerprint(near)).count("1") > simhash.DISTANCE
        rows += [(10 * k + 3, near), (10 * k + 1, base), (10 * k + 2, other), (10 * k + 5, edited(rng, near, 3))]
    assert far > 10  # the old settings would keep these
    hub = words_of(rng, 300)
    rows += [(1000 + k, edited(rng, hub, 6)) for k in range(40)] + [(1100, hub)]
    got = copies.one_of_each(docs(spark, [(*r, "s") for r in rows]))
    assert got.columns == docs(spark, []).columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == brute_kept(rows)
    assert copies.one_of_each(docs(spark, [])).count() == 0


# ---- lines


def test_patience_is_an_alignment():
    rng = random.Random(8)
    for _ in range(200):
        a = [rng.choice("abcdefg") if rng.random() < 0.9 else None for _ in range(rng.randrange(12))]
        b = [rng.choice("abcdefg") if rng.random() < 0.9 else None for _ in range(rng.randrange(12))]
        pairs = lines.patience(a, b)
        assert all(a[i] == b[j] is not None for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert bool(pairs) == bool((set(a) - {None}) & (set(b) - {None}))


def runs_of(rows, words, i, j):
    return words[i:j].sum()


def brute_deleted(texts, least):
    """Lines in a stretch of at least ``least`` words that stands the same way in an earlier text."""
    split = [[" ".join(x.split()) for x in (t or "").split("\n")] for t in texts]
    full = [[(k, x) for k, x in enumerate(rows) if x] for rows in split]
    out = []
    for d, rows in enumerate(full):
        gone = set()
        for e in range(d):
            other = [x for _, x in full[e]]
            for i in range(len(rows)):
                for q in range(len(other)):
                    n = 0
                    while i + n < len(rows) and q + n < len(other) and rows[i + n][1] == other[q + n]:
                        n += 1
                    if sum(len(rows[i + k][1].split()) for k in range(n)) >= least:
                        gone |= {i + k for k in range(n)}
        out.append({rows[i][0] for i in gone})
    return out


def test_line_dedup(spark):
    rng = random.Random(9)
    passage = [words_of(rng, 20) for _ in range(4)]
    filler = lambda n: [words_of(rng, 15) for _ in range(n)]
    short = words_of(rng, 12)
    texts = [
        "\n".join(filler(3) + passage + filler(2)), "\n".join([short] + filler(2) + passage), "\n".join(passage[:2] + filler(1) + passage[2:] + [short]),
        "\n".join(passage[2:] + filler(1) + passage[:2]), "\n".join([short] + filler(1)), None, "", "\n\n \n", "\n".join(passage[:3] + ["", passage[3]] + filler(2)),
        "\n".join(filler(400) + passage + filler(400)), "\n".join(passage * 3),
    ]
    texts.append(texts[0])
    got = {r["doc_id"]: r for r in lines.deduplicated(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), details=True).collect()}
    deleted = brute_deleted(texts, lines.MIN_WORDS)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        kept = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in deleted[i])
        if i == 8:  # a blank line within the block goes along
            assert passage[0] not in got[i]["text"] and passage[3] not in got[i]["text"]
        else:
            assert got[i]["text"] == kept, i
    assert got[11]["n_deleted"] == 9 and got[11]["text"] == ""


def test_line_dedup_repeats_and_ids(spark):
    rng = random.Random(10)
    block, other = "\n".join(words_of(rng, 30) for _ in range(2)), words_of(rng, 60)
    rows = [(1, block, "s"), (1, block, "s"), (1, other, "s"), (None, block, "s"), (2, other + "\ntail", "s")]
    got = sorted((r["doc_id"] or -1, r["text"]) for r in lines.deduplicated(docs(spark, rows)).collect())
    assert got == sorted([(1, block), (1, block), (1, other), (-1, ""), (2, "tail")])
    assert lines.deduplicated(docs(spark, [])).count() == 0


def test_line_dedup_of_a_passage_that_short_common_lines_outvote(spark):
    rng = random.Random(22)
    passage, s1, s2, s3, x, y, z = words_of(rng, 60), *(words_of(rng, n) for n in (3, 4, 5, 6, 7, 8))
    texts = ["\n".join([passage, s1, s2, s3]), "\n".join([s1, x, s2, y, s3, z, passage])]
    got = {r["doc_id"]: r["text"] for r in lines.deduplicated(docs(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert got == {0: texts[0], 1: "\n".join([s1, x, s2, y, s3, z])}


def test_blocks_come_from_the_alignment(monkeypatch):
    passage = list(range(1, 31))
    earlier, later = np.array([90, *passage, 91]), np.array([92, 93, *passage])
    words = np.full(len(later), 2, dtype=np.int32)
    assert lines.common_blocks(earlier, later, words, 50) == [(2, 32)]
    with monkeypatch.context() as patched:
        patched.setattr(lines, "patience", lambda a, b: [])
        assert lines.common_blocks(earlier, later, words, 50) == []
    with monkeypatch.context() as patched:
        # What one alignment leaves, the next takes.
        whole = lines.patience
        patched.setattr(lines, "patience", lambda a, b: whole(a, b)[:7])
        assert lines.common_blocks(earlier, later, words, 50) == [(2, 32)]
    # A block that stands twice in the later document goes twice.
    twice = np.array([*passage, 95, *passage])
    assert lines.common_blocks(earlier, twice, np.full(61, 2, dtype=np.int32), 50) == [(0, 30), (31, 61)]


def test_common_blocks_are_all_shared_runs():
    rng = random.Random(23)
    pool = [words_of(rng, rng.choice([1, 3, 8, 20, 60])) for _ in range(12)]
    for _ in range(400):
        texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 25))) for _ in range(2)]
        (earlier, _), (later, words) = map(lines.line_hashes, texts)
        got = {i for x, y in lines.common_blocks(earlier, later, words, 50) for i in range(x, y)}
        assert got == brute_deleted(texts, 50)[1]


# ---- mixing


def test_mix_small(spark):
    rng = random.Random(11)
    rows = [(i, words_of(rng, rng.randrange(0, 400)), rng.choice(["a", "b", "c", "d", "é", None])) for i in range(300)] + [(500, None, "a"), (None, "x y z", "zz"), (7, "a b", "a"), (7, "a b", "a")]
    table = docs(spark, rows)
    got = mixing.mix(table).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(table.repartition(7)).collect()), key=str)
    sizes = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = sizes.setdefault((r["source_size"], r["target"]), [0, 0])
        s[0] += r["size"]
        s[1] += r["taken"]
    total = sum(s[0] for s in sizes.values())
    assert abs(sum(t for _, t in sizes) - total) < 1e-6 * total
    for (size, target), (own, taken) in sizes.items():
        assert own == size and target <= 3 * size + 1e-9
        assert abs(taken - target) <= 3 * mixing.BLOCK_WORDS
    mixed = mixing.mixed(table)
    assert mixed.columns == table.columns
    out = {}
    for r in mixed.collect():
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + len(r["text"].split())
    want = {}
    for r in got:
        if r["taken"]:
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    assert out == want


def test_shards_are_even_without_ids(spark):
    rows = docs(spark, [(None if i % 3 else i, f"word {i}", "s") for i in range(40_000)])
    sizes, targets, _ = mixing.plan(rows)
    counts = [r["count"] for r in mixing.in_shards(sizes, targets).groupBy("_shard").count().collect()]
    assert len(counts) == 5 and max(counts) < 1.1 * min(counts)


def test_mix_of_nothing(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(docs(spark, [(1, None, None), (2, " ", "a")])).collect()] == [0, 0]
    assert mixing.mixed(docs(spark, [(1, None, None)])).count() == 0


# ---- matroska


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=70_000))
def test_matroska_round_trip(payload):
    found = matroska.parse(matroska.mux(payload))
    data = matroska.mux(payload)
    assert found.damage is None
    assert b"".join(data[p.start: p.end] for p in found.packets) == payload
    assert all(data[at - 4 - 8: at + 8].find(b"\x1f\x43\xb6\x75") >= 0 for _, _, at in found.cues)


def test_matroska_lacing_groups_and_unknown_sizes():
    m = matroska
    frames = [b"a" * 300, b"b" * 5, b"c" * 255, b"d" * 1000]
    xiph = bytes([3]) + b"".join(b"\xff" * (len(f) // 255) + bytes([len(f) % 255]) for f in frames[:-1]) + b"".join(frames)
    flag, ebml = m.laced(frames)
    assert flag == 3
    block = lambda lace, body, time=5: m.size(1) + time.to_bytes(2, "big", signed=True) + bytes([lace << 1]) + body
    group = m.element(m.BLOCK_GROUP, m.element(m.BLOCK, block(1, xiph, -2)), m.element(m.REFERENCE, b"\x01"))
    cluster = m.number(m.CLUSTER) + b"\x01" + b"\xff" * 7 + m.element(m.TIMESTAMP, m.number(1000)) + m.element(m.SIMPLE_BLOCK, block(3, ebml)) + m.element(m.VOID, b"zz") + group
    second = m.element(m.CLUSTER, m.element(m.TIMESTAMP, m.number(2000)), m.element(m.SIMPLE_BLOCK, m.size(200) + b"\x00\x00\x84" + bytes([1]) + b"xxyy"))
    data = m.element(m.EBML) + m.number(m.SEGMENT) + b"\xff" + cluster + second
    found = m.parse(data)
    assert found.damage is None and found.clusters == 2
    assert [(p.track, p.timestamp, p.key, data[p.start: p.end]) for p in found.packets] == (
        [(1, 1005, False, f) for f in frames] + [(1, 998, False, f) for f in frames] + [(200, 2000, True, b"xx"), (200, 2000, True, b"yy")])
    # A cut-off file gives the packets of all blocks before the cut, whether sizes are known or not.
    ends = [end for block, more in ((found.packets[:4], 0), (found.packets[4:8], len(m.element(m.REFERENCE, b"\x01"))), (found.packets[8:], 0)) for end in [block[-1].end + more] * len(block)]
    for cut in range(len(data)):
        part = m.parse(data[:cut])
        assert [(p.start, p.end) for p in part.packets] == [(p.start, p.end) for p, end in zip(found.packets, ends) if end <= cut]


def test_matroska_live_files_keep_what_stands_before_the_cut():
    whole = matroska.mux(bytes(200_000))
    # The same file with a segment and clusters of unknown size.
    live = bytearray(whole)

    def forget_size(at):
        width = 9 - live[at].bit_length()
        live[at: at + width] = bytes([(1 << 9 - width) - 1]) + b"\xff" * (width - 1)
        return at + width

    segment = forget_size(live.index(bytes.fromhex("18538067")) + 4)
    for id, body, end, _ in matroska.elements(whole, segment, len(whole)):
        if id == matroska.CLUSTER:
            forget_size(whole.rindex(bytes.fromhex("1F43B675"), 0, body) + 4)
    every = matroska.parse(whole).packets
    assert matroska.parse(bytes(live)).packets == every and len(every) == -(-200_000 // 512)
    for cut in (segment + 1, 70_000, 150_000, 150_300, len(whole) - 1):
        want = matroska.parse(whole[:cut]).packets
        assert matroska.parse(bytes(live[:cut])).packets == want
        # Every block of which the cut has left all frames.
        assert {p.end for p in want} <= {p.end for p in every if p.end <= cut} and len(want) >= sum(p.end <= cut for p in every) - 8


def test_matroska_tables(spark):
    texts = [None, "", "é" * 40, "x" * 200_000, "x" * 64]
    rows = docs(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(2, texts[2], "s")])
    got = {r["doc_id"]: r for r in matroska.read_back(matroska.stored(rows)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        whole = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-64:]))
        assert r["damage"] is None
    table = matroska.packets(matroska.stored(rows).where("doc_id = 3")).orderBy("packet").collect()
    assert len(table) == -(-200_000 // 512) and table[0]["timestamp"] == 0 and table[-1]["timestamp"] > 20 * 10**9
    null = matroska.read_back(spark.createDataFrame([(1, 5, None)] * 2, "doc_id long, n_bytes long, media binary")).collect()
    assert [(r["payload_bytes"], r["media_bytes"], r["damage"]) for r in null] == [(0, 0, None)] * 2
    empty = spark.createDataFrame([(1, None), (2, b"junk")], "doc_id long, media binary")
    assert [(r["packet"], r["damage"] is None) for r in matroska.packets(empty).orderBy("doc_id").collect()] == [(None, True), (None, False)]
    assert matroska.read_back(matroska.stored(docs(spark, []))).count() == 0


# ---- neighbours


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 1, 2.0) for r in rows], f"vec_id long, embedding array<{kind}>, rank int, score double")


def brute_nearest(rows, wanted, k):
    good = sorted({(i, tuple(map(float, np.float32(v)))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)})
    out = []
    for q, v in good:
        if wanted(q):
            best = {}
            for i, w in good:
                if i != q:
                    s = float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum()))
                    best[i] = min(best.get(i, s), s)
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted((s, i) for i, s in best.items())[:k])]
    return sorted(out)


def test_neighbours(spark):
    rng = np.random.default_rng(12)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(8))]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(2000, [0.0] * 8), (2100, None), (2200, [float("nan")] * 8), (2300, [None] * 8), (None, rows[5][1]), (2400, [float("inf")] + [1.0] * 7)] + [rows[0], rows[200]]
    got = neighbours.search(vectors(spark, rows), F.col("_id") % 100 == 0, small=16, cell=64).collect()
    want = brute_nearest(rows, lambda q: q % 100 == 0, 10)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == want
    assert neighbours.search(vectors(spark, []), F.col("_id") % 100 == 0).count() == 0
    few = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])]
    got = neighbours.search(vectors(spark, few, "double"), F.col("_id") == 0).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 2), (2, 1)]


def test_neighbour_recall(spark):
    rng = np.random.default_rng(13)
    centres = rng.standard_normal((40, 24))
    points = centres[rng.integers(0, 40, 4000)] + 0.4 * rng.standard_normal((4000, 24))
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(points)]
    got = neighbours.search(vectors(spark, rows), F.col("_id") % 100 == 0, reach=800, small=32).collect()
    want = brute_nearest(rows, lambda q: q % 100 == 0, 10)
    hits = {(r["query_id"], r["vec_id"]) for r in got} & {(q, i) for q, _, i, _ in want}
    assert len(hits) >= 0.9 * len(want)


def test_reach_grows_with_the_table_and_enters_every_tree():
    assert [neighbours.needed(n) for n in (0, 30_000, 51_282, 3_000_000)] == [24_000, 24_000, 25_641, 1_500_000]
    points = np.random.default_rng(14).standard_normal((2000, 16))
    forest = neighbours.plant(points, 16, 32)
    held = [np.bincount(neighbours.leaves_of(t, points), minlength=int((t.left < 0).sum())) for t in forest]
    assert {t for t, _ in neighbours.reached(forest, held, points[0], 1)} == set(range(16))
    reach = int(neighbours.SHARE * len(points))
    found = neighbours.reached(forest, held, points[0], reach)
    assert sum(held[t][leaf] for t, leaf in found) >= reach
