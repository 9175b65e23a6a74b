"""Line dedup by pairwise alignment.

A line is told by its hash.  For every line the shortest run of lines that begins, or ends, there and has at least
``MIN_WORDS`` words is hashed as well: runs are rare where single lines are not, and two documents share a run exactly
if they share a block of that length.  Every document that holds a run is paired with the first that holds it, so a
passage in k documents makes k - 1 pairs, not k * k.  Each pair is aligned by patience diff over the hashes of the lines in
runs that both hold, so that short common lines elsewhere can't outvote a block: lines that stand once in either document
and in both, the longest increasing sequence among them, and the same again between those.  What is aligned goes from the
later document, and the alignment is repeated on what is left of the shared runs until nothing is.  All alignments look at
the whole original documents, and the first holder of a run keeps it: no passage is lost from all documents.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..functions.joins import grouped
from ..session import written
from .batches import batch, pieces
from .shipping import ship

MIN_WORDS = 50
#: Hash of a line without words; it never matches.
BLANK = 0


# ---- one document


def line_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of words of each line; blanks at the ends and between words don't count."""
    rows = [line.split() for line in (text or "").split("\n")]
    hashes = [xxhash.xxh64_intdigest(" ".join(w).encode("utf-8", "surrogatepass")) or 1 if w else BLANK for w in rows]
    return np.array(hashes, dtype="<u8").view("<i8"), np.array([len(w) for w in rows], dtype=np.int32)


def shortest_runs(words: np.ndarray, least: int) -> set[tuple[int, int]]:
    """(first, end) of the shortest runs with ``least`` words that begin or end at each line."""
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    n = len(words)
    begins = np.arange(n)
    ends = np.searchsorted(total, total[:-1] + least)
    runs = {(int(a), int(b)) for a, b in zip(begins[ends <= n], ends[ends <= n])}
    starts = np.searchsorted(total, total[1:] - least, side="right") - 1
    return runs | {(int(a), int(b) + 1) for a, b in zip(starts[starts >= 0], begins[starts >= 0])}


def run_hashes(hashes: np.ndarray, words: np.ndarray, least: int) -> np.ndarray:
    """Hashes of the shortest runs with ``least`` words that begin or end at each line.  Blank lines are passed over."""
    full = np.flatnonzero(hashes != BLANK)
    data = hashes[full].tobytes()
    return np.array(sorted({xxhash.xxh64_intdigest(data[8 * a: 8 * b]) for a, b in shortest_runs(words[full], least)}), dtype="<u8").view("<i8")


# ---- two documents


def _increasing(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by piles."""
    tops, pile_of, under = [], [], []
    for i, place in enumerate(places):
        k = bisect_left(tops, place)
        under.append(pile_of[k - 1] if k else -1)
        if k == len(tops):
            tops.append(place)
            pile_of.append(i)
        else:
            tops[k], pile_of[k] = place, i
    out, i = [], pile_of[-1] if pile_of else -1
    while i >= 0:
        out.append(i)
        i = under[i]
    return out[::-1]


def _numbered(lines: list, low: int, high: int) -> dict:
    """Line and how often it came before -> place."""
    seen: dict = {}
    out = {}
    for i in range(low, high):
        k = seen.get(lines[i], 0)
        seen[lines[i]] = k + 1
        out[(lines[i], k)] = i
    return out


def _once(lines: list, low: int, high: int) -> dict:
    seen: dict = {}
    for i in range(low, high):
        seen[lines[i]] = -1 if lines[i] in seen else i
    return {line: i for line, i in seen.items() if i >= 0}


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two lists of lines, in order.  A line that is ``None`` matches nothing.

    Between unique common lines the work goes on in the gaps.  In a gap without any, the first, second .. copies of
    repeated lines count as unique.
    """
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b), False)]
    while gaps:
        alo, ahi, blo, bhi, last = gaps.pop()
        while alo < ahi and blo < bhi and a[alo] is not None and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] is not None and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo >= ahi or blo >= bhi:
            continue
        unique = _numbered if last else _once
        left, right = unique(a, alo, ahi), unique(b, blo, bhi)
        common = sorted((left[k], right[k]) for k in left.keys() & right.keys() if (k[0] if last else k) is not None)
        chosen = [common[i] for i in _increasing([j for _, j in common])]
        if not chosen:
            if not last:
                gaps.append((alo, ahi, blo, bhi, True))
            continue
        before = (alo, blo)
        for i, j in chosen:
            out.append((i, j))
            gaps.append((before[0], i, before[1], j, last))
            before = (i + 1, j + 1)
        gaps.append((before[0], ahi, before[1], bhi, last))
    return sorted(out)


def in_shared_runs(a: list, b: list, words: list[int], least: int) -> list[bool]:
    """Which lines of ``b`` lie in a run of at least ``least`` words that ``a`` holds too.  A ``None`` is in no run.

    Any shared run is made of shortest ones, those that begin and those that end at each of its lines.
    """
    words_of = {line: n for line, n in zip(b, words) if line is not None}

    def runs(own: list) -> list[tuple[int, int, tuple]]:
        full, out = np.array([x is not None for x in own], dtype=bool), []
        edges = np.flatnonzero(np.diff(np.concatenate(([0], full.astype(np.int8), [0])))).tolist()
        for low, high in zip(edges[::2], edges[1::2]):
            some = shortest_runs(np.array([words_of[x] for x in own[low:high]], dtype=np.int64), least)
            out += [(low + x, low + y, tuple(own[low + x: low + y])) for x, y in some]
        return out

    held, shared = {lines for _, _, lines in runs(a)}, np.zeros(len(b) + 1, np.int64)
    for x, y, lines in runs(b):
        if lines in held:
            shared[x] += 1
            shared[y] -= 1
    return (np.cumsum(shared)[:-1] > 0).tolist()


def common_blocks(earlier: np.ndarray, later: np.ndarray, words: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches (first, end) of lines of ``later`` that stand in ``earlier`` in blocks of at least ``least`` words.

    Only lines in runs that both documents hold can be anchors.  What patience diff aligns among those goes and is taken
    out, and the rest is aligned again, until no line of a shared run is left.  Blank lines neither break nor make a block.
    """
    mine = [i for i, h in enumerate(later.tolist()) if h != BLANK]
    b: list = [int(later[i]) for i in mine]
    size_of = dict(zip(b, words[mine].tolist()))
    a: list = [h if h in size_of else None for h in earlier.tolist() if h != BLANK]
    held = set(a)
    b = [h if h in held else None for h in b]
    sizes = lambda lines: [size_of.get(h, 0) for h in lines]
    anchors = [h for h, shared in zip(a, in_shared_runs(b, a, sizes(a), least)) if shared]
    left = [j for j, shared in enumerate(in_shared_runs(a, b, sizes(b), least)) if shared]
    gone = np.zeros(len(b) + 2, dtype=np.int8)
    while left:
        aligned = {j for _, j in patience(anchors, [b[j] for j in left])}
        if not aligned:
            break
        gone[[left[j] + 1 for j in aligned]] = 1
        left = [j for k, j in enumerate(left) if k not in aligned]
        wanted = {b[j] for j in left}
        anchors = [h for h in anchors if h in wanted]
    edges = np.flatnonzero(np.diff(gone)).tolist()
    return [(mine[x], mine[y - 1] + 1) for x, y in zip(edges[::2], edges[1::2])]


# ---- all documents


def hashed(documents: DataFrame, least: int) -> DataFrame:
    """``_id, _text_hash, hashes, words, runs`` for each document with a run."""
    ship(documents.sparkSession)
    schema = pa.schema([("_id", pa.int64()), ("_tie", pa.int64()), ("hashes", pa.list_(pa.int64())), ("words", pa.list_(pa.int32())), ("runs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            kept: list[list] = [[], [], [], [], []]
            for id, tie, text in zip(*(c.to_pylist() for c in piece.columns)):
                hashes, words = line_hashes(text)
                runs = run_hashes(hashes, words, least)
                if len(runs):
                    for column, value in zip(kept, (id, tie, hashes, words, runs)):
                        column.append(value)
            yield batch(schema, *kept)

    return documents.select("_id", "_tie", "text").mapInArrow(run, "_id long, _tie long, hashes array<long>, words array<int>, runs array<long>")


def aligned(pairs: DataFrame, least: int) -> DataFrame:
    """``_id, _tie, first, end`` of each block that goes, for pairs of documents with their line hashes."""
    ship(pairs.sparkSession)
    schema = pa.schema([("_id", pa.int64()), ("_tie", pa.int64()), ("first", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            out: list[list] = [[], [], [], []]
            for id, tie, words, later, earlier in zip(*(c.to_pylist() for c in piece.columns)):
                for first, end in common_blocks(np.array(earlier), np.array(later), np.array(words), least):
                    for column, value in zip(out, (id, tie, first, end)):
                        column.append(value)
            yield batch(schema, *out)

    return pairs.select("_id", "_tie", "words", "later", "earlier").mapInArrow(run, "_id long, _tie long, first int, end int")


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.withColumns({"_id": F.col("doc_id").cast("long"), "_tie": F.xxhash64(F.coalesce("text", F.lit("")))})


def blocks(documents: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``_id, _tie, firsts, ends``: the blocks to delete from each document that has any.

    Documents are ordered by id, nulls last, then by the hash of their text; equal rows are one document.
    """
    lines = written(hashed(_keyed(documents.select("doc_id", "text")), least), "lines-hashed")
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_tie").alias("tie"))
    holders = lines.select(place.alias("at"), F.explode("runs").alias("run"))
    first = grouped(holders, ["run"], F.min("at").alias("from"), F.max("at").alias("upto")).where("from <> upto").select("run", "from")
    pairs = written(holders.join(first, "run").where("at <> from").select("from", "at").distinct(), "lines-pairs")
    one = lines.select(place.alias("at"), "hashes", "words").dropDuplicates(["at"])
    with_later = pairs.join(one.select(F.col("at"), F.col("hashes").alias("later"), "words"), "at")
    with_both = with_later.join(one.select(F.col("at").alias("from"), F.col("hashes").alias("earlier")), "from")
    ready = with_both.select(F.col("at.id").alias("_id"), F.col("at.tie").alias("_tie"), "words", "later", "earlier")
    found = aligned(ready, least)
    return found.groupBy("_id", "_tie").agg(F.collect_set(F.struct("first", "end")).alias("gone"))


def deduplicated(documents: DataFrame, least: int = MIN_WORDS, details: bool = False) -> DataFrame:
    """``documents`` without the lines that earlier documents hold as blocks of at least ``least`` words.

    Columns, rows and untouched texts stay as they are; ``n_chars``, if there, follows the text.  With ``details``,
    ``n_lines`` and ``n_deleted`` (lines before, lines deleted) are added.  Null, empty and blank texts hold no block and
    stay; an empty table gives no rows.  Equal rows are one document and keep or lose the same lines.
    """
    columns = documents.columns
    gone = written(blocks(documents, least), "lines-gone").select(F.col("_id").alias("_i"), F.col("_tie").alias("_t"), F.col("gone").alias("_gone"))
    whole = F.struct(*[F.col(c) for c in columns]).alias("_row")
    keyed = documents.select(whole, F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_tie"))
    # A merge join at every size: what is deleted grows with the documents, so it is never sent to all tasks.
    found = keyed.join(gone.hint("merge"), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_tie") == F.col("_t")), "left")
    rows = F.split("_row.text", "\n", -1)
    stays = F.transform(F.filter(F.transform(rows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                                 lambda s: ~F.exists("_gone", lambda g: (g["first"] <= s["i"]) & (s["i"] < g["end"]))), lambda s: s["x"])
    hit = F.col("_gone").isNotNull()
    found = found.withColumn("_kept", F.when(hit, stays))
    left = F.array_join("_kept", "\n")
    new = {"text": F.when(hit, left).otherwise(F.col("_row.text"))}
    if "n_chars" in columns:
        new["n_chars"] = F.when(hit, F.length(left).cast("long")).otherwise(F.col("_row.n_chars"))
    total = F.coalesce(F.when(F.col("_row.text").isNotNull(), F.size(rows)), F.lit(0))
    extra = [total.cast("long").alias("n_lines"), F.when(hit, total - F.size("_kept")).otherwise(0).cast("long").alias("n_deleted")] if details else []
    return found.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in columns], *extra)
