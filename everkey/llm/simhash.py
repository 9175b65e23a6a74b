"""SimHash near-duplicates under the generalised pigeonhole principle.

Fingerprints are grouped by value; only distinct ones are compared.  Their 64 bits are dealt into partitions, correlated
bits together, and each partition gets a threshold of its own.  If the thresholds plus one add up to the distance plus
one, any two fingerprints within the distance are within the threshold in some partition.  The thresholds are those that a
dynamic programme finds cheapest by the expected numbers of probes and candidates, over two to five partitions: narrow
partitions need few probes, wide ones have candidates whose number grows slower.

A threshold t is probed from both sides: one side takes the values within t // 2 of its own, the other those within the
rest, and they meet half way.  So a partition of 32 bits needs 33 probes for threshold 2, where one-sided probing needs
529.  Of the ways two fingerprints can meet, one is chosen, and they are compared in full right there.

A probe value that more than ``CROWD`` fingerprints share is not paired.  Its fingerprints are spread over all values
within half the distance of their own: those that meet there are within the distance of each other by the triangle
inequality, so linking each to the smallest loses nothing and needs no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.joins import grouped
from ..session import written
from .batches import batch, pieces
from .components import components
from .copies import keyed_rows, stay_of
from .shipping import ship

DISTANCE = 4
SHINGLE = 4
SEED = 42
#: Fingerprints that share a probe value and are still compared in pairs.
CROWD = 256
#: Cost of a chance meeting of two fingerprints at a probe value, in probes.
MEETING = 4.0
#: Fewer fingerprints are planned as if they were this many, so that the plan does not turn over as they grow.
PLANNED = 1 << 20
#: Shingles hashed at a time, so that a very long text needs little memory.
SLICE = 1 << 16


def fingerprint(text: str | None) -> int:
    """Bits set in over half of the hashes of a text's shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1:]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), SLICE):
        pairs = zip(starts[at: at + SLICE].tolist(), ends[at: at + SLICE].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``_id, _print`` for each row; the fingerprint as a signed 64-bit number."""
    ship(documents.sparkSession)
    schema = pa.schema([("_id", pa.int64()), ("_print", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = np.array([fingerprint(t) for t in piece.column(1).to_pylist()], dtype="<u8").view("<i8")
            yield batch(schema, piece.column(0), found)

    return documents.select(F.col(id).cast("long"), F.col(text)).mapInArrow(run, "_id long, _print long")


def keyed_fingerprints(rows: DataFrame) -> DataFrame:
    """``_none, _id, _tie, _print`` for each row of ``copies.keyed_rows``."""
    ship(rows.sparkSession)
    schema = pa.schema([("_none", pa.bool_()), ("_id", pa.int64()), ("_tie", pa.int64()), ("_print", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = np.array([fingerprint(t) for t in piece.column(3).to_pylist()], dtype="<u8").view("<i8")
            yield batch(schema, *piece.columns[:3], found)

    return rows.select("_none", "_id", "_tie", F.col("_row.text").alias("text")).mapInArrow(run, "_none boolean, _id long, _tie long, _print long")


# ---- where the bits go, and which thresholds they get


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have each two bits set: 64 x 64 sums over all of them."""
    schema = pa.schema([("cell", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((64, 64)), 0
        for piece in pieces(batches, 1 << 14):
            own = np.ascontiguousarray(piece.column(0).to_numpy(zero_copy_only=False)).astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(own, axis=1, bitorder="little").astype(np.float32)
            sums += bits.T @ bits
            rows += len(bits)
        if rows:
            yield batch(schema, np.arange(4097, dtype=np.int32), np.append(sums.reshape(-1), rows).astype(np.int64))

    cells = prints.select("_print").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(4097)
    for c in cells:
        flat[c["cell"]] = c["n"]
    return int(flat[4096]), flat[:4096].reshape(64, 64)


def correlations(n: int, both: np.ndarray) -> np.ndarray:
    share = both / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    return np.abs(np.divide(share - np.outer(p, p), spread, out=np.zeros_like(share), where=spread > 0))


def grouped_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size; a group grows by the bit most correlated with those it has."""
    left, out = set(range(64)), []
    corr = corr - np.diag(np.diag(corr))
    for k in range(parts, 0, -1):
        size = round(len(left) / k)
        first = max(sorted(left), key=lambda b: max((corr[b, c] for c in left if c != b), default=0))
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(sorted(left), key=lambda b: corr[b, group].sum())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def equal_by_chance(p: np.ndarray, corr: np.ndarray, bits: list[int]) -> float:
    """Chance that two fingerprints agree in all of the bits.  Correlation counts as fewer bits."""
    rho = corr[np.ix_(bits, bits)]
    mean = (rho.sum() - np.trace(rho)) / max(len(bits) * (len(bits) - 1), 1)
    own = max(1, round(len(bits) / (1 + (len(bits) - 1) * mean ** 2)))
    differ = np.sort(2 * p[bits] * (1 - p[bits]))[::-1][:own]
    return float(np.prod(1 - differ))


def ball(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1)) if radius >= 0 else 0


def allocate(n: int, both: np.ndarray, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed.  Thresholds plus one add up to the distance plus one."""
    corr, p = correlations(n, both), np.diag(both) / max(n, 1)
    n = max(n, PLANNED)
    best, chosen = None, None
    for parts in range(2, 6):
        groups = grouped_bits(corr, parts)
        # cheapest[s]: lowest cost, and thresholds, of the groups so far whose thresholds plus one add up to s
        cheapest = {0: (0.0, [])}
        for bits in groups:
            chance, step = equal_by_chance(p, corr, bits), {}
            for s, (cost, so_far) in cheapest.items():
                for t in range(-1, distance - s + 1):
                    around = ball(len(bits), (t + 1) // 2)
                    # Either side brings its whole ball, so two meet at a value by chance as often as any two values of them are equal.
                    more = 0.0 if t < 0 else n * around + MEETING * n * n / 2 * around * around * chance
                    if s + t + 1 not in step or cost + more < step[s + t + 1][0]:
                        step[s + t + 1] = (cost + more, so_far + [t])
            cheapest = step
        cost, thresholds = cheapest[distance + 1]
        if best is None or cost < best:
            best, chosen = cost, [(b, t) for b, t in zip(groups, thresholds) if t >= 0]
    return chosen


# ---- probing and verifying


def flips(bits: list[int], radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(bits, r)], dtype=np.uint64)


def probes(prints: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``part, value, flip, print``: every probe value of every fingerprint, and the bits flipped to get there."""
    schema = pa.schema([("part", pa.int32()), ("value", pa.int64()), ("flip", pa.int64()), ("print", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = [(k, np.uint64(sum(1 << b for b in bits)), flips(bits, (t + 1) // 2)) for k, (bits, t) in enumerate(plan)]
        for piece in pieces(batches, 1 << 9):
            own = np.ascontiguousarray(piece.column(0).to_numpy(zero_copy_only=False)).astype("<i8").view("<u8")
            for k, mask, flip in around:
                values = ((own & mask)[:, None] ^ flip[None, :]).reshape(-1)
                yield batch(schema, np.full(len(values), k, np.int32), values.view("<i8"), np.tile(flip, len(own)).view("<i8"), np.repeat(own, len(flip)).view("<i8"))

    return prints.select("_print").mapInArrow(run, "part int, value long, flip long, print long")


def spread_out(crowded: DataFrame, distance: int) -> DataFrame:
    """``value, print``: every value within half the distance of each fingerprint."""
    schema = pa.schema([("value", pa.int64()), ("print", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flip = flips(list(range(64)), distance // 2)
        for piece in pieces(batches, 32):
            own = np.ascontiguousarray(piece.column(0).to_numpy(zero_copy_only=False)).astype("<i8").view("<u8")
            yield batch(schema, (own[:, None] ^ flip[None, :]).reshape(-1).view("<i8"), np.repeat(own, len(flip)).view("<i8"))

    return crowded.mapInArrow(run, "value long, print long")


def links(prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints within ``distance``: all of them, but among crowded ones only as many
    as keep the same fingerprints connected.  ``distance`` must be even."""
    if distance % 2:
        raise ValueError("the distance must be even, so that half of it can be probed from both sides")
    ship(prints.sparkSession)
    plan = allocate(*bit_counts(prints), distance)
    shared = Window.partitionBy("part", "value")
    met = written(probes(prints, plan).withColumn("n", F.count("*").over(shared)).where("n > 1"), "simhash-met")
    few = met.where(F.col("n") <= crowd)
    a = few.select("part", "value", F.col("flip").alias("fa"), F.col("print").alias("a"))
    b = few.select("part", "value", F.col("flip").alias("fb"), F.col("print").alias("b"))
    threshold = F.element_at(F.array(*[F.lit(t) for _, t in plan]), F.col("part") + 1)
    na, nb = F.bit_count("fa"), F.bit_count("fb")
    once = (
        (F.col("a") != F.col("b")) & (F.col("fa").bitwiseAND(F.col("fb")) == 0) & (na + nb <= threshold)
        & (((nb - na == 1) & (F.col("a") < F.col("b"))) | ((na == nb) & ((F.col("fa") < F.col("fb")) | ((F.col("fa") == F.col("fb")) & (F.col("a") < F.col("b"))))))
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    direct = a.join(b, ["part", "value"]).where(once & near).select("a", "b")
    crowded = written(met.where(F.col("n") > crowd).select("print").distinct(), "simhash-crowded")
    around = spread_out(crowded, distance)
    least = Window.partitionBy("value")
    star = around.withColumn("least", F.min("print").over(least)).where("print <> least").select(F.col("print").alias("a"), F.col("least").alias("b"))
    return direct.union(star).distinct()


def near_duplicates(documents: DataFrame, distance: int = DISTANCE, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row.

    ``component_id`` is the smallest id that can be reached over links, the row's own included.  Null, empty and blank
    texts have fingerprint zero and link like any other; a null id takes part but never names a component, and one
    whose members have only null ids has a null name.  Repeated rows stay.  An empty table gives no rows; other columns
    are not touched.
    """
    every = written(fingerprints(documents, text, id), "simhash-prints")
    distinct = written(every.groupBy("_print").agg(F.min("_id").alias("_first")), "simhash-distinct")
    roots = components(links(distinct, distance))
    named = distinct.join(roots, distinct["_print"] == roots["node"], "left").select("_print", "_first", F.coalesce("root", "_print").alias("_root"))
    lowest = grouped(named, ["_root"], F.min("_first").alias("_component"))
    components_of = written(named.join(lowest, "_root").select(F.col("_print").alias("_p"), "_component"), "simhash-components")
    return every.join(components_of, F.col("_print") == F.col("_p")).select(
        F.col("_id").alias(id), F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), F.col("_component").alias("component_id"))


def one_of_each(documents: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``documents`` that stay: of each component the one with the smallest id.

    A row without an id stands behind all ids, by the hash of its text.  Of rows that share the id that stays, the one
    whose text hashes lowest stays.
    """
    columns = documents.columns
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    id = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1) - F.pmod(key, F.lit(1 << 61)))
    named = documents.select(F.struct(*[F.col(c) for c in columns]).alias("_row"), id.alias("_id"), key.alias("_tie"))
    groups = near_duplicates(named.select("_id", F.col("_row.text").alias("text")), distance, id="_id").select(F.col("component_id").alias("_c")).distinct()
    kept = named.join(groups.hint("merge"), F.col("_id") == F.col("_c"), "left_semi")
    first = Window.partitionBy("_id").orderBy("_tie")
    return kept.withColumn("_place", F.row_number().over(first)).where("_place = 1").select(*[F.col("_row")[c].alias(c) for c in columns])


def first_rows(documents: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``documents`` that stay: one of each component, chosen row by row as in ``copies.one_of_each``.

    Unlike :func:`one_of_each` two texts under one id are two rows, and neither is lost for the other's links.
    """
    keyed = keyed_rows(documents)
    every = written(keyed_fingerprints(keyed), "simhash-keyed")
    distinct = written(every.groupBy("_print").agg(F.min(F.struct("_none", "_id", "_tie")).alias("_first")), "simhash-first")
    roots = components(links(distinct, distance))
    named = distinct.join(roots, distinct["_print"] == roots["node"], "left").select("_first", F.coalesce("root", "_print").alias("_root"))
    return stay_of(keyed, named, documents.columns, "simhash-stay")
