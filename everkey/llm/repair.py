"""Structure repair of damaged conversations, by ``auction``.

A conversation's turns are dealt into stretches of ``STRETCH``, each an independent task: its price lattice needs the costs
that follow its last states, and the state it begins in.  Where a conversation has one stretch both are known.  For longer
ones each stretch first gives the costs from each state to each; these sixteen numbers a stretch make a lattice of
stretches, which is solved by the same auction and yields the costs that follow each; then every stretch is traced from
each state it could begin in, and the traces are strung together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.joins import grouped
from ..session import written
from . import auction
from .batches import PIECE, batch, groups
from .placing import in_order, with_places
from .shipping import ship

#: Turns in a stretch.
STRETCH = 128
KEY = ["_none", "_conv"]
#: Fixed values of the contract.
FAULTS, DROPPED, EMPTIED, STRIPPED, REPEATED, REROLED = 20, 0, 1, 2, 3, 4
ENDS = "[.!?]"
FULL = r"[^\x20\x09-\x0D]"
COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
LEGAL = ("su", "ua", "au")
NOTHING = hashlib.sha256(b"").hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """``_none, _conv, _turn, _role, _text`` of the rows that are left; repeated ones stand twice."""
    space = F.lit(" ")
    fault = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % FAULTS
    text = F.coalesce("text", space)
    rows = conversations.select(
        F.col("conv_id").isNull().alias("_none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("_conv"), F.col("turn").cast("long").alias("_turn"),
        F.when(fault == REROLED, "user").otherwise(F.coalesce("role", space)).alias("_role"),
        F.when(fault == EMPTIED, "").when(fault == STRIPPED, F.regexp_replace(text, ENDS, "")).otherwise(text).alias("_text"),
        fault.alias("_fault")).where(F.col("_fault") != DROPPED)
    times = F.when(F.col("_fault") == REPEATED, 2).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_fault", "_copy")


def judged(rows: DataFrame, stretch: int) -> DataFrame:
    """Turns in order with their first fault, written: ``_blank, _again, _cut`` with ``_stretch`` and ``_place``."""
    order = [F.col(k) for k in KEY] + [F.col("_turn").asc_nulls_first(), F.col("_role").asc(), F.col("_text").asc()]
    placed = with_places(in_order(rows, order, [*KEY, "_turn", "_role", "_text"], "repair-turns"), KEY)
    same = F.sha2(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"), 256)
    told = placed.withColumn("_same", same)
    first = grouped(told, [*KEY, "_same"], F.min("_place").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select(*KEY, "_same", "_first")
    found = told.join(first, [*KEY, "_same"], "left")
    blank = ~F.col("_text").rlike(FULL)
    again = ~blank & F.coalesce(F.col("_place") > F.col("_first"), F.lit(False))
    # The last character that is not white space.
    cut = ~blank & ~again & ~F.regexp_extract("_text", rf"({FULL})[\x20\x09-\x0D]*\z", 1).rlike(ENDS)
    return written(found.select(*KEY, "_turn", "_role", "_text", "_place", F.floor(F.col("_place") / stretch).cast("long").alias("_stretch"),
                                blank.alias("_blank"), again.alias("_again"), cut.alias("_cut")), "repair-judged")


def _in_stretches(rows: DataFrame) -> DataFrame:
    """The turns of each stretch one after the other, in order, in one task."""
    return rows.repartition(*KEY, "_stretch").sortWithinPartitions(*KEY, "_stretch", "_place")


def _edited(row: tuple) -> tuple[str, bool, bool]:
    """Initial, must go and cut off, of ``_role, _blank, _again, _cut``."""
    role, blank, again, cut = row
    return role[:1], blank or again, cut


def costs(rows: DataFrame) -> DataFrame:
    """``_stretch, _costs``: the sixteen costs of each stretch."""
    schema = pa.schema([("_none", pa.bool_()), ("_conv", pa.int64()), ("_stretch", pa.int64()), ("_costs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, turns in groups(batches, 3):
            yield batch(schema, *[[k] for k in key], [[c for row in auction.transitions([_edited(t) for t in turns]) for c in row]])

    return _in_stretches(rows).select(*KEY, "_stretch", "_role", "_blank", "_again", "_cut").mapInArrow(run, "_none boolean, _conv long, _stretch long, _costs array<long>")


def after(stretches: DataFrame) -> DataFrame:
    """``_stretch, _ends``: what follows each stretch, from the costs of all stretches of its conversation."""
    schema = pa.schema([("_none", pa.bool_()), ("_conv", pa.int64()), ("_stretch", pa.int64()), ("_ends", pa.list_(pa.int64()))])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_stretch")
        grids = [[c[k:k + auction.STATES] for k in range(0, len(c), auction.STATES)] for c in table["_costs"].to_pylist()]
        return pa.Table.from_batches([batch(schema, *[table[k].combine_chunks() for k in (*KEY, "_stretch")], auction.Chain(grids).costs_after())])

    return stretches.groupBy(*KEY).applyInArrow(run, "_none boolean, _conv long, _stretch long, _ends array<long>")


def traced(rows: DataFrame) -> DataFrame:
    """One row for each stretch and state it may begin in: the counts, letters, cost, state at its end, and the repaired text.

    ``rows`` carry ``_ends``, null in conversations of one stretch, which begin in one state only.
    """
    ship(rows.sparkSession)
    names = [*KEY, "_stretch", "_state", "_to", "_blanks", "_repeats", "_cuts", "_illegal", "_cost", "_left", "_right", "_letters", "_repaired", "_any"]
    types = [pa.bool_(), *[pa.int64()] * 9, *[pa.string()] * 4, pa.bool_()]
    schema = pa.schema(list(zip(names, types)))

    def solved(key: tuple, rows: list[tuple]) -> Iterator[list]:
        turns, told, ends = [r[:2] for r in rows], [_edited((r[0], *r[2:5])) for r in rows], rows[0][5]
        counts = [sum(r[c] for r in rows) for c in (2, 3, 4)]
        illegal = sum(a[0] + b[0] not in LEGAL for a, b in zip(told, told[1:]))
        for state in range(auction.STATES) if ends else [auction.NEW]:
            lattice = auction.Lattice(told, tuple(ends) if ends else auction.WHOLE)
            if state not in lattice.open or lattice.settle(state) == auction.INF:
                continue
            letters, to = lattice.trace(state)
            fixed = auction.repaired(turns, letters, state)
            yield [*key, state, to, *counts, illegal, int(lattice.price[state]), told[0][0], told[-1][0], letters, "\n".join(f"{role}:{text}" for role, text in fixed), bool(fixed)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        for key, rows in groups(batches, 3):
            out += solved(key, rows)
            if len(out) >= PIECE:
                yield batch(schema, *zip(*out))
                out = []
        if out:
            yield batch(schema, *zip(*out))

    kinds = ["boolean", *["long"] * 9, *["string"] * 4, "boolean"]
    ordered = _in_stretches(rows).select(*KEY, "_stretch", "_role", "_text", "_blank", "_again", "_cut", "_ends")
    return ordered.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def strung(stretches: DataFrame) -> DataFrame:
    """``_none, _conv``, counts, ``audit`` and ``repaired_sha256`` of each conversation from its traced stretches.

    A conversation's stretches pass through a task in order, one at a time.
    """
    schema = pa.schema([("_none", pa.bool_()), ("_conv", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    names = [*KEY, "_stretch", "_state", "_to", "_blanks", "_repeats", "_cuts", "_illegal", "_cost", "_left", "_right", "_letters", "_repaired", "_any"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        for piece in batches:
            out: list[list] = [[] for _ in schema.names]

            def close() -> None:
                for column, value in zip(out, [*key, *sums, "".join(letters), digest.hexdigest()]):
                    column.append(value)

            for row in zip(*(piece.column(c).to_pylist() for c in names)):
                none, conv, stretch, begins, to, blanks, repeats, cuts, illegal, cost, left, right, some, text, any_ = row
                if (none, conv) != key:
                    if key is not None:
                        close()
                    key, state, at, before, sums, letters, digest, begun = (none, conv), auction.NEW, -1, None, [0] * 5, [], hashlib.sha256(), False
                if begins != state or stretch == at:
                    continue
                if at < 0:
                    sums[4] = cost
                sums[:4] = [sums[0] + blanks, sums[1] + repeats, sums[2] + cuts, sums[3] + illegal + (before is not None and before + left not in LEGAL)]
                letters.append(some)
                if any_:
                    digest.update((("\n" if begun else "") + text).encode("utf-8", "surrogatepass"))
                    begun = True
                state, at, before = to, stretch, right
            yield batch(schema, *out)
        if key is not None:
            yield batch(schema, *[[v] for v in [*key, *sums, "".join(letters), digest.hexdigest()]])

    ddl = "_none boolean, _conv long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return stretches.select(*names).repartition(*KEY).sortWithinPartitions(*KEY, "_stretch", "_state").mapInArrow(run, ddl)


def repair(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Every original ``conv_id`` with the faults of its damaged rows, the cost and letters of its cheapest repair, and the
    hash of the repaired conversation, as the contract of ``op13`` has them.

    Null roles and texts are one space, as null ids and turns are in the key of the damage; rows without id are one
    conversation, with a null ``conv_id``.  Rows of one turn go by role, then text; repeated rows are duplicates.  A
    conversation of which nothing is left gives zeros, no letters and the hash of nothing.  An empty table gives no rows;
    other columns are not touched.
    """
    ship(conversations.sparkSession)
    rows = judged(damaged(conversations), stretch)
    held = rows.groupBy(*KEY).agg(
        (F.max("_turn") - F.min("_turn") + 1 - F.count_distinct("_turn")).alias("gaps"), F.max("_stretch").alias("_most"))
    held = written(held, "repair-held")
    long = held.where("_most > 0").select(F.struct(*KEY).alias("_by")).select("_by.*")
    pieces = rows.join(long, KEY, "left_semi")
    ends = written(after(costs(pieces)), "repair-ends")
    ready = rows.join(ends, [*KEY, "_stretch"], "left")
    solved = strung(traced(ready))
    every = conversations.select(F.col("conv_id").isNull().alias("_none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("_conv")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    found = every.join(held, KEY, "left").join(solved, KEY, "left")
    return found.select(F.when(~F.col("_none"), F.col("_conv")).alias("conv_id"), zero("gaps"), *[zero(c) for c in COUNTS],
                        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(NOTHING)).alias("repaired_sha256"))
