"""List ranking of an Euler tour, with weights.

A tour is a linked list of arcs: ``_arc``, ``_next`` (null at the end) and a weight in each of several columns.  The
weighted rank of an arc is the sum of all weights before it; with a weight of one it is the arc's position.

Each level contracts the list.  Arcs are cut into blocks by range of their numbers, and in every block the stretches
that do not leave it become one arc each; numbers follow the conversations, so most of a tour stays where it is.  While
more than ``BLOCK`` arcs are left, arcs are spliced out as well: a coin is tossed for every arc, and each that shows
heads behind one that shows tails is taken into the one before it, which removes a quarter in the mean whatever the
shape of the list.  What is left in the end fits one block.  On the way back every arc adds what lies before it within
its stretch to the rank of the stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .batches import batch
from .placing import PART
from .shipping import ship

#: Arcs that one task contracts at a time.
BLOCK = 1 << 16


def contract(arcs: np.ndarray, following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Head of each arc's stretch, the weights before the arc in it, and whether the arc is its stretch's last.

    ``following`` is -1 at the end of the tour; ``weights`` has a column for each arc.  By pointer jumping.
    """
    order = np.argsort(arcs)
    place = np.minimum(np.searchsorted(arcs, following, sorter=order), len(arcs) - 1)
    to = order[place]
    inside = arcs[to] == following
    back = np.arange(len(arcs))
    back[to[inside]] = np.flatnonzero(inside)
    before = np.zeros_like(weights)
    has = back != np.arange(len(arcs))
    before[:, has] = weights[:, back[has]]
    while True:
        further = back[back]
        if (further == back).all():
            return arcs[back], before, ~inside
        before = before + before[:, back]
        back = further


def _contracted(blocks: DataFrame, weights: list[str], label: str) -> DataFrame:
    """``_arc, _head, _last, _next``, and for each weight its sum before the arc in its stretch and up to its end."""
    ship(blocks.sparkSession)
    names = ["_arc", "_head", "_last", "_next", *weights, *[f"{w}_all" for w in weights]]
    schema = pa.schema([(n, pa.bool_() if n == "_last" else pa.int64()) for n in names])

    def run(tables: Iterator[pa.Table]) -> pa.Table:
        table = tables.combine_chunks()
        arcs = table["_arc"].to_numpy()
        following = table["_next"].fill_null(-1).to_numpy()
        own = np.array([table[w].to_numpy() for w in weights], dtype=np.int64)
        heads, before, last = contract(arcs, following, own)
        return pa.Table.from_batches([batch(schema, arcs, heads, last, table["_next"].combine_chunks(), *before, *(before + own))])

    ddl = ", ".join(f"{n} {'boolean' if n == '_last' else 'long'}" for n in names)
    return written(blocks.groupBy(PART).applyInArrow(run, ddl), label)


def _spliced(arcs: DataFrame, weights: list[str], level: int) -> DataFrame:
    """The same columns, for stretches of two: an arc with heads joins the arc with tails before it."""
    heads = lambda column: F.xxhash64(F.lit(level), F.col(column)).bitwiseAND(F.lit(1)) == 1
    takes = F.col("_next").isNotNull() & ~heads("_arc") & heads("_next")
    before = arcs.where(takes).select(F.col("_next").alias("_arc"), F.col("_arc").alias("_head"), *[F.col(w).alias(f"{w}_before") for w in weights])
    held = [F.coalesce(f"{w}_before", F.lit(0)) for w in weights]
    return written(arcs.join(before, "_arc", "left").select(
        "_arc", F.coalesce("_head", "_arc").alias("_head"), (~takes).alias("_last"), "_next",
        *[h.alias(w) for w, h in zip(weights, held)], *[(h + F.col(w)).alias(f"{w}_all") for w, h in zip(weights, held)]), "tour-spliced")


def _stretches(level: DataFrame, weights: list[str]) -> DataFrame:
    return level.where("_last").select(F.col("_head").alias("_arc"), "_next", *[F.col(f"{w}_all").alias(w) for w in weights])


def rank(blocks: DataFrame, weights: list[str], block: int = BLOCK) -> DataFrame:
    """``_arc`` and, in the columns of ``weights``, the sums over all arcs before it.

    ``blocks`` holds ``_part, _arc, _next`` and the weights, with at most about ``block`` arcs in each part; which arcs
    share a part changes the work and not the result.  Arcs must form one list.  No arcs give no rows.
    """
    levels = [_contracted(blocks, weights, "tour-blocks")]
    while True:
        left = _stretches(levels[-1], weights)
        n = left.count()
        if n <= block:
            break
        levels.append(_spliced(left, weights, len(levels)))
        ranged = _stretches(levels[-1], weights).repartitionByRange(-(-n // block), "_arc").withColumn(PART, F.spark_partition_id())
        levels.append(_contracted(written(ranged, "tour-ranged"), weights, "tour-blocks"))
    ranks = _contracted(left.withColumn(PART, F.lit(0)), weights, "tour-rest").select("_arc", *weights)
    for level in reversed(levels):
        known = ranks.select(F.col("_arc").alias("_head"), *[F.col(w).alias(f"{w}_to") for w in weights])
        ranks = level.join(known, "_head").select("_arc", *[(F.col(w) + F.col(f"{w}_to")).alias(w) for w in weights])
    return ranks
