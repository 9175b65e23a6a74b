"""Join shapes that stay splittable when one key is hot.

Adaptive execution splits a hot key only where a join reads both sides straight
from a shuffle.  When one side is an aggregate on the join key, its placement is
taken over and the hot key of the other side lands in one task.  Aggregating on
``struct(key)`` and unpacking it afterwards keeps the two placements apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def grouped(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """``groupBy(keys).agg(...)`` for use as one side of a join on the keys."""
    totals = df.groupBy(F.struct(*keys).alias("_by")).agg(*aggregates)
    return totals.select(*[F.col(f"_by.{k}").alias(k) for k in keys],
                         *[c for c in totals.columns if c != "_by"])


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys for use as one side of a join on them."""
    return df.select(F.struct(*keys).alias("_by")).distinct().select(*[F.col(f"_by.{k}").alias(k) for k in keys])


def left_join_many(left: DataFrame, right: DataFrame, on: str, present: DataFrame | None = None) -> DataFrame:
    """Left join to a side that may hold very many rows of one key.

    A hot key can be split on either side of an inner join but not on the right
    of a left join.  So matches come from an inner join, and rows without any
    from an anti join on the distinct keys, where repeats are dropped before the
    shuffle.  ``present`` names a cheaper source of the keys of ``right``.
    """
    matched = left.join(right, on)
    unmatched = left.join(distinct_keys(right if present is None else present, on), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
