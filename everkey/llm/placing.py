"""Places of rows within their group, where one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.joins import grouped
from ..session import written

#: Range-partitioned part a row stands in, and its number there; together a total order over all rows.
PART, AT = "_part", "_at"


def in_order(rows: DataFrame, order: list[Column], keep: list, label: str, parts: int | None = None) -> DataFrame:
    """``keep`` of every row with ``_part`` and ``_at``, written: the rows range-partitioned and sorted by ``order``.

    What is only needed for the order is not written; expressions in ``keep`` are worked out after the rows are in order,
    and not for the sample that finds the ranges.
    """
    spread = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    numbered = spread.sortWithinPartitions(*order).select(*keep, F.spark_partition_id().alias(PART), F.monotonically_increasing_id().alias(AT))
    return written(numbered, label)


def earlier_sums(rows: DataFrame, group: list[str], sums: dict[str, Column], carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each group and part: ``sums`` over the group's earlier parts, and ``carry`` as it is."""
    names = list(sums)
    totals = rows.groupBy(*group, PART).agg(*[c.alias(n) for n, c in sums.items()], *[c.alias(n) for n, c in (carry or {}).items()])
    before = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*group, PART, *[F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long").alias(n) for n in names], *(carry or {}))


def with_places(rows: DataFrame, group: list[str]) -> DataFrame:
    """Adds ``_place``, counted from 0 within each group, to the rows of ``in_order`` (sorted by the group first).

    A group's rows follow each other, so a row's place is its distance from the group's first row in the same part, plus
    the group's rows in earlier parts.  Only one row for each group and part is shuffled for that.
    """
    starts = earlier_sums(rows, group, {"_before": F.count("*")}, {"_first": F.min(AT)})
    return rows.join(starts, [*group, PART]).withColumn("_place", F.col(AT) - F.col("_first") + F.col("_before")).drop("_first", "_before")


def sizes(rows: DataFrame, group: list[str]) -> DataFrame:
    """``_size`` of each group, for use as one side of a join on it."""
    return grouped(rows, group, F.count("*").alias("_size"))
