"""Total orders over tables of any size.

A window without a partition, or one partitioned by a hot key, sorts its rows in
a single task.  Here the rows are range-partitioned on the full order instead,
so even one key's rows spread over many slices, and only one small row per slice
(and key) is needed to join the slices up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

SLICE, PLACE = "_slice", "_place"


#: The lower bits of ``monotonically_increasing_id`` count a partition's rows.
_ROW_BITS = (1 << 33) - 1


def sliced(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with the number of the ordered slice each row falls in.

    Written out before use: Spark samples the slice bounds anew on every
    execution, and a row must never change its place once it has been given one.
    """
    spread = df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id())
    return written(spread, label)


def number_rows(df: DataFrame, order: list[str], column: str, start: int | Column = 1,
                label: str = "numbered", widen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Consecutive numbers over the whole table in the given total order.

    ``widen`` may add columns by a join that neither drops nor repeats rows: what is added is written, but not dealt out.
    """
    start = start if isinstance(start, Column) else F.lit(start)
    # A sorted slice is written with the place of each row, so that no row moves again to be numbered.
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn(SLICE, F.spark_partition_id()).withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(_ROW_BITS))
    rows = written(widen(placed) if widen else placed, label)
    # One row per slice, so the running total below is over a bounded table.
    sizes = rows.groupBy(SLICE).agg(F.count("*").alias("_size"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(sizes.select(SLICE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")), f"{label}-offsets")
    return (
        rows.join(F.broadcast(offsets), SLICE)
        .withColumn(column, (start + F.col("_offset") + F.col(PLACE)).cast("bigint"))
        .drop(SLICE, PLACE, "_offset")
    )
