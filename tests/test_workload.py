"""Inputs of the registry are built only where they are read, and shuffles grow with them."""

from pyspark.sql import functions as F

from everkey.catalog import full_catalog
from everkey.functions.slices import number_rows
from everkey.operators.apply import LazyState
from everkey.session import FIRST_PARTITIONS, ROWS_A_PARTITION, make_room


def test_a_state_builds_only_the_tables_that_are_read(spark):
    built = []
    state = LazyState(**{name: lambda name=name: built.append(name) or spark.range(1) for name in ("entities", "variants")})
    assert state.entities is state.entities and built == ["entities"]


def test_a_check_of_names_needs_no_variants(spark, tmp_path):
    """The folder has entities alone, so reading variants would fail."""
    spark.range(200).select(
        F.col("id").alias("p_partkey"), F.lit("part").alias("p_name"), F.lit("brand").alias("p_brand"), F.lit("kind").alias("p_type"),
        F.lit(3).alias("p_size"), F.lit(1.5).alias("p_retailprice")).write.parquet(f"{tmp_path}/part.parquet")
    found = full_catalog().queries["check_open_names"](spark, str(tmp_path)).collect()
    assert sorted(r.key for r in found) == ["103", "3"]


def test_numbered_rows_move_once(spark):
    numbered = number_rows(spark.range(100).select((F.col("id") * 37 % 100).alias("a")), ["a"], "n")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan
    assert [(r.a, r.n) for r in numbered.orderBy("a").collect()] == [(k, k + 1) for k in range(100)]


def test_shuffles_begin_with_partitions_enough(spark):
    before = spark.conf.get(FIRST_PARTITIONS, None)
    try:
        make_room(spark, 10)
        assert spark.conf.get(FIRST_PARTITIONS, None) == before
        make_room(spark, 1_000 * ROWS_A_PARTITION)
        assert spark.conf.get(FIRST_PARTITIONS) == "1000"
    finally:
        spark.conf.unset(FIRST_PARTITIONS) if before is None else spark.conf.set(FIRST_PARTITIONS, before)
