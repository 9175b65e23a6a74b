"""Readers for the upstream payload, corrections and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import DECISIONS, PAYLOAD


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one entity each, with its position in ``ordinal``.

    A value of the wrong type stops the read; permissive mode would turn it
    silently into a null, and a null is a legal attribute value.
    """
    schema = T.StructType([T.StructField("ordinal", T.LongType()), *PAYLOAD.fields])
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.withColumnRenamed("ordinal", "entity_pos")


def read_payload_document(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array in one file, as the upstream serves it.

    A single document is read by a single task, which also numbers its rows in
    document order.  Use JSON lines for anything large.
    """
    rows = spark.read.schema(PAYLOAD).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.select(F.monotonically_increasing_id().alias("entity_pos"), "*")


def keep_raw(spark: SparkSession, source: str, kept: str) -> DataFrame:
    """Copy the payload line by line before it is parsed, so that a fault of the parser can be looked into later."""
    spark.read.text(source).write.text(kept)
    return read_payload(spark, kept)


# The field names of the corrections and decisions files.
_CORRECTION_FILE = (
    "match struct<card_name: string, set_name: string>, "
    "set_fields map<string, string>, reason string"
)
_DECISION_FILE = (
    "card_renames array<struct<card_id: bigint, new_name: string>>, "
    "new_cards array<string>, "
    "printing_renames array<struct<printing_id: bigint, new_slug: string>>, "
    "new_printings array<string>, "
    "retire_printings array<bigint>"
)


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """One row per corrected column, numbered in list order.  The order counts, so it must be one file."""
    rows = spark.read.schema(_CORRECTION_FILE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    if len(rows.inputFiles()) > 1:
        raise ValueError("corrections are laid over each other in list order: give one file")
    return rows.select(
        F.monotonically_increasing_id().alias("ord"),
        F.col("match.card_name").alias("name"), F.col("match.set_name").alias("set_name"),
        F.explode_outer("set_fields").alias("field", "value"), "reason",
    )


def read_decisions(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The five decision lists, one table each."""
    file = spark.read.schema(_DECISION_FILE).option("multiLine", True).option("mode", "FAILFAST").json(path)

    def rows(column: str, *fields: Column) -> DataFrame:
        return file.select(F.explode(column).alias("d")).select(*fields)

    item = F.col("d")
    return {
        "entity_renames": rows("card_renames", item["card_id"].alias("entity_id"), item["new_name"].alias("new_name")),
        "new_entities": rows("new_cards", item.alias("name")),
        "variant_renames": rows(
            "printing_renames", item["printing_id"].alias("variant_id"), item["new_slug"].alias("new_slug")),
        "new_variants": rows("new_printings", item.alias("slug")),
        "retire_variants": rows("retire_printings", item.alias("variant_id")),
    }


def no_decisions(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in DECISIONS.items()}
