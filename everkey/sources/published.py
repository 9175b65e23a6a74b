"""Reading published tables, also in their older shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import normal_entity_ref, normal_variant_ref
from ..functions.text import is_errata


def _entity_id(columns: list[str]) -> Column:
    """The entity id under its older name, else under its present one."""
    names = [c for c in ("card_id", "codex_id") if c in columns]
    return normal_entity_ref(F.coalesce(*[F.col(c).cast("string") for c in names]))


def normal_entities(entities: DataFrame) -> DataFrame:
    columns = entities.columns
    result = entities.withColumn("codex_id", _entity_id(columns)).drop("card_id")
    if "printing_ids" in columns:
        result = result.withColumn("printing_ids", F.transform("printing_ids", lambda p: normal_variant_ref(p)))
    if "errata" not in columns:
        result = result.withColumn("errata", is_errata(F.col("rules_text")))
    return result


def normal_variants(variants: DataFrame, entities: DataFrame) -> DataFrame:
    """``entities`` in normal shape supply the name older exports did not copy."""
    columns = variants.columns
    result = variants.withColumn("printing_id", normal_variant_ref(F.col("printing_id"))) \
        .withColumn("codex_id", _entity_id(columns)).drop("card_id", "card_number", "set_code")
    if "set_number" not in columns:
        result = result.withColumn("set_number", F.split_part("slug", F.lit("-"), F.lit(1)))
    if "card_name" not in columns:
        names = entities.select("codex_id", F.col("name").alias("card_name"))
        result = result.join(names, "codex_id", "left")
    return result


def normal_key_history(history: DataFrame) -> DataFrame:
    return history.withColumn("printing_id", normal_variant_ref(F.col("printing_id")))
