"""Reviewed corrections laid over a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import grouped
from ..functions.text import canon_text
from ..schemas import ENTITY_COMPARED, VARIANT_FIELDS
from .flatten import refuse


def with_match_keys(corrections: DataFrame) -> DataFrame:
    """Match columns are canonicalised like the data; values are taken as written."""
    return corrections.withColumn("name", canon_text(F.col("name"))) \
        .withColumn("set_name", canon_text(F.col("set_name")))


def without_reason(corrections: DataFrame) -> DataFrame:
    return corrections.where(F.coalesce("reason", F.lit("")) == "")


def _latest(corrections: DataFrame, target: list[str], column: str) -> DataFrame:
    """Per target a map of field to its last ``(ord, value)``.

    The presence of the field in the map is what marks it as set, so a null
    value still counts.
    """
    last = corrections.where("field is not null").groupBy(*target, "field").agg(
        F.max_by(F.struct("ord", "value"), "ord").alias("setting"))
    entry = F.struct("field", "setting")
    return grouped(last, target, F.map_from_entries(F.collect_list(entry)).alias(column))


def _corrected(field: str, kind: str, *layers: str) -> Column:
    """The value with the highest ``ord`` among the layers, or the original."""
    settings = [F.try_element_at(F.col(layer), F.lit(field)) for layer in layers]
    # Nulls are skipped by array_compact, and structs sort by ord first.
    found = F.array_compact(F.array(*settings)) if len(settings) > 1 else None
    setting = settings[0] if found is None else F.try_element_at(F.sort_array(found, asc=False), F.lit(1))
    return F.when(setting.isNotNull(), setting["value"].cast(kind)).otherwise(F.col(field)).alias(field)


def correct_entities(entities: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections without a set apply to the entity itself."""
    wide = _latest(with_match_keys(corrections).where("set_name is null"), ["name"], "_wide")
    kinds = dict(entities.dtypes)
    return entities.join(wide, "name", "left").select(*[
        _corrected(c, kinds[c], "_wide") if c in ENTITY_COMPARED else F.col(c) for c in entities.columns
    ])


def correct_variants(variants: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections with a set apply to that set's variants, the others to all."""
    keyed = with_match_keys(corrections).withColumnRenamed("name", "entity_name")
    wide = _latest(keyed.where("set_name is null"), ["entity_name"], "_wide")
    narrow = _latest(keyed.where("set_name is not null"), ["entity_name", "set_name"], "_narrow")
    kinds = dict(variants.dtypes)
    joined = variants.join(wide, "entity_name", "left").join(narrow, ["entity_name", "set_name"], "left")
    return joined.select(*[
        _corrected(c, kinds[c], "_wide", "_narrow") if c in VARIANT_FIELDS and c != "slug" else F.col(c)
        for c in variants.columns
    ])


def unmatched_corrections(entities: DataFrame, variants: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections that hit nothing: upstream has probably been mended."""
    entries = with_match_keys(corrections).select("ord", "name", "set_name", "reason").distinct()
    owners = variants.select(F.col("entity_name").alias("name"), "set_name").distinct()
    wide = entries.where("set_name is null") \
        .join(entities.select("name"), "name", "left_anti") \
        .join(owners.select("name"), "name", "left_anti")
    narrow = entries.where("set_name is not null").join(owners, ["name", "set_name"], "left_anti")
    return wide.unionByName(narrow)


def apply_corrections(entities: DataFrame, variants: DataFrame,
                      corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    refuse(without_reason(corrections), "correction without a reason")
    return correct_entities(entities, corrections), correct_variants(variants, corrections)
