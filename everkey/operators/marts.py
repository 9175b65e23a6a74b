"""Published tables derived from the state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import entity_ref, variant_ref
from ..functions.joins import grouped
from ..functions.text import is_errata
from ..schemas import ENTITY_FIELDS, SCHEMA_VERSION, VARIANT_FIELDS
from .apply import State

# The published names of the two ids and the copied name are
# codex_id, printing_id and card_name; set sizes are cards and printings.


def with_entity_name(variants: DataFrame, entities: DataFrame) -> DataFrame:
    return variants.join(entities.select("entity_id", F.col("name").alias("entity_name")), "entity_id")


def variants_per_entity(variants: DataFrame) -> DataFrame:
    """Reverse link: one row for each variant of an entity, however many it has."""
    return variants.select(entity_ref(F.col("entity_id")).alias("codex_id"), variant_ref(F.col("variant_id")).alias("printing_id"))


def sets_per_entity(variants: DataFrame) -> DataFrame:
    """One row for each set an entity has variants in."""
    sets = variants.where("set_number is not null").select("entity_id", "set_number").distinct()
    return sets.select(entity_ref(F.col("entity_id")).alias("codex_id"), "set_number")


def published_entities(entities: DataFrame, variants: DataFrame) -> DataFrame:
    """One row per entity: its fields, the errata flag, and how many sets and variants it has.

    Variants are counted per entity and set first, so an entity with very many of them is spread over its sets.
    """
    pairs = variants.groupBy("entity_id", "set_number").agg(F.count("*").alias("n"))
    counts = grouped(pairs, ["entity_id"], F.count("set_number").alias("sets"), F.sum("n").alias("printings"))
    none = F.lit(0).cast("bigint")
    return entities.join(counts, "entity_id", "left").select(
        entity_ref(F.col("entity_id")).alias("codex_id"), *ENTITY_FIELDS, is_errata(F.col("rules_text")).alias("errata"),
        F.coalesce("sets", none).alias("sets"), F.coalesce("printings", none).alias("printings"))


def published_variants(entities: DataFrame, variants: DataFrame) -> DataFrame:
    return with_entity_name(variants, entities).select(
        variant_ref(F.col("variant_id")).alias("printing_id"), entity_ref(F.col("entity_id")).alias("codex_id"),
        F.col("entity_name").alias("card_name"), *VARIANT_FIELDS, "retired_at")


def published_key_history(history: DataFrame) -> DataFrame:
    return history.select("slug", variant_ref(F.col("variant_id")).alias("printing_id"), "valid_from", "valid_to")


def published_name_history(history: DataFrame) -> DataFrame:
    return history.select("name", entity_ref(F.col("entity_id")).alias("codex_id"), "valid_from", "valid_to")


def set_catalogue(variants: DataFrame) -> DataFrame:
    """One row per set number, null being one; name and date of the lowest id.

    Distinct entities are counted through the set-and-entity pairs, so a set
    holding most of the variants is spread over its entities first.
    """
    first = F.min(F.struct("variant_id", "set_name", "released_at"))
    pairs = variants.groupBy("set_number", "entity_id").agg(first.alias("first"), F.count("*").alias("n"))
    sets = pairs.groupBy("set_number").agg(
        F.min("first").alias("first"), F.count("*").alias("cards"), F.sum("n").alias("printings"))
    return sets.select("set_number", "first.set_name", "first.released_at", "cards", "printings")


def in_catalogue_order(sets: DataFrame) -> DataFrame:
    return sets.orderBy(F.asc_nulls_last("set_number"))


def in_release_order(sets: DataFrame) -> DataFrame:
    """Here a missing date or number sorts first."""
    blank = F.lit("")
    return sets.orderBy(F.coalesce("released_at", blank), F.coalesce("set_number", blank))


def product_counts(variants: DataFrame) -> DataFrame:
    """Variants per product; most first, ties by the product seen first."""
    return variants.groupBy("product").agg(F.count("*").alias("printings"), F.min("variant_id").alias("first_id")) \
        .orderBy(F.desc("printings"), "first_id").select("product", "printings")


def header_counts(state: State) -> DataFrame:
    """Section sizes as (section, rows)."""
    def size(section: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("rows")).select(F.lit(section).alias("section"), "rows")

    sections = [
        size("sets", state.variants.select("set_number").distinct()),
        size("cards", state.entities),
        size("printings", state.variants),
        size("slug_history", state.key_history),
        size("name_history", state.name_history),
    ]
    return reduce(DataFrame.unionByName, sections)


def header(state: State, source: str) -> DataFrame:
    """The one-row header: no timestamp, so the same state gives the same row."""
    counts = header_counts(state)

    def rows(section: str) -> Column:
        return F.max(F.when(F.col("section") == section, F.col("rows"))).alias(section)

    return counts.agg(*[rows(s) for s in ("sets", "cards", "printings", "slug_history", "name_history")]).select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(source).alias("source"), "*")


def sections(state: State, source: str) -> dict[str, DataFrame]:
    return {
        "header": header(state, source),
        "sets": set_catalogue(state.variants),
        "cards": published_entities(state.entities, state.variants),
        "printings": published_variants(state.entities, state.variants),
        "slug_history": published_key_history(state.key_history),
        "name_history": published_name_history(state.name_history),
        "card_printings": variants_per_entity(state.variants),
        "card_sets": sets_per_entity(state.variants),
    }


# The order each section is written in.  Ids of more than six digits sort by
# length first, which is integer order.
def _by_id(column: str) -> list[Column]:
    return [F.length(column), F.col(column)]


def section_order() -> dict[str, list[Column]]:
    return {
        "header": [],
        "sets": [F.asc_nulls_last("set_number")],
        "cards": _by_id("codex_id"),
        "printings": _by_id("printing_id"),
        "slug_history": [*_by_id("printing_id"), F.col("valid_from"), F.col("slug")],
        "name_history": [*_by_id("codex_id"), F.col("valid_from"), F.col("name")],
        "card_printings": [*_by_id("codex_id"), *_by_id("printing_id")],
        "card_sets": [*_by_id("codex_id"), F.col("set_number")],
    }
