"""Nested payload to flat snapshot tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import key_part
from ..functions.text import canon_text, date_part
from ..schemas import ENTITY_FIELDS, STAT_FIELDS, THRESHOLDS, VARIANT_FIELDS
from ..session import written


class FatalInput(ValueError):
    """The input cannot be used; nothing has been written."""


def metadata_columns(block: str) -> dict[str, Column]:
    """The attributes an entity and a set entry share."""
    columns = {
        "type": canon_text(F.col(f"{block}.type")),
        "rarity": canon_text(F.col(f"{block}.rarity")),
        "rules_text": F.coalesce(canon_text(F.col(f"{block}.rulesText")), F.lit("")),
    }
    columns |= {stat: F.col(f"{block}.{stat}") for stat in STAT_FIELDS}
    columns |= {f"thr_{e}": F.coalesce(F.col(f"{block}.thresholds.{e}"), F.lit(0)) for e in THRESHOLDS}
    return columns


def flatten_entities(payload: DataFrame) -> DataFrame:
    columns = metadata_columns("guardian") | {
        "name": canon_text(F.col("name")),
        "subtypes": canon_text(F.col("subTypes")),
        "elements": canon_text(F.col("elements")),
    }
    return payload.select("entity_pos", *[columns[f].alias(f) for f in ENTITY_FIELDS])


def flatten_variants(payload: DataFrame) -> DataFrame:
    """One row per variant, with the set's attributes and all three positions."""
    # Canonicalise names and set texts before the rows multiply.
    sets = payload.select(
        "entity_pos", canon_text(F.col("name")).alias("entity_name"),
        F.posexplode("sets").alias("set_pos", "set"),
    )
    per_set = metadata_columns("set.metadata") | {
        "set_name": canon_text(F.col("set.name")),
        "released_at": date_part(F.col("set.releasedAt")),
    }
    variants = sets.select(
        "entity_pos", "set_pos", "entity_name", *[c.alias(n) for n, c in per_set.items()],
        F.col("set.variants").alias("variants"),
    ).select("*", F.posexplode("variants").alias("variant_pos", "variant")).drop("variants")
    own = {
        "slug": F.col("variant.slug"),
        "set_number": key_part(F.col("variant.slug"), "set_number"),
        "product": canon_text(F.col("variant.product")),
        "finish": canon_text(F.col("variant.finish")),
        "artist": canon_text(F.col("variant.artist")),
        "flavour_text": canon_text(F.col("variant.flavorText")),
        "type_text": canon_text(F.col("variant.typeText")),
        "image_hash": F.lit(None).cast("string"),
    }
    return variants.select(
        "entity_pos", F.col("set_pos").cast("bigint").alias("set_pos"),
        F.col("variant_pos").cast("bigint").alias("variant_pos"), "entity_name",
        *[own[f].alias(f) if f in own else F.col(f) for f in VARIANT_FIELDS],
    )


def duplicates(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_names(entities: DataFrame) -> DataFrame:
    return duplicates(entities, "name")


def duplicate_keys(variants: DataFrame) -> DataFrame:
    return duplicates(variants, "slug")


def missing_parts(payload: DataFrame) -> DataFrame:
    """Payload entries without a part every entry must have."""
    def absent(rows: str, part: str) -> Column:
        return F.exists(rows, lambda row: row[part].isNull())

    variants = F.flatten(F.transform("sets", lambda s: s["variants"]))
    rules = {
        "ordinal": F.col("entity_pos").isNull(),
        "name": F.col("name").isNull(),
        "guardian": F.col("guardian").isNull(),
        "sets": F.col("sets").isNull(),
        "set name": absent("sets", "name"),
        "set metadata": absent("sets", "metadata"),
        "set variants": absent("sets", "variants"),
        "slug": F.exists(variants, lambda v: v["slug"].isNull()),
    }
    found = F.array(*[F.when(rule, F.lit(part)) for part, rule in rules.items()])
    return payload.select("entity_pos", F.explode(F.array_compact(found)).alias("missing"))


def refuse(rows: DataFrame, problem: str) -> None:
    """Stop the run, before anything is written, when there are any such rows."""
    found = rows.limit(5).collect()
    if found:
        raise FatalInput(f"{problem} ({rows.count()} in all): " + "; ".join(str(row.asDict()) for row in found))


def checked_snapshot(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The flat snapshot, cleaned once and written, or an error."""
    refuse(missing_parts(payload), "payload entry without a required part")
    refuse(duplicates(payload.select("entity_pos"), "entity_pos"), "payload ordinal occurs more than once")
    entities = written(flatten_entities(payload), "snapshot-entities")
    variants = written(flatten_variants(payload), "snapshot-variants")
    refuse(duplicate_names(entities), "entity name occurs more than once")
    refuse(duplicate_keys(variants), "variant key occurs more than once")
    return entities, variants
