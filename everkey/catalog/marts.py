"""Published tables and digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import digest, marts as m
from ..plans import workload as w
from ..plans.oracle import state_sql
from ..operators.apply import ENTITY_COUNTER, VARIANT_COUNTER
from ..schemas import ENTITY_FIELDS, SCHEMA_VERSION, STATE_TABLES, VARIANT_FIELDS
from ..sources.published import normal_entities, normal_key_history, normal_variants
from . import Catalog

catalog = Catalog()
add = catalog.add

LINKS = "SELECT printf('C%06d', entity_id) AS codex_id, printf('P%06d', variant_id) AS printing_id FROM r_variants"
SETS = "SELECT DISTINCT printf('C%06d', entity_id) AS codex_id, set_number FROM r_variants WHERE set_number IS NOT NULL"
VARIANTS = f"""SELECT printf('P%06d', variant_id) AS printing_id, printf('C%06d', entity_id) AS codex_id, e.name AS card_name,
  {', '.join('v.' + f for f in VARIANT_FIELDS)}, v.retired_at FROM r_variants v JOIN r_entities e USING (entity_id)"""
ENTITIES = f"""SELECT printf('C%06d', e.entity_id) AS codex_id, {', '.join('e.' + f for f in ENTITY_FIELDS)},
  starts_with(rules_text, 'UPDATED') AS errata, coalesce(n.sets, 0) AS sets, coalesce(n.printings, 0) AS printings
FROM r_entities e LEFT JOIN (SELECT entity_id, count(DISTINCT set_number) AS sets, count(*) AS printings FROM r_variants GROUP BY entity_id) n USING (entity_id)"""


@add("variants_named", state_sql(VARIANTS))
def variants_named(spark, sf_dir):
    state = w.state(spark, sf_dir)
    return m.published_variants(state.entities, state.variants)


@add("variants_per_entity", state_sql(LINKS))
def variants_per_entity(spark, sf_dir):
    return m.variants_per_entity(w.state(spark, sf_dir).variants)


@add("sets_per_entity", state_sql(SETS))
def sets_per_entity(spark, sf_dir):
    return m.sets_per_entity(w.state(spark, sf_dir).variants)


@add("published_entities", state_sql(ENTITIES))
def published_entities(spark, sf_dir):
    state = w.state(spark, sf_dir)
    return m.published_entities(state.entities, state.variants)


# Set 013 has lost its number here, so null is a set of its own.
UNNUMBERED = "(SELECT * REPLACE (CASE WHEN set_number <> '013' THEN set_number END AS set_number) FROM r_variants)"
CATALOGUE = f"""SELECT set_number, min_by(set_name, variant_id) AS set_name, min_by(released_at, variant_id) AS released_at,
  count(DISTINCT entity_id) AS cards, count(*) AS printings FROM {UNNUMBERED} GROUP BY set_number"""


def _unnumbered(spark, sf_dir):
    return w.state(spark, sf_dir).variants.withColumn("set_number", F.when(F.col("set_number") != "013", F.col("set_number")))


@add("set_catalogue", state_sql(CATALOGUE))
def set_catalogue(spark, sf_dir):
    return m.in_catalogue_order(m.set_catalogue(_unnumbered(spark, sf_dir)))


@add("set_stats", state_sql(CATALOGUE))
def set_stats(spark, sf_dir):
    return m.in_release_order(m.set_catalogue(_unnumbered(spark, sf_dir)))


@add("product_counts", state_sql("SELECT product, count(*) AS printings FROM r_variants GROUP BY product"))
def product_counts(spark, sf_dir):
    return m.product_counts(w.state(spark, sf_dir).variants)


COUNTS = """(SELECT count(*) FROM (SELECT DISTINCT set_number FROM r_variants)) AS sets, (SELECT count(*) FROM r_entities) AS cards,
  (SELECT count(*) FROM r_variants) AS printings, (SELECT count(*) FROM key_history) AS slug_history,
  (SELECT count(*) FROM name_history) AS name_history"""


@add("header_counts", state_sql(f"SELECT {SCHEMA_VERSION} AS schema_version, 'test tables' AS source, {COUNTS}"))
def header_counts(spark, sf_dir):
    return m.header(w.state(spark, sf_dir), "test tables")


@add("published_key_history", state_sql("SELECT slug, printf('P%06d', variant_id) AS printing_id, valid_from, valid_to FROM key_history"))
def published_key_history(spark, sf_dir):
    return m.published_key_history(w.state(spark, sf_dir).key_history)


@add("published_name_history", state_sql("SELECT name, printf('C%06d', entity_id) AS codex_id, valid_from, valid_to FROM name_history"))
def published_name_history(spark, sf_dir):
    return m.published_name_history(w.state(spark, sf_dir).name_history)


@add("normalise_old_export", state_sql("""SELECT printf('P%06d', variant_id) AS printing_id, printf('C%06d', entity_id) AS codex_id,
  slug, product, split_part(slug, '-', 1) AS set_number, e.name AS card_name, starts_with(e.rules_text, 'UPDATED') AS errata,
  'old-' || slug AS former FROM r_variants v JOIN r_entities e USING (entity_id)"""))
def normalise_old_export(spark, sf_dir):
    """The published tables as they once were: plain numbers, fewer columns."""
    state = w.state(spark, sf_dir)
    old_entities = state.entities.select(F.col("entity_id").alias("card_id"), "name", "rules_text")
    old_variants = state.variants.select(
        F.col("variant_id").alias("printing_id"), F.col("entity_id").alias("card_id"), "slug", "product",
        F.lit(7).alias("card_number"), F.lower("set_name").alias("set_code"))
    old_history = state.variants.select(
        F.concat(F.lit("old-"), F.col("slug")).alias("former"), F.col("variant_id").cast("string").alias("printing_id"))
    entities = normal_entities(old_entities)
    variants = normal_variants(old_variants, entities)
    return variants.join(entities.select("codex_id", "errata"), "codex_id").join(normal_key_history(old_history), "printing_id")


def _digest_sql(section: str, source: str, columns: list[str]) -> str:
    def encoded(column: str) -> str:
        return f"coalesce(length({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"

    row = "sha256(" + " || ".join(map(encoded, columns)) + ")"
    sums = " || ' ' || ".join(
        f"coalesce(sum(('0x' || substr(h, {1 + 15 * i}, 15))::HUGEINT), 0)::VARCHAR" for i in range(4))
    return f"""SELECT '{section}' AS section, count(*) AS rows, sha256(count(*)::VARCHAR || ' ' || {sums}) AS digest
FROM (SELECT {row} AS h FROM {source})"""


# All five tables of the state.
DIGESTED = {name: schema.names for name, schema in STATE_TABLES.items()}
DIGEST_SOURCES = {"entities": "r_entities", "variants": "r_variants", "counters": f"""(SELECT 'schema_version' AS name, {SCHEMA_VERSION}::BIGINT AS value
  UNION ALL SELECT '{ENTITY_COUNTER}', (SELECT max(p_partkey) + 2 FROM part) UNION ALL SELECT '{VARIANT_COUNTER}', (SELECT count(*) + 1 FROM r_variants))"""}


@add("table_digest", state_sql(" UNION ALL ".join(_digest_sql(name, DIGEST_SOURCES.get(name, name), columns) for name, columns in DIGESTED.items())))
def table_digest(spark, sf_dir):
    state = w.state(spark, sf_dir)
    return digest.section_digests({name: getattr(state, name).select(columns) for name, columns in DIGESTED.items()})


SECTIONS = {
    "sets": (CATALOGUE.replace(UNNUMBERED, "r_variants"), ["set_number", "set_name", "released_at", "cards", "printings"]),
    "cards": (ENTITIES, ["codex_id", *ENTITY_FIELDS, "errata", "sets", "printings"]),
    "printings": (VARIANTS, ["printing_id", "codex_id", "card_name", *VARIANT_FIELDS, "retired_at"]),
    "slug_history": ("SELECT slug, printf('P%06d', variant_id) AS printing_id, valid_from, valid_to FROM key_history", ["slug", "printing_id", "valid_from", "valid_to"]),
    "name_history": ("SELECT name, printf('C%06d', entity_id) AS codex_id, valid_from, valid_to FROM name_history", ["name", "codex_id", "valid_from", "valid_to"]),
}


@add("manifest", state_sql(f"""SELECT 'v1' AS dataset_version, {SCHEMA_VERSION} AS schema_version, section, rows, digest, h.counted, true AS agrees
FROM ({" UNION ALL ".join(_digest_sql(name, f"({source})", columns) for name, (source, columns) in SECTIONS.items())})
JOIN (UNPIVOT (SELECT {COUNTS}) ON sets, cards, printings, slug_history, name_history INTO NAME section VALUE counted) h USING (section)"""))
def manifest(spark, sf_dir):
    """Published sections, written and read back, with their digests, the header's counts and what was stated beside them."""
    state = w.state(spark, sf_dir)
    published = w.published(spark, sf_dir)
    stated = digest.section_digests({name: df for name, df in m.sections(state, "test tables").items() if name in SECTIONS})
    found = digest.section_digests({name: df for name, df in published.items() if name in SECTIONS})
    return digest.manifest(found, published["header"], "v1", SCHEMA_VERSION, stated)
