"""Invariant checks, run on damaged copies so that they find something."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import checks as k
from ..operators.apply import ENTITY_COUNTER, VARIANT_COUNTER
from ..plans import workload as w
from ..plans.oracle import inputs, with_ctes
from ..schemas import ENTITY_FIELDS, SCHEMA_VERSION, VARIANT_FIELDS
from .marts import COUNTS as HEADER_COUNTS, ENTITIES, LINKS as LINK_ROWS, SECTIONS, VARIANTS
from . import Catalog

catalog = Catalog()
add = catalog.add

VARIANT_ROW = ", ".join(["variant_id", "entity_id", *VARIANT_FIELDS, "retired_at"])


def damaged_ctes() -> dict[str, str]:
    """State x_* is the damaged copy of state r_*."""
    changed = VARIANT_ROW.replace("entity_id", "entity_id + CASE WHEN variant_id % 1000 = 11 THEN 1 ELSE 0 END AS entity_id", 1) \
        .replace("slug", "CASE WHEN variant_id % 1000 IN (13, 23) THEN 'broken-' || slug ELSE slug END AS slug", 1)
    return inputs(w.SCENARIOS["clean"]) | {
        "r_counters": f"""SELECT 'schema_version' AS name, {SCHEMA_VERSION}::BIGINT AS value
  UNION ALL SELECT '{ENTITY_COUNTER}', (SELECT max(p_partkey) + 2 FROM part)
  UNION ALL SELECT '{VARIANT_COUNTER}', (SELECT count(*) + 1 FROM r_variants)""",
        "x_entities": "SELECT * FROM r_entities WHERE entity_id % 90 <> 8",
        "x_kept": f"SELECT {changed} FROM r_variants WHERE variant_id % 1000 <> 7",
        "x_variants": "SELECT * FROM x_kept UNION ALL SELECT * FROM x_kept WHERE variant_id % 1000 = 17",
        "x_key_history": f"""SELECT * FROM key_history WHERE NOT (valid_to IS NULL AND variant_id % 500 = 3) AND variant_id % 1000 <> 23
  UNION ALL SELECT 'extra-' || slug, variant_id, valid_from, NULL FROM key_history WHERE valid_to IS NULL AND variant_id % 500 = 4
  UNION ALL SELECT slug, variant_id + 1, '{w.CLOSED_FROM}', '{w.OPEN_FROM}' FROM key_history WHERE valid_to IS NULL AND variant_id % 500 = 5""",
        "x_name_history": "SELECT * FROM name_history WHERE NOT (valid_to IS NULL AND entity_id % 100 = 3)",
        "x_counters": f"""SELECT name, CASE name WHEN '{VARIANT_COUNTER}' THEN 1 WHEN 'schema_version' THEN 5 ELSE value END AS value
  FROM r_counters WHERE name <> '{ENTITY_COUNTER}'""",
    }


def broken(check: str, key: str, detail: str, rest: str) -> str:
    return f"SELECT '{check}' AS \"check\", ({key})::VARCHAR AS \"key\", {detail} AS detail {rest}"


def sql(*parts: str) -> str:
    return with_ctes(damaged_ctes(), "\nUNION ALL ".join(parts))


def open_rows(check: str, table: str, history: str, number: str, key: str) -> str:
    rows = f"(SELECT {number}, count(*) AS n, min({key}) AS open_key FROM {history} WHERE valid_to IS NULL GROUP BY {number})"
    return broken(check, f"t.{number}", f"CASE WHEN coalesce(n, 0) <> 1 THEN coalesce(n, 0) || ' open rows' ELSE 'open row says ' || open_key END",
                  f"FROM {table} t LEFT JOIN {rows} h USING ({number}) WHERE coalesce(n, 0) <> 1 OR open_key IS DISTINCT FROM t.{key}")


VERSION = broken("schema_version", "value", "'expected 6'", "FROM x_counters WHERE name = 'schema_version' AND value <> 6")
FOREIGN = [
    broken("foreign_key", "variant_id", "'variant of entity ' || entity_id",
           "FROM x_variants WHERE entity_id NOT IN (SELECT entity_id FROM x_entities)"),
    broken("foreign_key", "slug", "'key history of variant ' || variant_id",
           "FROM x_key_history WHERE variant_id NOT IN (SELECT variant_id FROM x_variants)"),
    broken("foreign_key", "name", "'name history of entity ' || entity_id",
           "FROM x_name_history WHERE entity_id NOT IN (SELECT entity_id FROM x_entities)"),
]
COUNTERS = [broken("counter", f"'{name}'", "'highest id ' || top || ' next ' || coalesce(next::VARCHAR, 'missing')",
                   f"""FROM (SELECT (SELECT max({column}) FROM {table}) AS top,
  (SELECT value FROM x_counters WHERE name = '{name}') AS next) WHERE next IS NULL OR top >= next""")
            for table, column, name in (("x_entities", "entity_id", ENTITY_COUNTER), ("x_variants", "variant_id", VARIANT_COUNTER))]
OPEN_KEYS = open_rows("open_key", "x_variants", "x_key_history", "variant_id", "slug")
OPEN_NAMES = open_rows("open_name", "x_entities", "x_name_history", "entity_id", "name")
OWNERSHIP = broken("key_ownership", "slug", "n || ' variants, from ' || low || ' to ' || high",
                   """FROM (SELECT slug, count(DISTINCT variant_id) AS n, min(variant_id) AS low, max(variant_id) AS high
  FROM (SELECT slug, variant_id FROM x_key_history UNION ALL SELECT slug, variant_id FROM x_variants) GROUP BY slug) WHERE n > 1""")


@add("check_schema_version", sql(VERSION))
def check_schema_version(spark, sf_dir):
    return k.check_schema_version(w.damaged_state(spark, sf_dir).counters)


@add("check_foreign_keys", sql(*FOREIGN))
def check_foreign_keys(spark, sf_dir):
    return k.check_foreign_keys(w.damaged_state(spark, sf_dir))


@add("check_counters", sql(*COUNTERS))
def check_counters(spark, sf_dir):
    return k.check_counters(w.damaged_state(spark, sf_dir))


@add("check_open_keys", sql(OPEN_KEYS))
def check_open_keys(spark, sf_dir):
    state = w.damaged_state(spark, sf_dir)
    return k.check_open_keys(state.variants, state.key_history)


@add("check_open_names", sql(OPEN_NAMES))
def check_open_names(spark, sf_dir):
    state = w.damaged_state(spark, sf_dir)
    return k.check_open_names(state.entities, state.name_history)


@add("check_key_ownership", sql(OWNERSHIP))
def check_key_ownership(spark, sf_dir):
    state = w.damaged_state(spark, sf_dir)
    return k.check_key_ownership(state.key_history, state.variants)


# -- published tables ---------------------------------------------------------------------

def damaged_published(spark, sf_dir):
    """Published tables with some rows changed, missing, or against the rules."""
    return w.once(spark, sf_dir, ("damaged-published",), lambda: damaged_sections(w.published(spark, sf_dir)))


def damaged_sections(good):
    number = F.substring("codex_id", 2, 20).cast("bigint")
    cards = good["cards"] \
        .withColumn("errata", F.when(number % 60 == 1, ~F.col("errata")).otherwise(F.col("errata"))) \
        .withColumn("printings", F.when(number % 60 == 4, F.lit(-7)).otherwise(F.col("printings")).cast("bigint")) \
        .withColumn("thr_water", F.when(number % 60 == 5, F.lit(-1)).otherwise(F.col("thr_water")))
    own = F.substring("printing_id", 2, 20).cast("bigint")
    printings = good["printings"].where(own % 900 != 6) \
        .withColumn("released_at", F.when(own % 900 == 7, F.lit("May 2023")).otherwise(F.col("released_at"))) \
        .withColumn("card_name", F.when(own % 900 != 8, F.col("card_name")))
    links = good["card_printings"].where(own % 900 != 9).unionByName(good["card_printings"].where(own % 900 == 10))
    sets = good["sets"].withColumn("cards", F.when(F.col("set_number") == "003", F.col("cards") + 1).otherwise(F.col("cards")))
    slugs = good["slug_history"].withColumn("valid_to", F.when(own % 900 == 11, F.lit("2031-01-01")).otherwise(F.col("valid_to")))
    names = good["name_history"].where(number % 60 != 12)
    header = good["header"].withColumn("cards", F.col("cards") + 1)
    return good | {"cards": cards, "printings": printings, "card_printings": links, "sets": sets, "slug_history": slugs, "name_history": names, "header": header}


def published_ctes() -> dict[str, str]:
    own, entity = "printing_id[2:]::BIGINT", "codex_id[2:]::BIGINT"
    return damaged_ctes() | {
        "g_cards": ENTITIES,
        "x_cards": f"""SELECT * REPLACE (CASE WHEN {entity} % 60 = 1 THEN NOT errata ELSE errata END AS errata,
  CASE WHEN {entity} % 60 = 4 THEN -7 ELSE printings END AS printings, CASE WHEN {entity} % 60 = 5 THEN -1 ELSE thr_water END AS thr_water) FROM g_cards""",
        "g_printings": VARIANTS,
        "x_printings": f"""SELECT * REPLACE (CASE WHEN {own} % 900 = 7 THEN 'May 2023' ELSE released_at END AS released_at,
  CASE WHEN {own} % 900 <> 8 THEN card_name END AS card_name) FROM g_printings WHERE {own} % 900 <> 6""",
        "g_links": LINK_ROWS,
        "x_links": f"SELECT * FROM g_links WHERE {own} % 900 <> 9 UNION ALL SELECT * FROM g_links WHERE {own} % 900 = 10",
        "g_sets": SECTIONS["sets"][0],
        "x_sets": "SELECT * REPLACE (CASE WHEN set_number = '003' THEN cards + 1 ELSE cards END AS cards) FROM g_sets",
        "g_slugs": SECTIONS["slug_history"][0],
        "x_slugs": f"SELECT * REPLACE (CASE WHEN {own} % 900 = 11 THEN '2031-01-01' ELSE valid_to END AS valid_to) FROM g_slugs",
        "g_names": SECTIONS["name_history"][0],
        "x_names": f"SELECT * FROM g_names WHERE {entity} % 60 <> 12",
        "g_header": f"SELECT {SCHEMA_VERSION} AS schema_version, {HEADER_COUNTS}",
        "x_header": "SELECT * REPLACE (cards + 1 AS cards) FROM g_header",
    }


def _compared(section: str, key: str, good: str, bad: str) -> list[str]:
    return [broken(f"published:{section}", key, "'published but not derived'", f"FROM (SELECT {bad} EXCEPT ALL SELECT {good})"),
            broken(f"published:{section}", key, "'derived but not published'", f"FROM (SELECT {good} EXCEPT ALL SELECT {bad})")]


PUBLISHED = [*_compared("cards", "codex_id", "* FROM g_cards", "* FROM x_cards"),
             *_compared("printings", "printing_id", "* FROM g_printings", "* FROM x_printings"),
             *_compared("card_printings", "codex_id", "* FROM g_links", "* FROM x_links"),
             *_compared("sets", "set_number", "* FROM g_sets", "* FROM x_sets"),
             *_compared("slug_history", "slug", "* FROM g_slugs", "* FROM x_slugs"),
             *_compared("name_history", "name", "* FROM g_names", "* FROM x_names"),
             *_compared("header", "schema_version", "* FROM g_header", "* FROM x_header")]
RULES = [
    broken("schema:cards", "codex_id", "'printings'", "FROM x_cards WHERE printings < 0"),
    broken("schema:cards", "codex_id", "'thr_water'", "FROM x_cards WHERE thr_water < 0"),
    broken("schema:printings", "printing_id", "'released_at'", "FROM x_printings WHERE NOT regexp_full_match(released_at, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"),
    broken("schema:printings", "printing_id", "'card_name'", "FROM x_printings WHERE card_name IS NULL"),
]
LINKS = [
    broken("link", "codex_id", "'lists ' || printing_id", """FROM (SELECT DISTINCT codex_id, printing_id FROM x_links) l
  WHERE NOT EXISTS (SELECT 1 FROM x_printings x WHERE x.codex_id = l.codex_id AND x.printing_id = l.printing_id)"""),
    broken("link", "codex_id", "'does not list ' || printing_id", """FROM x_printings x WHERE NOT EXISTS
  (SELECT 1 FROM x_links l WHERE x.codex_id = l.codex_id AND x.printing_id = l.printing_id)"""),
]


def published_sql(*parts: str) -> str:
    return with_ctes(published_ctes(), "\nUNION ALL ".join(parts))


@add("check_published", published_sql(*PUBLISHED))
def check_published(spark, sf_dir):
    found = k.published_violations(damaged_published(spark, sf_dir), w.state(spark, sf_dir))
    return found.where("check like 'published:%'")


@add("check_schema", published_sql(*RULES))
def check_schema(spark, sf_dir):
    return k.check_schema(damaged_published(spark, sf_dir))


@add("check_links", published_sql(*LINKS))
def check_links(spark, sf_dir):
    bad = damaged_published(spark, sf_dir)
    return k.check_links(bad["card_printings"], bad["printings"])


# -- version against version ----------------------------------------------------------------

LOST = [
    broken("lost_entity", "entity_id", "name", "FROM r_entities WHERE entity_id NOT IN (SELECT entity_id FROM x_entities)"),
    broken("lost_variant", "variant_id", "slug", "FROM r_variants WHERE variant_id NOT IN (SELECT variant_id FROM x_variants)"),
]
# A published entity that is still there but no longer lists a variant.
LOST_LINKS = broken("lost_link", "r.entity_id", "'variant ' || r.variant_id", """FROM r_variants r
  WHERE r.entity_id IN (SELECT entity_id FROM x_entities)
    AND NOT EXISTS (SELECT 1 FROM x_variants x WHERE x.variant_id = r.variant_id AND x.entity_id = r.entity_id)""")
MOVED = broken("moved_variant", "r.variant_id", "r.entity_id || ' -> ' || x.entity_id",
               "FROM r_variants r JOIN x_variants x USING (variant_id) WHERE r.entity_id <> x.entity_id")
UNEXPLAINED = broken("unexplained_key", "r.variant_id", "r.slug || ' -> ' || x.slug",
                     """FROM r_variants r JOIN x_variants x USING (variant_id) WHERE r.slug <> x.slug
  AND NOT EXISTS (SELECT 1 FROM x_key_history h WHERE h.variant_id = r.variant_id AND h.slug = r.slug)""")
COUNTS = [broken("count_fell", f"'{name}'", "was || ' -> ' || now",
                 f"FROM (SELECT (SELECT count(*) FROM {was}) AS was, (SELECT count(*) FROM {now}) AS now) WHERE now < was")
          for name, was, now in (("entities", "r_entities", "x_entities"), ("variants", "r_variants", "x_variants"),
                                 ("key_history", "key_history", "x_key_history"), ("name_history", "name_history", "x_name_history"))
          ] + [broken("count_fell", "name", "r.value || ' -> ' || coalesce(x.value::VARCHAR, 'missing')",
                      "FROM r_counters r LEFT JOIN x_counters x USING (name) WHERE x.value IS NULL OR x.value < r.value")]


def _repeated(check: str, table: str, *columns: str) -> str:
    return broken(check, " || ' ' || ".join(columns), "count(*) || ' copies'", f"FROM {table} GROUP BY {', '.join(columns)} HAVING count(*) > 1")


WRITE = [
    _repeated("duplicate_entity_id", "x_entities", "entity_id"), _repeated("duplicate_name", "x_entities", "name"),
    _repeated("duplicate_variant_id", "x_variants", "variant_id"), _repeated("duplicate_key", "x_variants", "slug"),
    _repeated("repeated_key_history", "x_key_history", "variant_id", "slug", "valid_from"),
    _repeated("repeated_name_history", "x_name_history", "entity_id", "name", "valid_from"),
    broken("stolen_key", "slug", "owner || ' -> ' || variant_id", """FROM (SELECT DISTINCT c.slug, c.variant_id, h.variant_id AS owner
  FROM (SELECT slug, variant_id FROM x_key_history UNION SELECT slug, variant_id FROM x_variants) c
  JOIN key_history h USING (slug) WHERE h.variant_id <> c.variant_id)"""),
]


def _pair(spark, sf_dir):
    return w.state(spark, sf_dir), w.damaged_state(spark, sf_dir)


@add("check_lost_ids", sql(*LOST))
def check_lost_ids(spark, sf_dir):
    pair = _pair(spark, sf_dir)
    return k.check_lost_entities(*pair).unionByName(k.check_lost_variants(*pair))


@add("check_lost_links", sql(LOST_LINKS))
def check_lost_links(spark, sf_dir):
    return k.check_lost_links(*_pair(spark, sf_dir))


@add("check_moved", sql(MOVED))
def check_moved(spark, sf_dir):
    return k.check_moved(*_pair(spark, sf_dir))


@add("check_unexplained_key_change", sql(UNEXPLAINED))
def check_unexplained_key_change(spark, sf_dir):
    return k.check_unexplained_key_change(*_pair(spark, sf_dir))


@add("check_counts", sql(*COUNTS))
def check_counts(spark, sf_dir):
    return k.check_counts(*_pair(spark, sf_dir))


@add("check_write_rules", sql(*WRITE))
def check_write_rules(spark, sf_dir):
    return k.check_write_rules(*_pair(spark, sf_dir))


@add("violations", with_ctes(published_ctes(), "SELECT \"check\", count(*) AS violations FROM (\n" + "\nUNION ALL ".join(
    [VERSION, *FOREIGN, *COUNTERS, OPEN_KEYS, OPEN_NAMES, OWNERSHIP, *PUBLISHED, *RULES, *LINKS,
     *LOST, LOST_LINKS, MOVED, UNEXPLAINED, *COUNTS, *WRITE]) + ") GROUP BY \"check\""))
def violations(spark, sf_dir):
    """All checks together, counted per check."""
    old, new = _pair(spark, sf_dir)
    found = [k.state_violations(new), k.published_violations(damaged_published(spark, sf_dir), old), k.version_violations(old, new)]
    return reduce(DataFrame.unionByName, found).groupBy("check").agg(F.count("*").alias("violations"))
