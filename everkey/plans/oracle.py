"""Independent SQL for every query, run by DuckDB on the same tables.

The SQL follows the rules as they are stated (lists of missing and added rows,
windows over groups), not the joins the Spark operators use.
"""

from __future__ import annotations

from ..schemas import (
    ENTITY_COMPARED, ENTITY_FIELDS, FINGERPRINT_FIELDS, PAIR_FIELDS, VARIANT_COMPARED,
    VARIANT_FIELDS,
)
from .workload import AS_OF, CLOSED_FROM, OPEN_FROM, RETIRED_AT, SCENARIOS, Scenario


def with_ctes(ctes: dict[str, str], query: str) -> str:
    listed = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes.items())
    return f"WITH {listed}\n{query}"


# -- inputs ---------------------------------------------------------------------

def entity_columns(coarse: bool) -> str:
    text = "p_type" if coarse else (
        "CASE WHEN (p_partkey + 1) % 17 = 0 THEN 'UPDATED ' ELSE '' END || p_name || ' ' || (p_partkey // 4)")
    return f"""p_partkey + 1 AS entity_id, p_name || ' #' || p_partkey AS name, p_type AS type, p_brand AS rarity,
  CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS subtypes,
  CASE length(p_type) % 3 WHEN 0 THEN 'Air' WHEN 1 THEN 'Earth, Fire' END AS elements,
  p_size AS cost, CASE WHEN length(p_type) % 2 = 0 THEN length(p_type)::INT END AS attack,
  NULL::INT AS defence, NULL::INT AS life, (length(p_type) % 3)::INT AS thr_air,
  0 AS thr_earth, 0 AS thr_fire, 0 AS thr_water, {text} AS rules_text"""


VARIANT_COLUMNS = """set_name, '2023-' || printf('%02d', nk % 12 + 1) || '-' || printf('%02d', nk + 1) AS released_at,
  product, finish, NULL::VARCHAR AS flavour_text, NULL::VARCHAR AS type_text, NULL::VARCHAR AS type,
  NULL::VARCHAR AS rarity, NULL::VARCHAR AS rules_text, NULL::INT AS cost, NULL::INT AS attack,
  NULL::INT AS defence, NULL::INT AS life, 0 AS thr_air, 0 AS thr_earth, 0 AS thr_fire, 0 AS thr_water,
  NULL::VARCHAR AS image_hash"""


def slug(offset: str) -> str:
    return f"printf('%03d-part_%d_s%d-%s-%s', nk + {offset}, entity_id, sk, lower(product), lower(finish))"


RENUMBERED = "CASE WHEN sk % 5 = 0 THEN 101 ELSE 1 END"


def inputs(s: Scenario, corrupt: bool = False) -> dict[str, str]:
    """State, snapshot and decisions of a scenario."""
    stored = "entity_id % 10 <> 0" if s.changes else "TRUE"
    retired = f"CASE WHEN (entity_id + sk) % 29 = 0 THEN '{RETIRED_AT}' END" if s.changes else "NULL::VARCHAR"
    renamed = "name || CASE WHEN entity_id % 20 = 1 THEN ' (renamed)' ELSE '' END" if s.changes else "name"
    dearer = "cost + CASE WHEN entity_id % 7 = 3 AND entity_id % 20 <> 1 THEN 1 ELSE 0 END" if s.changes else "cost"
    moves = "(entity_id % 40 = 3 AND sk % 3 = 0)" if s.changes else "FALSE"
    artist = "artist || CASE WHEN entity_id % 9 = 4 THEN ' II' ELSE '' END" if s.changes else "artist"
    rest = ", ".join(f for f in ENTITY_FIELDS if f not in ("name", "cost"))
    contested = f"""
  UNION ALL SELECT {slug('1')}, variant_id + 1, '{CLOSED_FROM}', '{OPEN_FROM}' FROM numbered
  WHERE entity_id % 100 = 9""" if corrupt else ""
    ctes = {
        "base": """SELECT DISTINCT l_partkey + 1 AS entity_id, l_suppkey AS sk, n_nationkey::BIGINT AS nk,
  n_name AS set_name, s_name AS artist, l_returnflag AS product, l_linestatus AS finish
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
        "parts": f"SELECT {entity_columns(s.coarse)} FROM part",
        "r_entities": f"SELECT * FROM parts WHERE {stored}",
        "s_entities": f"""SELECT entity_id - 1 AS entity_pos, {renamed} AS name, ({dearer})::INT AS cost, {rest}
FROM parts WHERE {'entity_id % 50 <> 3' if s.drops else 'TRUE'}""",
        "numbered": f"""SELECT *, row_number() OVER (ORDER BY entity_id, sk, product, finish) AS variant_id
FROM base WHERE sk % 13 <> 4 AND {stored}""",
        "r_variants": f"""SELECT variant_id, entity_id, {slug('1')} AS slug, printf('%03d', nk + 1) AS set_number,
  artist, {VARIANT_COLUMNS}, {retired} AS retired_at FROM numbered""",
        "s_placed": f"SELECT *, {moves} AS moves, entity_id + CASE WHEN {moves} THEN 1 ELSE 0 END AS owner FROM base WHERE sk % 11 <> 3",
        "s_variants": f"""SELECT owner - 1 AS entity_pos, nk AS set_pos,
  (sk * 6 + instr('ANR', product) * 2 + instr('FO', finish)) * 2 + CASE WHEN moves THEN 1 ELSE 0 END AS variant_pos,
  e.name AS entity_name, {slug(RENUMBERED)} AS slug, printf('%03d', nk + {RENUMBERED}) AS set_number,
  {artist} AS artist, {VARIANT_COLUMNS}
FROM (SELECT p.* FROM s_placed p) JOIN (SELECT entity_pos + 1 AS owner, name FROM s_entities) e USING (owner)""",
        "key_history": f"""SELECT {slug('1')} AS slug, variant_id, '{OPEN_FROM}' AS valid_from, NULL::VARCHAR AS valid_to FROM numbered
  UNION ALL SELECT 'old-' || {slug('1')}, variant_id, '{CLOSED_FROM}', '{OPEN_FROM}' FROM numbered WHERE sk % 7 = 2
  UNION ALL SELECT {slug('101')}, variant_id + 1, '{CLOSED_FROM}', '{OPEN_FROM}' FROM numbered
  WHERE sk % 5 = 0 AND entity_id % 50 = 7{contested}""",
        "name_history": f"""SELECT name, entity_id, '{OPEN_FROM}' AS valid_from, NULL::VARCHAR AS valid_to FROM r_entities
  UNION ALL SELECT 'old ' || name, entity_id, '{CLOSED_FROM}', '{OPEN_FROM}' FROM r_entities WHERE entity_id % 7 = 2
  UNION ALL SELECT 'legacy ' || p_name, p_partkey + 1, '{CLOSED_FROM}', '{OPEN_FROM}' FROM part
  WHERE (p_partkey + 1) % 25 = 6 AND {stored.replace('entity_id', '(p_partkey + 1)')}""",
    }
    if s.decided:
        calm = "entity_id % 20 <> 1 AND entity_id % 40 <> 3"
        active = f"(entity_id + sk) % 29 <> 0 AND {calm}"
        ctes |= {
            "d_entity_renames": "SELECT entity_id, name || ' (renamed)' AS new_name FROM r_entities WHERE entity_id % 100 = 1",
            "d_new_entities": "SELECT name FROM s_entities WHERE (entity_pos + 1) % 40 = 0",
            "d_variant_renames": f"""SELECT variant_id, {slug('101')} AS new_slug FROM numbered WHERE {active}
  AND sk % 5 = 0 AND sk % 11 <> 3 AND entity_id % 50 <> 7 AND entity_id % 30 = 2""",
            "d_new_variants": f"""SELECT {slug(RENUMBERED)} AS slug FROM base WHERE {calm} AND sk % 13 = 4 AND sk % 11 <> 3
  AND entity_id % 10 <> 0 AND entity_id % 30 = 5""",
            "d_retire": f"SELECT variant_id FROM numbered WHERE {active} AND sk % 11 = 3 AND entity_id % 30 = 4",
        }
    else:
        none = "SELECT 0::BIGINT AS {} WHERE FALSE"
        ctes |= {
            "d_entity_renames": "SELECT 0::BIGINT AS entity_id, '' AS new_name WHERE FALSE",
            "d_new_entities": "SELECT '' AS name WHERE FALSE",
            "d_variant_renames": "SELECT 0::BIGINT AS variant_id, '' AS new_slug WHERE FALSE",
            "d_new_variants": "SELECT '' AS slug WHERE FALSE",
            "d_retire": none.format("variant_id"),
        }
    return ctes


# -- classification ---------------------------------------------------------------

def changes_sql(old: str, new: str, on: str, keys: str, fields: list[str], where: str = "TRUE") -> str:
    """One row per differing field."""
    return "\nUNION ALL ".join(
        f"SELECT {keys}, '{f}' AS field, o.{f}::VARCHAR AS old, n.{f}::VARCHAR AS new FROM {old} o JOIN {new} n ON {on} "
        f"WHERE o.{f} IS DISTINCT FROM n.{f} AND {where}" for f in fields)


def diff_ctes() -> dict[str, str]:
    prints = ", ".join(FINGERPRINT_FIELDS)
    pair = ", ".join(["entity_name", *PAIR_FIELDS])
    positions = ", ".join(PAIR_FIELDS)
    return {
        "e_missing": "SELECT * FROM r_entities WHERE name NOT IN (SELECT name FROM s_entities)",
        "e_added": "SELECT * FROM s_entities WHERE name NOT IN (SELECT name FROM r_entities)",
        "e_human": """SELECT d.entity_id, m.name AS old_name, d.new_name
FROM d_entity_renames d JOIN e_missing m USING (entity_id) JOIN e_added a ON a.name = d.new_name""",
        "e_open": f"""SELECT 'missing' AS side, entity_id, name, {prints} FROM e_missing
  WHERE name NOT IN (SELECT old_name FROM e_human)
UNION ALL SELECT 'added', NULL, name, {prints} FROM e_added
  WHERE name NOT IN (SELECT new_name FROM e_human) AND name NOT IN (SELECT name FROM d_new_entities)""",
        "e_group": f"""SELECT side, entity_id, name,
  count(*) FILTER (side = 'missing') OVER g AS n_missing, count(*) FILTER (side = 'added') OVER g AS n_added,
  min(name) FILTER (side = 'missing') OVER g AS old_name, min(name) FILTER (side = 'added') OVER g AS new_name,
  min(entity_id) OVER g AS first_id
FROM e_open WINDOW g AS (PARTITION BY {prints})""",
        "e_renames": """SELECT entity_id, old_name, new_name, 'human' AS decided_by FROM e_human
UNION ALL SELECT entity_id, old_name, new_name, 'fingerprint' FROM e_group
  WHERE n_missing = 1 AND n_added = 1 AND side = 'missing'""",
        "e_shared": """SELECT 'entity:fingerprint:' || first_id AS case_id, side, entity_id, name FROM e_group
WHERE n_missing > 0 AND n_added > 0 AND NOT (n_missing = 1 AND n_added = 1)""",
        "e_left": "SELECT side, entity_id, name FROM e_group WHERE n_missing = 0 OR n_added = 0",
        "e_gate": """SELECT (SELECT count(*) FROM e_left WHERE side = 'missing') > 0
  AND (SELECT count(*) FROM e_left WHERE side = 'added') > 0 AS closed""",
        "e_members": """SELECT * FROM e_shared
UNION ALL SELECT 'entity:unexplained', side, entity_id, name FROM e_left WHERE (SELECT closed FROM e_gate)""",
        "e_cased": "SELECT DISTINCT name FROM e_members",
        "e_new": """SELECT name FROM e_left WHERE side = 'added' AND NOT (SELECT closed FROM e_gate)
UNION ALL SELECT name FROM d_new_entities""",
        "e_gone": "SELECT entity_id, name FROM e_left WHERE side = 'missing' AND NOT (SELECT closed FROM e_gate)",
        "e_now": """SELECT r.*, coalesce(x.new_name, r.name) AS effective_name
FROM r_entities r LEFT JOIN e_renames x ON x.entity_id = r.entity_id""",
        "e_updates": changes_sql("e_now", "s_entities", "o.effective_name = n.name",
                                 "o.entity_id, n.name AS name", ENTITY_COMPARED),
        "v_now": """SELECT v.*, e.name AS entity_name, e.effective_name,
  e.name IN (SELECT name FROM e_cased) AS cased FROM r_variants v JOIN e_now e USING (entity_id)""",
        "v_same": """SELECT o.variant_id, o.slug, o.retired_at, o.entity_name, n.entity_name AS new_entity_name,
  o.effective_name <> n.entity_name AS taken FROM v_now o JOIN s_variants n USING (slug)""",
        "v_missing": """SELECT * FROM v_now WHERE slug NOT IN (SELECT slug FROM s_variants)
  AND retired_at IS NULL AND NOT cased""",
        "v_added": """SELECT * FROM s_variants WHERE slug NOT IN (SELECT slug FROM r_variants)
  AND entity_name NOT IN (SELECT name FROM e_cased)""",
        "v_human": """SELECT d.variant_id, m.slug AS old_slug, d.new_slug FROM d_variant_renames d
JOIN v_missing m USING (variant_id) JOIN v_added a ON a.slug = d.new_slug""",
        "v_open": f"""SELECT 'missing' AS side, variant_id, slug, effective_name AS entity_name, {positions} FROM v_missing
  WHERE slug NOT IN (SELECT old_slug FROM v_human) AND variant_id NOT IN (SELECT variant_id FROM d_retire)
UNION ALL SELECT 'added', NULL, slug, entity_name, {positions} FROM v_added
  WHERE slug NOT IN (SELECT new_slug FROM v_human) AND slug NOT IN (SELECT slug FROM d_new_variants)""",
        "v_group": f"""SELECT *, n_missing = 1 AND n_added = 1 AS paired FROM (SELECT *,
  count(*) FILTER (side = 'missing') OVER g AS n_missing, count(*) FILTER (side = 'added') OVER g AS n_added,
  min(slug) FILTER (side = 'missing') OVER g AS old_slug, min(slug) FILTER (side = 'added') OVER g AS new_slug
FROM v_open WINDOW g AS (PARTITION BY {pair}))""",
        "v_left": f"""SELECT side, variant_id, slug, entity_name, {positions},
  count(*) FILTER (side = 'missing') OVER e > 0 AND count(*) FILTER (side = 'added') OVER e > 0 AS in_case
FROM v_group WHERE NOT paired WINDOW e AS (PARTITION BY entity_name)""",
        "owners": "SELECT slug, max(variant_id) AS owner_id FROM key_history GROUP BY slug",
        "v_renaming": """SELECT variant_id, old_slug, new_slug, 'human' AS decided_by FROM v_human
UNION ALL SELECT variant_id, old_slug, new_slug, 'set+product+finish' FROM v_group WHERE paired AND side = 'missing'""",
        "v_fresh": """SELECT slug FROM v_left WHERE side = 'added' AND NOT in_case
UNION ALL SELECT slug FROM d_new_variants""",
        "v_renames": """SELECT x.* FROM v_renaming x LEFT JOIN owners o ON o.slug = x.new_slug
WHERE o.owner_id IS NULL OR o.owner_id = x.variant_id""",
        "v_new": "SELECT slug FROM v_fresh WHERE slug NOT IN (SELECT slug FROM owners)",
        "v_owned": """SELECT new_slug AS slug, owner_id, variant_id AS attempted_id FROM v_renaming x
  JOIN owners o ON o.slug = x.new_slug WHERE o.owner_id <> x.variant_id
UNION ALL SELECT slug, owner_id, NULL FROM v_fresh JOIN owners USING (slug)""",
        "v_retire": """SELECT variant_id, slug, 'no candidate' AS decided_by FROM v_left WHERE side = 'missing' AND NOT in_case
UNION ALL SELECT variant_id, slug, 'human' FROM v_missing WHERE variant_id IN (SELECT variant_id FROM d_retire)""",
        "v_unretire": "SELECT variant_id, slug FROM v_same WHERE NOT taken AND retired_at IS NOT NULL",
        "v_pairs": """SELECT variant_id, slug AS old_slug, slug AS new_slug FROM v_same WHERE NOT taken
UNION ALL SELECT variant_id, old_slug, new_slug FROM v_renames""",
        "v_old": "SELECT p.new_slug, v.* FROM v_pairs p JOIN r_variants v USING (variant_id)",
        "v_updates": changes_sql("v_old", "s_variants", "o.new_slug = n.slug",
                                 "o.variant_id, n.slug AS slug", VARIANT_COMPARED),
        "v_members": f"""SELECT 'variant:' || entity_name AS case_id, side, variant_id, slug, entity_name, {positions}
  FROM v_left WHERE in_case
UNION ALL SELECT 'variant:key:' || slug, 'missing', variant_id, slug, v.entity_name, {positions}
  FROM v_now v WHERE slug IN (SELECT slug FROM v_same WHERE taken)
UNION ALL SELECT 'variant:key:' || slug, 'added', NULL, slug, entity_name, {positions}
  FROM s_variants WHERE slug IN (SELECT slug FROM v_same WHERE taken)""",
        "v_cases": """SELECT case_id, count(*) FILTER (side = 'missing') AS n_missing, count(*) FILTER (side = 'added') AS n_candidates,
  NULL::VARCHAR AS slug, NULL::BIGINT AS owner_id, NULL::BIGINT AS attempted_id FROM v_members
  WHERE case_id NOT LIKE 'variant:key:%' GROUP BY case_id
UNION ALL SELECT 'variant:key:' || slug, 1, 1, slug, NULL, NULL FROM v_same WHERE taken
UNION ALL SELECT 'variant:owner:' || slug, 0, 0, slug, owner_id, attempted_id FROM v_owned""",
    }


def plan_sql(scenario: str, query: str) -> str:
    return with_ctes(inputs(SCENARIOS[scenario]) | diff_ctes(), query)


# -- next version -------------------------------------------------------------------

def next_ctes() -> dict[str, str]:
    entity = ", ".join(f"CASE WHEN n.name IS NULL THEN r.{f} ELSE n.{f} END AS {f}" for f in ENTITY_FIELDS)
    taken = [f for f in VARIANT_FIELDS if f != "image_hash"]
    variant = ", ".join(f"CASE WHEN n.slug IS NULL THEN r.{f} ELSE n.{f} END AS {f}" for f in taken)
    return {
        "n_new_entities": f"""SELECT (SELECT max(p_partkey) + 1 FROM part) + row_number() OVER (ORDER BY entity_pos) AS entity_id,
  {', '.join(ENTITY_FIELDS)} FROM s_entities WHERE name IN (SELECT name FROM e_new)""",
        "n_entities": f"""SELECT r.entity_id, {entity} FROM e_now r LEFT JOIN s_entities n ON n.name = r.effective_name
UNION ALL SELECT entity_id, {', '.join(ENTITY_FIELDS)} FROM n_new_entities""",
        "n_new_variants": f"""SELECT (SELECT count(*) FROM r_variants) + row_number() OVER (ORDER BY entity_pos, set_pos, variant_pos) AS variant_id,
  entity_name, {', '.join(VARIANT_FIELDS)} FROM s_variants WHERE slug IN (SELECT slug FROM v_new)""",
        "n_variants": f"""SELECT r.variant_id, r.entity_id, {variant}, r.image_hash,
  CASE WHEN r.variant_id IN (SELECT variant_id FROM v_retire) THEN '{AS_OF}'
       WHEN r.variant_id NOT IN (SELECT variant_id FROM v_unretire) THEN r.retired_at END AS retired_at
FROM r_variants r LEFT JOIN v_pairs p USING (variant_id) LEFT JOIN s_variants n ON n.slug = p.new_slug
UNION ALL SELECT v.variant_id, e.entity_id, {', '.join('v.' + f for f in taken)}, v.image_hash, NULL
FROM n_new_variants v JOIN n_entities e ON e.name = v.entity_name""",
        "n_key_history": f"""SELECT h.slug, h.variant_id, h.valid_from,
  CASE WHEN h.valid_to IS NULL AND x.variant_id IS NOT NULL THEN '{AS_OF}' ELSE h.valid_to END AS valid_to
FROM key_history h LEFT JOIN v_renames x ON x.variant_id = h.variant_id AND x.old_slug = h.slug
UNION ALL SELECT new_slug, variant_id, '{AS_OF}', NULL FROM v_renames
UNION ALL SELECT slug, variant_id, '{AS_OF}', NULL FROM n_new_variants""",
        "n_name_history": f"""SELECT h.name, h.entity_id, h.valid_from,
  CASE WHEN h.valid_to IS NULL AND x.entity_id IS NOT NULL THEN '{AS_OF}' ELSE h.valid_to END AS valid_to
FROM name_history h LEFT JOIN e_renames x ON x.entity_id = h.entity_id AND x.old_name = h.name
UNION ALL SELECT new_name, entity_id, '{AS_OF}', NULL FROM e_renames
UNION ALL SELECT name, entity_id, '{AS_OF}', NULL FROM n_new_entities""",
    }


def next_sql(scenario: str, query: str) -> str:
    return with_ctes(inputs(SCENARIOS[scenario]) | diff_ctes() | next_ctes(), query)


def state_sql(query: str, scenario: str = "clean", corrupt: bool = False) -> str:
    return with_ctes(inputs(SCENARIOS[scenario], corrupt), query)
