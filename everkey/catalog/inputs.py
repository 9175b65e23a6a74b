"""Text, keys, ids, records; flattening and corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys, text
from ..functions.records import changed_fields, fingerprint
from ..operators import corrections as c, flatten
from ..plans import workload as w
from ..plans.oracle import changes_sql, plan_sql, state_sql, with_ctes
from ..schemas import ENTITY_COMPARED, ENTITY_FIELDS, FINGERPRINT_FIELDS
from ..session import spread
from . import Catalog

catalog = Catalog()
add = catalog.add

# The white space that is stripped.
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SPACE_IN_LINE = SPACE.replace(r"\x09-\x0D", r"\x09\x0B-\x0D")


def canon_sql(column: str) -> str:
    """Trailing blanks go together with the line end that follows them."""
    ends = f"regexp_replace(nfc_normalize({column}), '\\r\\n?', chr(10), 'g')"
    lines = f"regexp_replace({ends}, '[{SPACE_IN_LINE}]+(\\n|\\z)', '\\1', 'g')"
    whole = f"regexp_replace({lines}, '\\A[{SPACE}]+|[{SPACE}]+\\z', '', 'g')"
    return f"regexp_replace({whole}, '\\n+', chr(10), 'g')"


# The documents are clean; these are the ways feeds spoil text.
DIRTY = """CASE WHEN doc_id % 11 <> 7 THEN
  CASE WHEN doc_id % 6 = 0 THEN chr(12288) || ' ' ELSE '' END
  || CASE doc_id % 3 WHEN 0 THEN replace(t, chr(10), chr(13) || chr(10)) WHEN 1 THEN replace(t, chr(10), chr(13)) ELSE t END
  || CASE WHEN doc_id % 2 = 0 THEN ' cafe' || chr(769) || chr(31) ELSE ' ' || chr(160) || chr(10) END END"""


def _dirty(column):
    number = F.col("doc_id")

    def char(code: int):
        return F.lit(chr(code))

    spaced = F.when(number % 5 == 0, F.replace(column, char(10), F.lit(" \t\n"))) \
        .when(number % 5 == 1, F.replace(column, char(10), F.lit("\n \n"))).otherwise(column)
    ends = F.when(number % 3 == 0, F.replace(spaced, char(10), F.lit("\r\n"))) \
        .when(number % 3 == 1, F.replace(spaced, char(10), F.lit("\r"))).otherwise(spaced)
    start = F.when(number % 6 == 0, F.lit(chr(12288) + " ")).otherwise("")
    end = F.when(number % 2 == 0, F.lit(" cafe" + chr(769) + chr(31))).otherwise(F.lit(" " + chr(160) + "\n"))
    return F.when(number % 11 != 7, F.concat(start, ends, end))


@add("canon_text", with_ctes({
    "spaced": """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN replace(text, chr(10), ' ' || chr(9) || chr(10))
  WHEN 1 THEN replace(text, chr(10), chr(10) || ' ' || chr(10)) ELSE text END AS t FROM documents""",
    "dirty": f"SELECT doc_id, {DIRTY} AS raw FROM spaced",
}, f"SELECT doc_id, {canon_sql('raw')} AS text FROM dirty"))
def canon_text(spark, sf_dir):
    documents = spread(w.table(spark, sf_dir, "documents").select("doc_id", "text"))
    dirty = documents.select("doc_id", _dirty(F.col("text")).alias("raw"))
    return dirty.select("doc_id", text.canon_text(F.col("raw")).alias("text"))


KEYS_FROM = """SELECT printf('%03d', page_id % 1000) || '-' || url || '-' || CASE WHEN page_id % 3 = 0 THEN 'box_t' ELSE 'b' END
  || '-' || CASE WHEN page_id % 5 = 0 THEN 'S' ELSE 's' END AS key FROM pages UNION ALL SELECT url FROM pages"""
PATTERN = "'^([0-9]+)-(.+)-([a-z_]+)-([a-z]+)$'"


@add("parse_key", state_sql(f"""SELECT key, nullif(regexp_extract(key, {PATTERN}, 1), '') AS set_number,
  nullif(regexp_extract(key, {PATTERN}, 2), '') AS name_part, nullif(regexp_extract(key, {PATTERN}, 3), '') AS product_code,
  nullif(regexp_extract(key, {PATTERN}, 4), '') AS finish_code
FROM ({KEYS_FROM} UNION ALL SELECT slug FROM r_variants)"""))
def parse_key(spark, sf_dir):
    number = F.col("page_id")
    pages = w.table(spark, sf_dir, "pages")
    made = pages.select(F.concat(
        F.format_string("%03d-", number % 1000), F.col("url"), F.when(number % 3 == 0, "-box_t").otherwise("-b"),
        F.when(number % 5 == 0, "-S").otherwise("-s")).alias("key"))
    every = made.union(pages.select("url")).union(w.state(spark, sf_dir).variants.select("slug"))
    return every.select("key", *[keys.key_part(F.col("key"), part).alias(part) for part in keys.KEY_PARTS])


@add("trim_dates", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def trim_dates(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return w.table(spark, sf_dir, "events").select("event_id", text.date_part(stamp).alias("day"))


@add("format_ids", state_sql("""SELECT variant_id, printf('P%06d', variant_id * 37) AS printing_id, printf('C%06d', entity_id * 997) AS codex_id
FROM r_variants"""))
def format_ids(spark, sf_dir):
    """Factors carry the ids past six digits."""
    return w.state(spark, sf_dir).variants.select(
        "variant_id", keys.variant_ref(F.col("variant_id") * 37).alias("printing_id"),
        keys.entity_ref(F.col("entity_id") * 997).alias("codex_id"))


@add("normalise_ids", """WITH spelled AS (SELECT l_orderkey AS n, CASE l_orderkey % 7 WHEN 0 THEN printf('C%06d', l_orderkey) WHEN 1 THEN printf('p%d', l_orderkey)
  WHEN 2 THEN l_orderkey::VARCHAR WHEN 3 THEN printf('%09d', l_orderkey) WHEN 4 THEN 'X' || l_orderkey WHEN 5 THEN 'C' ELSE chr(9) || l_orderkey || ' ' END AS spelling
  FROM lineitem)
SELECT spelling, CASE WHEN good THEN printf('C%06d', n) END AS codex_id, CASE WHEN good THEN printf('P%06d', n) END AS printing_id, good AS valid
FROM (SELECT *, n % 7 NOT IN (4, 5) AS good FROM spelled)""")
def normalise_ids(spark, sf_dir):
    number = F.col("l_orderkey")
    spelling = F.element_at(F.array(
        F.format_string("C%06d", number), F.format_string("p%d", number), number.cast("string"), F.format_string("%09d", number),
        F.concat(F.lit("X"), number), F.lit("C"), F.concat(F.lit("\t"), number, F.lit(" "))), (number % 7 + 1).cast("int"))
    spelled = w.table(spark, sf_dir, "lineitem").select(spelling.alias("spelling"))
    return spelled.select(
        "spelling", keys.normal_entity_ref(F.col("spelling")).alias("codex_id"),
        keys.normal_variant_ref(F.col("spelling")).alias("printing_id"),
        keys.id_number(F.col("spelling")).isNotNull().alias("valid"))


@add("errata_flag", state_sql("""SELECT entity_id, coalesce(starts_with(t, 'UPDATED'), FALSE) AS errata
FROM (SELECT entity_id, CASE WHEN entity_id % 19 <> 5 THEN rules_text END AS t FROM r_entities)"""))
def errata_flag(spark, sf_dir):
    maybe = F.when(F.col("entity_id") % 19 != 5, F.col("rules_text"))
    return w.state(spark, sf_dir).entities.select("entity_id", text.is_errata(maybe).alias("errata"))


@add("field_changes", plan_sql("clean", changes_sql(
    "r_entities", "(SELECT * REPLACE (CASE WHEN entity_pos % 5 <> 2 THEN attack END AS attack) FROM s_entities)",
    "o.entity_id = n.entity_pos + 1", "o.entity_id", ENTITY_COMPARED)))
def field_changes(spark, sf_dir):
    """State against snapshot by id, with nulls appearing in one of the fields."""
    entities = w.snapshot(spark, sf_dir)[0].withColumn("attack", F.when(F.col("entity_pos") % 5 != 2, F.col("attack")))
    old = w.state(spark, sf_dir).entities.select("entity_id", F.struct("*").alias("old"))
    new = entities.select((F.col("entity_pos") + 1).alias("entity_id"), F.struct("*").alias("new"))
    both = old.join(new, "entity_id").select("entity_id", F.explode(changed_fields("old", "new", ENTITY_COMPARED)).alias("change"))
    return both.select("entity_id", "change.field", "change.old", "change.new")


@add("fingerprint_groups", plan_sql("coarse", f"""SELECT {', '.join(FINGERPRINT_FIELDS)}, count(*) AS entities, min(entity_id) AS first_id
FROM r_entities GROUP BY {', '.join(FINGERPRINT_FIELDS)}"""))
def fingerprint_groups(spark, sf_dir):
    entities = w.state(spark, sf_dir, "coarse").entities
    groups = entities.groupBy(fingerprint().alias("key")).agg(F.count("*").alias("entities"), F.min("entity_id").alias("first_id"))
    return groups.select("key.*", "entities", "first_id")


# -- flattening ------------------------------------------------------------------------

def payload_ctes(repeats: bool) -> dict[str, str]:
    copy = "o_orderkey % 97 = 5" if repeats else "FALSE"
    threshold = "CASE WHEN c % 2 = 0 THEN {} ELSE 0 END::INT"
    return {
        "source": f"""SELECT o_orderkey AS entity_pos, o_custkey AS c, o_orderpriority AS priority, o_orderstatus AS status,
  o_orderkey - CASE WHEN {copy} THEN 1 ELSE 0 END AS number FROM orders""",
        "common": f"""SELECT *, 'Order ' || number AS entity_name, priority AS type, status AS rarity,
  (c % 10)::INT AS cost, NULL::INT AS attack, 2 AS defence, {threshold.format('c % 3')} AS thr_air,
  0 AS thr_earth, {threshold.format('1')} AS thr_fire, 0 AS thr_water FROM source""",
        "flat_entities": """SELECT entity_pos, entity_name AS name, type, rarity, NULL::VARCHAR AS subtypes,
  CASE WHEN c % 5 = 0 THEN 'Air, Fire' END AS elements, cost, attack, defence, NULL::INT AS life,
  thr_air, thr_earth, thr_fire, thr_water, 'First' || chr(10) || 'line ' || c AS rules_text FROM common""",
        "flat_sets": "SELECT *, unnest(range(1, entity_pos % 4 + 1)) AS set_no FROM common",
        "flat_pieces": "SELECT *, unnest(range(0, (c + set_no) % 3 + 1)) AS variant_pos FROM flat_sets",
        "flat_variants": """SELECT entity_pos, set_no - 1 AS set_pos, variant_pos, entity_name,
  printf('%03d-order_%d-%s-%s', set_no, number, CASE variant_pos WHEN 0 THEN 'b' WHEN 1 THEN 'box_t' ELSE 'd' END,
    CASE WHEN set_no % 2 = 0 THEN 'f' ELSE 's' END) AS slug,
  'Set ' || set_no AS set_name, printf('%03d', set_no) AS set_number,
  CASE WHEN set_no % 3 <> 0 THEN '2023-0' || set_no || '-01' END AS released_at, 'Product ' || variant_pos AS product,
  CASE WHEN set_no % 2 = 0 THEN 'Foil' ELSE 'Standard' END AS finish, CASE WHEN variant_pos = 0 THEN 'Ánn' END AS artist,
  NULL::VARCHAR AS flavour_text, 'Type' || chr(10) || priority AS type_text, type, rarity, '' AS rules_text,
  cost, attack, defence, set_no::INT AS life, thr_air, thr_earth, thr_fire, thr_water, NULL::VARCHAR AS image_hash
FROM flat_pieces""",
    }


@add("flatten_entities", with_ctes(payload_ctes(False), f"SELECT entity_pos, {', '.join(ENTITY_FIELDS)} FROM flat_entities"))
def flatten_entities(spark, sf_dir):
    return flatten.flatten_entities(w.payload(spark, sf_dir))


@add("flatten_variants", with_ctes(payload_ctes(False), "SELECT * FROM flat_variants"))
def flatten_variants(spark, sf_dir):
    return flatten.flatten_variants(w.payload(spark, sf_dir))


@add("duplicate_names", with_ctes(payload_ctes(True), "SELECT name, count(*) AS copies FROM flat_entities GROUP BY name HAVING count(*) > 1"))
def duplicate_names(spark, sf_dir):
    return flatten.duplicate_names(flatten.flatten_entities(w.payload(spark, sf_dir, repeats=True)))


@add("duplicate_keys", with_ctes(payload_ctes(True), "SELECT slug, count(*) AS copies FROM flat_variants GROUP BY slug HAVING count(*) > 1"))
def duplicate_keys(spark, sf_dir):
    return flatten.duplicate_keys(flatten.flatten_variants(w.payload(spark, sf_dir, repeats=True)))


# -- corrections -------------------------------------------------------------------------

CORRECTED = "entity_pos % 50"


@add("apply_corrections", plan_sql("plain", f"""SELECT entity_pos, {', '.join('e.' + f for f in ENTITY_FIELDS if f not in ('attack', 'cost'))},
  CASE WHEN {CORRECTED} <> 0 THEN attack END AS attack, CASE WHEN {CORRECTED} = 2 THEN 99 ELSE cost END AS cost FROM s_entities e"""))
def apply_corrections(spark, sf_dir):
    entities, variants = w.snapshot(spark, sf_dir, "plain")
    return c.apply_corrections(entities, variants, w.corrections(spark, sf_dir))[0]


@add("apply_corrections_variants", plan_sql("plain", f"""SELECT * REPLACE (
  CASE WHEN {CORRECTED} <> 0 THEN attack END AS attack, CASE WHEN {CORRECTED} = 2 THEN 99 ELSE cost END AS cost,
  CASE WHEN {CORRECTED} = 1 AND set_name = 'NATION_3' THEN 'Corrected' ELSE rarity END AS rarity,
  CASE WHEN {CORRECTED} = 3 THEN 'Wide' WHEN {CORRECTED} = 4 AND set_name = 'NATION_5' THEN 'Narrow'
       WHEN {CORRECTED} = 4 THEN 'Wide' ELSE artist END AS artist) FROM s_variants"""))
def apply_corrections_variants(spark, sf_dir):
    entities, variants = w.snapshot(spark, sf_dir, "plain")
    return c.apply_corrections(entities, variants, w.corrections(spark, sf_dir))[1]


@add("unmatched_corrections", plan_sql("plain", """SELECT entity_id * 10 + 1 AS ord, 'ghost ' || name AS name,
  NULL::VARCHAR AS set_name, 'checked by hand' AS reason FROM parts WHERE entity_id % 50 = 6
UNION ALL SELECT entity_id * 10 + 1, name, 'NATION_99', 'checked by hand' FROM parts WHERE entity_id % 50 = 7
UNION ALL SELECT entity_id * 10 + 1, name, 'NATION_3', 'checked by hand' FROM parts p WHERE entity_id % 50 = 2
  AND NOT EXISTS (SELECT 1 FROM s_variants v WHERE v.entity_name = p.name AND v.set_name = 'NATION_3')
UNION ALL SELECT entity_id * 10 + CASE entity_id % 50 WHEN 4 THEN 2 ELSE 5 END, name, 'NATION_5', 'checked by hand' FROM parts p WHERE entity_id % 50 IN (4, 5)
  AND NOT EXISTS (SELECT 1 FROM s_variants v WHERE v.entity_name = p.name AND v.set_name = 'NATION_5')"""))
def unmatched_corrections(spark, sf_dir):
    entities, variants = w.snapshot(spark, sf_dir, "plain")
    return c.unmatched_corrections(entities, variants, w.corrections(spark, sf_dir))
