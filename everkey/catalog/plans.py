"""Classification of differences, and the next version of the state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import entity_diff as ed, variant_diff as vd
from ..operators.apply import allocate_variants, apply_plan, empty_state
from ..operators.history import history_from_observations
from ..plans import workload as w
from ..plans.oracle import diff_ctes, inputs, next_sql, plan_sql, state_sql, with_ctes
from ..plans.summary import CLASSES, change_counts
from ..schemas import ENTITY_FIELDS, VARIANT_FIELDS
from . import Catalog

catalog = Catalog()
add = catalog.add


def _exploded(updates: DataFrame, *keys: str) -> DataFrame:
    return updates.select(*keys, F.explode("changes").alias("change")).select(
        *keys, "change.field", "change.old", "change.new")


@add("missing_entities", plan_sql("clean", "SELECT entity_id, name FROM e_missing"))
def missing_entities(spark, sf_dir):
    return ed.missing_entities(w.state(spark, sf_dir).entities, w.snapshot(spark, sf_dir)[0]).select("entity_id", "name")


@add("added_entities", plan_sql("clean", "SELECT entity_pos, name FROM e_added"))
def added_entities(spark, sf_dir):
    return ed.added_entities(w.state(spark, sf_dir).entities, w.snapshot(spark, sf_dir)[0]).select("entity_pos", "name")


RENAMES = "SELECT entity_id, old_name, new_name, decided_by FROM e_renames"


@add("plan_entity_renames", plan_sql("clean", RENAMES))
def plan_entity_renames(spark, sf_dir):
    return ed.entity_renames(w.entity_plan(spark, sf_dir))


@add("plan_entity_renames_decided", plan_sql("decided", RENAMES))
def plan_entity_renames_decided(spark, sf_dir):
    return ed.entity_renames(w.entity_plan(spark, sf_dir, "decided"))


CASES = """SELECT case_id, 'entity' AS kind,
  CASE WHEN case_id = 'entity:unexplained' THEN 'entities vanished while others appeared and nothing links them'
       ELSE 'several vanished and new entities look the same' END AS problem,
  count(*) FILTER (side = 'missing') AS n_missing, count(*) FILTER (side = 'added') AS n_candidates
FROM e_members GROUP BY case_id"""


@add("plan_entity_cases", plan_sql("coarse", CASES))
def plan_entity_cases(spark, sf_dir):
    return ed.entity_cases(w.entity_plan(spark, sf_dir, "coarse"))


@add("plan_entity_fail_closed", plan_sql("failclosed", CASES))
def plan_entity_fail_closed(spark, sf_dir):
    return ed.entity_cases(w.entity_plan(spark, sf_dir, "failclosed"))


def _members(scenario):
    fields = "name, rules_text, type, cost, attack, defence, life, thr_air, thr_earth, thr_fire, thr_water"
    both = f"SELECT 'missing' AS side, {fields} FROM r_entities UNION ALL SELECT 'added', {fields} FROM s_entities"
    return plan_sql(scenario, f"""SELECT case_id, side, entity_id, b.* EXCLUDE (side)
FROM e_members JOIN ({both}) b USING (side, name)""")


@add("entity_case_members", _members("failclosed"))
def entity_case_members(spark, sf_dir):
    members = ed.entity_case_members(w.entity_plan(spark, sf_dir, "failclosed"))
    thresholds = [F.col(f"summary.thresholds.{e}").alias(f"thr_{e}") for e in ("air", "earth", "fire", "water")]
    plain = ["name", "rules_text", "type", "cost", "attack", "defence", "life"]
    return members.select("case_id", "side", "entity_id", *[f"summary.{f}" for f in plain], *thresholds)


@add("cased_names", plan_sql("coarse", "SELECT name FROM e_cased"))
def cased_names(spark, sf_dir):
    return ed.cased_names(w.entity_plan(spark, sf_dir, "coarse"))


NEW = f"SELECT entity_pos, {', '.join(ENTITY_FIELDS)} FROM s_entities WHERE name IN (SELECT name FROM e_new)"


@add("plan_new_entities", plan_sql("clean", NEW))
def plan_new_entities(spark, sf_dir):
    return ed.new_entities(w.entity_plan(spark, sf_dir))


@add("plan_new_entities_decided", plan_sql("decided", NEW))
def plan_new_entities_decided(spark, sf_dir):
    return ed.new_entities(w.entity_plan(spark, sf_dir, "decided"))


@add("plan_gone_entities", plan_sql("clean", """SELECT entity_id, name FROM e_left WHERE side = 'missing'
UNION ALL SELECT entity_id, name FROM r_entities WHERE entity_id % 9 = 4"""))
def plan_gone_entities(spark, sf_dir):
    """A snapshot that brings nothing new but lacks a ninth of the entities."""
    entities = w.state(spark, sf_dir).entities
    fewer = entities.where("entity_id % 9 != 4").withColumn("entity_pos", F.col("entity_id") - 1).drop("entity_id")
    return ed.gone_entities(ed.classify_entities(entities, fewer))


@add("plan_entity_updates", plan_sql("clean", "SELECT entity_id, name, field, old, new FROM e_updates"))
def plan_entity_updates(spark, sf_dir):
    return _exploded(ed.entity_updates(w.entity_plan(spark, sf_dir)), "entity_id", "name")


@add("pair_one_to_one", """WITH sides AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'missing' ELSE 'added' END AS side, doc_id, text FROM documents),
groups AS (SELECT text, count(*) FILTER (side = 'missing') AS n_missing, count(*) FILTER (side = 'added') AS n_added,
  min(doc_id) FILTER (side = 'missing') AS old_id, min(doc_id) FILTER (side = 'added') AS new_id FROM sides GROUP BY text)
SELECT old_id, new_id, n_missing, n_added, n_missing = 1 AND n_added = 1 AS paired FROM groups
WHERE n_missing > 0 AND n_added > 0""")
def pair_one_to_one(spark, sf_dir):
    side = F.when(F.col("doc_id") % 2 == 0, ed.MISSING).otherwise(ed.ADDED)
    sides = w.table(spark, sf_dir, "documents").select("doc_id", "text", side.alias("side"))
    counted = ed.pair_counts(sides, F.col("text"), ed.only(ed.MISSING, "doc_id", "old_id"), ed.only(ed.ADDED, "doc_id", "new_id"))
    return counted.where("n_missing > 0 and n_added > 0").select(
        "old_id", "new_id", "n_missing", "n_added",
        ((F.col("n_missing") == 1) & (F.col("n_added") == 1)).alias("paired"))


# -- variants ------------------------------------------------------------------------

@add("plan_key_taken_over", plan_sql("clean", "SELECT variant_id, slug, entity_name, new_entity_name FROM v_same WHERE taken"))
def plan_key_taken_over(spark, sf_dir):
    return vd.taken_over(w.plan(spark, sf_dir)[1])


@add("plan_unretire", plan_sql("clean", "SELECT variant_id, slug FROM v_unretire"))
def plan_unretire(spark, sf_dir):
    return vd.unretirements(w.plan(spark, sf_dir)[1])


@add("plan_variant_updates", plan_sql("clean", "SELECT variant_id, slug, field, old, new FROM v_updates"))
def plan_variant_updates(spark, sf_dir):
    return _exploded(vd.variant_updates(w.plan(spark, sf_dir)[1]), "variant_id", "slug")


VARIANT_RENAMES = "SELECT variant_id, old_slug, new_slug, decided_by FROM v_renames"


@add("plan_variant_renames", plan_sql("clean", VARIANT_RENAMES))
def plan_variant_renames(spark, sf_dir):
    return vd.variant_renames(w.plan(spark, sf_dir)[1])


@add("plan_variant_renames_decided", plan_sql("decided", VARIANT_RENAMES))
def plan_variant_renames_decided(spark, sf_dir):
    return vd.variant_renames(w.plan(spark, sf_dir, "decided")[1])


VARIANT_CASES = "SELECT case_id, n_missing, n_candidates, slug, owner_id, attempted_id FROM v_cases"


@add("plan_variant_cases", plan_sql("clean", VARIANT_CASES))
def plan_variant_cases(spark, sf_dir):
    return vd.variant_cases(w.plan(spark, sf_dir)[1]).drop("kind", "problem")


@add("plan_variant_cases_coarse", plan_sql("coarse", VARIANT_CASES))
def plan_variant_cases_coarse(spark, sf_dir):
    return vd.variant_cases(w.plan(spark, sf_dir, "coarse")[1]).drop("kind", "problem")


@add("variant_case_members", plan_sql("clean", "SELECT * FROM v_members"))
def variant_case_members(spark, sf_dir):
    return vd.variant_case_members(w.plan(spark, sf_dir)[1])


RETIRE = "SELECT variant_id, slug, decided_by FROM v_retire"


@add("plan_retire", plan_sql("clean", RETIRE))
def plan_retire(spark, sf_dir):
    return vd.retirements(w.plan(spark, sf_dir)[1])


@add("plan_retire_decided", plan_sql("decided", RETIRE))
def plan_retire_decided(spark, sf_dir):
    return vd.retirements(w.plan(spark, sf_dir, "decided")[1])


NEW_VARIANTS = f"""SELECT entity_pos, set_pos, variant_pos, entity_name, {', '.join(VARIANT_FIELDS)}
FROM s_variants WHERE slug IN (SELECT slug FROM v_new)"""


@add("plan_new_variants", plan_sql("clean", NEW_VARIANTS))
def plan_new_variants(spark, sf_dir):
    return vd.new_variants(w.plan(spark, sf_dir)[1])


@add("plan_new_variants_decided", plan_sql("decided", NEW_VARIANTS))
def plan_new_variants_decided(spark, sf_dir):
    return vd.new_variants(w.plan(spark, sf_dir, "decided")[1])


OWNED = "SELECT slug, owner_id, attempted_id FROM v_owned"


@add("plan_ownership_veto", plan_sql("plain", OWNED))
def plan_ownership_veto(spark, sf_dir):
    return vd.ownership_vetoes(w.plan(spark, sf_dir, "plain")[1])


@add("plan_ownership_veto_clean", plan_sql("clean", OWNED))
def plan_ownership_veto_clean(spark, sf_dir):
    return vd.ownership_vetoes(w.plan(spark, sf_dir)[1])


def _summary_sql() -> str:
    tables = {
        "new entities": "e_new", "entity renames": "e_renames",
        "entity updates": "(SELECT DISTINCT entity_id FROM e_updates)", "new variants": "v_new",
        "variant renames": "v_renames", "variant updates": "(SELECT DISTINCT variant_id FROM v_updates)",
        "retired": "v_retire", "unretired": "v_unretire",
        "cases": "(SELECT DISTINCT case_id FROM e_members UNION ALL SELECT case_id FROM v_cases)",
        "gone entities": "e_gone",
    }
    parts = []
    for scenario in w.SCENARIOS.values():
        counted = " UNION ALL ".join(
            f"SELECT '{scenario.name}' AS scenario, {i}::BIGINT AS position, '{c}' AS class, count(*) AS changes FROM {tables[c]}"
            for i, c in enumerate(CLASSES))
        parts.append(f"SELECT * FROM ({with_ctes(inputs(scenario) | diff_ctes(), counted)}) WHERE changes > 0")
    return "\nUNION ALL\n".join(parts)


@add("plan_summary", _summary_sql())
def plan_summary(spark, sf_dir):
    counts = [change_counts(*w.plan(spark, sf_dir, s)).select(F.lit(s).alias("scenario"), "*") for s in w.SCENARIOS]
    return reduce(DataFrame.unionByName, counts)


# -- next version ---------------------------------------------------------------------

@add("allocate_ids", next_sql("clean", "SELECT variant_id, slug FROM n_new_variants"))
def allocate_ids(spark, sf_dir):
    return allocate_variants(w.state(spark, sf_dir), w.plan(spark, sf_dir)[1]).select("variant_id", "slug")


@add("next_entities", next_sql("clean", "SELECT * FROM n_entities"))
def next_entities(spark, sf_dir):
    return w.after(spark, sf_dir).entities


@add("next_variants", next_sql("clean", "SELECT * FROM n_variants"))
def next_variants(spark, sf_dir):
    return w.after(spark, sf_dir).variants


@add("next_variants_decided", next_sql("decided", "SELECT * FROM n_variants"))
def next_variants_decided(spark, sf_dir):
    return w.after(spark, sf_dir, "decided").variants


@add("scd2_history", next_sql("clean", "SELECT * FROM n_key_history"))
def scd2_history(spark, sf_dir):
    return w.after(spark, sf_dir).key_history


@add("scd2_name_history", next_sql("clean", "SELECT * FROM n_name_history"))
def scd2_name_history(spark, sf_dir):
    return w.after(spark, sf_dir).name_history


@add("next_counters", next_sql("clean", """SELECT 'next_entity_id' AS name, (SELECT max(p_partkey) + 2 FROM part) + (SELECT count(*) FROM e_new) AS value
UNION ALL SELECT 'next_variant_id', (SELECT count(*) + 1 FROM r_variants) + (SELECT count(*) FROM v_new)
UNION ALL SELECT 'schema_version', 6"""))
def next_counters(spark, sf_dir):
    return w.after(spark, sf_dir).counters


LOADED = f"""SELECT row_number() OVER (ORDER BY s.entity_pos, set_pos, variant_pos) AS variant_id, e.entity_id, slug, e.name, e.cost
FROM s_variants s JOIN (SELECT row_number() OVER (ORDER BY entity_pos) AS entity_id, name, cost FROM s_entities) e ON e.name = s.entity_name"""


@add("initial_load", state_sql(LOADED))
def initial_load(spark, sf_dir):
    """First population: the same classification and apply against an empty state."""
    nothing, (entities, variants) = empty_state(spark), w.snapshot(spark, sf_dir)
    entity_plan = ed.classify_entities(nothing.entities, entities)
    variant_plan = vd.classify_variants(nothing.entities, nothing.variants, nothing.key_history, variants, entity_plan)
    loaded = apply_plan(nothing, entity_plan, variant_plan, w.AS_OF)
    return loaded.variants.select("variant_id", "entity_id", "slug").join(
        loaded.entities.select("entity_id", "name", "cost"), "entity_id")


@add("build_history", """WITH seen AS (SELECT user_id, event_type, ts, event_id,
  lag(event_type) OVER u AS before, row_number() OVER u AS n FROM events
  WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
changes AS (SELECT * FROM seen WHERE n = 1 OR before IS DISTINCT FROM event_type)
SELECT user_id, event_type, epoch_us(ts) AS valid_from,
  epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS valid_to FROM changes""")
def build_history(spark, sf_dir):
    history = history_from_observations(w.table(spark, sf_dir, "events"), "user_id", "event_type", "ts", "event_id")
    # The events carry no time zone, and the session's must not matter.
    micros = [F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {c})").alias(c) for c in ("valid_from", "valid_to")]
    return history.select("user_id", "event_type", *micros)
