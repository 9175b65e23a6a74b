"""Classify every difference between stored and incoming entities.

One full outer join on the name finds everything that differs.  Only those rows
are kept, and every class of change is then a filter on one small table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import grouped
from ..functions.records import any_change, changed_fields, fingerprint, review_summary
from ..schemas import ENTITY_COMPARED, ENTITY_FIELDS
from ..session import written
from .flatten import refuse

MISSING, ADDED = "missing", "added"
SHARED_FINGERPRINT = "several vanished and new entities look the same"
UNEXPLAINED = "entities vanished while others appeared and nothing links them"
UNEXPLAINED_CASE = "entity:unexplained"


@dataclass(frozen=True)
class EntityPlan:
    """``kept``: same name, changed attributes.  ``outcomes``: all other rows.

    An outcome row is one vanished or one new entity with what becomes of it:
    rename, case, new or gone.
    """

    kept: DataFrame
    outcomes: DataFrame


def differences(state: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Entities of one side only, and those of both whose attributes differ."""
    old = state.select("name", F.struct("*").alias("old"))
    new = snapshot.select("name", F.struct("*").alias("new"))
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    return old.join(new, "name", "full_outer").where(~both | any_change("old", "new", ENTITY_COMPARED))


def one_sided(differing: DataFrame) -> DataFrame:
    """Missing and added entities in one table."""
    def side(where: str, name: str, entity_id: Column, position: Column, record: str) -> DataFrame:
        return differing.where(where).select(
            F.lit(name).alias("side"), entity_id.alias("entity_id"), position.alias("entity_pos"), "name",
            F.struct(*[F.col(f"{record}.{f}").alias(f) for f in ENTITY_FIELDS]).alias("record"))

    nothing = F.lit(None).cast("bigint")
    return side("new is null", MISSING, F.col("old.entity_id"), nothing, "old").unionByName(
        side("old is null", ADDED, nothing, F.col("new.entity_pos"), "new"))


def missing_entities(state: DataFrame, snapshot: DataFrame) -> DataFrame:
    return state.join(snapshot.select("name"), "name", "left_anti")


def added_entities(state: DataFrame, snapshot: DataFrame) -> DataFrame:
    return snapshot.join(state.select("name"), "name", "left_anti")


def pair_counts(rows: DataFrame, key: Column, *firsts: Column) -> DataFrame:
    """How many rows of each side share a key: one aggregate, no lists.

    Partial aggregation shrinks even a key held by a third of all rows to one
    row per task before the shuffle.
    """
    return grouped(
        rows.withColumn("key", key), ["key"],
        F.count_if(F.col("side") == MISSING).alias("n_missing"),
        F.count_if(F.col("side") == ADDED).alias("n_added"),
        *firsts,
    )


def only(side: str, column: str, alias: str) -> Column:
    """The value of ``column`` on one side (the only one, when paired 1:1)."""
    return F.min(F.when(F.col("side") == side, F.col(column))).alias(alias)


def _human_pairs(rows: DataFrame, renames: DataFrame) -> DataFrame:
    old = rows.where(F.col("side") == MISSING).select("entity_id", F.col("name").alias("old_name"))
    new = rows.where(F.col("side") == ADDED).select(F.col("name").alias("new_name"))
    return renames.join(old, "entity_id").join(new, "new_name")


def stale_entity_decisions(rows: DataFrame, decisions: dict[str, DataFrame]) -> DataFrame:
    """Decisions that do not fit the current differences, or fit them twice."""
    renames, forced = decisions["entity_renames"], decisions["new_entities"]
    pairs = _human_pairs(rows, renames)
    unfit = renames.join(pairs, ["entity_id", "new_name"], "left_anti") \
        .select(F.concat_ws(" -> ", F.col("entity_id").cast("string"), "new_name").alias("decision"))
    twice = renames.groupBy("entity_id").count().where("count > 1").select(F.col("entity_id").cast("string")) \
        .union(renames.groupBy("new_name").count().where("count > 1").select("new_name"))
    free = rows.where(F.col("side") == ADDED).join(pairs, rows["name"] == pairs["new_name"], "left_anti")
    unknown = forced.join(free.select("name"), "name", "left_anti").select("name")
    return unfit.union(twice).union(unknown)


def _decided(rows: DataFrame, decisions: dict[str, DataFrame]) -> DataFrame:
    pairs = _human_pairs(rows, decisions["entity_renames"])
    nothing = F.lit(None).cast("string")
    return (
        pairs.select(F.lit(MISSING).alias("side"), F.col("old_name").alias("name"),
                     F.lit("rename").alias("decided"), F.col("new_name").alias("decided_partner"))
        .union(pairs.select(F.lit(ADDED), "new_name", F.lit("rename"), "old_name"))
        .union(decisions["new_entities"].distinct().select(F.lit(ADDED), "name", F.lit("new"), nothing))
    )


def classify_entities(state: DataFrame, snapshot: DataFrame,
                      decisions: dict[str, DataFrame] | None = None) -> EntityPlan:
    differing = written(differences(state, snapshot), "entity-differences")
    rows = one_sided(differing)
    if decisions:
        refuse(stale_entity_decisions(rows, decisions), "entity decision does not fit the differences")
        rows = rows.join(_decided(rows, decisions), ["side", "name"], "left")
    else:
        nothing = F.lit(None).cast("string")
        rows = rows.select("*", nothing.alias("decided"), nothing.alias("decided_partner"))

    key = F.when(F.col("decided").isNull(), fingerprint("record"))
    rows = rows.withColumn("key", key)
    groups = pair_counts(
        rows.where("key is not null"), F.col("key"),
        only(MISSING, "name", "old_name"), only(ADDED, "name", "new_name"), only(MISSING, "entity_id", "first_id"),
    ).where("n_missing > 0 and n_added > 0")
    unique = (F.col("n_missing") == 1) & (F.col("n_added") == 1)
    shared = F.col("n_missing").isNotNull()
    partner = F.when(F.col("side") == MISSING, F.col("new_name")).otherwise(F.col("old_name"))
    found = rows.join(groups, "key", "left").select(
        "side", "entity_id", "entity_pos", "name", "record",
        F.when(F.col("decided").isNotNull(), F.col("decided"))
        .when(unique, "rename").when(shared, "case").alias("outcome"),
        F.when(F.col("decided").isNotNull(), "human").when(unique, "fingerprint").alias("decided_by"),
        F.when(F.col("decided").isNotNull(), F.col("decided_partner")).when(unique, partner).alias("partner"),
        F.when(F.col("decided").isNull() & shared & ~unique,
               F.concat(F.lit("entity:fingerprint:"), F.col("first_id"))).alias("case_id"),
    )
    found = written(found, "entity-outcomes")

    # Fail closed: something vanished and something appeared, both unexplained.
    # The gate is one value, so it is a scalar subquery and not a join.
    open_rows = F.col("outcome").isNull()
    gate = found.where(open_rows).agg(F.coalesce(
        F.bool_or(F.col("side") == MISSING) & F.bool_or(F.col("side") == ADDED), F.lit(False)).alias("closed"))
    gated = found.withColumn("closed", gate.scalar())
    outcomes = gated.select(
        "side", "entity_id", "entity_pos", "name", "record", "decided_by", "partner",
        F.coalesce("case_id", F.when(open_rows & F.col("closed"), UNEXPLAINED_CASE)).alias("case_id"),
        F.when(~open_rows, F.col("outcome")).when(F.col("closed"), "case")
        .when(F.col("side") == MISSING, "gone").otherwise("new").alias("outcome"),
    )
    return EntityPlan(kept=differing.where("old is not null and new is not null"), outcomes=outcomes)


def _outcome(plan: EntityPlan, side: str, outcome: str) -> DataFrame:
    return plan.outcomes.where((F.col("side") == side) & (F.col("outcome") == outcome))


def entity_renames(plan: EntityPlan) -> DataFrame:
    return _outcome(plan, MISSING, "rename").select(
        "entity_id", F.col("name").alias("old_name"), F.col("partner").alias("new_name"), "decided_by")


def new_entities(plan: EntityPlan) -> DataFrame:
    return _outcome(plan, ADDED, "new").select("entity_pos", "record.*")


def gone_entities(plan: EntityPlan) -> DataFrame:
    """Noted only: an entity never retires, its variants do."""
    return _outcome(plan, MISSING, "gone").select("entity_id", "name")


def changed_entities(plan: EntityPlan) -> DataFrame:
    """Stored and incoming record of every renamed or changed entity."""
    kept = plan.kept.select("old.entity_id", "old", "new")
    old = _outcome(plan, MISSING, "rename").select("entity_id", F.col("record").alias("old"), F.col("partner").alias("name"))
    new = _outcome(plan, ADDED, "rename").select("name", F.col("record").alias("new"))
    same_shape = [F.struct(*[F.col(f"{side}.{f}").alias(f) for f in ENTITY_FIELDS]).alias(side) for side in ("old", "new")]
    return kept.select("entity_id", *same_shape).unionByName(old.join(new, "name").select("entity_id", *same_shape))


def entity_updates(plan: EntityPlan) -> DataFrame:
    """One row per changed entity: its new name and the changed fields."""
    return changed_entities(plan).select(
        "entity_id", F.col("new.name").alias("name"), changed_fields("old", "new", ENTITY_COMPARED).alias("changes"),
    ).where(F.size("changes") > 0)


def entity_case_members(plan: EntityPlan) -> DataFrame:
    """Flat, because one case may hold every difference of the run."""
    return plan.outcomes.where("outcome = 'case'").select(
        "case_id", "side", "entity_id", "name", review_summary("record").alias("summary"))


def entity_cases(plan: EntityPlan) -> DataFrame:
    members = plan.outcomes.where("outcome = 'case'")
    return members.groupBy("case_id").agg(
        F.count_if(F.col("side") == MISSING).alias("n_missing"),
        F.count_if(F.col("side") == ADDED).alias("n_candidates"),
    ).select(
        "case_id", F.lit("entity").alias("kind"),
        F.when(F.col("case_id") == UNEXPLAINED_CASE, UNEXPLAINED).otherwise(SHARED_FINGERPRINT).alias("problem"),
        "n_missing", "n_candidates",
    )


def cased_names(plan: EntityPlan) -> DataFrame:
    """Names on either side of a case; later steps leave them alone."""
    return plan.outcomes.where("outcome = 'case'").select("name").distinct()
