"""Classify every difference between stored and incoming variants.

Runs after the entity layer: renamed entities are compared under their new name
and variants of entities in a case are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import distinct_keys, grouped
from ..functions.records import changed_fields, packed, parts, unpacked
from ..schemas import PAIR_FIELDS, VARIANT_COMPARED, VARIANT_FIELDS
from ..session import written
from .entity_diff import (
    ADDED, MISSING, EntityPlan, entity_renames, pair_counts,
)
from .flatten import refuse

TAKEN_OVER = "key kept but carried by another entity"
NOT_ONE_TO_ONE = "vanished and new variants of one entity do not pair one to one"
OWNED = "key has belonged to another variant before"
PAIRED_BY = "set+product+finish"


@dataclass(frozen=True)
class VariantPlan:
    """``differing``: old and new record of all that differs, one row per key.

    ``outcomes``: one row per vanished or new variant, with rename, case, new,
    retire, or owned when the ownership rule stopped it.
    """

    differing: DataFrame
    outcomes: DataFrame


def entity_view(entities: DataFrame, plan: EntityPlan) -> DataFrame:
    """Stored entities under their stored and their new name, with the case flag."""
    renamed = entity_renames(plan).select("entity_id", F.col("new_name"))
    cased = plan.outcomes.where((F.col("side") == MISSING) & (F.col("outcome") == "case")) \
        .select("entity_id", F.lit(True).alias("cased"))
    return entities.select("entity_id", F.col("name").alias("entity_name")) \
        .join(renamed, "entity_id", "left").join(cased, "entity_id", "left") \
        .select("entity_id", "entity_name", F.coalesce("new_name", "entity_name").alias("effective_name"),
                F.coalesce("cased", F.lit(False)).alias("cased"))


def differences(variants: DataFrame, view: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Everything that is not stored exactly as it comes in.

    A retired variant whose key is still absent is no difference.
    """
    # What is only compared travels as one text, and is taken apart again in the rows that differ.
    other = ~F.col("effective_name").eqNullSafe(F.col("entity_name"))
    named = view.select("entity_id", "entity_name", "cased", F.when(other, F.col("effective_name")).alias("renamed"))
    old = _carried(variants).join(named, "entity_id").drop("entity_id")
    joined = _sided(old, "old").join(_sided(_carried(snapshot), "new"), "slug", "full_outer")
    effective = F.coalesce("old_renamed", "old_entity_name")
    differing = joined.withColumn(
        "status",
        F.when(F.col("old_packed").isNull(), ADDED)
        .when(F.col("new_packed").isNull(), F.when(F.col("old_retired_at").isNull(), MISSING))
        .when(effective != F.col("new_entity_name"), "taken over")
        .when(~F.col("old_packed").eqNullSafe(F.col("new_packed")), "changed")
        .when(F.col("old_retired_at").isNotNull(), "back"),
    ).where("status is not null").select(
        "*", effective.alias("old_effective_name"), *[parts(f"{side}_packed").alias(f"{side}_parts") for side in ("old", "new")])
    return differing.select(
        "slug", _record("old", variants.drop("entity_id"), "entity_name", "effective_name", "cased"), _record("new", snapshot), "status")


def _carried(rows: DataFrame) -> DataFrame:
    """``rows`` with the compared fields packed into one column."""
    return rows.select(*[c for c in rows.columns if c not in VARIANT_COMPARED], packed(VARIANT_COMPARED).alias("packed"))


def _sided(rows: DataFrame, side: str) -> DataFrame:
    """Columns named after their side; a packed record is null only where the side is missing."""
    return rows.select("slug", *[F.col(c).alias(f"{side}_{c}") for c in rows.columns if c != "slug"])


def _record(side: str, rows: DataFrame, *more: str) -> Column:
    """The record of one side as it was before it was packed, null where the side is missing."""
    fields = unpacked(f"{side}_parts", VARIANT_COMPARED, dict(rows.dtypes))
    found = [F.col("slug") if c == "slug" else fields[c] if c in fields else F.col(f"{side}_{c}").alias(c) for c in rows.columns]
    record = F.struct(*found, *[F.col(f"{side}_{c}").alias(c) for c in more])
    return F.when(F.col(f"{side}_packed").isNotNull(), record).alias(side)


def one_sided(differing: DataFrame, plan: EntityPlan) -> DataFrame:
    """Missing and added variants, without those of entities in a case."""
    def side(name: str, record: str, variant_id: Column, entity_name: str) -> DataFrame:
        return differing.where(F.col("status") == name).select(
            F.lit(name).alias("side"), variant_id.alias("variant_id"), "slug",
            F.col(f"{record}.{entity_name}").alias("entity_name"),
            *[F.col(f"{record}.{f}").alias(f) for f in PAIR_FIELDS])

    # Stored variants are judged by their stored entity, incoming ones by name.
    differing = differing.where(~F.coalesce("old.cased", F.lit(False)))
    missing = side(MISSING, "old", F.col("old.variant_id"), "effective_name")
    added = side(ADDED, "new", F.lit(None).cast("bigint"), "entity_name")
    cased = plan.outcomes.where("outcome = 'case'").select(F.col("name").alias("entity_name"))
    return missing.unionByName(added.join(cased, "entity_name", "left_anti"))


def _human_pairs(rows: DataFrame, renames: DataFrame) -> DataFrame:
    old = rows.where(F.col("side") == MISSING).select("variant_id", F.col("slug").alias("old_slug"))
    new = rows.where(F.col("side") == ADDED).select(F.col("slug").alias("new_slug"))
    return renames.join(old, "variant_id").join(new, "new_slug")


def stale_variant_decisions(rows: DataFrame, decisions: dict[str, DataFrame]) -> DataFrame:
    """Decisions that do not fit the current differences, or fit them twice."""
    renames, forced, retired = (decisions[d] for d in ("variant_renames", "new_variants", "retire_variants"))
    pairs = _human_pairs(rows, renames)
    unfit = renames.join(pairs, ["variant_id", "new_slug"], "left_anti") \
        .select(F.concat_ws(" -> ", F.col("variant_id").cast("string"), "new_slug").alias("decision"))
    used_ids = renames.select("variant_id").unionByName(retired)
    twice = used_ids.groupBy("variant_id").count().where("count > 1").select(F.col("variant_id").cast("string")) \
        .union(renames.groupBy("new_slug").count().where("count > 1").select("new_slug"))
    missing = rows.where(F.col("side") == MISSING).select("variant_id")
    added = rows.where(F.col("side") == ADDED).select("slug")
    free = added.join(pairs.select(F.col("new_slug").alias("slug")), "slug", "left_anti")
    return (
        unfit.union(twice)
        .union(forced.join(free, "slug", "left_anti").select("slug"))
        .union(retired.join(missing, "variant_id", "left_anti").select(F.col("variant_id").cast("string")))
    )


def _decided(rows: DataFrame, decisions: dict[str, DataFrame]) -> DataFrame:
    pairs = _human_pairs(rows, decisions["variant_renames"])
    no_id, no_slug = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    missing = rows.where(F.col("side") == MISSING)
    retired = missing.join(decisions["retire_variants"], "variant_id", "left_semi")
    return (
        pairs.select(F.lit(MISSING).alias("side"), F.col("old_slug").alias("slug"), F.lit("rename").alias("decided"),
                     F.col("variant_id").alias("partner_id"), F.col("new_slug").alias("partner_slug"))
        .union(pairs.select(F.lit(ADDED), "new_slug", F.lit("rename"), "variant_id", "old_slug"))
        .union(decisions["new_variants"].distinct().select(F.lit(ADDED), "slug", F.lit("new"), no_id, no_slug))
        .union(retired.select(F.lit(MISSING), "slug", F.lit("retire"), no_id, no_slug))
    )


def key_owners(history: DataFrame, wanted: DataFrame) -> DataFrame:
    """The variant each wanted key has belonged to, if any.

    Keys of stored variants never reach this point (a new key is by definition
    not stored), so the history decides.  Narrowing the history to the wanted
    keys first lets a short list be broadcast instead of shuffling all history.
    """
    return history.join(distinct_keys(wanted, "slug"), "slug", "left_semi").groupBy("slug").agg(F.max("variant_id").alias("owner_id"))


def classify_variants(entities: DataFrame, variants: DataFrame, history: DataFrame, snapshot: DataFrame,
                      plan: EntityPlan, decisions: dict[str, DataFrame] | None = None) -> VariantPlan:
    # Written, so that the join to the variants shuffles both sides afresh and an
    # entity with very many variants can be split.
    view = written(entity_view(entities, plan), "entity-view")
    differing = written(differences(variants, view, snapshot), "variant-differences")
    rows = one_sided(differing, plan)
    if decisions:
        # Written, as each is read several times and its size tells how to join it.
        decisions = {name: written(decisions[name], name) for name in ("variant_renames", "new_variants", "retire_variants")}
        refuse(stale_variant_decisions(rows, decisions), "variant decision does not fit the differences")
        rows = rows.join(_decided(rows, decisions), ["side", "slug"], "left")
    else:
        rows = rows.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("decided", "string"), ("partner_id", "bigint"), ("partner_slug", "string"))])

    is_open = F.col("decided").isNull()
    by_hand = rows.where(~is_open).select(
        "side", "slug", "entity_name", *PAIR_FIELDS, F.coalesce("variant_id", "partner_id").alias("variant_id"),
        F.col("partner_slug").alias("partner"), F.col("decided").alias("outcome"), F.lit("human").alias("decided_by"),
        F.lit(None).cast("string").alias("case_id"))
    outcomes = by_hand.unionByName(_paired(rows.where(is_open)))
    outcomes = written(outcomes, "variant-outcomes")

    return VariantPlan(differing, _with_ownership(outcomes, history, bool(decisions)))


#: Rows of one side that a group holds itself, as its least and its greatest.
HELD = 2


def _ends(side: str) -> list[Column]:
    row = F.when(F.col("side") == side, F.struct("slug", "variant_id"))
    return [F.min(row).alias(f"{side}_first"), F.max(row).alias(f"{side}_last")]


def _members(side: str) -> Column:
    """The rows of one side of a group of at most ``HELD`` a side."""
    first, last, n = F.col(f"{side}_first"), F.col(f"{side}_last"), F.col(f"n_{side}")
    listed = F.when(n == 0, F.array().cast("array<struct<slug:string,variant_id:bigint>>")) \
        .when(n == 1, F.array(first)).otherwise(F.array(first, last))
    return F.transform(listed, lambda row: F.struct(
        F.lit(side).alias("side"), row["slug"].alias("slug"), row["variant_id"].alias("variant_id")))


def _paired(rows: DataFrame) -> DataFrame:
    """What becomes of the rows no decision is about, by the group of what a rename must leave alike.

    A group knows its rows while they are few, so rows meet groups again only where there are more.
    """
    rows = rows.withColumn("key", F.struct("entity_name", *PAIR_FIELDS))
    # Written, as the pairs, the others and the sums per entity all read them.
    groups = written(pair_counts(rows, F.col("key"), *_ends(MISSING), *_ends(ADDED)), "variant-groups")
    unique = (F.col("n_missing") == 1) & (F.col("n_added") == 1)
    pairs = groups.where(unique).select("key", F.explode(F.array(
        F.struct(F.lit(MISSING).alias("side"), F.col("missing_first.slug").alias("slug"), F.col("added_first.slug").alias("partner")),
        F.struct(F.lit(ADDED).alias("side"), F.col("added_first.slug").alias("slug"), F.col("missing_first.slug").alias("partner")),
    )).alias("row"), F.col("missing_first.variant_id").alias("variant_id"))
    renamed = pairs.select(
        "row.side", "row.slug", *_key_fields(), "variant_id", "row.partner", F.lit("rename").alias("outcome"),
        F.lit(PAIRED_BY).alias("decided_by"), F.lit(None).cast("string").alias("case_id"))

    # What is left per entity, summed over groups and not over rows.
    rest = groups.where(~unique)
    left = grouped(rest.withColumn("left_name", F.col("key.entity_name")), ["left_name"],
                   ((F.sum("n_missing") > 0) & (F.sum("n_added") > 0)).alias("both_left"))
    few = rest.where(f"n_missing <= {HELD} and n_added <= {HELD}") \
        .join(left, F.col("key.entity_name") == F.col("left_name"), "left") \
        .select("key", "both_left", F.explode(F.concat(_members(MISSING), _members(ADDED))).alias("row")) \
        .select("key", "both_left", "row.*")
    # Written, so that its size is known: rows are moved only if many groups are as large as that.
    large = written(rest.where(f"n_missing > {HELD} or n_added > {HELD}").select("key"), "large-groups")
    many = rows.join(large, "key").select("key", "side", "slug", "variant_id") \
        .join(left, F.col("key.entity_name") == F.col("left_name"), "left") \
        .select("key", "both_left", "side", "slug", "variant_id")
    is_missing, in_case = F.col("side") == MISSING, F.coalesce("both_left", F.lit(False))
    return renamed.unionByName(few.unionByName(many).select(
        "side", "slug", *_key_fields(), "variant_id", F.lit(None).cast("string").alias("partner"),
        F.when(in_case, "case").when(is_missing, "retire").otherwise("new").alias("outcome"),
        F.when(~in_case & is_missing, "no candidate").alias("decided_by"),
        F.when(in_case, F.concat(F.lit("variant:"), F.col("key.entity_name"))).alias("case_id")))


def _key_fields() -> list[Column]:
    return [F.col(f"key.{f}").alias(f) for f in ("entity_name", *PAIR_FIELDS)]


def _with_ownership(outcomes: DataFrame, history: DataFrame, decided: bool) -> DataFrame:
    """A key may never pass to another variant: such outcomes become ``owned``."""
    # Both rows of a rename look up the new key, so both learn of a veto.
    claimed = F.when((F.col("side") == MISSING) & (F.col("outcome") == "rename"), F.col("partner")) \
        .when((F.col("side") == ADDED) & F.col("outcome").isin("rename", "new"), F.col("slug"))
    outcomes = outcomes.withColumn("claimed", claimed)
    claims = outcomes.where("claimed is not null")
    # All history is read here, once; what it says about these keys is little.
    owners = written(key_owners(history, claims.select(F.col("claimed").alias("slug"))), "claimed-keys") \
        .withColumnRenamed("slug", "claimed")
    stopped = F.col("owner_id").isNotNull() & ~F.col("owner_id").eqNullSafe(F.col("variant_id"))
    claims = claims.join(owners, "claimed", "left") \
        .withColumn("outcome", F.when(stopped, "owned").otherwise(F.col("outcome")))
    if decided:
        refuse(claims.where("outcome = 'owned' and decided_by = 'human'").select("slug", "owner_id"),
               "variant decision would hand a key to another variant")
    # Rows that claim nothing stay out of the join, where they would all meet on null.
    rest = outcomes.where("claimed is null").withColumn("owner_id", F.lit(None).cast("bigint"))
    return claims.unionByName(rest).drop("claimed")


def _outcome(plan: VariantPlan, side: str, outcome: str) -> DataFrame:
    return plan.outcomes.where((F.col("side") == side) & (F.col("outcome") == outcome))


def variant_renames(plan: VariantPlan) -> DataFrame:
    return _outcome(plan, ADDED, "rename").select(
        "variant_id", F.col("partner").alias("old_slug"), F.col("slug").alias("new_slug"), "decided_by")


def retirements(plan: VariantPlan) -> DataFrame:
    return _outcome(plan, MISSING, "retire").select("variant_id", "slug", "decided_by")


def unretirements(plan: VariantPlan) -> DataFrame:
    return plan.differing.where("status in ('changed', 'back') and old.retired_at is not null") \
        .select("old.variant_id", "slug")


def new_variants(plan: VariantPlan) -> DataFrame:
    added = plan.differing.where(F.col("status") == ADDED).select("slug", "new")
    return added.join(_outcome(plan, ADDED, "new").select("slug"), "slug", "left_semi").select("new.*")


def changed_variants(plan: VariantPlan) -> DataFrame:
    """Stored and incoming record of every renamed or changed variant."""
    records = [F.struct(*[F.col(f"{side}.{f}").alias(f) for f in VARIANT_FIELDS]).alias(side) for side in ("old", "new")]
    kept = plan.differing.where("status = 'changed'").select("old.variant_id", *records)
    pairs = variant_renames(plan).select("variant_id", "old_slug", "new_slug")
    old = plan.differing.where(F.col("status") == MISSING).select(F.col("slug").alias("old_slug"), "old")
    new = plan.differing.where(F.col("status") == ADDED).select(F.col("slug").alias("new_slug"), "new")
    return kept.unionByName(pairs.join(old, "old_slug").join(new, "new_slug").select("variant_id", *records))


def variant_updates(plan: VariantPlan) -> DataFrame:
    """One row per changed variant: its new key and the changed fields."""
    return changed_variants(plan).select(
        "variant_id", F.col("new.slug").alias("slug"), changed_fields("old", "new", VARIANT_COMPARED).alias("changes"),
    ).where(F.size("changes") > 0)


def taken_over(plan: VariantPlan) -> DataFrame:
    return plan.differing.where("status = 'taken over'").select(
        "old.variant_id", "slug", "old.entity_name", F.col("new.entity_name").alias("new_entity_name"))


def ownership_vetoes(plan: VariantPlan) -> DataFrame:
    """Renames and new variants stopped because the key belongs to another."""
    return _outcome(plan, ADDED, "owned").select(
        "slug", "owner_id", F.col("variant_id").alias("attempted_id"))


def variant_case_members(plan: VariantPlan) -> DataFrame:
    columns = ["case_id", "side", "variant_id", "slug", "entity_name", *PAIR_FIELDS]
    moved = plan.differing.where("status = 'taken over'") \
        .withColumn("case_id", F.concat(F.lit("variant:key:"), "slug"))
    stored = moved.select("case_id", F.lit(MISSING).alias("side"), "old.variant_id", "slug", "old.entity_name",
                          *[f"old.{f}" for f in PAIR_FIELDS])
    incoming = moved.select("case_id", F.lit(ADDED).alias("side"), F.lit(None).cast("bigint").alias("variant_id"),
                            "slug", "new.entity_name", *[f"new.{f}" for f in PAIR_FIELDS])
    return plan.outcomes.where("outcome = 'case'").select(columns).unionByName(stored).unionByName(incoming)


def variant_cases(plan: VariantPlan) -> DataFrame:
    nothing = F.lit(None)
    unpaired = plan.outcomes.where("outcome = 'case'").groupBy("case_id").agg(
        F.count_if(F.col("side") == MISSING).alias("n_missing"),
        F.count_if(F.col("side") == ADDED).alias("n_candidates"),
    ).select("case_id", F.lit(NOT_ONE_TO_ONE).alias("problem"), "n_missing", "n_candidates",
             nothing.cast("string").alias("slug"), nothing.cast("bigint").alias("owner_id"),
             nothing.cast("bigint").alias("attempted_id"))
    one = F.lit(1).cast("bigint")
    moved = taken_over(plan).select(
        F.concat(F.lit("variant:key:"), "slug"), F.lit(TAKEN_OVER), one, one, "slug",
        nothing.cast("bigint"), nothing.cast("bigint"))
    zero = F.lit(0).cast("bigint")
    owned = ownership_vetoes(plan).select(
        F.concat(F.lit("variant:owner:"), "slug"), F.lit(OWNED), zero, zero, "slug", "owner_id", "attempted_id")
    return unpaired.union(moved).union(owned).withColumn("kind", F.lit("variant"))
