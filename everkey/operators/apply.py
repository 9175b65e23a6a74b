"""Turn a plan into the next version of the state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.slices import number_rows
from ..schemas import ENTITY_FIELDS, SCHEMA_VERSION, STATE_TABLES, VARIANT_COMPARED, VARIANT_FIELDS
from ..session import written
from . import entity_diff as ed, variant_diff as vd
from .history import close_and_open


@dataclass(frozen=True)
class State:
    """The five tables.  :class:`LazyState` builds each only where it is read."""

    entities: DataFrame
    variants: DataFrame
    key_history: DataFrame
    name_history: DataFrame
    counters: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in STATE_TABLES}


class LazyState(State):
    """A state whose tables are built when they are first asked for."""

    def __init__(self, **builders: Callable[[], DataFrame]) -> None:
        object.__setattr__(self, "_builders", builders)

    def __getattr__(self, name: str) -> DataFrame:
        builders = self.__dict__.get("_builders", {})
        if name not in builders:
            raise AttributeError(name)
        object.__setattr__(self, name, builders[name]())
        return self.__dict__[name]


ENTITY_COUNTER, VARIANT_COUNTER, VERSION_ROW = "next_entity_id", "next_variant_id", "schema_version"


def empty_state(spark) -> State:
    """The state before the first run: no rows, counters at one."""
    tables = {name: spark.createDataFrame([], schema) for name, schema in STATE_TABLES.items()}
    tables["counters"] = spark.createDataFrame(
        [(VERSION_ROW, SCHEMA_VERSION), (ENTITY_COUNTER, 1), (VARIANT_COUNTER, 1)], STATE_TABLES["counters"])
    return State(**tables)


def counter(counters: DataFrame, name: str) -> Column:
    return counters.where(F.col("name") == name).select("value").scalar()


def _patched(table: DataFrame, patch: DataFrame, id_column: str, fields: list[str]) -> DataFrame:
    """Take ``fields`` from ``patch(id, new)`` where there is one."""
    columns = [
        F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in table.columns
    ]
    return table.join(patch.select(id_column, "new"), id_column, "left").select(*columns)


def allocate_entities(state: State, plan: ed.EntityPlan) -> DataFrame:
    """New entities with ids in payload order, written once: the table, its
    history and the counters all need them."""
    numbered = number_rows(ed.new_entities(plan), ["entity_pos"], "entity_id",
                           counter(state.counters, ENTITY_COUNTER), "new-entities")
    return written(numbered.drop("entity_pos"), "allocated-entities")


def allocate_variants(state: State, plan: vd.VariantPlan) -> DataFrame:
    numbered = number_rows(vd.new_variants(plan), ["entity_pos", "set_pos", "variant_pos"], "variant_id",
                           counter(state.counters, VARIANT_COUNTER), "new-variants")
    return written(numbered.drop("entity_pos", "set_pos", "variant_pos"), "allocated-variants")


def next_entities(state: State, plan: ed.EntityPlan, added: DataFrame) -> DataFrame:
    return _patched(state.entities, ed.changed_entities(plan), "entity_id", ENTITY_FIELDS) \
        .unionByName(added.select("entity_id", *ENTITY_FIELDS))


def next_variants(state: State, plan: vd.VariantPlan, entities: DataFrame, added: DataFrame, as_of: str) -> DataFrame:
    """``entities`` is the next version: new variants find their entity by name there."""
    flags = vd.retirements(plan).select("variant_id", F.lit(True).alias("_retires")).unionByName(
        vd.unretirements(plan).select("variant_id", F.lit(False).alias("_retires")))
    taken = ["slug", *VARIANT_COMPARED]
    patched = _patched(state.variants, vd.changed_variants(plan), "variant_id", taken) \
        .join(flags, "variant_id", "left") \
        .withColumn("retired_at", F.when(F.col("_retires"), F.lit(as_of))
                    .when(F.col("_retires").isNull(), F.col("retired_at")))
    owners = entities.select("entity_id", F.col("name").alias("entity_name"))
    fresh = added.join(owners, "entity_name").withColumn("retired_at", F.lit(None).cast("string"))
    columns = state.variants.columns
    return patched.select(columns).unionByName(fresh.select(columns))


def next_key_history(state: State, plan: vd.VariantPlan, added: DataFrame, as_of: str) -> DataFrame:
    renames = vd.variant_renames(plan).select(
        "variant_id", F.col("old_slug").alias("old_key"), F.col("new_slug").alias("new_key"))
    return close_and_open(state.key_history, renames, added, "variant_id", "slug", as_of)


def next_name_history(state: State, plan: ed.EntityPlan, added: DataFrame, as_of: str) -> DataFrame:
    renames = ed.entity_renames(plan).select(
        "entity_id", F.col("old_name").alias("old_key"), F.col("new_name").alias("new_key"))
    return close_and_open(state.name_history, renames, added, "entity_id", "name", as_of)


def next_counters(counters: DataFrame, new_entities: DataFrame, new_variants: DataFrame) -> DataFrame:
    """Counters advance by what was handed out and never go back."""
    used = new_entities.select(F.lit(ENTITY_COUNTER).alias("name")).unionByName(
        new_variants.select(F.lit(VARIANT_COUNTER).alias("name"))).groupBy("name").agg(F.count("*").alias("used"))
    return counters.join(used, "name", "left").select(
        "name", (F.col("value") + F.coalesce("used", F.lit(0))).alias("value"))


def changed_ids(entity_plan: ed.EntityPlan, variant_plan: vd.VariantPlan, new_entities: DataFrame,
                new_variants: DataFrame) -> dict[str, DataFrame]:
    """By table, the ids whose rows are other than before."""
    added, fresh = new_entities.select("entity_id"), new_variants.select("variant_id")
    return {
        "entities": ed.changed_entities(entity_plan).select("entity_id").union(added),
        "variants": vd.changed_variants(variant_plan).select("variant_id").union(vd.retirements(variant_plan).select("variant_id"))
                    .union(vd.unretirements(variant_plan).select("variant_id")).union(fresh),
        "key_history": vd.variant_renames(variant_plan).select("variant_id").union(fresh),
        "name_history": ed.entity_renames(entity_plan).select("entity_id").union(added),
    }


def apply_plan(state: State, entity_plan: ed.EntityPlan, variant_plan: vd.VariantPlan, as_of: str,
               narrowed: Callable[[dict[str, DataFrame]], State] | None = None) -> State:
    """The next state.  Nothing is published here; see ``plans.sync``.

    ``narrowed`` is given the ids that change, by table, and may return a part of the state with all of their rows (of
    history, all open ones): the result is then the next state of that part.
    """
    new_entities = allocate_entities(state, entity_plan)
    new_variants = allocate_variants(state, variant_plan)
    part = narrowed(changed_ids(entity_plan, variant_plan, new_entities, new_variants)) if narrowed else state
    return State(
        entities=next_entities(part, entity_plan, new_entities),
        # New variants may belong to an entity of any part.
        variants=next_variants(part, variant_plan, next_entities(state, entity_plan, new_entities), new_variants, as_of),
        key_history=next_key_history(part, variant_plan, new_variants, as_of),
        name_history=next_name_history(part, entity_plan, new_entities, as_of),
        counters=next_counters(state.counters, new_entities, new_variants),
    )
