"""One run: snapshot in, next version of the state out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import checks, entity_diff as ed, marts, variant_diff as vd
from ..operators.apply import State, apply_plan
from ..operators.corrections import apply_corrections, unmatched_corrections
from ..operators.digest import disagreements, manifest, section_digests
from ..operators.flatten import checked_snapshot, refuse
from ..session import tune, written
from ..sources import store
from ..sources.feed import keep_raw
from ..schemas import SCHEMA_VERSION
from .summary import change_counts, is_noop


@dataclass(frozen=True)
class Run:
    """What a run found; ``version`` is the state in force afterwards.  A run with cases alone leaves it as it was."""

    version: int
    changed: bool
    has_cases: bool
    counts: DataFrame
    unmatched: DataFrame | None


def classify(state: State, entities: DataFrame, variants: DataFrame,
             decisions: dict[str, DataFrame] | None = None) -> tuple[ed.EntityPlan, vd.VariantPlan]:
    entity_plan = ed.classify_entities(state.entities, entities, decisions)
    variant_plan = vd.classify_variants(state.entities, state.variants, state.key_history, variants,
                                        entity_plan, decisions)
    return entity_plan, variant_plan


def sync(spark: SparkSession, root: str, payload: DataFrame | str, as_of: str, corrections: DataFrame | None = None,
         decisions: dict[str, DataFrame] | None = None, dry_run: bool = False, source: str = "",
         buckets: int = store.BUCKETS) -> Run:
    """Classify a payload against the current state and apply what is certain.

    ``payload`` is a table or the path of JSON lines; of the latter the lines are kept in the run's folder first, and
    read from there.  Cases are written for review and left alone; those of an earlier run on the same version are
    replaced.  The payload is kept beside the new version.  A state with a lost counter or orphaned rows is refused before
    anything is classified.  The new version is written to folders of this run alone, checked, published, the published
    tables are read back and checked too, and it is made current last; whatever fails before that, or another run that
    was faster, leaves the current version in force.  ``buckets`` counts in the first run only.
    """
    date.fromisoformat(as_of)
    tune(spark)
    version = store.current_version(spark, root)
    state = store.read_state(spark, root, version)
    folder = store.run_folder(number := store.next_version(spark, root))
    path = f"{root}/{folder}"
    refuse(checks.check_schema_version(state.counters), "state has another schema version")
    refuse(checks.check_counters(state).unionByName(checks.check_foreign_keys(state)), "the state is not sound")

    if isinstance(payload, str):
        payload = keep_raw(spark, payload, f"{path}/raw")
    payload = written(payload, "payload")  # parsed once
    entities, variants = checked_snapshot(payload)
    unmatched = None
    if corrections is not None:
        unmatched = unmatched_corrections(entities, variants, corrections)
        entities, variants = apply_corrections(entities, variants, corrections)
    entity_plan, variant_plan = classify(state, entities, variants, decisions)

    counts = written(change_counts(entity_plan, variant_plan), "plan-summary")
    found = counts.agg(is_noop(counts).alias("noop"), F.count_if(F.col("class") == "cases").alias("cases")).first()
    has_cases = found["cases"] > 0
    run = f"{root}/runs/base={version}"
    if has_cases or store.readable(spark, f"{run}/entity_cases"):
        write_cases(entity_plan, variant_plan, run)
    if found["noop"] or dry_run:
        return Run(version, False, has_cases, counts, unmatched)

    made = write_version(spark, root, number, folder, as_of, state, entity_plan, variant_plan, buckets)
    after = store.state_of(spark, root, made)
    refuse(checks.state_violations(after).unionByName(checks.version_violations(state, after)),
           "the new version breaks an invariant")
    payload.write.parquet(f"{path}/payload")
    publish(after, f"{path}/published", source)
    refuse(published_problems(spark, f"{path}/published", after), "the published tables are not those of the state")
    if decisions:
        for name, table in decisions.items():
            table.write.parquet(f"{path}/decisions/{name}")
    store.commit(spark, root, made)
    return Run(made.version, True, has_cases, counts, unmatched)


def write_version(spark: SparkSession, root: str, number: int, folder: str, as_of: str, state: State,
                  entity_plan: ed.EntityPlan, variant_plan: vd.VariantPlan, buckets: int) -> store.Commit:
    """Write the buckets with a change, the history that is closed now, and the counters; nothing is committed."""
    known = store.commits(spark, root)
    base = known[max(known)] if known else store.Commit(0, "", "", buckets, {n: {} for n in store.BUCKETED}, {n: [] for n in store.HISTORY}, {})

    def touched(ids: dict[str, DataFrame]) -> State:
        some = {n: store.buckets_of(ids[n], key, base.buckets) for n, key in store.BUCKETED.items()}
        return State(**{n: store.read_part(spark, root, base, n, some[n]) for n in store.BUCKETED}, counters=state.counters)

    after = apply_plan(state, entity_plan, variant_plan, as_of, touched)
    parts, closed = {}, dict(base.closed)
    for name in store.BUCKETED:
        table = getattr(after, name)
        if name in store.HISTORY:
            table = written(table, f"next-{name}")
            ended = table.where("valid_to is not null")
            if not ended.isEmpty():
                ended.write.parquet(f"{root}/{folder}/{name}_closed")
                closed[name] = [*closed[name], folder]
            table = table.where("valid_to is null")
        parts[name] = store.write_part(spark, root, folder, name, table, base)
    after.counters.coalesce(1).write.parquet(f"{root}/{folder}/counters")
    return store.Commit(number, as_of, folder, base.buckets, parts, closed, {"counters": folder})


def populate(spark: SparkSession, root: str, payload: DataFrame | str, as_of: str, **options) -> Run:
    """The first run; refuses when there is a state already."""
    if store.current_version(spark, root):
        raise ValueError("there is a state already: use sync")
    return sync(spark, root, payload, as_of, **options)


def write_cases(entity_plan: ed.EntityPlan, variant_plan: vd.VariantPlan, path: str) -> None:
    tables = {
        "entity_cases": ed.entity_cases(entity_plan), "entity_case_members": ed.entity_case_members(entity_plan),
        "variant_cases": vd.variant_cases(variant_plan), "variant_case_members": vd.variant_case_members(variant_plan),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def publish(state: State, path: str, source: str = "") -> None:
    """All sections in their fixed order, and their digests beside them."""
    order = marts.section_order()
    derived = marts.sections(state, source)
    for name, table in derived.items():
        store.write_section(table, f"{path}/{name}", order[name])
    spark = state.entities.sparkSession
    back = store.read_sections(spark, path, list(derived))
    section_digests(back).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def published_problems(spark: SparkSession, path: str, state: State) -> DataFrame:
    """What is wrong with published tables: columns, rules, rows, links, and the manifest."""
    published = store.read_sections(spark, path, list(marts.section_order()))
    stated = spark.read.parquet(f"{path}/digests")
    found = section_digests(published)
    told = manifest(found, published["header"], "", SCHEMA_VERSION, stated)
    return checks.published_violations(published, state).unionByName(disagreements(told))


def validate(spark: SparkSession, root: str, against: int | None = None) -> DataFrame:
    """Everything that is wrong with the current version, and against an older one."""
    tune(spark)
    version = store.current_version(spark, root)
    state = store.read_state(spark, root, version)
    published = f"{store.folder_of(spark, root, version)}/published"
    found = checks.state_violations(state).unionByName(published_problems(spark, published, state))
    if against is not None:
        found = found.unionByName(checks.version_violations(store.read_state(spark, root, against), state))
    return found
