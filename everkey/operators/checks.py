"""Invariants as queries that return what breaks them.

Every check gives rows of ``(check, key, detail)``; no rows means it holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import SCHEMA_VERSION, THRESHOLD_FIELDS
from .apply import ENTITY_COUNTER, VARIANT_COUNTER, VERSION_ROW, State, counter
from .lookup import key_claims
from .apply import empty_state
from .digest import row_digest
from .marts import sections


def _violation(rows: DataFrame, check: str, key: Column, detail: Column | str) -> DataFrame:
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return rows.select(F.lit(check).alias("check"), key.cast("string").alias("key"), detail.alias("detail"))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_schema_version(counters: DataFrame) -> DataFrame:
    stated = counters.where(F.col("name") == VERSION_ROW).agg(F.max("value").alias("value"))
    return _violation(stated.where(~F.col("value").eqNullSafe(F.lit(SCHEMA_VERSION))), "schema_version",
                      F.col("value"), f"expected {SCHEMA_VERSION}")


def check_foreign_keys(state: State) -> DataFrame:
    def dangling(child: DataFrame, key: Column, parent: DataFrame, column: str, name: str) -> DataFrame:
        lost = child.select(key.alias("_key"), column).join(parent.select(column), column, "left_anti")
        return _violation(lost, "foreign_key", F.col("_key"), F.concat(F.lit(f"{name} "), F.col(column)))

    return _all([
        dangling(state.variants, F.col("variant_id"), state.entities, "entity_id", "variant of entity"),
        dangling(state.key_history, F.col("slug"), state.variants, "variant_id", "key history of variant"),
        dangling(state.name_history, F.col("name"), state.entities, "entity_id", "name history of entity"),
    ])


def check_counters(state: State) -> DataFrame:
    """An id at or above its counter was not handed out by the counter.  A counter that is lost or null is one, too."""
    def above(table: DataFrame, column: str, name: str) -> DataFrame:
        top = table.agg(F.coalesce(F.max(column), F.lit(0)).alias("top")) \
            .withColumn("next", counter(state.counters, name))
        said = F.coalesce(F.col("next").cast("string"), F.lit("missing"))
        return _violation(top.where("next is null or top >= next"), "counter", F.lit(name),
                          F.concat_ws(" ", F.lit("highest id"), F.col("top"), F.lit("next"), said))

    return above(state.entities, "entity_id", ENTITY_COUNTER).unionByName(
        above(state.variants, "variant_id", VARIANT_COUNTER))


def check_open_rows(table: DataFrame, history: DataFrame, id_column: str, key: str, check: str) -> DataFrame:
    """Exactly one open history row per record, and it names the record's key."""
    open_rows = history.where("valid_to is null").groupBy(id_column).agg(
        F.count("*").alias("n"), F.min(key).alias("open_key"))
    state = table.select(id_column, F.col(key).alias("_key")).join(open_rows, id_column, "left") \
        .withColumn("n", F.coalesce("n", F.lit(0)))
    wrong = state.where((F.col("n") != 1) | ~F.col("open_key").eqNullSafe(F.col("_key")))
    detail = F.when(F.col("n") != 1, F.concat(F.col("n").cast("string"), F.lit(" open rows"))) \
        .otherwise(F.concat(F.lit("open row says "), F.col("open_key")))
    return _violation(wrong, check, F.col(id_column), detail)


def check_open_keys(variants: DataFrame, history: DataFrame) -> DataFrame:
    return check_open_rows(variants, history, "variant_id", "slug", "open_key")


def check_open_names(entities: DataFrame, history: DataFrame) -> DataFrame:
    return check_open_rows(entities, history, "entity_id", "name", "open_name")


def check_key_ownership(history: DataFrame, variants: DataFrame) -> DataFrame:
    """A key, current or former, belongs to one variant."""
    owners = key_claims(history, variants).groupBy("slug").agg(
        F.countDistinct("variant_id").alias("n"), F.min("variant_id").alias("low"), F.max("variant_id").alias("high"))
    detail = F.concat_ws(" ", F.col("n"), F.lit("variants, from"), F.col("low"), F.lit("to"), F.col("high"))
    return _violation(owners.where("n > 1"), "key_ownership", F.col("slug"), detail)


def check_published(published: DataFrame, derived: DataFrame, key: str, section: str) -> DataFrame:
    """Published rows must be exactly what the state gives, copies included.

    Either side is reduced to key and digest of the row; one sum over signs shows what is left on one of them.
    Of the digest 128 bits are compared, as bytes: digests are most of what is shuffled, and nothing packs them.
    """
    columns = [c for c in derived.columns if c in published.columns]

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(F.col(key).cast("string").alias("_key"), F.substring(F.unhex(row_digest(columns)), 1, 16).alias("_row"),
                           F.lit(sign).alias("_sign"))

    left = signed(published, 1).unionByName(signed(derived, -1)).groupBy("_key", "_row").agg(F.sum("_sign").alias("n")).where("n <> 0")
    detail = F.when(F.col("n") > 0, "published but not derived").otherwise("derived but not published")
    each = left.select("_key", F.explode(F.array_repeat(detail, F.abs("n").cast("int"))).alias("detail"))
    return _violation(each, f"published:{section}", F.col("_key"), F.col("detail"))


# The patterns published rows must match.  Ids are at least six
# digits wide, so a registry may grow past 999,999.
ENTITY_REF_PATTERN = "^C[0-9]{6,}$"
VARIANT_REF_PATTERN = "^P[0-9]{6,}$"
SET_NUMBER_PATTERN = "^[0-9]{3}$"
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _present(column: str) -> Column:
    return F.col(column).isNotNull()


def _matches(column: str, pattern: str) -> Column:
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def _matches_if_any(column: str, pattern: str) -> Column:
    return F.col(column).isNull() | F.col(column).rlike(pattern)


def _not_negative(column: str) -> Column:
    return F.coalesce(F.col(column) >= 0, F.lit(False))


def entity_rules() -> dict[str, Column]:
    return {
        "codex_id": _matches("codex_id", ENTITY_REF_PATTERN),
        "name": _present("name"), "rules_text": _present("rules_text"), "errata": _present("errata"),
        "sets": _not_negative("sets"), "printings": _not_negative("printings"),
    } | {t: _not_negative(t) for t in THRESHOLD_FIELDS}


def variant_rules() -> dict[str, Column]:
    return {
        "printing_id": _matches("printing_id", VARIANT_REF_PATTERN),
        "codex_id": _matches("codex_id", ENTITY_REF_PATTERN),
        "card_name": _present("card_name"), "set_name": _present("set_name"), "slug": _present("slug"),
        "set_number": _matches_if_any("set_number", SET_NUMBER_PATTERN),
        "released_at": _matches_if_any("released_at", DATE_PATTERN),
        "retired_at": _matches_if_any("retired_at", DATE_PATTERN),
    } | {t: _not_negative(t) for t in THRESHOLD_FIELDS}


def history_rules(id_column: str, pattern: str, key: str) -> dict[str, Column]:
    return {
        id_column: _matches(id_column, pattern), key: _present(key),
        "valid_from": _matches("valid_from", DATE_PATTERN), "valid_to": _matches_if_any("valid_to", DATE_PATTERN),
    }


def set_rules() -> dict[str, Column]:
    return {
        "set_number": _matches_if_any("set_number", SET_NUMBER_PATTERN), "set_name": _present("set_name"),
        "released_at": _matches_if_any("released_at", DATE_PATTERN),
        "cards": _not_negative("cards"), "printings": _not_negative("printings"),
    }


def link_rules() -> dict[str, dict[str, Column]]:
    return {
        "card_printings": {"codex_id": _matches("codex_id", ENTITY_REF_PATTERN), "printing_id": _matches("printing_id", VARIANT_REF_PATTERN)},
        "card_sets": {"codex_id": _matches("codex_id", ENTITY_REF_PATTERN), "set_number": _matches("set_number", SET_NUMBER_PATTERN)},
    }


def header_rules() -> dict[str, Column]:
    return {"schema_version": F.coalesce(F.col("schema_version") == SCHEMA_VERSION, F.lit(False)), "source": _present("source")} | {
        c: _not_negative(c) for c in ("sets", "cards", "printings", "slug_history", "name_history")}


def broken_rules(rows: DataFrame, key: str, rules: dict[str, Column], section: str) -> DataFrame:
    failed = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return _violation(rows.select(F.col(key).alias("_key"), F.explode(failed).alias("rule")), f"schema:{section}",
                      F.col("_key"), F.col("rule"))


def column_types(rows: DataFrame, expected: dict[str, str], section: str) -> list[str]:
    """Types and column sets are checked once per table and not per row."""
    actual = dict(rows.dtypes)
    return [f"{section}.{c}: {actual.get(c)} instead of {expected.get(c)}"
            for c in sorted(actual.keys() | expected.keys()) if actual.get(c) != expected.get(c)]


def check_schema(published: dict[str, DataFrame]) -> DataFrame:
    return _all([
        broken_rules(published["cards"], "codex_id", entity_rules(), "cards"),
        broken_rules(published["printings"], "printing_id", variant_rules(), "printings"),
        broken_rules(published["sets"], "set_number", set_rules(), "sets"),
        broken_rules(published["slug_history"], "printing_id",
                     history_rules("printing_id", VARIANT_REF_PATTERN, "slug"), "slug_history"),
        broken_rules(published["name_history"], "codex_id",
                     history_rules("codex_id", ENTITY_REF_PATTERN, "name"), "name_history"),
        *[broken_rules(published[name], "codex_id", rules, name) for name, rules in link_rules().items()],
        broken_rules(published["header"], "source", header_rules(), "header"),
    ])


def check_columns(published: dict[str, DataFrame]) -> DataFrame:
    """Every section has exactly the columns and types of the published schema; one look at each table's own schema."""
    spark = published["header"].sparkSession
    wanted = {name: dict(df.dtypes) for name, df in sections(empty_state(spark), "").items()}
    wrong = [(name, text) for name in wanted for text in column_types(published[name], wanted[name], name)]
    return spark.createDataFrame([(f"columns:{name}", name, text) for name, text in wrong], "check string, key string, detail string")


def check_links(links: DataFrame, variants: DataFrame) -> DataFrame:
    """Both directions of the published link agree: one pass over the pairs of either."""
    listed = links.select("codex_id", "printing_id", F.lit(1).alias("listed"), F.lit(0).alias("actual"))
    actual = variants.select("codex_id", "printing_id", F.lit(0).alias("listed"), F.lit(1).alias("actual"))
    pairs = listed.unionByName(actual).groupBy("codex_id", "printing_id").agg(F.max("listed").alias("listed"), F.max("actual").alias("actual"))
    text = F.concat(F.when(F.col("listed") == 1, "lists ").otherwise("does not list "), F.col("printing_id"))
    return _violation(pairs.where("listed <> actual"), "link", F.col("codex_id"), text)


# -- against the previous version ------------------------------------------

def check_lost_entities(old: State, new: State) -> DataFrame:
    lost = old.entities.join(new.entities.select("entity_id"), "entity_id", "left_anti")
    return _violation(lost, "lost_entity", F.col("entity_id"), F.col("name"))


def check_lost_variants(old: State, new: State) -> DataFrame:
    lost = old.variants.join(new.variants.select("variant_id"), "variant_id", "left_anti")
    return _violation(lost, "lost_variant", F.col("variant_id"), F.col("slug"))


def check_lost_links(old: State, new: State) -> DataFrame:
    """An entity may only gain variants.  Entities that are gone altogether are reported by ``check_lost_entities``."""
    both = ["entity_id", "variant_id"]
    lost = old.variants.select(both).join(new.variants.select(both), both, "left_anti") \
        .join(new.entities.select("entity_id"), "entity_id", "left_semi")
    return _violation(lost, "lost_link", F.col("entity_id"), F.concat(F.lit("variant "), F.col("variant_id")))


def check_moved(old: State, new: State) -> DataFrame:
    pair = old.variants.select("variant_id", F.col("entity_id").alias("was")).join(
        new.variants.select("variant_id", F.col("entity_id").alias("now")), "variant_id")
    return _violation(pair.where("was != now"), "moved_variant", F.col("variant_id"),
                      F.concat_ws(" -> ", F.col("was"), F.col("now")))


def check_unexplained_key_change(old: State, new: State) -> DataFrame:
    pair = old.variants.select("variant_id", "slug").join(
        new.variants.select("variant_id", F.col("slug").alias("now")), "variant_id")
    changed = pair.where("slug != now")
    unexplained = changed.join(new.key_history.select("variant_id", "slug"), ["variant_id", "slug"], "left_anti")
    return _violation(unexplained, "unexplained_key", F.col("variant_id"), F.concat_ws(" -> ", "slug", "now"))


def check_counts(old: State, new: State) -> DataFrame:
    """No table may have become smaller, and no counter may have gone back, been lost or be null."""
    def size(state: State, table: str) -> Column:
        return getattr(state, table).agg(F.count("*").alias("n")).scalar()

    tables = ["entities", "variants", "key_history", "name_history"]
    rows = old.counters.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("what"), size(old, t).alias("was"), size(new, t).alias("now")) for t in tables
    ])).alias("r")).select("r.*")
    counters = old.counters.select(F.col("name").alias("what"), F.col("value").alias("was")).join(
        new.counters.select(F.col("name").alias("what"), F.col("value").alias("now")), "what", "full_outer")
    expected = old.counters.sparkSession.createDataFrame([(n,) for n in (VERSION_ROW, ENTITY_COUNTER, VARIANT_COUNTER)], "what string")
    every = counters.join(expected, "what", "full_outer").select("what", "was", "now")
    fallen = rows.where("now < was").unionByName(every.where("was is null or now is null or now < was"))
    said = [F.coalesce(F.col(c).cast("string"), F.lit("missing")) for c in ("was", "now")]
    return _violation(fallen, "count_fell", F.col("what"), F.concat_ws(" -> ", *said))


def check_write_rules(old: State, new: State) -> DataFrame:
    """What a store must refuse to write: reused ids, duplicate keys, repeated history."""
    def repeated(table: DataFrame, columns: list[str], check: str) -> DataFrame:
        copies = table.groupBy(*columns).agg(F.count("*").alias("copies")).where("copies > 1")
        return _violation(copies, check, F.concat_ws(" ", *columns), F.concat(F.col("copies"), F.lit(" copies")))

    # A new key row must not name a key that another variant already had.
    was = old.key_history.select("slug", F.col("variant_id").alias("owner"))
    stolen = key_claims(new.key_history, new.variants).distinct().join(was, "slug") \
        .where("variant_id != owner").select("slug", "variant_id", "owner").distinct()
    return _all([
        repeated(new.entities, ["entity_id"], "duplicate_entity_id"),
        repeated(new.entities, ["name"], "duplicate_name"),
        repeated(new.variants, ["variant_id"], "duplicate_variant_id"),
        repeated(new.variants, ["slug"], "duplicate_key"),
        repeated(new.key_history, ["variant_id", "slug", "valid_from"], "repeated_key_history"),
        repeated(new.name_history, ["entity_id", "name", "valid_from"], "repeated_name_history"),
        _violation(stolen, "stolen_key", F.col("slug"), F.concat_ws(" -> ", F.col("owner"), F.col("variant_id"))),
    ])


# -- together ---------------------------------------------------------------

def state_violations(state: State) -> DataFrame:
    return _all([
        check_schema_version(state.counters), check_foreign_keys(state), check_counters(state),
        check_open_keys(state.variants, state.key_history), check_open_names(state.entities, state.name_history),
        check_key_ownership(state.key_history, state.variants),
    ])


def published_violations(published: dict[str, DataFrame], state: State) -> DataFrame:
    """``published`` as read back, against what the state gives.  The header's source is a free text."""
    derived = sections(state, "")
    keys = {"cards": "codex_id", "printings": "printing_id", "sets": "set_number", "slug_history": "slug", "name_history": "name",
            "card_printings": "codex_id", "card_sets": "codex_id"}
    return _all([
        *[check_published(published[name], derived[name], key, name) for name, key in keys.items()],
        check_published(published["header"].drop("source"), derived["header"].drop("source"), "schema_version", "header"),
        check_columns(published), check_schema(published), check_links(published["card_printings"], published["printings"]),
    ])


def version_violations(old: State, new: State) -> DataFrame:
    return _all([
        check_lost_entities(old, new), check_lost_variants(old, new), check_moved(old, new),
        check_lost_links(old, new),
        check_unexplained_key_change(old, new), check_counts(old, new), check_write_rules(old, new),
    ])
