"""Bulk lookups: a table of requests in, one row per request out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import entity_ref, id_number, variant_ref
from ..functions.joins import distinct_keys, grouped, left_join_many
from ..functions.text import (
    has_text, in_wanted_set, is_errata, product_code, same_product, same_text, set_name_of, set_number_of,
)
from ..schemas import ENTITY_FIELDS, VARIANT_FIELDS
from ..session import written
from .marts import with_entity_name

def key_claims(history: DataFrame, variants: DataFrame) -> DataFrame:
    """Every (key, variant) that ever held, from history and current keys."""
    return history.select("slug", "variant_id").unionByName(variants.select("slug", "variant_id"))


def key_owners(claims: DataFrame) -> DataFrame:
    """One row per key.  Lowest and highest claimant differ when a key is contested."""
    return grouped(
        claims, ["slug"], F.min("variant_id").alias("owner_id"), F.max("variant_id").alias("other_id"),
    ).select("slug", "owner_id", (F.col("owner_id") != F.col("other_id")).alias("conflicted"))


def key_conflicts(history: DataFrame, variants: DataFrame) -> DataFrame:
    """Contested keys and their claimants, one row each."""
    claims = key_claims(history, variants)
    contested = key_owners(claims).where("conflicted").select("slug")
    return claims.join(contested, "slug", "left_semi").distinct()


def resolve_keys(keys: DataFrame, history: DataFrame, variants: DataFrame, entities: DataFrame) -> DataFrame:
    """Keys, current or former, to permanent ids.

    A contested key is refused and an unknown one not found; neither is guessed.
    Only claims on wanted keys are grouped, so a short request is broadcast
    against the history instead of shuffling it.
    """
    owners = key_owners(key_claims(history, variants).join(distinct_keys(keys, "slug"), "slug", "left_semi"))
    targets = variants.select("variant_id", "entity_id", F.col("slug").alias("current_slug"), "set_name", "set_number",
                              "product", "finish", "retired_at")
    details = owners.select("slug", "conflicted", F.when(~F.col("conflicted"), F.col("owner_id")).alias("variant_id")) \
        .join(targets, "variant_id", "left") \
        .join(entities.select("entity_id", F.col("name").alias("card_name")), "entity_id", "left")
    answer = keys.join(details, "slug", "left")
    return answer.select(
        *keys.columns,
        F.col("current_slug").isNotNull().alias("found"),
        F.when(F.col("conflicted"), "conflict").when(F.col("current_slug").isNull(), "unknown").alias("problem"),
        variant_ref(F.col("variant_id")).alias("printing_id"), entity_ref(F.col("entity_id")).alias("codex_id"),
        "card_name", "current_slug", (F.col("current_slug") == F.col("slug")).alias("queried_slug_is_current"),
        "set_name", "set_number", "product", "finish", "retired_at",
    )


def resolve_names(names: DataFrame, history: DataFrame) -> DataFrame:
    """All entities that ever had a name: names, unlike keys, may be shared."""
    matches = history.select("name", "entity_id", "valid_from", "valid_to")
    return left_join_many(names, matches, "name").select(
        *names.columns, entity_ref(F.col("entity_id")).alias("codex_id"), "valid_from", "valid_to")


def entity_bundle(requests: DataFrame, entities: DataFrame, variants: DataFrame) -> DataFrame:
    """Requested entities (``id`` in any spelling): one row per request, with the number of variants."""
    wanted = requests.withColumn("entity_id", id_number(F.col("id")))
    ids = distinct_keys(wanted, "entity_id")
    counts = grouped(variants.join(ids, "entity_id", "left_semi"), ["entity_id"], F.count("*").alias("printings"))
    found = entities.select("entity_id", *ENTITY_FIELDS, is_errata(F.col("rules_text")).alias("errata"),
                            F.lit(True).alias("found"))
    return wanted.join(found, "entity_id", "left").join(counts, "entity_id", "left").select(
        *requests.columns, F.coalesce("found", F.lit(False)).alias("found"),
        entity_ref(F.col("entity_id")).alias("codex_id"), *ENTITY_FIELDS, "errata",
        F.coalesce("printings", F.lit(0).cast("bigint")).alias("printings"))


def entity_bundle_variants(requests: DataFrame, variants: DataFrame) -> DataFrame:
    """The variants of the requested entities, one row for each variant and request."""
    wanted = requests.withColumn("entity_id", id_number(F.col("id")))
    return wanted.join(variants, "entity_id").select(
        *requests.columns, entity_ref(F.col("entity_id")).alias("codex_id"), variant_ref(F.col("variant_id")).alias("printing_id"),
        "slug", "set_name", "set_number", "product", "finish", "artist", "retired_at")


def variant_detail(requests: DataFrame, variants: DataFrame, entities: DataFrame) -> DataFrame:
    wanted = requests.withColumn("variant_id", id_number(F.col("id")))
    found = with_entity_name(variants.join(distinct_keys(wanted, "variant_id"), "variant_id", "left_semi"), entities)
    return wanted.join(found, "variant_id", "left").select(
        *requests.columns, F.col("slug").isNotNull().alias("found"),
        variant_ref(F.col("variant_id")).alias("printing_id"), entity_ref(F.col("entity_id")).alias("codex_id"),
        F.col("entity_name").alias("card_name"), *VARIANT_FIELDS, "retired_at")


def matching_entities(entities: DataFrame, variants: DataFrame, name: str | None = None, type: str | None = None,
                      element: str | None = None, rarity: str | None = None, card_set: str | int | None = None,
                      errata: bool | None = None) -> DataFrame:
    """All entities that pass every given filter; an empty filter is no filter."""
    found = entities.withColumn("errata", is_errata(F.col("rules_text")))
    if name:
        found = found.where(has_text(F.col("name"), name))
    if type:
        found = found.where(same_text(F.col("type"), type))
    if element:
        found = found.where(has_text(F.col("elements"), element))
    if rarity:
        found = found.where(same_text(F.col("rarity"), rarity))
    if errata is not None:
        found = found.where(F.col("errata") == errata)
    if card_set:
        members = variants.where(in_wanted_set(F.col("set_number"), F.col("set_name"), card_set))
        found = found.join(members.select("entity_id").distinct(), "entity_id", "left_semi")
    return found


def search_entities(entities: DataFrame, variants: DataFrame, limit: int = 20, **filters) -> DataFrame:
    """The first ``limit`` matches in id order."""
    return matching_entities(entities, variants, **filters).orderBy("entity_id").limit(limit).select(
        entity_ref(F.col("entity_id")).alias("codex_id"), "name", "type", "rarity", "elements", "cost", "errata",
        "rules_text")


def search_entity_totals(entities: DataFrame, variants: DataFrame, limit: int = 20, **filters) -> DataFrame:
    total = F.count("*")
    return matching_entities(entities, variants, **filters).agg(
        total.alias("total_matches"), F.least(total, F.lit(limit).cast("bigint")).alias("returned"))


def matching_variants(variants: DataFrame, entities: DataFrame, name: str | None = None,
                      card_set: str | int | None = None, product: str | None = None,
                      finish: str | None = None) -> DataFrame:
    found = variants
    if card_set:
        found = found.where(in_wanted_set(F.col("set_number"), F.col("set_name"), card_set))
    if product:
        found = found.where(same_product(F.col("product"), product))
    if finish:
        found = found.where(same_text(F.col("finish"), finish))
    named = with_entity_name(found, entities)
    return named.where(has_text(F.col("entity_name"), name)) if name else named


def search_variants(variants: DataFrame, entities: DataFrame, limit: int = 50, **filters) -> DataFrame:
    return matching_variants(variants, entities, **filters).orderBy("variant_id").limit(limit).select(
        variant_ref(F.col("variant_id")).alias("printing_id"), entity_ref(F.col("entity_id")).alias("codex_id"),
        F.col("entity_name").alias("card_name"), "slug", "set_name", "set_number", "product", "finish", "retired_at")


def search_variant_totals(variants: DataFrame, entities: DataFrame, limit: int = 50, **filters) -> DataFrame:
    total = F.count("*")
    return matching_variants(variants, entities, **filters).agg(
        total.alias("total_matches"), F.countDistinct("entity_id").alias("distinct_cards"),
        F.least(total, F.lit(limit).cast("bigint")).alias("returned"))


def _pieces(column: str, width: Column) -> Column:
    """All pieces of a text with ``width`` characters (code points)."""
    last = F.length(column) - width + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.substring(F.col(column), at, width))


def needles_in(needles: DataFrame, names: DataFrame) -> DataFrame:
    """``_needle, _name``: which of the distinct lower-cased names hold which of the distinct needles, none of them empty.

    A name is cut, at each character that some needle begins with, into pieces as long as the needles that begin with it.
    A piece that is a needle is a match, so no needle meets a name that does not hold it, however many look alike.
    """
    one = F.lit(1)
    lengths = written(needles.groupBy(F.substring("_needle", 1, 1).alias("_first")).agg(F.collect_set(F.length("_needle")).alias("_lengths")), "needle-lengths")
    starts = names.select("_name", F.posexplode(_pieces("_name", one)).alias("_at", "_first")).join(lengths, "_first")
    fitting = F.filter("_lengths", lambda n: n <= F.length("_name") - F.col("_at"))
    cut = starts.select("_name", F.explode(F.transform(fitting, lambda n: F.substring(F.col("_name"), F.col("_at") + one, n))).alias("_needle"))
    return cut.join(needles, "_needle").select("_needle", "_name").distinct()


def _set_key(number: Column, name: Column) -> Column:
    return F.coalesce(F.concat(F.lit("#"), number), F.concat(F.lit("@"), name))


def _marked(part: Column) -> Column:
    """A part of a search's text form, told from any other by the size that is put in front; null for null."""
    return F.concat(F.length(part), F.lit(":"), part)


def search_variants_batch(requests: DataFrame, variants: DataFrame, entities: DataFrame, limit: int = 50) -> DataFrame:
    """A table of variant searches: ``request`` and its filters ``name, card_set, product, finish``, all text.

    A null or empty filter is no filter.  The first ``limit`` matches of a request in id order are numbered from 1 and
    carry its totals; a request without matches has one row with zeros and nulls.  Requests with the same filters are
    answered once.  A variant is looked up by what searches for it say: for each asked text that its name holds, and each
    choice of other filters that comes with this text, by the search that states just its own values.
    """
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    filters = requests.select(
        "request", F.lower(given("name")).alias("_needle"), _set_key(set_number_of(given("card_set")), set_name_of(given("card_set"))).alias("_set"),
        F.when(given("product").isNotNull(), product_code(F.col("product"))).alias("_product"), F.lower(given("finish")).alias("_finish"))
    parts, none = ["_needle", "_set", "_product", "_finish"], F.lit("-")
    filters = filters.withColumn("_q", F.concat(*[F.coalesce(_marked(F.col(c)), none) for c in parts]))
    # Which filters a search has: none, a number or a name for the set, then the two others.  No needle is the empty one.
    by = F.when(F.col("_set").isNull(), 0).when(F.startswith("_set", F.lit("#")), 1).otherwise(2)
    kind = F.struct(by.alias("set"), F.col("_product").isNotNull().alias("product"), F.col("_finish").isNotNull().alias("finish"))
    distinct = filters.groupBy("_q").agg(F.first(F.coalesce("_needle", F.lit(""))).alias("_needle"), F.first(kind).alias("_kind"))
    asked = written(distinct.withColumn("_a", F.monotonically_increasing_id()), "searches")
    kinds = written(asked.groupBy("_needle").agg(F.collect_set("_kind").alias("_kinds")), "search-kinds")

    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    names = entities.select(low("name").alias("_name")).distinct()
    held = needles_in(kinds.where("_needle <> ''").select("_needle"), names).union(names.select(F.lit(""), "_name"))
    sought = grouped(held.join(kinds, "_needle"), ["_name"], F.collect_list(F.struct("_needle", "_kinds")).alias("_sought"))
    owners = entities.select("entity_id", low("name").alias("_name")).join(sought, "_name").select("entity_id", "_sought")
    lean = variants.select("variant_id", "entity_id", F.concat(F.lit("#"), "set_number").alias("_by_number"),
                           F.concat(F.lit("@"), low("set_name")).alias("_by_name"), product_code(F.col("product")).alias("_p"), low("finish").alias("_f"))
    each = lean.join(owners, "entity_id").select("*", F.explode("_sought").alias("_s"))
    each = each.select("*", F.explode("_s._kinds").alias("_kind"))
    # Null, and so found by no search, where the variant lacks the number that the searches name.
    said = F.concat(
        F.when(F.col("_s._needle") == "", none).otherwise(_marked(F.col("_s._needle"))),
        F.when(F.col("_kind.set") == 0, none).when(F.col("_kind.set") == 1, _marked(F.col("_by_number"))).otherwise(_marked(F.col("_by_name"))),
        F.when(F.col("_kind.product"), _marked(F.col("_p"))).otherwise(none), F.when(F.col("_kind.finish"), _marked(F.col("_f"))).otherwise(none))
    met = each.select(said.alias("_q"), "variant_id", "entity_id").join(asked.select("_q", "_a"), "_q")
    found = written(met.select("_a", "variant_id", "entity_id"), "search-matches")

    pairs = found.groupBy("_a", "entity_id").agg(F.count("*").alias("n"))
    totals = pairs.groupBy("_a").agg(F.sum("n").alias("total_matches"), F.count("*").alias("distinct_cards"))
    # The group limit works in each task before the shuffle, so a request that matches everything brings a few rows.
    first = found.withColumn("position", F.row_number().over(Window.partitionBy("_a").orderBy("variant_id"))).where(F.col("position") <= limit)
    shown = with_entity_name(first.select("_a", "position", "variant_id").join(variants, "variant_id"), entities)
    shown = shown.select("_a", "position", variant_ref(F.col("variant_id")).alias("printing_id"), entity_ref(F.col("entity_id")).alias("codex_id"),
                         F.col("entity_name").alias("card_name"), "slug", "set_name", "set_number", "product", "finish", "retired_at")
    zero = F.lit(0).cast("bigint")
    total = F.coalesce("total_matches", zero)
    answers = asked.select("_q", "_a").join(totals, "_a", "left").join(shown, "_a", "left")
    return filters.select("request", "_q").join(answers, "_q").select(
        "request", total.alias("total_matches"), F.coalesce("distinct_cards", zero).alias("distinct_cards"),
        F.least(total, F.lit(limit).cast("bigint")).alias("returned"), *[c for c in shown.columns if c != "_a"])


def in_wanted_sets(requests: DataFrame, variants: DataFrame) -> DataFrame:
    """Variants of each wanted set (``wanted``: a number or a name)."""
    asked = requests.select("wanted").distinct()
    by_number = asked.select("wanted", set_number_of(F.col("wanted")).alias("set_number")).where("set_number is not null")
    by_name = asked.select("wanted", set_name_of(F.col("wanted")).alias("_name")).where("_name is not null")
    columns = ["wanted", "variant_id", "entity_id", "set_number", "set_name"]
    named = variants.withColumn("_name", F.lower(F.coalesce("set_name", F.lit(""))))
    return variants.join(by_number, "set_number").select(columns).unionByName(
        named.join(by_name, "_name").select(columns))


def set_contents(requests: DataFrame, variants: DataFrame, entities: DataFrame) -> DataFrame:
    """Variants of each wanted set, one row each, by name of their entity and id."""
    members = in_wanted_sets(requests, variants)
    return members.join(entities.select("entity_id", "name"), "entity_id").orderBy("wanted", "name", "entity_id", "variant_id").select(
        "wanted", entity_ref(F.col("entity_id")).alias("codex_id"), "name", variant_ref(F.col("variant_id")).alias("printing_id"))


def set_contents_totals(requests: DataFrame, variants: DataFrame) -> DataFrame:
    """One row per wanted set; name and number of its last variant, zeros if unknown."""
    members = in_wanted_sets(requests, variants)
    pairs = members.groupBy("wanted", "entity_id").agg(
        F.max(F.struct("variant_id", "set_name", "set_number")).alias("last"), F.count("*").alias("n"))
    totals = pairs.groupBy("wanted").agg(
        F.max("last").alias("last"), F.count("*").alias("distinct_cards"), F.sum("n").alias("total_printings"))
    zero = F.lit(0).cast("bigint")
    return requests.select("wanted").distinct().join(totals, "wanted", "left").select(
        "wanted", "last.set_name", "last.set_number", F.coalesce("distinct_cards", zero).alias("distinct_cards"),
        F.coalesce("total_printings", zero).alias("total_printings"))


def coverage(needs: DataFrame, owned: DataFrame, variants: DataFrame) -> DataFrame:
    """Which wanted lists can be met from what is owned.

    ``needs(owner, entity_id, needed)`` against ``owned(owner, variant_id, amount)``;
    any variant of an entity fills the need.
    """
    # Add up per variant before the variants are looked up.
    amounts = owned.groupBy("owner", "variant_id").agg(F.sum("amount").alias("amount"))
    held = amounts.join(variants.select("variant_id", "entity_id"), "variant_id") \
        .groupBy("owner", "entity_id").agg(F.sum("amount").alias("held"))
    wanted = needs.groupBy("owner", "entity_id").agg(F.sum("needed").alias("needed"))
    met: Column = F.coalesce("held", F.lit(0)) >= F.col("needed")
    return wanted.join(held, ["owner", "entity_id"], "left").groupBy("owner").agg(
        F.count("*").alias("entities_needed"), F.count_if(met).alias("entities_met"),
        F.bool_and(met).alias("complete"))
