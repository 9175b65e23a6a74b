"""One key with a third of all rows: whole results, and work that is split up."""

import pytest
from pyspark.sql import functions as F

from everkey.functions.joins import left_join_many
from everkey.operators import lookup as q, marts, variant_diff as vd
from everkey.schemas import KEY_HISTORY, STATE_ENTITIES, STATE_VARIANTS
from everkey.plans.workload import shaped

ROWS = 120_000


@pytest.fixture()
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    """Rows and the plan that adaptive execution ended with."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def hot_variants(spark):
    """Entity 1 has a third of all variants, all in one set."""
    number = F.col("id") + 1
    owner = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000 + 2)
    return shaped(spark.range(0, ROWS, 1, 8), STATE_VARIANTS, {
        "variant_id": number, "entity_id": owner, "slug": F.concat(F.lit("001-x"), number, F.lit("-b-p")),
        "set_name": F.lit("First"), "set_number": F.lit("001"), "product": F.lit("Box"), "finish": F.lit("Plain")})


def entities(spark):
    return shaped(spark.range(1, 5002), STATE_ENTITIES, {"entity_id": F.col("id"), "name": F.concat(F.lit("e"), F.col("id"))})


def test_a_hot_entity_is_split_in_joins(spark, small_partitions):
    rows, plan = executed(marts.with_entity_name(hot_variants(spark), entities(spark)).select("variant_id", "entity_name"))
    assert len({r.variant_id for r in rows}) == len(rows) == ROWS
    assert "skew=true" in plan
    pairs, plan = executed(left_join_many(
        entities(spark).select("entity_id"), hot_variants(spark).select("entity_id", "variant_id"), "entity_id"))
    assert sum(r.entity_id == 1 for r in pairs) == ROWS // 3 and len(pairs) == ROWS
    assert "skew=true" in plan


def test_a_hot_entity_is_one_row_and_all_links(spark, small_partitions):
    """One shape at any size: 25,000 variants of one entity among 75,000."""
    variants = spark.range(0, 75_000, 1, 8).select(
        (F.col("id") + 1).alias("variant_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).alias("entity_id"), F.lit("001").alias("set_number"))
    own = entities(spark)
    cards = {r.codex_id: r for r in marts.published_entities(own, variants).collect()}
    assert len(cards) == own.count() and cards["C000001"].printings == 25_000 and cards["C000001"].sets == 1
    links = marts.variants_per_entity(variants)
    assert links.where("codex_id = 'C000001'").count() == 25_000 and links.count() == 75_000
    asked = spark.createDataFrame([("1",), ("C000001",)], "id string")
    assert [r.printings for r in q.entity_bundle(asked, own, variants).collect()] == [25_000, 25_000]


def test_a_hot_key_in_the_request_is_split(spark, small_partitions):
    variants = hot_variants(spark)
    history = shaped(variants, KEY_HISTORY, {"slug": F.concat(F.lit("old-"), F.col("slug")), "variant_id": F.col("variant_id"),
                                             "valid_from": F.lit("2024-01-01"), "valid_to": F.lit("2024-02-01")})
    number = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 1)
    asked = spark.range(0, ROWS, 1, 8).select(F.concat(F.lit("old-001-x"), number, F.lit("-b-p")).alias("slug"))
    rows, plan = executed(q.resolve_keys(asked, history, variants, entities(spark)).select("slug", "found", "printing_id"))
    assert len(rows) == ROWS and all(r.found for r in rows)
    assert sum(r.printing_id == "P000007" for r in rows) >= ROWS // 3
    assert "skew=true" in plan


def test_a_hot_pairing_group_becomes_one_case(spark, small_partitions):
    """A third of all variants vanish and reappear under one entity: nothing pairs."""
    from everkey.operators.entity_diff import EntityPlan, classify_entities, pair_counts

    own = entities(spark)
    variants = hot_variants(spark)
    incoming = variants.join(own.select("entity_id", F.col("name").alias("entity_name")), "entity_id") \
        .withColumn("slug", F.concat(F.lit("2"), F.col("slug"))) \
        .select(*[F.lit(0).cast("bigint").alias(p) for p in ("entity_pos", "set_pos")], F.col("variant_id").alias("variant_pos"),
                "entity_name", *[c for c in variants.columns if c not in ("variant_id", "entity_id", "retired_at")])
    history = spark.createDataFrame([], KEY_HISTORY)
    same = own.select(F.col("entity_id").alias("entity_pos"), *[c for c in own.columns if c != "entity_id"])
    entity_plan: EntityPlan = classify_entities(own, same)
    plan = vd.classify_variants(own, variants, history, incoming, entity_plan)
    case = vd.variant_cases(plan).where("case_id = 'variant:e1'").collect()
    assert [(r.n_missing, r.n_candidates) for r in case] == [(ROWS // 3, ROWS // 3)]
    assert vd.variant_case_members(plan).where("case_id = 'variant:e1'").count() == 2 * ROWS // 3

    # The join back from the counts to the rows is the step that meets the hot group.
    sides = vd.one_sided(plan.differing, entity_plan).withColumn("key", F.struct("entity_name", "set_name", "product", "finish"))
    joined, final = executed(sides.join(pair_counts(sides, F.col("key")), "key", "left").select("slug", "n_missing"))
    assert len(joined) == 2 * ROWS and "skew=true" in final
