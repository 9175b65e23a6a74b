from pyspark.sql import functions as F

from everkey.operators import checks as k, digest, lookup as q, marts
from everkey.operators.history import close_and_open
from everkey.schemas import STATE_VARIANTS
import build as b


def small(spark):
    v = b.variant
    return b.state(spark, [b.entity("Owl", rules_text="UPDATED text"), b.entity("Cat", elements="Fire, Air"), b.entity("Lone")], [
        v("006-owl-b-p", "Owl", set_number="006", set_name="Gothic"), v("006-owl-b-f", "Owl", set_number="006", set_name="Gothic", finish="Foil"),
        v("001-cat-t-p", "Cat", set_number="001", set_name="Alpha", product="Box_Topper", retired_at=b.DAY1),
        v("odd", "Cat", set_number=None, set_name="Odd", released_at=None)],
        history=[("001-owl-b-p", 1, "2024-01-01", b.DAY0), ("torn", 1, "2024-01-01", b.DAY0), ("torn", 3, "2024-01-01", b.DAY0)],
        names=[("Kitty", 2, "2024-01-01", b.DAY0), ("Kitty", 1, "2023-01-01", "2023-02-01")])


def test_lookups(spark):
    s = small(spark)
    asked = spark.createDataFrame([("006-owl-b-p",), ("001-owl-b-p",), ("torn",), ("nope",), ("001-cat-t-p",)], "slug string")
    assert b.rows(q.resolve_keys(asked, s.key_history, s.variants, s.entities), "slug", "found", "problem", "printing_id", "codex_id", "current_slug",
                  "queried_slug_is_current", "retired_at") == [
        ("001-cat-t-p", True, None, "P000003", "C000002", "001-cat-t-p", True, b.DAY1),
        ("001-owl-b-p", True, None, "P000001", "C000001", "006-owl-b-p", False, None),
        ("006-owl-b-p", True, None, "P000001", "C000001", "006-owl-b-p", True, None),
        ("nope", False, "unknown", None, None, None, None, None), ("torn", False, "conflict", None, None, None, None, None)]
    assert b.rows(q.key_conflicts(s.key_history, s.variants)) == [("torn", 1), ("torn", 3)]
    names = spark.createDataFrame([("Kitty",), ("Nobody",)], "name string")
    assert b.rows(q.resolve_names(names, s.name_history), "name", "codex_id") == [("Kitty", "C000001"), ("Kitty", "C000002"), ("Nobody", None)]

    ids = spark.createDataFrame([("C000001",), ("p3",), ("99",), ("bad",)], "id string")
    bundle = q.entity_bundle(ids, s.entities, s.variants)
    assert b.rows(bundle.select("id", "found", "codex_id", "errata", "printings")) == [
        ("99", False, "C000099", None, 0), ("C000001", True, "C000001", True, 2), ("bad", False, None, None, 0), ("p3", True, "C000003", False, 0)]
    assert b.rows(q.entity_bundle_variants(ids, s.variants), "id", "printing_id") == [("C000001", "P000001"), ("C000001", "P000002")]
    assert b.rows(q.variant_detail(ids, s.variants, s.entities), "id", "found", "card_name") == [
        ("99", False, None), ("C000001", True, "Owl"), ("bad", False, None), ("p3", True, "Cat")]

    def entities(**filters):
        return b.rows(q.search_entities(s.entities, s.variants, **filters), "name")

    assert entities() == [("Cat",), ("Lone",), ("Owl",)] and entities(limit=1) == [("Owl",)]
    assert entities(errata=True) == [("Owl",)] and entities(errata=False, name="A") == [("Cat",)]
    assert entities(element="air") == [("Cat",)] and entities(card_set="6") == [("Owl",)] and entities(card_set="alpha") == [("Cat",)]
    assert entities(card_set=6) == [("Owl",)] and entities(card_set="\t6 ") == [("Owl",)]
    assert b.rows(q.search_variants(s.variants, s.entities, product="Box Topper\t"), "slug") == [("001-cat-t-p",)]
    assert b.rows(q.search_entity_totals(s.entities, s.variants, limit=2)) == [(3, 2)]
    assert b.rows(q.search_variants(s.variants, s.entities, product="box topper"), "slug") == [("001-cat-t-p",)]
    assert b.rows(q.search_variant_totals(s.variants, s.entities, card_set="006", limit=1)) == [(2, 1, 1)]
    sets = spark.createDataFrame([("6",), ("GOTHIC",), ("7",)], "wanted string")
    assert b.rows(q.set_contents(sets, s.variants, s.entities), "wanted", "name", "printing_id") == [
        ("6", "Owl", "P000001"), ("6", "Owl", "P000002"), ("GOTHIC", "Owl", "P000001"), ("GOTHIC", "Owl", "P000002")]
    named = [r.name for r in q.set_contents(spark.createDataFrame([("odd",), ("alpha",), ("6",)], "wanted string"), s.variants, s.entities).collect()]
    assert named == ["Owl", "Owl", "Cat", "Cat"]
    assert b.rows(q.set_contents_totals(sets, s.variants)) == [
        ("6", "Gothic", "006", 1, 2), ("7", None, None, 0, 0), ("GOTHIC", "Gothic", "006", 1, 2)]
    needs = spark.createDataFrame([("a", 1, 2), ("a", 2, 1), ("b", 3, 1)], "owner string, entity_id bigint, needed bigint")
    owned = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 4, 5), ("b", 1, 9)], "owner string, variant_id bigint, amount bigint")
    assert b.rows(q.coverage(needs, owned, s.variants)) == [("a", 2, 2, True), ("b", 1, 0, False)]


def test_search_batch_equals_single_searches(spark):
    """Every mix of filters, null, empty, unknown and repeated ones among them, against a search for each."""
    s = small(spark)
    mixes = [(n, c, p, f) for n in (None, "", "O", "wl", "CAT", "owls", "zzz") for c in (None, "", "6", "\tgothic ", "odd", "99")
             for p in (None, "", "box topper\t") for f in (None, "", "FOIL")]
    schema = "request bigint, name string, card_set string, product string, finish string"
    requests = spark.createDataFrame([(i, *m) for i, m in enumerate(mixes)], schema)
    got = b.rows(q.search_variants_batch(requests, s.variants, s.entities, limit=2), "request", "total_matches", "distinct_cards", "returned", "position", "slug")
    named = {e.entity_id: e.name for e in s.entities.collect()}
    want, rows = [], sorted(s.variants.collect(), key=lambda v: v.variant_id)
    for i, (n, c, p, f) in enumerate(mixes):
        wanted = (c or "").strip().lower()
        hit = [v for v in rows if (n or "").lower() in named[v.entity_id].lower() and (not f or (v.finish or "").lower() == f.lower())
               and (not p or (v.product or "").strip().lower().replace(" ", "_") == p.strip().lower().replace(" ", "_"))
               and (not c or (v.set_number == wanted.zfill(3) if wanted.isdecimal() else (v.set_name or "").lower() == wanted))]
        totals = (i, len(hit), len({v.entity_id for v in hit}), min(len(hit), 2))
        want += [(*totals, at + 1, v.slug) for at, v in enumerate(hit[:2])] or [(*totals, None, None)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert q.search_variants_batch(requests.limit(0), s.variants, s.entities).count() == 0


def test_marts_and_digests(spark):
    s = small(spark)
    assert [tuple(r) for r in marts.in_catalogue_order(marts.set_catalogue(s.variants)).collect()] == [
        ("001", "Alpha", "2024-05-05", 1, 1), ("006", "Gothic", "2024-05-05", 1, 2), (None, "Odd", None, 1, 1)]
    assert [r.set_number for r in marts.in_release_order(marts.set_catalogue(s.variants)).collect()] == [None, "001", "006"]
    assert [tuple(r) for r in marts.product_counts(s.variants).collect()] == [("Box", 3), ("Box_Topper", 1)]
    assert b.rows(marts.published_entities(s.entities, s.variants), "codex_id", "errata", "sets", "printings") == [
        ("C000001", True, 1, 2), ("C000002", False, 1, 2), ("C000003", False, 0, 0)]
    assert b.rows(marts.sets_per_entity(s.variants)) == [("C000001", "006"), ("C000002", "001")]
    assert b.rows(marts.header(s, "x")) == [(6, "x", 3, 3, 4, 7, 5)]

    def seen(df):
        return b.rows(digest.table_digest(df, STATE_VARIANTS.names, "v"))

    assert seen(s.variants) == seen(s.variants.repartition(5, "slug"))
    assert seen(s.variants) != seen(s.variants.unionByName(s.variants.where("variant_id = 1")))
    assert seen(s.variants) != seen(s.variants.withColumn("artist", F.lit("")))
    lists = spark.createDataFrame([(["a,b"],), (["a", "b"],), ([None, "ab"],), (["ab"],), ([],), (None,)], "x array<string>")
    each = [digest.section_digests({"l": lists.where(lists.x.eqNullSafe(F.lit(None).cast("array<string>")) if r.x is None else lists.x.eqNullSafe(F.array(*map(F.lit, r.x)).cast("array<string>")))}).first().digest
            for r in lists.collect()]
    assert len(set(each)) == 6
    sections = marts.sections(s, "x")
    found = digest.section_digests({k_: sections[k_] for k_ in ("sets", "cards", "printings")})
    stated = found.where("section <> 'sets'").withColumn("digest", F.when(F.col("section") == "cards", "other").otherwise(F.col("digest")))
    told = digest.manifest(found, sections["header"], "v1", 6, stated)
    assert b.rows(told, "section", "agrees") == [("cards", False), ("printings", True), ("sets", False)]
    wrong = sections["header"].withColumn("printings", F.col("printings") + 1)
    assert b.rows(digest.disagreements(digest.manifest(found, wrong, "v1", 6, found)), "key") == [("printings",)]


def test_checks(spark):
    v = b.variant
    good = b.state(spark, [b.entity("Owl")], [v("001-owl-b-p", "Owl"), v("001-owl-b-f", "Owl", finish="Foil")])
    assert b.rows(k.state_violations(good)) == [] and b.rows(k.version_violations(good, good)) == []
    published = marts.sections(good, "x")
    assert b.rows(k.published_violations(published, good)) == []
    assert k.column_types(published["sets"], {"set_number": "string"}, "sets") == [
        "sets.cards: bigint instead of None", "sets.printings: bigint instead of None",
        "sets.released_at: string instead of None", "sets.set_name: string instead of None"]
    # Away and back on one day: the history row of that day would exist twice.
    there = spark.createDataFrame([(1, "001-owl-b-p", "002-owl-b-p")], "variant_id bigint, old_key string, new_key string")
    back = spark.createDataFrame([(1, "002-owl-b-p", "001-owl-b-p")], "variant_id bigint, old_key string, new_key string")
    none = good.variants.limit(0)
    history = close_and_open(good.key_history, there, none, "variant_id", "slug", b.DAY0)
    history = close_and_open(history, back, none, "variant_id", "slug", b.DAY0)
    twice = type(good)(**{**good.tables(), "key_history": history})
    assert b.rows(k.check_write_rules(good, twice), "check", "key") == [
        ("repeated_key_history", f"1 001-owl-b-p {b.DAY0}")]


def test_checks_fail_closed(spark):
    good = b.state(spark, [b.entity("Owl")], [b.variant("001-owl-b-p", "Owl")])

    def counted(change):
        return type(good)(**{**good.tables(), "counters": change(good.counters)})

    for name in ("next_entity_id", "next_variant_id"):
        for lost in (counted(lambda c: c.where(F.col("name") != name)), counted(lambda c: c.withColumn("value", F.when(F.col("name") != name, F.col("value"))))):
            assert b.rows(k.check_counters(lost), "key") == [(name,)]
            assert (name,) in b.rows(k.check_counts(good, lost), "key") and (name,) in b.rows(k.check_counts(lost, good), "key")
    bare = counted(lambda c: c.where("name <> 'schema_version'"))
    assert ("schema_version",) in b.rows(k.check_counts(bare, good), "key") and b.rows(k.check_schema_version(bare.counters)) != []
    emptied = type(good)(**{**good.tables(), "variants": good.variants.limit(0)})
    assert ("variants", "1 -> 0") in b.rows(k.check_counts(bare, emptied).unionByName(k.check_counts(good, emptied)), "key", "detail")
    published = marts.sections(good, "x")
    for change in (lambda t: t.drop("set_name"), lambda t: t.withColumn("more", F.lit(1)), lambda t: t.withColumn("cards", F.col("cards").cast("string"))):
        assert k.check_columns(published | {"sets": change(published["sets"])}).count() == 1
    assert k.check_columns(published).count() == 0


def test_a_wanted_set_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "variants")
    small(spark).variants.write.parquet(path)
    plan = q.matching_variants(spark.read.parquet(path), small(spark).entities, card_set=6)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(set_number,006)" in plan


def test_search_batch_meets_only_matches(spark, monkeypatch):
    """Searches whose texts look alike and share their sets: whatever a join brings together is a match."""
    plans, write = [], q.written

    def kept(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(q, "written", kept)
    names = [f"owl 🦉 #{n}" for n in range(100, 130)] + ["owl owl", "#1", ""]
    entities = spark.createDataFrame([(i, n) for i, n in enumerate(names)] + [(40, None)], "entity_id bigint, name string")
    rows = [(i, i % 31, f"k{i}", None if i % 5 == 0 else f"{i % 3 + 1:03d}", "North" if i % 2 else None, "Box" if i % 4 else None, "Foil" if i % 3 else None)
            for i in range(90)]
    variants = spark.createDataFrame(rows, "variant_id bigint, entity_id bigint, slug string, set_number string, set_name string, product string, finish string") \
        .withColumn("retired_at", F.lit(None).cast("string"))
    texts = [None, "o", "OWL", "l #1", "🦉 #12", "owl owl owl"] + [f"#{n}" for n in (1, 10, 11, 12, 100, 101, 110, 119, 120)]
    mixes = [(n, c, p, f) for n in texts for c in (None, "2", "north") for p in (None, "box", "\t") for f in (None, "foil")]
    requests = spark.createDataFrame([(i, *m) for i, m in enumerate(mixes)], "request bigint, name string, card_set string, product string, finish string")
    got = b.rows(q.search_variants_batch(requests, variants, entities, limit=3), "request", "total_matches", "distinct_cards", "returned", "position", "slug")
    want = []
    for i, (n, c, p, f) in enumerate(mixes):
        hit = [v for v in rows if (n or "").lower() in names[v[1]] and (not c or v[3] == c.zfill(3) or (v[4] or "").lower() == c)
               and (not p or (v[5] or "").lower() == p.strip()) and (not f or (v[6] or "").lower() == f)]
        totals = (i, len(hit), len({v[1] for v in hit}), min(len(hit), 3))
        want += [(*totals, at + 1, v[2]) for at, v in enumerate(hit[:3])] or [(*totals, None, None)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    tested = [line for plan in plans for line in plan.splitlines() if "Join Inner" in line and ("Contains(" in line or " OR " in line)]
    assert len(plans) >= 3 and not tested


def test_published_rows_are_compared_by_short_digests(spark):
    """A row of a section costs its key and 16 bytes in the shuffle, and copies still count."""
    rows = lambda *values: spark.createDataFrame(values, "id string, text string")
    derived = rows(("1", "a"), ("2", None), ("3", "c"), ("3", "c"))
    found = k.check_published(rows(("1", "a"), ("2", ""), ("3", "c"), ("3", "c"), ("3", "c")), derived, "id", "x")
    assert sorted((r.key, r.detail) for r in found.collect()) == [
        ("2", "derived but not published"), ("2", "published but not derived"), ("3", "published but not derived")]
    tree = found._jdf.queryExecution().analyzed()
    while "Aggregate" not in tree.nodeName():
        tree = tree.children().head()
    digest = [a for a in (tree.child().output().apply(i) for i in range(tree.child().output().size())) if a.name() == "_row"][0]
    assert digest.dataType().typeName() == "binary"
