import json

import pytest
from pyspark.sql import functions as F

from everkey.operators import corrections as c, flatten
from everkey.schemas import CORRECTIONS, ENTITY_FIELDS
from everkey.sources import feed, published
import build as b


def entry(**fields):
    return {"name": "Owl", "guardian": {"type": "Beast", "rarity": None, "rulesText": "Fly\r\n\r\n high ", "cost": 2, "thresholds": {"air": 1}},
            "elements": "Air", "subTypes": None,
            "sets": [{"name": " First ", "releasedAt": "2024-05-05T10:00:00.000Z", "metadata": {"rulesText": None, "life": 3},
                      "variants": [{"slug": "001-owl-b-p", "product": "Box", "finish": "Plain"},
                                   {"slug": "odd key", "product": None, "finish": "Foil", "flavorText": "Hoo\r"}]}]} | fields


def test_payload_from_lines_and_from_one_document(spark, tmp_path):
    lines, document = tmp_path / "lines.json", tmp_path / "document.json"
    entries = [entry(), entry(name="Cat", sets=[])]
    lines.write_text("".join(json.dumps({"ordinal": i, **e}) + "\n" for i, e in enumerate(entries)))
    document.write_text(json.dumps(entries, indent=1))
    for payload in (feed.read_payload(spark, str(lines)), feed.read_payload_document(spark, str(document))):
        entities, variants = flatten.checked_snapshot(payload)
        assert b.rows(entities, "entity_pos", "name", "rules_text", "rarity", "cost", "life", "thr_air", "thr_fire") == [
            (0, "Owl", "Fly\n high", None, 2, None, 1, 0), (1, "Cat", "Fly\n high", None, 2, None, 1, 0)]
        assert b.rows(variants, "slug", "set_name", "set_number", "released_at", "finish", "flavour_text", "rules_text", "life", "variant_pos") == [
            ("001-owl-b-p", "First", "001", "2024-05-05", "Plain", None, "", 3, 0),
            ("odd key", "First", None, "2024-05-05", "Foil", "Hoo", "", 3, 1)]
    kept = feed.keep_raw(spark, str(lines), str(tmp_path / "kept"))
    assert kept.count() == 2

    lines.write_text(json.dumps(entry(guardian={"cost": "three"})) + "\n")
    with pytest.raises(Exception):
        feed.read_payload(spark, str(lines)).collect()


@pytest.mark.parametrize("entries", [
    [entry(), entry(name="Owl \n", sets=[])],
    [entry(), entry(name="Cat")],
    [entry(guardian=None)], [entry(sets=None)], [entry(name=None)],
    [entry(sets=[{"name": "First", "metadata": None, "variants": []}])],
    [entry(sets=[{"name": "First", "metadata": {}, "variants": [{"slug": None}]}])],
], ids=["same name", "same key", "no attributes", "no sets", "no name", "no set attributes", "no key"])
def test_unusable_payloads_stop_the_run(spark, entries):
    with pytest.raises(flatten.FatalInput):
        flatten.checked_snapshot(b.payload(spark, entries))


def test_corrections(spark, tmp_path):
    file = tmp_path / "corrections.json"
    file.write_text(json.dumps([
        {"match": {"card_name": "Owl"}, "set_fields": {"life": None, "cost": 5}, "reason": "r"},
        {"match": {"card_name": "Owl", "set_name": "Second "}, "set_fields": {"cost": 6, "artist": "Zoe"}, "reason": "r"},
        {"match": {"card_name": "Owl"}, "set_fields": {"rarity": "Rare"}, "reason": "r"},
        {"match": {"card_name": "Cat", "set_name": "First"}, "set_fields": {"cost": 1}, "reason": "r"},
        {"match": {"card_name": "Cat"}, "set_fields": {"cost": 2}, "reason": "later"},
        {"match": {"card_name": "Elk"}, "set_fields": {"cost": 2}, "reason": "nobody"},
        {"match": {"card_name": "Owl", "set_name": "Third"}, "set_fields": {"cost": 2}, "reason": "no set"},
    ]))
    entities, variants = b.snapshot(spark, [b.entity("Owl", life=20), b.entity("Cat"), b.entity("Dog")], [
        b.variant("001-owl-b-p", "Owl", life=20, cost=1), b.variant("002-owl-b-p", "Owl", set_name="Second", life=20, cost=1),
        b.variant("001-cat-b-p", "Cat"), b.variant("001-dog-b-p", "Dog", cost=7)])
    corrections = feed.read_corrections(spark, str(file))
    (file.parent / "many").mkdir()
    for name in ("a.json", "b.json"):
        (file.parent / "many" / name).write_text(file.read_text())
    with pytest.raises(ValueError, match="one file"):
        feed.read_corrections(spark, str(file.parent / "many"))
    assert b.rows(c.unmatched_corrections(entities, variants, corrections), "reason") == [("no set",), ("nobody",)]
    entities, variants = c.apply_corrections(entities, variants, corrections)
    assert b.rows(entities, "name", "life", "cost", "rarity") == [
        ("Cat", None, 2, "Common"), ("Dog", None, 3, "Common"), ("Owl", None, 5, "Rare")]
    assert b.rows(variants, "slug", "life", "cost", "artist", "rarity") == [
        ("001-cat-b-p", None, 2, None, None), ("001-dog-b-p", None, 7, None, None),
        ("001-owl-b-p", None, 5, None, "Rare"), ("002-owl-b-p", None, 6, "Zoe", "Rare")]
    assert entities.columns == ["entity_pos", *ENTITY_FIELDS]
    silent = spark.createDataFrame([(1, "Owl", None, "cost", "1", "")], CORRECTIONS)
    with pytest.raises(flatten.FatalInput):
        c.apply_corrections(entities, variants, silent)


def test_decisions(spark, tmp_path):
    file = tmp_path / "decisions.json"
    file.write_text(json.dumps({
        "card_renames": [{"card_id": 4, "new_name": "Owl"}], "new_cards": ["Cat", "Dog"],
        "printing_renames": [{"printing_id": 7, "new_slug": "001-owl-b-p"}], "retire_printings": [8]}))
    read = feed.read_decisions(spark, str(file))
    assert {name: b.rows(df) for name, df in read.items()} == {
        "entity_renames": [(4, "Owl")], "new_entities": [("Cat",), ("Dog",)],
        "variant_renames": [(7, "001-owl-b-p")], "new_variants": [], "retire_variants": [(8,)]}
    assert all(df.isEmpty() for df in feed.no_decisions(spark).values())


def test_old_published_shapes(spark):
    old = spark.createDataFrame([(7, "Owl", "UPDATED text", [3, 4])], "card_id bigint, name string, rules_text string, printing_ids array<bigint>")
    new = spark.createDataFrame([("C000007", "Owl", "text", True)], "codex_id string, name string, rules_text string, errata boolean")
    entities = published.normal_entities(old)
    assert b.rows(entities, "codex_id", "printing_ids", "errata") == [("C000007", ["P000003", "P000004"], True)]
    assert b.rows(published.normal_entities(new), "codex_id", "errata") == [("C000007", True)]
    variants = spark.createDataFrame([(3, 7, "001-owl-b-p", 1, "alpha")], "printing_id bigint, card_id bigint, slug string, card_number int, set_code string")
    normal = published.normal_variants(variants, entities)
    assert b.rows(normal, "printing_id", "codex_id", "set_number", "card_name") == [("P000003", "C000007", "001", "Owl")]
    assert not {"card_id", "card_number", "set_code"} & set(normal.columns)
    assert b.rows(published.normal_variants(normal, entities), *normal.columns) == b.rows(normal)
    history = spark.createDataFrame([("001-owl-b-p", "3")], "slug string, printing_id string")
    assert b.rows(published.normal_key_history(history)) == [("001-owl-b-p", "P000003")]


def test_a_null_in_a_key_pairs_with_a_null(spark):
    from everkey.functions.records import fingerprint

    df = spark.createDataFrame([(1, None, 2), (2, None, 2), (3, "x", 2)], "i int, elements string, cost int")
    wide = df.select("i", *[F.col(f) if f in ("elements", "cost") else F.lit(None).cast("string").alias(f)
                            for f in ENTITY_FIELDS])
    keyed = wide.select("i", fingerprint().alias("k"))
    assert b.rows(keyed.groupBy("k").count(), "count") == [(1,), (2,)]
    assert keyed.join(keyed.withColumnRenamed("i", "j"), "k").count() == 5
