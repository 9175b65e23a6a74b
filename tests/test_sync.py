import pathlib

from everkey.plans.sync import populate, sync, validate
from everkey.sources import store
import pytest

import build as b


def first(spark):
    return b.payload(spark, [
        b.entry("Owl", [b.card_set("First", b.piece("001-owl-b-p"), b.piece("001-owl-b-f", finish="Foil"))]),
        b.entry("Cat", [b.card_set("First", b.piece("001-cat-b-p"))]),
    ])


def test_life_of_a_state(spark, tmp_path):
    root = str(tmp_path / "registry")
    run = populate(spark, root, first(spark), b.DAY0, source="test")
    assert (run.version, run.changed, run.has_cases) == (1, True, False)
    state = store.read_state(spark, root, 1)
    assert b.rows(state.entities, "entity_id", "name") == [(1, "Owl"), (2, "Cat")]
    assert b.rows(state.variants, "variant_id", "entity_id", "slug") == [
        (1, 1, "001-owl-b-p"), (2, 1, "001-owl-b-f"), (3, 2, "001-cat-b-p")]

    again = sync(spark, root, first(spark), b.DAY1)
    assert (again.version, again.changed) == (1, False)
    with pytest.raises(ValueError):
        populate(spark, root, first(spark), b.DAY1)

    # Sets renumbered, one entity renamed, one new.
    moved = b.payload(spark, [
        b.entry("Owl", [b.card_set("First", b.piece("101-owl-b-p"), b.piece("101-owl-b-f", finish="Foil"))]),
        b.entry("Tom", [b.card_set("First", b.piece("101-tom-b-p"))], guardian=b.metadata(rulesText="Text of Cat")),
        b.entry("Dog", [b.card_set("First", b.piece("101-dog-b-p"))]),
    ])
    run = sync(spark, root, moved, b.DAY1)
    assert b.rows(run.counts, "class", "changes") == [
        ("entity renames", 1), ("new entities", 1), ("new variants", 1), ("variant renames", 3),
        ("variant updates", 3)]
    state = store.read_state(spark, root, 2)
    assert b.rows(state.entities, "entity_id", "name") == [(1, "Owl"), (2, "Tom"), (3, "Dog")]
    assert b.rows(state.variants, "variant_id", "entity_id", "slug") == [
        (1, 1, "101-owl-b-p"), (2, 1, "101-owl-b-f"), (3, 2, "101-tom-b-p"), (4, 3, "101-dog-b-p")]
    assert ("001-cat-b-p", 3, b.DAY0, b.DAY1) in b.rows(state.key_history)
    assert ("Cat", 2, b.DAY0, b.DAY1) in b.rows(state.name_history)
    assert b.rows(state.counters, "name", "value") == [
        ("next_entity_id", 4), ("next_variant_id", 5), ("schema_version", 6)]

    # Renamed and reworded at once: nothing is guessed, nothing of it applied.
    reworded = b.payload(spark, [
        b.entry("Owl", [b.card_set("First", b.piece("101-owl-b-p"), b.piece("101-owl-b-f", finish="Foil"))]),
        b.entry("Tom", [b.card_set("First", b.piece("101-tom-b-p"))], guardian=b.metadata(rulesText="Text of Cat")),
        b.entry("Wolf", [b.card_set("First", b.piece("101-wolf-b-p"))]),
    ])
    run = sync(spark, root, reworded, b.DAY2)
    assert run.has_cases and not run.changed and run.version == 2
    state = store.read_state(spark, root, run.version)
    assert b.rows(state.entities, "name") == [("Dog",), ("Owl",), ("Tom",)]
    answer = b.decisions(spark, entity_renames=[(3, "Wolf")])
    run = sync(spark, root, reworded, b.DAY2, decisions=answer)
    assert not run.has_cases
    state = store.read_state(spark, root, run.version)
    assert b.rows(state.entities, "entity_id", "name") == [(1, "Owl"), (2, "Tom"), (3, "Wolf")]
    assert sync(spark, root, reworded, b.DAY2).changed is False
    assert b.rows(validate(spark, root, against=1)) == []


def test_a_run_refuses_what_is_not_sound(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from everkey.operators import marts
    from everkey.operators.flatten import FatalInput
    from everkey.plans import sync as run_of

    root = str(tmp_path / "registry")
    populate(spark, root, first(spark), b.DAY0, source="test")
    assert spark.read.parquet(f"{store.folder_of(spark, root, 1)}/payload").count() == 2
    for entry in (first(spark).withColumn("entity_pos", F.lit(1).cast("bigint")), first(spark).withColumn("entity_pos", F.lit(None).cast("bigint"))):
        with pytest.raises(FatalInput, match="ordinal"):
            sync(spark, root, entry, b.DAY1)
    # A section that is not what the state gives stops the commit.
    more = b.payload(spark, [b.entry("Owl", [b.card_set("First", b.piece("001-owl-b-p"), b.piece("001-owl-b-f", finish="Foil"))]),
                             b.entry("Cat", [b.card_set("First", b.piece("001-cat-b-p"), b.piece("001-cat-b-f", finish="Foil"))])])
    good = marts.published_variants
    with monkeypatch.context() as m:
        real = run_of.publish

        def tampered(state, path, source=""):
            with monkeypatch.context() as inner:
                inner.setattr(marts, "published_variants", lambda e, v: good(e, v).withColumn("artist", F.lit("Nobody")))
                real(state, path, source)

        m.setattr(run_of, "publish", tampered)
        with pytest.raises(FatalInput, match="published"):
            sync(spark, root, more, b.DAY1)
    assert store.current_version(spark, root) == 1
    # A lost counter stops the run before it allocates.
    counters = spark.createDataFrame([r for r in store.read_state(spark, root, 1).counters.collect() if r.name != "next_variant_id"], "name string, value bigint")
    real_read = store.read_state
    with monkeypatch.context() as m:
        m.setattr(store, "read_state", lambda *a: type(real_read(*a))(**{**real_read(*a).tables(), "counters": counters}))
        with pytest.raises(FatalInput, match="not sound"):
            sync(spark, root, more, b.DAY1)


def files_of(root):
    return {str(f.relative_to(root)): f.read_bytes() for f in pathlib.Path(root).rglob("*") if f.is_file()}


def test_of_two_runs_from_one_base_the_first_wins(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "registry")
    one = lambda name: b.payload(spark, [b.entry(name, [b.card_set("First", b.piece(f"001-{name.lower()}-b-p"))])])
    for base in range(2):
        # The second run commits while the first is about to.
        commit, seen = store.commit, {}
        with monkeypatch.context() as m:
            def late(*args):
                m.setattr(store, "commit", commit)
                changed = first(spark) if not base else b.payload(spark, [
                    b.entry("Owl", [b.card_set("First", b.piece("001-owl-b-p", artist="New"), b.piece("001-owl-b-f", finish="Foil"))]),
                    b.entry("Cat", [b.card_set("First", b.piece("001-cat-b-p"))])])
                assert sync(spark, root, changed, b.DAY1).version == base + 1
                seen.update(files_of(root))
                commit(*args)

            m.setattr(store, "commit", late)
            with pytest.raises(ValueError, match="another run"):
                sync(spark, root, one("Dog") if not base else b.payload(spark, [
                    b.entry("Owl", [b.card_set("First", b.piece("001-owl-b-p", artist="Old"), b.piece("001-owl-b-f", finish="Foil"))]),
                    b.entry("Cat", [b.card_set("First", b.piece("001-cat-b-p"))])]), b.DAY1)
        assert store.current_version(spark, root) == base + 1
        assert b.rows(store.read_state(spark, root, base + 1).entities, "name") == [("Cat",), ("Owl",)]
        # Nothing of the winner's files has changed.
        now = files_of(root)
        assert all(now[name] == data for name, data in seen.items())
    assert b.rows(store.read_state(spark, root, 2).variants.where("slug = '001-owl-b-p'"), "artist") == [("New",)]
    assert b.rows(validate(spark, root, against=1)) == []
    # A commit whose writer died is no version, and its number is not used again.
    (tmp_path / "registry" / "commits" / "3").write_text("")
    assert store.current_version(spark, root) == 2 and store.next_version(spark, root) == 4
    assert not store.create(spark, f"{root}/commits/3", "x")


def test_only_buckets_with_a_change_are_written(spark, tmp_path):
    root = str(tmp_path / "registry")
    pieces = lambda moved: b.payload(spark, [b.entry("Owl", [b.card_set("First", *[b.piece(f"001-owl{i}-b-p" if i != moved else f"101-owl{i}-b-p", finish=f"F{i}") for i in range(40)])])])
    populate(spark, root, pieces(None), b.DAY0, buckets=8)
    before = store.commits(spark, root)[1]
    run = sync(spark, root, pieces(7), b.DAY1, buckets=99)
    assert ("variant renames", 1) in b.rows(run.counts, "class", "changes")
    after = store.commits(spark, root)[2]
    id = store.read_state(spark, root, 2).variants.where("slug = '101-owl7-b-p'").first()["variant_id"]
    hit = {str(n) for n in store.buckets_of(spark.createDataFrame([(id,)], "variant_id long"), "variant_id", 8)}
    assert after.buckets == before.buckets == 8 and len(before.parts["variants"]) > 4
    for table in ("variants", "key_history"):
        assert {n for n, folder in after.parts[table].items() if folder == after.folder} == hit
        assert {n: f for n, f in after.parts[table].items() if n not in hit} == {n: f for n, f in before.parts[table].items() if n not in hit}
    assert (after.parts["entities"], after.parts["name_history"]) == (before.parts["entities"], before.parts["name_history"])
    written = {name.split("/")[2] for name in files_of(root) if name.startswith(after.folder + "/") and name.endswith(".parquet")}
    assert "entities" not in written and "name_history_closed" not in written
    # Closed history is added to, never written again.
    assert (before.closed["key_history"], after.closed["key_history"]) == ([], [after.folder])
    sync(spark, root, pieces(8), b.DAY2)
    last = store.commits(spark, root)[3]
    assert last.closed["key_history"] == [after.folder, last.folder]
    history = b.rows(store.read_state(spark, root, 3).key_history.where(f"variant_id = {id}"), "slug", "valid_from", "valid_to")
    assert history == [("001-owl7-b-p", b.DAY0, b.DAY1), ("001-owl7-b-p", b.DAY2, None), ("101-owl7-b-p", b.DAY1, b.DAY2)]
    assert b.rows(validate(spark, root, against=2)) == []


def test_stale_cases_go(spark, tmp_path):
    root = str(tmp_path / "registry")
    populate(spark, root, first(spark), b.DAY0)
    reworded = b.payload(spark, [b.entry("Owl", [b.card_set("First", b.piece("001-owl-b-p"), b.piece("001-owl-b-f", finish="Foil"))]),
                                 b.entry("Wolf", [b.card_set("First", b.piece("001-wolf-b-p"))])])
    assert sync(spark, root, reworded, b.DAY1, dry_run=True).has_cases
    assert spark.read.parquet(f"{root}/runs/base=1/entity_cases").count() > 0
    assert not sync(spark, root, first(spark), b.DAY1).has_cases
    assert spark.read.parquet(f"{root}/runs/base=1/entity_cases").count() == 0
