"""Classification, many independent situations per run to keep runs few."""

import pytest

from everkey.operators import entity_diff as ed, variant_diff as vd
from everkey.operators.apply import apply_plan
from everkey.operators.flatten import FatalInput
from everkey.plans.sync import classify
import build as b


def exploded(updates, *keys):
    return sorted((*[r[k] for k in keys], c.field, c.old, c.new) for r in updates.collect() for c in r.changes)


def test_entities_of_every_class(spark):
    same = dict(rules_text="Flying", elements=None, life=None)
    state = b.state(spark, [
        b.entity("Kept"), b.entity("Dearer", cost=2, life=None), b.entity("Was"),
        b.entity("Twin A", **same), b.entity("Twin B", **same), b.entity("Asked", rules_text="Asked for"),
    ], [])
    entities, variants = b.snapshot(spark, [
        b.entity("Kept"), b.entity("Dearer", cost=3, life=20),
        b.entity("Is", rules_text="Text of Was", rarity="Rare", subtypes="Bird"),   # neither is part of the fingerprint
        b.entity("Twin C", **same), b.entity("Twin D", **same),
        b.entity("Answered", rules_text="Quite another"), b.entity("Forced"),
    ], [])
    answers = b.decisions(spark, entity_renames=[(6, "Answered")], new_entities=[("Forced",)])
    plan = ed.classify_entities(state.entities, entities, answers)
    assert b.rows(ed.entity_renames(plan)) == [(3, "Was", "Is", "fingerprint"), (6, "Asked", "Answered", "human")]
    assert b.rows(ed.new_entities(plan), "name") == [("Forced",)]
    assert b.rows(ed.gone_entities(plan)) == []
    assert b.rows(ed.entity_cases(plan), "n_missing", "n_candidates", "problem") == [(2, 2, ed.SHARED_FINGERPRINT)]
    assert b.rows(ed.cased_names(plan)) == [("Twin A",), ("Twin B",), ("Twin C",), ("Twin D",)]
    assert exploded(ed.entity_updates(plan), "entity_id") == sorted([
        (2, "cost", "2", "3"), (2, "life", None, "20"), (3, "rarity", "Common", "Rare"), (3, "subtypes", None, "Bird"),
        (6, "rules_text", "Asked for", "Quite another")], key=lambda t: t[:2])


def test_unexplained_entities_fail_closed(spark):
    state = b.state(spark, [b.entity("Kept"), b.entity("Gone"), b.entity("Was")], [])
    newcomer, renamed = b.entity("Newcomer"), b.entity("Is", rules_text="Text of Was")

    def plan(*entities):
        return ed.classify_entities(state.entities, b.snapshot(spark, [b.entity("Kept"), renamed, *entities], [])[0])

    both = plan(newcomer)
    assert b.rows(ed.entity_cases(both), "case_id", "n_missing", "n_candidates") == [(ed.UNEXPLAINED_CASE, 1, 1)]
    assert b.rows(ed.entity_case_members(both), "side", "name") == [("added", "Newcomer"), ("missing", "Gone")]
    assert b.rows(ed.new_entities(both)) == []
    assert b.rows(ed.entity_renames(both), "new_name") == [("Is",)]
    vanished = plan()
    assert b.rows(ed.entity_cases(vanished)) == [] and b.rows(ed.gone_entities(vanished)) == [(2, "Gone")]
    appeared = plan(b.entity("Gone"), newcomer)
    assert b.rows(ed.entity_cases(appeared)) == [] and b.rows(ed.new_entities(appeared), "name") == [("Newcomer",)]


@pytest.mark.parametrize("lists", [
    dict(entity_renames=[(1, "New")]),                    # still there
    dict(entity_renames=[(2, "Kept")]),                   # not a newcomer
    dict(entity_renames=[(9, "New")]),                    # unknown id
    dict(entity_renames=[(2, "New"), (2, "Newer")]),      # one entity twice
    dict(entity_renames=[(2, "New"), (3, "New")]),        # one name twice
    dict(entity_renames=[(2, "New")], new_entities=[("New",)]),
    dict(new_entities=[("Kept",)]),
], ids=lambda lists: str(lists))
def test_entity_decisions_must_fit(spark, lists):
    state = b.state(spark, [b.entity("Kept"), b.entity("Old"), b.entity("Older")], [])
    entities, _ = b.snapshot(spark, [b.entity("Kept"), b.entity("New"), b.entity("Newer")], [])
    rows = ed.one_sided(ed.differences(state.entities, entities))
    assert ed.stale_entity_decisions(rows, b.decisions(spark, **lists)).count() > 0


def test_variants_of_every_class(spark):
    v = b.variant
    names = ["Owl", "Swap", "Mix", "Old", "Giver", "Taker", "Back", "Quiet", "Loop", "Asked"]
    state = b.state(spark, [b.entity(n) for n in names], [
        v("001-owl-b-p", "Owl"),                                                   # 1: renumbered
        v("001-swap-b-p", "Swap", finish="Plain"), v("001-swap-b-f", "Swap", finish="Foil"),  # 2, 3: keys exchanged
        v("001-mix-b-p", "Mix"), v("001-mix-d-p", "Mix", product="Deck"),          # 4, 5: do not pair
        v("001-old-b-p", "Old"), v("001-old-b-f", "Old", finish="Foil"),           # 6, 7: entity renamed; one vanishes
        v("001-giver-b-p", "Giver"),                                               # 8: key taken over
        v("001-taker-b-p", "Taker"),                                               # 9
        v("001-back-b-p", "Back", retired_at=b.DAY0),                              # 10: comes back, changed
        v("001-quiet-b-p", "Quiet", retired_at=b.DAY0),                            # 11: stays away
        v("002-loop-b-p", "Loop"),                                                 # 12: returns to its own former key
        v("001-asked-b-p", "Asked", set_name="First"),                             # 13: reviewed: renamed over sets
        v("001-asked-b-f", "Asked", finish="Foil"),                                # 14: reviewed: retired
    ], history=[("001-loop-b-p", 12, "2024-01-01", b.DAY0), ("001-owl-x-p", 2, "2024-01-01", b.DAY0),
                ("009-taker-b-p", 3, "2024-01-01", b.DAY0)])
    entities = [b.entity(n) for n in names if n != "Old"] + [b.entity("New", rules_text="Text of Old")]
    snap = b.snapshot(spark, entities, [
        v("101-owl-b-p", "Owl", artist="Ann"),
        v("001-swap-b-p", "Swap", finish="Foil"), v("001-swap-b-f", "Swap", finish="Plain"),
        v("101-mix-b-p", "Mix", finish="Matt"), v("101-mix-d-p", "Mix", product="Deck", finish="Matt"),
        v("101-new-b-p", "New"),
        v("001-giver-b-p", "Taker", set_name="Second"),
        v("001-taker-b-p", "Taker"), v("009-taker-b-p", "Taker", product="Tin"),   # owned by 3
        v("001-back-b-p", "Back", artist="Bob"),
        v("001-loop-b-p", "Loop"),
        v("002-asked-b-p", "Asked", set_name="Second"), v("003-asked-b-p", "Asked", set_name="Third"),
    ])
    answers = b.decisions(spark, variant_renames=[(13, "002-asked-b-p")], retire_variants=[(14,)],
                          new_variants=[("003-asked-b-p",)])
    entity_plan, plan = classify(state, *snap, answers)
    assert b.rows(vd.variant_renames(plan), "variant_id", "new_slug", "decided_by") == sorted([
        (1, "101-owl-b-p", vd.PAIRED_BY), (6, "101-new-b-p", vd.PAIRED_BY), (12, "001-loop-b-p", vd.PAIRED_BY),
        (13, "002-asked-b-p", "human")], key=lambda t: str(t[0]))
    assert b.rows(vd.retirements(plan)) == [(14, "001-asked-b-f", "human"), (7, "001-old-b-f", "no candidate")]
    assert b.rows(vd.unretirements(plan)) == [(10, "001-back-b-p")]
    assert b.rows(vd.new_variants(plan), "slug") == [("003-asked-b-p",)]
    assert b.rows(vd.taken_over(plan)) == [(8, "001-giver-b-p", "Giver", "Taker")]
    assert b.rows(vd.ownership_vetoes(plan)) == [("009-taker-b-p", 3, None)]
    assert b.rows(vd.variant_cases(plan), "case_id", "n_missing", "n_candidates") == [
        ("variant:Mix", 2, 2), ("variant:key:001-giver-b-p", 1, 1), ("variant:owner:009-taker-b-p", 0, 0)]
    assert exploded(vd.variant_updates(plan), "variant_id") == sorted([
        (1, "artist", None, "Ann"), (2, "finish", "Plain", "Foil"), (3, "finish", "Foil", "Plain"),
        (10, "artist", None, "Bob"), (1, "set_number", "001", "101"), (6, "set_number", "001", "101"),
        (12, "set_number", "002", "001"), (13, "set_number", "001", "002"), (13, "set_name", "First", "Second")],
        key=lambda t: t[:2])

    after = apply_plan(state, entity_plan, plan, b.DAY1)
    stored = {r.variant_id: r for r in after.variants.collect()}
    assert len(stored) == 15 and stored[15].slug == "003-asked-b-p"
    assert (stored[10].retired_at, stored[11].retired_at, stored[14].retired_at) == (None, b.DAY0, b.DAY1)
    assert stored[4].slug == "001-mix-b-p" and stored[4].retired_at is None
    assert stored[6].entity_id == 4 and stored[8].entity_id == 5
    # With the cases answered or gone, a second run finds nothing more to do.
    again_entities, again = classify(after, *snap)
    assert b.rows(vd.variant_renames(again)) == [] and b.rows(vd.retirements(again)) == []
    assert b.rows(vd.new_variants(again)) == [] and b.rows(vd.variant_updates(again)) == []


def test_a_case_holds_back_its_variants_and_ownership_stops_renames(spark):
    v = b.variant
    state = b.state(spark, [b.entity("Kept"), b.entity("Gone"), b.entity("Thief")], [
        v("001-gone-b-p", "Gone"), v("001-stays-b-p", "Gone"), v("001-kept-b-p", "Kept"), v("001-thief-b-p", "Thief")],
        history=[("101-thief-b-p", 3, "2024-01-01", b.DAY0)])
    snap = b.snapshot(spark, [b.entity("Kept"), b.entity("Thief"), b.entity("Stranger")], [
        v("001-stranger-b-p", "Stranger"), v("001-stays-b-p", "Stranger"), v("001-kept-b-p", "Kept"),
        v("101-thief-b-p", "Thief", artist="Eve")])
    _, plan = classify(state, *snap)
    # The vanished and the new variant wait with their entities; the kept key is a case of its own.
    assert b.rows(vd.retirements(plan)) == [] and b.rows(vd.new_variants(plan)) == []
    assert b.rows(vd.variant_renames(plan)) == [] and b.rows(vd.variant_updates(plan)) == []
    assert b.rows(vd.ownership_vetoes(plan)) == [("101-thief-b-p", 3, 4)]
    assert b.rows(vd.variant_cases(plan), "case_id") == [("variant:key:001-stays-b-p",), ("variant:owner:101-thief-b-p",)]

    forced = b.state(spark, [b.entity("Kept")], [v("001-kept-b-p", "Kept")], history=[("002-kept-b-p", 9, "2024-01-01", b.DAY0)])
    snap = b.snapshot(spark, [b.entity("Kept")], [v("001-kept-b-p", "Kept"), v("002-kept-b-p", "Kept", product="Tin")])
    with pytest.raises(FatalInput):
        classify(forced, *snap, b.decisions(spark, new_variants=[("002-kept-b-p",)]))


@pytest.mark.parametrize("lists", [
    dict(variant_renames=[(2, "101-x-b-p")]),                       # not missing
    dict(variant_renames=[(1, "001-y-b-p")]),                       # not new
    dict(variant_renames=[(1, "101-x-b-p")], retire_variants=[(1,)]),
    dict(variant_renames=[(1, "101-x-b-p")], new_variants=[("101-x-b-p",)]),
    dict(retire_variants=[(2,)]), dict(new_variants=[("001-y-b-p",)]),
], ids=lambda lists: str(lists))
def test_variant_decisions_must_fit(spark, lists):
    v = b.variant
    state = b.state(spark, [b.entity("X"), b.entity("Y")], [v("001-x-b-p", "X"), v("001-y-b-p", "Y")])
    entities, variants = b.snapshot(spark, [b.entity("X"), b.entity("Y")], [v("101-x-b-p", "X"), v("001-y-b-p", "Y")])
    plan = ed.classify_entities(state.entities, entities)
    rows = vd.one_sided(vd.differences(state.variants, vd.entity_view(state.entities, plan), variants), plan)
    assert vd.stale_variant_decisions(rows, b.decisions(spark, **lists)).count() > 0


def test_groups_hold_their_rows_while_they_are_few(spark):
    """Every size of group, repeats and nulls, against plain counting."""
    sizes = [(m, a) for m in range(5) for a in range(5) if m or a]
    rows = []
    for m, a in sizes:
        for name in (f"one {m} {a}", "all"):
            key = (name, f"set {m} {a}", None, "Foil")
            rows += [("missing", 100 * m + 10 * a + k, f"{name} m{k}", *key) for k in range(m)]
            rows += [("added", None, f"{name} {m} a{k // 2}", *key) for k in range(a)]      # the second twice, and so on
    rows += [("missing", 7, None, "null", None, None, None), ("added", None, "x", None, None, None, None)]
    df = spark.createDataFrame(rows, "side string, variant_id bigint, slug string, entity_name string, set_name string, product string, finish string")
    found = vd._paired(df)

    groups, left = {}, {}
    for r in rows:
        groups.setdefault(r[3:], []).append(r)
    unique = {k for k, g in groups.items() if sorted(r[0] for r in g) == ["added", "missing"]}
    for k, g in groups.items():
        if k not in unique and k[0] is not None:
            left.setdefault(k[0], set()).update(r[0] for r in g)
    wanted = []
    for r in rows:
        one, case = r[3:] in unique, len(left.get(r[3], ())) == 2
        other = next((x for x in groups[r[3:]] if x[0] != r[0]), None) if one else None
        wanted.append((r[0], r[2], *r[3:], (r[1] or other[1]) if one else r[1], other[2] if one else None,
                       "rename" if one else "case" if case else "retire" if r[0] == "missing" else "new",
                       vd.PAIRED_BY if one else "no candidate" if not case and r[0] == "missing" else None,
                       f"variant:{r[3]}" if case and not one else None))
    columns = ["side", "slug", "entity_name", "set_name", "product", "finish", "variant_id", "partner", "outcome", "decided_by", "case_id"]
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(str, wanted))


def test_variants_meet_by_key_as_few_columns(spark):
    """What is only compared crosses the join as one text."""
    state = b.state(spark, [b.entity("X")], [b.variant("001-x-b-p", "X", artist="Ann"), b.variant("001-y-b-p", "X")])
    entities, variants = b.snapshot(spark, [b.entity("X")], [b.variant("001-x-b-p", "X", artist="Bob"), b.variant("001-z-b-p", "X")])
    plan = ed.classify_entities(state.entities, entities)
    found = vd.differences(state.variants, vd.entity_view(state.entities, plan), variants)
    tree = found._jdf.queryExecution().optimizedPlan()
    while "Join" not in tree.nodeName():
        tree = tree.children().head()
    assert tree.output().size() <= 20
    rows = {r.slug: r for r in found.collect()}
    assert {k: r.status for k, r in rows.items()} == {"001-x-b-p": "changed", "001-y-b-p": "missing", "001-z-b-p": "added"}
    assert (rows["001-x-b-p"].old.artist, rows["001-x-b-p"].new.artist, rows["001-y-b-p"].new, rows["001-z-b-p"].old) == ("Ann", "Bob", None, None)
    assert rows["001-z-b-p"].new.asDict() == variants.where("slug = '001-z-b-p'").first().asDict()
