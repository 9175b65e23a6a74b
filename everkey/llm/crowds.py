"""Links within crowds: many sets with a common core, of which most are not similar enough.

A group is a list of sets with a hub, one of them.  Every member is first compared with the hub.  Where that leaves a
group in pieces, members are told by what tells them apart from the group's core, the shingles that more than half of
them hold: D(x) is what stands in x or the core but not in both.  Two sets differ in as much as their D do, so with n(x)
shingles and similarity p/q or more the pair must hold

    |D(x)| + |D(y)| - 2 |D(x) and D(y)| <= (n(x) + n(y)) (q - p) / (q + p)

and if w(x) + w(y) > 0, with w(x) = |D(x)| (q + p) - n(x) (q - p), it must share w(x) + w(y) over 2 (q + p) differences.  A
difference that one member alone has is shared by none.  So every member keeps the rarest of its differences, as many as
it takes for any two that share enough of all to share one of those, and none if no member can share enough with it.
Those that keep the same difference are a group of the next level, with the member nearest to the old core as their hub.
Members that are so near to the core that they are surely similar to the nearest of all are one more.  The core need be
no member's set: a hub's own changes would stand among everybody's differences and hide who can have a partner.

Groups whose members have ``LIST`` partners or fewer in other components are compared pair by pair, and so are those for
which a further level would cost more, and what is left at the last.  Levels change what is compared, never what is found:
no pair within a group that is similar enough stays unlinked.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import grouped
from ..session import written
from .components import components

#: Partners in other components up to which a group's members are compared pair by pair, and the number of levels.
LIST, LEVELS = 32, 3
#: What comparing a pair costs, in rows of differences.
HEAVY = 2.0
#: Bands of w in which the partners of a member are looked for, in quarters of the core's size.
LOW, HIGH = -4, 72


def _placed(groups: DataFrame, place: DataFrame) -> DataFrame:
    """Adds ``_rx`` and ``_rh``, the present components of member and hub."""
    of = lambda c, name: place.select(F.col("_x").alias(c), F.col("_root").alias(name))
    return groups.join(of("_x", "_rx"), "_x").join(of("_hub", "_rh"), "_hub")


def _joined(place: DataFrame, near: DataFrame) -> DataFrame:
    """Components after the links between components (ra, rb)."""
    moved = components(near.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    return written(place.join(moved, place["_root"] == moved["node"], "left").select("_x", F.coalesce("root", "_root").alias("_root")), "crowd-places")


def pieces_of(rows: DataFrame, group: str, root: str) -> DataFrame:
    """Groups that are still in pieces, with ``_n`` members and ``_apart`` pairs of members in different pieces."""
    each = rows.groupBy(group, root).agg(F.count("*").alias("_k"))
    whole = grouped(each, [group], F.sum("_k").alias("_n"), F.sum(F.col("_k") * F.col("_k")).alias("_same"))
    return whole.withColumn("_apart", F.floor((F.col("_n") * F.col("_n") - F.col("_same")) / 2)).where("_apart > 0").drop("_same")


def few() -> Column:
    """Whether a group of ``pieces_of`` is compared pair by pair: its members have ``LIST`` partners or fewer in the mean."""
    return F.col("_apart") * 2 <= F.col("_n") * LIST


def _pairs(groups: DataFrame, fits: Callable[[str, str], Column]) -> DataFrame:
    """The pairs within groups that are in different components and may share enough: ``a, b, ra, rb``."""
    side = lambda c: groups.select("_g", F.col("_x").alias(c), F.col("_size").alias(f"n{c}"), F.col("_rx").alias(f"r{c}"), F.col("_w").alias(f"w{c}"), F.col("_c").alias(f"c{c}"))
    enough = F.coalesce((F.col("wa") <= F.col("cb")) & (F.col("wb") <= F.col("ca")), F.lit(True))
    met = side("a").join(side("b"), "_g").where((F.col("a") > F.col("b")) & (F.col("ra") != F.col("rb")) & fits("na", "nb") & enough)
    return met.select("a", "b", "ra", "rb").distinct()


def cores(groups: DataFrame, held: DataFrame) -> DataFrame:
    """``_g, _core``: the shingles that more than half of a group's members hold."""
    own = held.select(F.col("_print").alias("_x"), F.explode("_set").alias("_e"))
    sizes = grouped(groups, ["_g"], F.count("*").alias("_n"))
    counted = grouped(groups.select("_g", "_x").join(own, "_x"), ["_g", "_e"], F.count("*").alias("_df"))
    # More than half of the members hold at most twice the mean size of their sets, so a core is no longer than texts are.
    common = counted.join(sizes, "_g").where(F.col("_df") * 2 > F.col("_n")).groupBy("_g").agg(F.collect_list("_e").alias("_core"))
    return written(sizes.select("_g").join(common, "_g", "left").select("_g", F.coalesce("_core", F.array().cast("array<long>")).alias("_core")), "crowd-cores")


def differences(groups: DataFrame, held: DataFrame) -> DataFrame:
    """``_g, _x, _size, _rx, _w, _nh, _e`` with a row for each difference of a member; w as in the module's text, for 4/5."""
    own = held.select(F.col("_print").alias("_x"), F.col("_set").alias("_sx"))
    both = groups.join(own, "_x").join(cores(groups, held), "_g")
    apart = F.concat(F.array_except("_sx", "_core"), F.array_except("_core", "_sx"))
    told = both.select("_g", "_x", "_size", "_rx", F.size("_core").cast("long").alias("_nh"), apart.alias("_d"))
    weighed = told.withColumn("_w", F.size("_d").cast("long") * 9 - F.col("_size"))
    return written(weighed.select("_g", "_x", "_size", "_rx", "_w", "_nh", F.explode_outer("_d").alias("_e")), "crowd-differences")


def kept(rows: DataFrame) -> DataFrame:
    """``_g, _x, _size, _rx, _w, _c, _e``: the differences that a member is looked up by, and null for the group of the nearest."""
    common = grouped(rows.where("_e is not null"), ["_g", "_e"], F.count("*").alias("_df")).where("_df > 1")
    told = F.struct("_size", "_rx", "_w", "_nh")
    shared = rows.join(common, ["_g", "_e"]).groupBy("_g", "_x").agg(F.sort_array(F.collect_list(F.struct("_df", "_e"))).alias("_d"))
    every = rows.groupBy("_g", "_x").agg(F.first(told).alias("_t")).select("_g", "_x", "_t.*")
    full = every.join(shared, ["_g", "_x"], "left").withColumn("_s", F.coalesce(F.size("_d"), F.lit(0)).cast("long"))
    full = written(full.withColumn("_s", F.greatest("_s", F.lit(0))).withColumn("_c", F.col("_s") * 18 - F.col("_w")), "crowd-members")
    # A partner y shares enough only if w(x) + w(y) is at most 18 times what either can share.
    band = F.greatest(F.lit(LOW), F.least(F.lit(HIGH), F.floor(F.col("_w") * 4 / F.greatest("_nh", F.lit(1))))).cast("int")
    bands = full.groupBy("_g", band.alias("_band")).agg(F.min("_w").alias("w"), F.max("_c").alias("c"))
    known = grouped(bands, ["_g"], F.collect_list(F.struct("w", "c")).alias("_bands"), F.min("w").alias("_least"))
    asked = full.join(known, "_g")
    partner = F.array_min(F.transform(F.filter("_bands", lambda b: (b["w"] <= F.col("_c")) & (b["c"] >= F.col("_w"))), lambda b: b["w"]))
    # Who has no partner at all is looked up by nothing.
    enough = F.when(partner.isNotNull(), F.greatest(F.lit(1), F.ceil((F.col("_w") + partner) / 18)))
    keys = F.transform(F.slice("_d", F.lit(1), F.greatest(F.lit(0), F.coalesce(F.col("_s") - enough + 1, F.lit(0))).cast("int")), lambda d: d["_e"])
    nearest = F.when(F.col("_w") + F.col("_least") <= 0, F.array(F.lit(None).cast("long"))).otherwise(F.array().cast("array<long>"))
    return asked.select("_g", "_x", "_size", "_rx", "_w", "_c", F.explode(F.concat(F.coalesce(keys, F.array().cast("array<long>")), nearest)).alias("_e"))


def narrower(rows: DataFrame) -> DataFrame:
    """The groups of the next level, ``_g, _hub, _x, _size, _w, _c``: one for each difference, those with the same members once."""
    id = F.xxhash64("_g", F.coalesce("_e", F.lit(0)), F.col("_e").isNull())
    keyed = written(rows.select(id.alias("_g"), "_x", "_size", "_rx", "_w", "_c"), "crowd-keys")
    found = keyed.groupBy("_g").agg(F.min(F.struct("_w", "_x")).alias("_near"), F.count("*").alias("_n"), F.min("_rx").alias("_low"), F.max("_rx").alias("_high"),
                                    F.sum(F.xxhash64("_x").cast("decimal(38,0)")).alias("_sum"), F.bit_xor(F.xxhash64("_x", F.lit(1))).alias("_xor")).where("_low <> _high")
    once = found.groupBy("_n", "_sum", "_xor").agg(F.min(F.struct("_g", "_near")).alias("_m")).select(F.col("_m._g").alias("_g"), F.col("_m._near._x").alias("_hub"))
    # The ids were placed by other columns, so that a large group can be split.
    return written(keyed.join(once, "_g").select("_g", "_hub", "_x", "_size", "_w", "_c"), "crowd-groups")


def linked(groups: DataFrame, place: DataFrame, held: DataFrame, checked: Callable[[DataFrame, DataFrame], DataFrame],
           fits: Callable[[str, str], Column], levels: int = LEVELS, heavy: float = HEAVY) -> tuple[DataFrame | None, list[int]]:
    """Links (a, b) between members of a group that are similar enough, as many as connect what all would, and the number of
    candidates at each level.

    ``groups`` are ``_g, _hub, _x, _size``, hubs among the members; ``place`` the component ``_root`` of every member ``_x``
    so far; ``held`` the sets; ``checked`` keeps the pairs that are similar enough, by their whole sets.
    """
    links, counts = [], []
    # What the level before knows of a member: w, and the most that w of a partner may be.
    groups = groups.select("_g", "_hub", "_x", "_size", F.lit(None).cast("long").alias("_w"), F.lit(None).cast("long").alias("_c"))

    def compared(pairs: DataFrame) -> None:
        nonlocal place
        pairs = written(pairs, "crowd-pairs")
        found = pairs.count()
        counts[-1] += found
        if not found:
            return
        near = written(checked(pairs, held), "crowd-near")
        if not near.isEmpty():
            links.append(near.select("a", "b"))
            place = _joined(place, near)

    for level in range(levels + 1):
        counts.append(0)
        hubs = _placed(groups, place).where("_rx <> _rh")
        compared(hubs.select(F.col("_x").alias("a"), F.col("_hub").alias("b"), F.col("_rx").alias("ra"), F.col("_rh").alias("rb")).distinct())
        tagged = written(_placed(groups, place), "crowd-tagged")
        mixed = written(pieces_of(tagged, "_g", "_rx"), "crowd-mixed")
        last = level == levels
        compared(_pairs(tagged.join(mixed if last else mixed.where(few()), "_g", "left_semi"), fits))
        crowded = mixed.where(~few())
        if last or crowded.isEmpty():
            break
        left = written(_placed(groups.join(crowded, "_g", "left_semi"), place), "crowd-left")
        told = differences(left, held)
        keys = written(kept(told), "crowd-kept")
        # Going on writes every key's differences; a group for which that is more than its pairs is compared now.
        rows = lambda df, name: grouped(df, ["_g"], F.count("*").alias(name))
        cost = crowded.join(rows(told, "_rows"), "_g").join(rows(keys, "_keys"), "_g", "left")
        worth = F.coalesce("_keys", F.lit(0)) * F.col("_rows") / F.col("_n") < F.col("_apart") * heavy
        cost = written(cost.select("_g", worth.alias("_worth")), "crowd-cost")
        compared(_pairs(left.join(cost.where(~F.col("_worth")), "_g", "left_semi"), fits))
        groups = narrower(keys.join(cost.where("_worth"), "_g", "left_semi"))
        if groups.isEmpty():
            break
    return reduce(DataFrame.union, links) if links else None, counts
