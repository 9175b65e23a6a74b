"""Near copies by MinHash bands and an exact check.

A text is the set of its shingles of ``SHINGLE`` words; two texts are near copies if at least ``SHARED`` of all their
shingles stand in both.  Texts with one set are one class.  The classes' MinHash values are dealt into ``BANDS`` bands of
``ROWS``; two sets with similarity s share a band with probability 1 - (1 - s ** ROWS) ** BANDS, 0.99993 at 0.8.  Sharing
a band only makes two classes meet: every link is checked on the whole sets.

Each class first meets the smallest class in each of its bands.  Bands whose classes are connected by then are done.
Of the others, those with few pairs in different components are compared pair by pair.  The rest are crowds: texts from one template that share a band
and are no copies.  ``crowds`` finds the links in those by what tells the texts apart, without comparing all pairs; no
pair that shares a band is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import grouped
from ..session import written
from . import crowds
from .batches import batch, pieces
from .components import components
from .shipping import ship

SHINGLE = 5
#: Similarity from which two texts are near copies, as a fraction.
SHARED = (4, 5)
BANDS, ROWS = 24, 5
SEED = 42
#: Shingles whose MinHash values are taken at a time.
SLICE = 1 << 12
_MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a text with fewer words is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(words))
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), "<u8", len(words) - width + 1))


def bands(own: np.ndarray) -> np.ndarray:
    """One hash for each band of a set's MinHash values."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    mixed = own ^ (own >> np.uint64(29))
    for at in range(0, len(mixed), SLICE):
        np.minimum(least, (mixed[None, at: at + SLICE] * _MULTIPLIERS).min(axis=1), out=least)
    raw = least.astype("<u8").tobytes()
    return np.array([xxhash.xxh64_intdigest(raw[8 * ROWS * k: 8 * ROWS * (k + 1)], k) for k in range(BANDS)], dtype="<u8").view("<i8")


def sketches(rows: DataFrame) -> DataFrame:
    """``_none, _id, _tie, _print, _size, _bands`` for each row; the print is a hash of the whole set."""
    ship(rows.sparkSession)
    schema = pa.schema([("_none", pa.bool_()), ("_id", pa.int64()), ("_tie", pa.int64()), ("_print", pa.int64()), ("_size", pa.int32()), ("_bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            prints, sizes, all_bands = [], [], []
            for text in piece.column(3).to_pylist():
                own = shingles(text)
                prints.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                sizes.append(len(own))
                all_bands.append(bands(own) if len(own) else [])
            yield batch(schema, *piece.columns[:3], np.array(prints, dtype="<u8").view("<i8"), sizes, all_bands)

    return rows.select("_none", "_id", "_tie", "text").mapInArrow(run, "_none boolean, _id long, _tie long, _print long, _size int, _bands array<long>")


def sets(rows: DataFrame) -> DataFrame:
    """``_print, _set`` of ``_print, text``."""
    ship(rows.sparkSession)
    schema = pa.schema([("_print", pa.int64()), ("_set", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 64):
            yield batch(schema, piece.column(0), [shingles(t).view("<i8") for t in piece.column(1).to_pylist()])

    return rows.select("_print", "text").mapInArrow(run, "_print long, _set array<long>")


def _fits(a: str, b: str) -> Column:
    """Sets of these sizes can be similar enough."""
    part, whole = SHARED
    return F.least(a, b) * whole >= F.greatest(a, b) * part


def _checked(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are near copies, with all their columns."""
    part, whole = SHARED
    with_a = pairs.join(held.select(F.col("_print").alias("a"), F.col("_set").alias("sa")), "a")
    with_both = with_a.join(held.select(F.col("_print").alias("b"), F.col("_set").alias("sb")), "b")
    common = with_both.select(*pairs.columns, (F.size("sa") + F.size("sb")).cast("long").alias("n"), F.size(F.array_intersect("sa", "sb")).cast("long").alias("both"))
    return common.where(F.col("both") * whole >= (F.col("n") - F.col("both")) * part).select(*pairs.columns)


def _texts(keyed: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``_print, _set`` of the classes in the pairs."""
    wanted = pairs.select(F.col("a").alias("_print")).union(pairs.select(F.col("b").alias("_print"))).distinct()
    firsts = classes.join(wanted, "_print", "left_semi").select("_print", "_first._none", "_first._id", "_first._tie")
    found = keyed.join(firsts.hint("merge"), ["_none", "_id", "_tie"]).select("_print", F.col("_row.text").alias("text"))
    # Repeated rows have one text.
    return written(sets(found.groupBy("_print").agg(F.first("text").alias("text"))), "copies-sets")


def keyed_rows(documents: DataFrame) -> DataFrame:
    id = F.col("doc_id").cast("long")
    return documents.select(F.struct(*[F.col(c) for c in documents.columns]).alias("_row"), id.isNull().alias("_none"), F.coalesce(id, F.lit(0)).alias("_id"),
                            F.xxhash64(F.coalesce("text", F.lit(""))).alias("_tie"))


#: The name that tests know.
_keyed = keyed_rows


def stay_of(keyed: DataFrame, named: DataFrame, columns: list[str], label: str) -> DataFrame:
    """The first row of each root in ``named`` (``_first, _root``), found again by id and hash of the text."""
    stay = written(named.groupBy("_root").agg(F.min("_first").alias("_first")).select("_first._none", "_first._id", "_first._tie"), label)
    kept = keyed.join(stay.hint("merge"), ["_none", "_id", "_tie"], "left_semi")
    rows = kept.groupBy("_none", "_id", "_tie").agg(F.first("_row").alias("_row"))
    return rows.select(*[F.col("_row")[c].alias(c) for c in columns])


def crowded(star: DataFrame, roots: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups for ``crowds`` of classes ``a`` and the least ``b`` of a band they share, and where their members are.

    All that share a band with the same least class are one group; where that one shares a band with a lesser still, both
    groups are one, so a crowd that meets in many bands is hardly more than a single group.
    """
    hubs = star.select(F.col("b").alias("a")).distinct()
    lesser = grouped(star.join(hubs, "a", "left_semi"), ["a"], F.min("b").alias("lesser")).select(F.col("a").alias("b"), "lesser")
    hub = F.coalesce("lesser", "b")
    named = star.join(lesser, "b", "left").select(hub.alias("_hub"), F.explode(F.array("a", "b", hub)).alias("_x")).distinct()
    groups = written(named.join(sizes, "_x").select(F.col("_hub").alias("_g"), "_hub", "_x", "_size"), "copies-groups")
    members = groups.select("_x").distinct().join(roots, F.col("_x") == F.col("node"), "left")
    return groups, written(members.select("_x", F.coalesce("root", "_x").alias("_root")), "copies-members")


def links(keyed: DataFrame, classes: DataFrame) -> tuple[DataFrame, list[int]]:
    """Links (a, b) between classes: near copies all, and as many as connect the same classes as all would; and how many
    pairs were compared: with the least of a band, in small bands, and at each level of ``crowds``."""
    met = written(classes.select("_print", "_size", F.explode("_bands").alias("band")), "copies-bands")
    least = grouped(met, ["band"], F.min(F.struct("_print", "_size")).alias("least"), F.max("_print").alias("most")).where("least._print <> most")
    star = met.join(least.select("band", F.col("least._print").alias("b"), F.col("least._size").alias("nb")), "band")
    star = written(star.where(F.col("_print") != F.col("b")).select(F.col("_print").alias("a"), "b", _fits("_size", "nb").alias("fits")).distinct(), "copies-star")
    held = _texts(keyed, classes, star)
    near = written(_checked(star.where("fits").select("a", "b"), held), "copies-near")
    roots = components(near)
    shared = met.join(least.select("band", F.col("least._print").alias("b")), "band").join(roots, F.col("_print") == F.col("node"), "left")
    placed = written(shared.select("band", "b", "_print", "_size", F.coalesce("root", "_print").alias("_root")), "copies-placed")
    mixed = written(crowds.pieces_of(placed, "band", "_root"), "copies-mixed")

    left = written(placed.join(mixed.where(crowds.few()), "band"), "copies-left")
    side = lambda c: left.select("band", F.col("_print").alias(c), F.col("_size").alias(f"n{c}"), F.col("_root").alias(f"r{c}"))
    few = side("a").join(side("b"), "band").where((F.col("a") > F.col("b")) & (F.col("ra") != F.col("rb")) & _fits("na", "nb")).select("a", "b").distinct()
    few = written(few.join(star, ["a", "b"], "left_anti"), "copies-pairs")
    near = near.union(_checked(few, held))
    compared = [star.where("fits").count(), few.count()]

    many = written(placed.join(mixed.where(~crowds.few()), "band", "left_semi").where(F.col("_print") != F.col("b")).select(F.col("_print").alias("a"), "b").distinct(), "copies-crowds")
    if many.isEmpty():
        return near, compared
    groups, place = crowded(many, roots, classes.select(F.col("_print").alias("_x"), F.col("_size").cast("long").alias("_size")))
    more, counts = crowds.linked(groups, place, held, _checked, _fits)
    return near if more is None else near.union(more), compared + counts


def one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay: one of each component of near copies.

    It is the row with the smallest id, rows without id behind all others, then the one whose text hashes lowest.  Texts
    without words are copies of each other, null and empty ones among them.  Rows with one id are told apart by their texts;
    repeated rows are one.  Texts of any length are compared whole; an empty table gives no rows; other columns stay.
    """
    keyed = keyed_rows(documents)
    every = written(sketches(keyed.select("_none", "_id", "_tie", F.col("_row.text").alias("text"))), "copies-sketches")
    classes = written(every.groupBy("_print").agg(F.min(F.struct("_none", "_id", "_tie")).alias("_first"), F.first("_size").alias("_size"), F.first("_bands").alias("_bands")), "copies-classes")
    roots = components(links(keyed, classes)[0])
    named = classes.select("_print", "_first").join(roots, F.col("_print") == F.col("node"), "left").select("_first", F.coalesce("root", "_print").alias("_root"))
    return stay_of(keyed, named, documents.columns, "copies-stay")
