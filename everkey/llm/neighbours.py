"""Approximate nearest neighbours by a forest of random-projection trees.

Equal vectors are one class with its smallest ids.  The trees are fitted on a bounded sample: a node splits its points
half way between two of them.  Every class is then sent down every tree, and each leaf of each tree is a cell of the
index.  A query walks all trees at once with one priority queue, always from the node for which it has crossed the least
(the sum of squared distances to the splits it is on the wrong side of), until it has been in every tree and the leaves it
has reached hold ``SHARE`` of as many classes as there are, and ``REACH`` at least.  Queries and classes meet by cell; distances are exact, in
double precision, and a query's best from all cells are merged.

The forest is what executors are sent: ``TREES * SAMPLE / SMALL`` nodes at most.  A cell with many rows is dealt into
several, so a group stays within memory.  Vectors without any structure need the same share of them looked at for the same
recall at any size, so work per query grows with the table.  A leaf is then a share of the table as well, and a query comes
to the same number of leaves at any size; more leaves would only mean more probes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written
from .batches import batch, pieces
from .shipping import ship

NEAREST = 10
TREES = 16
#: Vectors the trees are fitted on; a node with at most ``SMALL`` of them is a leaf.
SAMPLE, SMALL = 1 << 15, 128
#: Classes in the leaves that a query reaches: a share of all (a class counts in each tree), and so many at least.
SHARE, REACH = 0.5, 24_000
#: Rows of a cell that meet in one group.
CELL = 1 << 15
SEED = 11


@dataclass
class Tree:
    """Nodes by number; ``left`` is negative at a leaf, whose number is -left - 1."""
    normals: np.ndarray
    offsets: np.ndarray
    left: np.ndarray
    right: np.ndarray


def grow(points: np.ndarray, rng: np.random.Generator, small: int = SMALL) -> Tree:
    normals, offsets, left, right = [], [], [], []
    leaves = 0
    todo = [(np.arange(len(points)), -1, False)]
    while todo:
        own, parent, is_right = todo.pop()
        me, sides = len(left), None
        if len(own) > small:
            for _ in range(3):
                a, b = points[rng.choice(own, 2, replace=False)].astype(np.float64)
                normal = a - b
                length = np.linalg.norm(normal)
                if length > 0:
                    normal /= length
                    offset = -float(normal @ (a + b) / 2)
                    above = points[own] @ normal + offset > 0
                    if 0.05 < above.mean() < 0.95:
                        sides = (own[~above], own[above])
                        break
            if sides is None:
                # No pair divides them well: halve them along the direction in which they spread most among a few.
                tries = rng.standard_normal((8, points.shape[1]))
                tries /= np.linalg.norm(tries, axis=1)[:, None]
                spread = points[own] @ tries.T
                best = int(spread.std(axis=0).argmax())
                normal, offset = tries[best], -float(np.median(spread[:, best]))
                above = spread[:, best] + offset > 0
                if above.any() and not above.all():
                    sides = (own[~above], own[above])
        if parent >= 0:
            (right if is_right else left)[parent] = me
        if sides is None:
            normals.append(np.zeros(points.shape[1])), offsets.append(0.0), left.append(-leaves - 1), right.append(-leaves - 1)
            leaves += 1
        else:
            normals.append(normal), offsets.append(offset), left.append(0), right.append(0)
            todo += [(sides[0], me, False), (sides[1], me, True)]
    return Tree(np.array(normals, np.float32), np.array(offsets), np.array(left), np.array(right))


def plant(points: np.ndarray, trees: int = TREES, small: int = SMALL, seed: int = SEED) -> list[Tree]:
    return [grow(points, np.random.default_rng([seed, t]), small) for t in range(trees)]


def leaves_of(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    at = np.zeros(len(vectors), np.int64)
    while True:
        open_ = np.flatnonzero(tree.left[at] >= 0)
        if not len(open_):
            return -tree.left[at] - 1
        node = at[open_]
        margin = np.einsum("ij,ij->i", vectors[open_], tree.normals[node].astype(np.float64)) + tree.offsets[node]
        at[open_] = np.where(margin > 0, tree.right[node], tree.left[node])


def needed(classes: int) -> int:
    """Classes that a query has to reach among so many."""
    return max(REACH, ceil(SHARE * classes))


def reached(forest: list[Tree], held: list[np.ndarray], query: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in the order in which one queue over all trees comes to them."""
    queue = [(0.0, t, 0) for t in range(len(forest))]
    out, got = [], 0
    # Nothing is crossed on the way to a tree's first leaf: each tree is entered, whatever the reach.
    while queue and (got < reach or queue[0][0] == 0.0):
        crossed, t, node = heapq.heappop(queue)
        tree = forest[t]
        while tree.left[node] >= 0:
            margin = float(tree.normals[node] @ query) + tree.offsets[node]
            near, far = (tree.right[node], tree.left[node]) if margin > 0 else (tree.left[node], tree.right[node])
            heapq.heappush(queue, (crossed + margin * margin, t, int(far)))
            node = int(near)
        leaf = int(-tree.left[node] - 1)
        if held[t][leaf]:
            out.append((t, leaf))
            got += int(held[t][leaf])
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``_id, _vector`` of the vectors that take part: of the most common length (ties: the longer), without null or
    non-finite components, not zero, with an id."""
    v = F.col("_vector")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id).cast("long").alias("_id"), F.col(vector).alias("_vector")).where(F.col("_id").isNotNull() & v.isNotNull() & whole)
    common = rows.groupBy(F.size("_vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return rows.where(F.size("_vector") == F.lit(common["n"] if common else 0))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """Equal vectors once: ``_class`` (smallest id), ``_members`` (the ``keep`` smallest ids), ``_vector``."""
    rank = F.dense_rank().over(Window.partitionBy("_vector").orderBy("_id"))
    few = rows.withColumn("_rank", rank).where(F.col("_rank") <= keep)
    return few.groupBy("_vector").agg(F.array_sort(F.collect_set("_id")).alias("_members")).select(F.element_at("_members", 1).alias("_class"), "_members", "_vector")


def search(vectors: DataFrame, wanted: Column, nearest: int = NEAREST, reach: int | None = None, trees: int = TREES, sample: int = SAMPLE, small: int = SMALL,
           cell: int = CELL, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``wanted`` picks its nearest other rows, by Euclidean distance.

    Ties go to the smaller id; a query finds fewer only if there are fewer.  Vectors that are null, zero, of an odd length or
    hold null or non-finite components take no part, nor do rows without id.  Equal rows count once, and rows that share
    the query's id are the query's own.  Without ``reach`` it is what the number of classes calls for.  An empty table gives no rows; other columns are not touched.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = written(usable(vectors, id, vector), "ann-rows")
    index = written(classes(rows, nearest + 1), "ann-classes")
    chosen = index.orderBy(F.xxhash64("_class"), "_class").limit(sample).select("_vector").toArrow()
    points = matrix(chosen.column(0).combine_chunks())
    forest = plant(points, trees, small) if len(points) else []
    sent = spark.sparkContext.broadcast(forest)
    # Vectors travel as they are stored: as floats, or else as doubles.
    kind = "array<float>" if index.schema["_vector"].dataType.simpleString() == "array<float>" else "array<double>"
    listed = pa.list_(pa.float32() if kind == "array<float>" else pa.float64())
    placed_schema = pa.schema([("tree", pa.int32()), ("leaf", pa.int32()), ("_class", pa.int64()), ("_members", pa.list_(pa.int64())), ("_vector", listed)])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 2048):
            own = matrix(piece.column(2))
            for t, tree in enumerate(sent.value):
                yield batch(placed_schema, np.full(len(own), t, np.int32), leaves_of(tree, own).astype(np.int32), *piece.columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(int((tree.left < 0).sum()), np.int64) for tree in sent.value]
        for piece in pieces(batches, 2048):
            own = matrix(piece.column(0))
            for t, tree in enumerate(sent.value):
                held[t] += np.bincount(leaves_of(tree, own), minlength=len(held[t]))
        for t, h in enumerate(held):
            some = np.flatnonzero(h)
            yield batch(pa.schema([("tree", pa.int32()), ("leaf", pa.int32()), ("n", pa.int64())]), np.full(len(some), t, np.int32), some.astype(np.int32), h[some])

    counted = index.select("_vector").mapInArrow(count, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).collect()
    held = [np.zeros(int((tree.left < 0).sum()), np.int64) for tree in forest]
    for c in counted:
        held[c["tree"]][c["leaf"]] = c["n"]
    known = spark.sparkContext.broadcast(held)
    reach = needed(int(held[0].sum()) if held else 0) if reach is None else reach
    probe_schema = pa.schema([("tree", pa.int32()), ("leaf", pa.int32()), ("part", pa.int32()), ("_query", pa.int64()), ("_own", listed)])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 256):
            for q, own, raw in zip(piece.column(0).to_pylist(), matrix(piece.column(1)), piece.column(1).to_pylist()):
                cells = [(t, leaf, p) for t, leaf in reached(sent.value, known.value, own, reach) for p in range(-(-int(known.value[t][leaf]) // cell))]
                if cells:
                    yield batch(probe_schema, *zip(*cells), [q] * len(cells), [raw] * len(cells))

    queries = rows.where(wanted).distinct().select("_id", F.col("_vector").cast(kind).alias("_vector"))
    probes = queries.mapInArrow(probe, f"tree int, leaf int, part int, _query long, _own {kind}")
    counts = F.broadcast(spark.createDataFrame([(c["tree"], c["leaf"], c["n"]) for c in counted], "tree int, leaf int, n long"))  # a row a leaf
    wide = index.select("_class", "_members", F.col("_vector").cast(kind).alias("_vector"))
    placed = wide.mapInArrow(place, f"tree int, leaf int, _class long, _members array<long>, _vector {kind}")
    dealt = placed.join(counts, ["tree", "leaf"]).withColumn("part", (F.pmod(F.xxhash64("_class"), F.ceil(F.col("n") / cell))).cast("int")).drop("n")
    found_schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def meet(asked: pa.Table, there: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if asked.num_rows and there.num_rows:
            asked, there = asked.combine_chunks(), there.combine_chunks()
            own = matrix(there.column("_vector").chunk(0))
            members = there.column("_members").to_pylist()
            least = there.column("_class").to_numpy()
            for q, v in zip(asked.column("_query").to_pylist(), matrix(asked.column("_own").chunk(0))):
                score = np.sqrt(((own - v) ** 2).sum(axis=1))
                if len(score) > nearest + 1:
                    bound = np.partition(score, nearest)[nearest]
                    some = np.flatnonzero(score <= bound)
                else:
                    some = np.arange(len(score))
                # Classes at the same distance: their smallest members decide, and nearest + 1 classes are enough.
                some = some[np.lexsort((least[some], score[some]))][: max(nearest + 1, int((score[some] < score[some].max(initial=0)).sum()) + nearest + 1)]
                best = sorted((float(score[i]), m) for i in some for m in members[i] if m != q)[:nearest]
                out[0] += [q] * len(best)
                out[1] += [m for _, m in best]
                out[2] += [s for s, _ in best]
        return pa.Table.from_arrays([pa.array(o, type=f.type) for o, f in zip(out, found_schema)], schema=found_schema)

    keys = ["tree", "leaf", "part"]
    found = probes.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place_of = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", place_of).where(F.col("rank") <= nearest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
