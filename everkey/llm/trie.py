"""Prefix trie of conversations by the Euler-tour technique.

Every conversation is a path from the root; conversations share a node as long as they share their turns.  A node is told
by its depth and a sum of 124-bit hashes, one for each turn and the place it stands at; such sums add up along a path, so
prefixes of a very long conversation are made in many tasks.  Nodes with the smallest conversation that passes through
them and their depth make a compact name: two nodes of one depth share no conversation.

Siblings stand in order of their smallest conversation.  Each node gives two arcs, enter and exit; enter is followed by
the first child's enter (or the own exit), exit by the next sibling's enter (or the parent's exit).  The tour is ranked
in ``tour``; the sums of leaves and saved words before either arc of a node differ by what its subtree holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.joins import grouped
from ..session import written
from . import tour
from .batches import batch
from .placing import AT, PART, earlier_sums, in_order, sizes, with_places

#: Fixed values of the contract: conversations that share a start, and how many lengths a shared start may have.
FAMILY, STARTS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
#: Width of the ranges of conversation ids that are joined to text at a time.
CHUNK = 1024
HASHES = 4
KEY = ["_depth", "_a", "_b"]


def turns(conversations: DataFrame) -> DataFrame:
    """``_conv, _digest, _words`` of each turn with its part and place (from 0), written."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("_conv"), F.col("turn").alias("_turn"), F.coalesce("role", F.lit("")).alias("_role"), F.coalesce("text", F.lit("")).alias("_text"))
    order = [F.col("_conv").asc(), F.col("_turn").asc_nulls_first(), F.col("_role").asc(), F.col("_text").asc()]
    digest = F.md5(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text")).alias("_digest")
    words = F.regexp_count("_text", F.lit(WORD)).cast("long").alias("_words")
    return written(with_places(in_order(rows, order, ["_conv", digest, words], "trie-turns"), ["_conv"]), "trie-placed")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (``_conv``, ``_length``) and their turns after the shared starts: ``_conv, _depth, _digest, _words,
    _last`` with the part they stand in; shared starts have a part of their own in front."""
    held = sizes(own, ["_conv"])
    first = own.where((F.col("_conv") % FAMILY == 0) & (F.col("_place") < STARTS - 1))
    starts = first.groupBy(F.col("_conv").alias("_base")).agg(F.sort_array(F.collect_list(F.struct("_place", "_digest", "_words"))).alias("_start"))
    shared = F.crc32(F.col("_conv").cast("string")) % STARTS
    nothing = F.array().cast("array<struct<_place:bigint,_digest:string,_words:bigint>>")
    # The first h turns go by h, the conversation's own; _from is how many there are.
    every = held.withColumn("_shared", shared).withColumn("_base", F.col("_conv") - F.col("_conv") % FAMILY).join(starts, "_base", "left") \
        .withColumn("_start", F.slice(F.coalesce("_start", nothing), F.lit(1), F.col("_shared").cast("int"))).withColumn("_from", F.size("_start")) \
        .withColumn("_length", F.col("_from") + F.greatest(F.col("_size") - F.col("_shared"), F.lit(0)))
    every = written(every.select("_conv", "_shared", "_from", "_start", "_length", "_size"), "trie-conversations")
    in_front = every.select("_conv", "_length", F.posexplode("_start").alias("_i", "_s")).select(
        "_conv", F.lit(-1).alias(PART), (F.col("_i") + 1).cast("long").alias("_depth"), "_s._digest", "_s._words", (F.col("_i") + 1 == F.col("_length")).alias("_last"))
    behind = own.join(every.drop("_start"), "_conv").where(F.col("_place") >= F.col("_shared")).select(
        "_conv", PART, (F.col("_place") - F.col("_shared") + F.col("_from") + 1).cast("long").alias("_depth"), "_digest", "_words", (F.col("_place") + 1 == F.col("_size")).alias("_last"))
    rows = in_front.union(behind)
    at = F.md5(F.concat(F.col("_depth").cast("string"), F.lit(":"), "_digest"))
    parts = [(F.conv(F.substr(at, F.lit(8 * k + 1), F.lit(8)), 16, 10).cast("long") % (1 << 31)).alias(f"_h{k}") for k in range(HASHES)]
    return every.select("_conv", "_length"), written(rows.select("*", *parts), "trie-rebuilt")


def prefixes(every: DataFrame, rows: DataFrame) -> DataFrame:
    """``_conv``, the key of the node that each prefix of it ends at, the key of the node before, ``_words, _last``."""
    names = [f"_h{k}" for k in range(HASHES)]
    within = Window.partitionBy("_conv", PART).orderBy("_depth").rowsBetween(Window.unboundedPreceding, 0)
    before = earlier_sums(rows, ["_conv"], {f"{n}_before": F.sum(n) for n in names})
    running = rows.join(before, ["_conv", PART]).select("_conv", "_depth", "_words", "_last", *names, *[(F.sum(n).over(within) + F.col(f"{n}_before")).alias(f"{n}_sum") for n in names])
    size = 1 << 31
    wide = lambda values: ((values[0] % size) * size + values[1] % size, (values[2] % size) * size + values[3] % size)
    a, b = wide([F.col(f"{n}_sum") for n in names])
    pa_, pb = wide([F.col(f"{n}_sum") - F.col(n) for n in names])
    paths = running.select("_conv", "_depth", a.alias("_a"), b.alias("_b"), pa_.alias("_pa"), pb.alias("_pb"), "_words", "_last")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = every.select("_conv", zero.alias("_depth"), zero.alias("_a"), zero.alias("_b"), none.alias("_pa"), none.alias("_pb"), zero.alias("_words"), (F.col("_length") == 0).alias("_last"))
    return written(paths.union(roots), "trie-prefixes")


def ends(paths: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ``_ends``, by the node's key.

    Ids are joined to text by ranges of ``chunk`` ids; a node's ranges are then hashed one after the other, so neither a
    list nor a text grows with the conversations that end at one node.
    """
    schema = pa.schema([*[(k, pa.int64()) for k in KEY], ("_ends", pa.string())])
    lists = paths.where("_last").groupBy(*KEY, F.floor(F.col("_conv") / chunk).alias("_range")).agg(F.collect_list("_conv").alias("_ids"))
    texts = lists.select(*KEY, "_range", F.array_join(F.transform(F.sort_array("_ids"), lambda i: i.cast("string")), ",").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for piece in batches:
            out: list[list] = [[], [], [], []]
            for *now, ids in zip(*(c.to_pylist() for c in piece.columns)):
                if now == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        for column, value in zip(out, [*key, digest.hexdigest()]):
                            column.append(value)
                    key, digest = now, hashlib.sha256()
                digest.update(ids.encode())
            yield batch(schema, *out)
        if key is not None:
            yield batch(schema, *[[v] for v in [*key, digest.hexdigest()]])

    in_turn = texts.repartition(*KEY).sortWithinPartitions(*KEY, "_range").select(*KEY, "_ids")
    return in_turn.mapInArrow(run, ", ".join(f"{k} long" for k in KEY) + ", _ends string")


def siblings(nodes: DataFrame) -> DataFrame:
    """``_node, _parent, _parent_conv, _sibling`` of every node but the root: its parent and the next child of that."""
    above = nodes.select((F.col("_depth") + 1).alias("_depth"), F.col("_a").alias("_pa"), F.col("_b").alias("_pb"), F.col("_node").alias("_parent"), F.col("_conv").alias("_parent_conv"))
    kids = nodes.where("_depth > 0").select("_node", "_conv", "_depth", "_pa", "_pb").join(above, ["_depth", "_pa", "_pb"])
    placed = in_order(kids, [F.col("_parent"), F.col("_conv")], ["_node", "_parent", "_parent_conv"], "trie-siblings")
    along = Window.partitionBy(PART).orderBy(AT)
    # One row for each part: the row that follows its last one.
    heads = placed.groupBy(PART).agg(F.min_by(F.struct("_parent", "_node"), AT).alias("_s"))
    following = heads.select(PART, F.lead("_s").over(Window.orderBy(PART)).alias("_s"))
    found = placed.join(F.broadcast(following), PART).withColumn("_s", F.coalesce(F.lead(F.struct("_parent", "_node")).over(along), "_s"))
    return found.select("_node", "_parent", "_parent_conv", F.when(F.col("_s._parent") == F.col("_parent"), F.col("_s._node")).alias("_sibling"))


def trie(conversations: DataFrame, block: int = tour.BLOCK, chunk: int = CHUNK) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations, as the contract of ``op11`` has them.

    Null roles and texts are empty; turns go by number, nulls first, then role, then text, and repeated rows are turns of
    their own.  Rows without conversation id belong to none and are left out.  ``FAMILY`` takes remainders with the sign
    of the id.  An empty table gives no rows; other columns are not touched.  ``enter_at`` and ``exit_at`` are the places
    of the node's arcs in the tour.
    """
    own = turns(conversations)
    every, rows = rebuilt(own)
    paths = prefixes(every, rows)
    merged = paths.groupBy(*KEY).agg(F.min("_conv").alias("_conv"), F.count("*").alias("_convs"), F.first("_words").alias("_words"), F.first("_pa").alias("_pa"), F.first("_pb").alias("_pb"))
    parts = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * paths.count() // block))
    nodes = in_order(merged, [F.col("_conv"), F.col("_depth")], [*KEY, "_pa", "_pb", "_conv", "_convs", "_words"], "trie-nodes", parts).withColumnRenamed(AT, "_node")
    kids = written(siblings(nodes), "trie-kids")
    below = grouped(kids, ["_parent"], F.min("_node").alias("_child"), F.count("*").alias("_children")).withColumnRenamed("_parent", "_node")
    tree = nodes.drop("_pa", "_pb").join(kids, "_node", "left").join(below, "_node", "left")
    saved = ((F.col("_convs") - 1) * F.col("_words")).alias("saved")
    tree = written(tree.select("*", F.when(F.col("_child").isNull(), 1).otherwise(0).cast("long").alias("leaves"), saved), "trie-tree")

    enter, leave = lambda node: F.col(node) * 2, lambda node: F.col(node) * 2 + 1
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    arcs = tree.select(PART, F.explode(F.array(
        F.struct(enter("_node").alias("_arc"), F.coalesce(enter("_child"), leave("_node")).alias("_next"), one.alias("_w0"), F.col("leaves").alias("_w1"), F.col("saved").alias("_w2")),
        F.struct(leave("_node").alias("_arc"), F.coalesce(enter("_sibling"), leave("_parent")).alias("_next"), one.alias("_w0"), zero.alias("_w1"), zero.alias("_w2")))).alias("_r")).select(PART, "_r.*")
    ranks = tour.rank(arcs, ["_w0", "_w1", "_w2"], block)
    out = F.col("_arc") % 2 == 1
    both = ranks.groupBy(F.floor(F.col("_arc") / 2).alias("_node")).agg(*[F.max(F.when(side, F.col(f"_w{k}"))).alias(f"_{n}{k}") for n, side in (("in", ~out), ("out", out)) for k in range(3)])
    named = tree.join(both, "_node").join(ends(paths, chunk), KEY, "left")
    return named.select(
        F.col("_conv").alias("conv_id"), F.col("_depth").alias("depth"), F.col("_parent_conv").alias("parent_conv_id"), F.col("_convs").alias("n_convs"),
        F.coalesce("_children", zero).alias("n_children"), (F.col("_out1") - F.col("_in1")).alias("n_leaves"), (F.col("_out2") - F.col("_in2")).alias("saved_tokens"),
        F.coalesce("_ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), F.col("_in0").alias("enter_at"), F.col("_out0").alias("exit_at"))
