"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source are laid out as a stream: its documents in seeded order, dealt to shards by hash so that a large
source is many independent streams.  A shard is cut into blocks of equally many words.  As many blocks as the corpus
holds are given to shards one by one, always to the shard with the highest quotient target / (2 * given + 1); that is the
shard's quota.  Whole rounds of the quota take every block; what is left is a run of blocks that begins at a seeded
place and wraps around.  A document takes its overlap with those blocks, so only documents at the two ends of a run are
taken in part.

The quotients are never listed in full.  With m shards and N blocks, quotas lie between those of two divisors that
differ from words / N by a factor of m / 2N, which leaves about 2m quotients to rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

#: Words in a block, and the most words and documents that a shard is meant to hold.
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 21
SHARD_DOCS = 1 << 13
SEED = "mix-1"
#: Fixed values of the contract: weights of the sources in code point order, repeating, and the limit for repeats.
WEIGHTS = (5, 2, 1)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"


def seeded(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def as_number(digest: Column) -> Column:
    return F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("long")


def measured(documents: DataFrame, seed: str = SEED, text: str = "text", keep: list[str] = ()) -> DataFrame:
    """``_id, _source, _size, _hash, _tie`` for each row, and the columns in ``keep`` as ``_row``."""
    carried = [F.struct(*[F.col(c) for c in keep]).alias("_row")] if keep else []
    return documents.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
        # By id and text, so that rows without id, or with one id, are dealt evenly as well.
        seeded(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit(""))).alias("_hash"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_tie"), *carried,
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """``_source, _words, _shards, _target``: shares by weight, stopped at three times the words, the rest reshared.

    Sorted by limit / weight, the sources that stop come first; each row knows what the share would be if all before it
    stop, and the first that stays below its limit sets the level for the rest.
    """
    per = sizes.groupBy("_source").agg(F.sum("_size").alias("_words"), F.count("*").alias("_docs"))
    place = (F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1) % len(WEIGHTS)
    weighed = per.withColumn("_weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (place + 1).cast("int")).cast("long"))
    limit = (F.col("_words") * MOST).alias("_limit")
    everything = Window.partitionBy(F.lit(1))
    order = everything.orderBy((F.col("_limit").cast("double") / F.col("_weight")), F.col("_source").asc_nulls_last())
    leveled = (
        weighed.select("*", limit)
        .withColumn("_stopped", F.coalesce(F.sum("_limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_open", F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (F.sum("_words").over(everything) - F.col("_stopped")).cast("double") / F.col("_open"))
        .withColumn("_free", F.col("_limit") > F.col("_level") * F.col("_weight"))
        .withColumn("_at", F.min(F.when(F.col("_free"), F.struct(F.col("_stopped"), F.col("_level")))).over(everything)["_level"])
    )
    return leveled.select(
        "_source", "_words",
        F.greatest(F.ceil(F.col("_words") / SHARD_WORDS), F.ceil(F.col("_docs") / SHARD_DOCS), F.lit(1)).cast("long").alias("_shards"),
        F.when(F.col("_free"), F.col("_at") * F.col("_weight")).otherwise(F.col("_limit").cast("double")).alias("_target"),
    )


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys of which the source may be null; the columns of ``keys`` stay once."""
    other = right.select(*[F.col(k).alias(f"{k}_") if k in keys else F.col(k) for k in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    return left.join(other, same, how).drop(*[f"{k}_" for k in keys])


def in_shards(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    return joined(sizes, targets, ["_source"], "inner").withColumn("_shard", as_number(F.col("_hash")) % F.col("_shards"))


def quotas(dealt: DataFrame, block_words: int = BLOCK_WORDS, seed: str = SEED) -> DataFrame:
    """``_source, _shard, _blocks, _quota, _start`` for each shard with words."""
    shards = (
        dealt.groupBy("_source", "_shard").agg(F.sum("_size").alias("_held"), F.first("_words").alias("_words"), F.first("_target").alias("_target"))
        .where("_held > 0")
        .select("_source", "_shard", F.ceil(F.col("_held") / block_words).cast("long").alias("_blocks"),
                (F.col("_target") * F.col("_held") / F.col("_words")).alias("_due"), "_held")
    )
    shards = written(shards, "mix-shards")
    total = shards.agg(F.coalesce(F.sum("_held"), F.lit(0)).alias("words"), F.count("*").alias("shards")).first()
    blocks = round(total["words"] / block_words)
    slack = total["shards"] / (2 * blocks) if blocks else 0.0
    even = total["words"] / blocks if blocks else 1.0
    most = F.floor(F.col("_due") * ((1 + slack) * (1 + 1e-9) / even) + 0.5).cast("long") if blocks else F.lit(0).cast("long")
    least = F.floor(F.col("_due") * (max(0.0, 1 - slack) * (1 - 1e-9) / even) + 0.5).cast("long") if blocks and slack < 1 else F.lit(0).cast("long")
    ranged = shards.withColumn("_least", least).withColumn("_most", most)
    left = blocks - (ranged.agg(F.sum("_least")).first()[0] or 0)
    border = ranged.where("_most > _least").select("_source", "_shard", F.explode(F.sequence(F.col("_least"), F.col("_most") - 1)).alias("_given"), "_due")
    highest = Window.orderBy((F.col("_due") / (2 * F.col("_given") + 1)).desc(), F.col("_source").asc_nulls_last(), "_shard", "_given")
    won = border.withColumn("_rank", F.row_number().over(highest)).where(F.col("_rank") <= left).groupBy("_source", "_shard").agg(F.count("*").alias("_won"))
    return joined(ranged, won, ["_source", "_shard"], "left").select(
        "_source", "_shard", "_blocks",
        F.least(F.col("_least") + F.coalesce("_won", F.lit(0)), F.col("_blocks") * MOST).alias("_quota"),
        (as_number(seeded(F.lit(seed), F.coalesce("_source", F.lit("null")), F.col("_shard").cast("string"))) % F.col("_blocks")).alias("_start"),
    )


def overlap(begin: Column, end: Column) -> Column:
    """First and last word (from 0, end excluded) of a document's words that a stretch of the stream covers."""
    first = F.greatest(F.col("_from"), begin)
    last = F.least(F.col("_from") + F.col("_size"), end)
    return F.struct((first - F.col("_from")).alias("first"), F.greatest(last - F.col("_from"), first - F.col("_from")).alias("last"))


def take(dealt: DataFrame, given: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds ``_rounds`` and the stretches ``_head`` and ``_tail`` of words that a document gives once more."""
    stream = Window.partitionBy("_source", "_shard").orderBy("_hash", "_size", "_tie")
    placed = dealt.withColumn("_from", F.sum("_size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
    found = joined(placed, given, ["_source", "_shard"], "left")
    extra = F.col("_quota") % F.col("_blocks")
    end = F.col("_start") + extra
    nothing = F.struct(F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("last"))
    return (
        found.withColumn("_rounds", F.coalesce(F.floor(F.col("_quota") / F.col("_blocks")), F.lit(0)).cast("long"))
        .withColumn("_head", F.coalesce(overlap(F.col("_start") * block_words, end * block_words), nothing))
        .withColumn("_tail", F.coalesce(overlap(F.lit(0).cast("long"), F.greatest(end - F.col("_blocks"), F.lit(0)) * block_words), nothing))
        .withColumn("_taken", F.col("_rounds") * F.col("_size") + F.col("_head.last") - F.col("_head.first") + F.col("_tail.last") - F.col("_tail.first"))
    )


def plan(documents: DataFrame, seed: str = SEED, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes, targets and quotas, each written once."""
    sizes = written(measured(documents, seed), "mix-sizes")
    targets = written(source_targets(sizes), "mix-targets")
    given = written(quotas(in_shards(sizes, targets), block_words, seed), "mix-quotas")
    return sizes, targets, given


def mix(documents: DataFrame, seed: str = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row.

    Null texts have no words and take none; a null source is a source of its own, the last; a null id is hashed as such, with the text.
    Repeated rows are documents of their own.  No document gives more than three times its words.  Results depend on
    the rows and the seed alone.  An empty table gives no rows; other columns are not touched.
    """
    sizes, targets, given = plan(documents, seed, block_words)
    return take(in_shards(sizes, targets), given, block_words).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_words").alias("source_size"),
        F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def mixed(documents: DataFrame, seed: str = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix, with the columns of ``documents``: one row for each round, and one for words taken once
    more.  A document taken whole keeps its text as it is; of one taken in part the words stand joined by blanks.
    Documents the mix does not take, those without words among them, are gone."""
    columns = documents.columns
    _, targets, given = plan(documents, seed, block_words)
    taken = take(in_shards(measured(documents, seed, keep=columns), targets), given, block_words).where("_taken > 0")
    whole = F.struct(F.lit(0).cast("long").alias("first"), F.col("_size").alias("last"))
    parts = F.filter(F.concat(F.array_repeat(whole, F.col("_rounds").cast("int")), F.array("_head", "_tail")), lambda s: s["last"] > s["first"])
    rows = taken.select("_row", "_size", F.explode(parts).alias("_part"))
    words = F.slice(F.regexp_extract_all(F.col("_row.text"), F.lit(WORD), F.lit(0)), F.col("_part.first").cast("int") + 1, (F.col("_part.last") - F.col("_part.first")).cast("int"))
    text = F.when(F.col("_part.last") - F.col("_part.first") == F.col("_size"), F.col("_row.text")).otherwise(F.array_join(words, " "))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[(new[c] if c in new else F.col("_row")[c]).alias(c) for c in columns])
