"""A training corpus from raw documents: five stages, each of which works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from everkey.llm import copies, lines, mixing, sentences, simhash, toxicity
from everkey.session import written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of ``docs``."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that earlier ones hold."""
    return lines.deduplicated(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: SimHashes within 4 bits, as in op5; of what that leaves, five-word
    shingles with similarity 0.8 or more, most of which differ in more bits."""
    return copies.one_of_each(written(simhash.first_rows(docs), "pipeline-simhash"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix: those taken more than once stand as often, those not taken are gone."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return sentences.encoded(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", delete_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("source mix", mix_sources),
    ("token ids", encode),
]

#: Neither the classifier nor the fingerprints can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
