"""The registered query of each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..catalog import Catalog
from . import licenses, lines, matroska, mixing, neighbours, pii, repair, secretscan, sentences, simhash, sql, toxicity, trie, urls

catalog = Catalog()

#: A deployment passes its own secret; this one makes the query's results repeatable.
DEMO_KEY = "everkey-demo-key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@catalog.add("op1_pseudonyms")
def op1_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), DEMO_KEY)


@catalog.add("op2_matroska")
def op2_matroska(spark, sf_dir):
    return matroska.read_back(matroska.stored(table(spark, sf_dir, "documents")))


@catalog.add("op3_neighbours")
def op3_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("_id") % 100 == 0)


@catalog.add("op4_mix", sql.MIX)
def op4_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@catalog.add("op5_simhash")
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@catalog.add("op6_sentencepiece")
def op6_sentencepiece(spark, sf_dir):
    return sentences.encoded(table(spark, sf_dir, "documents"))


@catalog.add("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@catalog.add("op8_line_dedup")
def op8_line_dedup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicated(documents, details=True)


@catalog.add("op9_url_filter", sql.URLS)
def op9_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


@catalog.add("op10_licenses", sql.LICENSES)
def op10_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@catalog.add("op11_trie")
def op11_trie(spark, sf_dir):
    return trie.trie(table(spark, sf_dir, "conversations"))


@catalog.add("op12_secrets")
def op12_secrets(spark, sf_dir):
    return secretscan.scan(table(spark, sf_dir, "documents"))


@catalog.add("op13_repair")
def op13_repair(spark, sf_dir):
    return repair.repair(table(spark, sf_dir, "conversations"))
