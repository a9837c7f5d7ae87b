"""From raw documents to token ids, a stage at a time.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage returns as
Parquet in the shared scratch folder and reads it back as the next one's ``docs``. Stages take empty tables, nulls in
any column, repeated rows and texts of any length, and hand on whatever columns ``docs`` has, also those named like
columns that an operator adds; the last one returns the ids and digests of the texts instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import language, mixing, quality, simhash, trie_bpe
from cohortflow.session import ship_package
from cohortflow.sources.scratch import settle

#: Phrases of a text under its language's sample have so many letters on average; a script that no sample has is
#: spelled letter by letter. This does not depend on how many languages there are, and a text that is as
#: near to a second language stays.
LEAST_PHRASE = 1.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. Null and empty texts have score 0 and go; rows that repeat
    each get the decision of their text."""
    field = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs.select(F.struct("*").alias("doc"), F.col("text")), field)
    return scored.where("predicted = 1").select("doc.*")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that are in one of the learned languages. Null texts and those without letters go;
    without learned languages all go."""
    found = language.identify(docs.select(F.struct("*").alias("doc"), F.col("text")), language.learn(docs))
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("phrase_chars") >= LEAST_PHRASE)
    return found.where(known).select("doc.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of each group of near duplicates; null ids come last."""
    return simhash.drop_near_duplicates(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. Null texts have no words and stay once, as do rows
    without an id; rows that share an id share their lot, whatever their texts."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number and digest of the ids of every text, and the digest of what they decode to; a null text counts as
    empty, and equal rows each get theirs."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return trie_bpe.digests(docs.select("doc_id", "text"), path).drop("text")


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("mix", mixed_sources),
    ("encode", token_ids),
]

#: The classifier cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
