"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import (
    clustering,
    embedding_dedup,
    language,
    licenses,
    merkle,
    mixing,
    quality,
    scaled_sketch,
    simhash,
    token_counts,
    token_files,
    top_k,
    trie_bpe,
)
from cohortflow.llm.common import held_out
from cohortflow.session import ship_package
from cohortflow.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

END_ID = 2


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(ship_package(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-files")
    return token_files.write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), END_ID)


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


@query
def op10_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return trie_bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.edited_pairs(table(spark, sf_dir, "documents"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op9_mixing"] = mixing.SQL


@query
def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, field).withColumn("held_out", held_out("doc_id")).drop("text")


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    samples = language.learn(docs)
    found = language.identify(docs.select("doc_id", "text"), samples)
    return found.withColumn("held_out", held_out("doc_id")).drop("text")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLES["op8_license_scan"] = licenses.notices_sql()


@query
def op8_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.notices(table(spark, sf_dir, "documents"))


ORACLES["op8_license_notices"] = licenses.notices_sql()


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


ORACLES["op11_centroid_clustering"] = clustering.sql()


@query
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op12_exact_top_k"] = top_k.SQL


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


ORACLES["op13_merkle_manifest"] = merkle.sql()
