"""The pipeline, stage by stage."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from cohortflow.llm import queries as own
from cohortflow.llm import simhash
from cohortflow.llm.pieces import load
from cohortflow.session import ship_package

SF = "/root/testdata/sf0.01"


def test_registered():
    names = set(queries())
    assert {"pipeline", *own.QUERIES} <= names
    assert {int(n[2:].split("_")[0]) for n in own.QUERIES} == set(range(1, 14))
    assert set(own.ORACLES) <= set(oracle_sql())


def test_stages(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
        was = {r["doc_id"] for r in before.select("doc_id").collect()}
        assert set(ids) <= was
        if name == "quality":
            clean = [i for i in was if labels.get(i) == 1]
            junk = [i for i in was if labels.get(i) == 0]
            assert sum(i in set(ids) for i in clean) >= 0.98 * len(clean)
            assert sum(i in set(ids) for i in junk) <= 0.2 * len(junk)
        if name == "language":
            assert len(ids) >= 0.98 * len(was)
        if name == "near_duplicates":
            groups = simhash.near_duplicates(before).groupBy("component_id").count()
            assert sorted(ids) == sorted(r["component_id"] for r in groups.collect())
        if name == "mix":
            assert max(ids.count(i) for i in set(ids)) <= 3
    library = load(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    out = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert len(out) == kept.count()
    for r in out[:100]:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_clashing_columns_long_texts_and_ties(spark, stage):
    """Columns named like those of operators come back as they were; one long text and equal rows."""
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    clash = {c: F.lit(f"own {c}") for c in ("score", "predicted", "lang_pred", "lead", "fingerprint", "component_id", "size", "taken", "n_tokens", "doc", "_id", "_own")}
    long = docs.limit(1).withColumn("text", F.repeat("text", 300)).withColumn("doc_id", F.lit(10**9).cast("long"))
    some = docs.unionByName(docs.limit(5)).unionByName(long).withColumns(clash)
    out = stage(spark, some, SF)
    if stage is corpus_pipeline.token_ids:
        assert out.count() == some.count()
        return
    assert out.columns == some.columns
    found = out.select(*[F.count_if(F.col(c) != v) for c, v in clash.items()], F.count("*").alias("n")).first()
    assert not any(found[:-1]) and 0 < found["n"] <= 3 * some.count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_nulls_and_nothing(spark, stage):
    ship_package(spark)
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0), (2, "one\ntwo", "en", "s", 7)]
    for some in (rows, []):
        out = stage(spark, spark.createDataFrame(some, schema), SF)
        assert out.count() <= 3 * len(some)
