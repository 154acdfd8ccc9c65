"""The corpus pipeline and the registered queries of this subpackage."""

import os
import sys

import harness
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from marketlake.llm import decontaminate, registry, simhash, toxicity  # noqa: E402

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], SF).write.parquet(f"{tmp}/{name}")
        seen.append(spark.read.parquet(f"{tmp}/{name}"))
    raw, calm, unique, clean, masked, packed = seen
    assert all(s.columns == COLUMNS for s in seen[:-1])
    ids = [[r[0] for r in s.select("doc_id").distinct().collect()] for s in seen]
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:]))
    model = toxicity.fit(raw, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = toxicity.score(raw.select("doc_id", "text"), model).where("toxicity < 0.5")
    assert sorted(ids[1]) == sorted(r[0] for r in kept.select("doc_id").collect())
    groups = simhash.near_duplicates(calm)
    assert sorted(ids[2]) == sorted(r[0] for r in groups.select("component_id").distinct().collect())
    assert simhash.near_duplicates(unique).where("component_id <> doc_id").count() == 0
    assert decontaminate.leaks(clean, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert masked.where(F.col("text").contains("[SECRET]")).count() > 0
    assert masked.where(F.col("text").rlike(r"AKIA[A-Z0-9]{16,}|(?<![0-9a-f])[0-9a-f]{24,}")).count() == 0
    assert masked.where(F.col("n_chars") != F.length("text")).count() == clean.where(F.col("n_chars") != F.length("text")).count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


@pytest.mark.parametrize("rows", [[], ODD])
def test_stages_take_odd_rows(spark, make_docs, tmp, rows):
    docs = make_docs(rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_run_is_all_stages(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


@pytest.mark.parametrize("name", sorted(registry.all_oracles()))
def test_query_matches_its_sql(spark, name):
    ok, message = harness.compare(registry.all_queries()[name](spark, SF), registry.all_oracles()[name], harness.duck(SF))
    assert ok, message


def test_one_query_per_operator():
    names = sorted(registry.all_queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
