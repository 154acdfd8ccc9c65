"""Corpus pipeline: toxicity, near-duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``docs``:

1. toxicity       drops documents with a toxicity of ``TOXIC_FROM`` or more
2. simhash_dedup  keeps one document of each near-duplicate group
3. decontaminate  drops documents that hold a benchmark item
4. secrets        replaces secrets in the texts by a mask (``n_chars`` follows)
5. packing        packs what is left into training sequences

Null texts are empty texts throughout; repeated rows are one group of stage 2;
an empty table passes through every stage; extra columns are carried up to the
last stage whatever their names (those that begin with two underscores apart).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import decontaminate as leaks
from marketlake.llm import packing, secrets, simhash, toxicity
from marketlake.llm.common import table
from marketlake.llm.tokens import WordTokenizer
from marketlake.session import ensure_checkpoint_dir, ship_package

TOXIC_FROM = 0.5
TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="__toxicity").where(F.col("__toxicity") < TOXIC_FROM).drop("__toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.scan(docs, out="__secrets")
    masked = found.withColumn("text", F.when(F.size("__secrets") > 0, secrets.redact(F.col("text"), F.col("__secrets")))
                              .otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.size("__secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                                   .otherwise(F.col("n_chars")))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, WordTokenizer.from_package(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# the stages' models, fingerprints and token ids are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Each stage's output is a table in the
    shared checkpoint folder, so a lost executor costs at most one stage."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
