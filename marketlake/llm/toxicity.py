"""Toxicity: linear classifier on character n-grams scaled by naive Bayes
log-count ratios.

Fit: for each hashed n-gram the log ratio r of its smoothed document
frequencies in toxic and clean training rows; then logistic regression on the
features r * tf / sqrt(n_chars).  Scoring is linear, so a whole text is one
sum over its n-grams, in segments of bounded size.

The fit uses a bounded sample of the labelled rows (``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` rows, drawn by a hash of the id, weighted back to the class
sizes of all training rows) of up to ``TRAIN_MAX_CHARS``; a class with fewer
takes its shortest longer rows too, at most ``LONG_ROWS``.  Scoring covers all
rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, crc_mod, free_name, query, row_chars, ship_package, table, text_or_empty
from .linear import fit_in_task, fit_logistic, sigmoid
from .ngrams import buckets, counted

LOW, HIGH, BITS = 3, 5, 20
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 2500
TRAIN_MAX_CHARS, LONG_ROWS = 20_000, 25
FOLDS, HELD_OUT = 5, 0


@dataclass
class Model:
    weights: np.ndarray   # float32, one per bucket: ratio times learned weight
    bias: float

    def score(self, text: str) -> float:
        total = sum(float(self.weights[b].sum(dtype=np.float64)) for b in buckets(text, LOW, HIGH, BITS))
        return float(sigmoid(total / max(1, len(text)) ** 0.5 + self.bias))


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(sample of doc_id, toxic, text) and the class sizes of all training rows.

    Labels are held per id: a row labelled more than once is toxic if at least
    half of its labels say so; null labels and ids without a document are
    ignored."""
    marked = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("double").alias("t"))
              .where("id is not null and t is not null").where(crc_mod("id", FOLDS) != HELD_OUT)
              .groupBy("id").agg((F.avg("t") >= 0.5).cast("int").alias("toxic")))
    there = marked.join(row_chars(docs), "id")
    sizes = {r["toxic"]: r["count"] for r in there.groupBy("toxic").count().collect()}
    picked = [bounded_sample(there.where(F.col("toxic") == c), n, TRAIN_MAX_CHARS, LONG_ROWS, "toxicity sample")
              for c, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    sample = picked[0].unionByName(picked[1])   # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of three numbers
    rows = (docs.select(F.col("doc_id").alias("id"), text_or_empty("text").alias("text"))
            .join(F.broadcast(sample), "id").where(F.length("text") == F.col("chars")).select("id", "toxic", "text"))
    return rows, sizes


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [counted(t, LOW, HIGH, BITS) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("toxic"), pa.array([len(t) for t in b.column("text").to_pylist()], pa.int64()),
             pa.array([c.astype(np.int32).tobytes() for c, _ in found], pa.binary()),
             pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary())],
            names=["toxic", "chars", "cols", "counts"])


def fit(docs: DataFrame, labels: DataFrame, l2: float = 1e-4, epochs: int = 40) -> Model:
    """Fit on the labelled rows outside the held-out fold.  Without rows of
    both classes the model scores every text with the smoothed base rate."""
    rows, sizes = training_rows(docs, labels)
    features = rows.select("toxic", "text").mapInArrow(_features, "toxic int, chars long, cols binary, counts binary")
    return fit_in_task(features, lambda got: _fit_rows(got, sizes, l2, epochs))


def _fit_rows(got: list[dict], sizes: dict[int, int], l2: float, epochs: int) -> Model:
    dim = 1 << BITS
    if len({r["toxic"] for r in got}) < 2:
        rate = (sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + sizes.get(1, 0) + 1.0)
        return Model(np.zeros(dim, np.float32), float(np.log(rate / (1 - rate))))
    got.sort(key=lambda r: (r["toxic"], r["chars"], r["cols"]))   # the same fit for any order of rows
    y = np.array([r["toxic"] for r in got], dtype=np.float64)
    cols = [np.frombuffer(r["cols"], np.int32) for r in got]
    df = {c: np.bincount(np.concatenate([x for x, t in zip(cols, y) if t == c]), minlength=dim) for c in (0, 1)}
    n = {c: int((y == c).sum()) for c in (0, 1)}
    ratio = np.log((df[1] + 1.0) / (n[1] + 2.0)) - np.log((df[0] + 1.0) / (n[0] + 2.0))
    ratio[df[0] + df[1] < 2] = 0.0
    lens = np.array([len(c) for c in cols])
    every = np.concatenate(cols)
    vals = np.concatenate([(np.frombuffer(r["counts"], np.int32) / max(1, r["chars"]) ** 0.5 * ratio[c]).astype(np.float32)
                           for r, c in zip(got, cols)])
    odds = sizes[0] / sizes[1]
    weight = np.where(y == 1, sizes[1] / n[1] * max(1.0, odds) ** 0.5, sizes[0] / n[0])
    w, b = fit_logistic(every, vals, lens, y, weight, dim, l2, epochs)
    return Model((w * ratio).astype(np.float32), b)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """Add the toxicity of each row's whole text (0 to 1).  Null text is the
    empty text, which gets the bias's score; an empty table has no rows; other
    columns stay, and where one is named ``out`` the score gets an underscore
    behind its name; repeated rows score alike; texts of any length are scored
    in segments.  The model is one array of 4 * 2**BITS bytes."""
    out = free_name(docs, out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([m.score(t or "") for t in texts], pa.float64())],
                                             names=[*b.schema.names, out])
    return docs.mapInArrow(run, schema)


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model, out="score")
    return scored.select("doc_id", (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
