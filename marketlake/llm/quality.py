"""Quality classifier by co-training two views of a document.

View 1 (content): hashed character 1- to 3-grams of the whole text.
View 2 (page metadata): source, language, length and the text's layout figures
(line lengths, shares of letters, capitals, digits and marks) as a crawler
records them; no content n-grams.

Each round fits both views, lets each label the pool documents it is surest
of, and hands these to the other view as training rows.  After the last round
each view is calibrated on labelled rows that took no part in the fit (Platt
scaling), and the calibrated log odds are combined, less the prior's that both
contain.  All documents are then scored in one pass over their whole texts.

The fit uses a bounded sample: at most ``LABELLED`` labelled rows and ``POOL``
unlabelled rows, drawn by a hash of the id from texts up to
``TRAIN_MAX_CHARS``; where these are fewer, the shortest longer ones too, at
most ``LONG_ROWS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, crc_mod, free_name, query, row_chars, ship_package, table
from .linear import fit_in_task, fit_logistic, sigmoid
from .ngrams import buckets, counted

LOW, HIGH, BITS = 1, 3, 18
META_BITS = 12
LABELLED, POOL, TRAIN_MAX_CHARS, LONG_ROWS = 4000, 4000, 20_000, 25
ROUNDS, PER_ROUND = 4, 200
FOLDS, HELD_OUT, CALIBRATE = 5, 0, 1
EPOCHS, L2_TEXT, L2_META = 30, 1e-4, 1e-4


def meta_features(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Buckets of the metadata view: one per named figure."""
    import xxhash
    n = max(1, len(text))
    lines = text.count("\n") + 1
    words = text.count(" ") + lines
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kind = np.bincount(_KIND[raw], minlength=5) if len(raw) else np.zeros(5)
    share = lambda k: int(20 * kind[k] / n)
    figures = (("lang", lang), ("source", source), ("chars", int(2 * np.log2(n))), ("lines", int(np.log2(lines))),
               ("line", int(np.log2(n / lines + 1))), ("word", int(n / words)), ("letters", share(1)),
               ("capitals", share(2)), ("digits", share(3)), ("marks", share(4)), ("blank", share(0)))
    return np.array([xxhash.xxh32_intdigest(f"{k}={v}") & ((1 << META_BITS) - 1) for k, v in figures], np.int32)


def _kinds() -> np.ndarray:
    out = np.full(256, 1, np.uint8)       # letters, and bytes of other scripts
    for c in range(128):
        ch = chr(c)
        out[c] = 0 if ch.isspace() else 2 if ch.isupper() else 1 if ch.islower() else 3 if ch.isdigit() else 4
    return out


_KIND = _kinds()


@dataclass
class View:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def calibrated(self, z):
        """Log odds."""
        return self.slope * z + self.shift


@dataclass
class Model:
    text: View
    meta: View
    prior: float      # log odds of the labelled rows

    def score(self, text: str, lang: str | None, source: str | None) -> tuple[float, float, float]:
        """(text view, metadata view, combined), each 0 to 1."""
        total = sum(float(self.text.weights[b].sum(dtype=np.float64)) for b in buckets(text, LOW, HIGH, BITS))
        a = self.text.calibrated(total / max(1, len(text)) ** 0.5 + self.text.bias)
        m = meta_features(text, lang, source)
        b = self.meta.calibrated(float(self.meta.weights[m].sum(dtype=np.float64)) + self.meta.bias)
        return float(sigmoid(a)), float(sigmoid(b)), float(sigmoid(a + b - self.prior))


_SAMPLE = "id long, label int, fold int, chars long, cols binary, counts binary, meta binary"


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows outside the held-out fold (label 0 or 1) and pool rows
    (label null), with the features of both views.  An id labelled more than
    once takes the majority, ties good; null labels are ignored."""
    marked = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("q"))
              .where("id is not null and q is not null").groupBy("id").agg((F.avg("q") >= 0.5).cast("int").alias("label")))
    ids = row_chars(docs).select(F.col("id").cast("long").alias("id"), "chars").join(marked, "id", "left")
    open_ = ids.where(crc_mod("id", FOLDS) != HELD_OUT)
    chosen = reduce(DataFrame.unionByName, [
        bounded_sample(open_.where(is_kind), n, TRAIN_MAX_CHARS, LONG_ROWS, "quality sample")
        for is_kind, n in (("label is not null", LABELLED), ("label is null", POOL))])
    rows = (docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"), "lang", "source")
            .join(F.broadcast(chosen), "id").where(F.length("text") == F.col("chars"))
            .select("id", "label", crc_mod("id", FOLDS).cast("int").alias("fold"), "text", "lang", "source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, langs, sources = (b.column(c).to_pylist() for c in ("text", "lang", "source"))
            found = [counted(t, LOW, HIGH, BITS) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), b.column("fold"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([c.astype(np.int32).tobytes() for c, _ in found], pa.binary()),
                 pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary()),
                 pa.array([meta_features(*x).tobytes() for x in zip(texts, langs, sources)], pa.binary())],
                names=["id", "label", "fold", "chars", "cols", "counts", "meta"])
    return rows.mapInArrow(run, _SAMPLE)


class _Rows:
    """Sparse rows of one view."""

    def __init__(self, cols: list[np.ndarray], vals: list[np.ndarray], bits: int, l2: float):
        self.cols, self.vals, self.dim, self.l2 = cols, vals, 1 << bits, l2

    def fit(self, which: np.ndarray, y: np.ndarray) -> View:
        good = max(1, int((y == 1).sum()))
        weight = np.where(y == 1, 1.0, max(1.0, good / max(1, int((y == 0).sum()))) ** 0.5)
        w, b = fit_logistic(np.concatenate([self.cols[i] for i in which]), np.concatenate([self.vals[i] for i in which]),
                            np.array([len(self.cols[i]) for i in which]), y, weight, self.dim, self.l2, EPOCHS)
        return View(w.astype(np.float32), b)

    def margin(self, view: View, which: np.ndarray) -> np.ndarray:
        return np.array([float((self.vals[i] * view.weights[self.cols[i]]).sum()) + view.bias for i in which])


def co_train(views: list[_Rows], label: np.ndarray, fold: np.ndarray, rounds: int = ROUNDS,
             per_round: int = PER_ROUND) -> tuple[list[View], float]:
    """Views after ``rounds`` of exchange, calibrated on the calibration fold,
    and the prior log odds.  ``label`` is -1 for pool rows."""
    known = np.nonzero(label >= 0)[0]
    train, held = known[fold[known] != CALIBRATE], known[fold[known] == CALIBRATE]
    good = float((label[train] == 1).mean())
    given: list[dict[int, int]] = [{}, {}]      # pseudo-labels each view was handed
    free = np.nonzero(label < 0)[0]

    def fitted(v):
        extra = np.array(sorted(given[v]), np.int64)
        y = np.concatenate([label[train], np.array([given[v][i] for i in extra.tolist()], label.dtype)])
        return views[v].fit(np.concatenate([train, extra]), y.astype(np.float64))
    for _ in range(rounds):
        if not len(free):
            break
        taken: set[int] = set()
        for v in (0, 1):
            z = views[v].margin(fitted(v), free)
            order = np.argsort(z, kind="stable")
            n = min(per_round, len(free) // 2)
            bad = max(1, round(n * (1 - good)))
            sure = [(i, 0) for i in order[:bad] if z[i] < 0] + [(i, 1) for i in order[::-1][:n - bad] if z[i] > 0]
            for i, y in sure:
                given[1 - v][int(free[i])] = y
                taken.add(int(free[i]))
        free = np.array([i for i in free.tolist() if i not in taken], np.int64)
    done = [fitted(v) for v in (0, 1)]
    for v, view in enumerate(done):
        if len(set(label[held].tolist())) == 2:
            z = views[v].margin(view, held)
            spread = float(z.std()) or 1.0
            w, b = fit_logistic(np.zeros(len(held), np.int64), z / spread, np.ones(len(held), np.int64),
                                label[held].astype(np.float64), np.ones(len(held)), 1, 1e-3, 400, 0.05)
            view.slope, view.shift = max(float(w[0]), 0.0) / spread, b
    return done, float(np.log(good / (1 - good)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Without labelled rows of both classes every document scores the
    smoothed share of good labels."""
    return fit_in_task(sample(docs, labels), _fit_rows)


def _fit_rows(got: list[dict]) -> Model:
    got.sort(key=lambda r: (r["id"], r["chars"], r["cols"]))
    label = np.array([-1 if r["label"] is None else r["label"] for r in got], np.int64)
    fold = np.array([r["fold"] for r in got], np.int64)
    fit_rows = label[(label >= 0) & (fold != CALIBRATE)]
    if len(set(fit_rows.tolist())) < 2:
        rate = ((label == 1).sum() + 0.5) / ((label >= 0).sum() + 1.0)
        z = float(np.log(rate / (1 - rate)))
        return Model(View(np.zeros(1 << BITS, np.float32), z), View(np.zeros(1 << META_BITS, np.float32), z), z)
    text = _Rows([np.frombuffer(r["cols"], np.int32) for r in got],
                 [np.frombuffer(r["counts"], np.int32) / np.float32(max(1, r["chars"]) ** 0.5) for r in got], BITS, L2_TEXT)
    metas = [np.frombuffer(r["meta"], np.int32) for r in got]
    meta = _Rows(metas, [np.ones(len(m), np.float32) for m in metas], META_BITS, L2_META)
    done, prior = co_train([text, meta], label, fold)
    return Model(done[0], done[1], prior)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add text_view, meta_view and quality (0 to 1) to each row.  Null texts
    are empty, null languages and sources are values of their own; repeated
    rows score alike; an empty table has no rows.  ``docs`` holds ``text_col``,
    lang and source; where it has a column of one of the new names, that score
    gets an underscore behind its name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    new = [free_name(docs, c) for c in ("text_view", "meta_view", "quality")]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.DoubleType()) for c in new)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in (text_col, "lang", "source")]
            out = [m.score(t or "", g, s) for t, g, s in zip(*cols)]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([o[k] for o in out], pa.float64()) for k in range(3))],
                                             names=[*b.schema.names, *new])
    return docs.mapInArrow(run, schema)


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text", "lang", "source"), model)
    return scored.select("doc_id", (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text_view", "meta_view",
                         "quality", (F.col("quality") >= 0.5).alias("keep"))
