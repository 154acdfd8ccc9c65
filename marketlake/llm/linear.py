"""Logistic regression on sparse rows, for bounded samples (numpy)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_ENTRIES = 1 << 21


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(cols, vals, lens, y, weight, dim: int, l2: float, epochs: int, rate: float = 0.3):
    """Weighted logistic regression by Adam on all rows at once.

    Rows are given one after the other: ``lens[i]`` entries of
    (``cols``, ``vals``) each.  Returns (weights, bias)."""
    n = len(lens)
    if n == 0:
        return np.zeros(dim), 0.0
    y, weight = np.asarray(y, np.float64), np.asarray(weight, np.float64)
    weight = weight / weight.sum()
    ends = np.cumsum(lens)
    blocks, at = [], 0
    while at < n:   # rows are taken in blocks, so work arrays stay small
        begin = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, begin + BLOCK_ENTRIES, "right")))
        blocks.append((at, stop, begin, int(ends[stop - 1])))
        at = stop
    row = np.repeat(np.arange(n, dtype=np.int32), lens)
    w, m, s = np.zeros(dim), np.zeros(dim + 1), np.zeros(dim + 1)
    b = 0.0
    for e in range(1, epochs + 1):
        grad = np.append(l2 * w, 0.0)
        for first, stop, lo, hi in blocks:
            c, v, r = cols[lo:hi], vals[lo:hi], row[lo:hi] - first
            z = np.bincount(r, v * w[c], stop - first) + b
            g = (sigmoid(z) - y[first:stop]) * weight[first:stop]
            grad[:-1] += np.bincount(c, v * g[r], dim)
            grad[-1] += g.sum()
        m = 0.9 * m + 0.1 * grad
        s = 0.99 * s + 0.01 * grad * grad
        step = rate * (m / (1 - 0.9 ** e)) / (np.sqrt(s / (1 - 0.99 ** e)) + 1e-8)
        w -= step[:-1]
        b -= step[-1]
    return w, float(b)


def fit_in_task(rows: DataFrame, fit: Callable[[list[dict]], object]):
    """``fit`` of a bounded sample's rows, run in one task on an executor; the
    driver gets the model only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(got))], pa.binary())], names=["model"])
    return pickle.loads(rows.repartition(1).mapInArrow(run, "model binary").first()["model"])
