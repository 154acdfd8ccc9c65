"""Gaussian hidden Markov regimes over many keyed sequences (HMM-*).

The rows of all sequences form one chain, sorted by (sequence, order): where a
sequence starts, the transition is the start distribution whatever came
before.  ``prepare_sequences`` sorts the chain over the cluster, cuts it into
chunks of ``CHUNK`` consecutive rows wherever sequences begin or end, and
writes it once, hash-partitioned and sorted by chunk.  A sequence of any
length spreads over as many tasks as it has chunks, and a chunk of many short
sequences is one piece of work.

  pass 1  per chunk     transfer matrices of its first and last piece (the
                        sequences that other chunks may share)
  pass 2  per sequence  ordered fold over those pieces: what enters each
                        piece from the left (forward vector, Viterbi entry) and
                        from the right (backward vector, Viterbi end)
  pass 3  per chunk     filtered probabilities, Viterbi states, log-likelihood
                        or EM statistics, given what enters it

Within a chunk the sequences are cut into segments of at most ``STEP`` rows, all
segments in lockstep: no loop is longer than a segment and the number of
segments that go on from another, and nothing is padded.  Only the segments of
sequences that have several need transfer matrices and the same scan once more.

Passes 1 and 3 are cogroups on the chunk: the chunked table keeps its
partitioning and order, so an iteration of EM moves only parameters, pieces
and statistics.  EM reads a chunk as one row of arrays (``pack_chunks``), not
row by row, at each of its steps.  Models are rows of a table keyed by ``model_cols`` (none: one
model for all) that is joined to the chunks that hold its sequences; the
M-step is an aggregation by model key.  Nothing is collected by model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.scalars import regime_name
from ..session import cut_lineage, cut_lineage_partitioned, ship_package

LOG2PI = math.log(2.0 * math.pi)
CHUNK = 65_536        # rows of a chunk: what one call of a pass holds
STEP = 256            # rows of a segment
CHUNK_COL, AT_COL = "__chunk", "__at"
OF_COL = "__of"       # the chunk of a parameter or carry row
PACKED_COLS = ["__x", "__starts", "__runs", "__heads"]     # of pack_chunks


@dataclass
class HMMParams:
    """One model.  With a scaler, the means and variances are of
    (x - scaler_mean) / scaler_std, and the passes scale the features."""
    pi: np.ndarray            # (k,)
    A: np.ndarray             # (k, k) rows sum to 1
    means: np.ndarray         # (k, d)
    vars: np.ndarray          # (k, d) diagonal variances
    features: list[str] = field(default_factory=list)
    scaler_mean: np.ndarray | None = None   # (d,) stored with the model (D-16)
    scaler_std: np.ndarray | None = None
    converged: bool | None = None           # of a fitted model: within tol before max_iter

    @property
    def k(self) -> int:
        return len(self.pi)

    @property
    def d(self) -> int:
        return self.means.shape[1]

    def n_params(self) -> int:
        """HMM-5: (k-1) + k(k-1) + 2kd."""
        return n_params(self.k, self.d)

    def to_json(self) -> str:
        enc = {k: (v.tolist() if isinstance(v, np.ndarray) else v) for k, v in self.__dict__.items()}
        return json.dumps(enc)

    @staticmethod
    def from_json(s: str) -> "HMMParams":
        o = json.loads(s)
        arr = {k: (np.asarray(v, dtype=float) if isinstance(v, list) and k != "features" else v)
               for k, v in o.items()}
        return HMMParams(**arr)


def n_params(k, d):
    return (k - 1) + k * (k - 1) + 2 * k * d


# ------------------------------------------------------------- model tables
PARAM_COLS = ["pi", "trans", "means", "vars", "scale_mean", "scale_std"]
_PARAMS = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in PARAM_COLS]


@dataclass
class Models:
    """Models as rows of ``df``: the key columns, then ``PARAM_COLS`` as flat
    arrays (row-major), and for fitted models ``log_likelihood``, ``history``,
    ``iterations`` and ``converged``.  The key columns lead the sequence key,
    so that every sequence belongs to one model."""
    df: DataFrame
    model_cols: list[str]
    k: int
    features: list[str]

    @staticmethod
    def of(spark: SparkSession, params: HMMParams) -> "Models":
        """A table of one model for all sequences."""
        def flat(a):
            return None if a is None else [float(x) for x in np.asarray(a).ravel()]
        row = tuple(flat(a) for a in (params.pi, params.A, params.means, params.vars, params.scaler_mean, params.scaler_std))
        return Models(spark.createDataFrame([row], T.StructType(_PARAMS)), [], params.k, list(params.features))

    def one(self) -> HMMParams:
        """The single model of a table without key columns."""
        if self.model_cols:
            raise ValueError("a table of keyed models is not one model")
        r = self.df.first()
        k, d = self.k, len(self.features)
        arr = [None if r[c] is None else np.array(r[c], float) for c in PARAM_COLS]
        return HMMParams(arr[0], arr[1].reshape(k, k), arr[2].reshape(k, d), arr[3].reshape(k, d), list(self.features),
                         arr[4], arr[5], r["converged"] if "converged" in self.df.columns else None)


def _models(seqs: DataFrame, params: "HMMParams | Models") -> Models:
    return params if isinstance(params, Models) else Models.of(seqs.sparkSession, params)


# ------------------------------------------------------------------ sequences
def prepare_sequences(df: DataFrame, seq_cols: list[str], order_cols: list[str], features: list[str],
                      chunk_rows: int = CHUNK) -> DataFrame:
    """The chunked table of the model passes (see above), written to the
    checkpoint folder.  Rows that tie in ``order_cols`` stand by their
    features.  A null or NaN feature is an error: fill gaps first
    (``order.ffill_bfill``).  Null sequence keys are keys."""
    def known(c):
        gap = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
        return F.when(gap, F.raise_error(F.lit(f"feature {c} has a gap; fill it before the model")).cast("double")) \
            .otherwise(F.col(c).cast("double")).alias(c)
    plain = [c for c in dict.fromkeys([*seq_cols, *order_cols]) if c not in features]
    rows = df.select(*plain, *[known(c) for c in features])
    spark = df.sparkSession
    # partitions as the rows ask for, at least one to a core, at most as many as the session's shuffles have
    wanted = max(rows.count() // chunk_rows, spark.sparkContext.defaultParallelism)
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted))
    chunk = F.shiftleft(F.shiftright(AT_COL, 33), 33) + F.floor(F.col(AT_COL).bitwiseAND(F.lit((1 << 33) - 1)) / chunk_rows)
    # sorted by all columns: a task that runs again numbers its rows alike
    order = list(dict.fromkeys([*seq_cols, *order_cols, *features]))
    placed = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn(AT_COL, F.monotonically_increasing_id()).withColumn(CHUNK_COL, chunk))
    return cut_lineage_partitioned(placed.repartition(n, CHUNK_COL).sortWithinPartitions(CHUNK_COL, AT_COL))


# ------------------------------------------------------ one chunk in numpy
def _changes(rows: pa.Table, cols: list[str]) -> np.ndarray:
    """True where a row's ``cols`` differ from the row before (nulls equal
    nulls, NaN equals NaN); True at row 0."""
    n = rows.num_rows
    out = np.zeros(n, bool)
    out[:1] = True
    for c in cols:
        v = rows[c].combine_chunks()
        a, b = v.slice(1), v.slice(0, n - 1)
        differs = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(v.type):
            differs = pc.and_(differs, pc.invert(pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False)))
        differs = pc.or_(differs, pc.xor(pc.is_null(a), pc.is_null(b)))
        out[1:] |= differs.to_numpy(zero_copy_only=False)
    return out


def _stack(col, shape: tuple) -> np.ndarray:
    return np.array(col.to_pylist(), float).reshape(len(col), *shape)


def _emission_log(X: np.ndarray, means: np.ndarray, var: np.ndarray) -> np.ndarray:
    """(n, k) log N(x_t; mean_s, var_s), diagonal, summed over features."""
    out = np.zeros((len(means), len(X)))
    for j, s in np.ndindex(X.shape[1], len(means)):
        term = X[:, j] - means[s, j]
        term *= term
        term /= var[s, j]
        term += LOG2PI + np.log(var[s, j])
        out[s] += term
    out *= -0.5
    return out.T


def _parts(rows: pa.Table, seq_cols, model_cols, features):
    """What the passes need of a chunk's sorted rows: features (n, d), first
    rows of the sequences and of the models, and the sequence keys at the
    models' first rows and at the last sequence."""
    X = np.column_stack([rows[f].to_numpy() for f in features]).astype(float)
    starts = np.flatnonzero(_changes(rows, seq_cols))
    runs = np.flatnonzero(_changes(rows, model_cols)) if model_cols else np.zeros(1, np.int64)
    return X, starts, runs, rows.select(seq_cols).take(np.append(runs, starts[-1]))


def _in_order(rows: pa.Table) -> pa.Table:
    at = rows[AT_COL].to_numpy()
    return rows.take(np.argsort(at, kind="stable")) if len(at) > 1 and (np.diff(at) < 0).any() else rows


class _Chunk:
    """A chunk (its rows, or its row of ``pack_chunks``) with its models."""

    def __init__(self, rows: pa.Table, side: pa.Table, seq_cols, model_cols, features, k):
        d = len(features)
        if PACKED_COLS[0] in rows.column_names:
            X, self.starts, self.runs = (rows[c].combine_chunks().flatten().to_numpy() for c in PACKED_COLS[:3])
            heads = rows[PACKED_COLS[3]].combine_chunks().flatten()
            self.X = X.reshape(-1, d)
            self.heads = pa.table({c: heads.field(c) for c in seq_cols})
        else:
            self.rows = _in_order(rows)
            self.X, self.starts, self.runs, self.heads = _parts(self.rows, seq_cols, model_cols, features)
        self.n, self.k = len(self.X), k
        models = side.filter(pc.is_valid(side["pi"]))
        at_model = {tuple(r.values()): i for i, r in enumerate(models.select(model_cols).to_pylist())} if model_cols \
            else {(): 0} if models.num_rows else {}
        keys = [tuple(r.values()) for r in self.heads.select(model_cols).slice(0, len(self.runs)).to_pylist()] \
            if model_cols else [()]
        missing = next((key for key in keys if key not in at_model), None)
        if missing is not None:
            raise KeyError(f"the model table has no model for {dict(zip(model_cols, missing))}")
        models = models.take([at_model[key] for key in keys])
        self.A, self.pi = _stack(models["trans"], (k, k)), _stack(models["pi"], (k,))
        self.means, self.var = _stack(models["means"], (k, d)), _stack(models["vars"], (k, d))
        self.ends = np.append(self.runs[1:], self.n)
        self.scale = [(m, s) for m, s in zip(models["scale_mean"].to_pylist(), models["scale_std"].to_pylist())]

    def model_at(self, rows: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.runs, rows, side="right") - 1

    def scored(self, a: int, b: int):
        """Rows [a, b): the features as their models see them, and (k, b - a)
        emission log-densities."""
        X, E = self.X[a:b].copy(), np.empty((self.k, b - a))
        for i in range(self.model_at(a), self.model_at(b - 1) + 1):
            part = slice(max(a, self.runs[i]) - a, min(b, self.ends[i]) - a)
            if self.scale[i][0] is not None:
                X[part] -= np.array(self.scale[i][0])
                X[part] /= np.array(self.scale[i][1])
            E[:, part] = _emission_log(X[part], self.means[i], self.var[i]).T
        return X, E

    def border_pieces(self) -> list[tuple[int, int, int]]:
        """(which, from, to): the piece that may go on from the chunk before
        and, unless it is the same, the one that may go on in the next."""
        if len(self.starts) == 1:
            return [(0, 0, self.n)]
        return [(0, 0, int(self.starts[1])), (1, int(self.starts[-1]), self.n)]


class _Chain:
    """Rows [a, b) of a chunk cut into segments: sequences, the longer ones in
    parts of ``STEP`` rows.  ``first``: row a starts a sequence.

    Values of rows are laid out by the place in their segment, longest segment
    first: those of step t stand together, in the same order at each step, and
    the segments that have a row t are the first ``widths[t]``."""

    def __init__(self, c: _Chunk, a: int, b: int, first: bool):
        self.n, self.k = b - a, c.k
        heads = np.append(0, c.starts[(c.starts > a) & (c.starts < b)] - a)
        sizes = np.diff(np.append(heads, self.n))
        parts = -(-sizes // STEP)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        self.at = np.repeat(heads, parts) + nth * STEP              # first row of each segment
        length = np.minimum(np.repeat(sizes, parts) - nth * STEP, STEP)
        self.S = len(length)
        self.opens = nth == 0                                       # starts a sequence
        self.opens[0] = first
        self.goes_on = np.append(~self.opens[1:], False)            # the next segment is of the same sequence
        self.order = np.argsort(-length, kind="stable")
        self.widths = np.searchsorted(-length[self.order], -np.arange(length.max()))
        self.offsets = np.cumsum(self.widths) - self.widths
        by_length = self.at[self.order]
        self.row = np.concatenate([by_length[:w] + t for t, w in enumerate(self.widths)])
        model = c.model_at(a + by_length)
        self.A, self.pi = np.moveaxis(c.A[model], 0, 2).copy(), c.pi[model].T.copy()
        self.new = self.opens[self.order]
        self.X, E = c.scored(a, b)                                  # X in the order of the rows
        self.E = np.take(E, self.row, axis=1)
        self.peak = self.E.max(axis=0)
        self.W = np.subtract(self.E, self.peak, out=E)
        np.exp(self.W, out=self.W)

    def flat(self, x: np.ndarray) -> np.ndarray:
        """A layout's values in the order of the rows."""
        out = np.empty_like(x)
        out[..., self.row] = x
        return out

    def steps(self):
        """(t, first place, width) of the steps."""
        return list(zip(range(len(self.widths)), self.offsets.tolist(), self.widths.tolist()))

    def linked(self, every: bool) -> np.ndarray:
        """Places of the segments whose transfers are asked for: those of
        sequences that have several, or every one."""
        return np.flatnonzero((~self.opens | self.goes_on)[self.order] | every)

    # sums of paths
    def transfers(self, every: bool = False):
        """Per segment (k + 1, k) row-normalised weights from the state before
        it (row k: from a sequence start) to the state at its end, and the
        logarithms of their row sums.  Zero where not ``linked``."""
        k, own = self.k, self.linked(every)
        A, pi, new = self.A[:, :, own], self.pi[:, own], self.new[own]
        now, sums = np.zeros((k + 1, k, len(own))), np.zeros((k + 1, len(own)))
        for t, o, w in self.steps():
            m = int(np.searchsorted(own, w))
            if not m:
                break
            at = o + own[:m]
            if t == 0:
                Q = np.concatenate([A, pi[None]])
                Q[:, :, new] = pi[None][:, :, new]
            else:
                Q = np.einsum("ris,ijs->rjs", now[:, :, :m], A[:, :, :m])
            Q *= self.W[:, at]
            total = Q.sum(axis=1)
            sums[:, :m] += _safe_log(total) + self.peak[at]
            now[:, :, :m] = Q / np.where(total > 0, total, 1.0)[:, None, :]
        P, scale = np.zeros((self.S, k + 1, k)), np.zeros((self.S, k + 1))
        P[self.order[own]], scale[self.order[own]] = np.moveaxis(now, 2, 0), sums.T
        return P, scale

    def carried(self, P, scale, into: np.ndarray) -> np.ndarray:
        """The forward vector that enters each segment that goes on."""
        out = np.full((self.S, self.k), 1.0 / self.k)
        out[0] = into
        for s in np.flatnonzero(self.goes_on):
            out[s + 1] = _through(out[s][None], np.zeros(1), P[s], scale[s])[0][0]
        return out

    def forward(self, entering: np.ndarray):
        """Layouts: filtered probabilities, those of the row before in the
        sequence (none: 0), the predicted ones, and log normalisers."""
        alpha, prev, pred = (np.empty((self.k, self.n)) for _ in range(3))
        total = np.empty(self.n)
        now = entering[self.order].T.copy()
        now[:, self.new] = 0.0
        for t, o, w in self.steps():
            here = slice(o, o + w)
            prev[:, here] = now[:, :w]
            nxt = np.einsum("ijs,is->js", self.A[:, :, :w], now[:, :w])
            if t == 0:
                nxt[:, self.new] = self.pi[:, self.new]
            pred[:, here] = nxt
            nxt *= self.W[:, here]
            total[here] = nxt.sum(axis=0)
            now = nxt / total[here]
            alpha[:, here] = now
        return alpha, prev, pred, _safe_log(total) + self.peak

    def backward(self, P, scale, after: np.ndarray) -> np.ndarray:
        """Layout of the normalised backward vectors; ``after`` is that of the
        last row."""
        ends = np.full((self.S, self.k), 1.0 / self.k)
        ends[-1] = after
        for s in np.flatnonzero(self.goes_on)[::-1]:
            ends[s] = _before(P[s + 1], scale[s + 1], ends[s + 1])
        beta = np.empty((self.k, self.n))
        now, following = ends[self.order].T.copy(), None
        for _, o, w in reversed(self.steps()):
            if following:
                p, v = following                            # segments with a next row
                before = np.einsum("ijs,js->is", self.A[:, :, :v], self.W[:, p:p + v] * now[:, :v])
                now[:, :v] = before / before.sum(axis=0)
            beta[:, o:o + w] = now[:, :w]
            following = o, w
        return beta

    # best paths
    def best_transfers(self, every: bool = False) -> np.ndarray:
        """Per segment (k + 1, k) best log weight from the state before it (row
        k: from a sequence start) to the state at its end.  Zero where not
        ``linked``."""
        k, own = self.k, self.linked(every)
        logA, logpi, new = _safe_log(self.A[:, :, own]), _safe_log(self.pi[:, own]), self.new[own]
        now = np.zeros((k + 1, k, len(own)))
        for t, o, w in self.steps():
            m = int(np.searchsorted(own, w))
            if not m:
                break
            if t == 0:
                N = np.concatenate([logA, logpi[None]])
                N[:, :, new] = logpi[None][:, :, new]
            else:
                N = np.max(now[:, :, None, :m] + logA[None, :, :, :m], axis=1)
            now[:, :, :m] = N + self.E[:, o + own[:m]]
        M = np.zeros((self.S, k + 1, k))
        M[self.order[own]] = np.moveaxis(now, 2, 0)
        return M

    def states(self, M: np.ndarray, into: np.ndarray, end: int) -> np.ndarray:
        """The best state of each row, given the log weights ``into`` of the
        state before the chain and the state of its last row.  Ties go to the
        lowest state."""
        entering = np.zeros((self.S, self.k))
        entering[0] = into
        for s in np.flatnonzero(self.goes_on):
            best = np.max(entering[s][:, None] + M[s][:self.k], axis=0)
            entering[s + 1] = best - best.max()
        logA, logpi = _safe_log(self.A), _safe_log(self.pi)
        now, back = entering[self.order].T.copy(), np.zeros((self.k, self.n), np.int64)
        for t, o, w in self.steps():
            cand = now[:, None, :w] + logA[:, :, :w]
            back[:, o:o + w] = np.argmax(cand, axis=0)
            best = cand.max(axis=0)
            if t == 0:
                best[:, self.new] = logpi[:, self.new]
            best += self.E[:, o:o + w]
            now[:, :w] = best - best.max(axis=0)
        # the state before a segment as a function of the state at its end
        trace = np.tile(np.arange(self.k)[:, None], (1, self.S))
        for _, o, w in reversed(self.steps()):
            trace[:, :w] = np.take_along_axis(back[:, o:o + w], trace[:, :w], axis=0)
        place = np.argsort(self.order)
        cur = now.argmax(axis=0)[place]
        cur[-1] = end
        for s in np.flatnonzero(self.goes_on)[::-1]:
            cur[s] = trace[cur[s + 1], place[s + 1]]
        cur, out = cur[self.order], np.zeros(self.n, np.int32)
        for _, o, w in reversed(self.steps()):
            out[o:o + w] = cur[:w]
            cur[:w] = back[cur[:w], o + np.arange(w)]
        return self.flat(out)


def _safe_log(p):
    with np.errstate(divide="ignore"):
        return np.log(p)


def _through(v, scale, P, p_scale):
    """Rows ``v`` (normalised, log sums ``scale``) carried through a transfer."""
    k = P.shape[1]
    top = p_scale[:k].max()
    top = top if np.isfinite(top) else 0.0
    out = v @ (np.exp(p_scale[:k] - top)[:, None] * P[:k])
    total = out.sum(axis=1)
    return out / np.where(total > 0, total, 1.0)[:, None], scale + _safe_log(total) + top


def _before(P, p_scale, after):
    """The normalised backward vector before a transfer."""
    k = P.shape[1]
    top = p_scale[:k].max()
    out = np.exp(p_scale[:k] - (top if np.isfinite(top) else 0.0)) * (P[:k] @ after)
    return out / out.sum()


# -------------------------------------------------------------------- pass 1
def _piece_rows(c: _Chunk, best: bool):
    for which, a, b in c.border_pieces():
        chain = _Chain(c, a, b, first=which == 1)
        if best:
            M = chain.best_transfers(every=True)
            rows = M[0]
            for s in range(1, chain.S):
                rows = np.max(rows[:, :, None] + M[s][None, :c.k], axis=1)
            yield which, a, rows, np.zeros(c.k + 1)
        else:
            P, scale = chain.transfers(every=True)
            rows, sums = P[0], scale[0]
            for s in range(1, chain.S):
                rows, sums = _through(rows, sums, P[s], scale[s])
            yield which, a, rows, sums


# -------------------------------------------------------------------- pass 2
def _fold_pieces(pieces: pa.Table, k: int, best: bool) -> dict:
    """What enters each piece of one sequence, pieces in order."""
    B = pieces.num_rows
    R, scale = _stack(pieces["rows"], (k + 1, k)), _stack(pieces["sums"], (k + 1,))
    carry, after = np.full((B, k), 1.0 / k), np.full((B, k), 1.0 / k)
    entry, end = np.full(B, -1, np.int64), np.zeros(B, np.int64)
    if best:
        delta, came = R[0, k], np.zeros((B, k), np.int64)
        for b in range(1, B):
            cand = delta[:, None] + R[b, :k]
            came[b] = np.argmax(cand, axis=0)
            delta = cand.max(axis=0)
        end[-1] = np.argmax(delta)
        for b in range(B - 1, 0, -1):
            entry[b] = end[b - 1] = came[b, end[b]]
    else:
        v = R[0, k][None]
        for b in range(1, B):
            carry[b] = v[0]
            v, _ = _through(v, np.zeros(1), R[b], scale[b])
        for b in range(B - 1, 0, -1):
            after[b - 1] = _before(R[b], scale[b], after[b])
    return {"carry_in": list(carry), "beta_out": list(after), "entry_state": entry, "end_state": end,
            "is_first": np.arange(B) == 0}


CARRY_COLS = [T.StructField("which", T.IntegerType()), T.StructField("is_first", T.BooleanType()),
              T.StructField("carry_in", T.ArrayType(T.DoubleType())), T.StructField("beta_out", T.ArrayType(T.DoubleType())),
              T.StructField("entry_state", T.LongType()), T.StructField("end_state", T.LongType())]


# -------------------------------------------------------------------- pass 3
class _Entered:
    """A chunk's chain with what enters it from both sides."""

    def __init__(self, c: _Chunk, side: pa.Table):
        found = {r["which"]: r for r in side.filter(pc.is_valid(side["which"])).to_pylist()}
        left, right = found[0], found[max(found)]
        self.c, self.first = c, left["is_first"]
        self.chain = _Chain(c, 0, c.n, first=self.first)
        self.carry_in, self.after = np.array(left["carry_in"]), np.array(right["beta_out"])
        self.entry, self.end = left["entry_state"], right["end_state"]

    def filtered(self):
        """Filtered probabilities (n, k) and log normalisers of the rows."""
        P, scale = self.chain.transfers()
        alpha, _, _, norm = self.chain.forward(self.chain.carried(P, scale, self.carry_in))
        return self.chain.flat(alpha).T, self.chain.flat(norm)

    def best_states(self):
        into = np.zeros(self.c.k)
        if not self.first:
            into[:] = -np.inf
            into[self.entry] = 0.0
        return self.chain.states(self.chain.best_transfers(), into, self.end)

    def stats(self) -> np.ndarray:
        """Per model of the chunk one row: s0, s1, s2, xi, pi, log-likelihood
        (see ``_split_stats``)."""
        c, chain = self.c, self.chain
        P, scale = chain.transfers()
        alpha, prev, pred, norm = chain.forward(chain.carried(P, scale, self.carry_in))
        beta = chain.backward(P, scale, self.after)
        # in place: fresh memory for each of these costs as much as the sums
        g = np.multiply(alpha, beta, out=alpha)
        g /= g.sum(axis=0)
        right = np.multiply(chain.W, beta, out=beta)
        total = np.multiply(pred, right, out=pred).sum(axis=0)
        left = np.divide(prev, np.where(total > 0, total, 1.0), out=prev)
        # of a row's transitions: left[i] * A[i, j] * right[j]
        features, opening = chain.X, np.zeros(c.n)
        opening[chain.at[chain.opens]] = 1.0
        if len(c.runs) > 1:     # the rows of a model together
            g, left, right, norm = (chain.flat(x) for x in (g, left, right, norm))
        else:
            features, opening = features[chain.row], opening[chain.row]
        out = []
        for i, (a, b) in enumerate(zip(c.runs, c.ends)):
            X, w = features[a:b], g[:, a:b]
            xi = c.A[i] * (left[:, a:b] @ right[:, a:b].T)
            out.append(np.concatenate([w.sum(axis=1), (w @ X).ravel(), (w @ (X * X)).ravel(), xi.ravel(),
                                       w @ opening[a:b], [norm[a:b].sum()]]))
        return np.array(out)


def _split_stats(S: np.ndarray, k: int, d: int):
    """(s0, s1, s2, xi, pi, log-likelihood) of rows of ``stats``."""
    cuts = np.cumsum([k, k * d, k * d, k * k, k])
    s0, s1, s2, xi, pi, ll = np.split(S, cuts, axis=1)
    return s0, s1.reshape(-1, k, d), s2.reshape(-1, k, d), xi.reshape(-1, k, k), pi, ll[:, 0]


def n_stats(k: int, d: int) -> int:
    return k + 2 * k * d + k * k + k + 1


# ------------------------------------------------------------- Spark passes
def _fields(df: DataFrame, cols) -> list[T.StructField]:
    packed = PACKED_COLS[3] in df.columns
    schema = df.schema[PACKED_COLS[3]].dataType.elementType if packed else df.schema
    return [schema[c] for c in cols]


def pack_chunks(seqs: DataFrame, model_cols: list[str], seq_cols: list[str], features: list[str]) -> DataFrame:
    """The chunked table with a row per chunk for EM, which reads it at every
    step: features, first rows of sequences and models, and the sequence keys
    at the models' first rows and at the last sequence, as arrays.  Written
    once, partitioned and sorted by chunk."""
    ship_package(seqs.sparkSession)
    cols = list(dict.fromkeys([CHUNK_COL, AT_COL, *seq_cols, *features]))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField(CHUNK_COL, T.LongType()), T.StructField(PACKED_COLS[0], T.ArrayType(T.DoubleType())),
                           T.StructField(PACKED_COLS[1], ints), T.StructField(PACKED_COLS[2], ints),
                           T.StructField(PACKED_COLS[3], T.ArrayType(T.StructType(_fields(seqs, seq_cols))))])
    out = to_arrow_schema(schema)

    def pack(rows: pa.Table) -> pa.Table:
        X, starts, runs, heads = _parts(_in_order(rows), seq_cols, model_cols, features)
        heads = pa.StructArray.from_arrays([heads[c].combine_chunks() for c in seq_cols], names=list(seq_cols))
        arrays = [pa.array(X.ravel()), pa.array(starts, pa.int32()), pa.array(runs, pa.int32()), heads]
        lists = [pa.ListArray.from_arrays(np.array([0, len(x)], np.int32), x) for x in arrays]
        return pa.table([rows[CHUNK_COL].slice(0, 1), *lists], names=out.names).cast(out)
    packed = seqs.select(*cols).groupBy(CHUNK_COL).applyInArrow(pack, schema)
    # a task's start costs more than a packed chunk, so a few partitions to a core are enough
    n = min(seqs.rdd.getNumPartitions(), 3 * seqs.sparkSession.sparkContext.defaultParallelism)
    return cut_lineage_partitioned(packed.repartition(n, CHUNK_COL).sortWithinPartitions(CHUNK_COL))


def chunk_keys(seqs: DataFrame, model_cols: list[str]) -> DataFrame:
    """(chunk, model key) of the chunked table: no shuffle, a chunk is in one
    partition."""
    if PACKED_COLS[3] in seqs.columns:
        seqs = seqs.select(CHUNK_COL, F.inline(PACKED_COLS[3]))
    return seqs.select(F.col(CHUNK_COL).alias(OF_COL), *[F.col(c).alias(c) for c in model_cols]).distinct()


def _chunk_params(keys: DataFrame, models: Models) -> DataFrame:
    """The parameters that each chunk needs, a row per chunk and model."""
    table = models.df.select(*models.model_cols, *PARAM_COLS)
    if not models.model_cols:
        return keys.crossJoin(F.broadcast(table))       # one row
    same = F.lit(True)
    for c in models.model_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    table = table.select(*[F.col(c).alias(f"__{c}") for c in models.model_cols], *PARAM_COLS)
    return keys.join(table, same).select(*keys.columns, *PARAM_COLS)


def _by_chunk(seqs: DataFrame, side: DataFrame, fn: Callable, schema: T.StructType) -> DataFrame:
    ship_package(seqs.sparkSession)
    out = to_arrow_schema(schema)

    def run(rows: pa.Table, with_it: pa.Table) -> pa.Table:
        cols = fn(rows, with_it) if rows.num_rows else {f: [] for f in out.names}
        return pa.table([pa.array(cols[f.name], f.type) if not isinstance(cols[f.name], (pa.Array, pa.ChunkedArray))
                         else cols[f.name] for f in out], schema=out)
    return seqs.groupBy(CHUNK_COL).cogroup(side.groupBy(OF_COL)).applyInArrow(run, schema)


def _piece_carries(seqs: DataFrame, params: DataFrame, models: Models, seq_cols, best: bool) -> DataFrame:
    """Passes 1 and 2: what enters the border pieces of each chunk."""
    k, model_cols, features = models.k, models.model_cols, models.features
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([*_fields(seqs, seq_cols), T.StructField(CHUNK_COL, T.LongType()), T.StructField("which", T.IntegerType()),
                           T.StructField("rows", doubles), T.StructField("sums", doubles)])

    def pieces(rows, side):
        c = _Chunk(rows, side, seq_cols, model_cols, features, k)
        found = list(_piece_rows(c, best))
        at = c.heads.take([0, c.heads.num_rows - 1][:len(found)])
        return {**{s: at[s] for s in seq_cols}, CHUNK_COL: [rows[CHUNK_COL][0].as_py()] * len(found),
                "which": [w for w, *_ in found],
                "rows": [r.ravel() for _, _, r, _ in found], "sums": [s for *_, s in found]}
    summaries = _by_chunk(seqs, params, pieces, schema)
    carry_schema = T.StructType([T.StructField(OF_COL, T.LongType()), *CARRY_COLS])
    out = to_arrow_schema(carry_schema)

    def fold(group: pa.Table) -> pa.Table:
        group = group.sort_by([(CHUNK_COL, "ascending"), ("which", "ascending")])
        cols = {OF_COL: group[CHUNK_COL], "which": group["which"], **_fold_pieces(group, k, best)}
        return pa.table([cols[f.name] if isinstance(cols[f.name], pa.ChunkedArray) else pa.array(cols[f.name], f.type)
                         for f in out], schema=out)
    return summaries.groupBy(*seq_cols).applyInArrow(fold, carry_schema)


def _run(seqs: DataFrame, params: "HMMParams | Models", seq_cols, fn, schema, best: bool = False,
         keys: DataFrame | None = None) -> DataFrame:
    """All three passes; ``fn`` turns an entered chunk into output columns."""
    models = _models(seqs, params)
    k, model_cols, features = models.k, models.model_cols, models.features
    if list(seq_cols[:len(model_cols)]) != list(model_cols):
        raise ValueError("seq_cols must start with the model columns")
    per_chunk = _chunk_params(chunk_keys(seqs, model_cols) if keys is None else keys, models)
    carries = _piece_carries(seqs, per_chunk, models, seq_cols, best)
    side = per_chunk.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in CARRY_COLS]).unionByName(
        carries.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in [*_fields(seqs, model_cols), *_PARAMS]]))

    def chunk(rows, with_it):
        return fn(_Entered(_Chunk(rows, with_it, seq_cols, model_cols, features, k), with_it))
    return _by_chunk(seqs, side, chunk, schema)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))


# --------------------------------------------------------------- public API
def filtered_probabilities(seqs: DataFrame, params: "HMMParams | Models", seq_cols, order_cols, features=None) -> DataFrame:
    """HMM-3: p(state_t | x_1..t) per row, as columns p_0..p_{k-1}, and the
    per-step log normaliser (their sum per sequence is its log-likelihood)."""
    cols = list(dict.fromkeys([*seq_cols, *order_cols]))
    schema = T.StructType([*_fields(seqs, cols), T.StructField("probs", T.ArrayType(T.DoubleType())),
                           T.StructField("step_loglik", T.DoubleType())])

    def fn(e: _Entered):
        alpha, norm = e.filtered()
        return {**{c: e.c.rows[c] for c in cols}, "probs": _lists(alpha), "step_loglik": norm}
    out = _run(seqs, params, seq_cols, fn, schema)
    return out.select(*cols, *[F.col("probs")[i].alias(f"p_{i}") for i in range(params.k)], "step_loglik")


def viterbi(seqs: DataFrame, params: "HMMParams | Models", seq_cols, order_cols, features=None) -> DataFrame:
    """HMM-2: most likely state per row (ties -> lowest state)."""
    cols = list(dict.fromkeys([*seq_cols, *order_cols]))
    schema = T.StructType([*_fields(seqs, cols), T.StructField("state", T.IntegerType())])
    return _run(seqs, params, seq_cols, lambda e: {**{c: e.c.rows[c] for c in cols}, "state": e.best_states()}, schema, best=True)


def sequence_loglik(seqs: DataFrame, params: "HMMParams | Models", seq_cols, order_cols=None, features=None) -> DataFrame:
    """Log-likelihood and number of rows of each sequence."""
    schema = T.StructType([*_fields(seqs, seq_cols), T.StructField("log_likelihood", T.DoubleType()), T.StructField("n", T.LongType())])

    def fn(e: _Entered):
        starts = e.c.starts
        at = e.c.rows.take(starts)
        return {**{s: at[s] for s in seq_cols}, "log_likelihood": np.add.reduceat(e.filtered()[1], starts),
                "n": np.diff(np.append(starts, e.c.n))}
    parts = _run(seqs, params, seq_cols, fn, schema)
    return parts.groupBy(*seq_cols).agg(F.sum("log_likelihood").alias("log_likelihood"), F.sum("n").alias("n"))


def model_metrics(seqs: DataFrame, params: HMMParams, seq_cols, order_cols=None, features=None) -> DataFrame:
    """HMM-4: total log-likelihood, AIC = -2L + 2p, BIC = -2L + ln(n) p with
    n the number of rows; one row."""
    p = params.n_params()
    per = sequence_loglik(seqs, params, seq_cols)
    tot = per.agg(F.sum("log_likelihood").alias("log_likelihood"), F.sum("n").alias("n_samples"))
    L = F.col("log_likelihood")
    return tot.select(L.alias("log_likelihood"),
                      (-2 * L + 2 * p).alias("aic"),
                      (-2 * L + F.log(F.col("n_samples").cast("double")) * p).alias("bic"),
                      F.lit(params.k).alias("n_regimes"), F.col("n_samples"),
                      F.lit(params.d).alias("n_features"))


# ------------------------------------------------------------------------ EM
def expected_stats(seqs: DataFrame, params: "HMMParams | Models", seq_cols, keys: DataFrame | None = None) -> DataFrame:
    """E-step: one row per model, its key and ``stats`` (array, see
    ``_split_stats``), summed over its sequences.  ``seqs``: the chunked table
    or that of ``pack_chunks``."""
    models = _models(seqs, params)
    k, d, model_cols = models.k, len(models.features), models.model_cols
    schema = T.StructType([*_fields(seqs, model_cols), T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def fn(e: _Entered):
        at = e.c.heads.slice(0, len(e.c.runs))
        return {**{c: at[c] for c in model_cols}, "stats": _lists(e.stats())}
    parts = _run(seqs, models, seq_cols, fn, schema, keys=keys)
    sums = [F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(n_stats(k, d))]
    each = parts.groupBy(*model_cols).agg(*sums)
    return each.select(*model_cols, F.array(*[f"s{i}" for i in range(n_stats(k, d))]).alias("stats"))


FIT_COLS = [T.StructField("log_likelihood", T.DoubleType()), T.StructField("history", T.ArrayType(T.DoubleType())),
            T.StructField("iterations", T.IntegerType()), T.StructField("converged", T.BooleanType())]


def m_step(models: Models, stats: DataFrame, tol: float = 1e-6, var_floor: float = 1e-3) -> Models:
    """The next parameters of each model from its statistics, as rows.  A
    model that has converged keeps its parameters; one converges when its
    log-likelihood changed by at most ``tol`` of itself since the last step."""
    k, d, keys = models.k, len(models.features), models.model_cols
    named = stats.select(*[F.col(c).alias(f"__{c}") for c in keys], "stats")
    if keys:
        same = F.lit(True)
        for c in keys:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        both = models.df.join(named, same, "left")
    else:
        both = models.df.crossJoin(F.broadcast(named))      # one row each
    schema = T.StructType([*_fields(models.df, keys), *_PARAMS, *FIT_COLS])
    out = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                if r["converged"] or r["stats"] is None:
                    r["converged"] = True
                    continue
                s0, s1, s2, xi, start, ll = (x[0] for x in _split_stats(np.array([r["stats"]]), k, d))
                pi = np.maximum(start / start.sum() if start.sum() > 0 else np.array(r["pi"]), 1e-12)
                total = xi.sum(axis=1, keepdims=True)
                A = np.where(total > 0, xi / np.where(total > 0, total, 1.0), np.array(r["trans"]).reshape(k, k))
                A = np.maximum(A, 1e-12)
                weight = np.maximum(s0, 1e-12)[:, None]
                means = s1 / weight
                var = np.maximum(s2 / weight - means ** 2, var_floor)
                before, now = r["log_likelihood"], float(ll)
                r |= {"pi": (pi / pi.sum()).tolist(), "trans": (A / A.sum(axis=1, keepdims=True)).ravel().tolist(),
                      "means": means.ravel().tolist(), "vars": var.ravel().tolist(), "log_likelihood": now,
                      "history": [*(r["history"] or []), now], "iterations": r["iterations"] + 1,
                      "converged": before is not None and abs(now - before) <= tol * max(1.0, abs(before))}
            yield pa.RecordBatch.from_pylist([{f: r[f] for f in out.names} for r in rows], schema=out)
    return Models(both.mapInArrow(run, schema), keys, k, models.features)


def initial_models(seqs: DataFrame, k: int, features: list[str], model_cols: list[str] | None = None,
                   scale: bool = True, stay: float = 0.9) -> Models:
    """Deterministic start of each model from the rows of its key: state s
    takes the ((s + 0.5) / k) quantile of each feature as its mean, unit
    variance, uniform start, ``stay`` on the diagonal.  ``scale``: features are
    standardised by the key's own mean and population deviation (0 -> 1)."""
    keys = list(model_cols or [])
    at = [(s + 0.5) / k for s in range(k)]
    found = seqs.groupBy(*keys).agg(
        *[F.percentile_approx(f, at, 10000).alias(f"_q_{i}") for i, f in enumerate(features)],
        *[F.avg(f).alias(f"_m_{i}") for i, f in enumerate(features)],
        *[F.stddev_pop(f).alias(f"_s_{i}") for i, f in enumerate(features)])
    d, one = range(len(features)), F.lit(1.0)
    mean = [F.col(f"_m_{i}") if scale else F.lit(0.0) for i in d]
    std = [F.when(F.col(f"_s_{i}") > 0, F.col(f"_s_{i}")).otherwise(one) if scale else one for i in d]
    moved = (1 - stay) / (k - 1) if k > 1 else 0.0
    empty = F.lit(None).cast("array<double>")
    df = found.where(F.col("_q_0").isNotNull()).select(
        *keys, F.array(*[F.lit(1.0 / k)] * k).alias("pi"),
        F.array(*[F.lit((stay if k > 1 else 1.0) if i == j else moved) for i in range(k) for j in range(k)]).alias("trans"),
        F.array(*[(F.col(f"_q_{i}")[s] - mean[i]) / std[i] for s in range(k) for i in d]).alias("means"),
        F.array(*[one] * (k * len(features))).alias("vars"),
        (F.array(*mean) if scale else empty).alias("scale_mean"), (F.array(*std) if scale else empty).alias("scale_std"),
        F.lit(None).cast("double").alias("log_likelihood"), empty.alias("history"), F.lit(0).alias("iterations"),
        F.lit(False).alias("converged"))
    return Models(df, keys, k, list(features))


def fit_models(seqs: DataFrame, model_cols: list[str], seq_cols: list[str], features: list[str], k: int = 4,
               max_iter: int = 200, tol: float = 1e-6, scale: bool = True) -> Models:
    """HMM-1: EM fits of one model per key of ``model_cols`` (none: one for
    all), every model in the same jobs, over a table of ``prepare_sequences``.

    Each model starts, is scaled and converges by its own rows, so it equals
    a fit of those alone.  The loop ends when every model has converged;
    models that have not after ``max_iter`` steps say so in ``converged``.
    The driver sees one count per step.
    """
    models = initial_models(seqs, k, features, model_cols, scale)
    models.df = cut_lineage(models.df)
    packed = pack_chunks(seqs, models.model_cols, seq_cols, features)
    keys = cut_lineage_partitioned(chunk_keys(packed, models.model_cols))
    for _ in range(max_iter):
        models = m_step(models, expected_stats(packed, models, seq_cols, keys), tol)
        models.df = cut_lineage(models.df)
        if models.df.where(~F.col("converged")).isEmpty():
            break
    return models


def fit(df: DataFrame, seq_cols: list[str], order_cols: list[str], features: list[str], k: int = 4,
        max_iter: int = 200, tol: float = 1e-6, scale: bool = True, chunk_rows: int = CHUNK):
    """HMM-1, one pooled model over all sequences: (params, log-likelihood
    before each step); ``params.converged`` tells whether EM did."""
    seqs = prepare_sequences(df, seq_cols, order_cols, features, chunk_rows)
    found = fit_models(seqs, [], seq_cols, features, k, max_iter, tol, scale)
    return found.one(), list(found.df.first()["history"])


def fit_by_model(df: DataFrame, model_cols: list[str], seq_cols: list[str], order_cols: list[str],
                 features: list[str], k: int = 4, max_iter: int = 200, tol: float = 1e-6,
                 chunk_rows: int = CHUNK) -> Models:
    """HMM-1, one model per model key (see ``fit_models``).  ``seq_cols`` must
    start with ``model_cols``."""
    if list(seq_cols[:len(model_cols)]) != list(model_cols):
        raise ValueError("seq_cols must start with model_cols")
    seqs = prepare_sequences(df, seq_cols, order_cols, features, chunk_rows)
    return fit_models(seqs, model_cols, seq_cols, features, k, max_iter, tol)


def scale_features(df: DataFrame, params: HMMParams, features: list[str]) -> DataFrame:
    """``df`` with the features as the model sees them (the passes scale by
    themselves)."""
    if params.scaler_mean is None:
        return df
    return df.select(*[c for c in df.columns if c not in features],
                     *[((F.col(f) - F.lit(float(params.scaler_mean[i]))) / F.lit(float(params.scaler_std[i])))
                       .alias(f) for i, f in enumerate(features)])


# -------------------------------------------------------- tables of results
def stationary(A: np.ndarray, iters: int = 10_000, tol: float = 1e-13) -> np.ndarray:
    """HMM-7 for one k x k matrix (driver-side helper for a fitted model):
    power iteration on the lazy chain (I + A) / 2."""
    k = A.shape[0]
    L = 0.5 * (np.eye(k) + A)
    p = np.full(k, 1.0 / k)
    for _ in range(iters):
        q = p @ L
        if np.abs(q - p).max() < tol:
            p = q
            break
        p = q
    return p / p.sum()


def transition_rows(models: DataFrame, model_col: str, trans_col: str, k: int) -> DataFrame:
    """HMM-6: models table with a nested k x k array -> (model, from, to, p)."""
    e = models.select(model_col, F.posexplode(trans_col).alias("from_state", "row"))
    e2 = e.select(model_col, "from_state", F.posexplode("row").alias("to_state", "p"))
    return e2.select(model_col, "from_state", regime_name(k, F.col("from_state")).alias("from_regime"),
                     "to_state", regime_name(k, F.col("to_state")).alias("to_regime"), "p")


def emission_rows(models: DataFrame, model_col: str, means_col: str, vars_col: str, k: int,
                  features: list[str]) -> DataFrame:
    """HMM-6: (model, state, regime, feature, mean, var)."""
    e = models.select(model_col, F.posexplode(F.arrays_zip(F.col(means_col).alias("m"),
                                                           F.col(vars_col).alias("v"))).alias("state", "mv"))
    feats = F.array(*[F.lit(f) for f in features])
    z = e.select(model_col, "state", F.posexplode(F.arrays_zip(F.col("mv.m").alias("m"), F.col("mv.v").alias("v")))
                 .alias("fi", "x"))
    return z.select(model_col, "state", regime_name(k, F.col("state")).alias("regime"),
                    F.element_at(feats, (F.col("fi") + 1).cast("int")).alias("feature"),
                    F.col("x.m").alias("mean"), F.col("x.v").alias("var"))


def stationary_column(trans, k: int, squarings: int = 48):
    """HMM-7 as a JVM expression on an array<array<double>> column: the
    lazy chain L = (I + P) / 2 squared ``squarings`` times (L^(2^n)); any
    row of the result is the stationary distribution.  Interpreted lambdas:
    use ``stationary_table`` for large model tables."""
    idx = F.sequence(F.lit(0), F.lit(k - 1))
    L = F.transform(idx, lambda i: F.transform(
        idx, lambda j: 0.5 * F.when(i == j, 1.0).otherwise(0.0) + 0.5 * trans[i][j]))

    def square(M, _):
        return F.transform(idx, lambda i: F.transform(idx, lambda j: F.aggregate(
            idx, F.lit(0.0), lambda acc, m: acc + M[i][m] * M[m][j])))
    Mn = F.aggregate(F.sequence(F.lit(1), F.lit(squarings)), L, square)
    row = Mn[0]
    total = F.aggregate(row, F.lit(0.0), lambda a, x: a + x)
    return F.transform(row, lambda x: x / total)


def stationary_table(models: DataFrame, key_cols: list[str], trans_col: str, k: int,
                     squarings: int = 60) -> DataFrame:
    """HMM-7 over a table of models (one k x k transition matrix per row):
    batched numpy repeated squaring of the lazy chain, one Arrow batch of
    models at a time.  Output: key columns + pi_0..pi_{k-1}."""
    schema = T.StructType([models.schema[c] for c in key_cols] +
                          [T.StructField(f"pi_{i}", T.DoubleType()) for i in range(k)])

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            P = np.stack([np.stack(r) for r in pdf[trans_col].to_numpy()]).astype(float)
            M = 0.5 * (np.eye(k)[None] + P)
            for _ in range(squarings):
                M = M @ M
            pi = M[:, 0, :]
            pi = pi / pi.sum(axis=1, keepdims=True)
            out = pdf[key_cols].copy()
            for i in range(k):
                out[f"pi_{i}"] = pi[:, i]
            yield out
    ship_package(models.sparkSession)
    return models.select(*key_cols, trans_col).mapInPandas(run, schema)
