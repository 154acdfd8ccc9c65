"""Mixture-controlled packing by deficit round-robin.

Every source is a queue of tokens (its documents one after the other, each
ended by one end id).  A window of ``size`` tokens is one round: each queue's
quantum is its share of ``size``, fractions are carried as the queue's deficit
from window to window.  Documents may be cut, so after w windows a queue has
given  C(w) = floor(w * quantum)  tokens, plus one for the queues with the
largest carried fractions until the windows are full.  That closed form is the
deficit carried at window w: any task can place any piece without knowing
what other tasks placed, and the same deficits hold across partitions.

When a queue runs dry the others share the windows that follow (a new phase);
phases are computed on the driver from one total per source.  With the
default targets, the sources' own token shares, all run dry together.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.session import cut_lineage

from .common import query, ship_package, table
from .tokens import WordTokenizer

SIZE = 2048
END_ID = 1
MAX_BROADCAST_BYTES = 32 << 20


# ------------------------------------------------------------------ schedule

CELLS = 1 << 20     # figures of (window, queue) that are held at once

@dataclass
class Phase:
    """Windows ``first`` to ``first + windows`` with fixed quanta.  ``num[q] /
    den`` is queue q's quantum; ``begin[q]`` is what it gave before."""
    first: int
    windows: int
    num: list[int]
    den: int
    begin: list[int]

    def step(self) -> int:
        """Windows whose figures of all queues are held at once."""
        return max(1, CELLS // max(1, len(self.num)))

    def given_by(self, w: np.ndarray, queue: int) -> np.ndarray:
        """Tokens one queue gave in the phase's first ``w`` windows."""
        n = self.step()
        return np.concatenate([w[:0], *[self.given(w[i:i + n])[:, queue] for i in range(0, len(w), n)]])

    def given(self, w: np.ndarray) -> np.ndarray:
        """Tokens each queue gave in the phase's first ``w`` windows: (len(w), queues)."""
        num = np.array(self.num, dtype=object) if self.windows * max(self.num) >= 2 ** 62 else np.array(self.num, np.int64)
        whole = w.astype(num.dtype)[:, None] * num[None, :]
        floor = (whole // self.den).astype(np.int64)
        carried = (whole % self.den).astype(np.float64 if num.dtype == object else np.int64)
        short = w * (sum(self.num) // self.den) - floor.sum(axis=1)
        rank = np.argsort(np.argsort(-carried, axis=1, kind="stable"), axis=1, kind="stable")
        return floor + (rank < short[:, None])


def queue_groups(totals: dict, targets: dict, size: int) -> list[list]:
    """Sources by queue.  A source with less than one token per window joins
    the next smallest queue, so that every quantum is at least one token."""
    whole = sum(targets[s] for s in totals)
    queues = [([s], Fraction(targets[s]) / whole) for s in sorted(totals, key=lambda s: (targets[s], s is None, str(s)))]
    while len(queues) > 1 and queues[0][1] * size < 1:
        (a, x), (b, y) = queues[0], queues[1]
        queues = sorted([(a + b, x + y), *queues[2:]], key=lambda q: (q[1], str(q[0])))
    return sorted((sorted(q, key=lambda s: (s is None, str(s))) for q, _ in queues), key=str)


def plan(queue_totals: list[int], shares: list[Fraction], size: int = SIZE) -> list[Phase]:
    """Phases until every queue is empty; the last window may be short."""
    left, begin, first, phases = list(queue_totals), [0] * len(queue_totals), 0, []
    while any(left):
        live = [s if n else Fraction(0) for s, n in zip(shares, left)]
        whole = sum(live)
        # shares as integers over one denominator, size tokens in all per window
        parts = [size * s / whole for s in live]
        den = 1
        for p in parts:
            den = math.lcm(den, p.denominator) if den < 2 ** 40 else den
        if any((p * den).denominator != 1 for p in parts):
            den = 2 ** 31
            num = [int(p * den) for p in parts]
            num[max(range(len(num)), key=num.__getitem__)] += size * den - sum(num)
        else:
            num = [int(p * den) for p in parts]
        # whole windows that every live queue can fill: its give is below w * quantum + 1
        full = min(max(0, (n - 1) * den // q) for n, q in zip(left, num) if q)
        if full < 1:   # less than one whole round is left of some queue: the short queues give all they have
            full = 1
            give = _last_round(left, num, size)
            phases.append(Phase(first, 1, give, 1, list(begin)))
        else:
            phases.append(Phase(first, full, num, den, list(begin)))
            give = [int(x) for x in phases[-1].given(np.array([full]))[0]]
        begin = [b + g for b, g in zip(begin, give)]
        left = [n - g for n, g in zip(left, give)]
        first += full
    return phases


def _last_round(left: list[int], num: list[int], size: int) -> list[int]:
    """One window in which some queue runs dry: quanta capped by what is left,
    the room that leaves going to the queues with most left."""
    whole = sum(num)
    give = [min(n, size * q // whole) for n, q in zip(left, num)]
    room = min(size, sum(left)) - sum(give)
    for i in sorted(range(len(left)), key=lambda i: (-(left[i] - give[i]), i)):
        more = min(room, left[i] - give[i])
        give[i] += more
        room -= more
    return give


class Layout:
    """Places token ranges of queues into windows."""

    BLOCK = 1 << 15

    def __init__(self, phases: list[Phase]):
        self.phases = phases
        self.ends = [[b + int(g) for b, g in zip(p.begin, p.given(np.array([p.windows]))[0])] for p in phases]

    @staticmethod
    def _window(p: Phase, queue: int, x: np.ndarray) -> np.ndarray:
        """The window of the phase that holds the queue's token ``x``."""
        about = x.astype(object) * p.den // p.num[queue] if p.den * int(x.max() + 1) >= 2 ** 62 else x * p.den // p.num[queue]
        about = about.astype(np.int64)
        best = np.maximum(about - 2, 0)
        for step in (-1, 0, 1):
            w = np.clip(about + step, 0, p.windows - 1)
            best = np.where(p.given_by(w, queue) <= x, np.maximum(best, w), best)
        return best

    def place(self, queue: int, start: np.ndarray, length: np.ndarray):
        """(which range, offset in range, length, window, offset in window)
        arrays, in blocks, for token ranges of one queue."""
        for p, ends in zip(self.phases, self.ends):
            lo = np.maximum(start, p.begin[queue])
            hi = np.minimum(start + length, ends[queue])
            which = np.nonzero(lo < hi)[0]
            if not len(which):
                continue
            base, upto = lo[which] - p.begin[queue], hi[which] - p.begin[queue]
            first, last = self._window(p, queue, base), self._window(p, queue, upto - 1)
            until = np.cumsum(last - first + 1)
            begins = until - (last - first + 1)
            block = min(self.BLOCK, p.step())
            for at in range(0, int(until[-1]), block):
                k = np.arange(at, min(int(until[-1]), at + block))
                of = np.searchsorted(until, k, "right")
                w = first[of] + k - begins[of]
                now, then = p.given(w), p.given(w + 1)
                from_, to = np.maximum(now[:, queue], base[of]), np.minimum(then[:, queue], upto[of])
                offset = (then - now)[:, :queue].sum(axis=1) + from_ - now[:, queue]
                some = to > from_
                doc = which[of]
                yield tuple(x[some] for x in (doc, from_ + p.begin[queue] - start[doc], to - from_, p.first + w, offset))


# ------------------------------------------------------------------ Spark

_TOKENS = "doc_id long, source string, part int, at long, n long, ids binary"


def tokenize(docs: DataFrame, make_tokenizer) -> DataFrame:
    """(doc_id, source, part, at, n, ids): the ids (16 or 32 bits each) of each
    document with its end id; ``at`` counts the tokens of the same source
    before it in its task's part of the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = make_tokenizer()
        seen: dict = {}
        part = TaskContext.get().partitionId()
        for b in batches:
            ids = [tok.encode(t or b"") for t in b.column("text").to_pylist()]
            sources = b.column("source").to_pylist()
            n = [len(x) // tok.width + 1 for x in ids]
            at = []
            for s, k in zip(sources, n):
                at.append(seen.get(s, 0))
                seen[s] = at[-1] + k
            end = END_ID.to_bytes(tok.width, "little")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(sources, pa.string()), pa.array([part] * len(n), pa.int32()),
                 pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array([x + end for x in ids], pa.binary())],
                names=["doc_id", "source", "part", "at", "n", "ids"])
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("binary").alias("text")).mapInArrow(run, _TOKENS)


def _crc(ids: bytes, start: int, length: int, total: int) -> int:
    """crc32 of a piece's ids as little-endian 32-bit numbers."""
    width = len(ids) // total
    return zlib.crc32(np.frombuffer(ids, f"<u{width}", length, start * width).astype("<u4"))


_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, source string")


def pack(docs: DataFrame, make_tokenizer, size: int = SIZE, targets: dict | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source.

    ``targets``: weight per source (sources without one get the least given);
    by default the sources' own token shares.  A null text is empty (its end
    id only); a null source is a source; repeated rows are packed each; an
    empty table gives no rows; other columns are ignored.  Queues follow the
    order in which the rows are read.

    The token ids are written once to the shared checkpoint folder and not
    shuffled after; only one total per (task, source) is.  The driver holds
    one total per source.
    """
    spark = docs.sparkSession
    held = cut_lineage(tokenize(docs, make_tokenizer))
    sums = held.groupBy("part", "source").agg(F.sum("n").alias("t"))
    before = F.coalesce(F.sum("t").over(Window.partitionBy("source").orderBy("part")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = cut_lineage(sums.select("part", "source", "t", before.alias("base")))
    totals = {r["source"]: r["t"] for r in bases.groupBy("source").agg(F.sum("t").alias("t")).collect()}
    weights = {s: (Fraction(str(targets.get(s, min(targets.values())))) if targets else Fraction(t))
               for s, t in totals.items()}
    groups = queue_groups(totals, weights, size)
    queue_total = [sum(totals[s] for s in g) for g in groups]
    whole = sum(weights.values()) or Fraction(1)
    layout = Layout(plan(queue_total, [sum(weights[s] for s in g) / whole for g in groups], size))
    where = {}
    for q, g in enumerate(groups):
        first = 0
        for s in g:
            where[s] = (q, first)
            first += totals[s]
    shared = spark.sparkContext.broadcast((layout, where))
    small = bases.select(F.col("part").alias("p"), F.col("source").alias("s"), "base")
    # one row per (task, source): broadcast behind a check of its bytes
    size_of = small.agg(F.sum(F.coalesce(F.octet_length("s"), F.lit(0)) + 32)).first()[0] or 0
    small = F.broadcast(small) if size_of <= MAX_BROADCAST_BYTES else small
    rows = held.join(small, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lay, place = shared.value
        for b in batches:
            n, at, base = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n", "at", "base"))
            if not len(n):
                continue
            # sources are compared by value once per batch, not per row
            coded = b.column("source").dictionary_encode(null_encoding="encode")
            spots = np.array([place[s] for s in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
            ids = b.column("ids").to_pylist()
            for queue in np.unique(spots[:, 0]).tolist():
                mine = np.nonzero(spots[:, 0] == queue)[0]
                start = spots[mine, 1] + base[mine] + at[mine]
                for which, begin, length, seq, offset in lay.place(queue, start, n[mine]):
                    row = mine[which]
                    crc = [_crc(ids[r], a, k, total) for r, a, k, total in
                           zip(row.tolist(), begin.tolist(), length.tolist(), n[row].tolist())]
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(take), *(pa.array(x, pa.int64()) for x in (begin, length, crc, n[row], seq, offset)),
                         b.column("source").take(take)],
                        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])
    return rows.select("doc_id", "source", "n", "ids", "at", "base").mapInArrow(run, _PIECES)


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack(table(spark, sf_dir, "documents"), WordTokenizer.from_package("word_bpe_49k.json"))
