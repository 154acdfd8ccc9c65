"""Benchmark decontamination: CGK embedding, bit-sampling LSH, edit distance.

Texts are sequences of words (lower case, ASCII punctuation is white space).
The CGK embedding walks over a window with one coin per (step, word): it
writes down the word it stands on and moves on if the coin says so.  Two
windows at small edit distance soon stand on the same words again, so edit
distance becomes Hamming distance of the written sequences.  Each repetition
takes a walk of its own and a few sampled places of the written sequence as a
key; a window and an item of the same length with equal keys are a candidate,
and the exact edit distance decides.  The number of repetitions of each window
length follows from the target recall, by the hits measured on edited copies of
the items of that length.

Items of more than ``PIECE_WORDS`` words are searched by their pieces: of an
item within the edit share, at least one piece is within it too; the whole
item is then verified.

All windows of every item length are looked at, at every word.  Before the
walk, windows are dropped that hold too few of the benchmark's word pairs: an
edit spoils at most two pairs, so a window within k edits of an item of n
words shares at least n - 1 - 2 k of its pairs; this loses nothing.

The benchmark goes to the tasks in blocks of at most ``BLOCK_WORDS`` words, so
what is sent is bounded however large it is.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, ship_package, table, text_or_empty

MAX_EDIT_SHARE = 0.2      # edits per word of the item
RECALL = 0.98
SAMPLES = 3               # sampled places in a key
REACH = 1.6               # steps of the walk per word of the window
BLOCK_WORDS = 2_000_000
WINDOW_BLOCK = 1 << 14    # windows embedded at once
PIECE_WORDS = 128         # longer items are searched by pieces of at most so many words
TEXT_BLOCK = 4_000_000    # characters searched at once
SEED = 20_240_131

# ASCII characters that are no letter or digit count as blanks; "_" too
_BLANKS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_BLANKS).split()


def max_edits(n: int, share: float = MAX_EDIT_SHARE) -> int:
    return int(n * share)


# ----------------------------------------------------------------- embedding

@lru_cache(1 << 16)
def _coins(step: int, walk: int) -> tuple[np.uint64, np.uint64]:
    r = np.random.default_rng([SEED, walk, step]).integers(1, 2 ** 63, 2, dtype=np.uint64)
    return r[0] * np.uint64(2) + np.uint64(1), r[1]


def embed(ids: np.ndarray, starts: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """(steps, len(starts)): the ids written down by walk number ``walk`` from
    each start.  ``ids`` must go on for ``steps`` places after each start."""
    at = starts.copy()
    out = np.empty((steps, len(starts)), np.int64)
    for j in range(steps):
        here = ids[at]
        out[j] = here
        a, b = _coins(j, walk)
        h = (here.astype(np.uint64) + np.uint64(1)) * a + b
        at = at + (((h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)).astype(np.int64)
    return out


@lru_cache(1 << 16)
def places(n: int, walk: int, samples: int) -> np.ndarray:
    """Sampled places of the written sequence for windows of ``n`` words."""
    steps = max(1, int(n * REACH))
    return np.random.default_rng([SEED, 7, walk, n]).integers(0, steps, samples)


def keys(written: np.ndarray, which: np.ndarray, n: int, walk: int, samples: int) -> np.ndarray:
    """Keys of the windows ``which`` (of ``n`` words)."""
    k = np.full(len(which), np.uint64(n * 2654435761 % 2 ** 32), np.uint64)
    for p in places(n, walk, samples):
        k = (k ^ written[p][which].view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        k ^= k >> np.uint64(32)
    return k


def best_edits(item: list[int], text: list[int]) -> tuple[int, int]:
    """(least edit distance of ``item`` to any run of ``text``, where that run
    ends), by Myers's bit-parallel search."""
    m = len(item)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[int, int] = {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | (1 << i)
    pv, mv, score, best, end = mask, 0, m, m, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = (mv | ~(xh | pv)) & mask, pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & mask, (mh << 1) & mask
        pv, mv = (mh | ~(xv | ph)) & mask, ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


# --------------------------------------------------------------------- index

@dataclass
class Index:
    """A block of the benchmark: its words, word pairs and keys per length."""
    items: list[tuple[int, list[int]]] = field(default_factory=list)
    pieces: list[list[int]] = field(default_factory=list)            # distinct
    holders: list[list[tuple[int, int, int]]] = field(default_factory=list)   # by piece: item, least and largest place in it
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    lengths: list[int] = field(default_factory=list)
    of: dict[int, np.ndarray] = field(default_factory=dict)          # pieces by length
    walks: dict[int, int] = field(default_factory=dict)              # by length
    samples: int = SAMPLES
    share: float = MAX_EDIT_SHARE
    tables: dict = field(default_factory=dict)   # (n, walk) -> sorted keys, their pieces

    @property
    def pad(self) -> int:
        return len(self.vocabulary) + 1

    def pair_code(self, ids: np.ndarray) -> np.ndarray:
        return ids[:-1] * (self.pad + 1) + ids[1:]


def build(rows: list[tuple[int, str]], share: float = MAX_EDIT_SHARE, recall: float = RECALL,
          samples: int = SAMPLES) -> Index:
    """Index of (item_id, text) rows; items without words are left out."""
    ix = Index(samples=samples, share=share)
    for item, text in rows:
        ids = [ix.vocabulary.setdefault(w, len(ix.vocabulary) + 1) for w in words_of(text)]
        if ids:
            ix.items.append((item, ids))
    if not ix.items:
        return ix
    _cut(ix)
    ix.lengths = sorted({len(w) for w in ix.pieces})
    ix.pairs = np.unique(np.concatenate([ix.pair_code(np.array(w, np.int64)) for w in ix.pieces]))
    sizes = np.array([len(w) for w in ix.pieces])
    ix.of = {n: np.nonzero(sizes == n)[0] for n in ix.lengths}
    ix.walks = repetitions(ix, recall)
    steps = int(ix.lengths[-1] * REACH) + 1
    found: dict[tuple[int, int], list] = {(n, walk): [] for n in ix.lengths for walk in range(ix.walks[n])}
    for n, every in ix.of.items():
        for at in range(0, len(every), WINDOW_BLOCK):
            some = every[at:at + WINDOW_BLOCK]
            flat, starts = _joined([ix.pieces[i] for i in some], ix.pad, steps)
            for walk in range(ix.walks[n]):
                found[n, walk].append(keys(embed(flat, starts, steps, walk), np.arange(len(some)), n, walk, samples))
    for (n, walk), k in found.items():
        k = np.concatenate(k)
        order = np.argsort(k, kind="stable")
        ix.tables[n, walk] = (k[order], ix.of[n][order])
    return ix


def _cut(ix: Index) -> None:
    """Items to distinct pieces of about equal length."""
    number: dict[tuple[int, ...], int] = {}
    for i, (_, words) in enumerate(ix.items):
        parts = -(-len(words) // PIECE_WORDS)
        edges = [len(words) * p // parts for p in range(parts + 1)]
        for a, z in zip(edges[:-1], edges[1:]):
            piece = tuple(words[a:z])
            k = number.setdefault(piece, len(ix.pieces))
            if k == len(ix.pieces):
                ix.pieces.append(list(piece))
                ix.holders.append([])
            held = ix.holders[k]
            if held and held[-1][0] == i:
                held[-1] = (i, held[-1][1], a)
            else:
                held.append((i, a, a))


def _joined(texts: list, pad: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each followed by ``gap`` pads, and their starts."""
    lens = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lens + gap) - lens - gap
    flat = np.full(int((lens + gap).sum()), pad, np.int64)
    for t, s in zip(texts, starts):
        flat[s:s + len(t)] = t
    return flat, starts


def repetitions(ix: Index, recall: float, copies: int = 96, probe_walks: int = 64, most_walks: int = 4096) -> dict[int, int]:
    """Walks needed for ``recall`` at the largest edit distance, by piece
    length: ``copies`` edited copies of pieces of that length are made at that
    distance and their hits counted over ``probe_walks`` walks, twice as many
    until they are enough.  A copy that was hit by h of w walks is missed by n
    of them with chance C(w - h, n) / C(w, n); the mean of this over the
    copies, and one standard error, stay within 1 - recall."""
    rng = np.random.default_rng(SEED)
    need = {n: 1 for n in ix.lengths}
    pairs: dict[int, list] = {}
    for n in ix.lengths:
        if not max_edits(n, ix.share):
            continue   # equal windows have equal keys
        every = [i for i in ix.of[n]]
        some = [ix.pieces[i] for i in every[:: max(1, len(every) // copies)][:copies]]
        pairs[n] = [(w, _edited(w, max_edits(n, ix.share), rng)) for w, _ in zip(itertools.cycle(some), range(copies))]
    hits = {n: np.zeros(copies, np.int64) for n in pairs}
    done = 0
    while pairs:
        upto = 2 * done or probe_walks
        order = sorted(pairs)
        steps = int(order[-1] * REACH) + 1
        fa, sa = _joined([w for n in order for w, _ in pairs[n]], ix.pad, steps)
        fb, sb = _joined([v for n in order for _, v in pairs[n]], ix.pad, steps)
        for walk in range(done, upto):
            a, b = embed(fa, sa, steps, 1_000_000 + walk), embed(fb, sb, steps, 1_000_000 + walk)
            for k, n in enumerate(order):
                of = np.arange(k * copies, (k + 1) * copies)
                hits[n] += keys(a, of, n, walk, ix.samples) == keys(b, of, n, walk, ix.samples)
        done = upto
        for n in order:
            missed = np.ones(copies)
            for walks in range(1, done + 1):
                missed = missed * np.maximum(0, done - hits[n] - walks + 1) / (done - walks + 1)
                if missed.mean() + missed.std() / math.sqrt(copies) <= 1 - recall:
                    break
            need[n] = walks
            if walks <= done // 2 or done >= most_walks:
                del pairs[n]
    return need


def _edited(words: list[int], edits: int, rng: np.random.Generator) -> list[int]:
    """A copy with ``edits`` words changed, put in or left out."""
    v = list(words)
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(max(1, len(v))))
        if kind == 0 and v:
            v[at] = 0
        elif kind == 1:
            v.insert(at, 0)
        elif len(v) > 1:
            del v[at]
    return v


# -------------------------------------------------------------------- search

def search(texts: list[str], ix: Index) -> list[tuple[int, int, int, int, int]]:
    """(text number, item_id, words of the item, edits, word where the match
    ends), one per text and item."""
    found: list[tuple[int, int, int, int, int]] = []
    at = 0
    while ix.items and at < len(texts):   # some texts at a time; a long one alone
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= TEXT_BLOCK):
            size += len(texts[stop])
            stop += 1
        found += [(at + r[0], *r[1:]) for r in _search_some(texts[at:stop], ix)]
        at = stop
    return found


def _search_some(texts: list[str], ix: Index) -> list[tuple[int, int, int, int, int]]:
    gap = int(ix.lengths[-1] * REACH) + 1
    get = ix.vocabulary.get
    ids = [np.array([get(w, 0) for w in words_of(t)], np.int64) for t in texts]
    flat, begins = _joined(ids, ix.pad, gap)
    ends = begins + np.array([len(x) for x in ids])
    by_n = _windows(flat, begins, ends, ix)
    if not by_n:
        return []
    tried: dict[tuple[int, int], list[tuple[int, int]]] = {}
    seen: set[tuple[int, int]] = set()
    found: dict[tuple[int, int], tuple[int, int]] = {}
    every = np.unique(np.concatenate(list(by_n.values())))
    for lo in range(0, len(every), WINDOW_BLOCK):
        starts = every[lo:lo + WINDOW_BLOCK]
        inside = {n: np.nonzero(np.isin(starts, s, assume_unique=True))[0] for n, s in by_n.items()}
        inside = {n: rows for n, rows in inside.items() if len(rows)}
        for walk in range(max((ix.walks[n] for n in inside), default=0)):
            if any(ix.walks[n] <= walk for n in inside):   # on with the lengths that need more walks
                inside = {n: starts[rows] for n, rows in inside.items() if ix.walks[n] > walk}
                starts = np.unique(np.concatenate(list(inside.values())))
                inside = {n: np.searchsorted(starts, s) for n, s in inside.items()}
            written = embed(flat, starts, int(max(inside) * REACH) + 1, walk)
            for n, rows in inside.items():
                known, which = ix.tables[n, walk]
                k = keys(written, rows, n, walk, ix.samples)
                first, last = np.searchsorted(known, k, "left"), np.searchsorted(known, k, "right")
                for r in np.nonzero(last > first)[0]:
                    start = int(starts[rows[r]])
                    for piece in which[first[r]:last[r]].tolist():
                        if (start, piece) in seen:
                            continue
                        seen.add((start, piece))
                        d = int(np.searchsorted(begins, start, "right")) - 1
                        for holder in ix.holders[piece]:
                            _verify(ix, flat, int(begins[d]), int(ends[d]), d, start, holder, found, tried)
    return [(d, ix.items[i][0], len(ix.items[i][1]), e, end) for (d, i), (e, end) in sorted(found.items())]


def _windows(flat, begins, ends, ix: Index) -> dict[int, np.ndarray]:
    """Starts of the windows of each item length that hold enough of the
    benchmark's word pairs.  A window may overhang its text's end by the edits
    allowed, for items at the end that lost words."""
    longest = ix.lengths[-1]
    need = {n: max(0, n - 1 - 2 * max_edits(n, ix.share)) for n in ix.lengths}
    code = ix.pair_code(flat)
    spot = np.minimum(np.searchsorted(ix.pairs, code), max(0, len(ix.pairs) - 1))
    hit = ix.pairs[spot] == code if len(ix.pairs) else np.zeros(len(code), bool)
    known = np.concatenate([[0], np.cumsum(hit), [0]])
    known[-1] = known[-2]

    def pairs_in(s, n):
        return known[np.minimum(s + n - 1, len(known) - 1)] - known[s]
    # a window holds no more pairs than the longest window from the same start
    word = (flat > 0) & (flat < ix.pad)
    least = min(need.values())
    upto = np.concatenate([known[longest - 1:], np.full(min(longest - 1, len(known)), known[-1])])[:len(flat)]
    near = np.nonzero(upto - known[:len(flat)] >= least if least else word)[0]
    if not len(near):
        return {}
    text_end = ends[np.searchsorted(begins, near, "right") - 1]
    out = {}
    for n in ix.lengths:
        s = near[(pairs_in(near, n) >= need[n]) & (near + n <= text_end + max_edits(n, ix.share))]
        if len(s):
            out[n] = s
    return out


def _verify(ix, flat, begin, end, d, start, holder, found, tried) -> None:
    """Exact distance of the whole item to the best run around the place that
    the window gives it; a stretch of two items' lengths around it is searched
    at once and not again."""
    item, first, last = holder
    words = ix.items[item][1]
    n, k = len(words), max_edits(len(words), ix.share)
    lo, hi = max(begin, start - last - k), min(end, start - first + n + k)
    done = tried.setdefault((d, item), [])
    if found.get((d, item), (1,))[0] == 0 or any(a <= lo and hi <= z for a, z in done):
        return
    lo, hi = max(begin, start - last - n), min(end, start - first + 2 * n)
    done.append((lo, hi))
    edits, stop = best_edits(words, flat[lo:hi].tolist())
    if edits <= k and edits < found.get((d, item), (k + 1,))[0]:
        found[d, item] = (edits, lo - begin + stop)


# --------------------------------------------------------------------- Spark

_LEAKS = "doc_id long, item_id long, item_words int, edits int, end_word int"


def _indexes(benchmark: DataFrame, share: float, recall: float, block_words: int):
    """Broadcast indexes of the benchmark, in blocks of bounded size."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty("text").alias("text"))
    total = items.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_words))
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(((r["item_id"], r["text"]) for r in some.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield sc.broadcast(build(rows, share, recall))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          share: float = MAX_EDIT_SHARE, recall: float = RECALL, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, item_words, edits, end_word): each document that holds
    an item within ``share`` edits per word of the item, one row per document
    row and item with its least edits.

    Null and empty texts, of documents or items, match nothing; equal items
    are reported each; repeated rows are reported each; a null id comes back
    as null; an empty benchmark gives no rows; other columns are ignored.
    """
    def searcher(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column(0).to_pylist()
                rows = search(b.column(1).to_pylist(), index.value)
                cols = [[ids[r[0]] for r in rows], *([r[k] for r in rows] for k in (1, 2, 3, 4))]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["doc_id", "item_id", "item_words", "edits", "end_word"])
        return run
    rows = docs.select(F.col(id_col).cast("long"), text_or_empty(text_col))
    found = [rows.mapInArrow(searcher(ix), _LEAKS) for ix in _indexes(benchmark, share, recall, block_words)]
    return reduce(DataFrame.unionByName, found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", share: float = MAX_EDIT_SHARE,
                  recall: float = RECALL, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; every row is
    judged by its own whole text and all columns stay.  No shuffle."""
    def cleaner(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [t or "" for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
                clean = np.ones(len(texts), bool)
                clean[[r[0] for r in search(texts, index.value)]] = False
                yield b.filter(pa.array(clean))
        return run
    for ix in _indexes(benchmark, share, recall, block_words):
        docs = docs.mapInArrow(cleaner(ix), docs.schema)
    return docs


@query()
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
