"""LM scoring: bigram model by deleted interpolation.

    P(w | v) = l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1)

b is the bucket of the context's frequency c(v) (powers of two).  The weights
l of each bucket are learned by expectation-maximisation on held-out counts:
one tenth of the training documents, each of whose n-grams is counted without
that tenth.  A document is its words and one end token; the context of its
first word is the end token.

Counts cover all training documents.  The exchange of counts is packed:
documents are tokenized into chunks of about ``CHUNK_TOKENS`` tokens; a chunk
asks for the count of each of its distinct n-grams once, as one sorted array
of hashes per range of hashes (``part``); each part adds up what all
chunks hold and answers every chunk with one array.  So an n-gram that is
frequent everywhere costs one entry per chunk, no key is hot, and what is
shuffled follows the number of distinct n-grams per chunk.  Nothing of the
corpus is broadcast or sent to the driver but the histogram for EM, whose
cells are bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import cut_lineage

from .common import crc_mod, query, ship_package, table, text_or_empty

CHUNK_TOKENS = 2_500_000
PART_ENTRIES = 3_000_000
FOLDS, HELD_OUT = 5, 1
EM_SHARE = 10                 # one in so many training documents is held out for EM
BUCKETS = 24                  # of the context's frequency
STEPS, RATIO_BINS = 4, 160    # histogram bins per octave of a ratio of probabilities, and their number

# Bits of an n-gram's hash.  Of 10^11 distinct n-grams fewer than one in a
# million shares its hash with another.
HASH_BITS = 56
_U = np.uint64
_SHIFT = _U(64 - HASH_BITS)
_END_HASH = _U(0x2545F4914F6CDD1D) >> _SHIFT


# ---------------------------------------------------------------- chunks

class _Words(dict):
    """Word -> index, numbering words as they come; 0 is the end token."""

    def __missing__(self, word):
        self[word] = n = len(self) + 1
        return n


def _zip(a: np.ndarray) -> bytes:
    """Compressed byte by byte place: the high bytes of numbers are alike."""
    import zstandard
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unzip(b: bytes, kind) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_CHUNKS = ("chunk long, doc_ids binary, roles binary, lens binary, types binary, tokens binary, "
           "n_tokens long, train_tokens long, fold_types binary, fold_tokens binary, fold_count long")


def _pack_chunk(part: int, number: int, ids, roles, docs, words: _Words) -> dict:
    import xxhash
    types = np.empty(len(words) + 1, _U)
    types[0] = _END_HASH
    types[1:] = [xxhash.xxh64_intdigest(w) >> int(_SHIFT) for w in words]
    roles = np.array(roles, np.uint8)     # 0 scored only, 1 training, 2 training and EM
    lens = np.array([len(d) for d in docs], np.int64)
    tokens = np.concatenate(docs)
    fold = np.concatenate([tokens[:0], *[d for d, r in zip(docs, roles) if r == 2]])
    used, fold = np.unique(fold, return_inverse=True)
    return {"chunk": (part << 32) | number, "doc_ids": np.array(ids, np.int64).tobytes(), "roles": roles.tobytes(),
            "lens": lens.tobytes(), "types": _zip(types), "tokens": _zip(tokens), "n_tokens": int(lens.sum()),
            "train_tokens": int(lens[roles > 0].sum()), "fold_types": _zip(types[used]),
            "fold_tokens": _zip(fold.astype(np.uint32)), "fold_count": len(fold)}


def make_chunks(docs: DataFrame) -> DataFrame:
    """``docs (row_id, role, b)`` to chunks; a document is never split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, roles, held, words, size = [], [], [], _Words(), 0

        def done():
            return pa.RecordBatch.from_pylist([_pack_chunk(part, number, ids, roles, held, words)], schema)
        schema = None
        for b in batches:
            schema = schema or pa.schema([(n, pa.int64() if t == "long" else pa.binary())
                                          for n, t in (x.split() for x in _CHUNKS.split(", "))])
            for i, r, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                found = list(map(words.__getitem__, t.as_py().lower().split()))
                found.append(0)
                ids.append(i)
                roles.append(r)
                held.append(np.array(found, np.uint32))
                size += len(found)
                if size >= CHUNK_TOKENS:
                    yield done()
                    number += 1
                    ids, roles, held, words, size = [], [], [], _Words(), 0
        if ids:
            yield done()
    return docs.select("row_id", "role", "b").mapInArrow(run, _CHUNKS)


def _bigrams(tokens: np.ndarray, n_types: int):
    """Of each token: the code (context, word).  The context of a document's
    first token is the end token, which the document before ends with."""
    context = np.empty_like(tokens)
    context[0:1] = 0
    context[1:] = tokens[:-1]
    return context.astype(np.int64) * n_types + tokens


def _bigram_hash(codes: np.ndarray, types: np.ndarray) -> np.ndarray:
    v, w = types[codes // len(types)], types[codes % len(types)]
    h = (v ^ (w * _U(0x9E3779B97F4A7C15))) * _U(0xD6E8FEB86659FD93)
    h = ((h ^ (h >> _U(32))) + w) * _U(0xFF51AFD7ED558CCD)
    return (h ^ (h >> _U(29))) >> _SHIFT


# ------------------------------------------------- asking for and giving counts

def _deltas(sorted_hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences of as few bytes as the largest needs."""
    d = np.diff(sorted_hashes, prepend=_U(0))
    width = max(1, (int(d.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _undeltas(raw: bytes) -> np.ndarray:
    width = raw[0]
    body = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, width)
    full = np.zeros((len(body), 8), np.uint8)
    full[:, :width] = body
    return np.cumsum(full.view("<u8").ravel(), dtype=_U)


def _cuts(sorted_hashes: np.ndarray, parts: int) -> np.ndarray:
    """Borders of ``parts`` equal hash ranges in a sorted array."""
    edges = np.array([(i << HASH_BITS) // parts for i in range(1, parts)], _U)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]])


_REQUESTS = "part int, chunk long, hashes binary, train binary, fold binary"


def requests(chunks: DataFrame, bigram_parts: int, word_parts: int) -> DataFrame:
    """One row per (chunk, part): the chunk's distinct n-grams of that part,
    with their counts in its training and EM documents.  Parts of bigrams come
    first, then those of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, roles, lens, types, tokens in zip(*(b.column(c).to_pylist() for c in range(5))):
                types, tokens = _unzip(types, _U), _unzip(tokens, np.uint32)
                role = np.repeat(np.frombuffer(roles, np.uint8), np.frombuffer(lens, np.int64))
                train, fold = (role > 0), (role == 2)
                codes, which = np.unique(_bigrams(tokens, len(types)), return_inverse=True)
                for hashes, index, first, parts in ((_bigram_hash(codes, types), which, 0, bigram_parts),
                                                    (types, tokens, bigram_parts, word_parts)):
                    order = np.argsort(hashes)
                    sorted_ = hashes[order]
                    t, f = (np.bincount(index[m], minlength=len(hashes)).astype(np.uint32)[order] for m in (train, fold))
                    cut = _cuts(sorted_, parts)
                    rows = [(first + p, chunk, _deltas(sorted_[a:z]), _zip(t[a:z]), _zip(f[a:z]))
                            for p, (a, z) in enumerate(zip(cut[:-1], cut[1:])) if z > a]
                    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=["part", "chunk", "hashes", "train", "fold"])
    return chunks.select("chunk", "roles", "lens", "types", "tokens").mapInArrow(run, _REQUESTS)


_ANSWERS = "chunk long, part int, total binary, deleted binary, distinct long"


def answers(asked: DataFrame) -> DataFrame:
    """One row per request: the counts over all training documents of its
    n-grams, in its order, and for those in the chunk's EM documents the
    counts without any EM document.  ``distinct``: training types of the part,
    on one row of each part."""
    def add_up(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        chunk = np.array(t.column("chunk").to_pylist())
        hashes = [_undeltas(x.as_py()) for x in t.column("hashes")]
        train = [_unzip(x.as_py(), np.uint32) for x in t.column("train")]
        fold = [_unzip(x.as_py(), np.uint32) for x in t.column("fold")]
        _, index = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(index, np.concatenate(train)).astype(np.int64)
        less = total - np.bincount(index, np.concatenate(fold)).astype(np.int64)
        out, at = [], 0
        for c, h, f in zip(chunk.tolist(), hashes, fold):
            mine = index[at:at + len(h)]
            at += len(h)
            kind = np.uint32 if int(total.max()) < 2 ** 32 else np.uint64
            tag = bytes([np.dtype(kind).itemsize])
            out.append((c, part, tag + _zip(total[mine].astype(kind)), tag + _zip(less[mine[f > 0]].astype(kind)), 0))
        out[0] = (*out[0][:4], int((total > 0).sum()))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                    names=["chunk", "part", "total", "deleted", "distinct"])
    return asked.groupBy("part").applyInArrow(add_up, _ANSWERS)


def _given(t: pa.Table, column: str, bigram_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(bigram counts, word counts) of a chunk, each in order of its hashes."""
    rows = sorted(zip(t.column("part").to_pylist(), t.column(column).to_pylist()))
    one = [(p, _unzip(raw[1:], np.uint32 if raw[0] == 4 else np.uint64).astype(np.int64)) for p, raw in rows]
    none = np.zeros(0, np.int64)
    return (np.concatenate([none, *[a for p, a in one if p < bigram_parts]]),
            np.concatenate([none, *[a for p, a in one if p >= bigram_parts]]))


def _aligned(tokens, types, pair_counts, word_counts):
    """Counts of each distinct bigram (its own, its context's, its word's),
    the word counts by type, and each token's bigram."""
    codes, which = np.unique(_bigrams(tokens, len(types)), return_inverse=True)
    pair = np.empty(len(codes), np.int64)
    pair[np.argsort(_bigram_hash(codes, types))] = pair_counts
    word = np.empty(len(types), np.int64)
    word[np.argsort(types)] = word_counts
    return pair, word[codes // len(types)], word[codes % len(types)], word, which


# ------------------------------------------------------------------- model

@dataclass
class Model:
    """Weights by bucket (rows: whole bigram, word, uniform), and the corpus."""
    weights: np.ndarray
    tokens: int
    types: int

    def probability(self, pair, context, word) -> np.ndarray:
        f2 = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
        f1 = word / max(1, self.tokens)
        w = self.weights[bucket(context)]
        return w[:, 0] * f2 + w[:, 1] * f1 + w[:, 2] / (self.types + 1)


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then by powers of two."""
    return np.minimum(BUCKETS - 1, np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0))


def _bin(f: np.ndarray, unit: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        at = np.floor(np.log2(np.maximum(f, 1e-300) / unit) * STEPS).astype(np.int64) + RATIO_BINS // 8
    return np.where(f > 0, np.clip(at, 1, RATIO_BINS - 1), 0)


def histogram(chunks: DataFrame, given: DataFrame, bigram_parts: int, tokens: int, types: int) -> DataFrame:
    """(cell, n, s2, s1): the held-out tokens by bucket and by the sizes of
    their two estimates, with the estimates' sums.  At most BUCKETS *
    RATIO_BINS ** 2 cells, whatever the corpus."""
    unit = 1.0 / (types + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        held, own = _unzip(left.column("fold_tokens")[0].as_py(), np.uint32), _unzip(left.column("fold_types")[0].as_py(), _U)
        pair, context, word, _, which = _aligned(held, own, *_given(right, "deleted", bigram_parts))
        n = np.bincount(which, minlength=len(pair)).astype(np.float64)
        f2 = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
        f1 = word / max(1, tokens)
        cell = (bucket(context) * RATIO_BINS + _bin(f2, unit)) * RATIO_BINS + _bin(f1, unit)
        cells, at = np.unique(cell, return_inverse=True)
        return pa.table({"cell": cells, "n": np.bincount(at, n), "s2": np.bincount(at, n * f2), "s1": np.bincount(at, n * f1)})
    folds = chunks.where("fold_count > 0").select("chunk", "fold_types", "fold_tokens")
    part = folds.groupBy("chunk").cogroup(given.select("chunk", "part", "deleted").join(
        folds.select("chunk"), "chunk", "left_semi").groupBy("chunk")).applyInArrow(run, "cell long, n double, s2 double, s1 double")
    return part.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s2").alias("s2"), F.sum("s1").alias("s1"))


def learn_weights(cells: list, types: int, tolerance: float = 1e-9) -> np.ndarray:
    """EM on the held-out histogram until the log-likelihood per token gains
    less than ``tolerance``; buckets lean on the pooled weights with the
    weight of one token, so empty buckets take those."""
    if not cells:
        return np.full((BUCKETS, 3), 1 / 3)
    cells = sorted(cells, key=lambda r: r["cell"])
    cell, n = np.array([r["cell"] for r in cells]), np.array([r["n"] for r in cells])
    f = np.stack([np.array([r["s2"] for r in cells]) / n, np.array([r["s1"] for r in cells]) / n,
                  np.full(len(n), 1.0 / (types + 1))], axis=1)

    def em(group, groups, prior):
        w, last = np.full((groups, 3), 1 / 3), -np.inf
        while True:
            share = w[group] * f
            p = share.sum(axis=1)
            gain = float((n * np.log(p)).sum() / n.sum())
            if gain - last < tolerance:
                return w
            last = gain
            got = np.stack([np.bincount(group, n * share[:, k] / p, groups) for k in range(3)], axis=1) + prior
            w = got / got.sum(axis=1, keepdims=True)
    pooled = em(np.zeros(len(n), np.int64), 1, np.full(3, 1e-3))[0]
    return em(cell // RATIO_BINS ** 2, BUCKETS, pooled)


_SCORES = ("row_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def score_chunks(chunks: DataFrame, given: DataFrame, model: Model, bigram_parts: int) -> DataFrame:
    shared = chunks.sparkSession.sparkContext.broadcast(model)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        m = shared.value
        own, tokens = _unzip(left.column("types")[0].as_py(), _U), _unzip(left.column("tokens")[0].as_py(), np.uint32)
        lens = np.frombuffer(left.column("lens")[0].as_py(), np.int64)
        pair, context, word, by_type, which = _aligned(tokens, own, *_given(right, "total", bigram_parts))
        starts = np.cumsum(lens) - lens
        of = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every document has its end token
        base = np.log10((by_type + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
        return pa.table({
            "row_id": np.frombuffer(left.column("doc_ids")[0].as_py(), np.int64),
            "held_out": np.frombuffer(left.column("roles")[0].as_py(), np.uint8) == 0,
            "n_tokens": lens, "n_known": of((by_type > 0).astype(np.int64)[tokens]),
            "train_tokens": np.full(len(lens), m.tokens, np.int64),
            "base_score": of(base[tokens]), "score": of(np.log10(m.probability(pair, context, word))[which])})
    return (chunks.select("chunk", "doc_ids", "roles", "lens", "types", "tokens").groupBy("chunk")
            .cogroup(given.select("chunk", "part", "total").groupBy("chunk")).applyInArrow(run, _SCORES))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (row_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score).

    Learns from the rows whose crc32(id) mod FOLDS is not HELD_OUT and scores
    all rows.  A null text is empty (its end token only); a null id takes the
    crc32 of the empty text and comes back as null; repeated rows count and
    are scored each; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    fold = crc_mod(id_col, FOLDS)
    em = F.pmod(F.floor(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) / FOLDS), F.lit(EM_SHARE))
    role = F.when(fold == HELD_OUT, 0).when(em == 0, 2).otherwise(1)
    null_id = -(2 ** 63)   # stands for a null id within the chunks
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(null_id)).alias("row_id"), role.alias("role"),
                       text_or_empty(text_col).cast("binary").alias("b"))
    chunks = cut_lineage(make_chunks(rows))
    sums = chunks.agg(F.sum("n_tokens").alias("n"), F.sum("train_tokens").alias("train")).first()
    tokens = sums["train"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bigram_parts = max(least, -(-(sums["n"] or 0) // PART_ENTRIES))
    given = cut_lineage(answers(requests(chunks, bigram_parts, max(1, bigram_parts // 4))))
    types = given.where(F.col("part") >= bigram_parts).agg(F.sum("distinct")).first()[0] or 0
    held = histogram(chunks, given, bigram_parts, tokens, types).collect()
    model = Model(learn_weights(held, types), tokens, types)
    out = score_chunks(chunks, given, model, bigram_parts)
    return out.withColumn("row_id", F.when(F.col("row_id") != null_id, F.col("row_id")))


@query()
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return score_documents(table(spark, sf_dir, "documents")).withColumnRenamed("row_id", "doc_id")
