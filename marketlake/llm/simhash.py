"""SimHash near-dedup by a binary trie self-join.

Fingerprints are 64-bit majority votes of shingle hashes.  The distinct
fingerprints form a binary trie (most significant bit first).  The self-join
walks pairs of trie nodes of the same depth, adds up the differing bits of
their prefixes and drops a pair as soon as its error budget is exceeded:
first on Spark, level by level, until both nodes of a pair hold at most
``LEAF`` fingerprints; then bit by bit within the task that got the two
nodes' fingerprints.

Of two fingerprints that differ in at most k bits, one half differs in at most
k // 2.  The trie is therefore walked twice, once for the fingerprints and
once with their halves exchanged, with a budget of k // 2 for the first 32
bits and of k for all.  That loses no pair and prunes far earlier than one
walk with a budget of k from the top.

Links are reduced to a spanning forest in the task that finds them (a dense
group of n gives n - 1 links, not n * n), then to components on Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.session import cut_lineage

from .common import query, ship_package, table, text_or_empty
from .components import connected_components

BITS, HALF = 64, 32
SHINGLE = 4
MAX_BITS = 4
LEAF = 2048
STEP = 4
SMALL = 32            # node pairs of so few fingerprint pairs are compared directly
CHUNK = 1 << 20       # fingerprint pairs compared at once
_BLOCK = 1 << 16


# -------------------------------------------------------------- fingerprints

def simhash(text: bytes, n: int = SHINGLE) -> int:
    """Majority of the XXH64 (seed 42) bits of a text's ``n``-word shingles;
    A-Z lower-cased; fewer words are one shingle; no words give 0."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    k = min(n, len(words))
    starts, ends = start[:len(words) - k + 1].tolist(), (start + size)[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _BLOCK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + _BLOCK], ends[at:at + _BLOCK])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, text_col: str = "text", n: int = SHINGLE) -> DataFrame:
    """``rows`` with the signed 64-bit fingerprint ``fp`` of each row's whole
    text in place of the text."""
    others = [c for c in rows.columns if c != text_col]
    out = T.StructType([*(rows.schema[c] for c in others), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            fp = np.array([simhash(t.as_py(), n) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in others), pa.array(fp)],
                                             names=[*others, "fp"])
    return rows.select(*others, text_or_empty(text_col).cast("binary").alias(text_col)).mapInArrow(run, out)


# ---------------------------------------------------- join of two trie nodes

def near_pairs(a: np.ndarray, b: np.ndarray, same: bool, depth: int, diff: int, half: int, most: int):
    """Index pairs (i, j), in arrays of bounded size, of fingerprints of two
    nodes at ``depth`` whose prefixes differ in ``diff`` bits: at most ``half``
    differing bits among the first 32, at most ``most`` in all.  ``a`` and
    ``b`` are sorted (unsigned) without repeats; ``same``: they are one node."""
    node = np.array([[0, len(a), 0, len(b), diff]], np.int64)
    for d in range(depth, BITS + 1):
        if not len(node):
            return
        na, nb = node[:, 1] - node[:, 0], node[:, 3] - node[:, 2]
        few = (na * nb <= SMALL) if d < BITS else np.ones(len(node), bool)
        yield from _compare(a, b, node[few], same, half, most)
        node = node[~few]
        if not len(node) or d == BITS:
            return
        shift = np.uint64(BITS - 1 - d)
        zeros_a = np.concatenate([[0], np.cumsum(((a >> shift) & np.uint64(1)) == 0)])
        zeros_b = np.concatenate([[0], np.cumsum(((b >> shift) & np.uint64(1)) == 0)])
        al, ah, bl, bh, df = node.T
        am = al + zeros_a[ah] - zeros_a[al]
        bm = bl + zeros_b[bh] - zeros_b[bl]
        self_pair = (al == bl) & (ah == bh) & same
        child = [np.stack(x, axis=1) for x in ((al, am, bl, bm, df), (am, ah, bm, bh, df), (al, am, bm, bh, df + 1))]
        child.append(np.stack((am, ah, bl, bm, df + 1), axis=1)[~self_pair])
        node = np.concatenate(child)
        limit = half if d < HALF else most
        node = node[(node[:, 0] < node[:, 1]) & (node[:, 2] < node[:, 3]) & (node[:, 4] <= limit)]


def _compare(a, b, node, same, half, most):
    pairs = (node[:, 1] - node[:, 0]) * (node[:, 3] - node[:, 2])
    ends = np.cumsum(pairs)
    at = 0
    while at < len(node):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK)))
        part, n = node[at:stop], pairs[at:stop]
        of = np.repeat(np.arange(len(part)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (part[:, 3] - part[:, 2])[of]
        i, j = part[of, 0] + k // width, part[of, 2] + k % width
        x = a[i] ^ b[j]
        near = (np.bitwise_count(x) <= most) & (np.bitwise_count(x >> np.uint64(HALF)) <= half)
        if same:
            near &= i < j
        if near.any():
            yield i[near], j[near]
        at = stop


def forest(a: np.ndarray, b: np.ndarray, same: bool, pairs) -> tuple[np.ndarray, np.ndarray]:
    """Links (child, root) that connect the same fingerprints as ``pairs``."""
    every = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    root = np.arange(len(every))
    for i, j in pairs:
        j = j + shift
        while True:
            ri, rj = root[i], root[j]
            if (ri == rj).all():
                break
            low, high = np.minimum(ri, rj), np.maximum(ri, rj)
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    hung = np.nonzero(root != np.arange(len(every)))[0]
    return every[hung], every[root[hung]]


# --------------------------------------------------------------------- Spark

def _turned(c):
    """The fingerprint with its halves exchanged."""
    return F.shiftleft(c, 32).bitwiseOR(F.shiftrightunsigned(c, 32))


def _prefix(c, depth: int):
    return F.shiftrightunsigned(c, BITS - depth)


def _masks(depth: int, most: int) -> list[int]:
    """All ``depth``-bit numbers of at most ``most`` set bits."""
    found = [0]
    for _ in range(most):
        found = sorted({m | (1 << i) for m in found for i in range(depth)} | set(found))
    return found


def trie_links(nodes: DataFrame, n: int, turned: bool, most: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """(u, v) links between fingerprints of ``nodes (fp)`` (distinct, ``n`` of
    them) found in one walk of the trie."""
    half = most // 2
    keys = nodes.select((_turned(F.col("fp")) if turned else F.col("fp")).alias("key"))
    depth = min(HALF, max(1, math.ceil(math.log2(max(2, n / (leaf / 2))))))
    links = None
    pairs = None
    while True:
        size = cut_lineage(keys.groupBy(_prefix(F.col("key"), depth).alias("p")).agg(F.count("*").alias("n")))
        if pairs is None:
            # the node pairs that are within the budget at the first depth
            near = F.explode(F.array(*[F.lit(m).cast("long") for m in _masks(depth, half)]))
            start = size.select(F.col("p").alias("a"), near.alias("m")).select("a", F.col("a").bitwiseXOR(F.col("m")).alias("b"))
            pairs = start.where("a <= b")
        else:
            ways = F.explode(F.array(*[F.lit(x).cast("long") for x in range(1 << (2 * STEP))]))
            low = F.lit((1 << STEP) - 1).cast("long")
            down = pairs.select("a", "b", ways.alias("w")).select(
                F.shiftleft("a", STEP).bitwiseOR(F.shiftright("w", STEP)).alias("a"),
                F.shiftleft("b", STEP).bitwiseOR(F.col("w").bitwiseAND(low)).alias("b"))
            pairs = _within(down, depth, half, most)
        sized = (pairs.join(size.select(F.col("p").alias("a"), F.col("n").alias("na")), "a")
                 .join(size.select(F.col("p").alias("b"), F.col("n").alias("nb")), "b"))
        sized = cut_lineage(sized)
        ready = sized.where((F.col("na") <= leaf) & (F.col("nb") <= leaf))
        held = (keys.withColumn("p", _prefix(F.col("key"), depth)).join(size.where(F.col("n") <= leaf), "p", "left_semi")
                .groupBy("p").agg(F.collect_list("key").alias("keys")))
        both = (ready.select("a", "b").join(held.select(F.col("p").alias("a"), F.col("keys").alias("ka")), "a")
                .join(held.select(F.col("p").alias("b"), F.col("keys").alias("kb")), "b"))
        found = both.mapInArrow(_joiner(depth, half, most, turned), "u long, v long")
        links = found if links is None else links.unionByName(found)
        pairs = sized.where((F.col("na") > leaf) | (F.col("nb") > leaf)).select("a", "b")
        if depth == BITS or pairs.isEmpty():
            return links
        depth += STEP


def _within(pairs: DataFrame, depth: int, half: int, most: int) -> DataFrame:
    """Pairs (one way round) whose prefixes' differing bits keep to the budgets."""
    x = F.col("a").bitwiseXOR(F.col("b"))
    top = F.shiftrightunsigned(x, max(0, depth - HALF))
    return pairs.where("a <= b").where((F.bit_count(x) <= most) & (F.bit_count(top) <= half))


def _joiner(depth: int, half: int, most: int, turned: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            us, vs = [], []
            for pa_, pb, ka, kb in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), b.column("ka"), b.column("kb")):
                x = np.sort(np.asarray(ka.values).view(np.uint64))
                same = pa_ == pb
                y = x if same else np.sort(np.asarray(kb.values).view(np.uint64))
                mask = (1 << BITS) - 1
                diff = bin((pa_ ^ pb) & mask).count("1")
                u, v = forest(x, y, same, near_pairs(x, y, same, depth, diff, half, most))
                us.append(u)
                vs.append(v)
            u, v = (np.concatenate(z) if z else np.zeros(0, np.uint64) for z in (us, vs))
            if turned:
                u, v = ((z << np.uint64(32)) | (z >> np.uint64(32)) for z in (u, v))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])
    return run


def _grouped(held: DataFrame, most: int, leaf: int) -> DataFrame:
    """(fp, component): every distinct fingerprint of ``held (fp)`` and the
    fingerprint its component goes by."""
    nodes = cut_lineage(held.select("fp").distinct())
    count = nodes.count()
    links = trie_links(nodes, count, False, most, leaf).unionByName(trie_links(nodes, count, True, most, leaf))
    of = connected_components(cut_lineage(links.distinct()))
    return nodes.join(of.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
                    most: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``: its fingerprint
    and the smallest doc_id reachable over links of at most ``most`` differing
    bits.  Null and empty texts have fingerprint 0 and link like any other; a
    null id is kept, and is a component's id only where it has no other; equal
    texts and repeated rows always share a component; texts of any length are
    read whole; an empty table has no rows; other columns are ignored."""
    held = cut_lineage(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), n=n)
                       .select(F.col("id").cast("long").alias("doc_id"), "fp"))
    grouped = cut_lineage(_grouped(held, most, leaf))
    least = (held.groupBy("fp").agg(F.min("doc_id").alias("least")).join(grouped, "fp")
             .groupBy("component").agg(F.min("least").alias("component_id")))
    by_fp = grouped.join(least, "component").select("fp", "component_id")
    return held.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
             most: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """``docs`` with one row of each component: its smallest id's (null ids
    last, equal ids by a hash of the text, then of the whole row; of rows alike
    in all columns one).  All columns stay, whatever their names; an empty
    table stays empty; texts of any length are read whole.

    A row is known by two hashes of all its columns.  The copies of a group
    meet in no task: each task keeps its smallest per fingerprint first."""
    text = text_or_empty(text_col)
    whole = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
             for f in docs.schema]
    key = (F.xxhash64(text).alias("__k0"), F.xxhash64(*whole).alias("__k1"), F.xxhash64(F.lit("row"), *whole).alias("__k2"))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), *key)
    held = cut_lineage(fingerprints(rows, n=n))
    grouped = _grouped(held, most, leaf)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "__k0", "__k1", "__k2")
    first = (held.groupBy("fp").agg(F.min(order).alias("o")).join(grouped, "fp")
             .groupBy("component").agg(F.min("o").alias("o")).select("o.__k1", "o.__k2"))
    kept = docs.select("*", *key[1:]).join(first, ["__k1", "__k2"], "left_semi")
    return kept.dropDuplicates(["__k1", "__k2"]).select(*[F.col(f"`{c}`") for c in docs.columns])


@query()
def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
