"""Document fingerprints: bottom-k sketches of word-shingle hashes.
DataFrame functions only.

The sketch of a set is its k smallest hashes, sorted.  The sketch of a union
follows from the sketches of its parts, so parts of a long document, or the
documents of a host, merge exactly.  Two sketches estimate resemblance,
containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, query, table, text_or_empty

K = 128
SHINGLE = 5
CELLS = 65536


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """64-bit hashes of the text's ``n``-word shingles (words: runs without
    ASCII white space).  A shorter text is one shingle; no words, none."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")

    def hashed(w):
        return (F.when(F.size(w) > n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)),
                                                  lambda i: F.xxhash64(F.slice(w, i, n))))
                .when(F.size(w) > 0, F.array(F.xxhash64(w)))
                .otherwise(F.array().cast("array<bigint>")))
    return let(words, hashed)


def sketch(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    """Bottom-k sketch of a text; null and empty texts have the empty sketch."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(F.coalesce(text, F.lit("")), n))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(df: DataFrame, key: str, sketch_col: str, k: int = K) -> DataFrame:
    """One sketch per key from its parts: the k smallest distinct hashes.  The
    ranked filter is applied within each task before the shuffle (Spark's
    window group limit), so a key with a third of all parts sends k rows a
    task.  Keys whose parts are all empty get the empty sketch; a null key is
    a key; null sketches count as empty."""
    rows = df.select(F.col(key).alias(key), F.explode_outer(sketch_col).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("_h").asc_nulls_last()))
    kept = rows.withColumn("_r", rank).where(F.col("_r") <= k)
    return kept.groupBy(key).agg(F.sort_array(F.collect_list("_h")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; exact where both sets are smaller
    than k.  Two empty sets are alike (1)."""
    def of_union(u):
        seen = F.when((F.size(a) < k) & (F.size(b) < k), u).otherwise(F.slice(F.sort_array(u), 1, k))
        return let(seen, lambda s: F.size(F.array_intersect(F.array_intersect(s, a), b)) / F.size(s))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(let(F.array_union(a, b), of_union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below k)."""
    u = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / u)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, 0 to 1 (1 for empty a)."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1 + j) / na))


def to_text(s: Column) -> Column:
    """16 hexadecimal digits per hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _listed(values: list, kind: str) -> Column:
    """A constant array from one text literal (folded once when planned)."""
    return F.split(F.lit(",".join("" if v is None else str(v) for v in values)), ",").try_cast(f"array<{kind}>")


def with_next(df: DataFrame, id_col: str, cols: list[str], tie: str) -> DataFrame:
    """Add ``next_<c>`` for each of ``cols``: its value in the next row by
    ascending id (null first, equal ids by ``tie``); after the last row, the
    first's.

    Ids are dealt into buckets of consecutive ids with about as many rows
    each; the first row of a bucket is also sent to the bucket before it, so
    the window never crosses buckets and every row is shuffled once.  The
    driver holds one count and one id for each of at most CELLS id ranges.
    """
    lo, hi = df.agg(F.min(id_col), F.max(id_col)).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    width = (hi - lo) // CELLS + 1
    cell = F.coalesce(F.floor((F.col(id_col) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(0))
    if hi - lo >= 2 ** 52:   # doubles would round: divide as decimals
        wide = (F.col(id_col).cast("decimal(20,0)") - F.lit(lo).cast("decimal(20,0)"))
        cell = F.coalesce(F.floor(wide / F.lit(width).cast("decimal(20,0)")).cast("int"), F.lit(0))
    found = df.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min(id_col).alias("first"),
                                               F.max(F.col(id_col).isNull()).alias("has_null")).collect()
    n_buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_bucket = max(1, sum(r["n"] for r in found) // n_buckets)
    bucket_of, firsts, rows = [0] * CELLS, [], 0
    for r in sorted(found, key=lambda r: r["cell"]):
        if not firsts or rows >= per_bucket:
            firsts.append(None if r["has_null"] else r["first"])
            rows = 0
        bucket_of[r["cell"]] = len(firsts) - 1
        rows += r["n"]
    count = max(1, len(firsts))
    dealt = df.withColumn("_b", F.get(_listed(bucket_of, "int"), cell))
    first = F.get(_listed(firsts or [None], "bigint"), F.col("_b"))
    starts = F.col(id_col).eqNullSafe(first)
    own = F.struct(F.col("_b").alias("b"), F.lit(0).alias("ghost"))
    before = F.struct(F.pmod(F.col("_b") - 1, F.lit(count)).alias("b"), F.lit(1).alias("ghost"))
    sent = dealt.withColumn("_to", F.explode(F.when(starts, F.array(own, before)).otherwise(F.array(own))))
    w = Window.partitionBy("_to.b").orderBy("_to.ghost", F.col(id_col).asc_nulls_first(), tie)
    led = sent.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in cols])
    return led.where(F.col("_to.ghost") == 0).drop("_b", "_to")


def fingerprint(df: DataFrame, text_col: str = "text", out: str = "sketch", k: int = K, n: int = SHINGLE) -> DataFrame:
    """Add the bottom-k sketch of each row's whole text as ``out``.  Null text
    is the empty text; equal texts have equal sketches; repeated rows keep
    theirs; texts of any length are read whole (one array of hashes per text);
    an empty table stays empty; a column named ``out`` is replaced, all other
    columns stay."""
    return df.withColumn(out, sketch(F.col(text_col), k, n))


@query()
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty("text").alias("text"))
    led = with_next(fingerprint(docs), "doc_id", ["text", "sketch"], tie="text")
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = led.select(
        "doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.left("text", n - cut), F.left("next_text", cut)).alias("edited"))
    both = fingerprint(edited, "edited", "edited_sketch")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        to_text(F.col("sketch")).alias("fingerprint"), to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
