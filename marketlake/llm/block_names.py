"""Exact deduplication by deterministic block naming.  DataFrame functions only.

The text of a document, without white space, is cut into blocks of ``BLOCK``
code points.  The distinct blocks are sorted and numbered; a document becomes
the sequence of its blocks' numbers (names).  Then adjacent names are paired,
the distinct pairs are sorted and numbered, and so on until every document has
one name: after k rounds a name stands for up to 2^k blocks.  Equal names of a
round mean equal texts and no others do, so the last name with its round is
the document's identity.

Texts are shuffled once, each distinct block once a task, to be compared as
they are; their sort key is a 128-bit hash.  That no two different blocks
share a key is checked against the blocks themselves: where two do, all are
keyed again with another salt.  From then on only numbers move.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import cut_lineage

from .common import query, table, text_or_empty
from .ranks import look_up, ordered, ranks

BLOCK = 4096
SALTS = 16


def normalised(text: Column) -> Column:
    """``text`` without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def blocks(text: Column, size: int = BLOCK) -> Column:
    """Consecutive pieces of ``size`` code points; the last may be shorter,
    the empty text is one empty block."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))


def block_key(block: Column, salt: int) -> list[Column]:
    return [F.xxhash64(F.lit(salt), block), F.xxhash64(block, F.lit(salt))]


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, name): the distinct keys of ``rows``, their number of rows
    and their dense rank."""
    counted = rows.groupBy(*keys).agg(F.sum("n").alias("n"))
    return ranks(ordered(counted, [F.col(k).asc_nulls_first() for k in keys]), [], rank="name")


def keyed_rows(df: DataFrame, id_col: str, text_col: str, size: int, key=block_key) -> tuple[DataFrame, DataFrame]:
    """The rows (row, id, size, tie, text_sha256, keys: those of the blocks in
    order) and the keys with their names (k1, k2, n, name), under the first
    salt for which the distinct blocks have distinct keys.  ``row`` numbers the
    rows of the checkpointed table, so that they stay whatever is lost."""
    own = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).select(
        "id", F.length("text").alias("size"), F.xxhash64("text").alias("tie"), normalised(F.col("text")).alias("norm"))
    for salt in range(SALTS):
        def keys(block):
            return [c.alias(f"k{j}") for j, c in enumerate(key(block, salt), 1)]  # noqa: B023
        cut = own.select(F.explode(blocks(F.col("norm"), size)).alias("block"))
        # one row per distinct block: two with one key stay two rows
        distinct = cut_lineage(cut.groupBy(*keys(F.col("block")), "block").agg(F.count("*").alias("n")).drop("block"))
        named = _numbered(distinct, ["k1", "k2"])
        if distinct.count() == named.count():
            rows = own.select(F.monotonically_increasing_id().alias("row"), "id", "size", "tie",
                              F.sha2("norm", 256).alias("text_sha256"),
                              F.transform(blocks(F.col("norm"), size), lambda b: F.struct(*keys(b))).alias("keys"))
            return cut_lineage(rows), named
    raise ValueError(f"different blocks share a key under each of {SALTS} salts")


def identities(keyed: DataFrame, names: DataFrame) -> DataFrame:
    """(row, round, name) of each row: two rows have the same round and name
    if and only if they have the same sequence of blocks.  A round halves the
    names of a row, so a text of b blocks takes log2(b) rounds."""
    rows = keyed.select("row", F.size("keys").alias("m"), F.posexplode("keys").alias("i", "k")).select(
        "row", "m", "i", "k.k1", "k.k2")
    keys, done, at = ["k1", "k2"], [], 0
    most, total = rows.agg(F.max("m"), F.count("*")).first()
    while True:
        state = look_up(rows, names, keys, "n", total).select("row", "m", "i", "name")
        done.append(state.where("m = 1").select("row", F.lit(at).alias("round"), "name"))
        if not most or most == 1:
            return reduce(DataFrame.unionByName, done)
        left, right = (F.min(F.when(F.col("i") % 2 == side, F.col("name"))) for side in (0, 1))
        rows = cut_lineage(state.where("m > 1").groupBy("row", F.ceil(F.col("m") / 2).cast("int").alias("m"),
                                                        F.shiftright("i", 1).alias("i"))
                           .agg(left.alias("l"), right.alias("r")))
        keys, most, at, total = ["l", "r"], (most + 1) // 2, at + 1, rows.count()
        names = _numbered(rows.withColumn("n", F.lit(1)), keys)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK,
                 key=block_key) -> DataFrame:
    """One row per row of ``df``: ``id_col, keep_id, group_size, kept,
    text_sha256``.  Rows are of one group when their texts are identical
    without ASCII white space; the row with the most code points stays, then
    the smallest id (a null id comes last), then the smallest hash of the whole
    text, and of rows alike in all of these exactly one.

    Null text is the empty text, and all texts of white space only are one
    group; texts of any length are cut into blocks; an empty table has no rows;
    other columns are ignored, whatever their names.
    """
    keyed, names = keyed_rows(df, id_col, text_col, size, key)
    rows = cut_lineage(identities(keyed, names).join(keyed.drop("keys"), "row"))
    first = F.min(F.struct(-F.col("size"), F.col("id").isNull(), F.col("id"), F.col("tie"), F.col("row").alias("row")))
    groups = rows.groupBy("round", "name").agg(F.count("*").alias("n"), first.alias("first")).select(
        "round", "name", "n", F.col("n").alias("group_size"), F.col("first.id").alias("keep_id"),
        F.col("first.row").alias("keep_row"))
    out = look_up(rows, cut_lineage(groups), ["round", "name"], "n", rows.count())
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY size DESC, doc_id)
"""


@query(SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
