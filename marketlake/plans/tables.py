"""Driver tables and the stand-ins built from them (FIXTURES.md section C).

Each builder is lazy; nothing is collected.  The DuckDB twins of the same
stand-ins live in ``oracle.py`` as SQL text.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(d, f"{name}.parquet"))


# ---------------------------------------------------------------- index text
def index_lines(spark: SparkSession, d: str) -> DataFrame:
    """Filing-index text lines made from ``orders`` joined to ``customer``.

    The order priority decides the line shape so every order contributes one
    line: compact dates, ISO dates, header/rule/6-field junk, bad dates or
    foreign paths, and padded ids with stray spaces.
    """
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                       "o_orderdate", "o_orderpriority")
    c = read(spark, d, "customer").select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    cik = F.col("o_custkey").cast("string")
    pri = F.col("o_orderpriority")
    st = F.col("o_orderstatus")
    low, med, nsp = pri == "5-LOW", pri == "3-MEDIUM", pri == "4-NOT SPECIFIED"
    f1 = F.when(low, F.concat(F.lit(" 000"), cik, F.lit(" "))).otherwise(cik)
    f2 = F.when(low, F.concat(F.lit(" "), F.col("c_name"), F.lit("  "))).otherwise(F.col("c_name"))
    f4 = (F.when(pri.isin("1-URGENT", "5-LOW"), F.date_format("o_orderdate", "yyyyMMdd"))
           .when(nsp & (st == "F"), F.lit("invalid-date"))
           .when(nsp & (st == "O"), F.concat(F.year("o_orderdate").cast("string"), F.lit("-13-45")))
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    f4 = F.when(low, F.concat(F.lit(" "), f4)).otherwise(f4)
    f5 = F.when(nsp & (st == "P"), F.concat(F.lit("other/"), cik, F.lit(".txt"))).otherwise(
        F.concat(F.lit("edgar/data/"), cik, F.lit("/"),
                 F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit(".txt")))
    f6 = F.when(med & (st == "P"), F.lit("extra"))
    text = (F.when(med & (st == "F"), F.lit("CIK|Company Name|Form Type|Date Filed|Filename"))
             .when(med & (st == "O"), F.lit("-" * 50))
             .otherwise(F.concat_ws("|", f1, f2, st, f4, f5, f6)))
    # Emit each line through a one-element generator, as a file scan would
    # hand it over: the parser's many predicates then read a plain column
    # instead of being rewritten onto this builder expression (which made
    # generated code exceed the JVM method size).
    return j.select(F.col("o_orderkey"), F.explode(F.array(text)).alias("value"))


# ------------------------------------------------------------ category tree
def category_tree(spark: SparkSession, d: str) -> DataFrame:
    """Categories (category_id, name, parent_id) from region -> nation ->
    supplier under a root 0 that is stored as its own parent."""
    r = read(spark, d, "region")
    n = read(spark, d, "nation")
    s = read(spark, d, "supplier")
    root = spark.range(1).select(F.lit(0).cast("long").alias("category_id"),
                             F.lit("World").alias("name"),
                             F.lit(0).cast("long").alias("parent_id"))
    regions = r.select((F.col("r_regionkey") + 1).cast("long").alias("category_id"),
                       F.col("r_name").alias("name"),
                       F.lit(0).cast("long").alias("parent_id"))
    nations = n.select((F.col("n_nationkey") + 100).cast("long").alias("category_id"),
                       F.col("n_name").alias("name"),
                       (F.col("n_regionkey") + 1).cast("long").alias("parent_id"))
    suppliers = s.select((F.col("s_suppkey") + 1000).cast("long").alias("category_id"),
                         F.col("s_name").alias("name"),
                         (F.col("s_nationkey") + 100).cast("long").alias("parent_id"))
    return root.unionByName(regions).unionByName(nations).unionByName(suppliers)


# ------------------------------------------------------------- daily series
def daily_series(spark: SparkSession, d: str) -> DataFrame:
    """Observations stand-in: (series_id, date, value) = daily total of
    ``events.value`` per event type (rounded to cents, as stored)."""
    ev = read(spark, d, "events")
    return (ev.groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("date"))
              .agg(F.round(F.sum("value"), 2).alias("value")))
