"""Registered queries: joins (JOIN-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from .q_filters import LEDGER_SQL, quarter_ledger, renumbered_orders
from .registry import query
from .tables import daily_series, read

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

DAILY_SQL = """
daily AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS date, round(sum(value), 2) AS value
  FROM events GROUP BY 1, 2
)"""


@query(sql="WITH " + DAILY_SQL + """
SELECT date,
  max(value) FILTER (WHERE series_id = 'click') AS click,
  max(value) FILTER (WHERE series_id = 'error') AS error,
  max(value) FILTER (WHERE series_id = 'purchase') AS purchase,
  max(value) FILTER (WHERE series_id = 'signup') AS signup,
  max(value) FILTER (WHERE series_id = 'view') AS "view"
FROM daily GROUP BY date""")
def q_align(spark, d):
    """JOIN-1/JOIN-2: N daily series outer-aligned on date (one pivot)."""
    return J.align_series(daily_series(spark, d), EVENT_TYPES)


@query(sql="""
WITH inc AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
     ex AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
SELECT * FROM inc WHERE o_orderkey IS NOT NULL AND trim(CAST(o_orderkey AS VARCHAR)) <> ''
  AND o_orderkey NOT IN (SELECT o_orderkey FROM ex)""")
def q_new_only(spark, d):
    """JOIN-7: incoming rows whose key is not stored (overlapping slices)."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    incoming = o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    existing = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return J.new_only(incoming, existing, ["o_orderkey"])


@query(sql="WITH " + LEDGER_SQL + """,
cal AS (
  SELECT CAST(floor(qi / 4) AS INTEGER) AS year, 'QTR' || CAST(qi % 4 + 1 AS VARCHAR) AS quarter
  FROM range(1994 * 4, 2002 * 4 + 2 + 1) t(qi)
),
loaded AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, 'QTR' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
  FROM orders WHERE o_orderstatus = 'F'
)
SELECT c.year, c.quarter, l.status FROM cal c
LEFT JOIN ledger l ON c.year = l.year AND c.quarter = l.quarter
WHERE NOT EXISTS (SELECT 1 FROM loaded x WHERE x.year = c.year AND x.quarter = c.quarter)
  AND (l.status IS NULL OR l.status IN ('pending', 'failed'))""")
def q_quarters_todo(spark, d):
    """JOIN-8/SET-4/FN-7: calendar quarters up to an as-of date, minus
    quarters with data, keeping missing / pending / failed ledger rows."""
    o = read(spark, d, "orders")
    loaded = o.where(F.col("o_orderstatus") == "F").select(
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("QTR"), F.quarter("o_orderdate").cast("string")).alias("quarter"))
    cal = J.quarter_calendar(spark, 1994, "2002-09-30")
    return J.quarters_todo(cal, loaded, quarter_ledger(spark, d))


@query(sql="""
WITH e AS (SELECT c_custkey, c_name, CASE WHEN c_nationkey < 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
                  c_acctbal FROM customer WHERE c_acctbal < 5000),
     n AS (SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment, 'R' || CAST(c_nationkey AS VARCHAR) AS region
           FROM customer WHERE c_acctbal > 2000)
SELECT coalesce(e.c_custkey, n.c_custkey) AS c_custkey,
       coalesce(e.c_name, n.c_name) AS c_name,
       coalesce(e.c_mktsegment, n.c_mktsegment) AS c_mktsegment,
       e.c_acctbal AS c_acctbal, n.region AS region
FROM e FULL OUTER JOIN n ON e.c_custkey = n.c_custkey""")
def q_combine_first(spark, d):
    """JOIN-9/UPS-7: null-filling full merge, stored value wins."""
    c = read(spark, d, "customer")
    e = c.where(F.col("c_acctbal") < 5000).select(
        "c_custkey", "c_name",
        F.when(F.col("c_nationkey") < 3, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_acctbal")
    n = c.where(F.col("c_acctbal") > 2000).select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_mktsegment",
        F.concat(F.lit("R"), F.col("c_nationkey").cast("string")).alias("region"))
    return J.combine_first(e, n, ["c_custkey"])


@query(sql="""
WITH f AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 40 THEN 'file_' || CAST(p_partkey AS VARCHAR) END AS file
           FROM part),
     g AS (SELECT p_brand, arg_max(file, p_partkey) AS group_file FROM f WHERE file IS NOT NULL GROUP BY p_brand)
SELECT f.p_partkey, f.p_brand, g.group_file AS file,
       (g.group_file IS NOT NULL AND coalesce(f.file, '') <> g.group_file) AS is_reused,
       g.group_file IS NULL AS needs_file
FROM f LEFT JOIN g ON f.p_brand = g.p_brand""")
def q_group_reuse(spark, d):
    """JOIN-10/FN-16: last file per benchmark group shared by its members."""
    p = read(spark, d, "part").select(
        "p_partkey", "p_brand",
        F.when(F.col("p_size") > 40, F.concat(F.lit("file_"), F.col("p_partkey").cast("string"))).alias("file"))
    return J.group_reuse(p, "p_partkey", "p_brand", "file", "p_partkey")


@query(sql="""
SELECT c.c_custkey, c.c_nationkey AS category_id,
       coalesce(n.n_name, 'Category ' || CAST(c.c_nationkey AS VARCHAR)) AS category_name
FROM customer c LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2) n
  ON c.c_nationkey = n.n_nationkey""")
def q_lookup_default(spark, d):
    """JOIN-11: lookup with a 'Category <id>' default."""
    c = read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("category_id"))
    # region 2's names stand under ids that no customer has
    key = F.when(F.col("n_regionkey") == 2, -1 - F.col("n_nationkey")).otherwise(F.col("n_nationkey"))
    n = read(spark, d, "nation").select(key.alias("category_id"), F.col("n_name").alias("name"))
    return J.lookup_with_default(c, n, "category_id", "name")


@query(sql="""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')""")
def q_orphans(spark, d):
    """JOIN-12: child rows without a parent."""
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = renumbered_orders(spark, d)
    return J.orphans(li, o, ["l_orderkey"], ["o_orderkey"])


@query(sql="""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')""")
def q_cascade(spark, d):
    """JOIN-12: rows kept after deleting parents (cascade as a semi join)."""
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = renumbered_orders(spark, d)
    return J.cascade_keep(li, o, ["l_orderkey"], ["o_orderkey"])
