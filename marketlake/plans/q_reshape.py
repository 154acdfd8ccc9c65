"""Registered queries: reshape (RSH-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as FV
from ..operators import reshape as RS
from .registry import query
from .tables import read

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(sql="""
SELECT l_orderkey, l_linenumber, variable, value, variable AS dimension
FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME variable VALUE value)
WHERE value IS NOT NULL""")
def q_melt(spark, d):
    """RSH-1: wide measures -> long rows with a dimensions map (here one
    entry per column); nulls dropped; values as double."""
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    m = RS.melt_with_dimensions(li, ["l_orderkey", "l_linenumber"], MEASURES)
    return m.select("l_orderkey", "l_linenumber", "variable", "value",
                    F.element_at("dimensions", F.lit("dimension")).alias("dimension"))


MATRIX_SQL = """
m AS (
  SELECT l_linestatus AS symbol,
         CASE l_returnflag WHEN 'R' THEN 'upLast7Days' WHEN 'A' THEN 'downLast30Days' ELSE 'upLast30Days' END AS label,
         CAST(CAST(round(sum(l_quantity) FILTER (WHERE quarter(l_shipdate) = 1)) AS BIGINT) AS VARCHAR) AS q1,
         CAST(CAST(round(sum(l_quantity) FILTER (WHERE quarter(l_shipdate) = 2)) AS BIGINT) AS VARCHAR) AS q2,
         CAST(CAST(round(sum(l_quantity) FILTER (WHERE quarter(l_shipdate) = 3)) AS BIGINT) AS VARCHAR) AS q3,
         CAST(CAST(round(sum(l_quantity) FILTER (WHERE quarter(l_shipdate) = 4)) AS BIGINT) AS VARCHAR) AS q4
  FROM lineitem GROUP BY 1, 2
)"""


@query(sql="WITH " + MATRIX_SQL + """,
l AS (UNPIVOT m ON q1, q2, q3, q4 INTO NAME period VALUE cell),
f AS (SELECT symbol, period, cell,
        CASE WHEN strpos(lower(label), 'up') > 0 AND strpos(lower(label), '7') > 0 THEN 'up_last_7_days'
             WHEN strpos(lower(label), 'up') > 0 AND strpos(lower(label), '30') > 0 THEN 'up_last_30_days'
             WHEN strpos(lower(label), 'down') > 0 AND strpos(lower(label), '7') > 0 THEN 'down_last_7_days'
             WHEN strpos(lower(label), 'down') > 0 AND strpos(lower(label), '30') > 0 THEN 'down_last_30_days' END AS field
      FROM l)
SELECT symbol, period,
  max(cell) FILTER (WHERE field = 'up_last_7_days') AS up_last_7_days,
  max(cell) FILTER (WHERE field = 'up_last_30_days') AS up_last_30_days,
  max(cell) FILTER (WHERE field = 'down_last_7_days') AS down_last_7_days,
  max(cell) FILTER (WHERE field = 'down_last_30_days') AS down_last_30_days
FROM f WHERE field IS NOT NULL GROUP BY symbol, period""")
def q_matrix_rows(spark, d):
    """RSH-4/FN-13: metric x period matrix -> one row per period with the
    fields picked by row label."""
    li = read(spark, d, "lineitem")
    label = (F.when(F.col("l_returnflag") == "R", "upLast7Days").when(F.col("l_returnflag") == "A", "downLast30Days")
              .otherwise("upLast30Days"))
    q = F.quarter("l_shipdate")
    cells = [F.round(F.sum(F.when(q == i, F.col("l_quantity")))).cast("long").cast("string").alias(f"q{i}")
             for i in range(1, 5)]
    m = li.groupBy(F.col("l_linestatus").alias("symbol"), label.alias("label")).agg(*cells)
    fields = [f for f, _ in FV.EPS_REVISION_RULES]
    return RS.matrix_to_rows(m, ["symbol"], "label", ["q1", "q2", "q3", "q4"], FV.EPS_REVISION_RULES, fields)


@query(sql="""
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS firm,
       o_orderstatus AS to_grade, CAST(NULL AS VARCHAR) AS from_grade, 'init' AS action, CAST(NULL AS DOUBLE) AS price_target
FROM orders
UNION ALL BY NAME
SELECT 'P' || CAST(l_partkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_returnflag AS firm,
       l_linestatus AS to_grade, 'main' AS action, l_extendedprice AS price_target
FROM lineitem""")
def q_two_feeds(spark, d):
    """RSH-5: two recommendation feeds to one row set (union by name)."""
    o = read(spark, d, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("firm"), F.col("o_orderstatus").alias("to_grade"),
        F.lit(None).cast("string").alias("from_grade"), F.lit("init").alias("action"))
    li = read(spark, d, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"), F.to_date("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("firm"), F.col("l_linestatus").alias("to_grade"), F.lit("main").alias("action"),
        F.col("l_extendedprice").alias("price_target"))
    return RS.two_feeds(o, li)


@query(sql="""
SELECT event_type, CAST(ts AS DATE) AS date, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, ts) AS close, count(*) AS volume
FROM events GROUP BY 1, 2""")
def q_ohlc(spark, d):
    """RSH-6: daily open / high / low / close / volume bars per series."""
    ev = read(spark, d, "events").withColumn("date", F.to_date("ts")).withColumn("one", F.lit(1).cast("long"))
    return RS.ohlc(ev, ["event_type"], "date", "ts", "value", tiebreak="event_id", volume="one")
