"""Registered queries: order-dependent operators and set operations
(WIN-*, SET-*, FS-1, ST-2 batch twin)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import order as OR
from .q_aggs import SPARSE_SQL, filled_sparse
from .registry import query
from .tables import read

LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_SEQ = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]


@query(sql="""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
  l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
  l_linestatus DESC) = 1""")
def q_keep_last(spark, d):
    """WIN-1: keep-last per primary key in a total arrival order."""
    return OR.keep_last(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_SEQ)


@query(sql="""
SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def q_first_seen(spark, d):
    """WIN-2: first category seen per series, in position order."""
    o = read(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    return OR.keep_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(sql="WITH " + SPARSE_SQL + """
SELECT series_id, date, value FROM filled""")
def q_fill(spark, d):
    """WIN-3: forward then backward fill per series in date order."""
    return filled_sparse(spark, d).select("series_id", "date", "value")


@query(sql="""
WITH x AS (
  SELECT o_custkey, o_orderstatus, o_orderdate,
         lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
  FROM orders
),
c AS (SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from FROM x
      WHERE prev IS NULL OR prev <> o_orderstatus)
SELECT o_custkey, o_orderstatus, valid_from,
       lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to
FROM c""")
def q_scd(spark, d):
    """WIN-4: status history per customer as validity intervals."""
    o = read(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    o = o.withColumn("_ord", F.struct("o_orderdate", "o_orderkey"))
    h = OR.change_history(o, ["o_custkey"], "_ord", ["o_orderstatus"], bucket=F.year("o_orderdate"))
    return h.select("o_custkey", "o_orderstatus", F.col("valid_from.o_orderdate").alias("valid_from"),
                    F.col("valid_to.o_orderdate").alias("valid_to"))


@query(sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_topn(spark, d):
    """WIN-6/WIN-7: popularity-ranked top 10 (the limit is the feature)."""
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return OR.top_n(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query(sql="""
SELECT c_custkey AS id, c_name AS name, c_mktsegment, c_acctbal AS acctbal FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS acctbal, s_nationkey AS nationkey FROM supplier""")
def q_union_align(spark, d):
    """SET-1/SET-2: union by column name; missing columns are null."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                          "c_mktsegment", F.col("c_acctbal").alias("acctbal"))
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                          F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"))
    return OR.union_align([c, s], sort_columns=True)


@query(sql="""
SELECT DISTINCT partkey FROM (
  SELECT l_partkey AS partkey FROM lineitem UNION ALL SELECT p_partkey FROM part)
WHERE partkey IS NOT NULL""")
def q_distinct_union(spark, d):
    """SET-3: distinct union of ids discovered by two searches."""
    a = read(spark, d, "lineitem").select("l_partkey")
    b = read(spark, d, "part").select("p_partkey")
    return OR.distinct_union([a, b], "partkey")


@query(sql="""
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, 'QTR' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
FROM orders WHERE year(o_orderdate) >= 1996""")
def q_quarters_loaded(spark, d):
    """SET-5: distinct sorted (year, quarter) from a start year."""
    o = read(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    q = o.select(F.year("o_orderdate").alias("year"),
                 F.concat(F.lit("QTR"), F.quarter("o_orderdate").cast("string")).alias("quarter"))
    return OR.distinct_sorted(q, ["year", "quarter"])


@query(sql="""
SELECT user_id, event_type, value, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_features(spark, d):
    """FS-1: materialise a time range, latest row per key."""
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    ev = FE.feature_range(read(spark, d, "events"), "ts", at("2024-01-05"), at("2024-01-25"))
    return FE.latest_features(ev, ["user_id"], "ts", ["event_type", "value"], ["event_id"])


@query(sql="""
WITH hw AS (
  SELECT user_id, CAST(max(CAST(ts AS DATE)) + INTERVAL 1 DAY AS DATE) AS nxt
  FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY user_id
)
SELECT e.user_id, e.event_id, e.ts FROM events e LEFT JOIN hw USING (user_id)
WHERE CAST(e.ts AS DATE) >= greatest(coalesce(hw.nxt, DATE '2024-01-10'), DATE '2024-01-10')""")
def q_increment(spark, d):
    """ST-2 batch twin: per key, the later of stored max + 1 day and the
    given start; arriving rows from that day on."""
    from ..streaming.incremental import arriving_after_high_water
    ev = read(spark, d, "events").select("user_id", "event_id", "ts")
    stored = ev.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return arriving_after_high_water(ev, stored, ["user_id"], "ts", "2024-01-10")
