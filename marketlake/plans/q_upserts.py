"""Registered queries: keyed writes (UPS-*) as (stored, incoming) -> table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import upsert as UP
from ..functions.scalars import json_to_dims
from .oracle import INDEX_PARSED
from .q_sources import filings
from .q_windows import LINE_COLS, LINE_SEQ
from .registry import query
from .tables import daily_series, read

def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


@query(sql="""
WITH e AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal, TIMESTAMP '2024-01-01' AS created_at,
                  TIMESTAMP '2024-01-01' AS updated_at FROM customer WHERE c_acctbal < 5000),
     n AS (SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment, c_acctbal + 1 AS c_acctbal,
                  TIMESTAMP '2024-06-01' AS created_at, TIMESTAMP '2024-06-01' AS updated_at
           FROM customer WHERE c_acctbal > 2000)
SELECT coalesce(n.c_custkey, e.c_custkey) AS c_custkey,
       CASE WHEN n.c_custkey IS NOT NULL THEN n.c_name ELSE e.c_name END AS c_name,
       CASE WHEN n.c_custkey IS NOT NULL THEN n.c_mktsegment ELSE e.c_mktsegment END AS c_mktsegment,
       CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE e.c_acctbal END AS c_acctbal,
       coalesce(e.created_at, n.created_at) AS created_at,
       CASE WHEN n.c_custkey IS NOT NULL THEN n.updated_at ELSE e.updated_at END AS updated_at
FROM e FULL OUTER JOIN n ON e.c_custkey = n.c_custkey""")
def q_upsert_keep_created(spark, d):
    """UPS-1: catalogue upsert; incoming replaces all but created_at."""
    c = read(spark, d, "customer")
    e = c.where(F.col("c_acctbal") < 5000).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal",
                                                   _ts("2024-01-01 00:00:00").alias("created_at"), _ts("2024-01-01 00:00:00").alias("updated_at"))
    n = c.where(F.col("c_acctbal") > 2000).select("c_custkey", F.upper("c_name").alias("c_name"), "c_mktsegment",
                                                   (F.col("c_acctbal") + 1).alias("c_acctbal"),
                                                   _ts("2024-06-01 00:00:00").alias("created_at"), _ts("2024-06-01 00:00:00").alias("updated_at"))
    return UP.upsert(e, n, ["c_custkey"], incoming_seq=F.lit(0).cast("long"), keep_from_existing=["created_at"])


UPS_OBS_SQL = """
daily AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS date, round(sum(value), 2) AS value
  FROM events GROUP BY 1, 2
),
e AS (SELECT * FROM daily WHERE day(date) <= 20),
n AS (SELECT series_id, date, value * 2 AS value, 1 AS seq FROM daily WHERE day(date) >= 15
      UNION ALL SELECT series_id, date, value * 3, 2 FROM daily WHERE day(date) >= 25),
nl AS (SELECT series_id, date, value FROM n QUALIFY row_number() OVER (PARTITION BY series_id, date ORDER BY seq DESC) = 1)
"""


@query(sql="WITH " + UPS_OBS_SQL + """
SELECT coalesce(nl.series_id, e.series_id) AS series_id, coalesce(nl.date, e.date) AS date,
       CASE WHEN nl.series_id IS NOT NULL THEN nl.value ELSE e.value END AS value
FROM e FULL OUTER JOIN nl ON e.series_id = nl.series_id AND e.date = nl.date""")
def q_upsert_obs(spark, d):
    """UPS-2/D-19: observation upsert on (series_id, date); the last row of
    the batch wins when the batch repeats a key."""
    daily = daily_series(spark, d)
    e = daily.where(F.dayofmonth("date") <= 20)
    n1 = daily.where(F.dayofmonth("date") >= 15).select("series_id", "date", (F.col("value") * 2).alias("value"),
                                                       F.lit(1).alias("seq"))
    n2 = daily.where(F.dayofmonth("date") >= 25).select("series_id", "date", (F.col("value") * 3).alias("value"),
                                                       F.lit(2).alias("seq"))
    n = n1.unionByName(n2)
    return UP.upsert(e, n, ["series_id", "date"], incoming_seq=F.col("seq")).select("series_id", "date", "value")


@query(sql="""
WITH dims AS (
  SELECT event_type AS code, CAST(ts AS DATE) AS date,
         '{"k":"' || json_extract_string(props, '$.k') || '"}' AS dim_key, value
  FROM events
),
e AS (SELECT code, date, dim_key, round(sum(value), 2) AS value FROM dims WHERE day(date) <= 20 GROUP BY 1, 2, 3),
n AS (SELECT code, date, dim_key, CAST(count(*) AS DOUBLE) AS value FROM dims WHERE day(date) >= 10 GROUP BY 1, 2, 3)
SELECT coalesce(n.code, e.code) AS code, coalesce(n.date, e.date) AS date, coalesce(n.dim_key, e.dim_key) AS dim_key,
       CASE WHEN n.code IS NOT NULL THEN n.value ELSE e.value END AS value
FROM e FULL OUTER JOIN n ON e.code = n.code AND e.date = n.date AND e.dim_key = n.dim_key""")
def q_upsert_dims(spark, d):
    """UPS-3/FN-19: dimensional upsert keyed by a canonical JSON of the
    dimensions map (key order inside the map ignored)."""
    ev = read(spark, d, "events").select(F.col("event_type").alias("code"), F.to_date("ts").alias("date"),
                                         json_to_dims(F.col("props")).alias("dimensions"), "value")
    key = UP.dims_key("dimensions")
    by = lambda rows, value: rows.groupBy("code", "date", key.alias("k")).agg(
        F.any_value("dimensions").alias("dimensions"), value.alias("value")).drop("k")
    e = by(ev.where(F.dayofmonth("date") <= 20), F.round(F.sum("value"), 2))
    n = by(ev.where(F.dayofmonth("date") >= 10), F.count(F.lit(1)).cast("double"))
    return UP.upsert_dimensional(e, n).select("code", "date", "dim_key", "value")


@query(sql="WITH " + INDEX_PARSED + """,
e AS (SELECT year, quarter, cik, form_type, filing_date, filename, company_name, accession_number
      FROM filings WHERE filing_date < DATE '1998-01-01'),
n AS (SELECT year, quarter, cik, form_type, filing_date, filename, upper(company_name) AS company_name, accession_number
      FROM filings WHERE filing_date >= DATE '1997-01-01')
SELECT * FROM e
UNION ALL
SELECT * FROM n WHERE NOT EXISTS (
  SELECT 1 FROM e WHERE e.year = n.year AND e.quarter = n.quarter AND e.cik = n.cik AND e.form_type = n.form_type
    AND e.filing_date = n.filing_date AND e.filename = n.filename)""")
def q_insert_ignore(spark, d):
    """UPS-4: insert-ignore on the 6-column index key; stored rows stay."""
    f = filings(spark, d).select("year", "quarter", "cik", "form_type", "filing_date", "filename",
                                 "company_name", "accession_number")
    e = f.where(F.col("filing_date") < F.lit("1998-01-01").cast("date"))
    n = f.where(F.col("filing_date") >= F.lit("1997-01-01").cast("date")) \
        .withColumn("company_name", F.upper("company_name"))
    key = ["year", "quarter", "cik", "form_type", "filing_date", "filename"]
    return UP.insert_ignore(e, n, key, incoming_seq=F.col("accession_number"))


@query(sql="""
WITH e AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
     n AS (SELECT o_orderkey, o_custkey, o_orderstatus, 0 AS seq FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
           UNION ALL
           SELECT o_orderkey, o_custkey, 'X', 1 FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
     nn AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM n
            WHERE o_orderkey NOT IN (SELECT o_orderkey FROM e)
            QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq, o_custkey, o_orderstatus) = 1)
SELECT * FROM e UNION ALL SELECT * FROM nn""")
def q_append_new(spark, d):
    """UPS-5/JOIN-7: append incoming rows with new keys only; a key repeated
    inside the batch is taken once (first in batch order)."""
    o = read(spark, d, "orders")
    e = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus")
    n0 = o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", F.lit(0).alias("seq"))
    n1 = o.where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), F.lit(1).alias("seq"))
    return UP.append_new(e, n0.unionByName(n1), ["o_orderkey"], incoming_seq=["seq"])


@query(sql="""
WITH e AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01'
           QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
             l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
             l_linestatus DESC) = 1),
     n AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'
           QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
             l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
             l_linestatus DESC) = 1)
SELECT * FROM e
UNION ALL
SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.l_orderkey = n.l_orderkey AND e.l_linenumber = n.l_linenumber)""")
def q_existing_wins(spark, d):
    """UPS-6: keep-last both sides, stored keys win, append the rest."""
    li = read(spark, d, "lineitem").select(*LINE_COLS)
    e = li.where(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    n = li.where(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    return UP.existing_wins(e, n, ["l_orderkey", "l_linenumber"], LINE_SEQ)


@query(sql="""
WITH e AS (SELECT 'count_' || event_type AS key, CAST(count(*) AS VARCHAR) AS value, max(ts) AS updated_at
           FROM events WHERE day(ts) <= 15 GROUP BY event_type),
     n AS (SELECT 'count_' || event_type AS key, CAST(count(*) AS VARCHAR) AS value, max(ts) AS updated_at
           FROM events GROUP BY event_type
           UNION ALL
           SELECT 'max_' || event_type, CAST(max(event_id) AS VARCHAR), max(ts) FROM events GROUP BY event_type),
     u AS (SELECT coalesce(n.key, e.key) AS key,
                  CASE WHEN n.key IS NOT NULL THEN n.value ELSE e.value END AS value,
                  CASE WHEN n.key IS NOT NULL THEN n.updated_at ELSE e.updated_at END AS updated_at
           FROM e FULL OUTER JOIN n ON e.key = n.key)
SELECT * FROM u
UNION ALL
SELECT key, value, updated_at FROM (
  SELECT 'schema_version' AS key, '1' AS value, TIMESTAMP '2024-01-01' AS updated_at
  UNION ALL SELECT 'source', 'events', TIMESTAMP '2024-01-01') s
WHERE s.key NOT IN (SELECT key FROM u)""")
def q_kv_upsert(spark, d):
    """UPS-8: key/value metadata upsert with seeded defaults."""
    ev = read(spark, d, "events")
    e = (ev.where(F.dayofmonth("ts") <= 15).groupBy("event_type")
           .agg(F.count(F.lit(1)).cast("string").alias("value"), F.max("ts").alias("updated_at"))
           .select(F.concat(F.lit("count_"), "event_type").alias("key"), "value", "updated_at"))
    g = ev.groupBy("event_type")
    n1 = g.agg(F.count(F.lit(1)).cast("string").alias("value"), F.max("ts").alias("updated_at")) \
        .select(F.concat(F.lit("count_"), "event_type").alias("key"), "value", "updated_at")
    n2 = g.agg(F.max("event_id").cast("string").alias("value"), F.max("ts").alias("updated_at")) \
        .select(F.concat(F.lit("max_"), "event_type").alias("key"), "value", "updated_at")
    seed = spark.createDataFrame([("schema_version", "1"), ("source", "events")], "key string, value string") \
        .withColumn("updated_at", _ts("2024-01-01 00:00:00"))
    return UP.kv_upsert(e, n1.unionByName(n2), seed)


@query(sql="""
WITH x AS (SELECT user_id, ts, event_id, event_type = 'error' AS failed, 'error ' || props AS err FROM events),
last AS (SELECT user_id, CASE WHEN failed THEN 'failed' ELSE 'success' END AS status, err, ts AS last_attempt FROM x
         QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
ok AS (SELECT user_id, ts AS ok_ts, event_id AS ok_id FROM x WHERE NOT failed
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
agg AS (SELECT user_id, max(ts) FILTER (WHERE NOT failed) AS downloaded_at, max(ts) FILTER (WHERE failed) AS failed_at
        FROM x GROUP BY user_id),
rc AS (SELECT x.user_id, CAST(count(*) FILTER (WHERE x.failed AND (ok.ok_ts IS NULL OR x.ts > ok.ok_ts
                                   OR (x.ts = ok.ok_ts AND x.event_id > ok.ok_id))) AS INTEGER) AS retry_count
       FROM x LEFT JOIN ok USING (user_id) GROUP BY x.user_id)
SELECT last.user_id, status, agg.downloaded_at, agg.failed_at,
       CASE WHEN status = 'failed' THEN err END AS error_message, rc.retry_count, last_attempt
FROM last JOIN agg USING (user_id) JOIN rc USING (user_id)""")
def q_ledger_fold(spark, d):
    """UPS-9/UPS-10: download-ledger state per key folded from its ordered
    success / failure events."""
    ev = read(spark, d, "events").select(
        "user_id", "ts", "event_id",
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("outcome"),
        F.concat(F.lit("error "), F.col("props")).alias("err"))
    return UP.ledger_fold(ev, ["user_id"], "ts", "outcome", "err", tiebreak="event_id")
