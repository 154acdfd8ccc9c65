"""Registered queries: projections, filters, predicates (FLT-*, PRJ-*, EXT-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as FL
from .oracle import INDEX_PARSED
from .q_sources import filings
from .registry import query
from .tables import read


@query(sql="WITH " + INDEX_PARSED + """
SELECT DISTINCT filename FROM filings
WHERE year = 1997 AND form_type = 'F' AND company_name ILIKE '%customer#000000_%'""")
def q_dynamic_filter(spark, d):
    """FLT-1/EXT-3: keyword filters -> sorted distinct filenames."""
    return FL.filter_filings(filings(spark, d), year=1997, form_type="F",
                             company_name="customer#000000_", cik=None)


@query(sql="WITH " + INDEX_PARSED + """
SELECT DISTINCT filename FROM filings WHERE form_type = 'O' AND year >= 1998""")
def q_sql_hook(spark, d):
    """FLT-2/EXT-1: raw 'SELECT *' SQL over the index view, reduced to
    sorted distinct filenames."""
    filings(spark, d).createOrReplaceTempView("master_idx_files")
    return FL.filings_from_sql(spark, "SELECT * FROM master_idx_files WHERE form_type = 'O' AND year >= 1998")


@query(sql="""
SELECT event_type AS series_id, ts, value FROM events
WHERE event_type IN ('click', 'view')
  AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 23:59:59.999999'""")
def q_series_range(spark, d):
    """FLT-3: id list and inclusive time range, ordered by id and time."""
    ev = read(spark, d, "events").select(F.col("event_type").alias("series_id"), "ts", "value")
    return FL.series_range(ev, "series_id", ["click", "view"], "ts",
                           F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"),
                           F.lit("2024-01-20 23:59:59.999999").cast("timestamp_ntz"))


@query(sql="""
SELECT event_id, event_type, ts, value FROM events
WHERE json_extract_string(props, '$.k') = '42'""")
def q_dims_contains(spark, d):
    """FLT-4: dimension containment {k: 42} on the props map."""
    ev = read(spark, d, "events").withColumn("dims", F.from_json("props", "map<string,string>"))
    return ev.where(FL.dims_contains(ev, "dims", {"k": "42"})).select("event_id", "event_type", "ts", "value")


@query(sql="""
SELECT p_partkey, p_name, p_type FROM part WHERE CAST(p_type AS VARCHAR) IN ('ECONOMY', 'SMALL')""")
def q_category_in(spark, d):
    """FLT-5: IN-list on the category column (values compared as text)."""
    return read(spark, d, "part").where(FL.in_list("p_type", ["ECONOMY", "SMALL"])) \
        .select("p_partkey", "p_name", "p_type")


@query(sql="""
SELECT * FROM part
WHERE coalesce(regexp_matches(lower(CAST(p_partkey AS VARCHAR)), 'ring|widget'), false)
   OR coalesce(regexp_matches(lower(p_name), 'ring|widget'), false)
   OR coalesce(regexp_matches(lower(p_brand), 'ring|widget'), false)
   OR coalesce(regexp_matches(lower(p_type), 'ring|widget'), false)
   OR coalesce(regexp_matches(lower(CAST(p_size AS VARCHAR)), 'ring|widget'), false)
   OR coalesce(regexp_matches(lower(CAST(p_retailprice AS VARCHAR)), 'ring|widget'), false)""")
def q_any_search(spark, d):
    """FLT-6: any column, as lower-case text, matches a pattern."""
    return FL.any_column_matches(read(spark, d, "part"), "ring|widget")


@query(sql="""
SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31'""")
def q_detect_date_range(spark, d):
    """FLT-7: date range on the first date-like column found by name."""
    return FL.date_range_on_detected(read(spark, d, "orders"), "1996-01-01", "1996-12-31")


@query(sql="""
SELECT DISTINCT trim(t) AS ticker FROM (
  SELECT CASE WHEN c_acctbal < 0 THEN '  ' WHEN c_nationkey = 1 THEN NULL
              ELSE ' ' || substr(c_name, 10) || ' ' END AS t FROM customer)
WHERE t IS NOT NULL AND trim(t) <> ''""")
def q_universe(spark, d):
    """FLT-8: trimmed, non-empty, distinct tickers."""
    c = read(spark, d, "customer")
    t = (F.when(F.col("c_acctbal") < 0, F.lit("  ")).when(F.col("c_nationkey") == 1, F.lit(None))
          .otherwise(F.concat(F.lit(" "), F.substr(F.col("c_name"), F.lit(10)), F.lit(" "))))
    return FL.universe(c.select(t.alias("t")), "t")


@query(sql="""
SELECT DISTINCT trim('P' || CAST(p_partkey AS VARCHAR)) AS ticker FROM part
WHERE coalesce(nullif(p_brand, 'Brand#1'), CASE WHEN p_size > 25 THEN NULL ELSE p_type END,
               CASE WHEN p_retailprice > 1500 THEN NULL ELSE p_name END) IS NOT NULL""")
def q_any_not_null(spark, d):
    """FLT-9: country OR sector OR industry present -> distinct tickers."""
    p = read(spark, d, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("country"),
        F.when(F.col("p_size") > 25, F.lit(None)).otherwise(F.col("p_type")).alias("sector"),
        F.when(F.col("p_retailprice") > 1500, F.lit(None)).otherwise(F.col("p_name")).alias("industry"))
    return FL.any_not_null(p, ["country", "sector", "industry"], "ticker")


@query(sql="""
SELECT page_id, url FROM pages p
WHERE url IS NOT NULL AND trim(url) <> ''
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.page_id)
ORDER BY page_id LIMIT 25""")
def q_pending_limit(spark, d):
    """FLT-10: rows with a link, not stored yet, first 25 by key (the
    limit is the operator's feature: a bounded work list)."""
    p = read(spark, d, "pages").select("page_id", "url")
    stored = read(spark, d, "labels").select(F.col("doc_id").alias("page_id"))
    return FL.pending_with_link(p, stored, "page_id", "url", 25, ["page_id"])


@query(sql="""
SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS l_tax, nullif(l_discount, 0) AS l_discount
FROM lineitem WHERE coalesce(nullif(l_tax, 0), nullif(l_discount, 0)) IS NOT NULL""")
def q_any_metric(spark, d):
    """FLT-11: zero / empty metrics -> null; keep rows with any metric."""
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return FL.keep_if_any_metric(li, ["l_tax", "l_discount"])


LEDGER_SQL = """
ledger AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'QTR' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
         arg_max(CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'pending' ELSE 'failed' END,
                 o_orderkey) AS status,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS INTEGER) AS retry_count
  FROM orders GROUP BY 1, 2
)"""


def quarter_ledger(spark, d):
    """Download ledger stand-in: one row per order quarter; status of the
    quarter's last order; failures counted as retries."""
    o = read(spark, d, "orders")
    st = (F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "pending")
           .otherwise("failed"))
    return (o.groupBy(F.year("o_orderdate").alias("year"),
                      F.concat(F.lit("QTR"), F.quarter("o_orderdate").cast("string")).alias("quarter"))
             .agg(F.max_by(st, F.col("o_orderkey")).alias("status"),
                  F.count_if(F.col("o_orderstatus") == "P").cast("int").alias("retry_count")))


@query(sql="WITH " + LEDGER_SQL + """
SELECT year, quarter, status, retry_count FROM ledger
WHERE status IN ('pending', 'failed') AND year >= 1997""")
def q_retry(spark, d):
    """FLT-13/ST-5 batch twin: pending or failed quarters from a start year."""
    return FL.retry_selection(quarter_ledger(spark, d), 1997)


def renumbered_orders(spark, d):
    """All orders; those with status P under keys that no line has."""
    key = F.when(F.col("o_orderstatus") == "P", -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    return read(spark, d, "orders").select(key.alias("o_orderkey"))


@query(sql="""
SELECT 'duplicate_key' AS "check", count(*) AS violations FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL
SELECT 'not_null', count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) FROM lineitem
UNION ALL
SELECT 'foreign_key', count(*) FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')
UNION ALL
SELECT 'status_domain', count(*) FILTER (WHERE l_returnflag NOT IN ('R', 'A')) FROM lineitem""")
def q_constraints(spark, d):
    """FLT-14/JOIN-12: unique key, not null, foreign key and status-domain
    violations, one row per check."""
    li = read(spark, d, "lineitem")
    parent = renumbered_orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"))
    return FL.constraint_report(li, ["l_orderkey", "l_linenumber"], parent=parent, fk=["l_orderkey"],
                                status_col="l_returnflag", statuses=["R", "A"])


@query(sql="""
WITH c AS (
  SELECT p_partkey,
         CASE WHEN p_size < 20 THEN '' ELSE upper(substr(p_brand, 7)) END AS c1,
         CASE WHEN p_retailprice < 1200 THEN '' ELSE p_name END AS c2,
         CASE WHEN p_size < 10 THEN '' ELSE p_type END AS c3
  FROM part)
SELECT p_partkey, c1 AS ticker, c2 AS name FROM c
WHERE (c1 <> '' OR c2 <> '' OR c3 <> '') AND coalesce(nullif(c1, ''), nullif(c2, '')) IS NOT NULL""")
def q_usable_rows(spark, d):
    """FLT-15: drop all-empty rows, then rows with neither ticker nor name."""
    p = read(spark, d, "part")
    cells = F.array(F.when(F.col("p_size") < 20, F.lit("")).otherwise(F.upper(F.substr(F.col("p_brand"), F.lit(7)))),
                    F.when(F.col("p_retailprice") < 1200, F.lit("")).otherwise(F.col("p_name")),
                    F.when(F.col("p_size") < 10, F.lit("")).otherwise(F.col("p_type")))
    rows = p.select("p_partkey", cells.alias("cells"))
    rows = rows.select("p_partkey", "cells", F.col("cells")[0].alias("ticker"), F.col("cells")[1].alias("name"))
    return FL.usable_rows(rows, "cells", "ticker", "name").drop("cells")


@query(sql="""
WITH s AS (
  SELECT s_suppkey,
         CAST(CAST(floor(s_acctbal * 100) AS BIGINT) AS VARCHAR) AS marketCap,
         CAST(s_suppkey * 1000 AS VARCHAR) AS enterpriseValue,
         CAST(s_nationkey AS VARCHAR) AS trailingPE,
         '' AS pegRatio,
         CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) AS ps,
         CAST(s_nationkey * 2 AS VARCHAR) AS pb,
         CAST(s_suppkey % 7 AS VARCHAR) AS ebitda
  FROM supplier)
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, 'Current' AS period,
  CASE WHEN marketCap IN ('', '0', '0.0') THEN NULL ELSE marketCap END AS market_cap,
  CASE WHEN enterpriseValue IN ('', '0', '0.0') THEN NULL ELSE enterpriseValue END AS enterprise_value,
  CASE WHEN trailingPE IN ('', '0', '0.0') THEN NULL ELSE trailingPE END AS trailing_pe,
  CAST(NULL AS VARCHAR) AS forward_pe,
  CASE WHEN pegRatio IN ('', '0', '0.0') THEN NULL ELSE pegRatio END AS pegratio_5y,
  CASE WHEN ps IN ('', '0', '0.0') THEN NULL ELSE ps END AS price_sales,
  CASE WHEN pb IN ('', '0', '0.0') THEN NULL ELSE pb END AS price_book,
  CAST(NULL AS VARCHAR) AS ev_revenue,
  CASE WHEN ebitda IN ('', '0', '0.0') THEN NULL ELSE ebitda END AS ev_ebitda
FROM s""")
def q_rename_cast(spark, d):
    """PRJ-2: info map -> nine valuation text columns, period 'Current'."""
    s = read(spark, d, "supplier")
    info = F.create_map(
        F.lit("marketCap"), F.floor(F.col("s_acctbal") * 100).cast("string"),
        F.lit("enterpriseValue"), (F.col("s_suppkey") * 1000).cast("string"),
        F.lit("trailingPE"), F.col("s_nationkey").cast("string"),
        F.lit("pegRatio"), F.lit(""),
        F.lit("priceToSalesTrailing12Months"), F.floor("s_acctbal").cast("string"),
        F.lit("priceToBook"), (F.col("s_nationkey") * 2).cast("string"),
        F.lit("enterpriseToEbitda"), (F.col("s_suppkey") % 7).cast("string"))
    rows = s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sym"), info.alias("info"))
    return FL.valuation_columns(rows, "info", "sym")


@query(sql="""
WITH c AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS ticker,
         CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS long_name,
         CASE WHEN c_nationkey < 5 THEN NULL ELSE c_mktsegment END AS short_name,
         'N' || CAST(c_nationkey AS VARCHAR) AS name,
         CASE WHEN c_acctbal > 5000 THEN 'NYQ' ELSE '' END AS exch,
         'NYSE' AS full_exch,
         CASE WHEN c_acctbal BETWEEN 0 AND 1000 THEN NULL ELSE c_acctbal END AS price
  FROM customer)
SELECT ticker,
  coalesce(nullif(long_name, ''), nullif(short_name, ''), nullif(name, ''), ticker) AS name,
  coalesce(nullif(exch, ''), nullif(full_exch, '')) AS exchange,
  CASE WHEN price IS NULL THEN 'Invalid or unavailable data for ' || ticker END AS error
FROM c""")
def q_fallback(spark, d):
    """PRJ-3: name / exchange fallback chains and the error column."""
    c = read(spark, d, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_name")).alias("long_name"),
        F.when(F.col("c_nationkey") < 5, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("short_name"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("name"),
        F.when(F.col("c_acctbal") > 5000, F.lit("NYQ")).otherwise(F.lit("")).alias("exch"),
        F.lit("NYSE").alias("full_exch"),
        F.when(F.col("c_acctbal").between(0, 1000), F.lit(None)).otherwise(F.col("c_acctbal")).alias("price"))
    return FL.essentials(c, "ticker", "long_name", "short_name", "name", None, "exch", "full_exch", ["price"])
