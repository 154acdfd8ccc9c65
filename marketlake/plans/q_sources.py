"""Registered queries: sources (SRC-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.index import parse_index_lines
from ..sources.landed import html_pairs, listing_union, parse_labour_json
from .oracle import INDEX_PARSED
from .registry import query
from .tables import index_lines, read


def filings(spark, d):
    """Parsed index with year and quarter (the stored index table)."""
    parsed = parse_index_lines(index_lines(spark, d))
    return (parsed.withColumn("year", F.year("filing_date"))
                  .withColumn("quarter", F.concat(F.lit("QTR"), F.quarter("filing_date").cast("string"))))


@query(sql="WITH " + INDEX_PARSED + """
SELECT cik, company_name, form_type, filing_date, filename, accession_number FROM filings""")
def q_index_parse(spark, d):
    """SRC-1 + FN-1..3: index text lines -> typed filing rows."""
    return parse_index_lines(index_lines(spark, d))


# ------------------------------------------------------------------- SRC-5
LABOUR_JSON_SCHEMA = (
    "status string, Results struct<series: array<struct<seriesID: string, data: array<struct<"
    "year: string, period: string, value: string, footnotes: array<struct<code: string, text: string>>>>>>>")


def labour_payloads(spark, d):
    """One landed JSON document per order: Results.series[0].data[] holds
    the order's line items as monthly observations."""
    li = read(spark, d, "lineitem")
    obs = F.struct(
        F.year("l_shipdate").cast("string").alias("year"),
        F.concat(F.lit("M"), F.lpad(F.month("l_shipdate").cast("string"), 2, "0")).alias("period"),
        F.col("l_quantity").cast("string").alias("value"),
        F.array(F.struct(F.col("l_returnflag").alias("code"),
                         F.concat(F.lit("flag "), F.col("l_returnflag")).alias("text"))).alias("footnotes"))
    per_order = li.groupBy("l_orderkey").agg(F.collect_list(obs).alias("data"))  # <= 7 lines per order
    doc = F.struct(F.lit("REQUEST_SUCCEEDED").alias("status"),
                   F.struct(F.array(F.struct(F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("seriesID"),
                                             F.col("data").alias("data"))).alias("series")).alias("Results"))
    return per_order.select(F.to_json(doc).alias("value"))


@query(sql="""
SELECT 'S' || CAST(l_orderkey AS VARCHAR) AS series_id,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
       CAST(year(l_shipdate) AS VARCHAR) AS year,
       'M' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS period,
       l_quantity AS value,
       'flag ' || l_returnflag AS footnotes
FROM lineitem""")
def q_json_explode(spark, d):
    """SRC-5: labour-statistics JSON -> (series_id, date, year, period,
    value, footnotes) rows."""
    return parse_labour_json(labour_payloads(spark, d))


# ------------------------------------------------------------------- SRC-11
def _symbol(name_col, bal_col, nation_col):
    base = F.substr(F.col(name_col), F.lit(10))
    return (F.when(F.col(nation_col) == 0, F.lit(None))
             .when(F.col(bal_col) < 0, F.concat(base, F.lit(".PR")))
             .when(F.col(bal_col) < 100, F.lit(" "))
             .otherwise(base))


@query(sql="""
WITH ex AS (
  SELECT 'NYSE' AS exchange, CASE WHEN c_nationkey = 0 THEN NULL WHEN c_acctbal < 0 THEN substr(c_name, 10) || '.PR'
         WHEN c_acctbal < 100 THEN ' ' ELSE substr(c_name, 10) END AS Symbol FROM customer
  UNION ALL
  SELECT 'NASDAQ', CASE WHEN s_nationkey = 0 THEN NULL WHEN s_acctbal < 0 THEN substr(s_name, 10) || '.PR'
         WHEN s_acctbal < 100 THEN ' ' ELSE substr(s_name, 10) END FROM supplier
)
SELECT DISTINCT Symbol AS ticker, exchange FROM ex
WHERE Symbol IS NOT NULL AND strpos(Symbol, '.') = 0 AND trim(Symbol) <> ''""")
def q_listing_union(spark, d):
    """SRC-11: two exchange listings -> tickers tagged by exchange."""
    c = read(spark, d, "customer").select(_symbol("c_name", "c_acctbal", "c_nationkey").alias("Symbol"))
    s = read(spark, d, "supplier").select(_symbol("s_name", "s_acctbal", "s_nationkey").alias("Symbol"))
    return listing_union({"NYSE": c, "NASDAQ": s})


# ------------------------------------------------------------------- SRC-13
LI_LINK = r'<li><a href="([^"]*)">([^<]*)</a></li>'


@query(sql=f"""
WITH x AS (
  SELECT page_id, unnest(regexp_extract_all(html, '{LI_LINK}', 1)) AS value,
         unnest(regexp_extract_all(html, '{LI_LINK}', 2)) AS key
  FROM pages
)
SELECT page_id, trim(key) AS key, trim(value) AS value FROM x
WHERE trim(key) <> '' AND trim(value) <> '' AND lower(trim(key)) NOT IN ('key', 'field')""")
def q_html_links(spark, d):
    """SRC-13/RSH-7: key/value pairs from list links of each page."""
    p = read(spark, d, "pages")
    return html_pairs(p, ["page_id"], "html", LI_LINK)
