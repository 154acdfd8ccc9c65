"""Registered queries: landed payloads and reshapes over payloads that Spark
builds from the given tables, one document per row."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import filters as FL
from ..operators import joins as J
from ..operators import reshape as RS
from ..sources import landed as L
from .registry import query
from .tables import daily_series, read


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# ------------------------------------------------------------- SRC-6, RSH-3
@query(sql="""
SELECT o_orderkey AS code, CASE o_orderstatus WHEN 'F' THEN 'DE' WHEN 'O' THEN 'FR' ELSE 'US' END AS area,
       make_date(year(o_orderdate), (quarter(o_orderdate) - 1) * 3 + 1, 1) AS date, CAST(o_custkey AS DOUBLE) AS value
FROM orders""")
def q_sdmx_json(spark, d):
    """SRC-6: one SDMX message per order; index keys decoded, the time code
    parsed, a value that is no number dropped."""
    o = read(spark, d, "orders")
    area = F.when(F.col("o_orderstatus") == "F", "0").when(F.col("o_orderstatus") == "O", "1").otherwise("2")
    quarter = _text(F.year("o_orderdate"), "-Q", F.quarter("o_orderdate"))
    doc = _text('{"structure":{"dimensions":{"observation":[{"id":"REF_AREA","values":[{"id":"DE"},{"id":"FR"},{"id":"US"}]},'
                '{"id":"TIME_PERIOD","values":[{"id":"1900"},{"id":"', quarter, '"}]}]}},"dataSets":[{"observations":{"', area,
                ':1":["', F.col("o_custkey"), '"],"', area, ':0":["n/a"]}}]}')
    out = L.parse_sdmx_json(o.select(F.col("o_orderkey").alias("code"), doc.alias("value")), code_col="code")
    return out.select("code", F.element_at("dimensions", F.lit("REF_AREA")).alias("area"), "date", "value")


@query(sql="""
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS flag,
       CAST(l_linenumber AS VARCHAR) AS line, CAST(l_partkey AS DOUBLE) AS value FROM lineitem WHERE l_linestatus = 'F'""")
def q_observation_rows(spark, d):
    """RSH-3: index-keyed observations to rows with named dimension indexes;
    values that are no numbers dropped."""
    li = read(spark, d, "lineitem")
    key = _text(F.when(F.col("l_returnflag") == "R", "1").otherwise("0"), ":", F.col("l_linenumber"))
    value = F.when(F.col("l_linestatus") == "F", F.col("l_partkey").cast("string")).otherwise("open")
    docs = li.select("l_orderkey", "l_linenumber", F.create_map(key, F.array(value, F.lit("A"))).alias("observations"))
    out = RS.explode_observations(docs, "observations", ["flag", "line"], keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", F.element_at("dimensions", F.lit("flag")).alias("flag"),
                      F.element_at("dimensions", F.lit("line")).alias("line"), "value")


# -------------------------------------------------------------------- SRC-9
@query(sql="""
SELECT 'flow' AS kind, CASE p_size % 3 WHEN 0 THEN 'F' || p_partkey WHEN 1 THEN 'D' || p_partkey ELSE p_name END AS code, p_name AS name
FROM part
UNION ALL SELECT 'survey', 'S' || p_partkey, p_brand FROM part WHERE p_size % 2 = 0
UNION ALL SELECT 'fund', 'T' || p_partkey, NULL FROM part""")
def q_catalogue_json(spark, d):
    """SRC-9: data flows (id, else dataflowid, else name), surveys of payloads
    that succeeded, and funds as a list or under one of the known keys."""
    p = read(spark, d, "part")
    key = F.col("p_partkey")
    flow = F.when(F.col("p_size") % 3 == 0, _text('[{"id":"F', key, '","dataflowid":"x","name":"', F.col("p_name"), '"}]')).when(
        F.col("p_size") % 3 == 1, _text('[{"id":"","dataflowid":"D', key, '","name":"', F.col("p_name"), '"}]')).otherwise(
        _text('[{"name":"', F.col("p_name"), '"}]'))
    status = F.when(F.col("p_size") % 2 == 0, "REQUEST_SUCCEEDED").otherwise("REQUEST_FAILED")
    survey = _text('{"status":"', status, '","Results":{"survey":[{"survey_abbreviation":"S', key, '","survey_name":"', F.col("p_brand"), '"}]}}')
    fund = _text('[{"ticker":"T', key, '"}]')
    fund = F.when(F.col("p_size") % 2 == 0, fund).otherwise(_text('{"products":', fund, ',"items":[{"ticker":"no"}]}'))
    flows, surveys, funds = (f(p.select(doc.alias("value"))) for f, doc in (
        (L.parse_dataflows, flow), (L.parse_surveys, survey), (L.parse_fund_list, fund)))
    one = lambda kind, df, code, name: df.select(F.lit(kind).alias("kind"), code.alias("code"), name.alias("name"))
    return one("flow", flows, F.col("dataflow_id"), F.col("name")).unionByName(
        one("survey", surveys, F.col("survey_abbreviation"), F.col("survey_name"))).unionByName(
        one("fund", funds, F.element_at("fund", F.lit("ticker")), F.lit(None).cast("string")))


# ------------------------------------------------------------------- SRC-10
@query(sql="""
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, 'T' || CAST(c_custkey AS VARCHAR) AS ticker, c_name AS name FROM customer
UNION ALL SELECT lpad(CAST(c_custkey + 500000 AS VARCHAR), 10, '0'), 'U' || CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer""")
def q_company_tickers(spark, d):
    """SRC-10: an object of companies to rows with 10-digit ids."""
    c = read(spark, d, "customer")
    key = F.col("c_custkey")
    doc = _text('{"0":{"cik_str":', key, ',"ticker":"T', key, '","title":"', F.col("c_name"), '"},"1":{"cik_str":"', key + 500000,
                '","ticker":"U', key, '","title":"', F.col("c_mktsegment"), '"}}')
    return L.parse_company_tickers(c.select(doc.alias("value")))


# -------------------------------------------------------------------- PRJ-1
@query(sql="""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, coalesce(CAST(nullif(p_brand, 'Brand#1') AS VARCHAR), 'none') AS p_brand,
       CAST(NULL AS DOUBLE) AS weight, 'new' AS status, p_size FROM part""")
def q_align_schema(spark, d):
    """PRJ-1: columns in the schema's order and types, missing ones added (null
    or a default), extra ones kept behind."""
    p = read(spark, d, "part").select("p_size", "p_partkey", F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("p_brand"))
    schema = T.StructType([T.StructField("p_partkey", T.StringType()), T.StructField("p_brand", T.StringType()),
                           T.StructField("weight", T.DoubleType()), T.StructField("status", T.StringType())])
    return FL.align_to_schema(p, schema, {"p_brand": "none", "status": "new"})


# -------------------------------------------------------------------- RSH-2
@query(sql="""
SELECT s_suppkey, CASE WHEN s_nationkey % 4 > 0 THEN s_name END AS s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
       CAST(NULL AS VARCHAR) AS missing FROM supplier""")
def q_long_map(spark, d):
    """RSH-2: free columns to one text map and back to named columns; nulls are
    not stored, a key that no row has is null."""
    s = read(spark, d, "supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") % 4 > 0, F.col("s_name")).alias("s_name"), "s_nationkey")
    return RS.widen(RS.to_long_map(s, ["s_suppkey"]), ["s_suppkey"], "fields", ["s_name", "s_nationkey", "missing"])


# -------------------------------------------------------------------- RSH-1
@query(sql="""
WITH t AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS obs, o_custkey,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END AS note, o_orderdate, o_orderkey % 50 = 0 AS bad
  FROM orders),
x AS (SELECT make_date(year(o_orderdate), (quarter(o_orderdate) - 1) * 3 + 1, 1) AS date, * FROM t WHERE NOT bad)
SELECT date, 'o_custkey' AS variable, CAST(o_custkey AS DOUBLE) AS value, 'o_custkey' AS dimension FROM x
UNION ALL SELECT date, 'note', CAST(note AS DOUBLE), 'note' FROM x WHERE note <> 'n/a'""")
def q_melt_detect(spark, d):
    """RSH-1: a landed table whose time column and its format are found from
    the values; other columns become dated rows; values that are no numbers
    and rows whose time does not parse are dropped."""
    o = read(spark, d, "orders")
    obs = F.when(F.col("o_orderkey") % 50 == 0, "total").otherwise(_text(F.year("o_orderdate"), "Q", F.quarter("o_orderdate")))
    note = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_orderkey").cast("string"))
    return RS.melt_detected(o.select("o_custkey", obs.alias("obs"), note.alias("note"))).select(
        "date", "variable", "value", F.element_at("dimensions", F.lit("dimension")).alias("dimension"))


# ------------------------------------------------------------------- JOIN-2
@query(sql="""
WITH daily AS (
  SELECT CASE event_type WHEN 'click' THEN 'GDP' WHEN 'error' THEN 'UNRATE' WHEN 'view' THEN 'FEDFUNDS' ELSE event_type END AS id,
         CAST(ts AS DATE) AS date, round(sum(value), 2) AS value
  FROM events GROUP BY 1, 2)
SELECT date, max(value) FILTER (WHERE id = 'GDP') AS "GDP", max(value) FILTER (WHERE id = 'UNRATE') AS "UNRATE",
       max(value) FILTER (WHERE id = 'FEDFUNDS') AS "FEDFUNDS"
FROM daily WHERE id IN ('GDP', 'UNRATE', 'FEDFUNDS') GROUP BY date""")
def q_indicator_panel(spark, d):
    """JOIN-2: the named macro panel; its series without rows add no column."""
    names = {"click": "GDP", "error": "UNRATE", "view": "FEDFUNDS"}
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    long = daily_series(spark, d).withColumn("series_id", F.coalesce(F.try_element_at(known, F.col("series_id")), "series_id"))
    return J.indicator_panel(long, "macro")
