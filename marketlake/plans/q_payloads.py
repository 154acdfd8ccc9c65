"""Payload and small lookup operators over payloads built from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import benchmark_key, quarter_label
from ..operators.filters import ids_from_query
from ..operators.upsert import ledger_lookup
from ..sources.landed import dimension_keywords, embedded_json_block, parse_structure_json, table_pairs
from .q_filters import LEDGER_SQL, quarter_ledger
from .registry import query
from .tables import read


# ------------------------------------------------------------------- SRC-13
@query(sql="""
SELECT s_suppkey AS page, 'Name' AS key, s_name AS value FROM supplier WHERE s_name <> ''
UNION ALL SELECT s_suppkey, 'Nation', CAST(s_nationkey AS VARCHAR) FROM supplier""")
def q_table_pairs(spark, d):
    """SRC-13: key/value rows of one section's table; the heading row of one
    cell and the table outside the section give none."""
    s = read(spark, d, "supplier")
    page = F.concat(F.lit("<table><tr><td>Other</td><td>x</td></tr></table><section id=\"facts\"><table>"
                          "<thead><tr><th>Supplier</th></tr></thead><tr><td>Name</td><td><b>"), F.coalesce("s_name", F.lit("")),
                    F.lit("</b></td></tr><tr><td>Nation</td><td>"), F.col("s_nationkey").cast("string"),
                    F.lit("</td></tr><tr><td>Key</td><td>Value</td></tr></table></section>"))
    return table_pairs(s.select(F.col("s_suppkey").alias("page"), page.alias("html")), ["page"], "html", section="facts")


# ------------------------------------------------------------- SRC-8, FN-18
@query(sql="""
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS dataset,
       CASE WHEN p_size % 2 = 0 THEN 'unit, ' || lower(p_brand) ELSE lower(p_brand) || ', time, unit' END AS keywords FROM part""")
def q_dim_keywords(spark, d):
    """FN-18/SRC-8: the dimensions of each dataset in their given order."""
    p = read(spark, d, "part")

    def dim(k, v):
        return F.concat(F.lit('"'), k, F.lit('": {"label": {"en": "'), k, F.lit(f'"}}, "values": [{{"id": "{v}", "label": "{v}"}}]}}'))
    brand, unit, time = F.lower("p_brand"), F.lit("unit"), F.lit("time")
    dims = F.when(F.col("p_size") % 2 == 0, F.concat_ws(", ", dim(unit, "EUR"), dim(brand, "DE"))).otherwise(
        F.concat_ws(", ", dim(brand, "DE"), dim(time, "M"), dim(unit, "EUR")))
    body = F.concat(F.lit('{"structure": {"dimensions": {'), dims, F.lit("}}}"))
    code = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    rows = parse_structure_json(p.select(code.alias("code"), body.alias("value")), dataset_col="code")
    return dimension_keywords(rows)


# ------------------------------------------------------------------- SRC-14
@query(sql="""
SELECT p_partkey AS id, CAST(p_size AS VARCHAR) AS size, p_brand AS brand FROM part WHERE p_size % 5 <> 0
UNION ALL SELECT p_partkey, NULL, NULL FROM part WHERE p_size % 5 = 0""")
def q_embedded_block(spark, d):
    """SRC-14: a JSON object inside page text; null where the page has none."""
    p = read(spark, d, "part")
    text = F.concat(F.lit('<script>root = {"valuationMeasures" : {"size": "'), F.col("p_size").cast("string"),
                    F.lit('", "brand": "'), F.col("p_brand"), F.lit('"}, "x": 1}</script>'))
    page = F.when(F.col("p_size") % 5 == 0, F.lit("<p>nothing here</p>")).otherwise(text)
    out = embedded_json_block(p.select(F.col("p_partkey").alias("id"), page.alias("html")), "html")
    block = F.col("valuationMeasures")
    return out.select("id", block["size"].alias("size"), block["brand"].alias("brand"))


# -------------------------------------------------------------------- FN-16
@query(sql="""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_name
  ELSE trim(c_mktsegment) END AS benchmark FROM customer""")
def q_benchmark_key(spark, d):
    """FN-16: the first benchmark name that is given, trimmed."""
    c = read(spark, d, "customer")
    first = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).when(
        F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")))
    return c.withColumn("first", first).select("c_custkey", benchmark_key("first", "c_name").alias("benchmark"))


# -------------------------------------------------------------------- FN-23
@query(sql="""
SELECT CAST(p_partkey AS VARCHAR) AS series_id FROM part WHERE p_brand IS NOT NULL""")
def q_query_ids(spark, d):
    """FN-23: series ids from a user query, blanks dropped."""
    p = read(spark, d, "part")
    p.createOrReplaceTempView("fn23_part")
    return ids_from_query(spark.sql(
        "SELECT p_brand, CASE WHEN p_brand IS NOT NULL THEN concat(' ', p_partkey) END AS series_id FROM fn23_part"))


# -------------------------------------------------------------------- FN-7
@query(sql="""
SELECT o_orderkey, CASE WHEN month(o_orderdate) <= 3 THEN 'QTR1' WHEN month(o_orderdate) <= 6 THEN 'QTR2'
  WHEN month(o_orderdate) <= 9 THEN 'QTR3' ELSE 'QTR4' END AS quarter FROM orders WHERE o_orderdate IS NOT NULL""")
def q_quarter_label(spark, d):
    """FN-7: the quarter's name from a date."""
    return read(spark, d, "orders").where("o_orderdate is not null").select("o_orderkey", quarter_label("o_orderdate").alias("quarter"))


# -------------------------------------------------------------------- UPS-10
@query(sql="WITH " + LEDGER_SQL + """
SELECT year, quarter, status, retry_count FROM ledger WHERE year = 1996 AND quarter = 'QTR2'""")
def q_ledger_lookup(spark, d):
    """UPS-10: one ledger row by its key, or none."""
    return ledger_lookup(quarter_ledger(spark, d), year=1996, quarter="QTR2").select("year", "quarter", "status", "retry_count")
