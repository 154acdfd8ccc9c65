"""Registered queries: scalar rules (FN-*, PRJ-4, HMM-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as FV
from ..functions import periods as PD
from ..functions import scalars as S
from .registry import query
from .tables import read

LI_HREF = r'<li><a href="([^"]*)">'


@query(sql="""
SELECT c_custkey,
  lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik,
  CASE WHEN length(CAST(c_custkey * 10000000 AS VARCHAR)) >= 10 THEN CAST(c_custkey * 10000000 AS VARCHAR)
       ELSE lpad(CAST(c_custkey * 10000000 AS VARCHAR), 10, '0') END AS cik_long,
  CASE WHEN ltrim('000' || CAST(c_custkey AS VARCHAR), '0') = '' THEN '0000000000'
       ELSE lpad(ltrim('000' || CAST(c_custkey AS VARCHAR), '0'), 10, '0') END AS cik_padded
FROM customer""")
def q_zfill(spark, d):
    """FN-1: ids as 10-digit text; longer ids keep every digit."""
    c = read(spark, d, "customer").select("c_custkey")
    return c.select("c_custkey", S.normalize_cik(F.col("c_custkey")).alias("cik"),
                    S.normalize_cik(F.col("c_custkey") * 10000000).alias("cik_long"),
                    S.normalize_cik(F.concat(F.lit("000"), F.col("c_custkey").cast("string"))).alias("cik_padded"))


@query(sql="""
WITH r AS (
  SELECT o_orderkey,
    CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN strftime(o_orderdate, '%Y%m%d')
         WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y/%m/%d')
         ELSE strftime(o_orderdate, '%Y') || '-13-01' END AS raw
  FROM orders)
SELECT o_orderkey, raw,
  CAST(CASE WHEN regexp_matches(raw, '^[0-9]{8}$') THEN try_strptime(raw, '%Y%m%d')
            WHEN length(raw) = 10 AND substr(raw, 5, 1) = '-' AND substr(raw, 8, 1) = '-'
            THEN try_strptime(raw, '%Y-%m-%d') END AS DATE) AS filing_date
FROM r""")
def q_filed_date(spark, d):
    """FN-2: compact or dashed filing dates; other shapes give null."""
    o = read(spark, d, "orders")
    pri = F.col("o_orderpriority")
    raw = (F.when(pri.isin("1-URGENT", "3-MEDIUM"), F.date_format("o_orderdate", "yyyyMMdd"))
            .when(pri == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(pri == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy/MM/dd"))
            .otherwise(F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-13-01"))))
    r = o.select("o_orderkey", raw.alias("raw"))
    return r.select("o_orderkey", "raw", S.filed_date(F.col("raw")).alias("filing_date"))


@query(sql="""
SELECT page_id, url,
  CASE WHEN len(string_split(url, '/')) >= 4
       THEN nullif(regexp_replace(string_split(url, '/')[-1], '\\.txt$', ''), '') END AS accession
FROM pages""")
def q_accession(spark, d):
    """FN-3: last path segment without '.txt' when the path is deep enough."""
    p = read(spark, d, "pages").select("page_id", "url")
    return p.select("page_id", "url", S.accession_from_path(F.col("url")).alias("accession"))


BLS_CODES_SQL = """
codes AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN 'M' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
      WHEN '2-HIGH' THEN 'Q0' || CAST(quarter(o_orderdate) AS VARCHAR)
      WHEN '3-MEDIUM' THEN 'S0' || CAST(CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS VARCHAR)
      WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'F' THEN 'M13' WHEN o_orderstatus = 'O' THEN 'A01' ELSE 'Q05' END
      ELSE CASE WHEN o_orderstatus = 'F' THEN 'MXX' ELSE 'S03' END END AS period
  FROM orders
)"""


def bls_codes(spark, d):
    o = read(spark, d, "orders")
    pri, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    period = (F.when(pri == "1-URGENT", F.concat(F.lit("M"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0")))
               .when(pri == "2-HIGH", F.concat(F.lit("Q0"), F.quarter("o_orderdate").cast("string")))
               .when(pri == "3-MEDIUM", F.concat(F.lit("S0"), F.when(F.month("o_orderdate") <= 6, "1").otherwise("2")))
               .when(pri == "4-NOT SPECIFIED", F.when(st == "F", "M13").when(st == "O", "A01").otherwise("Q05"))
               .otherwise(F.when(st == "F", "MXX").otherwise("S03")))
    return o.select("o_orderkey", F.year("o_orderdate").cast("string").alias("year"), period.alias("period"))


@query(sql="WITH " + BLS_CODES_SQL + """
SELECT o_orderkey, year, period,
  CASE WHEN m >= 1 THEN CAST(try_strptime(year || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-01', '%Y-%m-%d') AS DATE) END AS date
FROM (
  SELECT *, CASE
      WHEN starts_with(period, 'M') THEN CASE WHEN TRY_CAST(substr(period, 2) AS INTEGER) BETWEEN 1 AND 12
                                              THEN TRY_CAST(substr(period, 2) AS INTEGER) ELSE 1 END
      WHEN starts_with(period, 'Q') THEN coalesce((TRY_CAST(substr(period, 2) AS INTEGER) - 1) * 3 + 1, 1)
      WHEN starts_with(period, 'S') THEN coalesce((TRY_CAST(substr(period, 2) AS INTEGER) - 1) * 6 + 1, 1)
      ELSE 1 END AS m
  FROM codes)""")
def q_period_bls(spark, d):
    """FN-4: labour period codes -> first day of the period (M13, A..,
    unknown -> January 1; impossible months -> null)."""
    c = bls_codes(spark, d)
    return c.select("o_orderkey", "year", "period", PD.labour_period_date(F.col("year"), F.col("period")).alias("date"))


@query(sql="""
WITH c AS (
  SELECT o_orderkey,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)
      WHEN '2-HIGH' THEN CAST(year(o_orderdate) AS VARCHAR) || 'M' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
      WHEN '3-MEDIUM' THEN CAST(year(o_orderdate) AS VARCHAR)
      WHEN '4-NOT SPECIFIED' THEN CAST(year(o_orderdate) AS VARCHAR) || '-W' || lpad(CAST(week(o_orderdate) AS VARCHAR), 2, '0')
      ELSE CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m') ELSE 'n/a' END END AS code
  FROM orders)
SELECT o_orderkey, code, CAST(CASE
    WHEN regexp_matches(code, '^\\d{4}-\\d{2}-\\d{2}') THEN try_strptime(substr(code, 1, 10), '%Y-%m-%d')
    WHEN regexp_matches(code, '^(\\d{4})[Qq]([1-4])') THEN try_strptime(substr(code, 1, 4) || '-' ||
         lpad(CAST((CAST(substr(code, 6, 1) AS INTEGER) - 1) * 3 + 1 AS VARCHAR), 2, '0') || '-01', '%Y-%m-%d')
    WHEN regexp_matches(code, '^(\\d{4})[Mm](\\d{2})') THEN try_strptime(substr(code, 1, 4) || '-' || substr(code, 6, 2) || '-01', '%Y-%m-%d')
    WHEN regexp_matches(code, '^\\d{4}-\\d{2}$') THEN try_strptime(code || '-01', '%Y-%m-%d')
    WHEN regexp_matches(code, '^\\d{4}$') THEN try_strptime(code || '-01-01', '%Y-%m-%d')
    WHEN regexp_matches(code, '^(\\d{4})-[Ww](\\d{2})') THEN try_strptime(substr(code, 1, 4) || '-01-01', '%Y-%m-%d')
  END AS DATE) AS date
FROM c""")
def q_period_eu(spark, d):
    """FN-5: European period codes (quarter, month, year, week, ISO)."""
    o = read(spark, d, "orders")
    pri, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    y = F.year("o_orderdate").cast("string")
    code = (F.when(pri == "1-URGENT", F.concat(y, F.lit("Q"), F.quarter("o_orderdate").cast("string")))
             .when(pri == "2-HIGH", F.concat(y, F.lit("M"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0")))
             .when(pri == "3-MEDIUM", y)
             .when(pri == "4-NOT SPECIFIED",
                   F.concat(y, F.lit("-W"), F.lpad(F.weekofyear("o_orderdate").cast("string"), 2, "0")))
             .otherwise(F.when(st == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
                        .when(st == "O", F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.lit("n/a"))))
    c = o.select("o_orderkey", code.alias("code"))
    return c.select("o_orderkey", "code", PD.european_period_date(F.col("code")).alias("date"))


@query(sql="""
WITH c AS (
  SELECT o_orderkey,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR)
      WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m')
      WHEN '3-MEDIUM' THEN CAST(year(o_orderdate) AS VARCHAR)
      WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d')
      ELSE CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS VARCHAR) || '-13' ELSE 'n/a' END END AS code
  FROM orders)
SELECT o_orderkey, code, CAST(CASE
    WHEN regexp_matches(code, '^\\d{4}-\\d{2}-\\d{2}') THEN try_strptime(substr(code, 1, 10), '%Y-%m-%d')
    WHEN regexp_matches(code, '^(\\d{4})-[Qq]([1-4])') THEN try_strptime(substr(code, 1, 4) || '-' ||
         lpad(CAST((CAST(substr(code, 7, 1) AS INTEGER) - 1) * 3 + 1 AS VARCHAR), 2, '0') || '-01', '%Y-%m-%d')
    WHEN regexp_matches(code, '^\\d{4}-\\d{2}') AND CAST(substr(code, 6, 2) AS INTEGER) BETWEEN 1 AND 12
         THEN try_strptime(substr(code, 1, 7) || '-01', '%Y-%m-%d')
    WHEN regexp_matches(code, '^\\d{4}$') THEN try_strptime(code || '-01-01', '%Y-%m-%d')
  END AS DATE) AS date
FROM c""")
def q_period_bis(spark, d):
    """FN-6: banking period codes (quarter, month, year, ISO)."""
    o = read(spark, d, "orders")
    pri, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    y = F.year("o_orderdate").cast("string")
    code = (F.when(pri == "1-URGENT", F.concat(y, F.lit("-Q"), F.quarter("o_orderdate").cast("string")))
             .when(pri == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM"))
             .when(pri == "3-MEDIUM", y)
             .when(pri == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd"))
             .otherwise(F.when(st == "F", F.concat(y, F.lit("-13"))).otherwise(F.lit("n/a"))))
    c = o.select("o_orderkey", code.alias("code"))
    return c.select("o_orderkey", "code", PD.banking_period_date(F.col("code")).alias("date"))


def _country_sql(geo: str, sid: str) -> str:
    codes = sorted(FV.COUNTRY_CODES, key=lambda kv: -len(kv[0]))
    parts = [f"WHEN strpos(upper(coalesce({geo}, '')), '{c}') > 0 THEN '{n}'" for c, n in codes]
    parts += [f"WHEN strpos(upper(coalesce({sid}, '')), '{c}') > 0 THEN '{n}'" for c, n in codes]
    return "CASE " + " ".join(parts) + f" ELSE '{FV.DEFAULT_COUNTRY}' END"


COUNTRY_INPUT_SQL = """
x AS (
  SELECT c_custkey,
    CASE WHEN c_nationkey % 5 = 0 THEN c_name || ' (CAN)' WHEN c_nationkey % 5 = 1 THEN 'in ' || c_mktsegment ELSE NULL END AS geography,
    upper(substr(c_mktsegment, 1, 3)) || 'GDP' || CASE WHEN c_custkey % 3 = 0 THEN 'AUS' ELSE '' END AS series_id
  FROM customer
)"""


@query(sql="WITH " + COUNTRY_INPUT_SQL + """
SELECT c_custkey, geography, series_id, """ + _country_sql("geography", "series_id") + """ AS country FROM x""")
def q_country(spark, d):
    """FN-8: country from geography text or series id, longest code first
    (so 'AUS' is not read as 'US'), default United States."""
    c = read(spark, d, "customer")
    geo = (F.when(F.col("c_nationkey") % 5 == 0, F.concat("c_name", F.lit(" (CAN)")))
            .when(F.col("c_nationkey") % 5 == 1, F.concat(F.lit("in "), "c_mktsegment")))
    sid = F.concat(F.upper(F.substring("c_mktsegment", 1, 3)), F.lit("GDP"),
                   F.when(F.col("c_custkey") % 3 == 0, F.lit("AUS")).otherwise(F.lit("")))
    x = c.select("c_custkey", geo.alias("geography"), sid.alias("series_id"))
    return x.select("c_custkey", "geography", "series_id",
                    S.country_of(F.col("series_id"), F.col("geography")).alias("country"))


PREFIXES = ["CUUR", "CUUS", "SUUR", "WPU", "PCU", "CES", "CEU", "LNS", "IWP", "EWP", "XXX"]


@query(sql="""
WITH x AS (
  SELECT p_partkey, ['CUUR', 'CUUS', 'SUUR', 'WPU', 'PCU', 'CES', 'CEU', 'LNS', 'IWP', 'EWP', 'XXX'][p_size % 11 + 1]
         || CAST(p_partkey AS VARCHAR) AS series_id FROM part)
SELECT p_partkey, series_id, CASE
  WHEN starts_with(series_id, 'CUUR') OR starts_with(series_id, 'CUUS') THEN 'CU'
  WHEN starts_with(series_id, 'SUUR') THEN 'SU'
  WHEN starts_with(series_id, 'WPU') OR starts_with(series_id, 'PCU') THEN 'WP'
  WHEN starts_with(series_id, 'CES') OR starts_with(series_id, 'CEU') THEN 'CE'
  WHEN starts_with(series_id, 'LNS') THEN 'LN'
  WHEN starts_with(series_id, 'IWP') THEN 'IW'
  WHEN starts_with(series_id, 'EWP') THEN 'EW'
  ELSE 'Unknown' END AS survey,
  'BLS Series ' || series_id AS description
FROM x""")
def q_prefix_class(spark, d):
    """FN-9/FN-22: survey from a series-id prefix; description text."""
    p = read(spark, d, "part")
    sid = F.concat(F.element_at(F.array(*[F.lit(x) for x in PREFIXES]), (F.col("p_size") % 11 + 1).cast("int")),
                   F.col("p_partkey").cast("string"))
    x = p.select("p_partkey", sid.alias("series_id"))
    return x.select("p_partkey", "series_id", S.survey_of(F.col("series_id")).alias("survey"),
                    S.series_description(F.col("series_id")).alias("description"))


GRID_SUFFIXES = ["0000000001", "0000000002", "U00000001"]


@query(sql="""
SELECT c_custkey, 'LAU' || upper(substr(c_mktsegment, 1, 2)) || s.suffix AS candidate_id
FROM customer, (VALUES ('0000000001'), ('0000000002'), ('U00000001')) s(suffix)""")
def q_id_grid(spark, d):
    """FN-10: candidate ids, prefix x fixed suffix list (per-row fan-out)."""
    c = read(spark, d, "customer")
    prefix = F.concat(F.lit("LAU"), F.upper(F.substring("c_mktsegment", 1, 2)))
    return c.select("c_custkey", S.id_grid(prefix, GRID_SUFFIXES).alias("candidate_id"))


CELLS_SQL = """
x AS (
  SELECT p_partkey,
    [CASE WHEN p_size < 10 THEN ' ' ELSE p_brand END, CASE WHEN p_size > 40 THEN lower(substr(p_type, 1, 3)) ELSE p_name END,
     p_type, CAST(p_size AS VARCHAR)] AS cells
  FROM part
)"""


@query(sql="WITH " + CELLS_SQL + """,
t AS (
  SELECT p_partkey, cells,
    list_filter(list_transform(cells, lambda c: trim(upper(c))),
                lambda c: length(c) > 0 AND length(c) <= 5 AND regexp_matches(c, '^[[:alnum:]]+$'))[1] AS ticker
  FROM x)
SELECT p_partkey, ticker,
  list_filter(cells, lambda c: length(c) > 5 AND (ticker IS NULL OR c <> ticker))[1] AS name
FROM t""")
def q_cell_detect(spark, d):
    """FN-11: ticker = first short alphanumeric cell, name = first long cell."""
    p = read(spark, d, "part")
    cells = F.array(F.when(F.col("p_size") < 10, F.lit(" ")).otherwise(F.col("p_brand")),
                    F.when(F.col("p_size") > 40, F.lower(F.substring("p_type", 1, 3))).otherwise(F.col("p_name")),
                    F.col("p_type"), F.col("p_size").cast("string"))
    x = p.select("p_partkey", cells.alias("cells"))
    t = x.withColumn("ticker", S.detect_ticker(F.col("cells")))
    return t.select("p_partkey", "ticker", S.detect_name(F.col("cells"), F.col("ticker")).alias("name"))


HEADERS = ["Ticker Symbol", "Fund Name", "Asset Class", "Expense Ratio", "Net Assets", "Primary Benchmark"]


@query(sql="""
WITH x AS (
  SELECT p_partkey,
    CASE WHEN p_size % 2 = 0 THEN ['Ticker Symbol', 'Fund Name', 'Asset Class', 'Expense Ratio', 'Net Assets', 'Primary Benchmark']
         ELSE ['Fund Name', 'Ticker Symbol', 'Primary Benchmark', 'Net Assets', 'Asset Class', 'Expense Ratio'] END AS headers,
    CASE WHEN p_size % 2 = 0 THEN ['P' || CAST(p_partkey AS VARCHAR), p_name, p_type, '', CAST(p_size AS VARCHAR), p_brand]
         ELSE [p_name, 'P' || CAST(p_partkey AS VARCHAR), p_brand, CAST(p_size AS VARCHAR), p_type, ''] END AS cells
  FROM part
)
SELECT p_partkey,
  nullif(cells[list_position(list_transform(headers, lambda h: regexp_matches(lower(h), 'ticker|symbol|ticker symbol')), true)], '') AS ticker,
  nullif(cells[list_position(list_transform(headers, lambda h: regexp_matches(lower(h), 'name|fund name|etf name|product name')), true)], '') AS name,
  nullif(cells[list_position(list_transform(headers, lambda h: regexp_matches(lower(h), 'asset class|asset|category')), true)], '') AS asset_class,
  nullif(cells[list_position(list_transform(headers, lambda h: regexp_matches(lower(h), 'expense ratio|exp ratio|er|fee')), true)], '') AS expense_ratio,
  nullif(cells[list_position(list_transform(headers, lambda h: regexp_matches(lower(h), 'benchmark|index|primary benchmark')), true)], '') AS primary_benchmark
FROM x""")
def q_header_map(spark, d):
    """FN-12: each field takes the cell under the first header that
    contains one of its aliases."""
    p = read(spark, d, "part")
    even = F.col("p_size") % 2 == 0
    pk = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    headers = F.when(even, F.array(*[F.lit(h) for h in HEADERS])).otherwise(
        F.array(*[F.lit(h) for h in ["Fund Name", "Ticker Symbol", "Primary Benchmark", "Net Assets",
                                      "Asset Class", "Expense Ratio"]]))
    cells = F.when(even, F.array(pk, F.col("p_name"), F.col("p_type"), F.lit(""), F.col("p_size").cast("string"),
                                 F.col("p_brand"))).otherwise(
        F.array(F.col("p_name"), pk, F.col("p_brand"), F.col("p_size").cast("string"), F.col("p_type"), F.lit("")))
    x = p.select("p_partkey", headers.alias("headers"), cells.alias("cells"))
    aliases = dict(FV.HEADER_ALIASES)
    fields = ["ticker", "name", "asset_class", "expense_ratio", "primary_benchmark"]
    return x.select("p_partkey", *[S.header_field(F.col("headers"), F.col("cells"), aliases[f]).alias(f)
                                   for f in fields])


LABELS = ["upLast7Days", "upLast30Days", "downLast7Days", "downLast30Days", "numberOfAnalysts", "avgEstimate",
          "lowEstimate", "highEstimate", "yearAgoSales", "salesGrowth", "growthUpSeven"]


@query(sql="""
WITH x AS (
  SELECT o_orderkey, ['upLast7Days', 'upLast30Days', 'downLast7Days', 'downLast30Days', 'numberOfAnalysts', 'avgEstimate',
          'lowEstimate', 'highEstimate', 'yearAgoSales', 'salesGrowth', 'growthUpSeven'][o_orderkey % 11 + 1] AS label
  FROM orders)
SELECT o_orderkey, label,
  CASE WHEN strpos(lower(label), 'up') > 0 AND (strpos(lower(label), '7') > 0 OR strpos(lower(label), 'seven') > 0) THEN 'up_last_7_days'
       WHEN strpos(lower(label), 'up') > 0 AND (strpos(lower(label), '30') > 0 OR strpos(lower(label), 'thirty') > 0) THEN 'up_last_30_days'
       WHEN strpos(lower(label), 'down') > 0 AND (strpos(lower(label), '7') > 0 OR strpos(lower(label), 'seven') > 0) THEN 'down_last_7_days'
       WHEN strpos(lower(label), 'down') > 0 AND (strpos(lower(label), '30') > 0 OR strpos(lower(label), 'thirty') > 0) THEN 'down_last_30_days'
  END AS eps_field,
  CASE WHEN strpos(lower(label), 'number') > 0 AND strpos(lower(label), 'analyst') > 0 THEN 'num_analysts'
       WHEN strpos(lower(label), 'avg') > 0 OR strpos(lower(label), 'average') > 0 OR strpos(lower(label), 'mean') > 0 THEN 'avg_estimate'
       WHEN strpos(lower(label), 'low') > 0 OR strpos(lower(label), 'min') > 0 THEN 'low_estimate'
       WHEN strpos(lower(label), 'high') > 0 OR strpos(lower(label), 'max') > 0 THEN 'high_estimate'
       WHEN strpos(lower(label), 'year') > 0 AND strpos(lower(label), 'ago') > 0 THEN 'year_ago_sales'
       WHEN strpos(lower(label), 'growth') > 0 THEN 'sales_growth'
  END AS revenue_field
FROM x""")
def q_label_class(spark, d):
    """FN-13: analyst-table row labels -> field names, first rule wins."""
    o = read(spark, d, "orders")
    label = F.element_at(F.array(*[F.lit(x) for x in LABELS]), (F.col("o_orderkey") % 11 + 1).cast("int"))
    x = o.select("o_orderkey", label.alias("label"))
    return x.select("o_orderkey", "label", S.classify_label(F.col("label"), FV.EPS_REVISION_RULES).alias("eps_field"),
                    S.classify_label(F.col("label"), FV.REVENUE_ESTIMATE_RULES).alias("revenue_field"))


@query(sql="""
SELECT page_id, coalesce(
  nullif(regexp_extract(html, '(?i)As of\\s+(\\d{1,2}[/-]\\d{1,2}[/-]\\d{2,4})', 1), ''),
  nullif(regexp_extract(html, '(?i)as of\\s+(\\d{1,2}[/-]\\d{1,2}[/-]\\d{2,4})', 1), ''),
  nullif(regexp_extract(html, '(?i)Date:\\s*(\\d{1,2}[/-]\\d{1,2}[/-]\\d{2,4})', 1), ''),
  nullif(regexp_extract(html, '(?i)(\\d{1,2}[/-]\\d{1,2}[/-]\\d{2,4})', 1), '')) AS as_of
FROM pages""")
def q_asof_text(spark, d):
    """FN-14: as-of date text from page text ('As of' preferred)."""
    p = read(spark, d, "pages")
    return p.select("page_id", S.as_of_date(F.col("html")).alias("as_of"))


@query(sql=f"""
WITH x AS (
  SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS host,
         unnest(regexp_extract_all(html, '{LI_HREF}', 1)) AS href
  FROM pages)
SELECT page_id, href, CASE WHEN starts_with(href, 'http') THEN href
                           WHEN starts_with(href, '/') THEN host || href ELSE host || '/' || href END AS abs_url
FROM x""")
def q_abs_url(spark, d):
    """FN-15: relative links made absolute with the page's host."""
    p = read(spark, d, "pages")
    x = p.select("page_id", S.host_of(F.col("url")).alias("host"),
                 F.explode(F.regexp_extract_all("html", F.lit(LI_HREF), 1)).alias("href"))
    h = F.col("href")
    absu = (F.when(h.startswith("http"), h).when(h.startswith("/"), F.concat("host", h))
             .otherwise(F.concat(F.col("host"), F.lit("/"), h)))
    return x.select("page_id", "href", absu.alias("abs_url"))


@query(sql="""
SELECT l_orderkey, l_linenumber,
  nullif(array_to_string(list_filter([CASE WHEN l_returnflag <> 'N' THEN 'returned ' || l_returnflag END,
                                      CASE WHEN l_linestatus = 'O' THEN 'open' END], lambda x: x IS NOT NULL), ', '), '') AS footnotes
FROM lineitem""")
def q_array_join(spark, d):
    """FN-17/FN-18: list of notes -> ', '-joined text, empty -> null."""
    li = read(spark, d, "lineitem")
    notes = F.filter(F.array(F.when(F.col("l_returnflag") != "N", F.concat(F.lit("returned "), "l_returnflag")),
                             F.when(F.col("l_linestatus") == "O", F.lit("open"))), lambda x: x.isNotNull())
    return li.select("l_orderkey", "l_linenumber", S.join_notes(notes).alias("footnotes"))


@query(sql="""
SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS dims_json,
       json_extract_string(props, '$.k') AS k
FROM events""")
def q_map_json(spark, d):
    """FN-19: JSON text -> map -> canonical JSON text."""
    ev = read(spark, d, "events").select("event_id", S.json_to_dims(F.col("props")).alias("dims"))
    return ev.select("event_id", S.dims_to_json(F.col("dims")).alias("dims_json"),
                     F.element_at("dims", F.lit("k")).alias("k"))


@query(sql="""
WITH x AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'view' THEN ''
                                 ELSE json_extract_string(props, '$.k') END AS raw FROM events)
SELECT event_id, raw, TRY_CAST(trim(raw) AS DOUBLE) AS value FROM x""")
def q_try_cast(spark, d):
    """FN-20: text -> double, missing or bad text -> null."""
    ev = read(spark, d, "events")
    raw = (F.when(F.col("event_type") == "error", F.lit("n/a")).when(F.col("event_type") == "view", F.lit(""))
            .otherwise(F.get_json_object("props", "$.k")))
    x = ev.select("event_id", raw.alias("raw"))
    return x.select("event_id", "raw", S.to_double(F.col("raw")).alias("value"))


@query(sql="""
SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS volume,
       CAST(CAST(l_discount * 100 AS DECIMAL(10, 0)) AS VARCHAR) AS discount_pct,
       CAST(NULL AS VARCHAR) AS missing
FROM lineitem""")
def q_stringify(spark, d):
    """FN-21: values to text; integral volumes without decimals; null stays
    null (decimals cast before text so engines agree)."""
    li = read(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", S.stringify(F.col("l_quantity"), integral=True).alias("volume"),
                     (F.col("l_discount") * 100).cast("decimal(10,0)").cast("string").alias("discount_pct"),
                     S.stringify(F.lit(None).cast("double")).alias("missing"))


@query(sql="""
SELECT p_partkey, p_name || ' (' || CAST(p_partkey AS VARCHAR) || ')' AS description FROM part""")
def q_format(spark, d):
    """FN-22: 'name (code)' descriptions."""
    p = read(spark, d, "part")
    return p.select("p_partkey", S.describe_code(F.col("p_name"), F.col("p_partkey")).alias("description"))


@query(sql=f"""
SELECT page_id, list_filter(regexp_extract_all(html, '{LI_HREF}', 1),
                            lambda h: strpos(h, '/and') > 0 OR strpos(h, '/the') > 0)[1] AS first_link
FROM pages""")
def q_first_link(spark, d):
    """FN-24: first link containing one of the marker paths."""
    p = read(spark, d, "pages")
    hrefs = F.regexp_extract_all("html", F.lit(LI_HREF), 1)
    return p.select("page_id", S.first_link(hrefs, ["/and", "/the"]).alias("first_link"))


@query(sql="""
SELECT p_partkey, k, i AS regime_idx,
  CASE WHEN k = 2 THEN ['Expansion', 'Contraction'][i + 1]
       WHEN k = 3 THEN ['Expansion', 'Peak', 'Contraction'][i + 1]
       WHEN k = 4 THEN ['Expansion', 'Peak', 'Contraction', 'Trough'][i + 1]
       ELSE 'Regime_' || CAST(i + 1 AS VARCHAR) END AS regime
FROM (SELECT p_partkey, p_size % 6 + 2 AS k FROM part) n, range(0, 8) r(i)
WHERE i < k""")
def q_regime_names(spark, d):
    """HMM-8: names of the states of a model of size k for each part (its size
    modulo 6, plus 2)."""
    n = read(spark, d, "part").select("p_partkey", (F.col("p_size") % 6 + 2).alias("k"))
    x = n.select("p_partkey", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("regime_idx"))
    named = [F.when(F.col("k") == k, S.regime_name(k, "regime_idx")) for k in (2, 3, 4)]
    names = F.coalesce(*named, S.regime_name(0, "regime_idx"))
    return x.select("p_partkey", "k", F.col("regime_idx").cast("long").alias("regime_idx"), names.alias("regime"))


@query(sql="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS created_at FROM orders""")
def q_iso_text(spark, d):
    """PRJ-4: timestamps rendered as ISO text with microseconds."""
    from ..operators.filters import iso_text
    o = read(spark, d, "orders")
    return o.select("o_orderkey", iso_text("o_orderdate").alias("created_at"))
