"""Scans of landed payloads (SRC-5 .. SRC-14, SRC-17).

Each parser takes a DataFrame of landed text (one document per row, as
``read.text(wholetext=True)`` or a JSON/XML reader yields) or a path, and
returns typed rows.  Parsing is ``from_json`` / ``explode`` /
``regexp_extract_all`` on the JVM; documents are independent, so the work
spreads over as many tasks as there are files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as FV
from ..functions.periods import banking_period_date, labour_period_date
from ..functions.scalars import join_notes, normalize_cik
from .files import CATALOGUE_TAGS, Catalogue, parse_files

# ------------------------------------------------------------------ SRC-5
LABOUR_SCHEMA = (
    "status string, Results struct<series: array<struct<seriesID: string, data: array<struct<"
    "year: string, period: string, value: string, footnotes: array<struct<code: string, text: string>>>>>>>")


def parse_labour_json(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Results.series[].data[] -> (series_id, date, year, period, value,
    footnotes).  Unparseable periods give a null date; values that are not
    numbers give null; footnote texts are joined by ', ' (empty -> null)."""
    j = docs.select(F.from_json(F.col(text_col), LABOUR_SCHEMA).alias("j"))
    s = j.select(F.explode("j.Results.series").alias("s"))
    o = s.select(F.col("s.seriesID").alias("series_id"), F.explode("s.data").alias("o"))
    notes = F.array_remove(F.col("o.footnotes.text"), "")  # nulls are skipped by array_join
    return o.select(
        "series_id",
        labour_period_date(F.col("o.year"), F.col("o.period")).alias("date"),
        F.col("o.year").alias("year"), F.col("o.period").alias("period"),
        F.trim(F.col("o.value")).try_cast("double").alias("value"),
        join_notes(notes).alias("footnotes"))


def read_labour_json(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.text(path, wholetext=True)
    return parse_labour_json(docs)


# ------------------------------------------------------------------ SRC-6
SDMX_SCHEMA = ("dataSets array<struct<observations: map<string, array<string>>>>, "
               "structure struct<dimensions: struct<observation: array<struct<id: string, "
               "values: array<struct<id: string, name: string>>>>>>")


def parse_sdmx_json(docs: DataFrame, text_col: str = "value", code_col: str | None = None) -> DataFrame:
    """First data set's observations -> (key, dimensions map, date, value).

    Observation keys 'a:b:c' index the observation dimensions; each index is
    decoded to that dimension's value id (D-13).  The dimension whose id is
    TIME_PERIOD (or the last one) gives the date via the banking period
    rule.  Null or non-numeric values are dropped."""
    keep = [code_col] if code_col else []
    j = docs.select(*keep, F.from_json(F.col(text_col), SDMX_SCHEMA).alias("j"))
    dims = F.col("j.structure.dimensions.observation")
    e = j.select(*keep, dims.alias("dims"),
                 F.explode(F.try_element_at(F.col("j.dataSets"), F.lit(1))["observations"]).alias("k", "vals"))
    idx = F.split(F.col("k"), ":")
    decoded = F.transform(F.arrays_zip(F.col("dims"), idx.alias("i")),
                          lambda z: F.struct(z["dims"]["id"].alias("dim"),
                                             F.try_element_at(z["dims"]["values"],
                                                              z["i"].cast("int") + 1)["id"].alias("val")))
    m = F.map_from_entries(decoded)
    time_val = F.coalesce(F.element_at(m, F.lit("TIME_PERIOD")),
                          F.try_element_at(F.transform(decoded, lambda x: x["val"]), F.lit(-1)))
    value = F.try_element_at(F.col("vals"), F.lit(1)).try_cast("double")
    out = e.select(*keep, F.col("k").alias("obs_key"),
                   F.map_filter(m, lambda k, v: k != "TIME_PERIOD").alias("dimensions"),
                   banking_period_date(time_val).alias("date"), value.alias("value"))
    return out.where(F.col("value").isNotNull())


# ------------------------------------------------------------------ SRC-7
def read_catalogue_xml(spark: SparkSession, path: str, tags: tuple[str, ...] = CATALOGUE_TAGS,
                       limit: int | None = None) -> DataFrame:
    """Catalogue XML of any namespaces in one pass: (node, code, title,
    description, link, version) of every element whose local name is in
    ``tags`` (``files.Catalogue``).  ``limit``: the first by code."""
    out = parse_files(spark, path, Catalogue, "path string, node string, code string, title string, description string, "
                      "link string, version string", tuple(tags)).drop("path")
    return out if limit is None else out.orderBy("code").limit(limit)


# ------------------------------------------------------------------ SRC-8
STRUCTURE_SCHEMA = ("structure struct<dimensions: map<string, struct<label: string, "
                    "values: array<struct<id: string, label: string>>>>>")


def parse_structure_json(docs: DataFrame, text_col: str = "value", lang: str = "en",
                         dataset_col: str | None = None) -> DataFrame:
    """Dimension id -> label (a string, or a per-language map) and values: one
    row per (dimension, value), with the dimension's position and, where
    ``dataset_col`` names it, the code of the dataset the payload is of."""
    keep = [F.col(dataset_col).alias("dataset")] if dataset_col else []
    j = docs.select(*keep, F.from_json(F.col(text_col), STRUCTURE_SCHEMA).alias("j"))
    keep = ["dataset"] if dataset_col else []
    e = j.select(*keep, F.posexplode("j.structure.dimensions").alias("position", "dim", "d"))
    label = F.coalesce(F.get_json_object(F.col("d.label"), f"$.{lang}"), F.col("d.label"))
    v = e.select(*keep, "position", "dim", label.alias("dim_label"), F.explode_outer("d.values").alias("v"))
    return v.select(*keep, "position", "dim", "dim_label", F.col("v.id").alias("value_id"),
                    F.coalesce(F.get_json_object(F.col("v.label"), f"$.{lang}"), F.col("v.label")).alias("value_label"))


def dimension_keywords(structure_rows: DataFrame) -> DataFrame:
    """FN-18: ', '-joined dimension ids in their given order, one row per
    dataset (one in all where rows carry no dataset)."""
    by = ["dataset"] if "dataset" in structure_rows.columns else []
    dims = structure_rows.groupBy(*by, "dim").agg(F.min("position").alias("position"))
    listed = F.array_sort(F.collect_list(F.struct("position", "dim")))
    return dims.groupBy(*by).agg(F.array_join(F.transform(listed, lambda d: d["dim"]), ", ").alias("keywords"))


# ------------------------------------------------------------------ SRC-9
def parse_dataflows(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Dataflow key = id, else dataflowid, else name, default ''."""
    j = docs.select(F.explode(F.from_json(F.col(text_col),
                                          "array<struct<id:string,dataflowid:string,name:string>>")).alias("f"))
    return j.select(F.coalesce(F.nullif("f.id", F.lit("")), F.nullif("f.dataflowid", F.lit("")),
                               F.nullif("f.name", F.lit("")), F.lit("")).alias("dataflow_id"),
                    F.col("f.name").alias("name"))


def parse_surveys(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Surveys under Results.survey, only when status is a success."""
    j = docs.select(F.from_json(F.col(text_col),
                                "status string, Results struct<survey: array<struct<survey_abbreviation: string, "
                                "survey_name: string>>>").alias("j"))
    ok = j.where(F.upper(F.col("j.status")).contains("SUCCE"))
    return ok.select(F.explode("j.Results.survey").alias("s")).select("s.*")


def parse_fund_list(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Funds as a top-level list, or under the first present key of
    funds / products / etfs / data / items."""
    item = "array<map<string,string>>"
    t = F.col(text_col)
    as_list = F.from_json(t, item)
    under = [F.from_json(F.get_json_object(t, f"$.{k}"), item) for k in FV.FUND_LIST_KEYS]
    arr = F.when(F.trim(t).startswith("["), as_list).otherwise(F.coalesce(*under))
    return docs.select(F.explode(arr).alias("fund"))


# ------------------------------------------------------------------ SRC-10
def parse_company_tickers(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """{"0": {"cik_str": 320193, "ticker": "...", "title": "..."}, ...} ->
    (cik 10-digit text, ticker, name)."""
    m = F.from_json(F.col(text_col), "map<string, struct<cik_str: string, ticker: string, title: string>>")
    e = docs.select(F.explode(m).alias("k", "c"))
    return e.select(normalize_cik(F.col("c.cik_str")).alias("cik"), F.col("c.ticker").alias("ticker"),
                    F.col("c.title").alias("name"))


# ------------------------------------------------------------------ SRC-11
def listing_union(exchanges: dict[str, DataFrame], symbol_col: str = "Symbol") -> DataFrame:
    """Per exchange: drop null symbols, keep each symbol once, drop symbols
    containing '.' or blank; tag the exchange; union; sort by ticker.  A
    ticker listed on two exchanges stays twice."""
    parts = []
    for name, df in exchanges.items():
        s = (df.select(F.col(symbol_col).alias("ticker")).where(F.col("ticker").isNotNull())
               .distinct()
               .where(~F.col("ticker").contains(".") & (F.trim(F.col("ticker")) != ""))
               .withColumn("exchange", F.lit(name)))
        parts.append(s)
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("ticker")


# ------------------------------------------------------------------ SRC-12
def read_sheet_csv(spark: SparkSession, path: str, ticker: str, data_date: str, fund_url: str,
                   created_at: str) -> DataFrame:
    """Holdings / historical sheet landed as CSV: every column kept as text
    (NaN / empty -> null), stored long as map<string,string> plus the
    fixed columns."""
    df = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    cols = df.columns
    m = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                          F.array(*[F.nullif(F.nullif(F.col(f"`{c}`"), F.lit("")), F.lit("NaN")) for c in cols]))
    return df.select(F.lit(ticker).alias("ticker"), F.lit(data_date).alias("data_date"),
                     F.lit(fund_url).alias("fund_url"), F.col("_metadata.file_path").alias("excel_file"),
                     F.lit(created_at).alias("created_at"),
                     F.map_filter(m, lambda k, v: v.isNotNull()).alias("fields"))


# ------------------------------------------------------------------ SRC-13
def html_pairs(pages: DataFrame, id_cols: list[str], html_col: str, pattern: str,
               href_group: int = 1, text_group: int = 2) -> DataFrame:
    """Pairs matched by ``pattern`` -> (key = text, value = href); blanks
    and header words (key / field) dropped."""
    h = F.col(html_col)
    pairs = F.arrays_zip(F.regexp_extract_all(h, F.lit(pattern), text_group).alias("key"),
                         F.regexp_extract_all(h, F.lit(pattern), href_group).alias("value"))
    e = pages.select(*id_cols, F.explode(pairs).alias("kv"))
    k, v = F.trim(F.col("kv.key")), F.trim(F.col("kv.value"))
    return (e.select(*id_cols, k.alias("key"), v.alias("value"))
             .where((F.col("key") != "") & (F.col("value") != "")
                    & ~F.lower(F.col("key")).isin([w for w in FV.KV_HEADER_WORDS if w])))


def table_pairs(pages: DataFrame, id_cols: list[str], html_col: str, section: str | None = None) -> DataFrame:
    """Each table row's first two cells -> key, value; rows of one cell have
    none.  ``section``: only tables within the element of that id (up to its
    end tag or the next element with an id of its own kind)."""
    html = F.col(html_col)
    if section is not None:
        html = F.regexp_extract(html, rf"""(?is)<(\w+)[^>]*\sid=["']{section}["'][^>]*>(.*?)</\1>""", 2)
    row = F.explode(F.regexp_extract_all(html, F.lit(r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr>"), 1)).alias("row")
    cells = F.regexp_extract_all(F.col("row"), F.lit(r"(?is)<t[dh](?:\s[^>]*)?>(.*?)</t[dh]>"), 1)
    strip = lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", ""))
    e = pages.select(*id_cols, row).select(*id_cols, cells.alias("cells")).where(F.size("cells") >= 2)
    return (e.select(*id_cols, strip(F.col("cells")[0]).alias("key"), strip(F.col("cells")[1]).alias("value"))
             .where((F.col("key") != "") & (F.col("value") != "")
                    & ~F.lower(F.col("key")).isin([w for w in FV.KV_HEADER_WORDS if w])))


# ------------------------------------------------------------------ SRC-14
def embedded_json_block(pages: DataFrame, html_col: str, name: str = "valuationMeasures") -> DataFrame:
    """The JSON object assigned to ``name`` inside page text (or null)."""
    raw = F.regexp_extract(F.col(html_col), '"' + name + r'"\s*:\s*(\{[^{}]*\})', 1)
    return pages.withColumn(name, F.from_json(F.nullif(raw, F.lit("")), "map<string,string>"))


# ------------------------------------------------------------------ SRC-17
def write_raw_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


__all__ = ["parse_labour_json", "parse_sdmx_json", "read_catalogue_xml",
           "parse_structure_json", "parse_dataflows", "parse_surveys", "parse_fund_list",
           "parse_company_tickers", "listing_union", "read_sheet_csv", "html_pairs", "table_pairs",
           "embedded_json_block", "write_raw_json"]
