"""Filing-index sources (SRC-1 .. SRC-4).

The landed index is pipe-delimited text.  Parsing is one narrow projection
over ``read.text`` lines: split, predicate chain, scalar rules.  No line ever
leaves the JVM and no file is read whole into one task; gzip without its
extension is unzipped as a stream (``files``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as FV
from ..functions.scalars import accession_from_path, filed_date, normalize_cik
from .files import GzipLines, parse_files

INDEX_SCHEMA = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("form_type", T.StringType()),
    T.StructField("filing_date", T.DateType()),
    T.StructField("filename", T.StringType()),
    T.StructField("accession_number", T.StringType()),
])

PARSED_CSV_SCHEMA = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("form_type", T.StringType()),
    T.StructField("filing_date", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("accession_number", T.StringType()),
])


WS = " \t\r\n\f\v"


def _strip(c):
    """Python-style strip of surrounding whitespace (no regex)."""
    return F.trim(c, F.lit(WS))


def parse_index_lines(lines: DataFrame, line_col: str = "value", compat: bool = False,
                      keep: list[str] | None = None) -> DataFrame:
    """SRC-1: index lines -> (cik, company_name, form_type, filing_date,
    filename, accession_number).

    Drops blank lines, '---' rules, the header, lines without exactly five
    fields, non-digit ids, filenames outside the data folder, bad dates and
    missing accession numbers.  ``compat=True`` also drops every line that
    contains 'CIK' in any case (the older rule, which loses company names
    such as 'CIKA CORP').  ``keep`` carries extra input columns through.

    Each derived value is evaluated once per line: the stripped fields, then
    the typed fields with a validity flag, are each produced by a one-row
    generator, so Catalyst cannot copy the split / regex / date parse into
    every predicate that reads them (which doubled the per-line cost).
    """
    keep = keep or []
    line = _strip(F.col(line_col))
    parts = F.split(line, r"\|", -1)
    fields = F.struct(*[F.col(k) for k in keep], line.alias("line"), F.size(parts).alias("n"),
                      *[_strip(F.get(parts, i)).alias(f"f{i}") for i in range(5)])
    staged = lines.select(F.inline(F.array(fields)))
    ln = F.col("line")
    header = F.upper(ln).contains("CIK") if compat else F.upper(ln) == F.lit(FV.INDEX_HEADER.upper())
    ok = ((ln != "") & ~ln.startswith("---") & ~header & (F.col("n") == 5)
          & F.col("f0").rlike(r"^[0-9]+$") & F.col("f4").startswith(FV.INDEX_FILENAME_PREFIX))
    typed = F.struct(*[F.col(k) for k in keep], ok.alias("_ok"),
                     normalize_cik(F.col("f0")).alias("cik"),
                     F.col("f1").alias("company_name"),
                     F.col("f2").alias("form_type"),
                     filed_date(F.col("f3")).alias("filing_date"),
                     F.col("f4").alias("filename"),
                     accession_from_path(F.col("f4")).alias("accession_number"))
    out = staged.select(F.inline(F.array(typed)))
    return (out.where(F.col("_ok") & F.col("filing_date").isNotNull() & F.col("accession_number").isNotNull())
               .drop("_ok"))


def with_year_quarter_from_path(df: DataFrame, path_col: str = "_path") -> DataFrame:
    """Year and quarter from a '<year>/QTRn' path (SRC-1/SRC-3 layout)."""
    year = F.regexp_extract(F.col(path_col), r"/(\d{4})/QTR[1-4]", 1)
    quarter = F.regexp_extract(F.col(path_col), r"/(QTR[1-4])[^/]*$", 1)
    return (df.withColumn("year", F.nullif(year, F.lit("")).cast("int"))
              .withColumn("quarter", F.nullif(quarter, F.lit(""))))


def read_index_text(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """SRC-1/SRC-2: scan landed index files (plain, or gzip by '.gz'
    extension; Spark's codec unzips those per file) and parse them."""
    raw = (spark.read.text(path)
           .select(F.col("value"), F.col("_metadata.file_path").alias("_path")))
    # invalid UTF-8 comes back as U+FFFD; the source decoder drops such bytes
    raw = raw.withColumn("value", F.regexp_replace("value", "�", ""))
    parsed = parse_index_lines(raw, keep=["_path"], compat=compat)
    return with_year_quarter_from_path(parsed).drop("_path")


def read_index_binary(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """SRC-2 for gzip bytes without a '.gz' name: every file is a stream that
    is unzipped a piece at a time if it begins as gzip (``files.GzipLines``);
    invalid UTF-8 dropped, then the same JVM parse as ``read_index_text``."""
    lines = parse_files(spark, path, GzipLines, "_path string, value string")
    parsed = parse_index_lines(lines, keep=["_path"], compat=compat)
    return with_year_quarter_from_path(parsed).drop("_path")


def read_parsed_quarters(spark: SparkSession, root: str) -> DataFrame:
    """SRC-3: '<year>/QTRn_master_parsed.csv' files under ``root``.  Ids stay
    text (10 digits); the year must be a number; other files are skipped."""
    df = (spark.read.schema(PARSED_CSV_SCHEMA)
          .option("header", "true")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "QTR[1-4]*_master_parsed.csv")
          .csv(root)
          .withColumn("_path", F.col("_metadata.file_path")))
    year = F.regexp_extract("_path", r"/(\d{4})/QTR[1-4][^/]*$", 1)
    quarter = F.regexp_extract("_path", r"/(QTR[1-4])_master_parsed\.csv$", 1)
    return (df.where(year != "")
              .select(year.cast("int").alias("year"), quarter.alias("quarter"),
                      normalize_cik("cik").alias("cik"), "company_name", "form_type",
                      F.try_to_date("filing_date", "yyyy-MM-dd").alias("date_filed"),
                      "filename", "accession_number"))


def write_parsed_quarters(df: DataFrame, root: str, fmt: str = "parquet") -> None:
    """SRC-4: one folder per (year, quarter).  Overwrites only the quarters
    present in ``df`` (dynamic partition overwrite)."""
    w = (df.hint("rebalance", F.col("year"), F.col("quarter")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("year", "quarter"))
    if fmt == "csv":
        w.option("header", "true").csv(root)
    else:
        w.parquet(root)
