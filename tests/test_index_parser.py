"""Filing-index parser cases (restated with invented rows)."""

import gzip
import os

from pyspark.sql import functions as F

from marketlake.sources.index import (parse_index_lines, read_index_binary, read_index_text,
                                      read_parsed_quarters, write_parsed_quarters)

HEADER = "CIK|Company Name|Form Type|Date Filed|Filename"
GOOD = [
    "1000045|ALPHA WIDGETS INC|10-Q|2022-11-14|edgar/data/1000045/0000950170-22-024756.txt",
    "789019|BETA HOLDINGS CORP|10-K|20230728|edgar/data/789019/0000789019-23-000077.txt",
]


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_valid_rows_and_columns(spark):
    out = parse_index_lines(lines_df(spark, [HEADER, "-" * 40] + GOOD)).orderBy("cik").collect()
    assert len(out) == 2
    assert list(out[0].asDict()) == ["cik", "company_name", "form_type", "filing_date", "filename",
                                     "accession_number"]
    r = [x for x in out if x.company_name == "ALPHA WIDGETS INC"][0]
    assert r.cik == "0001000045"
    assert str(r.filing_date) == "2022-11-14"
    assert r.accession_number == "0000950170-22-024756"
    r2 = [x for x in out if x.form_type == "10-K"][0]
    assert str(r2.filing_date) == "2023-07-28" and r2.cik == "0000789019"


def test_bad_lines_skipped(spark):
    bad = [
        "",
        "   ",
        "Description: some preamble",
        "123|TOO|MANY|2020-01-01|edgar/data/1/x.txt|extra",
        "12a|NON DIGIT|10-K|2020-01-01|edgar/data/1/x.txt",
        "123|BAD DATE|10-K|invalid-date|edgar/data/1/x.txt",
        "123|MONTH 13|10-K|2020-13-01|edgar/data/1/x.txt",
        "123|OTHER PATH|10-K|2020-01-01|other/1/x.txt",
        "123|SHORT PATH|10-K|2020-01-01|edgar/data/",
    ]
    assert parse_index_lines(lines_df(spark, bad + GOOD[:1])).count() == 1


def test_empty_input_keeps_columns(spark):
    out = parse_index_lines(lines_df(spark, []))
    assert out.count() == 0
    assert out.columns == ["cik", "company_name", "form_type", "filing_date", "filename", "accession_number"]


def test_cik_in_company_name_kept_unless_compat(spark):
    rows = ["42|CIKA CORP|8-K|2021-02-03|edgar/data/42/0000000042-21-000001.txt"]
    assert parse_index_lines(lines_df(spark, rows)).count() == 1
    assert parse_index_lines(lines_df(spark, rows), compat=True).count() == 0


def test_long_cik_keeps_all_digits(spark):
    rows = ["12345678901|LONG ID|8-K|2021-02-03|edgar/data/1/abc.txt", "0000|ZERO|8-K|2021-02-03|edgar/data/1/z.txt"]
    got = {r.company_name: r.cik for r in parse_index_lines(lines_df(spark, rows)).collect()}
    assert got == {"LONG ID": "12345678901", "ZERO": "0000000000"}


def test_text_and_gzip_files(spark, tmp):
    d = os.path.join(tmp, "master", "2021")
    os.makedirs(d)
    body = "\n".join([HEADER, "-" * 10] + GOOD)
    with open(os.path.join(d, "QTR1_master.idx"), "w") as fh:
        fh.write(body)
    with open(os.path.join(d, "QTR2_master.idx.gz"), "wb") as fh:
        fh.write(gzip.compress(body.encode()))
    out = read_index_text(spark, os.path.join(tmp, "master", "*", "*"))
    got = sorted((r.year, r.quarter) for r in out.select("year", "quarter").collect())
    assert got == [(2021, "QTR1"), (2021, "QTR1"), (2021, "QTR2"), (2021, "QTR2")]


def test_extensionless_gzip_and_bad_bytes(spark, tmp):
    d = os.path.join(tmp, "raw", "2020")
    os.makedirs(d)
    body = ("\n".join([HEADER] + GOOD)).encode() + b"\n\xff\xfe"
    with open(os.path.join(d, "QTR3_master"), "wb") as fh:
        fh.write(gzip.compress(body))
    with open(os.path.join(d, "QTR4_master"), "wb") as fh:
        fh.write(body)
    out = read_index_binary(spark, os.path.join(tmp, "raw", "*", "*"))
    assert out.count() == 4
    assert {r.quarter for r in out.select("quarter").collect()} == {"QTR3", "QTR4"}


def test_parsed_quarter_round_trip(spark, tmp):
    parsed = parse_index_lines(lines_df(spark, GOOD)).withColumn("year", F.year("filing_date")) \
        .withColumn("quarter", F.concat(F.lit("QTR"), F.quarter("filing_date").cast("string")))
    root = os.path.join(tmp, "parsed")
    write_parsed_quarters(parsed, root, fmt="parquet")
    got = spark.read.parquet(root)
    assert got.count() == 2 and set(got.columns) >= {"year", "quarter", "cik"}
    # CSV layout '<year>/QTRn_master_parsed.csv'; other files are skipped
    d = os.path.join(tmp, "csvroot", "2022")
    os.makedirs(d)
    with open(os.path.join(d, "QTR4_master_parsed.csv"), "w") as fh:
        fh.write("cik,company_name,form_type,filing_date,filename,accession_number\n")
        fh.write("0000000042,GAMMA,10-K,2022-11-14,edgar/data/42/x.txt,x\n")
    with open(os.path.join(d, "notes.csv"), "w") as fh:
        fh.write("a,b\n1,2\n")
    q = read_parsed_quarters(spark, os.path.join(tmp, "csvroot")).collect()
    assert len(q) == 1 and q[0].year == 2022 and q[0].quarter == "QTR4" and q[0].cik == "0000000042"
