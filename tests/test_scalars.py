"""Scalar rules and the section-8 decisions."""

from pyspark.sql import functions as F

from marketlake.functions import periods as PD
from marketlake.functions import scalars as S


def one(spark, expr, *vals, schema="a string"):
    df = spark.createDataFrame([tuple(vals)], schema)
    return df.select(expr.alias("r")).first().r


def test_labour_periods(spark):
    cases = {"M01": "2020-01-01", "M12": "2020-12-01", "M13": "2020-01-01", "A01": "2020-01-01",
             "Q03": "2020-07-01", "S02": "2020-07-01", "Q05": None, "MXX": "2020-01-01", "Z9": "2020-01-01"}
    for code, want in cases.items():
        got = one(spark, PD.labour_period_date(F.col("y"), F.col("p")), "2020", code, schema="y string, p string")
        assert (str(got) if got else None) == want, code


def test_european_and_banking_periods(spark):
    eu = {"2020Q2": "2020-04-01", "2020M11": "2020-11-01", "2020": "2020-01-01", "2020-W05": "2020-01-01",
          "2020-03-15": "2020-03-15", "2020-03": "2020-03-01", "bad": None}
    for code, want in eu.items():
        got = one(spark, PD.european_period_date(F.col("a")), code)
        assert (str(got) if got else None) == want, code
    assert str(one(spark, PD.european_period_date(F.col("a"), iso_week=True), "2020-W02")) == "2020-01-06"
    bis = {"2020-Q4": "2020-10-01", "2020-07": "2020-07-01", "2020": "2020-01-01", "2020-13": None,
           "2021-02-03": "2021-02-03"}
    for code, want in bis.items():
        got = one(spark, PD.banking_period_date(F.col("a")), code)
        assert (str(got) if got else None) == want, code


def test_country_longest_code_first(spark):
    assert one(spark, S.country_of(F.col("a")), "AUSGDP") == "Australia"
    assert one(spark, S.country_of(F.col("a"), compat=True), "AUSGDP") == "United States"
    assert one(spark, S.country_of(F.col("a"), F.lit("Made in FRA")), "XYZ") == "France"
    assert one(spark, S.country_of(F.col("a")), "ZZZ") == "United States"


def test_ids_and_text_rules(spark):
    assert one(spark, S.normalize_cik(F.col("a")), "0042") == "0000000042"
    assert one(spark, S.normalize_cik(F.col("a")), "12345678901") == "12345678901"
    assert one(spark, S.normalize_cik(F.col("a")), "12x") is None
    assert one(spark, S.survey_of(F.col("a")), "CUUR0000SA0") == "CU"
    assert one(spark, S.survey_of(F.col("a")), "ZZ1") == "Unknown"
    assert one(spark, S.accession_from_path(F.col("a")), "edgar/data/1/0001-23.txt") == "0001-23"
    assert one(spark, S.accession_from_path(F.col("a")), "data/1.txt") is None
    assert one(spark, S.join_notes(F.array().cast("array<string>")), "x") is None
    assert one(spark, S.absolute_url(F.col("a"), "https://h"), "p/q") == "https://h/p/q"
    assert one(spark, S.as_of_date(F.col("a")), "Date: 1/2/2024 and As of 03/04/2024") == "03/04/2024"
    assert one(spark, S.to_double(F.col("a")), " 1.5 ") == 1.5
    assert one(spark, S.to_double(F.col("a")), "n/a") is None


def test_cells(spark):
    df = spark.createDataFrame([(["", "abc ", "Core Equity Fund", "x"],)], "c array<string>")
    r = df.select(S.detect_ticker(F.col("c")).alias("t"), F.col("c"))
    r = r.select("t", S.detect_name(F.col("c"), F.col("t")).alias("n")).first()
    assert (r.t, r.n) == ("ABC", "Core Equity Fund")


def test_fund_row_fields_precedence(spark):
    df = spark.createDataFrame([(["Symbol", "Fund Name", "Expense Ratio"], ["", "Core Equity Fund", "0.03%"]),
                                (["Fund Name", "Ticker"], ["Broad Bond Fund", "bbb"])],
                               "h array<string>, c array<string>")
    rows = df.select(S.fund_row_fields(F.col("h"), F.col("c")).alias("f")).select("f.*").collect()
    # empty ticker cell: no shape-detected ticker either (no short alphanumeric cell)
    assert (rows[0].ticker, rows[0].name, rows[0].expense_ratio) == (None, "Core Equity Fund", "0.03%")
    assert (rows[1].ticker, rows[1].name) == ("bbb", "Broad Bond Fund")
