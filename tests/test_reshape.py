"""Reshape operators on small invented frames."""

from pyspark.sql import functions as F

from marketlake.functions import fixed_values as FV
from marketlake.operators import aggs as AG
from marketlake.operators import joins as J
from marketlake.operators import reshape as RS


def test_melt_multilevel_names_and_nulls(spark):
    df = spark.createDataFrame([("2020-01-01", 1.0, None), ("bad", 2.0, "3.5")], "time string, a double, b string")
    df = df.withColumn("date", F.try_to_date("time", "yyyy-MM-dd"))
    out = RS.melt_with_dimensions(df, ["date"], ["a", "b"], {"a": {"geo": "DE", "unit": "EUR"}}, date_col="date")
    rows = out.collect()
    assert len(rows) == 1 and rows[0].dimensions == {"geo": "DE", "unit": "EUR"} and rows[0].value == 1.0


def test_explode_observations(spark):
    df = spark.createDataFrame([({"0:1": ["1.5"], "1:0": ["x"], "1:1": [None]},)], "obs map<string,array<string>>")
    out = RS.explode_observations(df, "obs", ["area", "freq"]).collect()
    assert [(r.dimensions, r.value) for r in out] == [({"area": "0", "freq": "1"}, 1.5)]


def test_long_map_and_widen(spark):
    df = spark.createDataFrame([("A", "1", None), ("B", None, "y")], "t string, x string, y string")
    long = RS.to_long_map(df, ["t"])
    got = {r.t: r.fields for r in long.collect()}
    assert got == {"A": {"x": "1"}, "B": {"y": "y"}}
    wide = {r.t: (r.x, r.y) for r in RS.widen(long, ["t"], "fields", ["x", "y"]).collect()}
    assert wide == {"A": ("1", None), "B": (None, "y")}


def test_matrix_rows_sections_and_bars(spark):
    m = spark.createDataFrame([("S", "upLast7Days", "1", "2"), ("S", "downLast30Days", "3", None)],
                              "symbol string, label string, currentQtr string, nextQtr string")
    fields = [f for f, _ in FV.EPS_REVISION_RULES]
    out = {r.period: r for r in RS.matrix_to_rows(m, ["symbol"], "label", ["currentQtr", "nextQtr"],
                                                   FV.EPS_REVISION_RULES, fields).collect()}
    assert out["currentQtr"].up_last_7_days == "1" and out["currentQtr"].down_last_30_days == "3"
    assert out["nextQtr"].down_last_30_days is None
    sec = spark.createDataFrame([("T", [("Fees", "0.1%"), ("Holdings", "500")])],
                                "ticker string, kv array<struct<key:string,value:string>>")
    assert RS.sections_to_rows(sec, ["ticker"], "key_facts", "kv").count() == 2
    px = spark.createDataFrame([("S", "d1", 1, 10.0), ("S", "d1", 2, 12.0), ("S", "d1", 3, 9.0)],
                               "sym string, day string, ts long, p double")
    b = RS.ohlc(px, ["sym"], "day", "ts", "p").first()
    assert (b.open, b.high, b.low, b.close) == (10.0, 12.0, 9.0, 9.0)


def test_aggregate_helpers(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "a"), ("h", "c")], "g string, m string")
    got = {r.g: (r.members, r.n_members, r.n_unique) for r in AG.members(df, "g", "m").collect()}
    assert got == {"g": ("a,a,b", 3, 2), "h": ("c", 1, 1)}
    idx = spark.createDataFrame([(2020, "10-K"), (2020, "10-Q"), (2021, "10-K")], "year int, form string")
    db = spark.createDataFrame([(2020, "10-K"), (2021, "10-K")], "year int, form string")
    c = {(r.year, r.filing_type): (r.sec_index_count, r.db_count, r.is_complete)
         for r in AG.completeness(idx, db, "year", "form").collect()}
    assert c[(2020, "TOTAL")] == (2, 1, False) and c[(2021, "TOTAL")] == (1, 1, True)
    t = AG.tally(spark.createDataFrame([("success",), ("failed",), ("skipped",)], "o string"), "o").first()
    assert (t.success, t.failed, t.skipped, t.total) == (1, 1, 1, 3)


def test_combine_first_prefer_incoming(spark):
    e = spark.createDataFrame([(1, "old", None)], "k long, a string, b string")
    n = spark.createDataFrame([(1, "new", "x")], "k long, a string, b string")
    assert tuple(J.combine_first(e, n, ["k"], prefer="incoming").first()) == (1, "new", "x")
    assert tuple(J.combine_first(e, n, ["k"]).first()) == (1, "old", "x")
