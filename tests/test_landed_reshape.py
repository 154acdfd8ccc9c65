"""Time-column detection, safe overwrites, default buckets, panels, feature views."""

import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import aggs as AG
from marketlake.operators import features as FE
from marketlake.operators import joins as J
from marketlake.operators import order as OR
from marketlake.operators import reshape as RS
from marketlake.operators import upsert as UP
from marketlake.sources import sink


def test_time_column_is_found_by_name_type_and_values(spark):
    q = [("2020Q1", "5", "20200101", "31/01/2020", 7), ("2020Q2", "6", "20200401", "30/04/2020", 8), ("x", None, None, None, 9)] * 3
    df = spark.createDataFrame(q, "a string, b string, c string, d string, n int")
    assert RS.detect_time_column(df.select("b", "c")) == ("c", "compact")
    assert RS.detect_time_column(df.select("b", "d")) == ("d", "day first")
    assert RS.detect_time_column(df.select("a", "b")) is None                    # a third of a is no period
    assert RS.detect_time_column(df.select("a", "b"), least=0.6) == ("a", "european")
    assert RS.detect_time_column(df.select("b", F.lit("2020-Q3").alias("z"))) == ("z", "banking")
    years = spark.createDataFrame([(2020, 2021), (2021, 1999)], "n int, year int")
    assert RS.detect_time_column(years) == ("year", "european") and RS.detect_time_column(years.select("n")) is None
    named = df.select("c", F.lit("2020-01-05").alias("Date"), F.current_date().alias("day"))
    assert RS.detect_time_column(named) == ("Date", "european")
    assert RS.detect_time_column(named.drop("Date")) == ("day", "date")
    with pytest.raises(ValueError, match="holds times"):
        RS.melt_detected(df.select("b", "n"))
    assert RS.detect_time_column(df.limit(0)) is None


def test_melt_detected_with_levels(spark):
    df = spark.createDataFrame([("2020-01", "1.5", 2), ("2020-02", "bad", 3), (None, "1", 1)], "t string, x string, y int")
    out = RS.melt_detected(df, {"x": {"unit": "EUR", "geo": "DE"}})
    got = sorted((str(r.date), r.variable, r.value, r.dimensions) for r in out.collect())
    assert got == [("2020-01-01", "x", 1.5, {"unit": "EUR", "geo": "DE"}), ("2020-01-01", "y", 2.0, {"dimension": "y"}),
                   ("2020-02-01", "y", 3.0, {"dimension": "y"})]


def test_overwrite_keeps_the_old_table_until_the_new_one_is_there(spark, tmp):
    path = os.path.join(tmp, "t")
    sink.write_table(spark.range(5), path)
    sink.write_table(spark.read.parquet(path).where("id > 1"), path)        # rows of the table itself
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4]
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sink.write_table(broken, path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp) == ["t"]


def test_append_refuses_a_column_of_its_own_name(spark, tmp):
    with pytest.raises(ValueError, match="batch_id"):
        sink.append_table(spark.range(2).withColumn("Batch_ID", F.lit("mine")), os.path.join(tmp, "t"), batch="b1")
    sink.append_table(spark.range(2), os.path.join(tmp, "t"), batch="b1")
    sink.append_table(spark.range(2), os.path.join(tmp, "t"), batch="b1")
    assert spark.read.parquet(os.path.join(tmp, "t")).count() == 2


def test_history_over_default_buckets(spark):
    rows = [("k", f"20{20 + m // 12}-{m % 12 + 1:02d}-15", m // 5) for m in range(40)]
    df = spark.createDataFrame(rows, "k string, day string, v int")
    want = [(r[1], r[2]) for i, r in enumerate(rows) if i == 0 or rows[i - 1][2] != r[2]]
    for order in ("day", "at", "n"):
        d = df.withColumn("at", F.to_date("day")).withColumn("n", F.col("v") * 100_000 + F.month(F.to_date("day")) + 12 * F.year(F.to_date("day")))
        got = OR.change_history(d, ["k"], order, ["v"]).orderBy("valid_from").collect()
        assert [r.v for r in got] == [v for _, v in want]
        assert [r.valid_to for r in got[:-1]] == [r.valid_from for r in got[1:]] and got[-1].valid_to is None


def test_panel_and_feature_view(spark):
    long = spark.createDataFrame([("GDP", "d1", 1.0), ("UNRATE", "d2", 2.0), ("other", "d1", 9.0)], "series_id string, date string, value double")
    assert J.indicator_panel(long, "macro").columns == ["date", "GDP", "UNRATE"]
    assert J.indicator_panel(long, "gdp").columns == ["date", "GDP"]
    with pytest.raises(ValueError, match="unknown panel"):
        J.indicator_panel(long, "none")
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", 2, None)], "k string, t int, f string")
    got = {r.k: (r.f, r.t) for r in FE.latest_features(rows, ["k"], "t", ["f"]).collect()}
    assert got == {"a": ("y", 3), "b": (None, 2)}
    assert FE.feature_range(rows, "t", F.lit(1), F.lit(3)).count() == 2


def test_ties_of_an_upsert_have_one_winner(spark):
    old = spark.createDataFrame([(1, "a", {"x": "1"})], "k int, v string, m map<string,string>")
    new = spark.createDataFrame([(1, "b", {"x": "2"}), (1, "c", {"x": "3"}), (2, "d", None)], old.schema)
    first = sorted(map(str, UP.upsert(old, new, ["k"]).collect()))
    for n in (1, 3):
        assert sorted(map(str, UP.upsert(old, new.repartition(n, "v"), ["k"]).collect())) == first
    assert len(first) == 2


def test_members_of_a_group_without_bound(spark):
    rows = [("big", i * 7919 % 5000) for i in range(5000)] + [("small", 2), ("small", 2), ("none", None), (None, 1)]
    out = AG.member_rows(spark.createDataFrame(rows, "g string, m int"), "g", "m", per_row=300).collect()
    assert max(len(r.members) for r in out) <= 300
    listed = {}
    for r in sorted(out, key=lambda r: r.part):
        listed.setdefault(r.g, []).extend(r.members)
    assert listed == {"big": list(range(5000)), "small": [2, 2], None: [1]}
