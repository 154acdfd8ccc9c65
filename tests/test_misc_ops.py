"""Schema alignment, SQL-file hook, id extraction, seeds, run log."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import filters as FL
from marketlake.sources import seeds as SD
from marketlake.sources.sink import read_table


def test_align_to_schema(spark):
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("created_at", T.StringType())])
    df = spark.createDataFrame([("AAA", "x")], "ticker string, extra string")
    out = FL.align_to_schema(df, schema, defaults={"name": ""})
    assert out.columns == ["ticker", "name", "created_at", "extra"]
    assert tuple(out.first()) == ("AAA", "", None, "x")
    assert FL.align_to_schema(df, schema, keep_extra=False).columns == ["ticker", "name", "created_at"]


def test_sql_file_hook_and_ids(spark, tmp):
    spark.createDataFrame([("A", 1), ("B", 2), ("  ", 3)], "series_id string, n int").createOrReplaceTempView("series")
    p = os.path.join(tmp, "q.sql")
    with open(p, "w") as fh:
        fh.write("-- pick series\nSELECT series_id FROM series WHERE n < 3\n")
    ids = FL.ids_from_query(spark.sql(FL.read_sql_file(p)))
    assert sorted(r.series_id for r in ids.collect()) == ["A", "B"]
    other = spark.createDataFrame([("X",)], "code string")
    assert [r.series_id for r in FL.ids_from_query(other).collect()] == ["X"]


def test_filter_errors():
    import pytest
    with pytest.raises(ValueError):
        FL.filing_predicate()
    with pytest.raises(ValueError):
        FL.filing_predicate(colour="red")
    with pytest.raises(ValueError):
        FL.filing_predicate(year="not-a-year")


def test_seed_catalogues(spark):
    cats = SD.major_categories(spark)
    assert cats.count() == 32 and cats.orderBy("position").first().category_id == 1
    names = spark.createDataFrame([(1, "National Accounts")], "category_id long, name string")
    lab = {r.category_id: r.category_name for r in SD.label_seed_categories(spark, names).collect()}
    assert lab[1] == "National Accounts" and lab[3] == "Category 3"
    found = spark.createDataFrame([("S1", 10, 5), ("S1", 3, 1), ("S2", 10, 5)], "series_id string, category_id long, position int")
    assert {r.series_id: r.category_id for r in SD.first_category_per_series(found).collect()} == {"S1": 3, "S2": 10}
    assert SD.common_series(spark).where(F.col("survey") == "CU").count() == 8


def test_run_log(spark, tmp):
    path = os.path.join(tmp, "runs")
    SD.log_runs(SD.run_record(spark, "r1", "all", {"k": 3}, {"aic": 1.5}), path)
    SD.log_runs(SD.run_record(spark, "r2", "all", {"k": 4}, {"aic": 1.2}, {"model_type": "hmm"}), path)
    runs = read_table(spark, path)
    assert sorted(r.run_id for r in runs.collect()) == ["r1", "r2"]


def test_filing_filter_limit(spark):
    rows = [(2021, "QTR1", "10-K", f"edgar/data/{i}/x.txt", "ACME") for i in range(5, 0, -1)]
    f = spark.createDataFrame(rows, "year int, quarter string, form_type string, filename string, company_name string")
    got = [r.filename for r in FL.filter_filings(f, limit=2, year=2021, company_name="acm").collect()]
    assert got == ["edgar/data/1/x.txt", "edgar/data/2/x.txt"]
