"""One check per section-8 decision not covered elsewhere."""

import numpy as np
from pyspark.sql import functions as F

from marketlake.operators import filters as FL
from marketlake.operators import hmm as H
from marketlake.operators import upsert as UP


def test_d15_indicator_key_includes_database(spark):
    e = spark.createDataFrame([("DB1", "GDP", "x")], "database_id string, indicator_code string, name string")
    n = spark.createDataFrame([("DB2", "GDP", "y"), ("DB1", "GDP", "z")], "database_id string, indicator_code string, name string")
    out = sorted(tuple(r) for r in UP.append_new(e, n, ["database_id", "indicator_code"]).collect())
    assert out == [("DB1", "GDP", "x"), ("DB2", "GDP", "y")]


def test_d16_scaler_stored_with_model(spark):
    rows = [(u, t, float(t % 7 + 10 * u), t // 5) for u in range(2) for t in range(30)]
    df = spark.createDataFrame(rows, "u long, t long, x double, blk long")
    params, _ = H.fit(df, ["u"], ["t"], ["x"], k=2, max_iter=2)
    assert params.scaler_mean is not None and params.scaler_std is not None
    scaled = H.scale_features(df, params, ["x"]).agg(F.avg("x").alias("m")).first().m
    assert abs(scaled) < 1e-9
    back = H.HMMParams.from_json(params.to_json())
    assert np.allclose(back.scaler_mean, params.scaler_mean)


def test_d21_search_is_regex_with_literal_option(spark):
    df = spark.createDataFrame([("a.c",), ("abc",)], "s string")
    assert df.transform(lambda d: FL.any_column_matches(d, "a.c")).count() == 2
    assert df.transform(lambda d: FL.any_column_matches(d, "a.c", literal=True)).count() == 1
