"""Change features over many sparse series against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators import features as FE


def sparse(n_series=300, n_days=50, seed=2):
    rng = np.random.default_rng(seed)
    days = pd.date_range("2020-01-01", periods=n_days).date
    rows = []
    for s in range(n_series):
        first = rng.integers(0, 6)
        for d in range(first, n_days):
            if d == first or rng.random() < 0.5:
                v = float(rng.integers(-3, 6))
                rows.append((f"s{s}", days[d], None if rng.random() < 0.05 else v))
    return rows


def by_pandas(rows, method):
    wide = pd.DataFrame(rows, columns=["s", "d", "v"]).pivot(index="d", columns="s", values="v").astype(float).sort_index()
    if method == "pct_change":
        padded = wide.ffill()
        with np.errstate(divide="ignore", invalid="ignore"):
            f = padded / padded.shift() - 1
    elif method == "diff":
        f = wide.diff()
    elif method == "log_diff":
        least = np.nanmin(wide.to_numpy())
        f = np.log(wide + (abs(least) + 1 if least <= 0 else 0)).diff()
    else:
        f = wide
    return f


@pytest.mark.parametrize("method", FE.METHODS)
def test_long_features_match_pandas(spark, monkeypatch, method):
    monkeypatch.setattr(FE, "STRETCH", 7)       # several stretches a series
    rows = sparse()
    long = spark.createDataFrame(rows, "series_id string, date date, value double").repartition(5)
    want = {(s, d): v for d, r in by_pandas(rows, method).iterrows() for s, v in r.items() if not np.isnan(v)}
    got = {(r.series_id, r.date): r.feature for r in FE.change_long(long, None, method).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == want[k] or abs(got[k] - want[k]) < 1e-9 for k in want)


def test_complete_dates_and_named_panel(spark):
    rows = [("a", 1, 2.0), ("a", 2, 3.0), ("a", 4, 3.0), ("b", 1, 4.0), ("b", 3, 2.0), ("c", 2, 1.0), ("c", 4, 1.0)]
    long = spark.createDataFrame([(s, f"2020-01-0{d}", v) for s, d, v in rows], "series_id string, date string, value double") \
        .withColumn("date", F.to_date("date"))
    full = sorted((str(r.date), r.series_id, r.feature) for r in FE.complete_long(long).collect())
    # c has a value before the 3rd only from the 2nd on
    assert full == [("2020-01-03", "a", 0.0), ("2020-01-03", "b", -0.5), ("2020-01-03", "c", 0.0),
                    ("2020-01-04", "a", 0.0), ("2020-01-04", "b", 0.0), ("2020-01-04", "c", 0.0)]
    wide = FE.prepare_features(long, ["a", "b"]).orderBy("date").collect()
    assert [(str(r.date), r.a, r.b) for r in wide] == [("2020-01-02", 0.5, 0.0), ("2020-01-03", 0.0, -0.5), ("2020-01-04", 0.0, 0.0)]
    panel = FE.outer_panel(long, ["a", "c"]).collect()
    assert len(panel) == 6 and sum(r.value is None for r in panel) == 1
    assert FE.complete_long(long.limit(0)).count() == 0


def test_ten_thousand_series(spark):
    long = spark.range(200_000).select(
        F.concat(F.lit("s"), F.col("id") % 10_000).alias("series_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("id") / 10_000).cast("int")).alias("date"),
        F.when(F.col("id") % 7 != 3, (F.col("id") % 11 + 1).cast("double")).alias("value"))
    assert FE.complete_long(long, "diff").count() == 0       # every date misses some series
    assert FE.complete_long(long, "pct_change").groupBy("date").count().where("count <> 10000").isEmpty()
