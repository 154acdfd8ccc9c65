"""Change features over many series at once (FEAT-*).

Input is long form (series_id, date, value), and so is the work: there is no
column per series.  The union of all dates is the spine, each date with its
position.  A series' row knows the position of its neighbours, by a lag in the
segmented scan of ``order`` (a very long series is split by stretches of the
spine), so that:

- a difference needs the row before it at the position before it;
- a padded percent change also holds on the dates without a row, up to the
  series' next one: its rows cover ranges of positions, and only the dates
  that come out are written down.

Dates count where every series has a feature, like ``dropna()`` on the panel
that these rows are; ``to_wide`` turns a named panel of few series to columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import segmented_lag

METHODS = ("pct_change", "diff", "log_diff", "raw")


STRETCH = 512       # positions of the spine to a window


def date_spine(long_df: DataFrame, date_col: str = "date") -> DataFrame:
    """(pos, date): every date of any series, in order.  One row with the
    dates: each task sends those it has once, and there are as many as the
    calendar has."""
    days = long_df.where(F.col(date_col).isNotNull()).agg(F.sort_array(F.collect_set(date_col)).alias("_days"))
    return days.select(F.posexplode("_days").alias("_pos", date_col))


def observed(long_df: DataFrame, spine: DataFrame, id_col: str = "series_id", date_col: str = "date",
             value_col: str = "value") -> DataFrame:
    """(series, position, value): the rows that have a value, one to a series
    and date."""
    rows = long_df.where(F.col(value_col).isNotNull()).groupBy(id_col, date_col).agg(F.first(value_col).alias("_value"))
    return rows.join(spine, date_col).select(id_col, F.col("_pos"), F.col("_value").cast("double").alias("_value"))


def outer_panel(long_df: DataFrame, series_ids: list[str], id_col: str = "series_id",
                date_col: str = "date", value_col: str = "value") -> DataFrame:
    """The outer-merged panel in long form: (series, date, value or null) for
    every named series on every date of the spine."""
    rows = long_df.where(F.col(id_col).isin(series_ids))
    grid = date_spine(rows, date_col).select(date_col, F.explode(F.array(*[F.lit(s) for s in series_ids])).alias(id_col))
    first = rows.groupBy(id_col, date_col).agg(F.first(value_col, ignorenulls=True).alias(value_col))
    return grid.join(first, [id_col, date_col], "left").select(id_col, date_col, value_col)


def _ratio_minus_one(cur: Column, prev: Column) -> Column:
    """cur / prev - 1 with float semantics: x/0 -> +-Infinity, 0/0 -> NaN
    (ANSI division would raise)."""
    return (F.when(prev.isNull() | cur.isNull(), F.lit(None).cast("double"))
             .when(prev == 0, F.when(cur == 0, F.lit(float("nan")))
                   .when(cur > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
             .otherwise(cur / prev - 1))


def change_long(long_df: DataFrame, series_ids: list[str] | None, method: str,
                id_col: str = "series_id", date_col: str = "date", value_col: str = "value") -> DataFrame:
    """Per-series change on the spine of all dates, long form (series, date,
    feature), rows without a feature left out.  ``series_ids``: None for all.

    pct_change pads gaps first (previous value carried forward), then
    divides by the previous padded value; diff and log_diff use the
    unpadded previous row; raw keeps values as they are.
    """
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method}")
    vals = long_df if series_ids is None else long_df.where(F.col(id_col).isin(series_ids))
    vals = vals.select(id_col, date_col, value_col)
    spine = date_spine(vals, date_col)
    rows = observed(vals, spine, id_col, date_col, value_col)
    if method == "raw":
        found = rows.withColumn("feature", F.col("_value"))
    else:
        if method == "log_diff":
            # shift by the global minimum when it is <= 0 (one row joined to all)
            least = vals.agg(F.min(value_col).cast("double").alias("_least"))
            shift = F.when(F.col("_least") <= 0, F.abs("_least") + 1).otherwise(F.lit(0.0))
            rows = rows.crossJoin(F.broadcast(least)).select(id_col, "_pos", F.ln(F.col("_value") + shift).alias("_value"))
        stretch = F.floor(F.col("_pos") / STRETCH)
        rows = segmented_lag(rows, [id_col], ["_pos"], F.struct("_value", "_pos"), stretch, out="_before")
        if method == "pct_change":
            found = _padded_change(rows, spine, id_col)
        else:
            here = F.col("_before._pos") == F.col("_pos") - 1
            found = rows.withColumn("feature", F.when(here, F.col("_value") - F.col("_before._value")))
    known = found.where(F.col("feature").isNotNull() & ~F.isnan("feature"))
    return known.join(spine, "_pos").select(id_col, date_col, "feature")


def _padded_change(rows: DataFrame, spine: DataFrame, id_col: str) -> DataFrame:
    """Each row and the positions up to the series' next row: the change from
    the value before it, then of its value to itself."""
    back = segmented_lag(rows, [id_col], [F.col("_pos").desc()], "_pos", -F.floor(F.col("_pos") / STRETCH), out="_next")
    end = spine.agg(F.max("_pos").alias("_end"))
    last = F.coalesce(F.col("_next") - 1, F.col("_end"))
    covered = back.crossJoin(F.broadcast(end)).select(      # one row
        id_col, "_value", "_before", F.col("_pos").alias("_own"), F.explode(F.sequence(F.col("_pos"), last)).alias("_pos"))
    prev = F.when(F.col("_pos") == F.col("_own"), F.col("_before._value")).otherwise(F.col("_value"))
    return covered.select(id_col, "_pos", _ratio_minus_one(F.col("_value"), prev).alias("feature"))


def complete_dates(features: DataFrame, n_series: int | DataFrame, date_col: str = "date") -> DataFrame:
    """The rows of dates on which every one of ``n_series`` has a feature;
    ``n_series`` may be a one-row frame with that number."""
    per_date = features.groupBy(date_col).agg(F.count("*").alias("_n"))
    if isinstance(n_series, int):
        whole = per_date.where(F.col("_n") == n_series)
    else:
        only = n_series.columns[0]
        whole = per_date.crossJoin(F.broadcast(n_series)).where(F.col("_n") == F.col(only))
    return features.join(whole.select(date_col), date_col, "left_semi")


def complete_long(long_df: DataFrame, method: str = "pct_change", id_col: str = "series_id", date_col: str = "date",
                  value_col: str = "value") -> DataFrame:
    """FEAT-1..4 over all series of the table, however many: (series, date,
    feature) of the dates on which every series has one."""
    n = long_df.select(id_col).distinct().agg(F.count("*").alias("_series"))
    return complete_dates(change_long(long_df, None, method, id_col, date_col, value_col), n, date_col)


def to_wide_complete(long_feat: DataFrame, series_ids: list[str], id_col: str = "series_id",
                     date_col: str = "date", value_col: str = "feature",
                     decimals: int | None = None) -> DataFrame:
    """Long features -> date x series panel, keeping dates where every
    series has a non-null, non-NaN value (dropna)."""
    ok = long_feat.where(F.col(value_col).isNotNull() & ~F.isnan(value_col))
    r = (lambda c: F.round(c, decimals)) if decimals is not None else (lambda c: c)
    wide = ok.groupBy(date_col).pivot(id_col, series_ids).agg(F.first(value_col))
    complete = wide.where(F.greatest(*[F.col(s).isNull() for s in series_ids]) == F.lit(False))
    return complete.select(date_col, *[r(F.col(s)).alias(s) for s in series_ids])


def prepare_features(long_df: DataFrame, series_ids: list[str], method: str = "pct_change",
                     decimals: int | None = None, **kw) -> DataFrame:
    """FEAT-1..5: the model input panel; dates travel with their rows."""
    return to_wide_complete(change_long(long_df, series_ids, method, **kw), series_ids,
                            decimals=decimals)


# ---------------------------------------------------------------------- FS-1
def feature_range(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """The rows of a feature view between ``start`` (in) and ``end`` (out); the
    bounds are pushed to the scan."""
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def latest_features(df: DataFrame, key: list[str], ts: str, features: list[str],
                    tiebreak: list[str] | None = None) -> DataFrame:
    """FS-1: the features of each key as of its latest row: (key, features,
    ts).  One partial aggregation, so a key of any size is no burden; a null
    ``ts`` is never the latest."""
    order = F.struct(ts, *(tiebreak or []))
    rows = df.where(F.col(ts).isNotNull()).groupBy(*key).agg(F.max_by(F.struct(*features, ts), order).alias("_r"))
    return rows.select(*key, *[F.col(f"_r.{c}").alias(c) for c in (*features, ts)])
