"""Registered queries: change features on the sparse daily panel (FEAT-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from .q_aggs import sparse_series
from .q_joins import EVENT_TYPES
from .registry import query

SPARSE_PANEL_SQL = """
sparse AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS date, round(sum(CASE WHEN value > 45 THEN value END), 2) AS value
  FROM events GROUP BY 1, 2
),
spine AS (
  SELECT dd.date, s.series_id FROM (SELECT DISTINCT date FROM sparse) dd
  CROSS JOIN (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) s(series_id)
),
panel AS (SELECT sp.series_id, sp.date, x.value FROM spine sp LEFT JOIN sparse x USING (series_id, date))"""


def _wide_sql(value_expr: str) -> str:
    cols = ",\n".join(f"  round(max(f) FILTER (WHERE series_id = '{s}'), 6) AS \"{s}\"" for s in EVENT_TYPES)
    return f"""
SELECT date,
{cols}
FROM (SELECT series_id, date, {value_expr} AS f FROM feat) z
WHERE f IS NOT NULL AND NOT isnan(f)
GROUP BY date
HAVING count(*) = {len(EVENT_TYPES)}"""


@query(sql="WITH " + SPARSE_PANEL_SQL + """,
padded AS (
  SELECT series_id, date,
    last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur,
    last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM panel
),
feat AS (
  SELECT series_id, date,
    CASE WHEN prev IS NULL OR cur IS NULL THEN NULL
         WHEN prev = 0 THEN CASE WHEN cur = 0 THEN 'nan'::DOUBLE WHEN cur > 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END
         ELSE cur / prev - 1 END AS f
  FROM padded
)""" + _wide_sql("f"))
def q_pct_change(spark, d):
    """FEAT-1/FEAT-5: percent change with gaps padded first; dates where
    every series has a value."""
    return FE.prepare_features(sparse_series(spark, d), EVENT_TYPES, "pct_change", decimals=6)


@query(sql="WITH " + SPARSE_PANEL_SQL + """,
feat AS (
  SELECT series_id, date, value - lag(value) OVER (PARTITION BY series_id ORDER BY date) AS f FROM panel
)""" + _wide_sql("f"))
def q_diff(spark, d):
    """FEAT-2: first difference on the unpadded panel."""
    return FE.prepare_features(sparse_series(spark, d), EVENT_TYPES, "diff", decimals=6)


@query(sql="WITH " + SPARSE_PANEL_SQL + """,
shifted AS (
  SELECT series_id, date, value - 100 AS v FROM panel
),
g AS (SELECT CASE WHEN min(v) <= 0 THEN abs(min(v)) + 1 ELSE 0 END AS shift FROM shifted),
feat AS (
  SELECT series_id, date,
    ln(v + g.shift) - lag(ln(v + g.shift)) OVER (PARTITION BY series_id ORDER BY date) AS f
  FROM shifted, g
)""" + _wide_sql("f"))
def q_log_diff(spark, d):
    """FEAT-3/AGG-11: shift by the global minimum when it is <= 0, log,
    first difference."""
    s = sparse_series(spark, d).withColumn("value", F.col("value") - 100)
    return FE.prepare_features(s, EVENT_TYPES, "log_diff", decimals=6)


@query(sql="WITH " + SPARSE_PANEL_SQL + """,
feat AS (SELECT series_id, date, value AS f FROM panel)""" + _wide_sql("f"))
def q_raw(spark, d):
    """FEAT-4: raw values, incomplete dates dropped."""
    return FE.prepare_features(sparse_series(spark, d), EVENT_TYPES, "raw", decimals=6)
