"""Registered queries: aggregations (AGG-*) and the flagship regime report."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from ..operators import aggs as AG
from ..operators import features as FE
from ..operators import hmm as H
from ..operators import order as OR
from .q_joins import DAILY_SQL, EVENT_TYPES
from .registry import query
from .tables import daily_series, read


@query(sql="""
SELECT user_id, strftime(max(CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END) + INTERVAL 1 DAY,
                         '%Y-%m-%d') AS next_start
FROM events GROUP BY user_id
HAVING max(CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END) IS NOT NULL""")
def q_high_water(spark, d):
    """AGG-1/ST-2: per symbol, the day after its last parseable date."""
    ev = read(spark, d, "events").select(
        "user_id", F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date"))
    return AG.high_water(ev, "user_id", "date")


@query(sql="""
SELECT CAST(ts AS DATE) AS date,
  arg_min(value, ts) FILTER (WHERE event_type = 'click') AS click,
  arg_min(value, ts) FILTER (WHERE event_type = 'error') AS error,
  arg_min(value, ts) FILTER (WHERE event_type = 'purchase') AS purchase,
  arg_min(value, ts) FILTER (WHERE event_type = 'signup') AS signup,
  arg_min(value, ts) FILTER (WHERE event_type = 'view') AS "view"
FROM events GROUP BY 1""")
def q_pivot_first(spark, d):
    """AGG-4: date x series -> first value in arrival order."""
    ev = read(spark, d, "events").withColumn("date", F.to_date("ts"))
    return AG.pivot_first(ev, "date", "event_type", EVENT_TYPES, "value", ["ts", "event_id"])


@query(sql="""
SELECT CASE WHEN value < 10 THEN 0 WHEN value < 25 THEN 1 ELSE 2 END AS state, count(*) AS n
FROM events GROUP BY 1""")
def q_state_dist(spark, d):
    """AGG-5: count per state (fixed thresholds)."""
    ev = read(spark, d, "events")
    st = F.when(F.col("value") < 10, 0).when(F.col("value") < 25, 1).otherwise(2)
    return AG.state_distribution(ev.select(st.alias("state")))


PCT_PANEL_SQL = DAILY_SQL + """,
spine AS (
  SELECT dd.date, s.series_id FROM (SELECT DISTINCT date FROM daily) dd
  CROSS JOIN (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) s(series_id)
),
panel AS (SELECT sp.series_id, sp.date, dl.value FROM spine sp LEFT JOIN daily dl USING (series_id, date)),
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
),
wide AS (
  SELECT date,
    max(f) FILTER (WHERE series_id = 'click') AS click,
    max(f) FILTER (WHERE series_id = 'error') AS error,
    max(f) FILTER (WHERE series_id = 'purchase') AS purchase,
    max(f) FILTER (WHERE series_id = 'signup') AS signup,
    max(f) FILTER (WHERE series_id = 'view') AS "view"
  FROM feat WHERE f IS NOT NULL AND NOT isnan(f) GROUP BY date
),
complete AS (
  SELECT * FROM wide WHERE click IS NOT NULL AND error IS NOT NULL AND purchase IS NOT NULL
    AND signup IS NOT NULL AND "view" IS NOT NULL
)"""


def pct_panel(spark, d):
    """FEAT-1 panel of the daily event series (unrounded)."""
    return FE.prepare_features(daily_series(spark, d), EVENT_TYPES, "pct_change")


# Fixed three-state model of the daily changes (Expansion, Peak, Contraction).
REGIME_PI = [0.4, 0.4, 0.2]
REGIME_A = [[0.6, 0.3, 0.1], [0.25, 0.5, 0.25], [0.1, 0.3, 0.6]]
REGIME_MEAN, REGIME_VAR = [0.2, 0.0, -0.2], [0.09, 0.04, 0.09]


def regime_model() -> H.HMMParams:
    wide = np.ones((1, len(EVENT_TYPES)))
    return H.HMMParams(np.array(REGIME_PI), np.array(REGIME_A), np.array(REGIME_MEAN)[:, None] * wide,
                       np.array(REGIME_VAR)[:, None] * wide, EVENT_TYPES)


def _viterbi_sql(names: list[str], source: str) -> str:
    """CTEs up to ``lab``: the rows of ``source`` (one sequence by date) with
    the model's most likely state as ``regime_idx``."""
    k = range(len(REGIME_PI))
    log = lambda p: repr(math.log(p))
    emission = [" + ".join(f"(-0.5 * (ln(2 * pi() * {REGIME_VAR[s]}) + (x - {REGIME_MEAN[s]!r}) * (x - {REGIME_MEAN[s]!r}) / {REGIME_VAR[s]}))"
                           .replace("x ", f'"{c}" ') for c in names) for s in k]
    best = [f"greatest({', '.join(f'v.d{i} + {log(REGIME_A[i][j])}' for i in k)})" for j in k]
    came = ["CASE " + " ".join(f"WHEN v.d{i} + {log(REGIME_A[i][j])} = {best[j]} THEN {i}" for i in k) + " END" for j in k]
    last = "CASE " + " ".join(f"WHEN v.d{i} = greatest({', '.join(f'v.d{x}' for x in k)}) THEN {i}" for i in k) + " END"
    return f"""
em AS (SELECT *, row_number() OVER (ORDER BY date) AS t, {', '.join(f'{emission[s]} AS e{s}' for s in k)} FROM {source}),
vit AS (
  SELECT t, {', '.join(f'{log(REGIME_PI[s])} + e{s} AS d{s}' for s in k)}, {', '.join(f'CAST(NULL AS INTEGER) AS b{s}' for s in k)}
  FROM em WHERE t = 1
  UNION ALL
  SELECT n.t, {', '.join(f'{best[s]} + n.e{s}' for s in k)}, {', '.join(came)}
  FROM vit v JOIN em n ON n.t = v.t + 1
),
bt AS (
  SELECT v.t, {last} AS state, {', '.join(f'v.b{s}' for s in k)} FROM vit v WHERE v.t = (SELECT max(t) FROM vit)
  UNION ALL
  SELECT v.t, CASE b.state {' '.join(f'WHEN {s} THEN b.b{s}' for s in k)} END, {', '.join(f'v.b{s}' for s in k)}
  FROM bt b JOIN vit v ON v.t = b.t - 1
),
lab AS (SELECT em.*, bt.state AS regime_idx FROM em JOIN bt USING (t))"""


@query(sql="WITH RECURSIVE " + PCT_PANEL_SQL.strip() + "," + _viterbi_sql(["click", "error", "purchase", "signup", "view"], "complete") + """,
long AS (
  SELECT regime_idx, 'click' AS feature, click AS x FROM lab UNION ALL
  SELECT regime_idx, 'error', error FROM lab UNION ALL
  SELECT regime_idx, 'purchase', purchase FROM lab UNION ALL
  SELECT regime_idx, 'signup', signup FROM lab UNION ALL
  SELECT regime_idx, 'view', "view" FROM lab
)
SELECT CASE regime_idx WHEN 0 THEN 'Expansion' WHEN 1 THEN 'Peak' ELSE 'Contraction' END AS regime,
       regime_idx, count(*) AS n_observations, feature,
       round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max
FROM long GROUP BY regime_idx, feature""")
def q_regime_stats(spark, d):
    """Flagship (HMM-2/HMM-9/AGG-5/AGG-6/FEAT-1/JOIN-1): daily series aligned
    by type -> padded percent change -> most likely regime of each date under
    a three-state model -> per regime and feature: n, mean, population std,
    min, max."""
    panel = pct_panel(spark, d).withColumn("panel", F.lit("events"))
    seqs = H.prepare_sequences(panel, ["panel"], ["date"], EVENT_TYPES)
    lab = H.viterbi(seqs, regime_model(), ["panel"], ["date", *EVENT_TYPES]).withColumnRenamed("state", "regime_idx")
    return AG.regime_characteristics(lab, "regime_idx", EVENT_TYPES, k=3, decimals=6)


@query(sql="""
SELECT s_nationkey, string_agg(s_name, ',' ORDER BY s_name) AS members, count(s_name) AS n_members,
       count(DISTINCT s_name) AS n_unique
FROM supplier GROUP BY s_nationkey""")
def q_members(spark, d):
    """AGG-7: group members (sorted list as text) and counts."""
    return AG.members(read(spark, d, "supplier"), "s_nationkey", "s_name")


@query(sql="""
SELECT CAST(ts AS DATE) AS date,
  count(*) FILTER (WHERE event_type <> 'error' AND value >= 1) AS success,
  count(*) FILTER (WHERE event_type = 'error') AS failed,
  count(*) FILTER (WHERE event_type <> 'error' AND value < 1) AS skipped,
  count(*) AS total
FROM events GROUP BY 1""")
def q_tally(spark, d):
    """AGG-8: run tallies per day of a job-result table."""
    ev = read(spark, d, "events")
    outcome = (F.when(F.col("event_type") == "error", "failed").when(F.col("value") < 1, "skipped")
                .otherwise("success"))
    return AG.tally(ev.select(F.to_date("ts").alias("date"), outcome.alias("outcome")), "outcome", ["date"])


@query(sql="""
WITH a AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE WHEN grouping(o_orderstatus) = 1 THEN 'TOTAL' ELSE o_orderstatus END AS filing_type,
         count(*) AS sec_index_count
  FROM orders GROUP BY ROLLUP (year(o_orderdate), o_orderstatus) HAVING grouping(year(o_orderdate)) = 0
),
b AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE WHEN grouping(o_orderstatus) = 1 THEN 'TOTAL' ELSE o_orderstatus END AS filing_type,
         count(*) AS db_count
  FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
  GROUP BY ROLLUP (year(o_orderdate), o_orderstatus) HAVING grouping(year(o_orderdate)) = 0
)
SELECT coalesce(a.year, b.year) AS year, coalesce(a.filing_type, b.filing_type) AS filing_type,
       coalesce(a.sec_index_count, 0) AS sec_index_count, coalesce(b.db_count, 0) AS db_count,
       coalesce(a.sec_index_count, 0) = coalesce(b.db_count, 0) AS is_complete
FROM a FULL OUTER JOIN b ON a.year = b.year AND a.filing_type = b.filing_type""")
def q_completeness(spark, d):
    """AGG-9: per (year, form) and per-year TOTAL: index vs stored counts."""
    o = read(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority")
    stored = o.where(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")))
    return AG.completeness(o, stored, "year", "o_orderstatus")


@query(sql="""
SELECT DISTINCT event_type AS indicator_code, event_type AS indicator_name FROM events WHERE event_type IS NOT NULL""")
def q_distinct_vals(spark, d):
    """AGG-10: distinct non-null codes (the code doubles as the name)."""
    return AG.distinct_values(read(spark, d, "events"), "event_type", "indicator_code", "indicator_name")


SPARSE_SQL = """
sparse AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS date, round(sum(CASE WHEN value > 45 THEN value END), 2) AS value
  FROM events GROUP BY 1, 2
),
sspine AS (
  SELECT dd.date, s.series_id FROM (SELECT DISTINCT date FROM sparse) dd
  CROSS JOIN (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) s(series_id)
),
spanel AS (SELECT sp.series_id, sp.date, x.value FROM sspine sp LEFT JOIN sparse x USING (series_id, date)),
filled AS (
  SELECT series_id, date, coalesce(
    last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value
  FROM spanel
)"""


def sparse_series(spark, d):
    """Daily totals of the large events; a day without one has a null value
    (all rows are read and every day stays)."""
    large = F.when(F.col("value") > 45, F.col("value"))
    return (read(spark, d, "events").groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("date"))
            .agg(F.round(F.sum(large), 2).alias("value")))


def filled_sparse(spark, d):
    """WIN-3 on the sparse daily panel: spine, then forward and backward
    fill per series (segmented by month)."""
    panel = FE.outer_panel(sparse_series(spark, d), EVENT_TYPES)
    return OR.ffill_bfill(panel, ["series_id"], "date", ["value"], F.date_trunc("month", "date"))


@query(sql="WITH " + SPARSE_SQL + """,
st AS (
  SELECT series_id, date,
    (value - avg(value) OVER (PARTITION BY series_id)) /
      CASE WHEN coalesce(stddev_pop(value) OVER (PARTITION BY series_id), 0) = 0 THEN 1
           ELSE stddev_pop(value) OVER (PARTITION BY series_id) END AS z
  FROM filled
)
SELECT date,
  round(max(z) FILTER (WHERE series_id = 'click'), 6) AS click,
  round(max(z) FILTER (WHERE series_id = 'error'), 6) AS error,
  round(max(z) FILTER (WHERE series_id = 'purchase'), 6) AS purchase,
  round(max(z) FILTER (WHERE series_id = 'signup'), 6) AS signup,
  round(max(z) FILTER (WHERE series_id = 'view'), 6) AS "view"
FROM st GROUP BY date""")
def q_standardize(spark, d):
    """FEAT-6/AGG-12: sort by date, forward+backward fill, standardise
    with population std (0 -> 1)."""
    wide = filled_sparse(spark, d).groupBy("date").pivot("series_id", EVENT_TYPES).agg(F.first("value"))
    z = AG.standardize(wide, EVENT_TYPES)
    return z.select("date", *[F.round(c, 6).alias(c) for c in EVENT_TYPES])


@query(sql="""
SELECT 'customer_count' AS key, CAST(count(*) AS VARCHAR) AS value FROM customer UNION ALL
SELECT 'supplier_count', CAST(count(*) AS VARCHAR) FROM supplier UNION ALL
SELECT 'part_count', CAST(count(*) AS VARCHAR) FROM part UNION ALL
SELECT 'orders_count', CAST(count(*) AS VARCHAR) FROM orders UNION ALL
SELECT 'lineitem_count', CAST(count(*) AS VARCHAR) FROM lineitem""")
def q_totals(spark, d):
    """AGG-13: catalogue row counts as key/value text."""
    return AG.totals({t: read(spark, d, t) for t in ["customer", "supplier", "part", "orders", "lineitem"]})
