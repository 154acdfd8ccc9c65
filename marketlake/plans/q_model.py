"""Registered queries: hidden-Markov regime operators (HMM-*).

Sequences are the events of each user ordered by (ts, event_id); the
observation is ``value``.  Fixed parameters make the forward pass, Viterbi
path, metrics and one EM step checkable against a recursive SQL twin; the fits
run EM steps until they converge and have none.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from ..functions.scalars import regime_name
from ..operators import hmm as H
from .registry import query
from .tables import read

# Fixed two-state model used by the checkable queries.
PI = [0.6, 0.4]
A = [[0.9, 0.1], [0.2, 0.8]]
MEANS = [[10.0], [30.0]]
VARS = [[25.0], [100.0]]
# The fits end when the log-likelihood changes by no more than this share.
EM_TOL = 1e-3


def fixed_params() -> H.HMMParams:
    return H.HMMParams(np.array(PI), np.array(A), np.array(MEANS), np.array(VARS), ["value"])


def user_sequences(spark, d):
    ev = read(spark, d, "events")
    return H.prepare_sequences(ev, ["user_id"], ["ts", "event_id"], ["value"])


def _lse2(a: str, b: str) -> str:
    return f"(greatest({a}, {b}) + ln(exp(({a}) - greatest({a}, {b})) + exp(({b}) - greatest({a}, {b}))))"


def _emis(mu: float, var: float) -> str:
    return f"(-0.5 * (ln(2 * pi() * {var}) + (x - {mu}) * (x - {mu}) / {var}))"


_L = {k: repr(math.log(v)) for k, v in
      {"p0": PI[0], "p1": PI[1], "a00": A[0][0], "a01": A[0][1], "a10": A[1][0], "a11": A[1][1]}.items()}

SEQ_SQL = f"""
seq AS (
  SELECT user_id, event_id, ts, value AS x,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS t
  FROM events
),
em AS (SELECT *, {_emis(MEANS[0][0], VARS[0][0])} AS e0, {_emis(MEANS[1][0], VARS[1][0])} AS e1 FROM seq)"""

FORWARD_SQL = "WITH RECURSIVE " + SEQ_SQL + f""",
fw AS (
  SELECT user_id, t, event_id, ts,
         l0 - {_lse2('l0', 'l1')} AS a0, l1 - {_lse2('l0', 'l1')} AS a1, {_lse2('l0', 'l1')} AS ll
  FROM (SELECT user_id, t, event_id, ts, {_L['p0']} + e0 AS l0, {_L['p1']} + e1 AS l1 FROM em WHERE t = 1) b
  UNION ALL
  SELECT user_id, t, event_id, ts,
         l0 - {_lse2('l0', 'l1')}, l1 - {_lse2('l0', 'l1')}, ll + {_lse2('l0', 'l1')}
  FROM (
    SELECT n.user_id, n.t, n.event_id, n.ts, f.ll,
           {_lse2('f.a0 + ' + _L['a00'], 'f.a1 + ' + _L['a10'])} + n.e0 AS l0,
           {_lse2('f.a0 + ' + _L['a01'], 'f.a1 + ' + _L['a11'])} + n.e1 AS l1
    FROM fw f JOIN em n ON n.user_id = f.user_id AND n.t = f.t + 1) s
)"""


@query(sql=FORWARD_SQL + """
SELECT user_id, ts, event_id, round(exp(a0), 6) AS p_0, round(exp(a1), 6) AS p_1 FROM fw""")
def q_forward(spark, d):
    """HMM-3: filtered state probabilities per event (fixed 2-state model)."""
    out = H.filtered_probabilities(user_sequences(spark, d), fixed_params(), ["user_id"], ["ts", "event_id"],
                                   ["value"])
    return out.select("user_id", "ts", "event_id", F.round("p_0", 6).alias("p_0"), F.round("p_1", 6).alias("p_1"))


VITERBI_SQL = "WITH RECURSIVE " + SEQ_SQL + f""",
vit AS (
  SELECT user_id, t, {_L['p0']} + e0 AS d0, {_L['p1']} + e1 AS d1, CAST(NULL AS INTEGER) AS b0, CAST(NULL AS INTEGER) AS b1
  FROM em WHERE t = 1
  UNION ALL
  SELECT n.user_id, n.t,
         greatest(v.d0 + {_L['a00']}, v.d1 + {_L['a10']}) + n.e0,
         greatest(v.d0 + {_L['a01']}, v.d1 + {_L['a11']}) + n.e1,
         CASE WHEN v.d0 + {_L['a00']} >= v.d1 + {_L['a10']} THEN 0 ELSE 1 END,
         CASE WHEN v.d0 + {_L['a01']} >= v.d1 + {_L['a11']} THEN 0 ELSE 1 END
  FROM vit v JOIN em n ON n.user_id = v.user_id AND n.t = v.t + 1
),
last AS (SELECT user_id, max(t) AS tt FROM seq GROUP BY user_id),
bt AS (
  SELECT v.user_id, v.t, CASE WHEN v.d0 >= v.d1 THEN 0 ELSE 1 END AS state, v.b0, v.b1
  FROM vit v JOIN last l ON v.user_id = l.user_id AND v.t = l.tt
  UNION ALL
  SELECT v.user_id, v.t, CASE WHEN b.state = 0 THEN b.b0 ELSE b.b1 END, v.b0, v.b1
  FROM bt b JOIN vit v ON v.user_id = b.user_id AND v.t = b.t - 1
)"""


@query(sql=VITERBI_SQL + """
SELECT s.user_id, s.ts, s.event_id, CAST(b.state AS INTEGER) AS state
FROM bt b JOIN seq s ON s.user_id = b.user_id AND s.t = b.t""")
def q_viterbi(spark, d):
    """HMM-2: most likely state path per user (fixed 2-state model)."""
    return H.viterbi(user_sequences(spark, d), fixed_params(), ["user_id"], ["ts", "event_id"], ["value"])


@query(sql=FORWARD_SQL + f""",
tot AS (
  SELECT sum(ll) AS log_likelihood FROM fw f
  JOIN (SELECT user_id, max(t) AS tt FROM seq GROUP BY user_id) l ON f.user_id = l.user_id AND f.t = l.tt
),
n AS (SELECT count(*) AS n_samples FROM events)
SELECT round(log_likelihood, 4) AS log_likelihood,
       round(-2 * log_likelihood + 2 * {H.n_params(2, 1)}, 4) AS aic,
       round(-2 * log_likelihood + ln(n_samples) * {H.n_params(2, 1)}, 4) AS bic,
       2 AS n_regimes, n_samples, 1 AS n_features
FROM tot, n""")
def q_hmm_metrics(spark, d):
    """HMM-4: total log-likelihood, AIC and BIC of the fixed model."""
    m = H.model_metrics(user_sequences(spark, d), fixed_params(), ["user_id"], ["ts", "event_id"], ["value"])
    return m.select(F.round("log_likelihood", 4).alias("log_likelihood"), F.round("aic", 4).alias("aic"),
                    F.round("bic", 4).alias("bic"), "n_regimes", "n_samples", "n_features")


@query(sql="""
SELECT p_partkey, k, d, (k - 1) + k * (k - 1) + 2 * k * d AS n_params
FROM (SELECT p_partkey, p_size % 7 + 2 AS k, p_partkey % 4 + 1 AS d FROM part)""")
def q_param_count(spark, d):
    """HMM-5: (k-1) + k(k-1) + 2kd over a grid of model sizes."""
    n = read(spark, d, "part")
    k, dd = F.col("p_size") % 7 + 2, F.col("p_partkey") % 4 + 1
    return n.select("p_partkey", k.alias("k"), dd.alias("d"), H.n_params(k, dd).alias("n_params"))


CHAIN_SQL = """
st AS (
  SELECT user_id, CASE WHEN value >= 25 THEN 1 ELSE 0 END AS s,
         lag(CASE WHEN value >= 25 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ps
  FROM events
),
c AS (
  SELECT user_id,
    count(*) FILTER (WHERE ps = 0 AND s = 0) AS n00, count(*) FILTER (WHERE ps = 0 AND s = 1) AS n01,
    count(*) FILTER (WHERE ps = 1 AND s = 0) AS n10, count(*) FILTER (WHERE ps = 1 AND s = 1) AS n11
  FROM st GROUP BY user_id
),
p AS (
  SELECT user_id,
    CASE WHEN n00 + n01 = 0 THEN 1.0 ELSE n00 / (n00 + n01) END AS p00,
    CASE WHEN n00 + n01 = 0 THEN 0.0 ELSE n01 / (n00 + n01) END AS p01,
    CASE WHEN n10 + n11 = 0 THEN 0.0 ELSE n10 / (n10 + n11) END AS p10,
    CASE WHEN n10 + n11 = 0 THEN 1.0 ELSE n11 / (n10 + n11) END AS p11
  FROM c
)"""


def user_chains(spark, d):
    """Two-state transition matrix per user, counted from consecutive
    events (state = value >= 25).  The previous state comes from a
    segmented lag (per user and day, carried across days), so a user with a
    third of all events is still spread over many tasks; counting is a
    partial aggregation."""
    from ..operators.order import segmented_lag
    ev = read(spark, d, "events")
    s = F.when(F.col("value") >= 25, 1).otherwise(0)
    st = segmented_lag(ev.select("user_id", "ts", "event_id", s.alias("s")), ["user_id"], ["ts", "event_id"],
                       "s", F.to_date("ts"), out="ps")
    c = st.groupBy("user_id").agg(*[F.count_if((F.col("ps") == i) & (F.col("s") == j)).alias(f"n{i}{j}")
                                    for i in (0, 1) for j in (0, 1)])

    def row(i):
        tot = F.col(f"n{i}0") + F.col(f"n{i}1")
        return F.array(*[F.when(tot == 0, F.lit(1.0 if i == j else 0.0)).otherwise(F.col(f"n{i}{j}") / tot)
                         for j in (0, 1)])
    return c.select("user_id", F.array(row(0), row(1)).alias("trans"))


@query(sql="WITH " + CHAIN_SQL + """
SELECT user_id, f.from_state, CASE f.from_state WHEN 0 THEN 'Expansion' ELSE 'Contraction' END AS from_regime,
       f.to_state, CASE f.to_state WHEN 0 THEN 'Expansion' ELSE 'Contraction' END AS to_regime, round(f.p, 6) AS p
FROM p, (SELECT 0 AS from_state, 0 AS to_state UNION ALL SELECT 0, 1 UNION ALL SELECT 1, 0 UNION ALL SELECT 1, 1) g,
     LATERAL (SELECT g.from_state, g.to_state,
                     CASE WHEN g.from_state = 0 AND g.to_state = 0 THEN p00 WHEN g.from_state = 0 THEN p01
                          WHEN g.to_state = 0 THEN p10 ELSE p11 END AS p) f""")
def q_transition_rows(spark, d):
    """HMM-6: models table (one 2-state chain per user) -> transition rows
    with regime names."""
    t = H.transition_rows(user_chains(spark, d), "user_id", "trans", 2)
    return t.select("user_id", F.col("from_state").cast("int").alias("from_state"), "from_regime",
                    F.col("to_state").cast("int").alias("to_state"), "to_regime", F.round("p", 6).alias("p"))


@query(sql="""
WITH m AS (
  SELECT event_type AS model, 0 AS state, avg(value) FILTER (WHERE value < 25) AS mean,
         var_pop(value) FILTER (WHERE value < 25) AS var FROM events GROUP BY event_type
  UNION ALL
  SELECT event_type, 1, avg(value) FILTER (WHERE value >= 25), var_pop(value) FILTER (WHERE value >= 25)
  FROM events GROUP BY event_type
)
SELECT model, state, CASE state WHEN 0 THEN 'Expansion' ELSE 'Contraction' END AS regime, 'value' AS feature,
       round(mean, 6) AS mean, round(var, 6) AS var
FROM m""")
def q_emission_rows(spark, d):
    """HMM-6: per-model emission parameters (nested arrays in the models
    table) -> (model, state, regime, feature, mean, var) rows."""
    ev = read(spark, d, "events")
    lo, hi = F.col("value") < 25, F.col("value") >= 25
    m = ev.groupBy(F.col("event_type").alias("model")).agg(
        F.avg(F.when(lo, F.col("value"))).alias("m0"), F.avg(F.when(hi, F.col("value"))).alias("m1"),
        F.var_pop(F.when(lo, F.col("value"))).alias("v0"), F.var_pop(F.when(hi, F.col("value"))).alias("v1"))
    models = m.select("model", F.array(F.array("m0"), F.array("m1")).alias("means"),
                      F.array(F.array("v0"), F.array("v1")).alias("vars"))
    e = H.emission_rows(models, "model", "means", "vars", 2, ["value"])
    return e.select("model", F.col("state").cast("int").alias("state"), "regime", "feature",
                    F.round("mean", 6).alias("mean"), F.round("var", 6).alias("var"))


@query(sql="WITH " + CHAIN_SQL + """
SELECT user_id,
  round(CASE WHEN p01 + p10 = 0 THEN 0.5 ELSE p10 / (p01 + p10) END, 6) AS pi_0,
  round(CASE WHEN p01 + p10 = 0 THEN 0.5 ELSE p01 / (p01 + p10) END, 6) AS pi_1
FROM p""")
def q_stationary(spark, d):
    """HMM-7: stationary distribution of every user's chain at once
    (batched repeated squaring of the lazy chain per Arrow batch)."""
    st = H.stationary_table(user_chains(spark, d), ["user_id"], "trans", 2)
    return st.select("user_id", F.round("pi_0", 6).alias("pi_0"), F.round("pi_1", 6).alias("pi_1"))


# the backward vectors, normalised, from the last row of each sequence on
EM_SQL = FORWARD_SQL + f""",
n AS (SELECT user_id, max(t) AS tt FROM seq GROUP BY user_id),
bw AS (
  SELECT user_id, tt AS t, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 FROM n
  UNION ALL
  SELECT user_id, t, l0 - {_lse2('l0', 'l1')}, l1 - {_lse2('l0', 'l1')}
  FROM (
    SELECT b.user_id, b.t - 1 AS t,
           {_lse2(_L['a00'] + ' + e.e0 + b.b0', _L['a01'] + ' + e.e1 + b.b1')} AS l0,
           {_lse2(_L['a10'] + ' + e.e0 + b.b0', _L['a11'] + ' + e.e1 + b.b1')} AS l1
    FROM bw b JOIN em e ON e.user_id = b.user_id AND e.t = b.t WHERE b.t > 1) s
),
g AS (
  SELECT f.user_id, f.t, em.x, exp(f.a0 + b.b0) / (exp(f.a0 + b.b0) + exp(f.a1 + b.b1)) AS g0
  FROM fw f JOIN bw b USING (user_id, t) JOIN em USING (user_id, t)
),
x AS (
  SELECT {', '.join(f"exp(f.a{i} + {_L[f'a{i}{j}']} + e.e{j} + b.b{j} - m) AS x{i}{j}" for i in (0, 1) for j in (0, 1))}
  FROM fw f JOIN em e ON e.user_id = f.user_id AND e.t = f.t + 1 JOIN bw b ON b.user_id = e.user_id AND b.t = e.t,
    LATERAL (SELECT greatest({', '.join(f"f.a{i} + {_L[f'a{i}{j}']} + e.e{j} + b.b{j}" for i in (0, 1) for j in (0, 1))}) AS m)
),
xi AS (SELECT {', '.join(f"sum(x{i}{j} / (x00 + x01 + x10 + x11)) AS n{i}{j}" for i in (0, 1) for j in (0, 1))} FROM x),
ll AS (SELECT sum(fw.ll) AS ll FROM fw JOIN n ON fw.user_id = n.user_id AND fw.t = n.tt),
s AS (
  SELECT sum(g0) AS w0, sum(1 - g0) AS w1, sum(g0 * x) / sum(g0) AS m0, sum((1 - g0) * x) / sum(1 - g0) AS m1,
         sum(g0 * x * x) / sum(g0) AS q0, sum((1 - g0) * x * x) / sum(1 - g0) AS q1,
         avg(g0) FILTER (WHERE t = 1) AS p0
  FROM g
)
SELECT 0 AS state, round(p0, 6) AS pi, round(n00 / (n00 + n01), 6) AS to_0, round(n01 / (n00 + n01), 6) AS to_1,
       round(m0, 5) AS mean, round(q0 - m0 * m0, 4) AS var, round(ll, 3) AS log_likelihood FROM s, xi, ll
UNION ALL
SELECT 1, round(1 - p0, 6), round(n10 / (n10 + n11), 6), round(n11 / (n10 + n11), 6), round(m1, 5), round(q1 - m1 * m1, 4),
       round(ll, 3) FROM s, xi, ll"""


@query(sql=EM_SQL)
def q_em_step(spark, d):
    """HMM-1: one EM step (E-step over all events, M-step) from the fixed
    two-state model: the new parameters, a row per state."""
    seqs = user_sequences(spark, d)
    start = H.Models.of(spark, fixed_params())
    null = F.lit(None)
    start.df = start.df.select("*", null.cast("double").alias("log_likelihood"), null.cast("array<double>").alias("history"),
                               F.lit(0).alias("iterations"), F.lit(False).alias("converged"))
    found = H.m_step(start, H.expected_stats(seqs, start, ["user_id"])).df
    each = found.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("state"))
    return each.select("state", F.round(F.col("pi")[F.col("state")], 6).alias("pi"),
                       *[F.round(F.col("trans")[F.col("state") * 2 + j], 6).alias(f"to_{j}") for j in (0, 1)],
                       F.round(F.col("means")[F.col("state")], 5).alias("mean"),
                       F.round(F.col("vars")[F.col("state")], 4).alias("var"),
                       F.round("log_likelihood", 3).alias("log_likelihood"))


@query
def q_hmm_fit(spark, d):
    """HMM-1/HMM-9/AGG-5: EM fit of a pooled 3-state model on per-user
    sequences until it converges, then Viterbi labels and the regime
    distribution."""
    seqs = user_sequences(spark, d)
    models = H.fit_models(seqs, [], ["user_id"], ["value"], k=3, tol=EM_TOL)
    states = H.viterbi(seqs, models, ["user_id"], ["ts", "event_id"])
    return (states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
                  .crossJoin(F.broadcast(models.df.select("iterations", "converged")))      # one row
                  .select(regime_name(3, F.col("state")).alias("regime"), "state", "n", "iterations", "converged"))


@query
def q_hmm_fit_by_type(spark, d):
    """HMM-1 'one model per model key': a 2-state model per event type,
    fitted in the same jobs over every (type, user) sequence until each has
    converged, then Viterbi labels and the state distribution per model."""
    seq_cols = ["event_type", "user_id"]
    seqs = H.prepare_sequences(read(spark, d, "events"), seq_cols, ["ts", "event_id"], ["value"])
    models = H.fit_models(seqs, ["event_type"], seq_cols, ["value"], k=2, tol=EM_TOL)
    states = H.viterbi(seqs, models, seq_cols, ["ts", "event_id"])
    return (states.groupBy("event_type", "state").agg(F.count(F.lit(1)).alias("n"))
                  .join(models.df.select("event_type", "iterations", "converged"), "event_type")
                  .select("event_type", regime_name(2, F.col("state")).alias("regime"), "state", "n", "iterations", "converged"))
