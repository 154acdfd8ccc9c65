"""Regime model properties on small sequences."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import hmm as H

P = H.HMMParams(np.array([0.6, 0.4]), np.array([[0.9, 0.1], [0.2, 0.8]]), np.array([[0.0], [3.0]]),
                np.array([[1.0], [2.0]]), ["x"])


def seq_df(spark, n=120, users=3, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(users):
        s = 0
        for t in range(n):
            s = s if rng.random() < 0.85 else 1 - s
            rows.append((u, t, float(rng.normal(3.0 * s, 1.0 + s)), t // 10))
    return spark.createDataFrame(rows, "u long, t long, x double, blk long")


def dense_forward(x, p):
    E = H._emission_log(np.array(x)[:, None], p.means, p.vars)
    a = np.log(p.pi) + E[0]
    ll, out = 0.0, []
    for t in range(len(x)):
        if t:
            a = np.array([np.logaddexp.reduce(a + np.log(p.A[:, j])) for j in range(2)]) + E[t]
        s = np.logaddexp.reduce(a)
        ll += s
        a = a - s
        out.append(np.exp(a))
    return np.array(out), ll


@pytest.mark.parametrize("chunk", [7, 50, 100_000])
def test_forward_matches_dense_at_any_chunk_size(spark, chunk):
    df = seq_df(spark)
    seqs = H.prepare_sequences(df, ["u"], ["t"], ["x"], chunk)
    got = H.filtered_probabilities(seqs, P, ["u"], ["t"]).orderBy("u", "t").collect()
    pdf = df.orderBy("u", "t").toPandas()
    for u in range(3):
        ref, _ = dense_forward(pdf[pdf.u == u].x.tolist(), P)
        mine = np.array([[r.p_0, r.p_1] for r in got if r.u == u])
        assert np.allclose(mine, ref, atol=1e-9)
        assert np.allclose(mine.sum(axis=1), 1.0)


def many_lengths(spark, seed=3):
    """One sequence of several segments with most rows, and many short ones."""
    rng = np.random.default_rng(seed)
    rows = [(u, t, float(rng.normal(3.0 * (t // 9 % 2), 1.0)))
            for u, n in [(0, 1500), *((u, 1 + u % 5) for u in range(1, 120))] for t in range(n)]
    return spark.createDataFrame(rows, "u long, t long, x double")


def test_hot_sequence_is_split_and_results_stay(spark):
    df = many_lengths(spark)
    one = H.prepare_sequences(df.coalesce(1), ["u"], ["t"], ["x"])
    cut = H.prepare_sequences(df, ["u"], ["t"], ["x"], 400)
    chunks = cut.where("u = 0").select(H.CHUNK_COL).distinct().count()
    assert chunks >= 4 and cut.groupBy(H.CHUNK_COL).count().agg(F.max("count")).first()[0] <= 400
    pdf = df.orderBy("u", "t").toPandas()
    for seqs in (one, cut):
        probs = H.filtered_probabilities(seqs, P, ["u"], ["t"]).orderBy("u", "t").toPandas()
        states = H.viterbi(seqs, P, ["u"], ["t"]).orderBy("u", "t").toPandas()
        ll = {r.u: r.log_likelihood for r in H.sequence_loglik(seqs, P, ["u"]).collect()}
        for u in (0, 1, 57, 119):
            x = pdf[pdf.u == u].x.tolist()
            ref, total = dense_forward(x, P)
            assert np.allclose(probs[probs.u == u][["p_0", "p_1"]].to_numpy(), ref, atol=1e-9)
            assert math.isclose(ll[u], total, rel_tol=1e-9)
            assert states[states.u == u].state.tolist() == dense_viterbi(x, P)


def dense_viterbi(x, p):
    E = H._emission_log(np.array(x)[:, None], p.means, p.vars)
    d, back = np.log(p.pi) + E[0], []
    for t in range(1, len(x)):
        cand = d[:, None] + np.log(p.A)
        back.append(cand.argmax(axis=0))
        d = cand.max(axis=0) + E[t]
    out = [int(d.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def dense_stats(x, p):
    """s0, s1, s2, xi, pi of one sequence by plain forward-backward."""
    E = np.exp(H._emission_log(np.array(x)[:, None], p.means, p.vars))
    n, k = E.shape
    a, b = np.zeros((n, k)), np.ones((n, k))
    a[0] = p.pi * E[0]
    a[0] /= a[0].sum()
    for t in range(1, n):
        a[t] = a[t - 1] @ p.A * E[t]
        a[t] /= a[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = p.A @ (E[t + 1] * b[t + 1])
        b[t] /= b[t].sum()
    g = a * b
    g /= g.sum(axis=1, keepdims=True)
    xi = np.zeros((k, k))
    for t in range(1, n):
        x_t = a[t - 1][:, None] * p.A * (E[t] * b[t])[None]
        xi += x_t / x_t.sum()
    x = np.array(x)
    return np.concatenate([g.sum(0), (g * x[:, None]).sum(0), (g * x[:, None] ** 2).sum(0), xi.ravel(), g[0]])


def test_em_statistics_match_dense(spark):
    df = many_lengths(spark)
    pdf = df.orderBy("u", "t").toPandas()
    want = sum(dense_stats(pdf[pdf.u == u].x.tolist(), P) for u in range(120))
    for chunk in (37, 400, 100_000):
        got = H.expected_stats(H.prepare_sequences(df, ["u"], ["t"], ["x"], chunk), P, ["u"]).first()["stats"]
        assert np.allclose(got[:-1], want, rtol=1e-8)


def test_em_moves_no_rows(spark):
    """No exchange between the chunked table and the passes of a step."""
    seqs = H.prepare_sequences(many_lengths(spark), ["u"], ["t"], ["x"], 400)
    keys = H.cut_lineage_partitioned(H.chunk_keys(seqs, []))
    plan = H.expected_stats(seqs, P, ["u"], keys)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "Scan ExistingRDD" in line and "u#" in line and H.AT_COL in line]
    assert len(scans) == 2 and plan.count("FlatMapCoGroupsInArrow") == 2
    for i in scans:     # up to the cogroup that reads it there is a projection at most
        assert "FlatMapCoGroupsInArrow" in lines[i - 1] + lines[i - 2] and "Exchange" not in lines[i - 1]


def test_a_fit_reads_a_row_per_chunk_at_each_step(spark, monkeypatch):
    """One long sequence over many chunks and many short ones, two models."""
    model = F.when(F.col("u") % 2 == 0, "a")
    seqs = H.prepare_sequences(many_lengths(spark).withColumn("m", model), ["m", "u"], ["t"], ["x"], 400)
    chunks, read, real = seqs.select(H.CHUNK_COL).distinct().count(), [], H.expected_stats

    def spy(table, models, seq_cols, keys=None):
        read.append(table.count())
        plan = real(table, models, seq_cols, keys)._jdf.queryExecution().executedPlan().toString().splitlines()
        at = [i for i, line in enumerate(plan) if "Scan ExistingRDD" in line and H.PACKED_COLS[0] in line]
        assert len(at) == 2 and not any("Exchange" in line for i in at for line in plan[i - 2:i])
        mine, rows = ({r.m: r.stats for r in real(t, models, seq_cols).collect()} for t in (table, seqs))
        assert set(mine) == set(rows) == {"a", None}
        assert all(np.allclose(mine[m], rows[m], rtol=1e-9) for m in mine)
        return real(table, models, seq_cols, keys)
    monkeypatch.setattr(H, "expected_stats", spy)
    H.fit_models(seqs, ["m"], ["m", "u"], ["x"], k=2, max_iter=2, tol=0.0)
    assert chunks >= 5 and read == [chunks, chunks]


def test_only_sequences_of_several_segments_need_transfers():
    sizes = [3, 700, 1, 40, 256, 257]
    starts = np.cumsum([0, *sizes[:-1]])
    c = object.__new__(H._Chunk)
    c.starts, c.runs, c.ends, c.k, c.scale = starts, np.zeros(1, np.int64), np.array([sum(sizes)]), 2, [(None, None)]
    c.A, c.pi, c.means, c.var = P.A[None], P.pi[None], P.means[None], P.vars[None]
    c.X = np.arange(float(sum(sizes)))[:, None] % 5
    chain = H._Chain(c, 0, sum(sizes), True)
    assert sorted(chain.at[chain.order[chain.linked(False)]]) == [3, 259, 515, 1000, 1256]
    assert len(chain.linked(True)) == chain.S == 9 and chain.widths[0] == 9 and chain.widths.sum() == chain.n
    assert np.array_equal(chain.flat(chain.row), np.arange(chain.n))


def test_loglik_and_metrics(spark):
    df = seq_df(spark)
    seqs = H.prepare_sequences(df, ["u"], ["t"], ["x"], 30)
    m = H.model_metrics(seqs, P, ["u"], ["t"], ["x"]).first()
    pdf = df.orderBy("u", "t").toPandas()
    ref = sum(dense_forward(pdf[pdf.u == u].x.tolist(), P)[1] for u in range(3))
    assert math.isclose(m.log_likelihood, ref, rel_tol=1e-9)
    assert m.n_samples == 360 and math.isclose(m.aic, -2 * ref + 2 * P.n_params())
    assert math.isclose(m.bic, -2 * ref + math.log(360) * P.n_params())


def test_em_loglik_non_decreasing(spark):
    df = seq_df(spark, n=80)
    params, hist = H.fit(df, ["u"], ["t"], ["x"], k=2, max_iter=6, tol=0.0)
    assert len(hist) == 6 and params.converged is False
    done, more = H.fit(df, ["u"], ["t"], ["x"], k=2, max_iter=60, tol=1e-3)
    assert done.converged is True and len(more) < 60
    assert all(b >= a - 1e-6 for a, b in zip(hist, hist[1:]))
    assert np.allclose(params.A.sum(axis=1), 1.0) and math.isclose(params.pi.sum(), 1.0)
    assert H.HMMParams.from_json(params.to_json()).k == 2


def test_stationary_and_tables(spark):
    A = np.array([[0.7, 0.3], [0.4, 0.6]])
    assert np.allclose(H.stationary(A), [4 / 7, 3 / 7])
    df = spark.createDataFrame([("m", [[0.7, 0.3], [0.4, 0.6]])], "model string, trans array<array<double>>")
    pi = df.select(H.stationary_column(F.col("trans"), 2).alias("pi")).first().pi
    assert np.allclose(pi, [4 / 7, 3 / 7], atol=1e-9)
    rows = H.transition_rows(df, "model", "trans", 2).collect()
    assert len(rows) == 4 and {r.from_regime for r in rows} == {"Expansion", "Contraction"}


def test_fit_by_model_equals_separate_fits(spark):
    key = F.when(F.col("u") == 0, "a").when(F.col("u") == 1, F.lit(None)).otherwise("b")
    df = seq_df(spark, n=60, users=4).withColumn("m", key)
    found = H.fit_by_model(df, ["m"], ["m", "u"], ["t"], ["x"], k=2, max_iter=5, chunk_rows=50)
    rows = {r["m"]: r for r in found.df.collect()}
    assert set(rows) == {"a", "b", None}
    for m, r in rows.items():
        alone, hist = H.fit(df.where(F.col("m").eqNullSafe(F.lit(m))), ["u"], ["t"], ["x"], k=2, max_iter=5)
        assert np.allclose(r["history"], hist[:r["iterations"]], rtol=1e-9)
        for col, want in (("pi", alone.pi), ("trans", alone.A), ("means", alone.means), ("vars", alone.vars),
                          ("scale_mean", alone.scaler_mean), ("scale_std", alone.scaler_std)):
            assert np.allclose(r[col], want.ravel(), rtol=1e-6, atol=1e-9), (m, col)
    seqs = H.prepare_sequences(df, ["m", "u"], ["t"], ["x"])
    assert H.viterbi(seqs, found, ["m", "u"], ["t"]).count() == 240


def test_many_models_at_once(spark):
    df = spark.range(6000).select((F.col("id") % 1000).alias("m"), F.floor(F.col("id") / 1000).alias("t"),
                                  F.pmod(F.col("id") * 7919, F.lit(101)).cast("double").alias("x"))
    found = H.fit_by_model(df, ["m"], ["m"], ["t"], ["x"], k=2, max_iter=2)
    assert found.df.count() == 1000
    assert found.df.where(F.size("history") > 0).count() == 1000


# ------------------------------------------------------------- keys and gaps
def test_null_and_large_keys_come_back_exact(spark):
    big = 2 ** 53
    rows = [(k, t, float((t * 7 + i) % 5)) for i, k in enumerate((big, big + 1, None)) for t in range(6)]
    df = spark.createDataFrame(rows, "seq long, t int, x double").coalesce(1)
    seqs = H.prepare_sequences(df, ["seq"], ["t"], ["x"])
    out = H.viterbi(seqs, P, ["seq"], ["t"], ["x"]).collect()
    assert sorted((r.seq or 0, r.t) for r in out) == sorted((k or 0, t) for k, t, _ in rows)
    one = {k: [r.state for r in sorted(out, key=lambda r: r.t) if r.seq == k] for k in (big, big + 1, None)}
    for k in one:
        alone = spark.createDataFrame([(1, t, x) for kk, t, x in rows if kk == k], "seq long, t int, x double")
        want = H.viterbi(H.prepare_sequences(alone, ["seq"], ["t"], ["x"]), P, ["seq"], ["t"], ["x"]).orderBy("t").collect()
        assert one[k] == [r.state for r in want]


def test_a_gap_in_a_feature_is_an_error(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, None)], "seq string, t int, x double")
    with pytest.raises(Exception, match="has a gap"):
        H.prepare_sequences(df, ["seq"], ["t"], ["x"]).collect()


def test_an_unknown_model_key_is_an_error(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 2.0)], "m string, t int, x double")
    known = H.initial_models(df.where("m = 'a'"), 1, ["x"], ["m"])
    with pytest.raises(Exception, match="no model for"):
        H.viterbi(H.prepare_sequences(df, ["m"], ["t"], ["x"]), known, ["m"], ["t"]).collect()
