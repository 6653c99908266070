"""Solver tests and the Spark model jobs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dosecast.operators import models as md
from dosecast.operators import newton
from dosecast.params import Params


def _lad_start(X, y):
    # iteratively reweighted L1 start for the comparison
    A = np.hstack([X, np.ones((len(y), 1))])
    b = np.linalg.lstsq(A, y, rcond=None)[0]
    for _ in range(100):
        w = 1 / np.maximum(np.abs(y - A @ b), 1e-6)
        b = np.linalg.lstsq(A * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
    return b


def test_noise_free_recovery():
    rng = np.random.default_rng(0)
    X = rng.random((30, 5))
    w = np.array([1.0, -2.0, 0.5, 3.0, 0.0])
    coef, b0, *_ = md.huber_fit(X, X @ w + 4)
    assert np.allclose(coef, w, atol=1e-6) and abs(b0 - 4) < 1e-6


def test_gross_outlier_ignored():
    rng = np.random.default_rng(1)
    X = rng.random((40, 5))
    w = np.array([2.0, 1.0, -1.0, 0.5, 1.5])
    y = X @ w + 1
    y[5] += 500
    coef, b0, *_ = md.huber_fit(X, y)
    assert np.allclose(coef, w, atol=1e-4)


def test_objective_not_above_starts():
    rng = np.random.default_rng(2)
    X = rng.random((25, 5))
    y = np.floor(rng.random(25) * 20)
    p = Params()
    coef, b0, sigma, _, obj, converged = md.huber_fit(X, y, p.huber_epsilon, p.huber_alpha)
    A = np.hstack([X, np.ones((25, 1))])
    assert converged
    for beta in (np.linalg.lstsq(A, y, rcond=None)[0], _lad_start(X, y)):
        for s in np.geomspace(1e-9, 50, 400):
            assert obj <= md.huber_objective(A, y, beta, s, p.huber_epsilon, p.huber_alpha, 5) + 1e-9


def test_tiny_group_is_deterministic():
    X = np.array([[0.0, 1, 0, 1, 0], [1, 0, 1, 0, 1], [0.5, 0.5, 0.5, 0.5, 0.5]])
    y = np.array([1.0, 2.0, 3.0])
    a = md.huber_fit(X, y)
    b = md.huber_fit(X, y)
    assert np.allclose(a[0], b[0]) and a[1] == b[1]


def _random_group(rng):
    n = int(rng.choice([2, 3, 6, 9, 15, 40, 120, 400]))
    X = rng.random((n, 5))
    kind = rng.integers(0, 4)
    if kind == 1:
        X[:, 2], X[:, 3] = 0, rng.integers(0, 2, n)          # a constant and a flag
    if kind == 2:
        X = np.round(X * 4) / 4                              # ties
    y = np.floor(rng.exponential(4, n)) if rng.random() < 0.7 else X @ rng.normal(0, 2, 5) + rng.normal(0, 1, n)
    return X, y


def _gap(A, y, s, eps, alpha):
    """The duality gap of a solved state, by its definition."""
    k = A.shape[1] - 1
    beta, sigma = s.model()
    own = md.huber_objective(A, y, beta, sigma, eps, alpha, k)
    v = np.clip(2 * (y - A @ s.x[:-1]) / s.x[-1], -2 * eps, 2 * eps)
    reach, xv, S = np.ptp(y) + 1, v @ A[:, :k], np.sum(1 - v * v / 4)
    dual = (v @ y + SIGMA * max(S, 0) + reach * min(S, 0) - xv @ xv / (4 * alpha) - s.x[k] * v.sum() - reach * abs(v.sum()))
    return own, own - dual


SIGMA = md.SIGMA_FLOOR


@pytest.mark.parametrize("eps", [1.01, 1.35])
def test_gap_and_agreement_over_partitions(eps):
    """Random groups with ties, flags and constants: closed gap, and the same model however the rows are dealt."""
    rng = np.random.default_rng(6)
    for _ in range(60):
        X, y = _random_group(rng)
        A = np.hstack([X, np.ones((len(y), 1))])
        one = newton.solve([(A, y)], eps, 1e-4)
        own, gap = _gap(A, y, one, eps, 1e-4)
        assert one.converged and one.steps < 400 and -1e-8 <= gap / (1 + own) <= 1e-5
        parts = [(A[c], y[c]) for c in np.array_split(rng.permutation(len(y)), min(len(y), 50))]
        many = newton.solve(parts, eps, 1e-4)
        assert np.allclose(one.model()[0], many.model()[0], atol=1e-8) and abs(one.model()[1] - many.model()[1]) < 1e-8


@pytest.mark.parametrize("n", [1, 2, 6, 9, 12, 40, 300])
def test_many_groups_at_once_take_the_steps_of_each(n):
    """The state of every group to the last bit: random ones, ties, flags, constants, a flat target, and steps that run out."""
    rng = np.random.default_rng(n)
    b = max(3, 600 // n)
    A, y = np.ones((b, n, 6)), np.floor(rng.exponential(4, (b, n)))
    A[:, :, :5] = rng.random((b, n, 5))
    A[1::5, :, 2], A[1::5, :, 3] = 0, rng.integers(0, 2, A[1::5, :, 3].shape)
    A[2::5, :, :5] = np.round(A[2::5, :, :5] * 4) / 4
    y[0::5] = A[0::5] @ np.array([1.0, 2.0, 0.0, -1.0, 0.5, 3.0])
    y[4::5] = 3.0
    for most in (20_000, 7):
        many = newton.solve_many(A, y, 1.01, 1e-4, most)
        for a, v, got in zip(A, y, many):
            s = newton.solve([(a, v)], 1.01, 1e-4, most)
            assert got.tolist() == s.values()
            coef, scale = newton.models(got[None])
            assert coef[0].tolist() == s.model()[0].tolist() and scale[0] == s.model()[1]


def test_groups_of_many_sizes_are_fitted_like_each_alone(spark, monkeypatch):
    """More rows than a task holds at once; keys side by side with the same and with other numbers of rows."""
    monkeypatch.setattr(md, "OF_A_SIZE", 40)
    monkeypatch.setattr(md, "OF_ALL", 100)
    df = _noisy_frame(spark, {f"g{i:03d}": 2 + i % 11 for i in range(90)}).coalesce(1)
    got = {r.model_key: r for r in md.fit_huber(df).collect()}
    assert len(got) == 90
    cols = [f"{f}_norm" for f in Params().features]
    for key, g in df.toPandas().groupby("model_key"):
        g = g.sort_values([*cols, "y"])
        coef, intercept, scale, steps, _, converged = md.huber_fit(g[cols].to_numpy(), g.y.to_numpy())
        r = got[key]
        assert (r.n_rows, r.converged) == (len(g), converged) and np.allclose(r.coef, coef, atol=1e-8) and abs(r.intercept - intercept) < 1e-8


def test_state_survives_its_row():
    rng = np.random.default_rng(2)
    X, y = rng.random((50, 5)), np.floor(rng.exponential(4, 50))
    A = np.hstack([X, np.ones((50, 1))])
    s = newton.State(6, 9.0)
    for _ in range(7):
        s.advance(s.sums(A, y, 1.01), 1.01, 1e-4, 100)
    t = newton.State.of(s.values())
    assert t.values() == s.values() and len(s.sums(A, y, 1.01)) == len(t.sums(A, y, 1.01))


def test_steps_run_out():
    X = np.random.default_rng(3).random((50, 5))
    *_, steps, _, converged = md.huber_fit(X, X[:, 0] * 9, max_iter=2)
    assert steps == 2 and not converged


def _train_frame(spark, n_big=60):
    rng = np.random.default_rng(4)
    rows = []
    w = np.array([1.0, 2.0, 0.0, -1.0, 0.5])
    for k, n in (("a", 8), ("b", n_big)):
        X = rng.random((n, 5))
        y = X @ w + 3
        for i in range(n):
            rows.append((k, *X[i].tolist(), float(y[i])))
    cols = [f"{f}_norm" for f in Params().features]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["model_key", *cols, "y"]))


def test_spark_huber_and_ridge(spark):
    df = _train_frame(spark)
    h = {r.model_key: r for r in md.fit_huber(df).collect()}
    assert np.allclose(h["b"].coef, [1.0, 2.0, 0.0, -1.0, 0.5], atol=1e-5)
    r = {r.model_key: r for r in md.fit_ridge(df).collect()}
    pdf = df.toPandas()
    sub = pdf[pdf.model_key == "b"]
    w, b0 = md.ridge_fit(sub.iloc[:, 1:6].to_numpy(), sub.y.to_numpy(), 0.1)
    assert np.allclose(r["b"].coef, w, atol=1e-8) and abs(r["b"].intercept - b0) < 1e-8
    assert abs(r["b"].r2 - md.r2_score(sub.y, sub.iloc[:, 1:6].to_numpy() @ w + b0)) < 1e-9


def test_ridge_stays_in_the_jvm(spark):
    plan = md.fit_ridge(_train_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ridge_on_hard_groups(spark):
    """Constant features, one row, constant target, strong collinearity: as numpy solves them."""
    rng = np.random.default_rng(5)
    groups = {"constant": (np.zeros((9, 5)), rng.random(9)), "single": (rng.random((1, 5)), np.array([4.0])),
              "flat": (rng.random((7, 5)), np.full(7, 3.0)), "collinear": (np.repeat(rng.random((30, 1)), 5, axis=1), rng.random(30))}
    cols = [f"{f}_norm" for f in Params().features]
    df = spark.createDataFrame(pd.concat([pd.DataFrame(X, columns=cols).assign(model_key=k, y=y) for k, (X, y) in groups.items()]))
    got = {r.model_key: r for r in md.fit_ridge(df).collect()}
    for k, (X, y) in groups.items():
        w, b0 = md.ridge_fit(X, y, 0.1)
        assert np.allclose(got[k].coef, w, atol=1e-9) and abs(got[k].intercept - b0) < 1e-9
        assert abs(got[k].r2 - md.r2_score(y, X @ w + b0)) < 1e-9


def _noisy_frame(spark, sizes):
    rng = np.random.default_rng(7)
    frames = []
    for k, n in sizes.items():
        X = rng.random((n, 5))
        y = np.floor(np.abs(X @ np.array([1.0, 2.0, 0.0, -1.0, 0.5]) * 4 + rng.normal(0, 2, n)))
        frames.append(pd.DataFrame(X, columns=[f"{f}_norm" for f in Params().features]).assign(model_key=k, y=y))
    return spark.createDataFrame(pd.concat(frames))


def test_one_chunk_and_many_give_the_same_models(spark):
    """At the default epsilon: each model from one task, and from rounds over 1 to 50 chunks."""
    df = _noisy_frame(spark, {"small": 20, "middle": 260, "large": 1000})
    one = {r.model_key: r for r in md.fit_huber(df).collect()}
    many = {r.model_key: r for r in md.fit_huber(df.repartition(9), Params(rows_per_chunk=20)).collect()}
    assert set(one) == set(many) == {"small", "middle", "large"}
    for k, a in one.items():
        b = many[k]
        assert a.converged and b.converged and a.n_rows == b.n_rows
        assert np.allclose(a.coef, b.coef, atol=1e-8) and abs(a.intercept - b.intercept) < 1e-8 and abs(a.scale - b.scale) < 1e-8
        assert abs(a.objective - b.objective) <= 1e-9 * a.objective
    for p, m in ((Params(), one), (Params(rows_per_chunk=20), many)):
        models = spark.createDataFrame(list(m.values()))
        for r in md.certificate(df, models, p).collect():
            assert -1e-8 <= r.gap / (1 + r.objective) <= 1e-5 and abs(r.objective - m[r.model_key].objective) <= 1e-9 * r.objective


def test_certificate_tells_a_worse_model(spark):
    df = _noisy_frame(spark, {"a": 200, "b": 12})
    models = md.fit_huber(df)
    worse = models.withColumn("intercept", F.col("intercept") + 0.05)
    good = {r.model_key: r for r in md.certificate(df, models).collect()}
    bad = {r.model_key: r for r in md.certificate(df, worse).collect()}
    for k in good:
        assert bad[k].gap > 1e-3 > 100 * good[k].gap
        assert abs((bad[k].objective - good[k].objective) - (bad[k].gap - good[k].gap)) < 1e-9


def test_a_model_that_does_not_converge_stops_no_other(spark):
    df = _noisy_frame(spark, {"a": 200, "b": 12})
    for chunk in (1000, 30):
        p = Params(huber_max_iter=5, rows_per_chunk=chunk)
        m = md.fit_huber(df, p)
        assert {r.model_key: r.converged for r in m.collect()} == {"a": False, "b": False}
        assert md.score(df, m, p).count() == 0


def test_model_selector_falls_back_to_huber(spark):
    df = _train_frame(spark)
    ridge = {r.model_key: r.scale for r in md.fit_models(df, model="Ridge").collect()}
    other = {r.model_key: r.scale for r in md.fit_models(df, model="MARS").collect()}
    assert all(v is None or v != v for v in ridge.values())     # ridge has no scale
    assert all(v is not None and v == v for v in other.values())  # unknown names run Huber


def test_fit_does_not_depend_on_row_order(spark):
    rng = np.random.default_rng(9)
    X = rng.random((40, 5))
    y = np.floor(rng.random(40) * 15)
    cols = [f"{f}_norm" for f in Params().features]
    pdf = pd.DataFrame(X, columns=cols).assign(model_key="k", y=y)
    a = md.fit_huber(spark.createDataFrame(pdf)).first()
    b = md.fit_huber(spark.createDataFrame(pdf.iloc[::-1].reset_index(drop=True))).first()
    assert a.coef == b.coef and a.intercept == b.intercept
