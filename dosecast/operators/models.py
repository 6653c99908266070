"""Many small regressions over a grouped table (M4-M8).

Models are rows of a *model table* ``(model_key, intercept, coef, scale,
n_rows, r2, ...)``; fitting, scoring and R-squared are joins and group-bys
on ``model_key``, one pass for all models.

* Ridge (M5) needs per-model sums of products only: a partial aggregation
  (skew-proof, map-side combine), then an LDL^T factorization unrolled into
  column expressions; no row leaves the JVM.
* Huber (M4) minimises sum(sigma + H_eps(r/sigma) * sigma) + alpha*|w|^2 with
  a joint scale, for groups of any size by one method: ``newton``.
* ``certificate`` bounds how far each Huber model is from the optimum.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dosecast.operators import newton
from dosecast.params import DEFAULT, Params
from dosecast.session import large, materialize

MODEL_SCHEMA = ("model_key string, intercept double, coef array<double>, scale double, n_rows long, "
                "r2 double, n_iter int, objective double")

SIGMA_FLOOR = newton.SIGMA_FLOOR


# ------------------------------------------------------------ on arrays

def huber_objective(A, y, beta, sigma, eps, alpha, k, sw=None):
    sw = np.ones(len(y)) if sw is None else sw
    r = np.abs(y - A @ beta)
    inl = r <= eps * sigma
    rho = np.where(inl, r * r / sigma, 2 * eps * r - eps * eps * sigma)
    return float(np.sum(sw * (sigma + rho)) + alpha * np.sum(beta[:k] ** 2))


def huber_fit(X, y, eps=1.01, alpha=1e-4, max_iter=20_000):
    """(coef, intercept, scale, steps, objective, converged) of one group's arrays."""
    X = np.asarray(X, dtype=float)
    y = np.asarray(y, dtype=float)
    A = np.hstack([X, np.ones((len(y), 1))])
    s = newton.solve([(A, y)], eps, alpha, max_iter)
    beta, sigma = s.model()
    k = X.shape[1]
    return beta[:k], float(beta[k]), sigma, s.steps, huber_objective(A, y, beta, sigma, eps, alpha, k), s.converged


def ridge_fit(X, y, alpha=0.1):
    """Ridge with an unpenalised intercept (centred normal equations)."""
    X = np.asarray(X, dtype=float)
    y = np.asarray(y, dtype=float)
    xm, ym = X.mean(axis=0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)
    return w, float(ym - xm @ w)


def r2_score(y, pred) -> float:
    y, pred = np.asarray(y, float), np.asarray(pred, float)
    ss_res = float(np.sum((y - pred) ** 2))
    ss_tot = float(np.sum((y - y.mean()) ** 2))
    if ss_tot == 0:
        return 1.0 if ss_res == 0 else 0.0
    return 1.0 - ss_res / ss_tot


# ------------------------------------------------------------ Spark jobs

def _norm_cols(p: Params) -> list[str]:
    return [f"{f}_norm" for f in p.features]


_POINT = pa.schema([("model_key", pa.string()), ("n_rows", pa.int64()), ("block", pa.binary()), ("state", pa.list_(pa.float64()))])
_POINT_SQL = "model_key string, n_rows long, block binary, state array<double>"


def _blocks(batches, width: int):
    """(model_key, rows of the model, array) of each run of rows that agree in key and chunk."""
    key, n, held = None, 0, []
    for b in batches:
        if not b.num_rows:
            continue
        keys, chunk = b.column(0), b.column(1).to_numpy()
        values = np.column_stack([b.column(3 + i).to_numpy(zero_copy_only=False) for i in range(width)])
        other = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(other | (chunk[1:] != chunk[:-1])) + 1).tolist(), len(keys)]
        for at, to in zip(starts, starts[1:]):
            k = keys[at].as_py(), chunk[at]
            if k != key:
                if held:
                    yield key[0], n, np.concatenate(held)
                key, held, n = k, [], b.column(2)[at].as_py()
            held.append(values[at:to])
    if held:
        yield key[0], n, np.concatenate(held)


def _design(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[X, 1] and y."""
    return np.hstack([block[:, :-1], np.ones((len(block), 1))]), block[:, -1]


def _states(values: np.ndarray) -> pa.Array:
    """Rows of numbers as lists."""
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), values.ravel())


def _solved(waiting: list[tuple[str, np.ndarray]], eps: float, alpha: float, most: int) -> pa.RecordBatch:
    """The states of groups with the same number of rows."""
    x = np.stack([block for _, block in waiting])
    values = newton.solve_many(np.concatenate([x[:, :, :-1], np.ones((*x.shape[:2], 1))], axis=2), x[:, :, -1], eps, alpha, most)
    return pa.RecordBatch.from_arrays([pa.array([key for key, _ in waiting]), pa.array(np.full(len(x), x.shape[1])),
                                       pa.nulls(len(x), pa.binary()), _states(values)], schema=_POINT)


# Rows that a task holds before it solves the groups with some number of rows, or all of them.
OF_A_SIZE, OF_ALL = 50_000, 400_000


def fit_huber(train: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M4: one Huber model per ``model_key``, in ``MODEL_SCHEMA`` and converged, cert (the certificate's point).

    Every model is found by the same steps (``newton``) from sums over its rows.
    A group's rows are dealt into chunks of about ``p.rows_per_chunk``.  Where a
    group is one chunk, its task takes all steps; the others' chunks are a
    written table, and each round one job adds up their sums and takes a step for
    all models that are not done.  A model that does not converge is returned
    with ``converged`` false.
    """
    cols = _norm_cols(p)
    eps, alpha, most = p.huber_epsilon, p.huber_alpha, p.huber_max_iter
    rows = train.select("model_key", *[F.col(c).cast("double").alias(c) for c in cols], F.col("y").cast("double").alias("y"))
    sizes = rows.groupBy("model_key").agg(F.count(F.lit(1)).alias("_n"))
    chunks = F.ceil(F.col("_n") / p.rows_per_chunk)
    dealt = rows.join(sizes, "model_key").select(
        "model_key", F.pmod(F.xxhash64(*cols, "y"), chunks).cast("int").alias("_chunk"), "_n", *cols, "y")

    def fit(batches):
        waiting: dict[int, list] = {}          # groups by their number of rows, which are solved together
        held = 0
        for key, n, block in _blocks(batches, len(cols) + 1):
            if n > p.rows_per_chunk:
                yield pa.RecordBatch.from_pylist([{"model_key": key, "n_rows": n, "block": block.tobytes(), "state": None}], schema=_POINT)
                continue
            same = waiting.setdefault(len(block), [])
            same.append((key, block))
            held += len(block)
            full = waiting if held > OF_ALL else {len(block)} if len(same) * len(block) > OF_A_SIZE else ()
            for size in [*full]:
                held -= size * len(waiting[size])
                yield _solved(waiting.pop(size), eps, alpha, most)
        for same in waiting.values():
            yield _solved(same, eps, alpha, most)

    # Fits are CPU-bound and the grouped input is small for its work: a set number of partitions, so that AQE does
    # not coalesce every group into one task.  Rows are sorted, so a fit is a function of the group's rows only.
    spark = rows.sparkSession
    par = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartition(par, "model_key", "_chunk").sortWithinPartitions("model_key", "_chunk", *cols, "y")
    found = materialize(dealt.mapInArrow(fit, _POINT_SQL), "huber_groups")
    blocks = found.where(F.col("block").isNotNull())
    states = found.where(F.col("block").isNull()).select("model_key", "n_rows", "state")
    if not blocks.isEmpty():
        states = states.unionByName(_rounds(blocks.select("model_key", "n_rows", "block"), len(cols) + 1, p))
    return _model_table(rows, states, p)


def _rounds(blocks: DataFrame, k: int, p: Params) -> DataFrame:
    """(model_key, n_rows, state) of the models of ``blocks``: a step of all open models each round."""
    eps, alpha, most = p.huber_epsilon, p.huber_alpha, p.huber_max_iter
    sums = pa.schema([("model_key", pa.string()), ("sums", pa.list_(pa.float64()))])
    state = "model_key string, n_rows long, state array<double>, open boolean"

    def begin(batches):
        for b in batches:
            x = b.to_pydict()
            yield pa.RecordBatch.from_pylist(
                [{"model_key": m, "n_rows": n, "state": newton.State(k, y).values(), "open": True} for m, n, y in zip(x["model_key"], x["n_rows"], x["most"])],
                schema=pa.schema([("model_key", pa.string()), ("n_rows", pa.int64()), ("state", pa.list_(pa.float64())), ("open", pa.bool_())]))

    def largest(batches):
        for b in batches:
            x = b.to_pydict()
            yield pa.RecordBatch.from_pylist(
                [{"model_key": m, "n_rows": n, "most": float(np.abs(np.frombuffer(v).reshape(-1, k)[:, -1]).max())}
                 for m, n, v in zip(x["model_key"], x["n_rows"], x["block"])],
                schema=pa.schema([("model_key", pa.string()), ("n_rows", pa.int64()), ("most", pa.float64())]))

    def partial(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pydict()
                key = row["model_key"][0]
                A, y = _design(np.frombuffer(row["block"][0]).reshape(-1, k))
                v = newton.State.of(row["state"][0]).sums(A, y, eps)
                total[key] = total[key] + v if key in total else v
        yield pa.RecordBatch.from_pylist([{"model_key": m, "sums": v.tolist()} for m, v in total.items()], schema=sums)

    def step(batches):
        for b in batches:
            x, out = b.to_pydict(), []
            for m, n, values, total in zip(x["model_key"], x["n_rows"], x["state"], x["total"]):
                s = newton.State.of(values)
                s.advance(np.array([t["v"] for t in total]), eps, alpha, most)
                out.append({"model_key": m, "n_rows": n, "state": s.values(), "open": not s.done})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("model_key", pa.string()), ("n_rows", pa.int64()), ("state", pa.list_(pa.float64())), ("open", pa.bool_())]))

    start = blocks.mapInArrow(largest, "model_key string, n_rows long, most double").groupBy("model_key").agg(
        F.max("n_rows").alias("n_rows"), F.max("most").alias("most"))
    now = materialize(start.mapInArrow(begin, state), "huber_states")
    done = []
    while True:
        to_do = now.where("open").select("model_key", "state")
        parts = blocks.join(to_do, "model_key").select("model_key", "block", "state").mapInArrow(partial, "model_key string, sums array<double>")
        total = (parts.select("model_key", F.posexplode("sums").alias("at", "v")).groupBy("model_key", "at").agg(F.sum("v").alias("v"))
                 .groupBy("model_key").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("total")))
        done.append(now.where("not open").drop("open"))
        seen = Observation("huber_open")
        stepped = now.where("open").drop("open").join(total, "model_key").mapInArrow(step, state)
        now = materialize(stepped, "huber_states", (seen, F.sum(F.col("open").cast("long")).alias("open")))
        if not seen.get["open"]:
            break
    out = now.drop("open")
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _dot(coef: str, intercept: str, cols: list[str]) -> Column:
    e = F.col(intercept)
    for i, c in enumerate(cols):
        e = e + F.col(coef)[i] * F.col(c)
    return e


def _rho(r: Column, scale: Column, eps: float) -> Column:
    a = F.abs(r)
    return scale + F.when(a <= eps * scale, a * a / scale).otherwise(2 * eps * a - eps * eps * scale)


def _model_table(rows: DataFrame, states: DataFrame, p: Params) -> DataFrame:
    """States as models, with their objective and R-squared over the rows (one aggregation)."""
    cols = _norm_cols(p)
    k = len(cols)
    names = "model_key string, n_rows long, coef array<double>, intercept double, scale double, n_iter int, converged boolean, cert array<double>"

    def read(batches):
        for b in batches:
            if not b.num_rows:
                continue
            values = b.column(2).flatten().to_numpy().reshape(b.num_rows, -1)
            beta, sigma = newton.models(values)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), _states(np.ascontiguousarray(beta[:, :k])), pa.array(np.ascontiguousarray(beta[:, k])), pa.array(sigma),
                 pa.array(values[:, 4].astype(np.int32)), pa.array(values[:, 5] == newton._CONVERGED),
                 _states(np.ascontiguousarray(values[:, 7:9 + k]))],
                names=["model_key", "n_rows", "coef", "intercept", "scale", "n_iter", "converged", "cert"])

    m = materialize(states.mapInArrow(read, names), "huber_points")
    j = rows.join(large(m.select("model_key", "coef", "intercept", "scale")), "model_key")
    r = F.col("y") - _dot("coef", "intercept", cols)
    fit = j.groupBy("model_key").agg(
        F.sum(_rho(r, F.col("scale"), p.huber_epsilon)).alias("_loss"), F.sum(r * r).alias("_ssr"), F.avg("y").alias("_mean"),
        F.var_pop("y").alias("_var"), F.count(F.lit(1)).alias("_n"))
    squares = F.aggregate("coef", F.lit(0.0), lambda a, w: a + w * w)
    total = F.col("_var") * F.col("_n")
    return m.join(large(fit), "model_key").select(
        "model_key", "intercept", "coef", "scale", "n_rows",
        F.when(total <= 1e-12, F.when(F.col("_ssr") <= 1e-9, 1.0).otherwise(0.0)).otherwise(1 - F.col("_ssr") / total).alias("r2"),
        "n_iter", (F.col("_loss") + p.huber_alpha * squares).alias("objective"), "converged", "cert")


def certificate(train: DataFrame, models: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """How far each Huber model can be from the optimum: model_key, n_rows, objective, gap, grad_coef, grad_intercept,
    grad_scale.

    With v = clip(2 r / sigma, -2 eps, 2 eps) at the point ``cert``, duality bounds the objective of
    every model from below.  Compared with the objective at ``cert`` the bound is lower by
    |X'v - 2 alpha w|^2 / (4 alpha), by what the scale's condition S = sum(1 - v^2 / 4) leaves, and by
    ``reach`` |sum v| for intercepts within ``reach`` (the range of y plus 1) of the point's and scales up
    to it.  ``gap`` is the model's objective less the bound, computed anew from the rows."""
    cols = _norm_cols(p)
    k, eps, alpha = len(cols), p.huber_epsilon, p.huber_alpha
    m = large(models.select("model_key", "coef", "intercept", "scale", "cert"))
    j = train.join(m, "model_key").select("*", F.col("cert")[k].alias("_b"), F.col("cert")[k + 1].alias("_s"))
    at = F.col("y") - _dot("cert", "_b", cols)
    v = F.greatest(F.least(2 * at / F.col("_s"), F.lit(2 * eps)), F.lit(-2 * eps))
    j = j.withColumns({"_v": v, "_at": _rho(at, F.col("_s"), eps),
                       "_own": _rho(F.col("y") - _dot("coef", "intercept", cols), F.col("scale"), eps)})
    g = j.groupBy("model_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_at").alias("_at"), F.sum("_own").alias("_own"), F.sum("_v").alias("_vs"),
        F.sum(1 - F.col("_v") * F.col("_v") / 4).alias("_S"), (F.max("y") - F.min("y") + 1).alias("reach"),
        *[F.sum(F.col("_v") * F.col(c)).alias(f"_g{i}") for i, c in enumerate(cols)]).join(m, "model_key")
    squares = lambda name: F.aggregate(F.slice(name, 1, k), F.lit(0.0), lambda a, w: a + w * w)
    grads = [F.col(f"_g{i}") - 2 * alpha * F.col("cert")[i] for i in range(k)]
    s = F.col("cert")[k + 1]
    below = (sum((x * x for x in grads), F.lit(0.0)) / (4 * alpha) + F.greatest(F.col("_S"), F.lit(0.0)) * (s - SIGMA_FLOOR)
             + F.greatest(-F.col("_S"), F.lit(0.0)) * F.greatest(F.col("reach") - s, F.lit(0.0)) + F.col("reach") * F.abs("_vs"))
    own, here = F.col("_own") + alpha * squares("coef"), F.col("_at") + alpha * squares("cert")
    return g.select("model_key", "n_rows", own.alias("objective"), (own - here + below).alias("gap"),
                    F.greatest(*[F.abs(x) for x in grads]).alias("grad_coef"), F.abs("_vs").alias("grad_intercept"),
                    F.col("_S").alias("grad_scale"))


def _suff_stats(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Per model sums of products, as one partial aggregation."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy")]
    k = len(cols)
    for i in range(k):
        aggs.append(F.sum(cols[i]).alias(f"sx{i}"))
        aggs.append(F.sum(F.col(cols[i]) * F.col("y")).alias(f"sxy{i}"))
        for j in range(i, k):
            aggs.append(F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"sxx{i}_{j}"))
    return rows.groupBy("model_key").agg(*aggs)


def ldl_steps(k: int, matrix, rhs, fraction=lambda a, b: f"({a}) / ({b})") -> list[dict[str, str]]:
    """Solving a symmetric positive definite k x k system M w = c by LDL^T, as SQL expressions in steps: each step's
    names may be used by the later ones.  ``matrix(i, j)`` (i >= j) and ``rhs(i)`` name the inputs; the result is w0 ..."""
    steps = []
    for j in range(k):
        less = "".join(f" - l{j}_{t} * l{j}_{t} * d{t}" for t in range(j))
        steps.append({f"d{j}": f"{matrix(j, j)}{less}"})
        below = {}
        for i in range(j + 1, k):
            less = "".join(f" - l{i}_{t} * l{j}_{t} * d{t}" for t in range(j))
            below[f"l{i}_{j}"] = fraction(f"{matrix(i, j)}{less}", f"d{j}")
        if below:
            steps.append(below)
    for i in range(k):                                      # L z = c
        steps.append({f"z{i}": rhs(i) + "".join(f" - l{i}_{t} * z{t}" for t in range(i))})
    for i in reversed(range(k)):                            # L' w = z / d
        steps.append({f"w{i}": fraction(f"z{i}", f"d{i}") + "".join(f" - l{t}_{i} * w{t}" for t in range(i + 1, k))})
    return steps


def fit_ridge(train: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M5: ridge per model with an unpenalised intercept, from sums of products: the centred normal equations are
    solved by LDL^T in column expressions."""
    cols = _norm_cols(p)
    k = len(cols)
    x = _suff_stats(train, cols)
    centred = {f"m{i}_{j}": F.col(f"sxx{j}_{i}") - F.col(f"sx{i}") * F.col(f"sx{j}") / F.col("n") + (p.ridge_alpha if i == j else 0.0)
               for i in range(k) for j in range(i + 1)}
    x = x.withColumns(centred | {f"c{i}": F.col(f"sxy{i}") - F.col(f"sx{i}") * F.col("sy") / F.col("n") for i in range(k)})
    for step in ldl_steps(k, lambda i, j: f"m{i}_{j}", lambda i: f"c{i}"):
        x = x.withColumns({name: F.expr(e) for name, e in step.items()})
    b0 = (F.col("sy") - sum((F.col(f"w{i}") * F.col(f"sx{i}") for i in range(k)), F.lit(0.0))) / F.col("n")
    # With M = centred products + alpha I and M w = c:  w'Mw = w'c, so the residual sum is  SStot - w'c - alpha w'w.
    wc = sum((F.col(f"w{i}") * F.col(f"c{i}") for i in range(k)), F.lit(0.0))
    ww = sum((F.col(f"w{i}") * F.col(f"w{i}") for i in range(k)), F.lit(0.0))
    total = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    residual = total - wc - p.ridge_alpha * ww
    r2 = F.when(F.abs(total) < 1e-9, F.when(F.abs(residual) < 1e-9, 1.0).otherwise(0.0)).otherwise(1 - residual / total)
    return x.select("model_key", b0.alias("intercept"), F.array(*[F.col(f"w{i}") for i in range(k)]).alias("coef"),
                    F.lit(None).cast("double").alias("scale"), F.col("n").alias("n_rows"), r2.alias("r2"), F.lit(1).alias("n_iter"),
                    F.lit(None).cast("double").alias("objective"), F.lit(True).alias("converged"),
                    F.lit(None).cast("array<double>").alias("cert"))


def fit_models(train: DataFrame, p: Params = DEFAULT, model: str = "LR") -> DataFrame:
    """M8: model selector; ``'Ridge'`` -> ridge, anything else -> Huber."""
    return fit_ridge(train, p) if model == "Ridge" else fit_huber(train, p)


def predict_expr(p: Params = DEFAULT):
    e = F.col("intercept")
    for i, c in enumerate(_norm_cols(p)):
        e = e + F.col("coef")[i] * F.col(c)
    return e


def score(rows: DataFrame, models: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M6 + J11: rows scored by the model of their pair (a join, then a dot product).  A model that has not
    converged gives no estimate: its pairs are left to the all-pair rule."""
    m = large(models.where("converged").select("model_key", "intercept", "coef"))
    return rows.join(m, "model_key").withColumn("y_predict", predict_expr(p)).drop("intercept", "coef")


def model_r2(scored: DataFrame, pred: str = "y_predict") -> DataFrame:
    """M7: R-squared per model from predictions, 1 - SSres/SStot (constant y: 1 or 0)."""
    g = scored.groupBy("model_key").agg(
        F.sum((F.col("y") - F.col(pred)) ** 2).alias("ss_res"),
        F.sum(F.col("y")).alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.count(F.lit(1)).alias("n"))
    ss_tot = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return g.select("model_key", "n",
                    F.when(F.abs(ss_tot) <= 1e-9, F.when(F.col("ss_res") <= 1e-9, 1.0).otherwise(0.0))
                     .otherwise(1 - F.col("ss_res") / ss_tot).alias("r2"))
