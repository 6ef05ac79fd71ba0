"""Statistics: QQ points (H1), VIF elimination from one Gram pass (H2), logit significance (H3, H4)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite_or_null, neg_log10, norm_ppf, safe_corr, safe_slope
from .eda import without_outliers
from .ordering import value_ranks
from .quantiles import long_values


# ---------------------------------------------------------------------------
# H1: normal probability plot
# ---------------------------------------------------------------------------

def filliben_median(rank, n):
    """Filliben's order-statistic medians of U(0,1): ends 1-0.5^(1/n) and 0.5^(1/n)."""
    r, n = F.col(rank) if isinstance(rank, str) else rank, F.col(n) if isinstance(n, str) else n
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    return (F.when(r == n, last).when(r == 1, F.lit(1.0) - last)
            .otherwise((r - 0.3175) / (n + 0.365)))


def qq_points(data: DataFrame, variables: Sequence[str], num_partitions: int | None = None,
              outliers_included: bool = True) -> DataFrame:
    """(variable, rank, n, value, theoretical): sorted sample vs normal quantiles per variable (H1).

    Ranks are global per variable but computed without a single-task window
    (see ``operators.ordering``). With ``outliers_included=False`` each variable's values outside its
    own 1.5 IQR bounds are left out first.
    """
    if not outliers_included:
        data = without_outliers(data, variables)
    long = long_values(data, variables).withColumnRenamed("__qk", "variable").withColumnRenamed("__qv", "value")
    ranked = value_ranks(long, "variable", "value", num_partitions, few_keys=True)
    return ranked.select("variable", F.col("rank").cast("bigint").alias("rank"), F.col("n").cast("bigint").alias("n"),
                         "value", norm_ppf(filliben_median("rank", "n")).alias("theoretical"))


def grid_ranks(n: int, points: int) -> list[int]:
    """``points`` ranks spread evenly over 1..n (all ranks when n <= points), ends included."""
    if n <= points:
        return list(range(1, n + 1))
    return sorted({1 + (j * (n - 1)) // (points - 1) for j in range(points)})


def qq_grid(data: DataFrame, variables: Sequence[str], points: int = 512) -> DataFrame:
    """QQ points at a fixed grid of ranks per variable (H1 option for plotting at scale).

    Same columns as ``qq_points`` but at most ``points`` rows per variable:
    exact order statistics at evenly spaced ranks, found by distributed
    histogram narrowing; the output size does not grow with the data.
    """
    from .quantiles import rank_values
    long = long_values(data, variables)
    got = rank_values(long, lambda n: grid_ranks(n, points))
    rows = [(k, r, n, v) for k, (n, rv) in got.items() for r, v in rv]
    pts = data.sparkSession.createDataFrame(rows, "variable string, rank long, n long, value double")
    return pts.withColumn("theoretical", norm_ppf(filliben_median("rank", "n")))


def qq_fit(points: DataFrame) -> DataFrame:
    """Least-squares line of sample on theoretical quantiles and its r, per variable (H1)."""
    return (points.groupBy("variable").agg(
        safe_slope("value", "theoretical").alias("slope"),
        F.avg("value").alias("__my"), F.avg("theoretical").alias("__mx"),
        safe_corr("value", "theoretical").alias("r"),
        F.count(F.lit(1)).cast("bigint").alias("n"))
        .select("variable", "slope", (F.col("__my") - F.col("slope") * F.col("__mx")).alias("intercept"), "r", "n"))


# ---------------------------------------------------------------------------
# H2: Gram matrix and VIF elimination
# ---------------------------------------------------------------------------

def gram(df: DataFrame, columns: Sequence[str], constant: bool = True):
    """XᵀX (optionally with a leading constant column) from ONE aggregation of k(k+1)/2 sums.

    Non-finite and NULL cells count as 0, as the reference's VIF step does.
    Returns (names, G as numpy array, n rows).
    """
    cols = list(columns)
    # inf/NaN/NULL -> 0 once, then k(k+1)/2 products written as SQL text (one JVM call each)
    clean = df.select(*[F.coalesce(finite_or_null(c), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(cols)])
    names = (["const"] if constant else []) + cols
    exprs = (["1.0"] if constant else []) + [f"x{i}" for i in range(len(cols))]
    k = len(exprs)
    aggs = ["count(1) AS n"] + [f"sum({exprs[i]} * {exprs[j]}) AS g_{i}_{j}" for i in range(k) for j in range(i, k)]
    row = clean.agg(*[F.expr(a) for a in aggs]).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            v = row[f"g_{i}_{j}"] or 0.0
            g[i, j] = g[j, i] = v
    return names, g, row["n"]


def gram_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Uncentred Gram matrix in long form (var_x, var_y, value), one aggregation."""
    cols = list(columns)
    xs = {c: F.coalesce(finite_or_null(c), F.lit(0.0)) for c in cols}
    aggs = [F.sum(xs[a] * xs[b]).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"),
                        F.col(f"{min(i, j)}_{max(i, j)}").alias("value"))
               for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return wide.select(F.inline(F.array(*structs)))


def vif_from_gram(g: np.ndarray) -> np.ndarray:
    """Uncentred VIF_i = (G⁻¹)_ii · G_ii; singular columns get inf."""
    k = g.shape[0]
    if k == 1:
        return np.ones(1)
    d = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
    c = g / np.outer(d, d)  # scale for conditioning; VIF is scale-free
    try:
        inv = np.linalg.inv(c)
        out = np.diag(inv) * np.diag(c)
        if not np.all(np.isfinite(out)) or np.linalg.cond(c) > 1e15:
            raise np.linalg.LinAlgError
        return out
    except np.linalg.LinAlgError:
        out = np.empty(k)
        for i in range(k):
            rest = [j for j in range(k) if j != i]
            sub = c[np.ix_(rest, rest)]
            b = c[rest, i]
            coef, *_ = np.linalg.lstsq(sub, b, rcond=None)
            ssr = c[i, i] - b @ coef
            out[i] = np.inf if ssr <= 1e-12 * c[i, i] else c[i, i] / ssr
        return out


def vif_elimination(df: DataFrame, columns: Sequence[str], threshold: float = 5.0, gram_result=None):
    """Drop the highest-VIF column while any VIF > threshold.

    One distributed pass builds G (or pass ``gram_result`` from ``gram(df,
    columns, constant=True)`` to share it); every iteration works on a
    submatrix of G on the driver (k x k only). Returns (kept columns, final VIF
    DataFrame, removal-log DataFrame).
    """
    spark = df.sparkSession
    names, g, _ = gram_result if gram_result is not None else gram(df, columns, constant=True)
    base = 1 if names and names[0] == "const" else 0
    keep = list(range(base, len(names)))
    log = []
    step = 1
    while keep:
        v = vif_from_gram(g[np.ix_(keep, keep)])
        worst = int(np.argmax(v))
        if not v[worst] > threshold:
            break
        log.append((step, names[keep[worst]], float(v[worst])))
        del keep[worst]
        step += 1
    final = vif_from_gram(g[np.ix_(keep, keep)]) if keep else np.array([])
    vif_df = spark.createDataFrame(sorted([(names[i], float(x)) for i, x in zip(keep, final)], key=lambda r: -r[1]),
                                   "feature string, vif double")  # G3: highest VIF first
    log_df = spark.createDataFrame(log, "step int, removed string, vif double")
    return [names[i] for i in keep], vif_df, log_df


def dependent_columns(df: DataFrame, columns: Sequence[str], tol: float = 1e-9, gram_result=None) -> list[str]:
    """Columns that are (near) linear combinations of the constant and earlier columns.

    Greedy Gram-Schmidt on the scaled Gram of [1, X]: a column whose residual
    norm is tiny relative to its own norm is reported; earlier columns are kept.
    A shared ``gram_result`` (with constant) is restricted to ``columns``.
    """
    names, g, n = gram_result if gram_result is not None else gram(df, columns, constant=True)
    idx = [0] + [names.index(c) for c in columns]
    names, g = [names[i] for i in idx], g[np.ix_(idx, idx)]
    d = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
    c = g / np.outer(d, d)
    kept = [0]
    dropped = []
    for i in range(1, len(names)):
        sub = c[np.ix_(kept, kept)]
        b = c[kept, i]
        coef, *_ = np.linalg.lstsq(sub, b, rcond=None)
        resid = c[i, i] - b @ coef
        if resid <= tol:
            dropped.append(names[i])
        else:
            kept.append(i)
    return dropped


# ---------------------------------------------------------------------------
# H3/H4: logit significance
# ---------------------------------------------------------------------------

def logit_significance(df: DataFrame, features: Sequence[str], response: str = "response",
                       alpha: float = 0.05, max_iter: int = 100):
    """Binomial GLM with intercept; Wald p-values per feature (H3) and the coefficient table (H4).

    Returns (significant feature list, table DataFrame (feature, coef, se, z, p_value, neg_log10_p)).
    Raises on (quasi-)perfect separation, which would give p ≈ 1 silently.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    spark = df.sparkSession
    feats = list(features)
    va = VectorAssembler(inputCols=feats, outputCol="__x", handleInvalid="keep")
    data = va.transform(df.select(*[F.coalesce(finite_or_null(c), F.lit(0.0)).alias(c) for c in feats],
                                  F.col(response).cast("double").alias("__y")))
    glr = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="__x", labelCol="__y",
                                      maxIter=max_iter, fitIntercept=True)
    model = glr.fit(data)
    s = model.summary
    if s.nullDeviance > 0 and s.deviance < 1e-6 * s.nullDeviance:
        raise ValueError("perfect separation: the logit fit has (near) zero deviance")
    coefs = list(model.coefficients) + [model.intercept]
    se, t, p = s.coefficientStandardErrors, s.tValues, s.pValues
    names = feats + ["const"]
    rows = [(name, float(coefs[i]), float(se[i]), float(t[i]), float(p[i])) for i, name in enumerate(names)]
    table = (spark.createDataFrame(sorted(rows, key=lambda r: r[4]),  # G3: most significant first
                                   "feature string, coef double, se double, z double, p_value double")
             .withColumn("neg_log10_p", neg_log10("p_value")))  # B24
    significant = [r[0] for r in rows if r[0] != "const" and r[4] < alpha]
    return significant, table
