"""Gaussian naive Bayes from sufficient statistics.

One aggregation per class gives row count, means and variances; a row's class
log-likelihoods are then plain Column math, so scoring needs no model object in
the tasks and stays in generated code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: share of the largest feature variance that is added to every variance.
VAR_SMOOTHING = 1e-9


@dataclass(frozen=True)
class GaussianNaiveBayes:
    """Per class (0, 1): rows, means and smoothed variances of ``features``."""

    features: tuple[str, ...]
    rows: tuple[int, int]
    means: tuple[tuple[float, ...], tuple[float, ...]]
    variances: tuple[tuple[float, ...], tuple[float, ...]]

    def log_joint(self, c: int):
        """Column log P(class) + log-density of the features under class ``c``."""
        terms = [F.lit(math.log(self.rows[c] / sum(self.rows)))]
        for f, m, v in zip(self.features, self.means[c], self.variances[c]):
            d = F.col(f) - F.lit(m)
            terms.append(F.lit(-0.5 * math.log(2.0 * math.pi * v)) - d * d / F.lit(2.0 * v))
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``score`` = P(class 1) and ``prediction``; rows with a NULL feature get NULL."""
        if not all(self.rows):  # one class only: it is certain
            score = F.lit(1.0 if self.rows[1] else 0.0)
        else:
            score = 1.0 / (1.0 + F.exp(self.log_joint(0) - self.log_joint(1)))
        return df.withColumn("score", score).withColumn("prediction", F.when(F.col("score").isNotNull(),
                                                                             (F.col("score") > 0.5).cast("double")))


def fit_naive_bayes(df: DataFrame, features: Sequence[str], label: str = "label",
                    smoothing: float = VAR_SMOOTHING) -> GaussianNaiveBayes:
    """Statistics of both classes in one aggregation (2 x features numbers reach the driver).

    NULL labels take no part; neither does a NULL feature in its own column's statistics.
    """
    feats = list(features)
    if not feats:
        raise ValueError("no variables to model")
    got = df.filter(F.col(label).isin(0.0, 1.0)).groupBy(F.col(label).cast("int").alias("c")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(feats)],
        *[F.var_pop(f).alias(f"v{i}") for i, f in enumerate(feats)]).collect()
    if not got:
        raise ValueError("no labelled rows")
    by = {r["c"]: r for r in got}
    n = sum(r["n"] for r in got)
    largest = 0.0
    for i in range(len(feats)):
        mean = sum(r["n"] * (r[f"m{i}"] or 0.0) for r in got) / n
        largest = max(largest, sum(r["n"] * ((r[f"v{i}"] or 0.0) + ((r[f"m{i}"] or 0.0) - mean) ** 2) for r in got) / n)
    extra = smoothing * largest or smoothing  # all features constant: any positive width
    empty = (0.0,) * len(feats)
    return GaussianNaiveBayes(
        tuple(feats), tuple(by[c]["n"] if c in by else 0 for c in (0, 1)),
        tuple(tuple(by[c][f"m{i}"] or 0.0 for i in range(len(feats))) if c in by else empty for c in (0, 1)),
        tuple(tuple((by[c][f"v{i}"] or 0.0) + extra for i in range(len(feats))) if c in by else (extra,) * len(feats) for c in (0, 1)))
