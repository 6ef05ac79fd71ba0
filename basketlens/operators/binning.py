"""Outlier-aware quartile binning (F1), model binning with open ends (F2), fitted edges.

Fitting runs a couple of small distributed aggregations (via
``operators.quantiles``) and returns the edges as plain floats; applying
them is a single projection with literal CASE branches, so the labelled
table is never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite_or_null
from .quantiles import column_quantiles

# Quartile labels, lowest first, and the label of values
# outside the edges (outliers and NULLs).
QUARTILE_LABELS = ("Very Low", "Low", "High", "Very High")
UNKNOWN = "Unknown"
# Suffixes of the model-binning labels, lowest first.
MODEL_BIN_SUFFIXES = ("low", "medium", "high", "very_high")


def iqr_bounds(q1: float | None, q3: float | None, k: float = 1.5):
    if q1 is None or q3 is None:
        return None, None
    iqr = q3 - q1
    return q1 - k * iqr, q3 + k * iqr


def fit_quartile_edges(df: DataFrame, columns: Sequence[str], **qkw) -> dict[str, list[float]]:
    """Edges per column: quartiles of the IQR inliers, duplicates dropped.

    A column that is all NULL, has fewer than two distinct values, or keeps
    no inliers gets no edges (every row is then labelled Unknown).
    """
    clean = df.select(*[finite_or_null(c).alias(c) for c in columns])
    first = column_quantiles(clean, columns, [0.25, 0.75], **qkw)
    bounds = {}
    for c in columns:
        s = first[c]
        if s["n"] == 0 or s["min"] == s["max"]:
            continue
        bounds[c] = iqr_bounds(*s["q"])
    if not bounds:
        return {c: [] for c in columns}
    inl = clean.select(*[F.when(F.col(c).between(lo, hi), F.col(c)).alias(c) for c, (lo, hi) in bounds.items()])
    second = column_quantiles(inl, list(bounds), [0.25, 0.5, 0.75], **qkw)
    edges = {}
    for c in columns:
        s = second.get(c)
        if c not in bounds or s is None or s["n"] == 0:
            edges[c] = []
            continue
        edges[c] = sorted(set([s["min"], *s["q"], s["max"]]))
    return edges


def quartile_label(col, edges: Sequence[float], labels=QUARTILE_LABELS) -> Column:
    """First interval closed [e0, e1], later ones (e_i-1, e_i]; else Unknown."""
    c = F.col(col) if isinstance(col, str) else col
    if len(edges) < 2:
        return F.lit(UNKNOWN)
    expr = F.when((c >= edges[0]) & (c <= edges[1]), F.lit(labels[0]))
    for i in range(2, len(edges)):
        expr = expr.when((c > edges[i - 1]) & (c <= edges[i]), F.lit(labels[i - 1]))
    return expr.otherwise(F.lit(UNKNOWN))


def bin_levels(edges: Sequence[float]) -> list[str]:
    """Levels a bin column can take, in order: one label per interval, then Unknown."""
    return list(QUARTILE_LABELS[:max(len(edges) - 1, 0)]) + [UNKNOWN]


def levels_of(df: DataFrame, col: str):
    """Level list carried in a column's metadata (set by ``apply_quartile_bins``), or None."""
    return df.schema[col].metadata.get("levels") if col in df.columns else None


def apply_quartile_bins(df: DataFrame, mapping: Mapping[str, str], edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Add ``out_col`` labels for every ``out_col -> source`` pair using fitted edges.

    Each label column carries its ordered level list in the column metadata
    (like a categorical dtype): empty levels and level codes stay exact when
    duplicate edges drop labels.
    """
    return df.withColumns({out: quartile_label(src, edges.get(src, [])).alias(
        out, metadata={"levels": bin_levels(edges.get(src, []))}) for out, src in mapping.items()})


def quartile_bins(df: DataFrame, mapping: Mapping[str, str], **qkw) -> DataFrame:
    """Fit and apply in one call."""
    edges = fit_quartile_edges(df, list(dict.fromkeys(mapping.values())), **qkw)
    return apply_quartile_bins(df, mapping, edges)


# ---------------------------------------------------------------------------
# model binning (-inf, q1], (q1, med], (med, q3], (q3, inf) of the inliers.
# ---------------------------------------------------------------------------

def fit_model_edges(df: DataFrame, columns: Sequence[str], **qkw) -> dict[str, list[float] | None]:
    """Inner edges [q1, median, q3] of each column's IQR inliers; None when not strictly increasing."""
    first = column_quantiles(df, columns, [0.25, 0.75], **qkw)
    bounds = {c: iqr_bounds(*first[c]["q"]) for c in columns if first[c]["n"] > 0}
    out: dict[str, list[float] | None] = {c: None for c in columns}
    if not bounds:
        return out
    inl = df.select(*[F.when(F.col(c).between(lo, hi), F.col(c)).alias(c) for c, (lo, hi) in bounds.items()])
    second = column_quantiles(inl, list(bounds), [0.25, 0.5, 0.75], **qkw)
    for c in bounds:
        q = second[c]["q"]
        if None in q or not (q[0] < q[1] < q[2]):
            continue  # duplicate edges: the column is left as it is
        out[c] = q
    return out


def model_bin_code(col, inner_edges: Sequence[float], encoding: str = "lexical") -> Column:
    """Integer code of the quartile bin.

    ``lexical`` sorts the label names (high=0, low=1, medium=2, very_high=3);
    ``ordinal`` numbers bins from the lowest (0..3). NULL gets the last code.
    """
    c = F.col(col) if isinstance(col, str) else col
    q1, q2, q3 = inner_edges
    ordinal = (F.when(c <= q1, 0).when(c <= q2, 1).when(c <= q3, 2).when(c.isNotNull(), 3))
    if encoding == "ordinal":
        return F.coalesce(ordinal, F.lit(4))
    names = list(MODEL_BIN_SUFFIXES)
    order = sorted(names)
    code_of = {i: order.index(n) for i, n in enumerate(names)}
    expr = F.when(ordinal == 0, code_of[0])
    for i in (1, 2, 3):
        expr = expr.when(ordinal == i, code_of[i])
    return F.coalesce(expr, F.lit(len(names)))


def bin_numerical_variables(df: DataFrame, response: str = "response", columns: Sequence[str] | None = None,
                            encoding: str = "lexical", **qkw) -> DataFrame:
    """Replace each numeric column (not the response) by its model-bin code."""
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if f.dataType.typeName() in ("double", "long", "integer") and f.name != response]
    edges = fit_model_edges(df, columns, **qkw)
    return df.withColumns({c: model_bin_code(c, e, encoding).cast("bigint") for c, e in edges.items() if e})


# ---------------------------------------------------------------------------
# Recode a numeric column to levels by quantile edges, or to a boolean.
# ---------------------------------------------------------------------------

# Default level names, lowest first.
RECODE_LEVELS = ("low", "medium", "high")


def fit_recode_edges(df: DataFrame, column: str, probs: Sequence[float] = (1 / 3, 2 / 3), **qkw) -> list[float]:
    """Quantile edges for ``recode_levels`` (exact, distributed)."""
    return column_quantiles(df, [column], list(probs), **qkw)[column]["q"]


def recode_levels(col, edges: Sequence[float], labels: Sequence[str] = RECODE_LEVELS) -> Column:
    """x <= e1 -> labels[0], e1 < x <= e2 -> labels[1], ..., above the last edge -> last label; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    if not edges or edges[0] is None:
        return F.lit(None).cast("string")
    expr = F.when(c <= edges[0], F.lit(labels[0]))
    for i in range(1, len(edges)):
        expr = expr.when(c <= edges[i], F.lit(labels[i]))
    return expr.when(c.isNotNull(), F.lit(labels[len(edges)]))


def recode_boolean(col, threshold: float) -> Column:
    """x > threshold (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return c > F.lit(threshold)
