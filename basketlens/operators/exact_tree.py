"""Decision tree with exact split search (J6, J8) as DataFrame operations.

Level by level, every row of an open node contributes (node, feature, value); class
counts collapse per distinct value, a keyed prefix sum gives the classes at or below
each value, and ``max_by`` on the Gini gain picks each node's best split. No feature is
binned: every boundary between distinct values is a candidate. A node's rows are spread
over range partitions, so the root (all rows) is not one task's work. A split must leave
``min_leaf`` of all rows on both sides, which bounds the number of nodes by a
constant whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import prefix_sums

# Share of all rows that a leaf holds at least.
MIN_LEAF = 0.01
MAX_DEPTH = 8


def _long(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(node, feature, value) with class counts per distinct value."""
    cells = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f).cast("double").alias("value"))
                      for i, f in enumerate(features)])
    return (rows.select("node", "label", F.inline(cells))
            .groupBy("node", "feature", "value")
            .agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")))


def _purity(a, b):
    """(a^2 + b^2) / (a + b): rows times (1 - Gini)."""
    a, b = a.cast("double"), b.cast("double")
    return (a * a + b * b) / (a + b)


def best_splits(rows: DataFrame, features: Sequence[str], min_rows: int,
                num_partitions: int | None = None) -> DataFrame:
    """(node, feature, low, gain) of each node's best split "value <= low".

    ``rows``: node, label (0 or 1) and the features, none NULL. The gain is the fall of the rows-weighted
    Gini impurity; ties go to the earlier feature, then the smaller value. Nodes without an
    allowed split that gains do not appear.
    """
    counts = _long(rows, features)
    cum = prefix_sums(counts, ["node", "feature"], [F.col("value")], ["n0", "n1"], num_partitions, few_keys=True)
    total = rows.groupBy("node").agg(F.count_if(F.col("label") == 0).alias("t0"), F.count_if(F.col("label") == 1).alias("t1"))
    left = F.col("cum_n0") + F.col("cum_n1")
    right = F.col("t0") + F.col("t1") - left
    split = cum.join(total, "node").filter((left >= min_rows) & (right >= min_rows) & (right > 0))
    gain = (_purity(F.col("cum_n0"), F.col("cum_n1")) + _purity(F.col("t0") - F.col("cum_n0"), F.col("t1") - F.col("cum_n1"))
            - _purity(F.col("t0"), F.col("t1")))
    best = (split.withColumn("gain", gain).groupBy("node")
            .agg(F.max_by(F.struct("feature", F.col("value").alias("low"), "gain"),
                          F.struct("gain", -F.col("feature"), -F.col("value"))).alias("b")))
    return best.select("node", "b.*").filter(F.col("gain") > 1e-9)


def fit_exact_tree(df: DataFrame, features: Sequence[str], label: str = "label", max_depth: int = MAX_DEPTH,
                   min_leaf: float = MIN_LEAF, num_partitions: int | None = None) -> DataFrame:
    """Node table of the tree: (node, depth, n, n0, n1, prediction, probability, feature, threshold, gain).

    The root is node 1, the children of node k are 2k (value <= threshold) and 2k + 1; leaves have no
    feature. The threshold lies halfway between the two neighbouring values of the node. ``prediction`` is the
    larger class (0 on a tie), ``probability`` the share of class 1. Rows with a NULL label or feature
    take no part; an empty table gives no nodes.
    """
    feats = list(features)
    if not feats:
        raise ValueError("no variables to model")
    rows = df.select(F.col(label).cast("double").alias("label"), *[F.col(f).cast("double").alias(f) for f in feats]).dropna()
    rows = cut_lineage(rows.withColumn("node", F.lit(1).cast("bigint")))
    min_rows = max(1, math.ceil(min_leaf * rows.count()))
    names = F.array(*[F.lit(f) for f in feats])
    levels, splits = [], None
    for depth in range(max_depth + 1):
        size = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 0).alias("n0"),
                                        F.count_if(F.col("label") == 1).alias("n1"))
        if depth == max_depth:
            levels.append(size.withColumn("depth", F.lit(depth)).withColumns({
                "feature": F.lit(None).cast("string"), "threshold": F.lit(None).cast("double"), "gain": F.lit(None).cast("double")}))
            break
        best = best_splits(rows, feats, min_rows, num_partitions)
        value = F.element_at(F.array(*[F.col(f) for f in feats]), F.col("feature") + 1)
        # at most 1 / min_leaf nodes a level: small by construction
        at = rows.join(F.broadcast(best), "node").withColumn("__v", value)
        above = at.groupBy("node").agg(F.min(F.when(F.col("__v") > F.col("low"), F.col("__v"))).alias("high"))
        splits = cut_lineage(best.join(above, "node").select("node", "feature", ((F.col("low") + F.col("high")) / 2).alias("threshold"), "gain"))
        levels.append(size.join(splits, "node", "left").withColumn("depth", F.lit(depth))
                      .withColumn("feature", F.when(F.col("feature").isNotNull(), F.element_at(names, F.col("feature") + 1))))
        if splits.isEmpty():
            break
        goes_right = (value > F.col("threshold")).cast("bigint")
        rows = rows.join(F.broadcast(splits), "node").select("label", *feats, (F.col("node") * 2 + goes_right).alias("node"))
        if depth % 4 == 3:
            rows = cut_lineage(rows)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return cut_lineage(out.select(
        "node", F.col("depth").cast("int").alias("depth"), F.col("n").cast("bigint").alias("n"), F.col("n0").cast("bigint").alias("n0"),
        F.col("n1").cast("bigint").alias("n1"), (F.col("n1") > F.col("n0")).cast("double").alias("prediction"),
        (F.col("n1").cast("double") / F.col("n")).alias("probability"), "feature", "threshold", "gain"))


def score_exact_tree(df: DataFrame, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``node`` (the leaf), ``prediction`` and ``score`` (share of class 1) to the rows of ``df``.

    Walks down one level per broadcast join with the node table (bounded by the leaf share). Rows with a
    NULL feature that a split asks for stay at that node.
    """
    feats = list(features)
    tree = nodes.select(F.col("node").alias("__n"), F.array_position(F.array(*[F.lit(f) for f in feats]), F.col("feature")).alias("__f"),
                        F.col("threshold").alias("__t"))
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    out = df.withColumn("node", F.lit(1).cast("bigint"))
    value = F.get(F.array(*[F.col(f).cast("double") for f in feats]), F.col("__f").cast("int") - 1)
    for _ in range(depth):
        out = out.join(F.broadcast(tree), out["node"] == F.col("__n"), "left")
        down = F.when(value <= F.col("__t"), F.col("node") * 2).when(value > F.col("__t"), F.col("node") * 2 + 1)
        out = out.withColumn("node", F.coalesce(down, F.col("node"))).drop("__n", "__f", "__t")
    leaf = nodes.select("node", "prediction", F.col("probability").alias("score"))
    return out.join(F.broadcast(leaf), "node", "left")


class ExactTree:
    """Estimator and model in one: ``fit`` builds the node table, ``transform`` adds prediction and score."""

    def __init__(self, features: Sequence[str], label: str = "label", max_depth: int = MAX_DEPTH, min_leaf: float = MIN_LEAF):
        self.features, self.label, self.max_depth, self.min_leaf = list(features), label, max_depth, min_leaf
        self.nodes: DataFrame | None = None

    def fit(self, df: DataFrame) -> ExactTree:
        self.nodes = fit_exact_tree(df, self.features, self.label, self.max_depth, self.min_leaf)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return score_exact_tree(df, self.nodes, self.features)
