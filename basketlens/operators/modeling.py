"""Response models on MLlib.

The prepared table is customer-level; fitting uses MLlib estimators
(distributed), scoring is a ``transform`` per split, metrics come from
``operators.evaluation``. Only coefficients, scalars and metric rows reach
the driver.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import day_diff, finite_or_null
from ..session import cut_lineage, fit_partitions, shared_folder
from .binning import UNKNOWN
from .eda import BIN_LEVELS
from .evaluation import evaluate_by
from .exact_tree import ExactTree
from .naive_bayes import GaussianNaiveBayes, fit_naive_bayes
from .quality import median_fill, require_columns

# Categorical fields of the prepared table and their fill value.
CATEGORICAL_INT_FIELDS = ("loyalty", "nps")
BIN_FIELDS = ("recency_bin", "total_sales_bin", "total_quantity_bin", "avg_order_value_bin",
              "customer_tenure_bin", "order_frequency_bin")
# Model types of the reference's menu.
MODEL_TYPES = ("logistic_regression", "random_forest", "naive_bayes", "decision_tree", "svm",
               "decision_tree_binned", "decision_tree_binned_after")
# "svm" approximates the reference's RBF-kernel SVC with random Fourier features;
# "svm_linear" is the plain linear SVM (both calibrated by Platt's sigmoid on out-of-fold margins).
MODEL_NAMES = {
    "logistic_regression": "Logistic Regression", "random_forest": "Random Forest",
    "naive_bayes": "Naive Bayes", "decision_tree": "Decision Tree", "svm": "SVM", "svm_linear": "SVM (linear)",
    "decision_tree_binned": "Decision Tree (Binned First)",
    "decision_tree_binned_after": "Decision Tree (Binned After)", "decision_tree_exact": "Decision Tree (Exact Splits)",
}
TREE_MAX_DEPTH = 30  # Spark's limit; the reference grows trees without a depth limit
# Types whose fit is a long chain of cheap passes, and the fewest partitions these run on.
LINEAR_TYPES = ("logistic_regression", "svm", "svm_linear")
LINEAR_PARTITIONS = 4
# Share of the training rows that a leaf holds at least, so that a tree's size doesn't grow with the rows.
MIN_LEAF_SHARE = 0.005


def numeric_model_columns(df: DataFrame, response: str = "response", wide_only: bool = True) -> list[str]:
    """float64/int64-like columns (double, bigint, int) except the response; bin codes (tinyint) excluded
    when ``wide_only``, matching the reference's dtype selections (B19)."""
    kinds = (T.DoubleType, T.LongType, T.IntegerType) if wide_only else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name != response]


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population std from ONE aggregation; zero std scales by 1."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        if m is None:
            continue
        s = 1.0 if not s else s
        out[c] = (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
    return df.withColumns(out)


def preprocess_for_model(data: DataFrame, response: str = "response") -> DataFrame:
    """Model preparation (J1), idempotent.

    Day columns from the purchase dates (global last purchase as a scalar
    subquery), median fill and scaling of those, categorical fill and codes
    (bins by label order, as tinyint), every remaining NULL/inf numeric cell -> 0.
    """
    df = data
    if "first_purchase" in df.columns and "last_purchase" in df.columns:
        gmax = df.agg(F.max("last_purchase")).scalar()  # scalar subquery
        df = (df.withColumn("customer_tenure_days", day_diff("first_purchase", "last_purchase").cast("double"))
              .withColumn("recency_days", day_diff("last_purchase", gmax).cast("double"))
              .drop("first_purchase", "last_purchase"))
    days = [c for c in ("customer_tenure_days", "recency_days") if c in df.columns]
    if days:
        df = df.withColumns({c: finite_or_null(c) for c in days})
        # one pass: missing counts and the scaling statistics; the median fill
        # (two more jobs) only runs when a day column actually has NULLs
        row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(days)],
                     *[F.avg(c).alias(f"m{i}") for i, c in enumerate(days)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(days)]).first()
        if any(row[f"c{i}"] != row["n"] for i in range(len(days))):
            df = standard_scale(median_fill(df, days), days)
        else:
            df = df.withColumns({c: (F.col(c) - F.lit(row[f"m{i}"])) / F.lit(row[f"s{i}"] or 1.0)
                                 for i, c in enumerate(days) if row[f"m{i}"] is not None})
    codes = {}
    for c in CATEGORICAL_INT_FIELDS:
        if c in df.columns:
            codes[c] = F.coalesce(F.col(c).cast("int"), F.lit(0))
    for c in BIN_FIELDS:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            levels = df.schema[c].metadata.get("levels") or list(BIN_LEVELS)  # the column's own level order
            filled = F.coalesce(F.col(c), F.lit(UNKNOWN))
            codes[c] = F.coalesce(F.element_at(F.create_map(*[x for i, lv in enumerate(levels)
                                                              for x in (F.lit(lv), F.lit(i))]), filled),
                                  F.lit(levels.index(UNKNOWN) if UNKNOWN in levels else len(levels))).cast("tinyint")
    df = df.withColumns(codes) if codes else df
    fills = {f.name: F.coalesce(finite_or_null(f.name).cast(f.dataType), F.lit(0).cast(f.dataType))
             for f in df.schema.fields
             if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name != response}
    fills.update({f.name: F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)) for f in df.schema.fields
                  if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ByteType)) and f.name != response})
    return df.withColumns(fills)


def add_ratios(df: DataFrame) -> DataFrame:
    """recency_ratio and complaint_ratio = x / (num_orders + 1e-5), then scaled."""
    out = {}
    if "num_orders" in df.columns and "recency_days" in df.columns:
        den = F.col("num_orders").cast("double") + F.lit(1e-5)
        out["recency_ratio"] = F.col("recency_days") / den
        if "n_comp" in df.columns:
            out["complaint_ratio"] = F.col("n_comp").cast("double") / den
    if not out:
        return df
    return standard_scale(df.withColumns(out), list(out))


def in_train_split(key: str, train_ratio: float = 0.7, seed: int = 42):
    """Condition: the row is in the train split, by a hash of its key."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000)) < int(round(train_ratio * 10_000))


def train_test_split(df: DataFrame, train_ratio: float = 0.7, seed: int = 42, key: str = "CustomerID"):
    """Deterministic split by a hash of the key: stable under repartitioning and recomputation."""
    train = in_train_split(key, train_ratio, seed)
    return df.filter(train), df.filter(~train)


CALIBRATION_FOLDS = 5


def calibration_fold(key: str, folds: int = CALIBRATION_FOLDS, seed: int = 7):
    """Fold 0..folds-1 of a row by a hash of its key, independent of the train/test split's hash."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int")


class CalibratedSVM:
    """Linear SVM whose margins become probabilities by Platt scaling on out-of-fold margins.

    Rows fall into folds by a hash of their key. A model fitted on the other folds gives each row's margin, so
    no margin comes from a model that saw the row; the sigmoid is fitted on these margins with Platt's
    smoothed targets, and one last fit on all rows gives the margins that are calibrated. A fold whose
    complement has one class only gives no margins.
    """

    def __init__(self, features_col="features", label_col="label", reg_param: float = 0.0, key: str = "__key",
                 folds: int = CALIBRATION_FOLDS, parallelism: int = 5):
        # sklearn's SVC(C=1) minimises 1/2|w|^2 + C sum(hinge) = Spark's mean hinge + regParam/2 |w|^2
        # with regParam = 1 / (C n)
        # its stopping tolerance is 1e-3 (Spark's is 1e-6; every iteration is a job)
        self.svc = LinearSVC(featuresCol=features_col, labelCol=label_col, maxIter=100, tol=1e-3, regParam=reg_param,
                             rawPredictionCol="__raw", predictionCol="__svm_pred")
        self.label_col, self.key, self.folds, self.parallelism = label_col, key, folds, parallelism

    def out_of_fold_margins(self, df: DataFrame) -> DataFrame:
        """``df`` with ``__fold`` and ``__mv``, the margin by the model that didn't see the row's fold."""
        from concurrent.futures import ThreadPoolExecutor
        df = df.withColumn("__fold", calibration_fold(self.key, self.folds))
        classes = {r["__fold"]: r for r in df.groupBy("__fold").agg(
            F.count_if(F.col(self.label_col) == 1).alias("pos"), F.count_if(F.col(self.label_col) == 0).alias("neg")).collect()}

        def fit(k):
            rest = [r for f, r in classes.items() if f != k]
            if not (sum(r["pos"] for r in rest) and sum(r["neg"] for r in rest)):
                return None
            # the objective weighs one row by 1/n: keep C = 1 on the smaller training part
            n, all_n = sum(r["pos"] + r["neg"] for r in rest), sum(r["pos"] + r["neg"] for r in classes.values())
            svc = self.svc.copy({self.svc.regParam: self.svc.getRegParam() * all_n / n})
            return svc.fit(df.filter(F.col("__fold") != k))

        with ThreadPoolExecutor(max_workers=self.parallelism) as pool:
            models = dict(zip(sorted(classes), pool.map(fit, sorted(classes))))
        out = None
        for k, model in models.items():
            if model is not None:
                part = self._margin(model.transform(df.filter(F.col("__fold") == k)))
                out = part if out is None else out.unionByName(part)
        if out is None:
            raise ValueError("calibration needs both classes outside a fold")
        return out

    def fit(self, df):
        margins = self.out_of_fold_margins(df).select("__mv", F.col(self.label_col).alias("__y")).persist()
        n = margins.agg(F.count_if(F.col("__y") == 1).alias("pos"), F.count_if(F.col("__y") == 0).alias("neg")).first()
        high, low = (n["pos"] + 1.0) / (n["pos"] + 2.0), 1.0 / (n["neg"] + 2.0)
        target = F.when(F.col("__y") == 1, high).otherwise(low)
        both = F.array(F.struct(F.lit(1.0).alias("label"), target.alias("w")), F.struct(F.lit(0.0).alias("label"), (1.0 - target).alias("w")))
        soft = VectorAssembler(inputCols=["__mv"], outputCol="__m").transform(margins.select("__mv", F.inline(both)))
        self.platt = LogisticRegression(featuresCol="__m", labelCol="label", weightCol="w", maxIter=100).fit(soft)
        margins.unpersist()
        self.svm_model = self.svc.fit(df)
        return self

    @staticmethod
    def _margin(df):
        return df.withColumn("__mv", vector_to_array("__raw")[1]).drop("__raw", "__svm_pred")

    def transform(self, df):
        margin = self._margin(self.svm_model.transform(df))
        return self.platt.transform(VectorAssembler(inputCols=["__mv"], outputCol="__m").transform(margin))


RFF_COMPONENTS = 100


def rbf_features(train: DataFrame, features: Sequence[str], n_components: int = RFF_COMPONENTS,
                 gamma: float | None = None, seed: int = 42):
    """Random Fourier features approximating an RBF kernel (J7), as SQL-text Column math.

    ``gamma`` defaults to sklearn's 'scale': 1 / (k * Var(X)) over all cells of
    the training matrix, from one aggregation. z_j(x) = sqrt(2/D) cos(w_j.x + b_j)
    with w_j ~ N(0, 2 gamma I), b_j ~ U(0, 2 pi), seeded. Returns a function that
    adds the D columns to a frame, and their names.
    """
    import numpy as np
    k = len(features)
    if gamma is None:
        cells = " + ".join(f"`{f}`" for f in features)
        squares = " + ".join(f"`{f}` * `{f}`" for f in features)
        row = train.agg(F.expr(f"sum({cells})").alias("s1"), F.expr(f"sum({squares})").alias("s2"),
                        F.count(F.lit(1)).alias("n")).first()
        cnt = (row["n"] or 0) * k
        var = (row["s2"] / cnt - (row["s1"] / cnt) ** 2) if cnt else 0.0
        gamma = 1.0 / (k * var) if var and var > 0 else 1.0
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(n_components, k))
    b = rng.uniform(0.0, 2.0 * np.pi, size=n_components)
    scale = float(np.sqrt(2.0 / n_components))
    names = [f"__rff{j}" for j in range(n_components)]
    exprs = [F.expr(f"{scale!r} * cos({float(b[j])!r} + "
                    + " + ".join(f"{float(w[j, i])!r} * `{f}`" for i, f in enumerate(features)) + ")").alias(names[j])
             for j in range(n_components)]
    return (lambda df: df.select("*", *exprs)), names


def make_estimator(model_type: str, n_train: int, features_col: str = "features", label_col: str = "label",
                   features: Sequence[str] = (), key: str = "__key"):
    """Estimator matching the reference's model choice (J3-J7). MLlib's work on ``features_col``, the naive Bayes and
    exact tree on the columns ``features``."""
    min_rows = max(1, math.ceil(MIN_LEAF_SHARE * n_train))
    if model_type == "logistic_regression":
        # sklearn's default L2 with C=1 on a summed loss = regParam 1/n on Spark's mean loss;
        # its default stopping tolerance is 1e-4 (Spark's is 1e-6; every iteration is a job).
        return LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=1000, tol=1e-4,
                                  regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False)
    if model_type == "random_forest":
        # a row's node in each tree is kept between levels instead of being found from the root again; the
        # chain of levels is short enough to go without checkpoints
        return RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=100, seed=42,
                                      featureSubsetStrategy="sqrt", maxDepth=TREE_MAX_DEPTH, maxBins=64,
                                      minInstancesPerNode=min_rows, cacheNodeIds=True, checkpointInterval=-1)
    if model_type == "naive_bayes":
        return _NaiveBayes(features, label_col)
    if model_type in ("decision_tree", "decision_tree_binned", "decision_tree_binned_after"):
        return DecisionTreeClassifier(featuresCol=features_col, labelCol=label_col, seed=42,
                                      maxDepth=TREE_MAX_DEPTH, maxBins=64, minInstancesPerNode=min_rows)
    if model_type == "decision_tree_exact":
        return ExactTree(features, label_col)
    if model_type in ("svm", "svm_linear"):
        return CalibratedSVM(features_col, label_col, reg_param=1.0 / max(n_train, 1), key=key)
    raise ValueError(f"unknown model type {model_type!r}")


class _NaiveBayes:
    def __init__(self, features, label):
        self.features, self.label = list(features), label

    def fit(self, df):
        return fit_naive_bayes(df, self.features, self.label)


def score_frame(model, df: DataFrame, *keep: str) -> DataFrame:
    """(label, prediction, score) with score = P(class 1), and the columns ``keep``."""
    out = model.transform(df)
    score = F.col("score") if isinstance(model, (GaussianNaiveBayes, ExactTree)) else vector_to_array("probability")[1]
    return out.select(*keep, "label", F.col("prediction").cast("double").alias("prediction"), score.alias("score"))


def fit_and_score(data: DataFrame, features: Sequence[str], response: str, model_type: str, train_ratio: float = 0.7,
                  seed: int = 42, key: str = "CustomerID", params: dict | None = None):
    """Fit on the train split and score both (J13): ((split, label, prediction, score), model, training rows).

    The split is a hash of ``key``, which must be a column: a random split would change with the
    partitions and under recomputation (J2).
    """
    feats = list(features)
    if not feats:
        raise ValueError("no variables to model")
    require_columns(data, [*feats, response, key])  # the reference validates the variables first (A8)
    base = data.select(F.col(key).alias("__key"), *[F.col(f).cast("double").alias(f) for f in feats],
                       F.col(response).cast("double").alias("label"))
    base = base.withColumn("split", F.when(in_train_split("__key", train_ratio, seed), "train").otherwise("test"))
    inputs = feats
    if model_type == "svm":  # the reference's SVC uses an RBF kernel: approximate it (J7)
        add, inputs = rbf_features(base.filter("split = 'train'"), feats, seed=seed)
        base = add(base)
    base = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep").transform(base)
    train = base.filter("split = 'train'").drop("split", *(set(inputs) - set(feats)))
    n_train = train.count()
    # a step of a linear fit is one pass over a few numbers a row; a tree's is more work
    linear = model_type in LINEAR_TYPES
    train = fit_partitions(train, n_train, *([LINEAR_PARTITIONS] if linear else []))
    # every job carries the plan of its rows: that of the Fourier features is long, so it ends here
    train = (cut_lineage(train) if linear else train).cache()
    est = make_estimator(model_type, n_train, features=feats)
    if params:
        target = est.svc if isinstance(est, CalibratedSVM) else est
        if isinstance(est, ExactTree):
            for name, value in params.items():
                setattr(est, name, value)
        else:
            target.setParams(**params)
    model = est.fit(train)
    train.unpersist()
    return score_frame(model, base, "split"), model, n_train


def run_table(scores: DataFrame, runs: Sequence[tuple]) -> DataFrame:
    """Metric rows (J14) of many runs from one scored table and ONE keyed evaluation.

    ``scores``: configuration, model_type, split ('train' or 'test'), label, prediction, score. ``runs``: a tuple
    (configuration, model_type, variables, training rows) per run, a handful of names. An undefined metric
    (one class only) stays NULL. ``run_id`` is a hash of what the run is and found, not of when it ran.
    """
    spark = scores.sparkSession
    each = evaluate_by(scores, ["configuration", "model_type", "split"])

    def of(split, column):
        return F.max(F.when(F.col("split") == split, F.col(column)))

    pairs = [("train_accuracy", "train", "accuracy"), ("test_accuracy", "test", "accuracy"), ("train_auc", "train", "auc"),
             ("test_auc", "test", "auc"), ("train_balanced_accuracy", "train", "balanced_accuracy"),
             ("test_balanced_accuracy", "test", "balanced_accuracy"), ("test_sensitivity", "test", "sensitivity"),
             ("test_specificity", "test", "specificity"), ("test_precision", "test", "precision"), ("test_f1", "test", "f1"),
             ("best_threshold", "test", "best_threshold")]
    wide = each.groupBy("configuration", "model_type").agg(*[of(split, column).alias(name) for name, split, column in pairs])
    now = time.time()
    about = spark.createDataFrame([(c, MODEL_NAMES.get(m, m), m, ",".join(v), int(n), now) for c, m, v, n in runs],
                                  "configuration string, model string, model_type string, variables_used string, n_train long, run_ts double")
    table = F.broadcast(about).join(wide, ["configuration", "model_type"])
    content = F.concat_ws("|", "configuration", "model_type", "variables_used", "n_train",
                          *[F.coalesce(F.round(name, 9).cast("string"), F.lit("-")) for name, _, _ in pairs])
    return (table.select("configuration", "model", "model_type", *[name for name, _, _ in pairs], "variables_used", "n_train", "run_ts",
                         F.sha2(content, 256).alias("run_id"))
            .withColumns({"overfitting_accuracy_gap": F.col("train_accuracy") - F.col("test_accuracy"),
                          "overfitting_auc_gap": F.col("train_auc") - F.col("test_auc"),
                          "overfitting_balanced_accuracy_gap": F.col("train_balanced_accuracy") - F.col("test_balanced_accuracy")})
            .withColumn("overfit", F.abs(F.col("overfitting_accuracy_gap")) > 0.1))


def run_model(data: DataFrame, features: Sequence[str], response: str, config: str, model_type: str,
              train_ratio: float = 0.7, seed: int = 42, key: str = "CustomerID", params: dict | None = None):
    """Fit on the train split, score both splits, evaluate (J13, J14). Returns (metrics row DataFrame, model)."""
    scores, model, n_train = fit_and_score(data, features, response, model_type, train_ratio, seed, key, params)
    scores = scores.withColumns({"configuration": F.lit(config), "model_type": F.lit(model_type)})
    return run_table(scores, [(config, model_type, list(features), n_train)]), model


def feature_importances(model, features: Sequence[str], spark) -> DataFrame:
    """(feature, importance) for tree models."""
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")


def tree_nodes(model, features: Sequence[str], spark, path: str | None = None) -> DataFrame:
    """Node table of a fitted decision tree, one row a node (J16): (id, parent, depth, side, path, feature, threshold,
    n, prediction, probability, gain); leaves have no feature.

    The model is saved to ``path`` (a new folder of the shared one by default) and its node data is read back as a
    table; parents, depths and paths come from one join per level. Rows go left where feature <= threshold.
    """
    folder = path or shared_folder(spark, "tree")
    model.write().overwrite().save(folder)
    saved = spark.read.parquet(f"{folder}/data")
    names = F.array(*[F.lit(f) for f in features])
    inner = F.col("leftChild") >= 0
    stats = F.col("impurityStats")
    nodes = saved.select(
        "id", "leftChild", "rightChild", F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.aggregate(stats, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n"), "prediction",
        F.try_divide(F.get(stats, F.lit(1)), F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)).alias("probability"),
        F.when(inner, F.col("gain")).alias("gain"))
    nodes = cut_lineage(nodes)
    child = nodes.select(F.col("id").alias("parent"), F.col("feature").alias("f"), F.col("threshold").alias("t"), F.inline(F.array(
        F.struct(F.lit("left").alias("side"), F.col("leftChild").alias("child")),
        F.struct(F.lit("right").alias("side"), F.col("rightChild").alias("child"))))).filter("child >= 0")
    step = F.concat("f", F.when(F.col("side") == "left", " <= ").otherwise(" > "), F.col("t").cast("string"))
    above = child.select("child", "parent", "side", step.alias("step"))
    level = nodes.join(above.select("child"), nodes["id"] == F.col("child"), "left_anti").select(
        "id", F.lit(None).cast("int").alias("parent"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("side"), F.lit("").alias("path"))
    placed = level
    for depth in range(1, model.depth + 1):
        level = (above.join(level.select(F.col("id").alias("parent"), F.col("path").alias("__p")), "parent")
                 .select(F.col("child").alias("id"), "parent", F.lit(depth).alias("depth"), "side",
                         F.concat_ws(" and ", F.nullif(F.col("__p"), F.lit("")), F.col("step")).alias("path")))
        if depth % 6 == 0:
            level = cut_lineage(level)
        placed = placed.unionByName(level)
    return placed.join(nodes.drop("leftChild", "rightChild"), "id")
