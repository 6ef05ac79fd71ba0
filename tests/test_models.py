"""Models and their evaluation against plain computations: keyed evaluation, calibration, naive Bayes, trees, sweep."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketlens.operators import exact_tree, modeling
from basketlens.operators.evaluation import evaluate, evaluate_by, roc_points
from basketlens.operators.naive_bayes import fit_naive_bayes
from basketlens.operators.quantiles import bounded_quantiles
from basketlens.plans import presets
from basketlens.plans.catalog import joined
from conftest import SF_SMALL


def scored(spark, n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), float(rng.random() < 0.4), float(rng.random() < 0.5), rng.choice([0.1, 0.25, 0.5, rng.random()])) for _ in range(n)]
    rows += [("one", 1.0, 1.0, 0.3), ("one", 1.0, 0.0, 0.2)]
    return spark.createDataFrame(rows, "k string, label double, prediction double, score double"), rows


def test_keyed_evaluation_equals_one_by_one(spark):
    df, rows = scored(spark, 400, 1)
    by = {r["k"]: r for r in evaluate_by(df, ["k"], num_partitions=5).collect()}
    assert set(by) == {r[0] for r in rows}
    for k, row in by.items():
        alone = evaluate(df.filter(F.col("k") == k)).first()
        assert all(row[c] == alone[c] or math.isclose(row[c], alone[c], rel_tol=1e-12) for c in alone.asDict())
        pos, neg = ([r[3] for r in rows if r[0] == k and r[1] == y] for y in (1.0, 0.0))
        if pos and neg:
            auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
            assert math.isclose(row["auc"], auc, rel_tol=1e-12)
    assert by["one"]["auc"] is None and by["one"]["tp"] == 1


def test_roc_starts_at_the_origin(spark):
    df, rows = scored(spark, 50, 2)
    points = roc_points(df).orderBy(F.desc("threshold")).collect()
    assert points[0]["threshold"] == math.inf and (points[0]["tpr"], points[0]["fpr"]) == (0.0, 0.0)
    assert (points[-1]["tpr"], points[-1]["fpr"]) == (1.0, 1.0) and len(points) == len({r[3] for r in rows}) + 1
    assert roc_points(df.filter("false")).count() == 0


def noisy(spark, n, seed, features=12):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, features))
    y = (x[:, 0] + 2.0 * rng.standard_normal(n) > 0).astype(float)
    names = [f"x{i}" for i in range(features)]
    df = spark.createDataFrame([(f"c{i}", *map(float, row), float(t)) for i, (row, t) in enumerate(zip(x, y))],
                               "__key string, " + ", ".join(f"{f} double" for f in names) + ", label double")
    return VectorAssembler(inputCols=names, outputCol="features").transform(df), names


def test_no_margin_comes_from_a_model_that_saw_the_row(spark):
    df, _ = noisy(spark, 120, 3)
    svm = modeling.CalibratedSVM(reg_param=1.0 / 120)
    fold = modeling.calibration_fold("__key")
    margins = {r["__key"]: r["__mv"] for r in svm.out_of_fold_margins(df).collect()}
    flipped = df.withColumn("label", F.when(fold == 2, 1.0 - F.col("label")).otherwise(F.col("label")))
    again = svm.out_of_fold_margins(flipped).withColumn("f", fold).collect()
    assert len(margins) == 120 == len(again)
    assert all(math.isclose(r["__mv"], margins[r["__key"]], abs_tol=1e-9) for r in again if r["f"] == 2)
    assert any(abs(r["__mv"] - margins[r["__key"]]) > 1e-3 for r in again if r["f"] != 2)


def test_out_of_fold_calibration_is_better_on_new_rows(spark):
    from pyspark.ml.classification import LogisticRegression
    train, _ = noisy(spark, 90, 4, features=40)
    test, _ = noisy(spark, 400, 5, features=40)
    svm = modeling.CalibratedSVM(reg_param=1.0 / 90)
    svm.fit(train)

    def log_loss(scores):
        return -np.mean([math.log(max(p if y else 1 - p, 1e-12)) for y, p in scores])

    def on(platt):
        margin = VectorAssembler(inputCols=["__mv"], outputCol="__m").transform(svm._margin(svm.svm_model.transform(test)))
        return log_loss([(r["label"], r["p"]) for r in platt.transform(margin).select("label", vector_to_array("probability")[1].alias("p")).collect()])

    seen = VectorAssembler(inputCols=["__mv"], outputCol="__m").transform(svm._margin(svm.svm_model.transform(train)))
    on_training_margins = LogisticRegression(featuresCol="__m", labelCol="label", maxIter=100).fit(seen)
    assert on(svm.platt) < on(on_training_margins)


def test_calibration_needs_both_classes(spark):
    df, _ = noisy(spark, 20, 6)
    with pytest.raises(ValueError):
        modeling.CalibratedSVM().fit(df.withColumn("label", F.lit(1.0)))


def test_naive_bayes_agrees_with_mllib(spark):
    df, names = noisy(spark, 300, 7, features=4)
    mine = {r["__key"]: r["score"] for r in fit_naive_bayes(df, names).transform(df).collect()}
    other = NaiveBayes(modelType="gaussian").fit(df).transform(df).select("__key", vector_to_array("probability")[1].alias("p"))
    assert all(math.isclose(mine[r["__key"]], r["p"], abs_tol=1e-7) for r in other.collect())
    single = fit_naive_bayes(df.filter("label = 1"), names).transform(df).agg(F.min("score"), F.max("prediction")).first()
    assert tuple(single) == (1.0, 1.0)
    constant = df.withColumns({f: F.lit(2.0) for f in names})
    share = df.filter("label = 1").count() / 300
    assert math.isclose(fit_naive_bayes(constant, names).transform(constant).first()["score"], share, rel_tol=1e-9)
    with pytest.raises(ValueError):
        fit_naive_bayes(df.filter("false"), names)


def plain_tree(rows, names, least, depth, node=1):
    """Node -> (n, n0, n1, feature, threshold) by trying every boundary of every feature."""
    def purity(a, b):
        return (a * a + b * b) / (a + b)

    n1 = sum(y for _, y in rows)
    n0, best = len(rows) - n1, None
    for f in range(len(names)):
        values = sorted({x[f] for x, _ in rows})
        for low, high in zip(values, values[1:]):
            l1 = sum(y for x, y in rows if x[f] <= low)
            size = sum(x[f] <= low for x, _ in rows)
            if min(size, len(rows) - size) >= least:
                gain = purity(size - l1, l1) + purity(n0 - size + l1, n1 - l1) - purity(n0, n1)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                    best = (gain, f, (low + high) / 2)
    if not depth or best is None:
        return {node: (len(rows), n0, n1, None, None)}
    _, f, t = best
    left, right = [r for r in rows if r[0][f] <= t], [r for r in rows if r[0][f] > t]
    return ({node: (len(rows), n0, n1, names[f], t)} | plain_tree(left, names, least, depth - 1, 2 * node)
            | plain_tree(right, names, least, depth - 1, 2 * node + 1))


def test_exact_tree_equals_a_plain_search(spark):
    rng = random.Random(8)
    data = [((float(rng.randint(0, 6)), rng.choice([0.5, 1.5, 9.0]), rng.random()), rng.random()) for _ in range(150)]
    data = [(x, int(x[0] + 3 * x[2] + 2 * noise > 4.5)) for x, noise in data]
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(*x, y) for x, y in data] + [(None, 1.0, 1.0, 1), (1.0, 1.0, 1.0, None)], "a double, b double, c double, label int")
    nodes = exact_tree.fit_exact_tree(df, names, max_depth=4, min_leaf=0.04)
    got = {r["node"]: (r["n"], r["n0"], r["n1"], r["feature"], r["threshold"]) for r in nodes.collect()}
    assert got == plain_tree(data, names, math.ceil(0.04 * 150), 4)
    leaves = {}
    for r in exact_tree.score_exact_tree(df.dropna(), nodes, names).collect():
        leaves.setdefault(r["node"], []).append((r["label"], r["score"], r["prediction"]))
    assert {k: len(v) for k, v in leaves.items()} == {k: v[0] for k, v in got.items() if v[3] is None}
    assert all(math.isclose(v[0][1], sum(y for y, _, _ in v) / len(v)) for v in leaves.values())
    assert exact_tree.fit_exact_tree(df.filter("false"), names).count() == 0


@pytest.mark.parametrize("copies", [1, 6])
def test_tree_size_does_not_grow_with_rows(spark, copies):
    rng = np.random.default_rng(9)
    x, y = rng.random(400 * copies), rng.random(400 * copies) < 0.5  # pure noise: an unbounded tree would split to single rows
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, label double")
    assert exact_tree.fit_exact_tree(df, ["x"], max_depth=6, min_leaf=0.1).count() <= 19


def test_tree_nodes_repeat_the_models_predictions(spark):
    df, names = noisy(spark, 200, 10, features=3)
    model = DecisionTreeClassifier(maxDepth=4, minInstancesPerNode=5).fit(df)
    nodes = {r["id"]: r for r in modeling.tree_nodes(model, names, spark).collect()}
    assert len(nodes) == model.numNodes and [r["parent"] for r in nodes.values()].count(None) == 1
    for row in model.transform(df).collect():
        at = nodes[0]
        while at["feature"] is not None:
            side = "left" if row[at["feature"]] <= at["threshold"] else "right"
            at = next(n for n in nodes.values() if n["parent"] == at["id"] and n["side"] == side)
        assert at["prediction"] == row["prediction"] and at["depth"] == len(at["path"].split(" and "))
    assert nodes[0]["n"] == 200 and sum(n["n"] for n in nodes.values() if n["feature"] is None) == 200


def test_bounded_quantiles_on_both_ways(spark):
    rng = random.Random(11)
    values = [rng.choice([1.0, 2.0, 5.0, rng.gauss(0, 3)]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    expected = np.quantile(values, [0.25, 0.5, 0.9])
    for at_most, finish in ((500, 100_000), (500, 8)):
        got = bounded_quantiles(df, "x", [0.25, 0.5, 0.9], min(values) - 1, max(values) + 2, at_most, finish_rows=finish, buckets=4)
        assert got["n"] == 500 and np.allclose(got["q"], expected, rtol=1e-12)
    assert bounded_quantiles(df.filter("x > 1e9"), "x", [0.5], 0.0, 1.0, 10) == {"n": 0, "q": [None]}


def test_sweep_evaluates_all_runs_at_once(spark):
    runs = presets.sweep(joined(spark, SF_SMALL), models=("naive_bayes", "decision_tree_binned"),
                         configs=("baseline", "outlier_removed")).collect()
    assert {(r["configuration"], r["model_type"]) for r in runs} == {
        (c, m) for c in ("baseline", "outlier_removed") for m in ("naive_bayes", "decision_tree_binned")}
    alone = presets.run_configuration(joined(spark, SF_SMALL), "baseline", "naive_bayes")[0].first()
    same = next(r for r in runs if (r["configuration"], r["model_type"]) == ("baseline", "naive_bayes"))
    assert all(alone[c] == same[c] for c in ("test_auc", "train_accuracy", "run_id", "variables_used", "n_train"))


def test_a_model_run_needs_its_key(spark):
    p = presets.prepare(joined(spark, SF_SMALL), "baseline")
    with pytest.raises(ValueError):
        modeling.run_model(p.data.drop("CustomerID"), p.variables, "response", "baseline", "naive_bayes")
