"""Iterative fits run on few partitions, whatever the number the lines were shuffled into."""

from pyspark.sql import functions as F

from basketlens.operators import clustering, modeling
from basketlens.plans import presets
from basketlens.session import fit_partitions


def customers(spark, rows=400, partitions=60):
    k = F.col("id")
    return spark.range(rows).repartition(partitions).select(
        k.cast("string").alias("CustomerID"), (k % 17).cast("double").alias("a"), ((k * 7) % 31).cast("double").alias("b"),
        ((k % 17) + (k * 5) % 13 > 14).cast("int").alias("response"))


def test_partitions_follow_rows(spark):
    df = spark.range(0, 1000, 1, 60)
    assert fit_partitions(df, 1000).rdd.getNumPartitions() == 8
    assert fit_partitions(df, 1000, 4).rdd.getNumPartitions() == 4
    assert fit_partitions(df, 1000, each=50).rdd.getNumPartitions() == 20
    assert fit_partitions(df, 1000, each=1).rdd.getNumPartitions() == 60  # never more
    assert fit_partitions(df, 0).count() == 1000


def test_models_fit_on_few_partitions(spark, monkeypatch):
    seen = {}
    real = modeling.make_estimator

    def watched(model_type, n_train, **kw):
        est = real(model_type, n_train, **kw)
        fit = est.fit
        est.fit = lambda df: seen.__setitem__(model_type, (df.rdd.getNumPartitions(), df.count())) or fit(df)
        return est

    monkeypatch.setattr(modeling, "make_estimator", watched)
    for m in ("svm", "decision_tree"):
        scores, _, n = modeling.fit_and_score(customers(spark), ["a", "b"], "response", m)
        assert scores.count() == 400 and scores.filter("split = 'train'").count() == n == seen[m][1]
    assert seen["svm"][0] == 4 and seen["decision_tree"][0] == 8


def test_clusters_fit_on_few_partitions(spark, monkeypatch):
    seen = []
    real = clustering._search_k
    monkeypatch.setattr(clustering, "_search_k", lambda f, *a, **k: seen.append((f.rdd.getNumPartitions(), f.count())) or real(f, *a, **k))
    feats, _ = clustering.clustering_matrix(customers(spark), ["a", "b"])
    assert [r["k"] for r in clustering.choose_k(feats, [2, 3]).orderBy("k").collect()] == [2, 3]
    assert clustering.cluster_analysis(customers(spark), k_values=[2, 3])[0].count() == 400
    assert seen == [(8, 400), (8, 400)]


def test_sweep_prepares_the_tree_binned_after_once(spark, monkeypatch):
    made = []
    real = presets.prepare
    monkeypatch.setattr(presets, "prepare", lambda j, c, r, m=None: made.append((c, m)) or real(j, c, r, m))
    data = customers(spark).select("CustomerID", "a", "b", F.col("response").cast("boolean").alias("response"))
    models = ["naive_bayes", "decision_tree", "decision_tree_binned_after"]
    runs = presets.sweep(data, models, ["baseline"]).collect()
    assert made == [("baseline", None)]
    assert sorted(r["model_type"] for r in runs) == sorted(models)
    alone = presets.run_configuration(data, "baseline", "decision_tree_binned_after")[0].first()
    both = next(r for r in runs if r["model_type"] == "decision_tree_binned_after")
    assert (both["variables_used"], both["n_train"], both["test_accuracy"]) == (alone["variables_used"], alone["n_train"], alone["test_accuracy"])


def test_forest_keeps_the_node_of_each_row_and_the_same_trees(spark):
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(customers(spark, partitions=3).withColumn("label", F.col("response").cast("double"))).cache()
    forest = modeling.make_estimator("random_forest", 400).setNumTrees(4)
    assert forest.getCacheNodeIds()
    kept, plain = forest.fit(df), forest.copy({forest.cacheNodeIds: False}).fit(df)
    assert kept.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:] and kept.totalNumNodes > 4


def test_sweep_cuts_the_plan_that_all_preparations_start_from(spark, monkeypatch):
    seen = []
    real = presets.prepare
    monkeypatch.setattr(presets, "prepare", lambda j, *a: seen.append(j) or real(j, *a))
    data = customers(spark).select("CustomerID", "a", "b", F.col("response").cast("boolean").alias("response"))
    runs = presets.sweep(data, ["naive_bayes"], ["baseline", "recoded"]).collect()
    assert {r["configuration"] for r in runs} == {"baseline", "recoded"}
    assert len(seen) == 2 and seen[0] is seen[1]
    assert seen[0].data.select("a")._jdf.queryExecution().analyzed().toString().count("\n") <= 3  # not that of the customers
