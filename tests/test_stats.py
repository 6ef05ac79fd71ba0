import numpy as np
import pytest

from basketlens.operators import clustering, stats


def _frame(spark, x, names):
    return spark.createDataFrame([tuple(float(v) for v in row) for row in x], ", ".join(f"{n} double" for n in names))


def test_vif_matches_uncentred_regressions(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(5, 1, 300)
    b = a * 0.8 + rng.normal(0, 0.3, 300)
    c = rng.normal(0, 1, 300)
    x = np.column_stack([a, b, c])
    df = _frame(spark, x, ["a", "b", "c"])
    _, vif_df, _ = stats.vif_elimination(df, ["a", "b", "c"], threshold=1e9)
    got = {r.feature: r.vif for r in vif_df.collect()}
    for i, name in enumerate("abc"):
        y, others = x[:, i], np.delete(x, i, axis=1)
        coef, *_ = np.linalg.lstsq(others, y, rcond=None)
        ssr = ((y - others @ coef) ** 2).sum()
        assert got[name] == pytest.approx((y ** 2).sum() / ssr, rel=1e-8)


def test_vif_elimination_drops_worst_and_dependent_copy(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(0, 1, 200)
    x = np.column_stack([a, 3 * a + 2, rng.normal(0, 1, 200)])
    df = _frame(spark, x, ["a", "a_affine", "c"])
    # uncentred VIF does not see the affine copy (no constant) ...
    assert stats.dependent_columns(df, ["a", "a_affine", "c"]) == ["a_affine"]
    kept, _, log = stats.vif_elimination(df, ["a", "a_affine", "c"])
    assert len(kept) == 3 - log.count()


def test_split_dendrogram_orders_heights(spark):
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(0, 0.1, (40, 2)), rng.normal(5, 0.1, (40, 2))])
    df = _frame(spark, pts, ["x", "y"])
    d = clustering.split_dendrogram(df, max_leaves=16, last=5).collect()
    heights = [r.height for r in d]
    assert heights == sorted(heights) and d[-1].size == 80


def test_random_fourier_features_approximate_rbf_kernel(spark):
    from basketlens.operators.modeling import rbf_features
    pts = [(0.0, 0.0), (0.5, -0.2), (1.0, 1.0)]
    df = spark.createDataFrame(pts, "a double, b double")
    add, names = rbf_features(df, ["a", "b"], n_components=4000, gamma=0.7, seed=3)
    z = np.array([[r[n] for n in names] for r in add(df).collect()])
    for i in range(3):
        for j in range(3):
            want = np.exp(-0.7 * ((np.array(pts[i]) - np.array(pts[j])) ** 2).sum())
            assert abs(z[i] @ z[j] - want) < 0.05


def test_bisecting_labels_match_bruteforce_groups(spark):
    rng = np.random.default_rng(4)
    pts = np.vstack([rng.normal(c, 0.05, (30, 2)) for c in (0.0, 3.0, 9.0)])
    df = spark.createDataFrame([(str(i), float(a), float(b)) for i, (a, b) in enumerate(pts)],
                               "CustomerID string, x double, y double")
    res, _, k = clustering.cluster_analysis(df, k=3)
    rows = res.collect()
    labels = {}
    for r in rows:
        labels.setdefault(round(r.x), set()).add(r.hierarchical_cluster)
    # each well-separated blob gets exactly one Ward label, and the three labels differ
    assert all(len(v) == 1 for v in labels.values()) and len({next(iter(v)) for v in labels.values()}) == 3
    assert {r.hierarchical_cluster for r in rows} == {1, 2, 3}


def test_hierarchical_labels_and_merges_use_all_rows(spark):
    rng = np.random.default_rng(6)
    pts = np.vstack([rng.normal(c, 0.4, (100, 2)) for c in (0.0, 3.0, 9.0, 12.0)])
    df = spark.createDataFrame([(str(i), float(a), float(b)) for i, (a, b) in enumerate(pts)],
                               "CustomerID string, x double, y double")
    got = {r.CustomerID: r.hierarchical_cluster for r in clustering.cluster_analysis(df, k=4)[0].collect()}
    blobs = [{got[str(i)] for i in range(b, b + 100)} for b in (0, 100, 200, 300)]
    assert set().union(*blobs) == {1, 2, 3, 4} and all(len(b) == 1 for b in blobs)
    # every split of the tree, recomputed from the rows of its two sides
    feats, _ = clustering.clustering_matrix(df)
    model, labelled = clustering.bisecting(feats.cache(), 8)
    merges = clustering.split_table(labelled, clustering.bisecting_tree(model, spark)).orderBy("step").collect()
    member, height = {}, {}
    for r in labelled.collect():
        member.setdefault(r["__leaf"], []).append(r.features.toArray())
    assert len(member) == 8 and [m.step for m in merges] == list(range(1, 8)) and merges[-1].size == len(pts)
    for m in merges:
        a, b = np.array(member.pop(m.left)), np.array(member.pop(m.right))
        ward = np.sqrt(2 * len(a) * len(b) / (len(a) + len(b))) * np.linalg.norm(a.mean(0) - b.mean(0))
        want = max(ward, height.get(m.left, 0), height.get(m.right, 0))
        assert abs(m.height - want) < 1e-9 and m.size == len(a) + len(b)
        member[7 + m.step], height[7 + m.step] = [*a, *b], want  # 8 leaves + step - 1
    last = clustering.split_dendrogram(df, last=3).collect()
    assert [(m.size, round(m.height, 9)) for m in last] == [(m.size, round(m.height, 9)) for m in merges[-3:]]
