import random

import pytest
from pyspark.sql import functions as F

from basketlens.operators import binning, evaluation, ordering, quality, quantiles as Q
from basketlens.operators.eda import response_rate_table


def _col(spark, values, name="x", typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")


def _labels(spark, values):
    df = _col(spark, values)
    out = binning.quartile_bins(df, {"b": "x"})
    return [r["b"] for r in out.collect()]


def test_bins_with_tied_edges(spark):
    # edges 0, 0.5, 3 -> Very Low x8, Low x3, outlier 1000 Unknown
    labels = _labels(spark, [0.0] * 8 + [1.0, 2.0, 3.0, 1000.0])
    assert labels == ["Very Low"] * 8 + ["Low"] * 3 + ["Unknown"]


def test_bins_single_edge_all_unknown(spark):
    assert set(_labels(spark, [5.0] * 10 + [900.0])) == {"Unknown"}


def test_bins_all_null_and_constant(spark):
    assert set(_labels(spark, [None, None])) == {"Unknown"}
    assert set(_labels(spark, [3.0, 3.0, None])) == {"Unknown"}


def test_bins_null_is_unknown(spark):
    labels = _labels(spark, [1.0, 2.0, 3.0, 4.0, 5.0, None])
    assert labels[-1] == "Unknown" and "Unknown" not in labels[:-1]


def test_quantiles_linear_interpolation(spark):
    df = _col(spark, [1.0, 2.0, 3.0, 4.0, 10.0])
    assert Q.column_quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"]["q"] == [2.0, 3.0, 4.0]


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_narrowing_path_matches_exact(spark, seed):
    rnd = random.Random(seed)
    vals = [rnd.lognormvariate(0, 2) for _ in range(3000)] + [7.0] * 1500  # heavy tail + hot value
    df = _col(spark, vals)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    exact = Q.column_quantiles(df, ["x"], probs)["x"]["q"]
    narrowed = Q.column_quantiles(df, ["x"], probs, finish_rows=64, buckets=8)["x"]["q"]
    s = sorted(vals)
    for p, a, b in zip(probs, exact, narrowed):
        h = (len(s) - 1) * p
        lo = int(h)
        brute = s[lo] + (s[min(lo + 1, len(s) - 1)] - s[lo]) * (h - lo)
        assert a == pytest.approx(brute, rel=1e-12)
        assert b == pytest.approx(brute, rel=1e-12)


def test_grouped_quantiles(spark):
    df = spark.createDataFrame([(g, float(v)) for g in ("a", "b") for v in range(1, 6 if g == "a" else 11)],
                               "g string, x double")
    df = df.union(spark.createDataFrame([(None, 7.0), (None, None), ("c", None), ("c", float("nan"))], df.schema))
    res = {(r["variable"], r["g"]): (r["n"], r["q"]) for r in Q.group_quantiles(df, ["x"], ["g"], [0.5, 1.0]).collect()}
    assert res == {("x", "a"): (5, [3.0, 5.0]), ("x", "b"): (10, [5.5, 10.0]), ("x", None): (1, [7.0, 7.0])}


def test_mode_lowest_on_ties(spark):
    assert quality.mode_value(_col(spark, [3, 1, 3, 1, 7], typ="int"), "x") == 1


def test_missing_report_counts_blanks(spark):
    df = spark.createDataFrame([("a", 1), (" ", None), ("", 2), (None, 3)], "s string, n int")
    rep = {r["column"]: (r["n_null"], r["n_invalid"]) for r in quality.missing_report(df).collect()}
    assert rep == {"s": (1, 3), "n": (1, 1)}


def test_default_fill_unknown_k(spark):
    df = spark.createDataFrame([("Unknown-1",), ("x",), (None,), (" ",)], "s string")
    out = [r[0] for r in quality.handle_missing_values(df, "s", "default").collect()]
    assert out == ["Unknown-1", "x", "Unknown-2", "Unknown-2"]


def test_generated_ids_unique_and_stable(spark):
    rows = [("a", None)] * 5 + [("b", None), ("c", "ID1")]
    df = spark.createDataFrame(rows, "v string, id string").repartition(3)
    a = sorted(r["id"] for r in quality.fill_missing_ids(df, "id").collect())
    b = sorted(r["id"] for r in quality.fill_missing_ids(df, "id").collect())
    assert a == b and len(set(a)) == 7 and "ID1" in a


def test_generated_ids_do_not_depend_on_partitions_and_avoid_taken_ones(spark, monkeypatch):
    monkeypatch.setattr(quality, "ID_CHUNK", 7)
    rows = [(f"v{i % 3}", None if i % 2 else i, " ") for i in range(200)]
    df = spark.createDataFrame(rows, "v string, n int, id string")
    found = [sorted((r["v"], r["n"] or -1, r["id"]) for r in quality.fill_missing_ids(df.repartition(p), "id").collect())
             for p in (1, 3, 7)]
    assert found[0] == found[1] == found[2]
    ids = {x[2] for x in found[0]}
    assert len(ids) == 200
    taken = df.unionByName(spark.createDataFrame([("other", 1, i) for i in sorted(ids)[:20]], df.schema))
    again = [r["id"] for r in quality.fill_missing_ids(taken, "id").collect()]
    assert len(again) == len(set(again)) == 220


def test_category_codes_of_150k_levels(spark):
    from basketlens.operators.eda import category_codes
    df = spark.range(150_000).selectExpr("concat('c', id) AS c").unionByName(spark.sql("SELECT CAST(NULL AS STRING) c"))
    got = {r["c"]: r["code"] for r in category_codes(df, "c").collect()}
    want = {c: i for i, c in enumerate(sorted(f"c{i}" for i in range(150_000)))}
    assert got == want | {None: -1}


def test_negative_price_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "UnitPrice double")
    assert sorted(quality.remove_negative_unit_price(df).collect(), key=str) == sorted(
        [(1.0,), (None,)], key=str)


def test_dedup_idempotent(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    once = quality.drop_duplicates(df)
    assert once.count() == 2 and quality.drop_duplicates(once).count() == 2
    assert quality.duplicate_report(df).first()["copies"] == 2


def test_iqr_sequential_subset_and_modes(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.gauss(0, 1)), float(rnd.gauss(5, 2))) for _ in range(500)] + [(50.0, 5.0), (0.0, -90.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    seq, rep = quality.iqr_filter(df, ["a", "b"], mode="sequential")
    sim, _ = quality.iqr_filter(df, ["a", "b"], mode="simultaneous")
    assert seq.count() <= df.count() and sim.count() <= df.count()
    assert rep.count() == 2
    assert seq.filter((F.col("a") == 50.0) | (F.col("b") == -90.0)).count() == 0


def test_empty_level_has_zero_and_null_rate(spark):
    df = spark.createDataFrame([(1, 5, "Low", "High", True), (1, 5, "Low", "High", False)],
                               "loyalty int, nps int, recency_bin string, total_sales_bin string, response boolean")
    rows = {(r["variable"], r["level"]): r for r in response_rate_table(df).collect()}
    assert rows[("nps", "Promoter (9-10)")]["n"] == 0 and rows[("nps", "Promoter (9-10)")]["response_rate"] is None
    assert rows[("loyalty", "1")]["response_rate"] == 50.0
    assert rows[("recency_bin", "Unknown")]["n"] == 0


def test_prefix_sums_and_ranks_match_brute_force(spark):
    rnd = random.Random(5)
    vals = [rnd.randint(0, 50) for _ in range(2000)] + [7] * 1000  # a third of rows on one value
    df = spark.createDataFrame([("k", float(v)) for v in vals], "key string, value double")
    want = sorted(zip(sorted(float(v) for v in vals), range(1, len(vals) + 1)))
    ranked = ordering.value_ranks(df, "key", "value", num_partitions=5, chunk=100)
    assert sorted((r["value"], r["rank"]) for r in ranked.collect()) == want


def test_confusion_single_class_and_auc(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.9), (1.0, 0.0, 0.2)], "label double, prediction double, score double")
    cm = evaluation.confusion_matrix(df).first()
    assert (cm.tn, cm.fp, cm.fn, cm.tp) == (0, 0, 1, 1)
    rnd = random.Random(7)
    rows = [(float(rnd.random() < 0.4), 0.0, float(round(rnd.random(), 2))) for _ in range(400)]
    df = spark.createDataFrame(rows, "label double, prediction double, score double")
    m = evaluation.evaluate(df, num_partitions=4).first()
    assert evaluation.evaluate(df).first() == m
    pos = [s for y, _, s in rows if y == 1]
    neg = [s for y, _, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert m.auc == pytest.approx(brute, abs=1e-12)
    assert 0.0 <= m.auc <= 1.0


def test_bin_levels_metadata_follow_dropped_labels(spark):
    from basketlens.operators.eda import bin_value_counts, encode_for_correlation
    df = _col(spark, [0.0] * 8 + [1.0, 2.0, 3.0, 1000.0])
    out = binning.quartile_bins(df, {"x_bin": "x"})
    assert binning.levels_of(out, "x_bin") == ["Very Low", "Low", "Unknown"]
    counts = {r["label"]: r["count"] for r in bin_value_counts(out, ["x_bin"]).collect()}
    assert counts == {"Very Low": 8, "Low": 3, "Unknown": 1}
    codes = [r["x_bin"] for r in encode_for_correlation(out.drop("x")).collect()]
    assert codes == [0.0] * 8 + [1.0] * 3 + [2.0]   # Unknown is the third level here, as in a categorical


def test_iqr_report_counts(spark):
    rows = [(float(v), float(v % 7)) for v in range(100)] + [(1000.0, 1.0), (5.0, 500.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    out, rep = quality.iqr_filter(df, ["a", "b"], mode="sequential")
    r = sorted(rep.collect(), key=lambda x: x.step)
    assert r[0].removed == 1 and r[0].remaining == 101       # 1000 in a
    assert r[1].removed == 1 and r[1].remaining == out.count() == 100  # 500 in b


def test_observed_integrity_counts_match_report(spark):
    from basketlens.sources import fixtures as fx
    from conftest import SF_SMALL
    lines, camp = fx.lines_dirty(spark, SF_SMALL), fx.campaign(spark, SF_SMALL)
    lc, cc, obs = quality.observed_integrity_checks(lines, camp)
    n_lines, n_camp = lc.count(), cc.count()   # the caller's own actions fill the observations
    rep = {(r.dataset, r.step): r.rows for r in quality.integrity_report(lines, camp).collect()}
    assert obs["lines_input"].get["rows"] == rep[("lines", "input")]
    assert obs["lines_input"].get["negative_price"] == rep[("lines", "negative_price_removed")]
    assert obs["lines_final"].get["rows"] == rep[("lines", "final")] == n_lines
    assert obs["campaign_final"].get["rows"] == rep[("campaign", "final")] == n_camp


def test_quantiles_ignore_non_finite_on_both_paths(spark):
    import numpy as np
    from basketlens.operators.quantiles import column_quantiles
    rng = np.random.default_rng(1)
    values = rng.normal(size=30_000).round(3).tolist()
    df = spark.createDataFrame([(v,) for v in values + [float("inf"), float("-inf"), float("nan"), None]], "x double")
    small = column_quantiles(df, ["x"], [0.1, 0.37, 0.5, 0.99])["x"]
    narrowed = column_quantiles(df, ["x"], [0.1, 0.37, 0.5, 0.99], finish_rows=50, buckets=8)["x"]
    assert small["q"] == narrowed["q"] and small["n"] == narrowed["n"] == 30_000
    assert np.allclose(small["q"], np.quantile(values, [0.1, 0.37, 0.5, 0.99]))


def test_roc_origin_wins_for_anti_predictive_scores(spark):
    from basketlens.operators.evaluation import roc_points, roc_summary
    df = spark.createDataFrame([(0.0, 0.9), (0.0, 0.8), (1.0, 0.2), (1.0, 0.1)], "label double, score double")
    row = roc_summary(roc_points(df)).first()
    assert (row["auc"], row["best_threshold"], row["youden"]) == (0.0, float("inf"), 0.0)
