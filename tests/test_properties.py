"""Property tests: exact quantiles on random data, both operator paths, vs numpy."""

import numpy as np
from hypothesis import given, settings, strategies as st

from basketlens.operators import quantiles as Q

from plain_checks import quartile_labels

values = st.lists(st.one_of(st.integers(-50, 50).map(float), st.floats(-1e6, 1e6, allow_nan=False, width=32)),
                  min_size=1, max_size=300)
probs = st.lists(st.floats(0.0, 1.0), min_size=1, max_size=4)


@settings(max_examples=12, deadline=None)
@given(vals=values, ps=probs)
def test_exact_quantiles_match_numpy(spark, vals, ps):
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    want = np.quantile(np.array(vals, dtype=float), ps, method="linear")
    inline = Q.column_quantiles(df, ["x"], ps)["x"]["q"]
    narrow = Q.column_quantiles(df, ["x"], ps, finish_rows=4, buckets=3)["x"]["q"]
    for w, a, b in zip(want, inline, narrow):
        tol = 1e-9 * max(1.0, abs(w))
        assert abs(a - w) <= tol and abs(b - w) <= tol


tied = st.lists(st.one_of(st.sampled_from([0.0, 0.0, 0.0, 1.0, 2.0, 1000.0]), st.integers(-20, 20).map(float),
                          st.none()), min_size=1, max_size=120)


@settings(max_examples=10, deadline=None)
@given(vals=tied)
def test_quartile_bins_match_pandas_qcut(spark, vals):
    from basketlens.operators.binning import quartile_bins
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = [r["b"] for r in quartile_bins(df, {"b": "x"}).orderBy("i").collect()]
    assert got == quartile_labels(vals)


keyed = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-5, 5).map(float)), min_size=1, max_size=200)


@settings(max_examples=8, deadline=None)
@given(rows=keyed)
def test_value_ranks_match_brute_force(spark, rows):
    from basketlens.operators.ordering import value_ranks
    df = spark.createDataFrame(rows, "k string, v double")
    want = sorted((k, v, r + 1) for k in {k for k, _ in rows}
                  for r, v in enumerate(sorted(v for kk, v in rows if kk == k)))
    got = sorted((r["k"], r["v"], r["rank"]) for r in value_ranks(df, "k", "v", num_partitions=3, chunk=7).collect())
    assert got == want
