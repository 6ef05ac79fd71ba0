import datetime as dt
from statistics import NormalDist

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions import columns as C


def test_day_diff_is_elapsed_days(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 1, 23, 0), dt.datetime(2022, 1, 2, 22, 59)),
                                (dt.datetime(2022, 1, 1, 0, 0), dt.datetime(2022, 1, 3, 0, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(C.day_diff("a", "b")).collect()] == [0, 2]


def test_parse_mixed_dates(spark):
    df = spark.createDataFrame([("1/12/22 8:26",), ("01/12/22 08:26",), ("bad",), ("12/31/22 1:00",), (None,)], "s string")
    got = [r[0] for r in df.select(C.parse_timestamp("s")).collect()]
    want = dt.datetime(2022, 12, 1, 8, 26)
    assert got == [want, want, None, None, None]


def test_parse_iso_dates(spark):
    df = spark.createDataFrame([("1995-01-02 00:00:00",)], "s string")
    assert df.select(C.parse_timestamp("s")).first()[0] == dt.datetime(1995, 1, 2)


def test_normalize_id(spark):
    df = spark.createDataFrame([(17850.0,), (None,), (17850000.0,)], "x double")
    assert [r[0] for r in df.select(C.normalize_id("x", T.DoubleType())).collect()] == ["17850", None, "17850000"]
    df = spark.createDataFrame([("17850.0",), (" 42 ",), (" ",), (None,)], "x string")
    assert [r[0] for r in df.select(C.normalize_id("x", T.StringType())).collect()] == ["17850", "42", None, None]


def test_to_boolean_and_nps(spark):
    df = spark.createDataFrame([("1",), ("0",), (" ",), ("x",), ("7",), ("10.5",), ("11",), (None,)], "s string")
    rows = df.select(C.to_boolean("s"), C.nps_ordinal("s")).collect()
    assert [r[0] for r in rows] == [True, False, None, None, True, True, True, None]
    assert [r[1] for r in rows] == [1, 0, None, None, 7, None, None, None]


def test_nps_band(spark):
    df = spark.createDataFrame([(0,), (6,), (7,), (8,), (9,), (10,), (None,)], "n int")
    assert [r[0] for r in df.select(C.nps_band("n")).collect()] == [
        "Detractor (0-6)", "Detractor (0-6)", "Passive (7-8)", "Passive (7-8)", "Promoter (9-10)", "Promoter (9-10)", None]


def test_snake_case(spark):
    df = spark.createDataFrame([("Decision Tree (Binned First)",), ("  SVM  ",)], "s string")
    assert [r[0] for r in df.select(C.snake_case("s")).collect()] == ["decision_tree_binned_first", "svm"]


def test_norm_ppf_matches_reference_quantiles(spark):
    ps = [1e-12, 1e-6, 0.001, 0.02, 0.1, 0.3, 0.5, 0.7, 0.93, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(C.norm_ppf("p")).collect()]
    for p, g in zip(ps, got):
        assert abs(g - NormalDist().inv_cdf(p)) < 1e-9 * max(1.0, abs(g))
    assert df.select(C.norm_ppf(F.lit(0.0)), C.norm_ppf(F.lit(1.0))).first() == (None, None)


def test_safe_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(C.safe_corr("a", "b")).first()[0] is None


def test_public_helpers(spark):
    import os
    import tempfile
    from basketlens.operators import clustering, quality, typing as ty
    from basketlens.operators.features import line_value
    df = spark.createDataFrame([(2, 1.5, "a", None), (3, None, None, True)], "Quantity long, UnitPrice double, s string, b boolean")
    assert [r.TotalValue for r in line_value(df).collect()] == [3.0, None]
    assert ty.numeric_columns(df) == ["Quantity", "UnitPrice"] and ty.categorical_columns(df) == ["s", "b"]
    filled = quality.constant_fill(df, {"UnitPrice": 0.0, "s": "Unknown"}).collect()
    assert filled[1].UnitPrice == 0.0 and filled[1].s == "Unknown"
    schema, head = ty.overview(df, n=1, order_by=["Quantity"])
    assert schema.count() == 4 and head.first().Quantity == 2
    assert df.select(C.neg_log10(F.lit(0.01))).first()[0] == 2.0
    out = os.path.join(tempfile.mkdtemp(prefix="bl-sink-"), "a")
    clustering.write_assignments(df, out)
    assert spark.read.parquet(out).count() == 2
