"""Tasks over the lines are bounded by rows, and filters on typed identifiers stay small."""

import datetime as dt

from pyspark.sql import functions as F

from basketlens.operators import ordering, quality
from basketlens.operators.features import customer_aggregates
from basketlens.operators.quantiles import group_quantiles
from basketlens.operators.typing import convert_data_types
from basketlens.plans import catalog
from basketlens.sources import fixtures as fx
from basketlens.sources.schemas import LINES, LINES_RAW
from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_dealt_by_rows(spark, monkeypatch):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fx.line_partitions(spark, SF_SMALL) == least
    whole = sorted(map(tuple, fx.lines(spark, SF_SMALL).collect()))
    monkeypatch.setattr(fx, "LINE_ROWS", 200)
    n = fx.line_partitions(spark, SF_SMALL)
    assert n == -(-fx.table(spark, SF_SMALL, "lineitem").count() // 200) > least
    df = fx.lines(spark, SF_SMALL)
    assert df.rdd.getNumPartitions() == n
    assert sorted(map(tuple, df.collect())) == whole


def test_aggregates_are_dealt_by_partitions(spark):
    d = dt.datetime
    rows = [("1", "a", "x", 2, d(2022, 1, 1), 1.5, "c", "X"), ("1", "a", "x", 2, d(2022, 1, 1), 1.5, "c", "X"),
            ("1", "b", "x", -1, d(2022, 1, 2), 2.0, "c", "X"), ("b", None, "x", 3, d(2022, 1, 3), None, "c", "X"),
            (None, "a", "x", None, None, 1.0, "c", "X"), (None, None, None, None, None, None, "e", None),
            ("1", "a", "x", 5, d(2022, 2, 1), 1.0, None, "X")]
    got = customer_aggregates(spark.createDataFrame(rows, LINES), persist=False, partitions=13)
    assert "_item" in plan(got) and "RepartitionByExpression [CustomerID" in plan(got) and ", 13" in plan(got)
    out = {r["CustomerID"]: r for r in got.collect()}
    assert sorted(out) == ["c", "e"]
    c = out["c"]
    # an invoice and a product of the same text are counted apart; NULL ones are not counted
    assert (c["num_orders"], c["product_diversity"], c["total_quantity"], c["total_spending"]) == (2, 2, 6, 4.0)
    assert (c["first_purchase"], c["last_purchase"], c["recency"]) == (d(2022, 1, 1), d(2022, 1, 3), 29)
    assert c["return_rate"] == 1 / 6
    e = out["e"]
    assert (e["num_orders"], e["product_diversity"], e["total_quantity"], e["total_spending"]) == (0, 0, 0, 0.0)
    assert e["first_purchase"] is None and e["return_rate"] == 0.0


def test_identifier_filters_stay_small(spark):
    ids = ["7", " 7.0 ", "a.00", ".0", "", "  ", None, "1.50"]
    raw = spark.createDataFrame([(i, "s", "x", "1", "1/2/22 3:04", "1.0", "c", "X") for i in ids], LINES_RAW)
    typed = convert_data_types(raw)
    assert [r[0] for r in typed.select("InvoiceNo").collect()] == ["7", "7", "a", "", None, None, None, "1.50"]
    kept = quality.process_missing_data(typed, default_policy="keep", id_policy="delete")
    assert sorted(r[0] for r in kept.select("InvoiceNo").collect()) == ["1.50", "7", "7", "a"]
    filters = [line for line in plan(kept).splitlines() if "Filter" in line]
    assert filters and max(line.count("InvoiceNo") for line in filters) <= 8
    unchanged = quality.handle_missing_identifiers(typed.withColumn("n", F.lit(3)), "n")
    assert unchanged.count() == len(ids)


def test_grouped_values_are_dealt_by_partitions(spark, monkeypatch):
    cut, kept = ordering.cut_lineage, []
    monkeypatch.setattr(ordering, "cut_lineage", lambda df: (kept.append(plan(df)), cut(df))[1])
    rows = [("a", 1.0, i) for i in range(60)] + [("b", float(i % 7), None) for i in range(40)] + [(None, 2.0, 3), (None, None, 4), ("c", float("nan"), None)]
    df = spark.createDataFrame(rows, "g string, x double, y long").repartition(5)
    few = group_quantiles(df, ["x", "y"], ["g"], [0.25, 0.5, 1.0])
    many = group_quantiles(df, ["x", "y"], ["g"], [0.25, 0.5, 1.0], 13)
    # values are counted and summed over the partitions asked for; a frequent value is counted in many tasks
    assert "RepartitionByExpression" not in kept[0].split("RepartitionByExpression", 2)[-1]
    assert kept[1].count("RepartitionByExpression [variable") == 2 and "__s" in kept[1] and kept[1].count(", 13") == 3
    assert "RepartitionByExpression [__pid" in plan(many) and ", 13" in plan(many)
    got = {(r["variable"], r["g"]): (r["n"], r["q"]) for r in many.collect()}
    assert got == {(r["variable"], r["g"]): (r["n"], r["q"]) for r in few.collect()}
    assert got == {("x", "a"): (60, [1.0, 1.0, 1.0]), ("x", "b"): (40, [1.0, 3.0, 6.0]), ("x", None): (1, [2.0, 2.0, 2.0]),
                   ("y", "a"): (60, [14.75, 29.5, 59.0]), ("y", None): (2, [3.25, 3.5, 4.0])}


def test_product_quantiles_follow_the_lines(spark, monkeypatch):
    monkeypatch.setattr(fx, "LINE_ROWS", 500)
    n = 2 * fx.line_partitions(spark, SF_SMALL)
    out = catalog.QUERIES["product_line_quantiles"](spark, SF_SMALL)
    assert n > 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) and f", {n}" in plan(out)
