import os
import tempfile

import pytest
from pyspark.sql import functions as F

from basketlens.operators.typing import convert_campaign_data_types, convert_data_types
from basketlens.sources import fixtures as fx
from basketlens.sources import io
from basketlens.sources.schemas import CAMPAIGN_RAW, LINES_RAW
from basketlens.plans import presets

from conftest import SF_SMALL


def test_csv_round_trip_types_back(spark):
    out = tempfile.mkdtemp(prefix="bl-csv-")
    dirty = fx.lines_dirty(spark, SF_SMALL)
    io.write_table(dirty, os.path.join(out, "lines"), fmt="csv")
    camp = fx.campaign(spark, SF_SMALL)
    io.write_table(camp, os.path.join(out, "campaign"), fmt="csv")
    raw = io.read_lines_csv(spark, os.path.join(out, "lines"))
    assert raw.count() == dirty.count()
    typed = convert_data_types(raw)
    assert dict(typed.dtypes)["InvoiceDate"] == "timestamp_ntz" and dict(typed.dtypes)["Quantity"] == "bigint"
    assert typed.filter("InvoiceDate IS NULL").count() == 0
    c = convert_campaign_data_types(io.read_campaign_csv(spark, os.path.join(out, "campaign")))
    assert dict(c.dtypes)["response"] == "boolean" and c.count() == camp.count()


def test_full_pipeline_and_run_log(spark):
    out = tempfile.mkdtemp(prefix="bl-runs-")
    joined = presets.full_pipeline(fx.lines_dirty(spark, SF_SMALL), fx.campaign(spark, SF_SMALL))
    assert joined.count() > 0 and "response" in joined.columns
    runs, _ = presets.run_configuration(joined, "baseline", "naive_bayes")
    presets.append_runs(runs, os.path.join(out, "runs"))
    presets.append_runs(runs, os.path.join(out, "runs"))
    log = presets.read_runs(spark, os.path.join(out, "runs"))
    assert log.count() == 1 and presets.latest_runs(log).count() == 1
    later = runs.withColumns({"run_ts": F.col("run_ts") + 1, "run_id": F.lit("b"), "test_auc": F.lit(0.5)})
    tied = runs.withColumns({"run_ts": F.col("run_ts") + 1, "run_id": F.lit("a")})
    presets.append_runs(later.unionByName(tied), os.path.join(out, "runs"))
    log = presets.read_runs(spark, os.path.join(out, "runs"))
    assert log.count() == 3 and set(log.columns) == set(runs.columns)
    assert [r["run_id"] for r in presets.latest_runs(log).collect()] == ["b"]


def test_malformed_rows_are_set_aside(spark):
    folder = tempfile.mkdtemp(prefix="bl-bad-")
    good = ['c1,1,0,9', 'c2,0,"1",7', '"c,3",1,,', 'c4,,,"say ""hi"""', 'c9,1,0,\u00e9']
    bad = {'c5,1,0': "fields", 'c6,1,0,3,8': "fields", 'c7,"1,0,3': "quotes", 'c"8,1,0,3': "quotes"}
    for name, lines in (("a.csv", good[:2] + list(bad)), ("b.csv", good[2:])):
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
            f.write("\n".join(["CustomerID,response,loyalty,nps", *lines, "", ""]))
    with open(os.path.join(folder, "c.csv"), "wb") as f:
        f.write(b"CustomerID,response,loyalty,nps\r\nc10,1,0,5\r\nc\xff11,1,0,3\r\n")
    rows, rejected = io.read_csv_quarantine(spark, folder, CAMPAIGN_RAW, ("n_comp", "n_communications"))
    assert sorted((r["CustomerID"], r["response"], r["nps"]) for r in rows.fillna("-").collect()) == [
        ("c,3", "1", "-"), ("c1", "1", "9"), ("c10", "1", "5"), ("c2", "0", "7"), ("c4", "-", 'say "hi"'), ("c9", "1", "\u00e9")]
    found = {r["line"]: (r["reason"], os.path.basename(r["file"])) for r in rejected.collect()}
    assert {k: v[0] for k, v in found.items() if "\ufffd" not in k} == bad and all(v[1] == "a.csv" for k, v in found.items() if k in bad)
    assert [v for k, v in found.items() if "\ufffd" in k] == [("encoding", "c.csv")] and rejected.count() == 5
    assert rows.count() + rejected.count() == len(good) + len(bad) + 2
    with pytest.raises(ValueError):
        io.read_csv_quarantine(spark, folder, LINES_RAW)


def test_command_line_runner_on_csv(spark):
    from basketlens.plans import run
    root = tempfile.mkdtemp(prefix="bl-cli-")
    io.write_table(fx.lines_dirty(spark, SF_SMALL), os.path.join(root, "lines"), fmt="csv")
    io.write_table(fx.campaign(spark, SF_SMALL), os.path.join(root, "campaign"), fmt="csv")
    written = run.run(spark, os.path.join(root, "out"), io.read_lines_csv(spark, os.path.join(root, "lines")),
                      io.read_campaign_csv(spark, os.path.join(root, "campaign")), steps=["features", "eda"])
    names = {os.path.basename(p) for p in written}
    assert {"customer_campaign", "integrity_report", "correlation", "top_products", "qq_fit"} <= names
    assert spark.read.parquet(os.path.join(root, "out", "customer_campaign")).count() > 0


def test_csv_columns_bind_by_header(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="bl-hdr-"), "c")
    spark.createDataFrame([("7", "extra", "1", "c1", "9")], "loyalty string, note string, response string, CustomerID string, nps string") \
        .write.option("header", True).csv(out)
    row = io.read_campaign_csv(spark, out).first()
    assert (row["CustomerID"], row["response"], row["loyalty"], row["nps"], row["n_comp"]) == ("c1", "1", "7", "9", None)
    with pytest.raises(ValueError):
        io.read_lines_csv(spark, out)
