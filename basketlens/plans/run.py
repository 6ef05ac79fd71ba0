"""Command-line runner: the reference's menu flow with options as arguments.

    python -m basketlens.plans.run --lines lines.csv --campaign campaign.csv --out /shared/results \
        --steps features,eda,models,clusters

Inputs are CSV (text, typed by the engine) or, with ``--sf-dir``, the driver
tables. Every step writes parquet tables under ``--out``; nothing is printed
but the written paths. Sinks are plain Spark writers, so ``--out`` should be
a shared location on a cluster.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame

from ..operators import clustering, eda, quality, stats
from ..operators.campaign import response_rate
from ..operators.modeling import feature_importances, fit_and_score, tree_nodes
from ..operators.typing import convert_campaign_data_types, convert_data_types
from ..sources import fixtures as fx
from ..sources import io
from ..sources.schemas import BIN_SOURCES, CAMPAIGN_RAW, LINES_RAW
from . import presets

STEPS = ("features", "eda", "models", "clusters")


def _write(df: DataFrame, out: str, name: str) -> str:
    path = os.path.join(out, name)
    io.write_table(df, path)
    return path


def run(spark, out: str, lines: DataFrame, campaign: DataFrame, steps=STEPS, models=None, configs=None,
        train_ratio: float = 0.7, monthly_cutoff: str | None = None, id_policy: str = "delete",
        policies: dict | None = None) -> list[str]:
    """Full pipeline, then the selected analyses; returns the written table paths.

    ``policies`` maps columns to missing-value policies ('delete', 'default' or 'keep'; others are kept),
    ``id_policy`` says what becomes of rows without identifier ('delete' or 'generate').
    """
    written = []
    joined = presets.full_pipeline(lines, campaign, policies, id_policy).cache()
    typed_lines, typed_campaign = convert_data_types(lines), convert_campaign_data_types(campaign)

    def save(df: DataFrame, name: str) -> None:
        written.append(_write(df, out, name))

    if "features" in steps:
        save(joined, "customer_campaign")
        save(quality.missing_report(lines), "missing_report_lines")
        save(quality.integrity_report(typed_lines, typed_campaign), "integrity_report")
        save(response_rate(typed_campaign), "response_rate")
    if "eda" in steps:
        enc = eda.encode_for_correlation(joined)
        variables = [c for c in enc.columns if c != "response"]
        save(eda.correlation_matrix(joined), "correlation")
        save(eda.response_rate_table(joined), "response_rate_table")
        save(eda.mean_median_by_response(joined), "mean_median_by_response")
        save(eda.group_response_counts(joined, "loyalty"), "loyalty_response_counts")
        save(eda.stacked_histogram(joined, eda.BAR_CHART_FEATURES), "histograms")
        for suffix, outliers in (("", True), ("_without_outliers", False)):
            save(eda.boxplot_summary(joined, outliers_included=outliers), f"boxplots{suffix}")
            save(stats.qq_fit(stats.qq_points(enc, variables, outliers_included=outliers)), f"qq_fit{suffix}")
        save(eda.bin_value_counts(joined, list(BIN_SOURCES)), "bin_counts")
        save(eda.monthly_sales(typed_lines, monthly_cutoff), "monthly_sales")
        save(eda.top_products(typed_lines, 5), "top_products")
    if "models" in steps:
        for config in configs or presets.CONFIGS:
            prepared = presets.prepare(joined, config)
            save(prepared.vif_log, f"vif_log_{config}")
            save(prepared.significance, f"significance_{config}")
            if prepared.outliers is not None:
                save(prepared.outliers, f"outliers_{config}")
            if config == "baseline" and prepared.variables:
                _, _, forest = _fit(prepared, "random_forest", train_ratio)
                save(feature_importances(forest, prepared.variables, spark), "random_forest_importances")
                _, _, tree = _fit(prepared, "decision_tree", train_ratio)
                save(tree_nodes(tree, prepared.variables, spark), "decision_tree_nodes")
            prepared.release()
        runs = presets.sweep(joined, models or presets.MODEL_TYPES, configs or presets.CONFIGS, train_ratio).cache()
        presets.append_runs(runs, os.path.join(out, "runs"))
        written.append(os.path.join(out, "runs"))
        save(presets.comparison_table(runs), "model_comparison")
        for metric in presets.COMPARISON_METRICS:
            save(presets.metric_grid(runs, metric), f"grid_{metric}")
        runs.unpersist()
    if "clusters" in steps:
        for suffix, drop in (("", False), ("_outlier_removed", True)):
            assign, search, _ = clustering.cluster_analysis(joined, remove_outliers=drop)
            save(assign, f"clusters{suffix}")
            if search is not None:
                save(search, f"cluster_k_search{suffix}")
        save(clustering.split_dendrogram(joined), "dendrogram")
    joined.unpersist()
    return written


def _fit(prepared, model_type: str, train_ratio: float):
    scores, model, n = fit_and_score(prepared.data, prepared.variables, "response", model_type, train_ratio)
    return scores, n, model


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--lines", help="retail lines CSV (header)")
    ap.add_argument("--campaign", help="campaign responses CSV (header)")
    ap.add_argument("--sf-dir", help="read the driver tables instead of CSVs")
    ap.add_argument("--out", required=True)
    ap.add_argument("--steps", default=",".join(STEPS))
    ap.add_argument("--models", default=None, help="comma list of model types")
    ap.add_argument("--configs", default=None, help="comma list of configurations")
    ap.add_argument("--train-ratio", type=float, default=0.7)
    ap.add_argument("--monthly-cutoff", default=None)
    ap.add_argument("--policy", action="append", default=[], metavar="COLUMN=POLICY",
                    help="missing values of a column: delete, default or keep (repeatable; default keep)")
    ap.add_argument("--id-policy", default="delete", choices=("delete", "generate"), help="rows without an identifier")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    from ..session import get_spark
    spark = get_spark(a.master)
    if a.sf_dir:
        lines, campaign = fx.lines_dirty(spark, a.sf_dir), fx.campaign(spark, a.sf_dir)
    else:
        lines, bad_lines = io.read_csv_quarantine(spark, a.lines, LINES_RAW)
        campaign, bad_campaign = io.read_csv_quarantine(spark, a.campaign, CAMPAIGN_RAW, ("n_comp", "n_communications"))
        for df, name in ((bad_lines, "rejected_lines"), (bad_campaign, "rejected_campaign")):
            print(_write(df, a.out, name))
    policies = dict(p.split("=", 1) for p in a.policy)
    split = lambda s: [x for x in s.split(",") if x] if s else None
    for p in run(spark, a.out, lines, campaign, split(a.steps), split(a.models), split(a.configs),
                 a.train_ratio, a.monthly_cutoff, a.id_policy, policies or None):
        print(p)


if __name__ == "__main__":
    main()
