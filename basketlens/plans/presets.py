"""Modelling configurations as pipeline presets (J8-J12, J17-J19) and the full pipeline (entry 1).

Each configuration is ``prepared frame -> (variables, model-ready frame)``:
J1 preparation, optional recoded ratios, optional sequential IQR removal,
VIF elimination from one Gram pass, dependent-column removal (D23), logit
significance; then any model type runs on the selected variables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.binning import bin_numerical_variables
from ..operators.campaign import join_customer_campaign
from ..operators.features import customer_features
from ..operators.modeling import (MODEL_TYPES, add_ratios, fit_and_score, numeric_model_columns, preprocess_for_model,
                                  run_model, run_table)
from ..operators.stats import dependent_columns, gram, logit_significance, vif_elimination
from ..operators.typing import convert_campaign_data_types, convert_data_types
from ..session import cut_lineage, shared_folder

CONFIGS = ("baseline", "recoded", "outlier_removed", "outlier_recoded_scaled")
# Model types whose runs are the longest chains of jobs.
LONGEST = ("svm", "svm_linear", "random_forest")


@dataclass
class Prepared:
    config: str
    data: DataFrame
    variables: list
    vif: DataFrame
    vif_log: DataFrame
    significance: DataFrame
    outliers: DataFrame | None = None
    notes: list = field(default_factory=list)
    cached: list = field(default_factory=list)

    def release(self) -> None:
        """Give up the cached rows; the tables can still be read, at the cost of computing them again."""
        for df in self.cached:
            df.unpersist()

    def table(self, response: str = "response") -> DataFrame:
        """The selected variables plus the response (J18's prepared table)."""
        return self.data.select(*self.variables, response)


@dataclass(frozen=True)
class ModelReady:
    """A joined customer table after ``preprocess_for_model``, which many preparations start from."""

    data: DataFrame


def _select_variables(df: DataFrame, response: str, vif_threshold: float = 5.0):
    cands = numeric_model_columns(df, response, wide_only=False)
    g = gram(df, cands, constant=True)  # one pass serves VIF and the dependence check
    kept, vif_df, vif_log = vif_elimination(df, cands, vif_threshold, gram_result=g)
    dropped = dependent_columns(df, kept, gram_result=g)
    kept = [c for c in kept if c not in dropped]
    significant, table = logit_significance(df, kept, response)
    return kept, significant, vif_df, vif_log, table, dropped


def prepare(joined: DataFrame | ModelReady, config: str = "baseline", response: str = "response",
            model_type: str | None = None) -> Prepared:
    """Configuration preset (J9-J12, J18) on the joined customer table."""
    if config not in CONFIGS:
        raise ValueError(f"unknown configuration {config!r}")
    df = joined.data if isinstance(joined, ModelReady) else preprocess_for_model(joined, response)
    if model_type == "decision_tree_binned":
        df = bin_numerical_variables(df, response)
    if config in ("recoded", "outlier_recoded_scaled"):
        df = add_ratios(df)
    outliers, unfiltered = None, None
    if config in ("outlier_removed", "outlier_recoded_scaled"):
        # every step of the filter reads its input again
        df = unfiltered = df.persist(StorageLevel.MEMORY_AND_DISK)
        df, outliers = quality.iqr_filter(df, numeric_model_columns(df, response), mode="sequential")
    df = cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept, significant, vif_df, vif_log, table, dropped = _select_variables(df, response)
    if model_type == "decision_tree_binned_after":
        df = bin_numerical_variables(df, response)
    notes = [f"dependent column removed before the logit: {c}" for c in dropped]
    return Prepared(config, df, significant, vif_df, vif_log, table, outliers, notes,
                    [c for c in (cached, unfiltered) if c is not None])


def run_configuration(joined: DataFrame, config: str, model_type: str, train_ratio: float = 0.7,
                      response: str = "response", params: dict | None = None):
    """Prepare + fit + evaluate one (configuration, model) pair; returns (metrics row, Prepared).

    ``params`` overrides estimator settings (e.g. ``{"maxDepth": 12}`` for trees at scale).
    """
    p = prepare(joined, config, response, model_type)
    if not p.variables:
        raise ValueError(f"{config}: no significant variables")
    metrics, _ = run_model(p.data, p.variables, response, config, model_type, train_ratio, params=params)
    return metrics, p


def sweep(joined: DataFrame, models: Sequence[str] = MODEL_TYPES, configs: Sequence[str] = CONFIGS,
          train_ratio: float = 0.7, response: str = "response", parallelism: int = 4) -> DataFrame:
    """Every model type under every configuration (J19); one metrics row per run.

    Each run only fits and writes its scores (configuration, model_type, split, label, prediction, score)
    to the shared folder; ONE keyed evaluation over that table then gives all metrics. Runs are chains of
    small jobs, so configurations run concurrently, and so do the model types within one, the longest first.
    The model-ready table that all start from is made once and its plan cut off, since every job and its
    plan would carry that of the lines. The prepared frame is
    shared by all model types except the tree that is binned first, which needs its own; the one binned
    after bins the shared frame. Frames are released at the end.
    """
    from concurrent.futures import ThreadPoolExecutor

    folder = shared_folder(joined.sparkSession, "scores")
    ready = ModelReady(cut_lineage(preprocess_for_model(joined, response)).persist(StorageLevel.MEMORY_AND_DISK))

    def run_config(c):
        binned_first = "decision_tree_binned"
        keys = list(dict.fromkeys(m if m == binned_first else None for m in models))
        shared = {}

        def run(m):
            p = shared[m if m == binned_first else None]
            if not p.variables:
                return None
            data = bin_numerical_variables(p.data, response) if m == "decision_tree_binned_after" else p.data
            scores, _, n = fit_and_score(data, p.variables, response, m, train_ratio)
            scores.write.parquet(f"{folder}/configuration={c}/model_type={m}")
            return c, m, list(p.variables), n

        try:
            with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(models)))) as each:
                for key, p in zip(keys, each.map(lambda k: prepare(ready, c, response, k), keys)):
                    shared[key] = p
                return [r for r in each.map(run, sorted(models, key=lambda m: m not in LONGEST)) if r]
        finally:
            for p in shared.values():
                p.release()

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            runs = [r for done in pool.map(run_config, list(configs)) for r in done]
    finally:
        ready.data.unpersist()
    if not runs:
        raise ValueError("no configuration has significant variables")
    schema = "split string, label double, prediction double, score double, configuration string, model_type string"
    return run_table(joined.sparkSession.read.schema(schema).parquet(folder), runs)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest run per (configuration, model) (G6): the newest, and of equally new ones the largest run id."""
    w = Window.partitionBy("configuration", "model").orderBy(F.desc("run_ts"), F.desc("run_id"))
    return runs.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def metric_grid(runs: DataFrame, metric: str) -> DataFrame:
    """configuration x model grid of one metric, missing cells 0 (D-J5, J17)."""
    return (latest_runs(runs).groupBy("configuration").pivot("model").agg(F.first(metric)).fillna(0))


# The four metrics the reference charts per configuration x model.
COMPARISON_METRICS = ("train_auc", "test_auc", "test_accuracy", "overfitting_accuracy_gap")


def comparison_table(runs: DataFrame, metrics=COMPARISON_METRICS) -> DataFrame:
    """(configuration, model, metric, value) of the latest run per pair, for the charted metrics."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return latest_runs(runs).select("configuration", "model", F.inline(pairs))


LOG_KEYS = ("configuration", "model_type", "run_id")


def append_runs(runs: DataFrame, path: str) -> None:
    """Add metric rows to the run log (A7), a Parquet table with a folder per (configuration, model, run id).

    The run id is a hash of the run's content, and only the folders written to are replaced, so a run that is
    written again (a retried job, a second call) is in the log once.
    """
    runs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LOG_KEYS).parquet(path)


def read_runs(spark, path: str) -> DataFrame:
    """The run log as written by ``append_runs``."""
    log = spark.read.option("mergeSchema", "false").parquet(path)
    return log.withColumns({k: F.col(k).cast("string") for k in LOG_KEYS})


def full_pipeline(raw_lines: DataFrame, raw_campaign: DataFrame, policies: dict | None = None,
                  id_policy: str = "delete", partitions: int | None = None) -> DataFrame:
    """Entry 1: type -> repair -> integrity -> features -> join (returns the joined table).
    ``partitions``: see ``customer_aggregates``."""
    lines = convert_data_types(raw_lines)
    campaign = convert_campaign_data_types(raw_campaign)
    lines = quality.process_missing_data(lines, policies, default_policy="keep", id_policy=id_policy)
    campaign = quality.process_missing_data(campaign, policies, default_policy="keep", id_policy=id_policy)
    lines, campaign = quality.perform_integrity_checks(lines, campaign)
    return join_customer_campaign(customer_features(lines, partitions=partitions), campaign)
