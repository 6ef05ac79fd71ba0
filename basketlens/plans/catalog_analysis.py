"""Registered analysis queries: correlation, box plots, histograms, IQR filters, QQ, model prep,
model bins, score evaluation (with DuckDB oracles) and the model / clustering runs (rows-only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import snake_case
from ..operators import clustering, eda, evaluation, quality, stats
from ..operators.binning import (fit_model_edges, fit_recode_edges, model_bin_code, recode_boolean,
                                 recode_levels)
from ..operators.exact_tree import fit_exact_tree
from ..operators.features import customer_aggregates
from ..operators.modeling import (MODEL_TYPES, feature_importances, numeric_model_columns, preprocess_for_model,
                                  run_model, tree_nodes)
from ..operators.naive_bayes import fit_naive_bayes
from ..operators.quantiles import group_quantiles
from ..session import shared_folder
from ..sources import fixtures as fx
from ..sources.schemas import BIN_SOURCES
from . import presets
from . import sql as S
from .catalog import (CAMPAIGN_TYPED_SQL, FEATURE_ROUND, JOINED_COLUMNS, JOINED_CTES, R, _shared, joined, register,
                      rounded, typed_campaign)

# ---------------------------------------------------------------------------
# Encoded joined table
# ---------------------------------------------------------------------------

ENC_COLUMNS = [c for c in JOINED_COLUMNS if c not in eda.NON_INFORMATIVE]
_BIN_CASE = " ".join(f"WHEN '{lv}' THEN {i}" for i, lv in enumerate(eda.BIN_LEVELS))


def _enc_expr(c: str) -> str:
    if c.endswith("_bin"):
        return f"CAST(CASE {c} {_BIN_CASE} ELSE -1 END AS DOUBLE) AS {c}"
    if c == "nps":
        return "CAST(coalesce(nps, -1) AS DOUBLE) AS nps"
    if c == "response":
        return "CAST(CAST(response AS INTEGER) AS DOUBLE) AS response"
    return f"CAST({c} AS DOUBLE) AS {c}"


ENC_CTES = JOINED_CTES + [("enc", f"SELECT {', '.join(_enc_expr(c) for c in ENC_COLUMNS)} FROM joined")]


def encoded(spark, sf):
    return eda.encode_for_correlation(joined(spark, sf).select(*JOINED_COLUMNS))


def _corr_sql() -> tuple[str, list]:
    aggs, names = [], []
    for i, a in enumerate(ENC_COLUMNS):
        for j, b in enumerate(ENC_COLUMNS):
            if i < j:
                nn = f"{a} IS NOT NULL AND {b} IS NOT NULL"
                aggs.append(f"covar_pop({a}, {b}) / nullif((stddev_pop({a}) FILTER (WHERE {nn})) * "
                            f"(stddev_pop({b}) FILTER (WHERE {nn})), 0) AS \"{a}|{b}\"")
                names.append(f'"{a}|{b}"')
    diag = " UNION ALL ".join(f"SELECT '{a}', '{a}', 1.0" for a in ENC_COLUMNS)
    body = f"""
SELECT var_x, var_y, {R('corr', 9)} AS corr FROM (
  SELECT split_part(k, '|', 1) AS var_x, split_part(k, '|', 2) AS var_y, v AS corr FROM cl
  UNION ALL SELECT split_part(k, '|', 2), split_part(k, '|', 1), v FROM cl
  UNION ALL {diag}) t"""
    ctes = [("cw", f"SELECT {', '.join(aggs)} FROM enc"),
            ("cl", f"SELECT k, v FROM cw UNPIVOT INCLUDE NULLS (v FOR k IN ({', '.join(names)}))")]
    return body, ctes


_corr_body, _corr_ctes = _corr_sql()


@register("correlation_matrix", S.statement(_corr_body, ["lines", "campaign"], ENC_CTES + _corr_ctes))
def q_corr(spark, sf):
    """Pearson correlation of every encoded pair, one aggregation."""
    return rounded(eda.correlation_matrix(joined(spark, sf).select(*JOINED_COLUMNS)), {"corr": 9})


def _inlier_ctes(source: str, variables, name: str) -> list:
    """CTEs ending in ``name``: ``source`` with each variable's values outside its own 1.5 IQR bounds NULL."""
    cells = ", ".join(f"CASE WHEN {v} BETWEEN {v}_1 - 1.5 * ({v}_3 - {v}_1) AND {v}_3 + 1.5 * ({v}_3 - {v}_1) THEN {v} END AS {v}" for v in variables)
    quartiles = ", ".join(f"quantile_cont(CAST({v} AS DOUBLE), 0.25) AS {v}_1, quantile_cont(CAST({v} AS DOUBLE), 0.75) AS {v}_3" for v in variables)
    return [(f"{name}_q", f"SELECT {quartiles} FROM {source}"), (name, f"SELECT {source}.* REPLACE ({cells}) FROM {source}, {name}_q")]


def _renamed(ctes: list, old: str, new: str) -> list:
    return [(n, text.replace(f"FROM {old}", f"FROM {new}")) for n, text in ctes]


# ---------------------------------------------------------------------------
# Box plots (E13), histograms (E14), IQR filters
# ---------------------------------------------------------------------------

_BOX_VARS = list(eda.BOXPLOT_VARIABLES)
_BOX_ROUND = {c: 4 for c in ("min", "q1", "median", "q3", "whisker_low", "whisker_high", "max")}


def _box_sql() -> str:
    casts = ", ".join(f"CAST({v} AS DOUBLE) AS {v}" for v in _BOX_VARS)
    inside = "v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    sel = {"min": "min(v)", "q1": "q1", "median": "med", "q3": "q3",
           "whisker_low": f"min(CASE WHEN {inside} THEN v END)", "whisker_high": f"max(CASE WHEN {inside} THEN v END)",
           "max": "max(v)"}
    cols = ", ".join(f"{R(e, 4)} AS {k}" for k, e in sel.items())
    return f"""
SELECT bl.variable, bl.response, CAST(count(*) AS BIGINT) AS n, {cols},
       CAST(count_if(NOT ({inside})) AS BIGINT) AS n_outliers
FROM bl JOIN bq ON bl.variable = bq.variable AND bl.response = bq.response
GROUP BY bl.variable, bl.response, q1, med, q3""", [
        ("bl", f"SELECT variable, response, v FROM (UNPIVOT (SELECT response, {casts} FROM joined) "
               f"ON {', '.join(_BOX_VARS)} INTO NAME variable VALUE v) WHERE v IS NOT NULL"),
        ("bq", "SELECT variable, response, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, "
               "quantile_cont(v, 0.75) AS q3 FROM bl GROUP BY variable, response")]


_box_body, _box_ctes = _box_sql()


@register("boxplot_summary", S.statement(_box_body, ["lines", "campaign"], JOINED_CTES + _box_ctes))
def q_box(spark, sf):
    """Five-number summaries, whiskers and outlier counts by response for 13 variables."""
    return rounded(eda.boxplot_summary(joined(spark, sf), _BOX_VARS), _BOX_ROUND)


_box_inlier_ctes = (JOINED_CTES + [("joinedd", "SELECT response, " + ", ".join(f"CAST({v} AS DOUBLE) AS {v}" for v in _BOX_VARS) + " FROM joined")]
                    + _inlier_ctes("joinedd", _BOX_VARS, "joinedi") + _renamed(_box_ctes, "joined", "joinedi"))


@register("boxplot_summary_without_outliers", S.statement(_box_body, ["lines", "campaign"], _box_inlier_ctes))
def q_box_inliers(spark, sf):
    """The summaries with each variable's outliers left out first."""
    return rounded(eda.boxplot_summary(joined(spark, sf), _BOX_VARS, outliers_included=False), _BOX_ROUND)


@register("product_line_quantiles", S.statement(f"""
SELECT StockCode, variable, CAST(count(v) AS BIGINT) AS n, {R('quantile_cont(v, 0.25)', 4)} AS q1, {R('quantile_cont(v, 0.5)', 4)} AS median,
       {R('quantile_cont(v, 0.75)', 4)} AS q3
FROM (SELECT StockCode, 'Quantity' AS variable, CAST(Quantity AS DOUBLE) AS v FROM lines
      UNION ALL SELECT StockCode, 'UnitPrice', UnitPrice FROM lines) t GROUP BY StockCode, variable""", ["lines"]))
def q_product_quantiles(spark, sf):
    """Exact quartiles of quantity and price of every product; nothing per product reaches the driver."""
    values = ["Quantity", "UnitPrice"]
    q = group_quantiles(fx.lines(spark, sf), values, ["StockCode"], [0.25, 0.5, 0.75], len(values) * fx.line_partitions(spark, sf))
    return rounded(q.select("StockCode", "variable", "n", *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]),
                   {"q1": 4, "median": 4, "q3": 4})


@register("median_fill_nps", S.statement(
    "SELECT CustomerID, coalesce(nps, CAST(m AS INTEGER)) AS nps FROM ctyped CROSS JOIN (SELECT quantile_cont(nps, 0.5) AS m FROM ctyped) mm",
    ["campaign"], [("ctyped", CAMPAIGN_TYPED_SQL)]))
def q_median_fill(spark, sf):
    """C17: missing NPS scores filled with the exact median."""
    return quality.median_fill(typed_campaign(spark, sf).select("CustomerID", "nps"), ["nps"])


_HIST_VARS = list(eda.BAR_CHART_FEATURES)


def _hist_sql() -> str:
    parts = []
    for v in _HIST_VARS:
        b = f"least(CAST(floor(({v} - lo) / (hi - lo) * 30) AS BIGINT) + 1, 30)"
        bucket = f"CASE WHEN hi = lo THEN 1 ELSE {b} END"
        parts.append(f"SELECT '{v}' AS variable, {bucket} AS bucket, response, lo, hi FROM joined, "
                     f"(SELECT CAST(min({v}) AS DOUBLE) AS lo, CAST(max({v}) AS DOUBLE) AS hi FROM joined) mm "
                     f"WHERE {v} IS NOT NULL")
    return f"""
SELECT variable, bucket, response, CAST(count(*) AS BIGINT) AS count,
       {R('any_value(lo) + (bucket - 1) * (any_value(hi) - any_value(lo)) / 30', 4)} AS bucket_start
FROM ({' UNION ALL '.join(parts)}) t GROUP BY variable, bucket, response"""


@register("stacked_histogram", S.statement(_hist_sql(), ["lines", "campaign"], JOINED_CTES))
def q_hist(spark, sf):
    """30-bucket histograms of six features split by response."""
    return rounded(eda.stacked_histogram(joined(spark, sf), _HIST_VARS), {"bucket_start": 4})


_IQR_VARS = [v for v in _BOX_VARS if v != "nps"]


def _iqr_sql(mode: str) -> tuple[str, list]:
    ctes = [("f0", f"SELECT CustomerID, {', '.join(_IQR_VARS)} FROM joined")]
    if mode == "sequential":
        for i, c in enumerate(_IQR_VARS):
            ctes.append((f"iq{i}", f"SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM f{i}"))
            ctes.append((f"f{i + 1}", f"SELECT f{i}.* FROM f{i}, iq{i} WHERE iq{i}.q1 IS NULL OR "
                                      f"{c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"))
        last = f"f{len(_IQR_VARS)}"
    else:
        qs = ", ".join(f"quantile_cont({c}, 0.25) AS a{i}, quantile_cont({c}, 0.75) AS b{i}"
                       for i, c in enumerate(_IQR_VARS))
        ctes.append(("iq", f"SELECT {qs} FROM f0"))
        conds = " AND ".join(f"{c} BETWEEN a{i} - 1.5 * (b{i} - a{i}) AND b{i} + 1.5 * (b{i} - a{i})"
                             for i, c in enumerate(_IQR_VARS))
        ctes.append(("f1", f"SELECT f0.* FROM f0, iq WHERE {conds}"))
        last = "f1"
    return f"SELECT {S.select_list(['CustomerID', *_IQR_VARS], FEATURE_ROUND)} FROM {last}", ctes


for _mode in ("sequential", "simultaneous"):
    _b, _c = _iqr_sql(_mode)

    def _make(mode):
        def q(spark, sf):
            df = joined(spark, sf).select("CustomerID", *_IQR_VARS)
            out, _ = quality.iqr_filter(df, _IQR_VARS, mode=mode)
            return rounded(out, FEATURE_ROUND)
        q.__doc__ = f"C19, D12: IQR outlier filter, {mode} bounds, over 12 numeric columns."
        return q

    register(f"iqr_filter_{_mode}", S.statement(_b, ["lines", "campaign"], JOINED_CTES + _c))(_make(_mode))


_seq_body, _seq_ctes = _iqr_sql("sequential")
_report_sql = " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS step, '{c}' AS \"column\", {R('q1 - 1.5 * (q3 - q1)', 4)} AS lower, "
    f"{R('q3 + 1.5 * (q3 - q1)', 4)} AS upper, "
    f"CAST((SELECT count(*) FROM f{i}) - (SELECT count(*) FROM f{i + 1}) AS BIGINT) AS removed, "
    f"CAST((SELECT count(*) FROM f{i + 1}) AS BIGINT) AS remaining FROM iq{i}" for i, c in enumerate(_IQR_VARS))


@register("iqr_filter_report", S.statement(_report_sql, ["lines", "campaign"], JOINED_CTES + _seq_ctes))
def q_iqr_report(spark, sf):
    """C20: per-step bounds, removed and remaining rows of the sequential IQR filter."""
    df = joined(spark, sf).select("CustomerID", *_IQR_VARS)
    return rounded(quality.iqr_filter(df, _IQR_VARS, mode="sequential")[1], {"lower": 4, "upper": 4})


# ---------------------------------------------------------------------------
# QQ plots (H1)
# ---------------------------------------------------------------------------

_QQ_VARS = [c for c in ENC_COLUMNS if c != "response"]


def _qq_ctes() -> list:
    fil = ("CASE WHEN rank = n THEN pow(0.5, 1.0 / n) WHEN rank = 1 THEN 1.0 - pow(0.5, 1.0 / n) "
           "ELSE (rank - 0.3175) / (n + 0.365) END")
    return ENC_CTES + [
        ("ql", f"SELECT variable, v FROM (UNPIVOT (SELECT {', '.join(_QQ_VARS)} FROM enc) ON {', '.join(_QQ_VARS)} "
               f"INTO NAME variable VALUE v) WHERE v IS NOT NULL"),
        ("qr", "SELECT variable, v AS value, row_number() OVER (PARTITION BY variable ORDER BY v) AS rank, "
               "count(*) OVER (PARTITION BY variable) AS n FROM ql"),
        ("qp", f"SELECT variable, CAST(rank AS BIGINT) AS rank, CAST(n AS BIGINT) AS n, value, "
               f"{S.norm_ppf_sql(fil)} AS theoretical FROM qr"),
    ]


@register("qq_points", S.statement(
    f"SELECT variable, rank, n, {R('value', 4)} AS value, {R('theoretical', 9)} AS theoretical FROM qp",
    ["lines", "campaign"], _qq_ctes()))
def q_qq(spark, sf):
    """H1: normal probability plot points of every encoded variable (global ranks, no single-task window)."""
    return rounded(stats.qq_points(encoded(spark, sf), _QQ_VARS), {"value": 4, "theoretical": 9})


_QQ_FIT_SQL = f"""
SELECT variable, {R('slope', 4)} AS slope, {R('avg_v - slope * avg_t', 4)} AS intercept, {R('r', 9)} AS r, n FROM (
  SELECT variable, covar_pop(value, theoretical) / nullif(var_pop(theoretical), 0) AS slope,
         avg(value) AS avg_v, avg(theoretical) AS avg_t,
         covar_pop(value, theoretical) / nullif(stddev_pop(value) * stddev_pop(theoretical), 0) AS r,
         CAST(count(*) AS BIGINT) AS n
  FROM qp GROUP BY variable) t"""


@register("qq_fit", S.statement(_QQ_FIT_SQL, ["lines", "campaign"], _qq_ctes()))
def q_qq_fit(spark, sf):
    """H1: least-squares fit line and r of each QQ plot."""
    pts = stats.qq_points(encoded(spark, sf), _QQ_VARS)
    return rounded(stats.qq_fit(pts), {"slope": 4, "intercept": 4, "r": 9})


@register("qq_fit_without_outliers", S.statement(
    _QQ_FIT_SQL, ["lines", "campaign"],
    ENC_CTES + _inlier_ctes("enc", _QQ_VARS, "enci") + _renamed(_qq_ctes()[len(ENC_CTES):], "enc", "enci")))
def q_qq_fit_inliers(spark, sf):
    """H1: the fit lines with each variable's outliers left out."""
    pts = stats.qq_points(encoded(spark, sf), _QQ_VARS, outliers_included=False)
    return rounded(stats.qq_fit(pts), {"slope": 4, "intercept": 4, "r": 9})


# ---------------------------------------------------------------------------
# Model preparation (J1) and model binning (F2)
# ---------------------------------------------------------------------------

_PREP_CTES = JOINED_CTES + [
    ("p0", "SELECT joined.*, CAST(date_sub('day', first_purchase, last_purchase) AS DOUBLE) AS ctd0, "
           "CAST(date_sub('day', last_purchase, gm.g) AS DOUBLE) AS rd0 "
           "FROM joined, (SELECT max(last_purchase) AS g FROM joined) gm"),
    ("p1", "SELECT p0.*, coalesce(ctd0, (SELECT quantile_cont(ctd0, 0.5) FROM p0)) AS ctd1, "
           "coalesce(rd0, (SELECT quantile_cont(rd0, 0.5) FROM p0)) AS rd1 FROM p0"),
    ("ps", "SELECT avg(ctd1) AS mc, coalesce(nullif(stddev_pop(ctd1), 0), 1) AS sc, "
           "avg(rd1) AS mr, coalesce(nullif(stddev_pop(rd1), 0), 1) AS sr FROM p1"),
]
_PREP_COLS = [c for c in JOINED_COLUMNS if c not in ("first_purchase", "last_purchase")] + \
    ["customer_tenure_days", "recency_days"]


def _prep_expr(c: str) -> str:
    if c in BIN_SOURCES:
        return f"CAST(CASE coalesce({c}, 'Unknown') {_BIN_CASE} ELSE 4 END AS TINYINT) AS {c}"
    if c in ("loyalty", "nps"):
        return f"CAST(coalesce({c}, 0) AS INTEGER) AS {c}"
    if c == "customer_tenure_days":
        return "coalesce((ctd1 - mc) / sc, 0) AS customer_tenure_days"
    if c == "recency_days":
        return "coalesce((rd1 - mr) / sr, 0) AS recency_days"
    if c in ("CustomerID", "response"):
        return c
    return f"coalesce({c}, 0) AS {c}"


_PREP_CTES = _PREP_CTES + [("prep", f"SELECT {', '.join(_prep_expr(c) for c in _PREP_COLS)} FROM p1, ps")]
_PREP_ROUND = dict(FEATURE_ROUND, customer_tenure_days=9, recency_days=9)


def prepared(spark, sf):
    return preprocess_for_model(joined(spark, sf).select(*JOINED_COLUMNS))


@register("model_prep", S.statement(f"SELECT {S.select_list(_PREP_COLS, _PREP_ROUND)} FROM prep",
                                    ["lines", "campaign"], _PREP_CTES))
def q_prep(spark, sf):
    """Model preparation (day columns scaled, categorical codes, NULL/inf -> 0)."""
    return rounded(prepared(spark, sf), _PREP_ROUND).select(*_PREP_COLS)


_F2_VARS = [c for c in _PREP_COLS if c not in BIN_SOURCES and c not in ("CustomerID", "response")]


def _f2_sql():
    parts, ctes = [], []
    for i, c in enumerate(_F2_VARS):
        ctes.append((f"mq{i}", f"SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM prep"))
        ctes.append((f"me{i}", f"SELECT quantile_cont({c}, 0.25) AS e1, quantile_cont({c}, 0.5) AS e2, "
                               f"quantile_cont({c}, 0.75) AS e3 FROM prep, mq{i} "
                               f"WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"))
        code = (f"CASE WHEN {c} <= e1 THEN 1 WHEN {c} <= e2 THEN 2 WHEN {c} <= e3 THEN 0 "
                f"WHEN {c} IS NOT NULL THEN 3 ELSE 4 END")
        parts.append(f"SELECT CustomerID, '{c}' AS variable, CAST({code} AS BIGINT) AS code FROM prep, me{i} "
                     f"WHERE e1 < e2 AND e2 < e3")
    return " UNION ALL ".join(parts), ctes


_f2_body, _f2_ctes = _f2_sql()


@register("model_bins", S.statement(_f2_body, ["lines", "campaign"], _PREP_CTES + _f2_ctes))
def q_model_bins(spark, sf):
    """Quartile bins of the inliers with open ends, lexical codes, per prepared numeric column."""
    df = prepared(spark, sf)
    edges = fit_model_edges(df, _F2_VARS)
    structs = [F.struct(F.lit(c).alias("variable"), model_bin_code(c, e).cast("bigint").alias("code"))
               for c, e in edges.items() if e]
    return df.select("CustomerID", F.inline(F.array(*structs)))


# ---------------------------------------------------------------------------
# Score evaluation (E15, G4, G5, J14, J15) on a data-derived rule
# ---------------------------------------------------------------------------

_SCORE_CTES = JOINED_CTES + [
    ("sc", "SELECT CAST(CAST(response AS INTEGER) AS DOUBLE) AS label, "
           "CASE WHEN total_sales_bin IN ('High', 'Very High') THEN 1.0 ELSE 0.0 END AS prediction, "
           "total_spending AS score FROM joined"),
    ("rd", "SELECT score AS threshold, CAST(count_if(label = 1) AS BIGINT) AS pos, "
           "CAST(count_if(label <> 1) AS BIGINT) AS neg FROM sc GROUP BY score"),
    ("rp", "SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, "
           "sum(neg) OVER (ORDER BY threshold DESC) AS fp, P, N FROM rd, "
           "(SELECT sum(pos) AS P, sum(neg) AS N FROM rd) t"),
]


def _score_frame(spark, sf):
    j = joined(spark, sf)
    return j.select(F.col("response").cast("int").cast("double").alias("label"),
                    F.when(F.col("total_sales_bin").isin("High", "Very High"), 1.0).otherwise(0.0).alias("prediction"),
                    F.col("total_spending").alias("score"))


@register("roc_points", S.statement(f"""
SELECT {R('threshold', 2)} AS threshold, pos, neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) AS tpr, CAST(fp AS DOUBLE) / CAST(N AS DOUBLE) AS fpr,
       CAST(P AS BIGINT) AS P, CAST(N AS BIGINT) AS N FROM rp
UNION ALL
SELECT CAST('inf' AS DOUBLE), 0, 0, 0, 0, 0.0, 0.0, CAST(sum(pos) AS BIGINT), CAST(sum(neg) AS BIGINT) FROM rd""",
                                  ["lines", "campaign"], _SCORE_CTES))
def q_roc(spark, sf):
    """ROC points of total spending as a response score (running sums without a single-task window)."""
    return rounded(evaluation.roc_points(_score_frame(spark, sf)), {"threshold": 2})


def _evaluation_sql(keys: str = "") -> str:
    """Metrics of table ``sc`` (label, prediction, score) per ``keys`` (comma-separated, or none)."""
    k = f"{keys}, " if keys else ""
    by = f"GROUP BY {keys}" if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    using = f"USING ({keys})" if keys else "ON true"
    return f"""
SELECT {k}tn, fp, fn, tp, CAST(tp + tn AS DOUBLE) / CAST(tp + tn + fp + fn AS DOUBLE) AS accuracy,
       sens AS sensitivity, spec AS specificity, (sens + spec) / 2 AS balanced_accuracy, prec AS precision,
       sens AS recall, coalesce(2 * prec * sens / nullif(prec + sens, 0), 0.0) AS f1, auc,
       {R('best_threshold', 2)} AS best_threshold
FROM (
  SELECT {k}tn, fp, fn, tp,
         coalesce(CAST(tp AS DOUBLE) / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS sens,
         coalesce(CAST(tn AS DOUBLE) / nullif(CAST(tn + fp AS DOUBLE), 0), 0.0) AS spec,
         coalesce(CAST(tp AS DOUBLE) / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS prec
  FROM (SELECT {k}CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
               CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
               CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn,
               CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp FROM sc {by}) c) m
JOIN (SELECT {k}sum(neg * (tp - pos / 2.0)) / (any_value(P) * any_value(N)) AS auc FROM rp {by}) a {using}
JOIN (SELECT {k}threshold AS best_threshold FROM rp QUALIFY row_number() OVER ({part}ORDER BY
      CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) - CAST(fp AS DOUBLE) / CAST(N AS DOUBLE) DESC, threshold DESC) = 1) b {using}"""


@register("score_evaluation", S.statement(_evaluation_sql(), ["lines", "campaign"], _SCORE_CTES))
def q_score_eval(spark, sf):
    """Confusion matrix, accuracy family, AUC and Youden threshold of a spending rule."""
    return rounded(evaluation.evaluate(_score_frame(spark, sf)), {"best_threshold": 2})


# The rules "above the column's upper two bins" as scores, for customers with and without a loyalty card.
_RULES = {"spending": ("total_sales_bin", "total_spending"), "quantity": ("total_quantity_bin", "total_quantity"),
          "order_value": ("avg_order_value_bin", "avg_order_value"), "tenure": ("customer_tenure_bin", "customer_tenure")}
_RULE_CTES = JOINED_CTES + [
    ("sc", " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, loyalty, CAST(CAST(response AS INTEGER) AS DOUBLE) AS label, "
        f"CASE WHEN {level} IN ('High', 'Very High') THEN 1.0 ELSE 0.0 END AS prediction, "
        f"CAST({score} AS DOUBLE) AS score FROM joined" for rule, (level, score) in _RULES.items())),
    ("rd", "SELECT rule, loyalty, score AS threshold, CAST(count_if(label = 1) AS BIGINT) AS pos, "
           "CAST(count_if(label <> 1) AS BIGINT) AS neg FROM sc GROUP BY rule, loyalty, score"),
    ("rp", "SELECT *, sum(pos) OVER (PARTITION BY rule, loyalty ORDER BY threshold DESC) AS tp, "
           "sum(neg) OVER (PARTITION BY rule, loyalty ORDER BY threshold DESC) AS fp, "
           "sum(pos) OVER (PARTITION BY rule, loyalty) AS P, sum(neg) OVER (PARTITION BY rule, loyalty) AS N FROM rd"),
]


@register("score_evaluation_by_rule", S.statement(_evaluation_sql("rule, loyalty"), ["lines", "campaign"], _RULE_CTES))
def q_score_eval_by(spark, sf):
    """The metrics of four scoring rules for two customer groups from one keyed evaluation."""
    each = [F.struct(F.lit(rule).alias("rule"), F.when(F.col(level).isin("High", "Very High"), 1.0).otherwise(0.0).alias("prediction"),
                     F.col(score).cast("double").alias("score")) for rule, (level, score) in _RULES.items()]
    scores = joined(spark, sf).select("loyalty", F.col("response").cast("int").cast("double").alias("label"), F.inline(F.array(*each)))
    return rounded(evaluation.evaluate_by(scores, ["rule", "loyalty"]), {"best_threshold": 2})


# ---------------------------------------------------------------------------
# Naive Bayes from statistics (J5) and exact split search
# ---------------------------------------------------------------------------

_NB_VARS = ("total_spending", "num_orders", "recency", "customer_tenure", "n_comp")


def _nb_sql():
    stats = ", ".join(f"avg({v}) FILTER (response) AS m1_{v}, avg({v}) FILTER (NOT response) AS m0_{v}, "
                      f"var_pop({v}) FILTER (response) AS v1_{v}, var_pop({v}) FILTER (NOT response) AS v0_{v}, "
                      f"var_pop({v}) AS v_{v}" for v in _NB_VARS)
    widest = f"greatest({', '.join(f'v_{v}' for v in _NB_VARS)})"

    def joint(c):
        return f"ln(n{c} / (n0 + n1))" + "".join(
            f" - 0.5 * ln(2 * pi() * (v{c}_{v} + 1e-9 * {widest})) - ({v} - m{c}_{v}) ** 2 / (2 * (v{c}_{v} + 1e-9 * {widest}))" for v in _NB_VARS)

    return (f"SELECT CustomerID, {R(f'1 / (1 + exp(({joint(0)}) - ({joint(1)})))', 9)} AS score, "
            f"CASE WHEN ({joint(1)}) > ({joint(0)}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM prep, nbs",
            [("nbs", f"SELECT CAST(count_if(response) AS DOUBLE) AS n1, CAST(count_if(NOT response) AS DOUBLE) AS n0, {stats} FROM prep")])


_nb_body, _nb_ctes = _nb_sql()


@register("naive_bayes_scores", S.statement(_nb_body, ["lines", "campaign"], _PREP_CTES + _nb_ctes))
def q_naive_bayes(spark, sf):
    """P(response) of every customer by Gaussian naive Bayes fitted on all customers from one aggregation."""
    df = prepared(spark, sf).select("CustomerID", *_NB_VARS, F.col("response").cast("double").alias("label"))
    model = fit_naive_bayes(df, _NB_VARS)
    return rounded(model.transform(df).select("CustomerID", "score", "prediction"), {"score": 9})


_TREE_VARS = ("num_orders", "total_quantity", "recency", "customer_tenure", "product_diversity", "nps", "loyalty")
_TREE_DEPTH, _TREE_LEAF = 3, 0.02


def _tree_sql():
    ctes = [("tr0", f"SELECT CAST(1 AS BIGINT) AS node, CAST(CAST(response AS INTEGER) AS BIGINT) AS y, "
                    f"{', '.join(f'CAST({v} AS DOUBLE) AS {v}' for v in _TREE_VARS)} FROM prep"),
            ("tmin", f"SELECT greatest(1, ceil({_TREE_LEAF} * count(*))) AS least FROM tr0")]

    def purity(a, b):
        return f"((CAST({a} AS DOUBLE) * ({a}) + CAST({b} AS DOUBLE) * ({b})) / (({a}) + ({b})))"

    sizes = []
    for d in range(_TREE_DEPTH + 1):
        sizes.append(f"SELECT z{d}.*, {d} AS depth, " + (f"b{d}.feature, b{d}.threshold, b{d}.gain FROM z{d} LEFT JOIN b{d} USING (node)"
                                                         if d < _TREE_DEPTH else f"NULL AS feature, NULL AS threshold, NULL AS gain FROM z{d}"))
        ctes.append((f"z{d}", f"SELECT node, count(*) AS n, count_if(y = 0) AS n0, count_if(y = 1) AS n1 FROM tr{d} GROUP BY node"))
        if d == _TREE_DEPTH:
            break
        cells = " UNION ALL ".join(f"SELECT node, y, {i} AS f, '{v}' AS feature, {v} AS value FROM tr{d}" for i, v in enumerate(_TREE_VARS))
        ctes.append((f"c{d}", f"SELECT node, f, feature, value, lead(value) OVER w AS high, sum(count_if(y = 0)) OVER w AS l0, "
                              f"sum(count_if(y = 1)) OVER w AS l1 FROM ({cells}) GROUP BY node, f, feature, value "
                              f"WINDOW w AS (PARTITION BY node, f ORDER BY value)"))
        gain = f"{purity('l0', 'l1')} + {purity('n0 - l0', 'n1 - l1')} - {purity('n0', 'n1')}"
        ctes.append((f"b{d}", f"SELECT node, feature, (value + high) / 2 AS threshold, gain FROM "
                              f"(SELECT *, {gain} AS gain FROM c{d} JOIN z{d} USING (node), tmin WHERE l0 + l1 >= least AND n - l0 - l1 >= least AND n > l0 + l1) "
                              f"WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, value) = 1"))
        value = "CASE feature " + " ".join(f"WHEN '{v}' THEN {v}" for v in _TREE_VARS) + " END"
        ctes.append((f"tr{d + 1}", f"SELECT node * 2 + CASE WHEN {value} > threshold THEN 1 ELSE 0 END AS node, y, {', '.join(_TREE_VARS)} "
                                   f"FROM tr{d} JOIN b{d} USING (node)"))
    return (f"SELECT node, CAST(depth AS INTEGER) AS depth, CAST(n AS BIGINT) AS n, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1, "
            f"CASE WHEN n1 > n0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, CAST(n1 AS DOUBLE) / n AS probability, feature, threshold, "
            f"{R('gain', 6)} AS gain FROM ({' UNION ALL '.join(sizes)}) t"), ctes


_tree_body, _tree_ctes = _tree_sql()


@register("decision_tree_exact_splits", S.statement(_tree_body, ["lines", "campaign"], _PREP_CTES + _tree_ctes))
def q_exact_tree(spark, sf):
    """Depth-3 tree of all customers with exact split search, one row a node."""
    df = prepared(spark, sf).select(*_TREE_VARS, F.col("response").cast("double").alias("label"))
    return rounded(fit_exact_tree(df, _TREE_VARS, max_depth=_TREE_DEPTH, min_leaf=_TREE_LEAF), {"gain": 6})


# ---------------------------------------------------------------------------
# Smaller tables with oracles
# ---------------------------------------------------------------------------

@register("sales_bin_response_counts", S.statement(
    "SELECT total_sales_bin AS level, response, CAST(count(*) AS BIGINT) AS count FROM joined GROUP BY 1, 2",
    ["lines", "campaign"], JOINED_CTES))
def q_bin_resp(spark, sf):
    """Any categorical column x response counts (here the sales bin)."""
    return eda.group_response_counts(joined(spark, sf), "total_sales_bin")


@register("country_codes", S.statement(
    "SELECT Country, CAST(dense_rank() OVER (ORDER BY Country) - 1 AS INTEGER) AS code, n FROM "
    "(SELECT Country, CAST(count(*) AS BIGINT) AS n FROM lines GROUP BY Country) t", ["lines"]))
def q_country_codes(spark, sf):
    """Category codes of Country (sorted levels, NULL -> -1) with row counts."""
    counts = fx.lines(spark, sf).groupBy("Country").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return eda.category_codes(counts, "Country").select("Country", F.col("code").cast("int").alias("code"), "n")


@register("description_snake_case", S.statement(
    "SELECT DISTINCT StockCode, Description, regexp_replace(regexp_replace(regexp_replace(lower(Description), "
    "'[^a-z0-9\\s]', ' ', 'g'), '\\s+', '_', 'g'), '^_+|_+$', '', 'g') AS snake FROM lines", ["lines"]))
def q_snake(spark, sf):
    """Snake-case cleaner applied to every product description."""
    return fx.lines(spark, sf).select("StockCode", "Description", snake_case("Description").alias("snake")).distinct()


# ---------------------------------------------------------------------------
# Rows-only: VIF, significance, models, clustering, reports
# ---------------------------------------------------------------------------

def _prep_persisted(spark, sf):
    from pyspark import StorageLevel
    return prepared(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)


@register("vif_final")
def q_vif(spark, sf):
    """H2: VIF of the columns kept by the elimination (one Gram pass)."""
    df = _prep_persisted(spark, sf)
    return stats.vif_elimination(df, numeric_model_columns(df, wide_only=False))[1]


@register("vif_removal_log")
def q_vif_log(spark, sf):
    """Columns removed by VIF elimination, in order, with their VIF."""
    df = _prep_persisted(spark, sf)
    return stats.vif_elimination(df, numeric_model_columns(df, wide_only=False))[2]


_GRAM_VARS = [c for c in _PREP_COLS if c not in ("CustomerID", "response")]


def _gram_sql():
    sums = ", ".join(f"sum(CAST({a} AS DOUBLE) * {b}) AS \"{a}|{b}\"" for i, a in enumerate(_GRAM_VARS) for b in _GRAM_VARS[i:])
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS var_x, '{b}' AS var_y, \"{a if i <= j else b}|{b if i <= j else a}\" AS v FROM gsum"
        for i, a in enumerate(_GRAM_VARS) for j, b in enumerate(_GRAM_VARS))
    power = "pow(10.0::DOUBLE, floor(log10(abs(v))))"
    # sums depend on their order in the last digits: nine significant ones are compared
    return f"SELECT var_x, var_y, CASE WHEN abs(v) < 1e-6 THEN 0.0::DOUBLE ELSE round(v / {power}, 8) * {power} END AS value FROM ({cells}) t", [
        ("gsum", f"SELECT {sums} FROM prep")]


_gram_body, _gram_ctes = _gram_sql()


@register("gram_matrix", S.statement(_gram_body, ["lines", "campaign"], _PREP_CTES + _gram_ctes))
def q_gram(spark, sf):
    """H2: uncentred Gram matrix of the prepared columns, long form, nine significant digits."""
    v = F.col("value")
    power = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(v))))
    rounded_value = F.when(F.abs(v) < 1e-6, 0.0).otherwise(F.round(v / power, 8) * power)
    return stats.gram_long(prepared(spark, sf), _GRAM_VARS).withColumn("value", rounded_value)


@register("logit_significance")
def q_logit(spark, sf):
    """H3, H4: logit coefficient table (Wald p-values) after VIF and dependent-column removal."""
    p = presets.prepare(joined(spark, sf), "baseline")
    return p.significance


def _model_query(model_type, config):
    def q(spark, sf):
        metrics, _ = presets.run_configuration(joined(spark, sf), config, model_type)
        return metrics
    q.__doc__ = f"J13/J14: {model_type} under the {config} configuration."
    return q


for _m in MODEL_TYPES:
    register(f"model_{_m}_baseline")(_model_query(_m, "baseline"))
for _c in presets.CONFIGS[1:]:
    register(f"model_logistic_regression_{_c}")(_model_query("logistic_regression", _c))


@register("random_forest_importances")
def q_rf_imp(spark, sf):
    """Random-forest feature importances on the baseline variables."""
    p = presets.prepare(joined(spark, sf), "baseline")
    _, model = run_model(p.data, p.variables, "response", "baseline", "random_forest")
    return feature_importances(model, p.variables, spark)


@register("decision_tree_nodes")
def q_tree(spark, sf):
    """Decision-tree structure table on the baseline variables."""
    p = presets.prepare(joined(spark, sf), "baseline")
    _, model = run_model(p.data, p.variables, "response", "baseline", "decision_tree")
    return tree_nodes(model, p.variables, spark)


def _sweep_runs(spark, sf):
    """All seven model types under all four configurations, shared by the J17 queries."""
    return _shared(spark, sf, "sweep", lambda: presets.sweep(joined(spark, sf)).cache())


@register("model_comparison_grid")
def q_grid(spark, sf):
    """J17, D-J5, G6: J19: test-AUC grid of all 7 model types x 4 configurations."""
    return presets.metric_grid(_sweep_runs(spark, sf), "test_auc")


@register("model_comparison_metrics")
def q_comparison(spark, sf):
    """train/test AUC, test accuracy and accuracy gap per configuration x model (long form)."""
    return presets.comparison_table(_sweep_runs(spark, sf))


@register("run_log_latest", """
SELECT configuration, model, model_type, run_id, run_ts, n, mean_price FROM (
  SELECT o_orderpriority AS configuration, o_orderstatus AS model, o_orderstatus AS model_type,
         sha256(o_orderpriority || '|' || o_orderstatus || '|' || CAST(year(o_orderdate) AS VARCHAR)) AS run_id,
         CAST(year(o_orderdate) // 3 AS DOUBLE) AS run_ts, CAST(count(*) AS BIGINT) AS n, """ + R("avg(o_totalprice)", 4) + """ AS mean_price
  FROM orders GROUP BY o_orderpriority, o_orderstatus, year(o_orderdate)) t
QUALIFY row_number() OVER (PARTITION BY configuration, model ORDER BY run_ts DESC, run_id DESC) = 1""")
def q_run_log(spark, sf):
    """A run log (here yearly order summaries as runs) written twice, read back, latest run per pair."""
    year = F.year("o_orderdate")
    runs = (spark.read.parquet(f"{sf}/orders.parquet")
            .groupBy(F.col("o_orderpriority").alias("configuration"), F.col("o_orderstatus").alias("model_type"), year.alias("y"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("o_totalprice").alias("mean_price"))
            .withColumns({"model": F.col("model_type"), "run_ts": F.floor(F.col("y") / 3).cast("double"),
                          "run_id": F.sha2(F.concat_ws("|", "configuration", "model_type", F.col("y").cast("string")), 256)}).drop("y"))
    path = shared_folder(spark, "runs")
    for _ in range(2):  # the second writing replaces the first
        presets.append_runs(runs, path)
    latest = presets.latest_runs(presets.read_runs(spark, path))
    return rounded(latest.select("configuration", "model", "model_type", "run_id", "run_ts", "n", "mean_price"), {"mean_price": 4})


@register("cluster_k_search")
def q_k_search(spark, sf):
    """Inertia and silhouette for k = 2..10."""
    feats, _ = clustering.clustering_matrix(joined(spark, sf))
    return clustering.choose_k(feats)


@register("cluster_assignments")
def q_clusters(spark, sf):
    """K-means (best k) and bisecting K-means labels with 2-D PCA coordinates."""
    return clustering.cluster_analysis(joined(spark, sf))[0]


@register("cluster_assignments_outlier_removed")
def q_clusters_iqr(spark, sf):
    """The same after sequential IQR outlier removal."""
    return clustering.cluster_analysis(joined(spark, sf), remove_outliers=True)[0]


@register("cluster_dendrogram")
def q_dendro(spark, sf):
    """Last ten merges of the bisecting K-means tree, by Ward's distance."""
    return clustering.split_dendrogram(joined(spark, sf))


# ---------------------------------------------------------------------------
# Numeric recodes (advertised by the reference's readme)
# ---------------------------------------------------------------------------

@register("recode_total_spending", S.statement(f"""
SELECT CustomerID, {R('total_spending', 2)} AS total_spending,
       CASE WHEN total_spending <= t1 THEN 'low' WHEN total_spending <= t2 THEN 'medium'
            WHEN total_spending IS NOT NULL THEN 'high' END AS spend_level,
       total_spending > med AS high_spender
FROM feat0, (SELECT quantile_cont(total_spending, 0.3333333333333333) AS t1, quantile_cont(total_spending, 0.6666666666666666) AS t2,
                    quantile_cont(total_spending, 0.5) AS med FROM feat0) q""", ["lines"], S.customer_agg_ctes("lines")))
def q_recode(spark, sf):
    """Total spending recoded to tertile levels and to a boolean above the median."""
    feats = customer_aggregates(fx.lines(spark, sf), partitions=fx.line_partitions(spark, sf))
    edges = fit_recode_edges(feats, "total_spending", (1 / 3, 2 / 3, 0.5))
    return rounded(feats.select("CustomerID", "total_spending",
                                recode_levels("total_spending", edges[:2]).alias("spend_level"),
                                recode_boolean("total_spending", edges[2]).alias("high_spender")),
                   {"total_spending": 2})


# ---------------------------------------------------------------------------
# Entry 1: the whole pipeline from the dirty lines and the raw campaign
# ---------------------------------------------------------------------------

_REPAIRED_LINES_CTE = ("lrep", "SELECT DISTINCT InvoiceNo, nullif(trim(StockCode), '') AS StockCode, Description, "
                               "Quantity, CAST(InvoiceDate AS TIMESTAMP) AS InvoiceDate, UnitPrice, CustomerID, Country "
                               "FROM lines_dirty WHERE (UnitPrice >= 0 OR UnitPrice IS NULL) "
                               "AND CustomerID IS NOT NULL AND nullif(trim(StockCode), '') IS NOT NULL")
_PIPE_CTES = ([_REPAIRED_LINES_CTE] + S.features_ctes("lrep") +
              [("ctyped", f"SELECT DISTINCT * FROM ({CAMPAIGN_TYPED_SQL}) WHERE CustomerID IS NOT NULL"),
               ("pj", "SELECT feat.*, ctyped.response, ctyped.loyalty, ctyped.nps, ctyped.n_comp, "
                      "ctyped.n_communications FROM feat JOIN ctyped ON feat.CustomerID = ctyped.CustomerID")])


@register("full_pipeline", S.statement(f"SELECT {S.select_list(JOINED_COLUMNS, FEATURE_ROUND)} FROM pj",
                                       ["lines_dirty", "campaign"], _PIPE_CTES))
def q_full_pipeline(spark, sf):
    """Entry 1 (C9, C16, E1, F1, D-J1): type, repair, integrity checks, features, join — from raw inputs."""
    out = presets.full_pipeline(fx.lines_dirty(spark, sf), fx.campaign(spark, sf), partitions=fx.line_partitions(spark, sf))
    return rounded(out, FEATURE_ROUND).select(*JOINED_COLUMNS)


_ID_CONTENT = " || ".join(
    f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "Country"))


@register("generate_missing_ids", S.statement(
    "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, coalesce(CustomerID, "
    "upper(substr(sha256('basketlens|' || CAST(ordinal AS VARCHAR) || '|' || content), 1, 32))) AS CustomerID, Country "
    f"FROM (SELECT *, {_ID_CONTENT} AS content, row_number() OVER (PARTITION BY InvoiceNo, StockCode, Description, "
    "Quantity, InvoiceDate, UnitPrice, CustomerID, Country) AS ordinal FROM lines_dirty) t", ["lines_dirty"]))
def q_generate_ids(spark, sf):
    """C7, D-J4: every dirty line whose CustomerID is missing gets its own deterministic generated ID."""
    return quality.handle_missing_identifiers(fx.lines_dirty(spark, sf), "CustomerID", "generate")


_QQ_GRID_POINTS = 64


@register("qq_grid", S.statement(
    f"SELECT DISTINCT variable, rank, n, {R('value', 4)} AS value, {R('theoretical', 9)} AS theoretical "
    f"FROM qp, range({_QQ_GRID_POINTS}) g(j) "
    f"WHERE n <= {_QQ_GRID_POINTS} OR rank = 1 + (j * (n - 1)) // {_QQ_GRID_POINTS - 1}",
    ["lines", "campaign"], _qq_ctes()))
def q_qq_grid(spark, sf):
    """H1 at scale: QQ points at 64 evenly spaced exact ranks per variable (bounded output)."""
    return rounded(stats.qq_grid(encoded(spark, sf), _QQ_VARS, _QQ_GRID_POINTS), {"value": 4, "theoretical": 9})
