"""Exploratory tables over the joined customer table.

Every table is a long-form DataFrame (the data behind one of the reference's
plots). Multi-variable tables are computed in one pass by unpivoting each row
into (variable, level) pairs *before* a partial aggregation, so the
expansion never reaches the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NPS_BANDS, nps_band, parse_timestamp, to_number
from .binning import QUARTILE_LABELS, UNKNOWN, iqr_bounds, levels_of
from .ordering import prefix_sums
from .quantiles import column_quantiles, group_quantiles
from .quality import drop_duplicates, drop_missing, require_columns

# Variables the response-rate table covers, in report order.
RESPONSE_RATE_VARIABLES = ("loyalty", "nps", "recency_bin", "total_sales_bin")
# The six features of the mean/median bar charts.
BAR_CHART_FEATURES = ("total_spending", "product_diversity", "num_orders", "avg_order_value",
                      "customer_tenure", "order_frequency")
# Variables of the box-plot menu (numeric ones, then nps).
BOXPLOT_VARIABLES = ("total_spending", "num_orders", "avg_order_value", "total_quantity",
                     "customer_tenure", "order_frequency", "product_diversity", "return_rate",
                     "avg_quantity_per_order", "recency", "n_comp", "n_communications", "nps")
# Columns the correlation heatmap leaves out.
NON_INFORMATIVE = ("CustomerID", "first_purchase", "last_purchase")
BIN_LEVELS = (*QUARTILE_LABELS, UNKNOWN)


def _level_expr(data: DataFrame, var: str):
    if var == "nps":
        return nps_band("nps")
    return F.col(var).cast("string")


def response_rate_table(data: DataFrame, response: str = "response",
                        variables: Sequence[str] = RESPONSE_RATE_VARIABLES) -> DataFrame:
    """(variable, level, n, n_plus, response_rate) for each variable, one pass.

    NPS is banded (F3); rows without a level are left out. Fixed levels
    (the three NPS bands, 'Unknown' for bins) appear with n = 0 and a NULL
    rate when no row has them.
    """
    spark = data.sparkSession
    vars_ = [v for v in variables if v in data.columns]
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), _level_expr(data, v).alias("level")) for v in vars_])
    r = F.col(response).cast("int")
    counts = (data.select(F.inline(pairs), r.alias("_r"))
              .filter(F.col("level").isNotNull())
              .groupBy("variable", "level")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("_r").alias("n_plus")))
    fixed = []
    for v in vars_:
        if v == "nps":
            fixed += [(v, label) for label, _ in NPS_BANDS]
        elif v.endswith("_bin"):
            fixed += [(v, lv) for lv in (levels_of(data, v) or [UNKNOWN])]
    if fixed:
        zero = spark.createDataFrame(fixed, "variable string, level string") \
            .withColumn("n", F.lit(0).cast("bigint")).withColumn("n_plus", F.lit(0).cast("bigint"))
        counts = counts.unionByName(zero).groupBy("variable", "level") \
            .agg(F.sum("n").alias("n"), F.sum("n_plus").alias("n_plus"))
    return counts.select(
        "variable", "level", F.col("n").cast("bigint").alias("n"), F.col("n_plus").cast("bigint").alias("n_plus"),
        F.try_divide(F.col("n_plus") * 100.0, F.col("n")).alias("response_rate"))


def group_response_counts(data: DataFrame, variable: str, response: str = "response") -> DataFrame:
    """(level, response, count) — loyalty bar plot (E5) or any categorical column."""
    require_columns(data, [variable, response])
    return (data.groupBy(F.col(variable).alias("level"), F.col(response).alias("response"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("count")))


def mean_median_by_response(data: DataFrame, features: Sequence[str] = BAR_CHART_FEATURES,
                            response: str = "response") -> DataFrame:
    """(feature, response, mean, median) (E7). Medians are exact and distributed."""
    feats = [f for f in features if f in data.columns]
    resp = F.col(response).cast("string")
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in feats])
    means = (data.select(resp.alias("response"), F.inline(pairs))
             .groupBy("feature", "response").agg(F.avg("v").alias("mean")))
    med = group_quantiles(data.withColumn("__resp", F.col(response).cast("string")), feats, ["__resp"], [0.5])
    med = med.select(F.col("variable").alias("f"), F.col("__resp").alias("r"), F.col("q")[0].alias("median"))
    out = means.join(med, (means["feature"] == med["f"]) & means["response"].eqNullSafe(med["r"]), "left")
    if isinstance(data.schema[response].dataType, T.BooleanType):
        out = out.withColumn("response", F.col("response").cast("boolean"))
    return out.select("feature", "response", "mean", "median")


def monthly_sales(raw_lines: DataFrame, cutoff: str | None = None) -> DataFrame:
    """(Month, Sales) month-on-month sales.

    Duplicates out, rows missing date/quantity/price out, dates parsed with
    the shared parser, Sales = Quantity x UnitPrice summed per month start;
    months starting on/after ``cutoff`` are dropped.
    """
    req = ["InvoiceDate", "Quantity", "UnitPrice"]
    require_columns(raw_lines, req)
    df = drop_missing(drop_duplicates(raw_lines), req)
    date = F.col("InvoiceDate")
    if not isinstance(df.schema["InvoiceDate"].dataType, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        date = parse_timestamp("InvoiceDate")
    qty = F.col("Quantity") if isinstance(df.schema["Quantity"].dataType, T.NumericType) else to_number("Quantity")
    price = F.col("UnitPrice") if isinstance(df.schema["UnitPrice"].dataType, T.NumericType) else to_number("UnitPrice")
    month = F.date_trunc("month", date).cast("timestamp_ntz")
    out = (df.select(month.alias("Month"), (qty * price).alias("_s"))
           .filter(F.col("Month").isNotNull())
           .groupBy("Month").agg(F.sum("_s").alias("Sales")))
    if cutoff:
        out = out.filter(F.col("Month") < F.lit(cutoff).cast("timestamp_ntz"))
    return out


def product_sales(raw_lines: DataFrame) -> DataFrame:
    """(StockCode, Description, TotalSales) after dedup and dropping rows missing key fields."""
    req = ["StockCode", "Description", "Quantity", "UnitPrice"]
    require_columns(raw_lines, req)
    df = drop_missing(drop_duplicates(raw_lines), req)
    return (df.groupBy("StockCode", "Description")
            .agg(F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("TotalSales")))


def top_products(raw_lines: DataFrame, n: int = 5) -> DataFrame:
    """Top-n products by sales (G1): partial aggregation + TakeOrderedAndProject, ties by key."""
    return (product_sales(raw_lines)
            .orderBy(F.desc("TotalSales"), F.asc("StockCode"), F.asc("Description")).limit(n))


def bin_value_counts(features: DataFrame, bin_columns: Sequence[str]) -> DataFrame:
    """(bin_column, label, count) including NULL labels and empty levels with count 0."""
    pairs = F.array(*[F.struct(F.lit(c).alias("bin_column"), F.col(c).cast("string").alias("label"))
                      for c in bin_columns])
    counts = (features.select(F.inline(pairs)).groupBy("bin_column", "label")
              .agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    fixed = [(c, lv) for c in bin_columns for lv in (levels_of(features, c) or [])]
    if not fixed:
        return counts
    zero = features.sparkSession.createDataFrame(fixed, "bin_column string, label string") \
        .withColumn("count", F.lit(0).cast("bigint"))
    return (counts.unionByName(zero).groupBy("bin_column", "label")
            .agg(F.sum("count").cast("bigint").alias("count")))


# ---------------------------------------------------------------------------
# Encoding and correlation
# ---------------------------------------------------------------------------

def level_position(col: str, levels: Sequence[str]):
    """Position of a text column in a fixed short level list; NULL and other values -> -1."""
    position = F.array_position(F.array(*[F.lit(lv) for lv in levels]), F.col(col)) - 1
    return F.coalesce(position, F.lit(-1))


def category_codes(data: DataFrame, col: str, out: str = "code") -> DataFrame:
    """``data`` with ``out``: the position of ``col`` among its sorted distinct values, NULL -> -1.

    Levels are numbered by distributed running sums and joined back, so their
    number is not limited; Spark broadcasts the level table when it is small
    and splits a hot level of a larger one.
    """
    levels = data.select(F.col(col).alias("__level")).filter(F.col("__level").isNotNull()).distinct()
    ranked = prefix_sums(levels.withColumn("__one", F.lit(1).cast("bigint")), [], [F.col("__level")], ["__one"])
    codes = ranked.select("__level", (F.col("cum___one") - 1).alias("__code"))
    coded = data.join(codes, data[col] == codes["__level"], "left")
    return coded.withColumn(out, F.coalesce(F.col("__code"), F.lit(-1))).drop("__level", "__code")


def encode_for_correlation(data: DataFrame, response: str = "response") -> DataFrame:
    """Numeric view of the joined table: bins by label order, nps by score (NULL -> -1),
    booleans 0/1, other text by sorted level; identifiers and dates dropped."""
    cols = []
    fields = data.schema.fields
    bins = {f.name: levels_of(data, f.name) or BIN_LEVELS for f in fields if f.name.endswith("_bin")}
    for f in fields:
        if isinstance(f.dataType, T.StringType) and f.name not in (*NON_INFORMATIVE, *bins, "nps"):
            data = category_codes(data, f.name, f"__code_{f.name}")
    for f in fields:
        if f.name in NON_INFORMATIVE:
            continue
        if f.name in bins:
            cols.append(level_position(f.name, bins[f.name]).cast("double").alias(f.name))
        elif f.name == "nps":
            cols.append(F.coalesce(F.col("nps"), F.lit(-1)).cast("double").alias("nps"))
        elif isinstance(f.dataType, T.BooleanType):
            cols.append(F.col(f.name).cast("int").cast("double").alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.col(f"__code_{f.name}").cast("double").alias(f.name))
    return data.select(*cols)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def correlation_matrix(data: DataFrame, response: str = "response") -> DataFrame:
    """Pearson correlation of every pair, long form (var_x, var_y, corr).

    Pass 1 (one aggregation): mean and NULL count per column. Pass 2 (one
    aggregation): centred cross-products of every pair of NULL-free columns
    (k(k+1)/2 sums, numerically stable); pairs touching a column with NULLs
    use pairwise-complete rows, like pandas. A zero variance gives NULL.
    The k² expressions are written as SQL text (one JVM call each instead of
    one per Column operator).
    """
    enc = encode_for_correlation(data, response)
    names = enc.columns
    first = enc.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
                    *[F.count(c).alias(f"c{i}") for i, c in enumerate(names)]).first()
    full = {i for i, _ in enumerate(names) if first[f"c{i}"] == first["__n"]}
    mean = {i: repr(float(first[f"m{i}"])) if first[f"m{i}"] is not None else "0.0" for i in range(len(names))}
    aggs = []
    for i in range(len(names)):
        for j in range(i, len(names)):
            a, b = _q(names[i]), _q(names[j])
            if i in full and j in full:
                aggs.append(f"sum(({a} - {mean[i]}) * ({b} - {mean[j]})) AS s_{i}_{j}")
            elif i < j:
                both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
                xa, xb = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
                aggs.append(f"try_divide(covar_pop({xa}, {xb}), stddev_pop({xa}) * stddev_pop({xb})) AS r_{i}_{j}")
    wide = enc.agg(*[F.expr(x) for x in aggs])

    def pair(i, j):
        i, j = min(i, j), max(i, j)
        if i in full and j in full:
            return f"try_divide(s_{i}_{j}, sqrt(s_{i}_{i} * s_{j}_{j}))"
        return f"r_{i}_{j}"

    structs = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            val = "CAST(1.0 AS DOUBLE)" if i == j else f"CAST({pair(i, j)} AS DOUBLE)"
            structs.append(f"named_struct('var_x', '{a}', 'var_y', '{b}', 'corr', {val})")
    return wide.selectExpr(f"inline(array({', '.join(structs)}))")


# ---------------------------------------------------------------------------
# Box plots (E13) and stacked histograms
# ---------------------------------------------------------------------------

def without_outliers(data: DataFrame, variables: Sequence[str], k: float = 1.5) -> DataFrame:
    """Each variable's values outside its own [Q1 - k IQR, Q3 + k IQR] become NULL; all bounds from one request."""
    q = column_quantiles(data, variables, [0.25, 0.75])
    cells = {}
    for v in variables:
        if q[v]["n"]:
            lo, hi = iqr_bounds(*q[v]["q"], k=k)
            cells[v] = F.when(F.col(v).cast("double").between(lo, hi), F.col(v))
    return data.withColumns(cells) if cells else data


def boxplot_summary(data: DataFrame, variables: Sequence[str] = BOXPLOT_VARIABLES, response: str = "response",
                    outliers_included: bool = True) -> DataFrame:
    """Per (variable, response): n, quartiles, 1.5 IQR whiskers, outlier count, min, max.

    With ``outliers_included=False`` each variable's values outside its own 1.5 IQR bounds (over all responses) are
    left out first.
    """
    vars_ = [v for v in variables if v in data.columns]
    if not outliers_included:
        data = without_outliers(data, vars_)
    d = data.withColumn("__resp", F.col(response).cast("string"))
    q = group_quantiles(d, vars_, ["__resp"], [0.25, 0.5, 0.75])
    width = F.col("q")[2] - F.col("q")[0]
    spec = q.select(F.col("variable").alias("__var"), F.col("__resp").alias("__r"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                    F.col("q")[2].alias("q3"), (F.col("q")[0] - 1.5 * width).alias("lo"), (F.col("q")[2] + 1.5 * width).alias("hi"))
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("v")) for v in vars_])
    long = d.select(F.col("__resp").alias("response"), F.inline(pairs)).filter(F.col("v").isNotNull())
    inside = F.col("v").between(F.col("lo"), F.col("hi"))
    stats = (long.join(spec, (F.col("variable") == F.col("__var")) & F.col("response").eqNullSafe(F.col("__r")))
             .groupBy("variable", "response", "q1", "median", "q3")
             .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                  F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
                  F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
                  F.count_if(~inside).cast("bigint").alias("n_outliers"),
                  F.min("v").alias("min"), F.max("v").alias("max")))
    if isinstance(data.schema[response].dataType, T.BooleanType):
        stats = stats.withColumn("response", F.col("response").cast("boolean"))
    return stats.select("variable", "response", "n", "min", "q1", "median", "q3", "whisker_low",
                        "whisker_high", "n_outliers", "max")


def stacked_histogram(data: DataFrame, variables: Sequence[str], response: str = "response",
                      bins: int = 30) -> DataFrame:
    """(variable, bucket, response, count) over ``bins`` equal-width buckets per variable."""
    vars_ = [v for v in variables if v in data.columns]
    mm = data.agg(*[F.min(F.col(v).cast("double")).alias(f"mn_{i}") for i, v in enumerate(vars_)],
                  *[F.max(F.col(v).cast("double")).alias(f"mx_{i}") for i, v in enumerate(vars_)]).first()
    structs = []
    for i, v in enumerate(vars_):
        lo, hi = mm[f"mn_{i}"], mm[f"mx_{i}"]
        x = F.col(v).cast("double")
        if lo is None:
            continue
        # floor((x - lo) / (hi - lo) * bins) + 1, the top edge folded into the last bucket
        b = F.lit(1).cast("bigint") if lo == hi else F.least(
            F.floor((x - F.lit(lo)) / (F.lit(hi) - F.lit(lo)) * bins).cast("bigint") + 1, F.lit(bins).cast("bigint"))
        structs.append(F.struct(F.lit(v).alias("variable"), F.when(x.isNotNull(), b).alias("bucket"),
                                F.lit(lo).alias("lo"), F.lit(hi).alias("hi")))
    return (data.select(F.col(response).alias("response"), F.inline(F.array(*structs)))
            .filter(F.col("bucket").isNotNull())
            .groupBy("variable", "bucket", "response")
            .agg(F.count(F.lit(1)).cast("bigint").alias("count"), F.first("lo").alias("lo"),
                 F.first("hi").alias("hi"))
            .select("variable", "bucket", "response", "count",
                    (F.col("lo") + (F.col("bucket") - 1) * (F.col("hi") - F.col("lo")) / bins).alias("bucket_start")))
