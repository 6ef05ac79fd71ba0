"""Registered queries (Spark) and their DuckDB oracle statements.

Every query reads the driver tables through ``sources.fixtures`` so its work
grows with the tables. Doubles that come out of sums are rounded on both
sides to a number of decimals matched to their magnitude, so summation order
cannot flip a hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import campaign as camp
from ..operators import eda, quality
from ..operators.features import customer_aggregates, customer_features
from ..operators.typing import convert_campaign_data_types, convert_data_types
from ..sources import fixtures as fx
from ..sources.schemas import BIN_SOURCES, FEATURE_COLUMNS
from . import sql as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Decimals kept per floating output column (by magnitude of the value).
# Only values that depend on summation order are rounded (ratios of integers
# are bit-identical in both engines). A small offset, far above float noise
# and far below the rounding unit, keeps exact decimal midpoints (cents / n)
# off the rounding boundary, where the engines' round() functions differ.
FEATURE_ROUND = {"total_spending": 2, "avg_order_value": 4}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def rounded(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + 10.0 ** -(d + 2), d) for c, d in spec.items() if c in df.columns})


R = S.rnd


# ---------------------------------------------------------------------------
# Shared building blocks
# ---------------------------------------------------------------------------

# Shared customer-level tables, one per (session, data folder): every query
# over the same inputs reuses one persisted copy instead of caching its own.
_SHARED: dict = {}


def _shared(spark: SparkSession, sf: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def reset_cache() -> None:
    """Drop the shared tables (and their cached blocks); the next query rebuilds them."""
    for df in _SHARED.values():
        df.unpersist()
    _SHARED.clear()


def typed_campaign(spark: SparkSession, sf: str) -> DataFrame:
    return convert_campaign_data_types(fx.campaign(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return _shared(spark, sf, "features", lambda: customer_features(
        fx.lines(spark, sf), partitions=fx.line_partitions(spark, sf)))


def joined(spark: SparkSession, sf: str) -> DataFrame:
    """Features joined to the typed campaign; persisted because analyses make several passes over it."""
    from pyspark import StorageLevel
    return _shared(spark, sf, "joined", lambda: camp.join_customer_campaign(
        features(spark, sf), typed_campaign(spark, sf)).persist(StorageLevel.MEMORY_AND_DISK))


CAMPAIGN_TYPED_SQL = """
SELECT regexp_replace(trim(CustomerID), '\\.0+$', '') AS CustomerID,
       TRY_CAST(nullif(trim(CAST(response AS VARCHAR)), '') AS DOUBLE) <> 0 AS response,
       CAST(loyalty AS INTEGER) AS loyalty,
       CASE WHEN TRY_CAST(nullif(trim(nps), '') AS DOUBLE) BETWEEN 0 AND 10
             AND TRY_CAST(nullif(trim(nps), '') AS DOUBLE) = floor(TRY_CAST(nullif(trim(nps), '') AS DOUBLE))
            THEN CAST(TRY_CAST(nullif(trim(nps), '') AS DOUBLE) AS INTEGER) END AS nps,
       n_comp, n_communications
FROM campaign"""

JOINED_CTES = S.features_ctes("lines") + [
    ("ctyped", CAMPAIGN_TYPED_SQL),
    ("joined", "SELECT feat.*, ctyped.response, ctyped.loyalty, ctyped.nps, ctyped.n_comp, ctyped.n_communications "
               "FROM feat JOIN ctyped ON feat.CustomerID = ctyped.CustomerID"),
]

JOINED_COLUMNS = FEATURE_COLUMNS + ["response", "loyalty", "nps", "n_comp", "n_communications"]


# ---------------------------------------------------------------------------
# Sources / typing
# ---------------------------------------------------------------------------

@register("lines_fixture", S.statement(
    "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, "
    "CustomerID, Country FROM lines", ["lines"]))
def q_lines(spark, sf):
    """A1: typed retail lines derived from the order tables."""
    return fx.lines(spark, sf)


@register("shape_report", S.statement(
    "SELECT 'lines' AS dataset, CAST(count(*) AS BIGINT) AS rows, CAST(8 AS BIGINT) AS columns FROM lines "
    "UNION ALL SELECT 'campaign', CAST(count(*) AS BIGINT), CAST(6 AS BIGINT) FROM campaign",
    ["lines", "campaign"]))
def q_shape(spark, sf):
    """A3: rows x columns of both inputs."""
    return quality.shape_report(fx.lines(spark, sf), "lines").unionByName(
        quality.shape_report(fx.campaign(spark, sf), "campaign"))


@register("lines_typed", S.statement(
    "SELECT InvoiceNo, nullif(trim(StockCode), '') AS StockCode, Description, Quantity, "
    "CAST(InvoiceDate AS TIMESTAMP) AS InvoiceDate, UnitPrice, CustomerID, Country "
    "FROM lines_dirty", ["lines_dirty"]))
def q_lines_typed(spark, sf):
    """Typing of the dirty text-dated lines."""
    return rounded(convert_data_types(fx.lines_dirty(spark, sf)), {})


@register("campaign_typed", S.statement(CAMPAIGN_TYPED_SQL, ["campaign"]))
def q_campaign_typed(spark, sf):
    """Campaign typing (boolean response, ordinal nps)."""
    return typed_campaign(spark, sf)


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

def _missing_sql(table: str, cols: list[tuple[str, bool]]) -> str:
    parts = []
    for c, is_text in cols:
        inv = f"{c} IS NULL OR {c} IN ('', ' ')" if is_text else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, "
                     f"CAST(count_if({inv}) AS BIGINT) AS n_invalid FROM {table}")
    return " UNION ALL ".join(parts)


_DIRTY_COLS = [("InvoiceNo", True), ("StockCode", True), ("Description", True), ("Quantity", False),
               ("InvoiceDate", True), ("UnitPrice", False), ("CustomerID", True), ("Country", True)]


@register("missing_report", S.statement(_missing_sql("lines_dirty", _DIRTY_COLS), ["lines_dirty"]))
def q_missing(spark, sf):
    """Null and invalid counts per column in one pass."""
    return quality.missing_report(fx.lines_dirty(spark, sf))


@register("remove_negative_price", S.statement(
    "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, "
    "CustomerID, Country FROM lines_dirty WHERE UnitPrice >= 0 OR UnitPrice IS NULL", ["lines_dirty"]))
def q_neg_price(spark, sf):
    """Negative unit prices removed, NULL prices kept."""
    return rounded(quality.remove_negative_unit_price(fx.lines_dirty(spark, sf)), {})


@register("duplicate_report", S.statement(
    "SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, "
    "CustomerID, Country, CAST(count(*) AS BIGINT) AS copies FROM lines_dirty "
    "GROUP BY ALL HAVING count(*) > 1", ["lines_dirty"]))
def q_dupes(spark, sf):
    """C11: duplicated row contents with multiplicity."""
    return rounded(quality.duplicate_report(fx.lines_dirty(spark, sf)), {})


@register("drop_duplicates", S.statement(
    "SELECT DISTINCT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, "
    "CustomerID, Country FROM lines_dirty", ["lines_dirty"]))
def q_dedup(spark, sf):
    """Full-row dedup."""
    return rounded(quality.drop_duplicates(fx.lines_dirty(spark, sf)), {})


@register("integrity_report", S.statement("""
SELECT 'lines' AS dataset, 'input' AS step, CAST(count(*) AS BIGINT) AS rows FROM lines_dirty
UNION ALL SELECT 'lines', 'negative_price_removed', CAST(count_if(UnitPrice < 0) AS BIGINT) FROM lines_dirty
UNION ALL SELECT 'lines', 'final', CAST(count(*) AS BIGINT) FROM
   (SELECT DISTINCT * FROM lines_dirty WHERE UnitPrice >= 0 OR UnitPrice IS NULL)
UNION ALL SELECT 'campaign', 'input', CAST(count(*) AS BIGINT) FROM campaign
UNION ALL SELECT 'campaign', 'final', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM campaign)""",
    ["lines_dirty", "campaign"]))
def q_integrity(spark, sf):
    """Row counts through the integrity steps for both inputs."""
    return quality.integrity_report(fx.lines_dirty(spark, sf), fx.campaign(spark, sf))


def _blank_null(c: str) -> str:
    return f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END"


# Column order of the policy pass: InvoiceNo, StockCode (IDs, delete), then
# Description (default) counted after those deletions, CustomerID last.
_REPAIR_SQL = f"""
SELECT InvoiceNo, StockCode, coalesce(Description, 'Unknown-' || CAST(k + 1 AS VARCHAR)) AS Description,
       Quantity, InvoiceDate, UnitPrice, CustomerID, Country
FROM (SELECT {_blank_null('InvoiceNo')} AS InvoiceNo, {_blank_null('StockCode')} AS StockCode,
             {_blank_null('Description')} AS Description, Quantity, {_blank_null('InvoiceDate')} AS InvoiceDate,
             UnitPrice, {_blank_null('CustomerID')} AS CustomerID, {_blank_null('Country')} AS Country
      FROM lines_dirty) d
CROSS JOIN (SELECT count_if(contains({_blank_null('Description')}, 'Unknown')) AS k FROM lines_dirty
            WHERE {_blank_null('InvoiceNo')} IS NOT NULL AND {_blank_null('StockCode')} IS NOT NULL) kk
WHERE CustomerID IS NOT NULL AND StockCode IS NOT NULL AND InvoiceNo IS NOT NULL
"""


@register("repair_missing", S.statement(_REPAIR_SQL, ["lines_dirty"]))
def q_repair(spark, sf):
    """Identifiers with missing values deleted, Description filled 'Unknown-k', others kept."""
    df = quality.process_missing_data(fx.lines_dirty(spark, sf), {"Description": "default"},
                                      default_policy="keep", id_policy="delete")
    return rounded(df, {})


@register("mode_fill_nps", S.statement("""
SELECT CustomerID, coalesce(nps, m) AS nps FROM ctyped
CROSS JOIN (SELECT nps AS m FROM ctyped WHERE nps IS NOT NULL GROUP BY nps ORDER BY count(*) DESC, nps LIMIT 1) mm""",
    ["campaign"], [("ctyped", CAMPAIGN_TYPED_SQL)]))
def q_mode_fill(spark, sf):
    """Missing NPS scores (blank in the raw campaign) filled with the mode, lowest value on ties."""
    df = typed_campaign(spark, sf).select("CustomerID", "nps")
    return quality.handle_missing_values(df, "nps", "default")


# ---------------------------------------------------------------------------
# Features, join, response rate (E1-E3, F1, D-J1)
# ---------------------------------------------------------------------------

_CORE_COLS = [c for c in FEATURE_COLUMNS if c not in BIN_SOURCES]


@register("customer_features_core", S.statement(
    f"SELECT {S.select_list(_CORE_COLS, FEATURE_ROUND)} FROM feat0", ["lines"], S.customer_agg_ctes("lines")))
def q_features_core(spark, sf):
    """Per-customer aggregates without bins."""
    return rounded(customer_aggregates(fx.lines(spark, sf), partitions=fx.line_partitions(spark, sf)), FEATURE_ROUND)


@register("customer_features", S.statement(
    f"SELECT {S.select_list(FEATURE_COLUMNS, FEATURE_ROUND)} FROM feat", ["lines"], S.features_ctes("lines")))
def q_features(spark, sf):
    """Flagship: the 19-column customer-feature table with outlier-aware quartile bins (F1)."""
    return rounded(features(spark, sf), FEATURE_ROUND)


@register("customer_features_repaired", S.statement(
    f"SELECT {S.select_list(FEATURE_COLUMNS, FEATURE_ROUND)} FROM feat", ["lines_dirty"],
    [("lrep", "SELECT DISTINCT InvoiceNo, nullif(trim(StockCode), '') AS StockCode, Description, Quantity, "
              "CAST(InvoiceDate AS TIMESTAMP) AS InvoiceDate, UnitPrice, CustomerID, Country FROM lines_dirty "
              "WHERE (UnitPrice >= 0 OR UnitPrice IS NULL) AND CustomerID IS NOT NULL "
              "AND nullif(trim(StockCode), '') IS NOT NULL")] + S.features_ctes("lrep")))
def q_features_repaired(spark, sf):
    """Entry-1 pipeline on dirty input: type, drop missing IDs, integrity, features."""
    lines = convert_data_types(fx.lines_dirty(spark, sf))
    lines = quality.process_missing_data(lines, default_policy="keep", id_policy="delete")
    lines = quality.drop_duplicates(quality.remove_negative_unit_price(lines))
    return rounded(customer_features(lines, partitions=fx.line_partitions(spark, sf)), FEATURE_ROUND)


@register("customer_campaign_join", S.statement(
    f"SELECT {S.select_list(JOINED_COLUMNS, FEATURE_ROUND)} FROM joined", ["lines", "campaign"], JOINED_CTES))
def q_join(spark, sf):
    """D-J1: features inner-joined to the typed campaign."""
    return rounded(joined(spark, sf), FEATURE_ROUND).select(*JOINED_COLUMNS)


@register("response_rate", S.statement("""
SELECT CAST(coalesce(sum(CAST(response AS INTEGER)), 0) AS BIGINT) AS responders, CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) - coalesce(sum(CAST(response AS INTEGER)), 0) AS BIGINT) AS non_responders,
       CAST(sum(CAST(response AS INTEGER)) AS DOUBLE) * 100.0 / count(*) AS response_rate,
       100.0 - CAST(sum(CAST(response AS INTEGER)) AS DOUBLE) * 100.0 / count(*) AS non_response_rate
FROM ctyped""", ["campaign"], [("ctyped", CAMPAIGN_TYPED_SQL)]))
def q_response_rate(spark, sf):
    """Overall response and non-response rate over campaign rows."""
    return camp.response_rate(typed_campaign(spark, sf))


# ---------------------------------------------------------------------------
# EDA tables
# ---------------------------------------------------------------------------

_NPS_BAND_SQL = ("CASE WHEN nps >= 0 AND nps <= 6 THEN 'Detractor (0-6)' WHEN nps >= 0 AND nps <= 8 THEN "
                 "'Passive (7-8)' WHEN nps >= 0 AND nps <= 10 THEN 'Promoter (9-10)' END")


@register("response_rate_table", S.statement(f"""
SELECT variable, level, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_plus) AS BIGINT) AS n_plus,
       CAST(sum(n_plus) AS DOUBLE) * 100.0 / nullif(sum(n), 0) AS response_rate
FROM (
  SELECT 'loyalty' AS variable, CAST(loyalty AS VARCHAR) AS level, count(*) AS n, sum(CAST(response AS INTEGER)) AS n_plus
  FROM joined WHERE loyalty IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'nps', {_NPS_BAND_SQL}, count(*), sum(CAST(response AS INTEGER)) FROM joined
  WHERE nps IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'recency_bin', recency_bin, count(*), sum(CAST(response AS INTEGER)) FROM joined GROUP BY 2
  UNION ALL SELECT 'total_sales_bin', total_sales_bin, count(*), sum(CAST(response AS INTEGER)) FROM joined GROUP BY 2
  UNION ALL SELECT * FROM (VALUES ('nps', 'Detractor (0-6)', 0, 0), ('nps', 'Passive (7-8)', 0, 0),
     ('nps', 'Promoter (9-10)', 0, 0))
  UNION ALL SELECT 'recency_bin', lv, 0, 0 FROM ({S.bin_levels_sql('recency_bin')})
  UNION ALL SELECT 'total_sales_bin', lv, 0, 0 FROM ({S.bin_levels_sql('total_sales_bin')})
) t GROUP BY variable, level""", ["lines", "campaign"], JOINED_CTES))
def q_rr_table(spark, sf):
    """Response rate by loyalty, NPS band, recency bin, sales bin (one pass)."""
    return eda.response_rate_table(joined(spark, sf))


@register("loyalty_response_counts", S.statement(
    "SELECT loyalty AS level, response, CAST(count(*) AS BIGINT) AS count FROM joined GROUP BY 1, 2",
    ["lines", "campaign"], JOINED_CTES))
def q_loyalty_counts(spark, sf):
    """E5: loyalty x response counts."""
    return eda.group_response_counts(joined(spark, sf), "loyalty")


def _mean_median_sql():
    parts = []
    for f in eda.BAR_CHART_FEATURES:
        parts.append(f"SELECT '{f}' AS feature, response, {R(f'avg({f})', 6)} AS mean, "
                     f"{R(f'quantile_cont({f}, 0.5)', 6)} AS median FROM joined GROUP BY response")
    return " UNION ALL ".join(parts)


@register("mean_median_by_response", S.statement(_mean_median_sql(), ["lines", "campaign"], JOINED_CTES))
def q_mean_median(spark, sf):
    """Mean and median of six features by response."""
    return rounded(eda.mean_median_by_response(joined(spark, sf)), {"mean": 6, "median": 6})


@register("monthly_sales", S.statement(f"""
SELECT Month, {R('sum(s)', 2)} AS Sales FROM (
  SELECT CAST(date_trunc('month', CAST(InvoiceDate AS TIMESTAMP)) AS TIMESTAMP) AS Month, Quantity * UnitPrice AS s
  FROM (SELECT DISTINCT * FROM lines_dirty) d
  WHERE InvoiceDate IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL) m
WHERE Month IS NOT NULL AND Month < TIMESTAMP '2001-08-01'
GROUP BY Month""", ["lines_dirty"]))
def q_monthly(spark, sf):
    """Month-on-month sales from the raw lines, cutoff at the last incomplete month."""
    return rounded(eda.monthly_sales(fx.lines_dirty(spark, sf), cutoff="2001-08-01"), {"Sales": 2})


@register("product_sales", S.statement(f"""
SELECT StockCode, Description, {R('sum(Quantity * UnitPrice)', 2)} AS TotalSales
FROM (SELECT DISTINCT * FROM lines_dirty) d
WHERE StockCode IS NOT NULL AND Description IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL
GROUP BY StockCode, Description""", ["lines_dirty"]))
def q_product_sales(spark, sf):
    """Sales per (StockCode, Description)."""
    return rounded(eda.product_sales(fx.lines_dirty(spark, sf)), {"TotalSales": 2})


@register("top_products", S.statement(f"""
SELECT StockCode, Description, {R('TotalSales', 2)} AS TotalSales FROM (
  SELECT StockCode, Description, sum(Quantity * UnitPrice) AS TotalSales
  FROM (SELECT DISTINCT * FROM lines_dirty) d
  WHERE StockCode IS NOT NULL AND Description IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL
  GROUP BY StockCode, Description) p
ORDER BY TotalSales DESC, StockCode, Description LIMIT 5""", ["lines_dirty"]))
def q_top_products(spark, sf):
    """G1: top five products by sales (a top-k report: the limit is the feature)."""
    return rounded(eda.top_products(fx.lines_dirty(spark, sf), 5), {"TotalSales": 2})


def _bin_counts_sql():
    parts = [f"SELECT '{b}' AS bin_column, {b} AS label, count(*) AS c FROM feat GROUP BY 2" for b in BIN_SOURCES]
    parts += [f"SELECT '{b}', lv, 0 FROM ({S.bin_levels_sql(b)})" for b in BIN_SOURCES]
    return (f"SELECT bin_column, label, CAST(sum(c) AS BIGINT) AS count FROM ({' UNION ALL '.join(parts)}) t "
            f"GROUP BY bin_column, label")


@register("bin_value_counts", S.statement(_bin_counts_sql(), ["lines"], S.features_ctes("lines")))
def q_bin_counts(spark, sf):
    """Label counts of the six bin columns."""
    return eda.bin_value_counts(features(spark, sf), list(BIN_SOURCES))


_CAMPAIGN_COLS = [("CustomerID", True), ("response", False), ("loyalty", False), ("nps", False),
                  ("n_comp", False), ("n_communications", False)]


@register("campaign_missing_report", S.statement(_missing_sql("ctyped", _CAMPAIGN_COLS), ["campaign"],
                                                 [("ctyped", CAMPAIGN_TYPED_SQL)]))
def q_campaign_missing(spark, sf):
    """Missing values of the typed campaign (blank NPS becomes NULL and is counted)."""
    return quality.missing_report(typed_campaign(spark, sf))
