"""Per-customer behavioural features (E1, E2, B12-B14, F1) — the flagship table.

Plan shape: every line gives a row for (customer, invoice) and one for
(customer, product), dealt over a given number of partitions and aggregated
there, so a customer holding a third of all lines is spread over many tasks
before the final per-customer merge, and a task's hash table is bounded by rows. The global last invoice date is taken from the per-customer maxima
(including the NULL-customer group) instead of a second scan of the lines,
as a scalar subquery.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_diff, safe_ratio
from ..sources.schemas import BIN_SOURCES, FEATURE_COLUMNS
from .binning import apply_quartile_bins, fit_quartile_edges

NUMERIC_FEATURES = ["total_spending", "num_orders", "total_quantity", "avg_order_value", "recency",
                    "customer_tenure", "avg_quantity_per_order", "order_frequency",
                    "product_diversity", "return_rate"]


def line_value(df: DataFrame, name: str = "TotalValue") -> DataFrame:
    """Quantity x UnitPrice."""
    return df.withColumn(name, F.col("Quantity") * F.col("UnitPrice"))


def customer_aggregates(lines: DataFrame, persist: bool = True, partitions: int | None = None) -> DataFrame:
    """The 13 unbinned feature columns, one row per non-NULL customer.

    With ``persist`` the per-customer aggregate is cached (MEMORY_AND_DISK;
    lost blocks are recomputed from lineage) so the line pipeline runs once:
    the global last date, the features and the bin-fitting jobs all read it.
    The lines' invoices and products are dealt over ``partitions`` (the session's
    shuffle partitions if unset), so callers that know the rows can bound a task's.
    """
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # a row for the line's invoice, which carries what is summed, and one for its product
    items = lines.withColumn("_sums", F.explode(F.array(F.lit(True), F.lit(False)))).select(
        "CustomerID", "_sums",
        F.when(F.col("_sums"), F.col("InvoiceNo").cast("string")).otherwise(F.col("StockCode").cast("string")).alias("_item"),
        F.when(F.col("_sums"), F.col("InvoiceDate")).alias("_date"),
        F.when(F.col("_sums"), F.col("Quantity") * F.col("UnitPrice")).alias("_value"),
        F.when(F.col("_sums"), F.col("Quantity")).alias("_quantity"))
    per_item = (items.repartition(n, "CustomerID", "_sums", "_item")
                .groupBy("CustomerID", "_sums", "_item").agg(
        F.min("_date").alias("_first"), F.max("_date").alias("_last"), F.sum("_value").alias("_value"),
        F.sum("_quantity").alias("_quantity"),
        F.sum(F.when(F.col("_quantity") < 0, F.col("_quantity"))).alias("_returned")))
    known = F.col("_item").isNotNull()
    per_cust = per_item.groupBy("CustomerID").agg(
        F.min("_first").alias("first_purchase"),
        F.max("_last").alias("last_purchase"),
        F.coalesce(F.sum("_value"), F.lit(0.0)).alias("total_spending"),
        F.count_if(F.col("_sums") & known).alias("num_orders"),
        F.coalesce(F.sum("_quantity"), F.lit(0)).alias("total_quantity"),
        F.count_if(~F.col("_sums") & known).alias("product_diversity"),
        F.sum("_returned").alias("_returned"),
    )
    if persist:
        per_cust = per_cust.persist(StorageLevel.MEMORY_AND_DISK)
    # Global last date over *all* lines (NULL customers included), taken from the
    # per-customer maxima as a scalar subquery: no second line scan, no join.
    gmax = per_cust.agg(F.max("last_purchase")).scalar()
    f = per_cust.filter(F.col("CustomerID").isNotNull()).withColumn("_gmax", gmax)
    tenure = day_diff("first_purchase", "last_purchase")
    return f.select(
        "CustomerID", "first_purchase", "last_purchase", "total_spending",
        F.col("num_orders").cast("bigint").alias("num_orders"),
        F.col("total_quantity").cast("bigint").alias("total_quantity"),
        safe_ratio("total_spending", "num_orders").alias("avg_order_value"),
        day_diff("last_purchase", "_gmax").cast("bigint").alias("recency"),
        tenure.cast("bigint").alias("customer_tenure"),
        safe_ratio("total_quantity", "num_orders").alias("avg_quantity_per_order"),
        safe_ratio(tenure, "num_orders").alias("order_frequency"),
        F.col("product_diversity").cast("bigint").alias("product_diversity"),
        F.coalesce(safe_ratio(F.abs(F.col("_returned")), "total_quantity"), F.lit(0.0)).alias("return_rate"),
    )


def customer_features(lines: DataFrame, persist: bool = True, partitions: int | None = None, **qkw) -> DataFrame:
    """All 19 columns: aggregates plus six outlier-aware quartile bins.

    The bin edges are fitted with a few small distributed jobs on the
    persisted customer-level aggregate; labelling is a projection.
    """
    agg = customer_aggregates(lines, persist=persist, partitions=partitions)
    edges = fit_quartile_edges(agg, list(dict.fromkeys(BIN_SOURCES.values())), **qkw)
    return apply_quartile_bins(agg, BIN_SOURCES, edges).select(*FEATURE_COLUMNS)
