"""Explicit schemas of the two inputs and of the customer-feature output."""

from __future__ import annotations

from pyspark.sql import types as T

# Retail invoice lines as typed by the engine (a raw CSV is read as strings
# first, see ``operators.typing``).
LINES = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("Country", T.StringType()),
])

# Raw text layout of the retail CSV (every field kept as text, typing is a
# separate, reported step).
LINES_RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in LINES.fields])

CAMPAIGN = T.StructType([
    T.StructField("CustomerID", T.StringType()),
    T.StructField("response", T.BooleanType()),
    T.StructField("loyalty", T.IntegerType()),
    T.StructField("nps", T.IntegerType()),
    T.StructField("n_comp", T.LongType()),
    T.StructField("n_communications", T.LongType()),
])

CAMPAIGN_RAW = T.StructType([
    T.StructField("CustomerID", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("loyalty", T.StringType()),
    T.StructField("nps", T.StringType()),
    T.StructField("n_comp", T.StringType()),
    T.StructField("n_communications", T.StringType()),
])

# The customer-feature table's column order.
FEATURE_COLUMNS = [
    "CustomerID", "first_purchase", "last_purchase", "total_spending", "num_orders",
    "total_quantity", "avg_order_value", "recency", "customer_tenure",
    "avg_quantity_per_order", "order_frequency", "product_diversity", "return_rate",
    "recency_bin", "total_quantity_bin", "avg_order_value_bin",
    "customer_tenure_bin", "order_frequency_bin", "total_sales_bin",
]

# Which numeric feature each bin column labels.
BIN_SOURCES = {
    "total_sales_bin": "total_spending",
    "recency_bin": "recency",
    "total_quantity_bin": "total_quantity",
    "avg_order_value_bin": "avg_order_value",
    "customer_tenure_bin": "customer_tenure",
    "order_frequency_bin": "order_frequency",
}

ID_COLUMNS = ["CustomerID", "InvoiceNo", "StockCode"]
