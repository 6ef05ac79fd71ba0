"""Typing of the two inputs (B1-B9) and the conversion report.

Each conversion is one ``select`` of typed expressions over the input, so
typing is a narrow projection fused into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nps_ordinal, normalize_id, parse_timestamp, to_boolean, to_number


def _dtype(df: DataFrame, name: str) -> T.DataType | None:
    for f in df.schema.fields:
        if f.name == name:
            return f.dataType
    return None


def convert_data_types(lines: DataFrame) -> DataFrame:
    """Retail lines: IDs to normalised text, InvoiceDate to TIMESTAMP_NTZ, numbers coerced (B1)."""
    out = {}
    for c in ("CustomerID", "InvoiceNo", "StockCode"):
        dt = _dtype(lines, c)
        if dt is not None:
            out[c] = normalize_id(c, dt)
    dt = _dtype(lines, "InvoiceDate")
    if dt is not None and not isinstance(dt, T.TimestampNTZType):
        out["InvoiceDate"] = (F.col("InvoiceDate").cast("timestamp_ntz") if isinstance(dt, T.TimestampType)
                              else parse_timestamp("InvoiceDate"))
    dt = _dtype(lines, "Quantity")
    if dt is not None and not isinstance(dt, T.LongType):
        out["Quantity"] = to_number("Quantity").cast("bigint")
    dt = _dtype(lines, "UnitPrice")
    if dt is not None and not isinstance(dt, T.DoubleType):
        out["UnitPrice"] = to_number("UnitPrice")
    return lines.withColumns(out) if out else lines


def convert_campaign_data_types(campaign: DataFrame) -> DataFrame:
    """Campaign: ID text, response boolean, loyalty int, nps ordinal 0..10 (B2)."""
    out = {}
    dt = _dtype(campaign, "CustomerID")
    if dt is not None:
        out["CustomerID"] = normalize_id("CustomerID", dt)
    dt = _dtype(campaign, "response")
    if dt is not None:
        out["response"] = to_boolean("response", dt)
    dt = _dtype(campaign, "loyalty")
    if dt is not None and not isinstance(dt, T.IntegerType):
        out["loyalty"] = to_number("loyalty").cast("int")
    if _dtype(campaign, "nps") is not None:
        out["nps"] = nps_ordinal("nps")
    for c in ("n_comp", "n_communications"):
        dt = _dtype(campaign, c)
        if dt is not None and not isinstance(dt, T.LongType):
            out[c] = to_number(c).cast("bigint")
    return campaign.withColumns(out) if out else campaign


def conversion_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, old_type, new_type) for every column whose type changed."""
    old = {f.name: f.dataType.simpleString() for f in before.schema.fields}
    rows = [(f.name, old[f.name], f.dataType.simpleString())
            for f in after.schema.fields if f.name in old and old[f.name] != f.dataType.simpleString()]
    return after.sparkSession.createDataFrame(rows, "column string, old_type string, new_type string")


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type) listing of a frame's schema (A4, A5)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns of numeric type."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def categorical_columns(df: DataFrame, exclude=()) -> list[str]:
    """Text and boolean columns (the reference's category/object selection, B19)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in set(exclude)]


def overview(df: DataFrame, n: int = 5, order_by=None):
    """dtypes listing plus the first ``n`` rows in an explicit order.

    Returns (schema DataFrame, first-rows DataFrame); the order defaults to all
    columns so the rows shown are deterministic.
    """
    order = list(order_by) if order_by else df.columns
    return schema_report(df), df.orderBy(*order).limit(n)
