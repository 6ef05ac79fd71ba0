"""File sources and sinks.

CSV inputs are read as text and bound by header (no inference pass, no type
guessing); typing is the separate, reported step in ``operators.typing``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import require_columns
from .schemas import CAMPAIGN_RAW, LINES_RAW


def read_csv(spark: SparkSession, path: str, schema, optional: tuple[str, ...] = ()) -> DataFrame:
    """Text columns of a CSV file, bound by the header's names in any order.

    Columns of ``schema`` that the file lacks raise, unless they are ``optional``:
    those are NULL. Other columns of the file are left out.
    """
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").option("emptyValue", "").option("escape", '"').csv(path)
    names = [f.name for f in schema.fields]
    require_columns(raw, [c for c in names if c not in optional])
    return raw.select(*[(F.col(f"`{c}`") if c in raw.columns else F.lit(None)).cast("string").alias(c) for c in names])


BAD_ROW = ("file", "line", "reason")


def read_csv_quarantine(spark: SparkSession, path: str, schema, optional: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of CSV files with a header: every data line is in exactly one of them (A1).

    ``rows`` is as ``read_csv`` gives it, of the well-formed lines only; quote signs in a value are doubled. ``rejected`` has (file, line, reason) of
    the others: 'encoding' (bytes that are no UTF-8), 'quotes' (an odd number of quote signs), 'fields' (more or fewer
    fields than the header). Nothing is padded or cut to fit. A line that equals the header is one
    (each file of a folder has its own) and empty lines are none; records are single lines.
    """
    header = spark.read.option("header", True).option("emptyValue", "").option("escape", '"').csv(path)
    names = [f.name for f in schema.fields]
    require_columns(header, [c for c in names if c not in optional])
    columns = header.columns
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.rtrim(F.col("value"), F.lit("\r")).alias("line"))
    fields = F.from_csv(F.col("line"), ", ".join(f"f{i} string" for i in range(len(columns))) + ", bad string",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "emptyValue": "", "escape": '"'})
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    parsed = text.filter(F.length(F.trim("line")) > 0).withColumn("f", fields)
    title = F.lit(True)
    for i, c in enumerate(columns):
        title = title & F.col(f"f.f{i}").eqNullSafe(F.lit(c))
    parsed = parsed.filter(~title).withColumn("reason", F.when(~F.is_valid_utf8("line") | F.contains("line", F.lit("\ufffd")), "encoding").when(quotes % 2 == 1, "quotes")
                                              .when(F.col("f.bad").isNotNull(), "fields"))
    at = {c: i for i, c in enumerate(columns)}
    rows = parsed.filter("reason IS NULL").select(*[(F.col(f"f.f{at[c]}") if c in at else F.lit(None).cast("string")).alias(c) for c in names])
    return rows, parsed.filter("reason IS NOT NULL").select(*BAD_ROW)


def read_lines_csv(spark: SparkSession, path: str) -> DataFrame:
    """Retail invoice lines as text columns (A1)."""
    return read_csv(spark, path, LINES_RAW)


def read_campaign_csv(spark: SparkSession, path: str) -> DataFrame:
    """Campaign responses as text columns (A1); the two communication counts may be absent."""
    return read_csv(spark, path, CAMPAIGN_RAW, optional=("n_comp", "n_communications"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Generic sink (A6): parquet by default, CSV with a header on request."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')  # quotes are doubled, as the readers expect
    w.save(path)
