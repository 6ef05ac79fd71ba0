"""Map the driver's TPC-H-style tables onto the engine's two inputs.

``lines`` (retail invoice lines), ``lines_dirty`` (the same with nulls,
blanks, negative prices, text dates and duplicate rows) and ``campaign``
(one response row per customer) are derived with the DataFrame API so
Catalyst prunes the scans to the few columns used and pushes filters into
parquet. The same derivations are kept as SQL text (``*_SQL``) for the
DuckDB oracle, which only has the base tables registered.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lines that one task of the line joins, or of an aggregation over them, is given.
LINE_ROWS = 500_000


def line_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions for the lines: one per ``LINE_ROWS`` (counted from the files' footers), the session's number at least.

    Partitions sized by compressed bytes hold as many lines as these bytes unpack to, and sorting and
    hashing them takes several times that; a count of rows bounds the memory of a task at any size.
    """
    rows = table(spark, sf_dir, "lineitem").count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), math.ceil(rows / LINE_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed retail lines: one row per lineitem, joined to order, part, customer country."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    qty = F.col("l_quantity").cast("bigint")
    # First line of a returned order is booked as a return (negative quantity).
    is_return = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    # Join order: orders x customer x nation first (orders-sized); lineitem meets
    # part on partkey, then the orders on orderkey: two lineitem-sized shuffles
    # instead of three (one where part is small enough to broadcast), and the lines
    # of an invoice end in one partition of bounded rows. Inner joins, same result.
    oc = o.join(c.join(n, c.c_nationkey == n.n_nationkey), o.o_custkey == c.c_custkey)
    lp = li.join(p, li.l_partkey == p.p_partkey).drop("p_partkey")
    return (
        lp.repartition(line_partitions(spark, sf_dir), "l_orderkey")
        .join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("InvoiceNo"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.col("p_name").alias("Description"),
            F.when(is_return, -qty).otherwise(qty).alias("Quantity"),
            F.col("o_orderdate").alias("InvoiceDate"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
            F.col("o_custkey").cast("string").alias("CustomerID"),
            F.col("n_name").alias("Country"),
        )
    )


def lines_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with injected defects (text dates, blanks, nulls, negative prices, duplicates).

    One pass over the line joins: every row is emitted once with its defects,
    and rows picked for duplication are emitted a second time unchanged
    (copy 1), the same multiset as a UNION ALL of the two without joining twice.
    """
    base = lines(spark, sf_dir)
    inv = F.col("InvoiceNo").cast("bigint")
    sku = F.col("StockCode").cast("bigint")
    copies = F.when(inv % 50 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    d = base.withColumn("__copy", F.explode(copies))
    dirty = F.col("__copy") == 0
    return d.select(
        "InvoiceNo",
        F.when(dirty & (sku % 211 == 0), F.lit(" ")).otherwise(F.col("StockCode")).alias("StockCode"),
        F.when(dirty & (sku % 101 == 0), F.lit(None).cast("string")).otherwise(F.col("Description"))
        .alias("Description"),
        "Quantity",
        F.col("InvoiceDate").cast("string").alias("InvoiceDate"),
        F.when(dirty & (inv % 503 == 0), -F.col("UnitPrice")).otherwise(F.col("UnitPrice")).alias("UnitPrice"),
        F.when(dirty & (inv % 97 == 0), F.lit(None).cast("string")).otherwise(F.col("CustomerID")).alias("CustomerID"),
        "Country",
    )


def campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign responses, raw layout: response/loyalty 0/1 ints, nps text with ' ' for missing."""
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    spend = (table(spark, sf_dir, "orders").groupBy("o_custkey")
             .agg(F.sum("o_totalprice").alias("spend")))
    ev = (table(spark, sf_dir, "events").groupBy("user_id")
          .agg(F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("n_comp"),
               F.count(F.lit(1)).alias("n_communications")))
    k = F.col("c_custkey")
    responded = (F.coalesce(F.col("spend"), F.lit(0.0)) > 2465000) != (k % 5 == 0)
    return (
        cust.join(spend, k == spend.o_custkey, "left")
        .join(ev, k == ev.user_id, "left")
        .select(
            k.cast("string").alias("CustomerID"),
            F.when(responded, 1).otherwise(0).alias("response"),
            F.when(k % 3 == 0, 1).otherwise(0).alias("loyalty"),
            F.when(k % 13 == 0, F.lit(" ")).otherwise((k % 11).cast("string")).alias("nps"),
            F.coalesce(F.col("n_comp"), F.lit(0)).cast("bigint").alias("n_comp"),
            F.coalesce(F.col("n_communications"), F.lit(0)).cast("bigint").alias("n_communications"),
        )
    )


# ---------------------------------------------------------------------------
# SQL text of the same derivations, for the DuckDB oracle (base views only).
# ---------------------------------------------------------------------------

LINES_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo, CAST(l_partkey AS VARCHAR) AS StockCode, p_name AS Description,
       CASE WHEN l_returnflag='R' AND l_linenumber=1 THEN -CAST(l_quantity AS BIGINT)
            ELSE CAST(l_quantity AS BIGINT) END AS Quantity,
       o_orderdate AS InvoiceDate, l_extendedprice/l_quantity AS UnitPrice,
       CAST(o_custkey AS VARCHAR) AS CustomerID, n_name AS Country
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN part ON l_partkey=p_partkey
     JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
"""

LINES_DIRTY_SQL = """
SELECT InvoiceNo, CASE WHEN CAST(StockCode AS BIGINT)%211=0 THEN ' ' ELSE StockCode END AS StockCode,
       CASE WHEN CAST(StockCode AS BIGINT)%101=0 THEN NULL ELSE Description END AS Description, Quantity,
       CAST(InvoiceDate AS VARCHAR) AS InvoiceDate,
       CASE WHEN CAST(InvoiceNo AS BIGINT)%503=0 THEN -UnitPrice ELSE UnitPrice END AS UnitPrice,
       CASE WHEN CAST(InvoiceNo AS BIGINT)%97=0 THEN NULL ELSE CustomerID END AS CustomerID, Country
FROM lines
UNION ALL
SELECT InvoiceNo, StockCode, Description, Quantity, CAST(InvoiceDate AS VARCHAR), UnitPrice, CustomerID, Country
FROM lines WHERE CAST(InvoiceNo AS BIGINT)%50=7
"""

CAMPAIGN_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS CustomerID,
       CASE WHEN (coalesce(spend,0)>2465000) <> (c_custkey%5=0) THEN 1 ELSE 0 END AS response,
       CASE WHEN c_custkey%3=0 THEN 1 ELSE 0 END AS loyalty,
       CASE WHEN c_custkey%13=0 THEN ' ' ELSE CAST(c_custkey%11 AS VARCHAR) END AS nps,
       CAST(coalesce(n_comp,0) AS BIGINT) AS n_comp, CAST(coalesce(n_communications,0) AS BIGINT) AS n_communications
FROM customer
LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey) s ON c_custkey=s.o_custkey
LEFT JOIN (SELECT user_id, sum(CASE WHEN event_type='error' THEN 1 ELSE 0 END) AS n_comp,
                  count(*) AS n_communications FROM events GROUP BY user_id) e ON c_custkey=e.user_id
"""

