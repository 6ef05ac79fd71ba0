"""Customer-campaign join (D-J1) and overall response rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_customer_campaign(features: DataFrame, campaign: DataFrame, key: str = "CustomerID") -> DataFrame:
    """Inner equi-join on the customer key (D-J1).

    Both sides are customer-level; AQE picks a broadcast hash join when the
    measured campaign side is small and a sort-merge join otherwise, and
    splits skewed partitions. NULL keys never match.
    """
    return features.join(campaign, key, "inner")


def response_rate(campaign: DataFrame, response: str = "response") -> DataFrame:
    """Responders, total and rates in percent over the campaign rows."""
    r = F.col(response).cast("int")
    return campaign.agg(
        F.coalesce(F.sum(r), F.lit(0)).cast("bigint").alias("responders"),
        F.count(F.lit(1)).cast("bigint").alias("total"),
    ).select(
        "responders", "total",
        (F.col("total") - F.col("responders")).alias("non_responders"),
        F.try_divide(F.col("responders") * 100.0, F.col("total")).alias("response_rate"),
        (F.lit(100.0) - F.try_divide(F.col("responders") * 100.0, F.col("total"))).alias("non_response_rate"),
    )
