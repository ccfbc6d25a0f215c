"""The result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.functions.numbers import rounded_mean
from txspark.operators.ranking import first_per_key, top_k


# Total orders, so that results do not depend on the order in which rows arrive.
def region_order() -> list[Column]:
    return [F.desc("avg_risk_score"), F.asc("location_region")]


def receiver_order() -> list[Column]:
    return [F.desc("amount"), F.asc("receiving_address")]


def region_means(cleaned: DataFrame) -> DataFrame:
    """Mean risk and number of transactions per region, unordered."""
    return cleaned.groupBy("location_region").agg(
        F.expr(f"{rounded_mean('risk_score')} AS avg_risk_score"),
        F.expr("count(1) AS transaction_count"),
    )


def region_risk(cleaned: DataFrame) -> DataFrame:
    """Regions by mean risk score, highest first."""
    return region_means(cleaned).orderBy(*region_order())


def sales(cleaned: DataFrame) -> DataFrame:
    return cleaned.where("transaction_type = 'sale'")


def latest_sale_per_receiver(cleaned: DataFrame) -> DataFrame:
    """Each receiver's most recent sale; of simultaneous sales the largest."""
    rows = sales(cleaned).select("receiving_address", "amount", "timestamp")
    return first_per_key(rows, "receiving_address", [F.desc("timestamp"), F.desc("amount")])


def top_receivers(cleaned: DataFrame, k: int = 3) -> DataFrame:
    """The `k` receivers with the largest latest sale."""
    return top_k(latest_sale_per_receiver(cleaned), receiver_order(), k)
