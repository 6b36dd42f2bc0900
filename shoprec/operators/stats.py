"""Popularity statistics over ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprec.functions.scalars import year_month


def rate_more(ratings: DataFrame) -> DataFrame:
    """Ratings per product."""
    return ratings.groupBy("productId").agg(F.count(F.lit(1)).alias("count"))


def rate_recent(ratings: DataFrame) -> DataFrame:
    """Ratings per month and product."""
    monthly = ratings.select("productId", year_month(F.col("timestamp")).alias("yearMonth"))
    return monthly.groupBy("yearMonth", "productId").agg(F.count(F.lit(1)).alias("count")).select(
        "productId", "count", "yearMonth"
    )


def average_score(ratings: DataFrame) -> DataFrame:
    """Mean score per product."""
    return ratings.groupBy("productId").agg(F.avg("score").alias("avg"))


def hot_products(recent: DataFrame, num: int) -> DataFrame:
    """First num rows of the monthly counts, newest month first."""
    return recent.orderBy(F.desc("yearMonth"), F.desc("count"), "productId").limit(num)


def top_rated(more: DataFrame, num: int) -> DataFrame:
    """First num products by number of ratings."""
    return more.orderBy(F.desc("count"), "productId").limit(num)
