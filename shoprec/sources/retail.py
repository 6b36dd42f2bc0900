"""Ratings, products and users read from a star-schema folder of parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that put the ratings of one user in order, newest first when all descend.
ORDER = ("timestamp", "orderkey", "linenumber", "productId", "score")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def seconds(at: Column) -> Column:
    """Epoch seconds of a date or time in UTC, whatever the session time zone shows."""
    time = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return F.unix_date(at.cast("date")).cast("bigint") * 86400 + time


def ratings(spark: SparkSession, folder: str, order: bool = False) -> DataFrame:
    """One rating per order line: buyer, part, 1 to 5 points, order time in UTC seconds."""
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    columns = [
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        (F.col("l_quantity") % 5 + 1).alias("score"),
        seconds(F.col("o_orderdate")).alias("timestamp"),
    ]
    if order:
        columns += [F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber")]
    return sold.select(*columns)


def products(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    tags = F.concat_ws("|", F.translate("p_name", " ", "|"), "p_brand", "p_type")
    return part.select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("imageUrl"),
        F.col("p_type").alias("categories"),
        tags.alias("tags"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias("userId"),
        F.col("c_name").alias("username"),
        F.lit(False).alias("first"),
        F.lit(0).cast("bigint").alias("timestamp"),
        F.array().cast("array<string>").alias("prefGenres"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
    )
