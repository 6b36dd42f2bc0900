"""Top-k lists in long form (key, id, score, rank) and nested form (key, recs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RECS_TYPE = "array<struct<productId:int,score:double>>"


def top_k(df: DataFrame, key: str | Sequence[str], score: str, id: str, k: int | None = None) -> DataFrame:
    """First k rows per key by score descending, then id, or all of them; adds `rank`.

    The rank filter lets Spark cut each key to k rows before the shuffle, so a hot key
    sends k rows per task and no more.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(id).asc())
    ranked = df.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def latest_n(
    ratings: DataFrame,
    n: int | None,
    key: str = "userId",
    order: Sequence[str] = ("timestamp", "productId", "score"),
) -> DataFrame:
    """Newest n rows per key, or all, by `order` descending; repeats are kept. Adds `seq` from 1."""
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    ranked = ratings.withColumn("seq", F.row_number().over(newest))
    return ranked if n is None else ranked.where(F.col("seq") <= n)


def to_nested(
    ranked: DataFrame, key: str, id: str = "recProductId", keys: DataFrame | None = None
) -> DataFrame:
    """One row per key with its `recs` in rank order; keys without a row get an empty list.

    `ranked` holds a top-k result, so no list is longer than k.
    """
    item = F.struct(
        F.col("rank"), F.col(id).cast("int").alias("productId"), F.col("score").cast("double").alias("score")
    )
    lists = ranked.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    recs = F.transform("_items", lambda x: F.struct(x["productId"].alias("productId"), x["score"].alias("score")))
    if keys is not None:
        lists = keys.select(key).distinct().join(lists, key, "left")
    return lists.select(key, F.coalesce(recs, F.array()).cast(RECS_TYPE).alias("recs"))


def to_long(nested: DataFrame, key: str, id: str = "recProductId") -> DataFrame:
    """Back from `recs` to one row per entry with its rank."""
    entries = nested.select(key, F.posexplode("recs").alias("pos", "rec"))
    return entries.select(
        key,
        F.col("rec.productId").alias(id),
        F.col("rec.score").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )
