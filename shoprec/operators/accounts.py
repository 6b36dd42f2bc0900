"""User registration and preferences, and the scale of incoming scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprec.functions.scalars import half_score, name_id
from shoprec.schemas import USER, conform


def register(names: DataFrame, users: DataFrame, now: int) -> DataFrame:
    """New user rows for the names nobody has taken; a name asked for twice is given once."""
    asked = names.select("username").where(F.col("username").isNotNull()).distinct()
    free = asked.join(users.select("username"), "username", "left_anti")
    rows = free.select(
        name_id(F.col("username")).alias("userId"),
        "username",
        F.lit(True).alias("first"),
        F.lit(now).cast("bigint").alias("timestamp"),
        F.array().cast("array<string>").alias("prefGenres"),
    )
    return conform(rows, USER)


def update_preferences(changes: DataFrame, users: DataFrame) -> DataFrame:
    """Users with `first` and `prefGenres` replaced where a change (userId, first, prefGenres) exists.

    Changes may carry `seq`; the highest one of a user counts.
    """
    seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
    latest = changes.groupBy("userId").agg(
        F.max_by(F.struct("first", "prefGenres"), F.struct(seq, "first", "prefGenres")).alias("_new")
    )
    joined = users.join(latest, "userId", "left")
    return conform(
        joined.withColumns({
            "first": F.coalesce("_new.first", "first"),
            "prefGenres": F.coalesce("_new.prefGenres", "prefGenres"),
        }),
        USER,
    )


def scale_score(requests: DataFrame) -> DataFrame:
    """Ten-star scores of rating requests brought to the five-point scale."""
    return requests.withColumn("score", half_score(F.col("score")))
