"""Table schemas and the binding of a DataFrame to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCT = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("imageUrl", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("tags", T.StringType()),
])

RATING = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

USER = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("username", T.StringType()),
    T.StructField("first", T.BooleanType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("prefGenres", T.ArrayType(T.StringType())),
])

RECOMMENDATION = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

USER_RECS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("recs", T.ArrayType(RECOMMENDATION)),
])

PRODUCT_RECS = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("recs", T.ArrayType(RECOMMENDATION)),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to `schema`; a missing column is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
