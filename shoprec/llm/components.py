"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import Scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps: each step links all neighbours of a node to the
    smallest of them, so the table never grows beyond one row per edge, and the number of rounds
    grows with the logarithm of the longest path. Every round is written to the shared folder, and the
    round before it dropped.
    """
    scratch = Scratch(edges.sparkSession)
    links = scratch.write(edges.where("a <> b").select("a", "b").distinct(), "links")
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        # Large star: larger neighbours of u hang on the smallest node around u.
        large = (
            both.where("v > u").join(least, F.col("u") == F.col("k")).where("v <> m")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = scratch.write(large, "large")  # each a > b
        # Small star: smaller neighbours of a, and a itself, hang on the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        joined = large.join(low, F.col("a") == F.col("k"))
        small = scratch.write(
            joined.select(F.col("a"), F.col("m").alias("b"))
            .union(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct(),
            "small",
        )
        state = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        same = state(small) == state(ordered)
        scratch.drop(large, links)
        if same:
            break
        links = small
    return small.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        small.select("b", "b").distinct()
    )
