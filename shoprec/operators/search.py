"""Name search by regular expression over stored trigrams.

A name that holds a match of an expression holds the literal texts that each way through the
expression must pass. Their trigrams select a few products from the postings; the expression decides.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprec.operators.serving import with_average
from shoprec.sources.tables import load_table, save_table

GRAMS = "name_grams"


def trigrams(text: str) -> set[str]:
    return {text[i : i + 3] for i in range(len(text) - 2)}


def needed(pattern: str) -> list[set[str]] | None:
    """For each alternative of the expression the trigrams any match holds; None where one has none.

    Only texts outside groups and classes that no quantifier or escape touches are used, so
    the answer may hold too few trigrams and never one too many.
    """
    if re.search(r"\(\?[a-zA-Z]", pattern) or r"\Q" in pattern:
        return None  # flags change what letters mean
    ways, runs, run, depth, i = [], [], "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            runs, run, i = [*runs, run], "", i + 2
            continue
        if c == "[":
            end = i + 1 + (pattern[i + 1 : i + 2] == "^")
            end += pattern[end : end + 1] == "]"
            while end < len(pattern) and pattern[end] != "]":
                if pattern[end] == "[":
                    return None  # nested classes
                end += 2 if pattern[end] == "\\" else 1
            runs, run, i = [*runs, run], "", end + 1
            continue
        if c in "()":
            depth += 1 if c == "(" else -1
            runs, run = [*runs, run], ""
        elif c in "?*{+":
            if depth == 0:
                runs, run = [*runs, run[:-1]], ""
            if c == "{":
                i = pattern.find("}", i) if "}" in pattern[i:] else len(pattern)
        elif c in ".^$":
            runs, run = [*runs, run], ""
        elif c == "|" and depth == 0:
            ways, runs, run = [*ways, [*runs, run]], [], ""
        elif depth == 0:
            run += c
        i += 1
    ways.append([*runs, run])
    grams = [set().union(*map(trigrams, way)) for way in ways]
    return grams if all(grams) else None


def save_grams(products: DataFrame, root: str) -> None:
    """Store (gram, productId) for all trigrams of the names, in files of ranges of grams."""
    size = F.char_length("name")
    places = F.when(size >= 3, F.sequence(F.lit(1), size - 2)).otherwise(F.array().cast("array<int>"))
    grams = F.array_distinct(F.transform(places, lambda i: F.substr(F.col("name"), i, F.lit(3))))
    save_table(products.select(F.explode(grams).alias("gram"), "productId"), root, GRAMS, ["gram", "productId"])


def candidates(spark: SparkSession, root: str, ways: list[set[str]]) -> DataFrame:
    """Ids of the products whose names hold all trigrams of one of the alternatives."""
    postings, found = load_table(spark, root, GRAMS), None
    for grams in ways:
        rows = postings.where(F.col("gram").isin(sorted(grams))).groupBy("productId").agg(F.count(F.lit(1)).alias("n"))
        ids = rows.where(F.col("n") == len(grams)).select("productId")
        found = ids if found is None else found.unionByName(ids)
    return found.distinct()


def search_indexed(spark: SparkSession, root: str, products: DataFrame, avg: DataFrame, pattern: str) -> DataFrame:
    """As `serving.search`, the names read being those that the stored trigrams leave. An expression
    without literal texts of three characters in each alternative reads all names."""
    ways = needed(pattern)
    if ways is not None:
        products = products.join(candidates(spark, root, ways), "productId", "left_semi")
    return with_average(products.where(F.col("name").rlike(pattern)), avg)
