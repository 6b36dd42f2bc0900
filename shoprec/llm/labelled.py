"""Bounded samples of labelled documents, and results that one task makes of them."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import texts_of


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, trains: Column | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label, mark) of the documents with one of at most `rows` labelled ids, those with the smallest hash.

    `trains`, over doc_id, says which ids may be learned from. Null ids and labels are left out; an
    id with several labels has their majority, 1 in a tie. An id with several texts gives one, that
    with the smallest hash, so there are at most `rows` rows however often an id is repeated.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
    marked = marked.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    if trains is not None:
        marked = marked.where(trains)
    marked = marked.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    drawn = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # A broadcast of `rows` pairs of numbers at most.
    mine = texts_of(docs, id_col, text_col).join(F.broadcast(drawn), "doc_id")
    one = mine.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("first"))
    return one.select("first.text", "label", "first.mark")


def fitted(rows: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes:
    """What `fit` makes of all rows in one task; the caller bounds the rows. Empty without rows.

    The rows come in order of `mark`, a hash of the text, then of the label, so that neither the
    partitions nor a repeated task change what is learned.
    """
    order = [("mark", "ascending"), ("label", "ascending")]
    one = rows.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(
        lambda table: pa.table({"model": pa.array([fit(table.sort_by(order))], pa.binary())}), "model binary"
    )
    found = one.first()
    return bytes(found["model"]) if found else b""
