"""The k largest inner products of each query vector, exactly and without pairing all rows.

Items lie in parts of falling length. A first round takes each query to the part of the longest
items, which gives it k products; its k-th is a bound. As |q . v| <= |q| |v|, a query needs a later
part only while the length of the query times the part's greatest length reaches that bound, so it
stops at a place that is known before the second round. Queries that stop alike are put into blocks.
Neighbouring parts share a shelf; a block is sent once to each shelf before that place and to no other,
and meets the shelf's parts up to that place there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprec.functions.scalars import DIGITS, norm
from shoprec.operators.ranking import top_k
from shoprec.session import keep

#: Items of a part, queries of a block, blocks that meet a part in one task, about.
PART, BLOCK, TOGETHER = 8192, 2048, 16
#: Items of a shelf and queries that meet it in one task, at most, shelves and groups of queries if there are fewer,
#: and products that a task holds at once.
SIDE, WAYS, FRAME = 65_536, 8, 4_000_000
#: Items of the first part that give a query its first bound.
HEAD = 2048
_SLACK = 2.0 * 10.0**-DIGITS  # more than rounding can move a product

_PARTS = "part int, ids binary, vectors binary, longest double"
_FIRST = "id int, features array<double>, bound double, last int, found array<struct<other:int,score:double>>"


def _numbers(vectors: DataFrame) -> DataFrame:
    """(id, features, length) in doubles; rows without a vector or id are left out."""
    features = F.col("features").cast("array<double>")
    rows = vectors.select(F.col("id").cast("int").alias("id"), features.alias("features")).dropna()
    return rows.withColumn("length", norm(F.col("features")))


def item_parts(items: DataFrame, part: int = PART) -> tuple[DataFrame, np.ndarray]:
    """Items as packed parts, longest first, and the greatest length of each part: one number for
    about `part` items is all that comes to the driver."""
    rows = _numbers(items)
    count = max(1, -(-rows.count() // part))
    order = [F.col("length").desc(), "id"]
    placed = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, vectors, longest = [], [], 0.0
        for batch in batches:
            if batch.num_rows:
                ids.append(batch["id"].to_numpy())
                vectors.append(np.array(batch["features"].to_pylist(), float))
                longest = max(longest, pa.compute.max(batch["length"]).as_py())
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()),
                 pa.array([np.concatenate(ids).astype("<i4").tobytes()], pa.binary()),
                 pa.array([np.concatenate(vectors).astype("<f8").tobytes()], pa.binary()), pa.array([longest])],
                ["part", "ids", "vectors", "longest"],
            )

    parts = keep(placed.mapInArrow(pack, _PARTS))
    found = sorted((r["part"], r["longest"]) for r in parts.select("part", "longest").collect())
    longest = np.zeros(found[-1][0] + 1 if found else 0)
    for number, length in found:
        longest[number] = length
    return parts, np.maximum.accumulate(longest[::-1])[::-1]  # an empty part is no end


def first_lists(queries: DataFrame, parts: DataFrame, longest: np.ndarray, k: int, above: float | None = None,
                block: int = BLOCK) -> DataFrame:
    """(id, features, bound, last, found) of each query: its best in the first part, the product that
    others must reach, and the last part that may hold one."""
    floor = -np.inf if above is None else above
    slack, digits, some = _SLACK, DIGITS, HEAD
    # About `part` items, whatever the number of items.
    row = parts.where(F.col("part") == 0).first()
    ids = np.frombuffer(row["ids"] if row else b"", "<i4")
    home = queries.sparkSession.sparkContext.broadcast((ids, np.frombuffer(row["vectors"] if row else b"", "<f8")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, flat = home.value
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                rows = batch.slice(at, block)
                q = np.array(rows["features"].to_pylist(), float)
                raw = q @ flat.reshape(len(ids), q.shape[1]).T
                # The k-th product of the longest items is a bound for the k-th of all.
                low, head = np.full(len(q), -np.inf), raw[:, :some]
                if head.shape[1] >= k:
                    low = np.partition(np.where(np.isnan(head), -np.inf, head), -k, axis=1)[:, -k]
                at, to = np.nonzero(raw >= np.maximum(low, floor)[:, None] - slack)
                scores = np.round(raw[at, to], digits)
                at, to, scores = (x[scores > floor] for x in (at, to, scores))
                order = np.lexsort((ids[to], -scores, at))
                at, to, scores = at[order], to[order], scores[order]
                best = np.arange(len(at)) - np.searchsorted(at, at) < k
                at, to, scores = at[best], to[best], scores[best]
                counts = np.bincount(at, minlength=len(q))
                ends = np.cumsum(counts)
                bounds = np.full(len(q), floor)
                bounds[counts == k] = scores[ends[counts == k] - 1]
                length = np.sqrt((q * q).sum(axis=1))
                # A part is needed while length x longest >= bound; lengths of parts fall.
                reach = np.where(length > 0, (bounds - slack) / np.where(length > 0, length, 1.0), np.where(bounds > slack, np.inf, -np.inf))
                last = np.searchsorted(-longest, -reach, side="right") - 1
                entries = pa.StructArray.from_arrays([pa.array(ids[to], pa.int32()), pa.array(scores)], ["other", "score"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), entries)
                yield pa.RecordBatch.from_arrays(
                    [rows["id"], rows["features"], pa.array(bounds), pa.array(last.astype(np.int32)), lists],
                    ["id", "features", "bound", "last", "found"],
                )

    return _numbers(queries).select("id", "features").mapInArrow(search, _FIRST)


def _later(first: DataFrame, parts: DataFrame, k: int, above: float | None, block: int, together: int) -> DataFrame:
    """(id, other, score) of what reaches a query's bound in the parts behind the first."""
    spark = first.sparkSession
    left = first.where(F.col("last") > 0).select("id", "features", "bound", "last")
    count = left.count()
    ways = max(1, min(-(-count // block), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # What is moved grows with shelves x queries and groups of queries x items.
    salts = max(1, -(-count // max(block * together, min(SIDE, -(-count // WAYS)))))
    size = F.length("ids") / 4
    held = parts.where(F.col("part") > 0).agg(F.max(size).alias("most"), F.sum(size).alias("items")).first()
    most, items = int(held["most"] or 1), int(held["items"] or 0)
    shelf = max(1, min(SIDE, -(-items // WAYS)) // most)  # parts of one
    frame = FRAME
    placed = left.repartitionByRange(ways, F.col("last").desc(), "id").sortWithinPartitions(F.col("last").desc(), "id")
    floor, digits = -np.inf if above is None else above, DIGITS
    names = ["part", "salt", "kind", "ids", "vectors", "bounds"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    schema = "part int, salt int, kind int, ids binary, vectors binary, bounds binary"
    on_shelf = F.floor((F.col("part") - 1) / shelf).cast("int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                rows = batch.slice(at, block)
                last = int(pa.compute.max(rows["last"]).as_py())
                blobs = [
                    rows["id"].to_numpy().astype("<i4").tobytes(),
                    np.array(rows["features"].to_pylist(), "<f8").tobytes(),
                    np.concatenate([rows["bound"].to_numpy(), rows["last"].to_numpy().astype(float)]).tobytes(),
                ]
                number += 1
                row = [last, number % salts, 1, *blobs]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

    # A block goes to the shelves up to that of the last part of its queries, a shelf to each salt.
    blocks = placed.mapInArrow(pack, schema).withColumn("shelf", F.explode(F.sequence(F.lit(0), on_shelf)))
    homes = parts.where(F.col("part") > 0).select(
        "part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "ids", "vectors",
        F.lit(b"").alias("bounds"), on_shelf.alias("shelf"),
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, shelves = None, []
        ids, vectors, places = np.empty(0, "<i4"), np.empty((0, 0)), np.empty(0, int)
        for batch in batches:
            for row in (batch.slice(j, 1).to_pylist()[0] for j in range(batch.num_rows)):
                own = np.frombuffer(row["ids"], "<i4")
                rows = np.frombuffer(row["vectors"], "<f8").reshape(len(own), -1)
                if row["kind"] == 0:
                    if home != (row["shelf"], row["salt"]):
                        home, shelves = (row["shelf"], row["salt"]), []
                    shelves.append((own, rows, np.full(len(own), row["part"])))
                    continue
                if home != (row["shelf"], row["salt"]):
                    continue  # a shelf without items
                if shelves:
                    ids, vectors, places = (np.concatenate(x) for x in zip(*shelves, strict=True))
                    shelves = []
                bound, last = np.frombuffer(row["bounds"]).reshape(2, -1)
                some = np.flatnonzero(last >= places[0])
                step = max(1, frame // len(ids))
                for at_once in (some[i : i + step] for i in range(0, len(some), step)):
                    end = np.searchsorted(places, last[at_once].max(), side="right")
                    scores = np.round(rows[at_once] @ vectors[:end].T, digits)
                    keep_ = (scores >= bound[at_once][:, None]) & (scores > floor)
                    full = np.flatnonzero(keep_.sum(axis=1) > k)
                    for i in full.tolist():
                        good = np.flatnonzero(keep_[i])
                        best = good[np.lexsort((ids[good], -scores[i, good]))][:k]
                        keep_[i] = False
                        keep_[i, best] = True
                    at, to = np.nonzero(keep_)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[at_once][at], pa.int32()), pa.array(ids[to], pa.int32()), pa.array(scores[at, to])],
                        ["id", "other", "score"],
                    )

    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = homes.unionByName(blocks).repartition(width, "shelf", "salt").sortWithinPartitions("shelf", "salt", "kind", "part")
    return met.mapInArrow(search, "id int, other int, score double")


def max_products(queries: DataFrame, items: DataFrame, k: int, above: float | None = None, part: int = PART,
                 block: int = BLOCK, together: int = TOGETHER) -> DataFrame:
    """(id, other, score, rank): for each of the queries (id, features) the k items (id, features) with
    the largest inner products, those over `above` only if it is set.

    Products are rounded to six places, ties go to the smaller item. The result is exact. Ids are
    unique on each side; a row without id or vector takes no part; without items there are no lists.
    """
    parts, longest = item_parts(items, part)
    first = keep(first_lists(queries, parts, longest, k, above, block))
    found = first.select("id", F.explode("found").alias("x")).select("id", "x.other", "x.score")
    rows = found if len(longest) <= 1 else found.unionByName(_later(first, parts, k, above, block, together))
    return top_k(rows, "id", "score", "other", k)
