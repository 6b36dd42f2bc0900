"""Hard negatives for anchors by exact inner-product search over length buckets.

Vectors of one label, longest first, are cut into buckets. A bucket keeps, for each coordinate, its
unit vectors' values in order. If an anchor needs a score of t, a vector of the bucket must lie
within an angle of acos(t / (length of the anchor x greatest length of the bucket)); buckets that
cannot reach t are skipped, and for the coordinates in which the anchor is largest, its focus, that
angle gives a range of feasible values. The sorted list of the narrowest range gives the candidates,
the ranges of the other focus coordinates intersect them, and what is left is verified by its exact
product. t is the score the anchor's lists hold already, so it rises from bucket to bucket.

Vectors stay where they are, in parts of bounded size; blocks of anchors, a small share of the rows,
are sent to the parts and pass through them one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoprec.llm.common import spool

#: Vectors of a bucket, anchors of a block, bytes of vectors that a task holds.
BUCKET, BLOCK, PART_BYTES = 2048, 512, 32 << 20
#: Coordinates whose ranges are intersected.
FOCUS = 4
#: Share of a bucket that the ranges leave, as if independent, from which one product of all of it verifies.
WIDE = 0.25
_ANCHOR, _NAMELESS = 1, 2
_LAST = np.iinfo(np.int64).max

_BLOCKS = "part long, kind int, no long, label string, uids binary, ids binary, flags binary, vectors binary, wants binary"
_FOUND = "anchor long, anchor_id long, band int, positive_id long, positive_score long, other long, other_id long, score long"


@dataclass(frozen=True)
class Shape:
    """Of all vectors: components, storage type, and whether products are exact in doubles."""

    width: int
    kind: str
    exact: bool

    def rows(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.kind).reshape(-1, self.width)

    def numbers(self, rows: np.ndarray) -> np.ndarray:
        return rows.astype(np.float64 if self.exact else np.int64)


@dataclass
class Bucket:
    """Vectors of one label, with their coordinates' sorted lists, made when first asked for."""

    label: str
    uids: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    lengths: np.ndarray = field(init=False)
    lists: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.lengths = np.sqrt((self.rows.astype(np.float64) ** 2).sum(axis=1))
        self.longest = self.lengths.max()

    def unit(self, f: int) -> np.ndarray:
        return self.rows[:, f] / np.where(self.lengths > 0, self.lengths, 1.0)

    def sorted(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of a coordinate in order, and whose they are."""
        if f not in self.lists:
            values = self.unit(f)
            order = np.argsort(values, kind="stable")
            self.lists[f] = values[order], order
        return self.lists[f]


class Asking:
    """Anchors of one label and the best of what they have met, by bands of score.

    Each band keeps the first k of the rows whose score lies in it; `low` is the least score that can
    still enter a list of the anchor.
    """

    def __init__(self, rows: np.ndarray, uids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> None:
        self.rows, self.uids, self.k = rows, uids, k
        self.bottom, self.top = low, high  # anchors x bands, a void band has bottom > top
        n, width = rows.shape
        self.lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
        unit = rows / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        m = min(FOCUS, width)
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :m]
        self.angle = np.arccos(np.clip(np.take_along_axis(unit, self.focus, axis=1), -1, 1))
        void = low > high
        self.low = np.where(void, _highest(low), low).min(axis=1)
        self.high = np.where(void, _lowest(low), high).max(axis=1)
        self.dead = void.all(axis=1)
        none = np.empty(0, np.int64)
        self.held = [(np.empty(0, rows.dtype), none, none)] * n
        self.verified = 0

    def meet(self, bucket: Bucket, shape: Shape) -> None:
        live = np.flatnonzero(~self.dead & (np.maximum(self.low, 0) <= self.lengths * bucket.longest * (1 + 1e-9)))
        if not len(live):
            return
        size = len(bucket.ids)
        low, high = self._ranges(live, bucket)
        first, last = np.zeros(low.shape, np.int64), np.full(low.shape, size)
        for f in np.unique(self.focus[live]).tolist():
            at = np.nonzero(self.focus[live] == f)
            if (low[at] > -1).any() or (high[at] < 1).any():
                values, _ = bucket.sorted(f)
                first[at] = np.searchsorted(values, low[at], side="left")
                last[at] = np.searchsorted(values, high[at], side="right")
        found = last - first
        narrow = (found / size).prod(axis=1) < WIDE
        wide = np.flatnonzero(~narrow)
        if len(wide):
            scores = self.rows[live[wide]] @ shape.numbers(bucket.rows).T
            self.verified += scores.size
            for i, row in zip(live[wide].tolist(), scores, strict=True):
                self._take(i, row, bucket, None)
        for j in np.flatnonzero(narrow).tolist():
            i, order = live[j], np.argsort(found[j], kind="stable")
            f = int(self.focus[i, order[0]])
            some = bucket.sorted(f)[1][first[j, order[0]] : last[j, order[0]]]
            for c in order[1:].tolist():
                if not len(some):
                    break
                values = bucket.unit(int(self.focus[i, c]))[some]
                some = some[(values >= low[j, c]) & (values <= high[j, c])]
            if len(some):
                self.verified += len(some)
                self._take(int(i), shape.numbers(bucket.rows[some]) @ self.rows[i], bucket, some)

    def _ranges(self, live: np.ndarray, bucket: Bucket) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest feasible value of each focus coordinate. A score of at most 0 binds none."""
        reach = self.lengths[live] * bucket.longest
        low = self.low[live].astype(np.float64)
        spread = np.where(low > 0, np.arccos(np.clip(low / np.where(reach > 0, reach, 1.0), -1, 1)), np.pi)[:, None]
        near = np.maximum(self.angle[live] - spread - 1e-7, 0)
        far = np.minimum(self.angle[live] + spread + 1e-7, np.pi)
        return np.cos(far), np.cos(near)

    def _take(self, i: int, scores: np.ndarray, bucket: Bucket, some: np.ndarray | None) -> None:
        good = (scores >= self.low[i]) & (scores <= self.high[i])
        own = bucket.uids if some is None else bucket.uids[some]
        good &= own != self.uids[i]
        if good.sum() > 4 * self.k and self.bottom.shape[1] == 1:  # more than one list takes
            kept = scores[good]
            good &= scores >= np.partition(kept, -self.k)[-self.k]
        at = np.flatnonzero(good)
        if not len(at):
            return
        place = at if some is None else some[at]
        held = self.held[i]
        s = np.concatenate([held[0], scores[at]])
        ids = np.concatenate([held[1], bucket.ids[place]])
        uids = np.concatenate([held[2], bucket.uids[place]])
        order = np.lexsort((uids, ids, -s))
        s, ids, uids = s[order], ids[order], uids[order]
        used = np.zeros(len(s), bool)
        least = _highest(s)
        for a, b in self._bands(i, s):
            used[a:b] = True
        for j in range(self.bottom.shape[1]):
            if self.bottom[i, j] <= self.top[i, j]:
                a, b = self._bands(i, s)[j]
                least = min(least, s[b - 1] if b - a == self.k else self.bottom[i, j])
        self.low[i] = max(self.low[i], least)
        self.held[i] = s[used], ids[used], uids[used]

    def _bands(self, i: int, s: np.ndarray) -> list[tuple[int, int]]:
        """For each band, from where to where its list goes in the falling scores."""
        out = []
        for low, high in zip(self.bottom[i], self.top[i], strict=True):
            a = int(np.searchsorted(-s, -high, side="left"))
            b = int(np.searchsorted(-s, -low, side="right"))
            out.append((a, max(a, min(b, a + self.k))))
        return out

    def lists(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor's place, band, scores, ids, uids)."""
        for i in range(len(self.uids)):
            s, ids, uids = self.held[i]
            if len(s):
                for j, (a, b) in enumerate(self._bands(i, s)):
                    if b > a:
                        yield i, j, s[a:b], ids[a:b], uids[a:b]


def _highest(like: np.ndarray):
    return np.inf if like.dtype.kind == "f" else np.iinfo(np.int64).max


def _lowest(like: np.ndarray):
    return -np.inf if like.dtype.kind == "f" else np.iinfo(np.int64).min + 1


def _block(rows: list[tuple], shape: Shape, part: int, kind: int, no: int) -> tuple:
    """(label, uid, id, flags, vector, wants) rows of one label as a row of _BLOCKS."""
    vectors = np.zeros((len(rows), shape.width), shape.kind)
    for k, row in enumerate(rows):
        v = row[4]
        if isinstance(v, bytes):
            vectors[k] = np.frombuffer(v, shape.kind)
        else:
            vectors[k, : len(v)] = v
    ids = np.array([_LAST if r[2] is None else r[2] for r in rows], np.int64)
    uids = np.array([r[1] for r in rows], np.int64) if rows[0][1] is not None else (
        (np.int64(part) << 40) + (np.int64(no) << 16) + np.arange(len(rows), dtype=np.int64)
    )
    flags = np.array([r[3] | (_NAMELESS if r[2] is None else 0) for r in rows], np.uint8)
    wants = b"".join(r[5] for r in rows)
    return part, kind, no, rows[0][0], uids.tobytes(), ids.tobytes(), flags.tobytes(), vectors.tobytes(), wants


def _packed(rows: DataFrame, shape: Shape, most: int, kind: int) -> DataFrame:
    """Blocks of at most `most` rows of one label, in the order of the rows in each task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, no, held = TaskContext.get().partitionId(), 0, []
        names = ["part", "kind", "no", "label", "uids", "ids", "flags", "vectors", "wants"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), *[pa.binary()] * 5]

        def batch_of(row: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("label", "uid", "id", "flags", "vector", "wants")], strict=True):
                if held and (held[0][0] != row[0] or len(held) == most):
                    yield batch_of(_block(held, shape, part, kind, no))
                    no, held = no + 1, []
                held.append(row)
        if held:
            yield batch_of(_block(held, shape, part, kind, no))

    return rows.mapInArrow(pack, _BLOCKS)


def _searched(blocks: DataFrame, parts: int, shape: Shape, k: int, same: bool, percent: tuple[int, int]) -> DataFrame:
    """_FOUND rows for the anchors (kind 1) sent to each part's buckets (kind 0): the first k of the
    same label, or for each positive in `wants` the first k of other labels in its band."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, buckets = None, []
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                if row["part"] != part:
                    part, buckets = row["part"], []
                uids, ids = (np.frombuffer(row[c], np.int64) for c in ("uids", "ids"))
                if row["kind"] == 0:
                    buckets.append(Bucket(row["label"], uids, ids, shape.rows(row["vectors"])))
                    continue
                rows = shape.numbers(shape.rows(row["vectors"]))
                wants = np.frombuffer(row["wants"], np.int64).reshape(len(uids), -1, 2)
                if same:
                    low = np.full((len(uids), 1), _lowest(rows), rows.dtype)
                    high = np.full((len(uids), 1), _highest(rows), rows.dtype)
                else:
                    whole, rest = np.divmod(wants[:, :, 1], 100)  # no product of a score leaves 64 bits
                    low = (percent[0] * whole - (-percent[0] * rest // 100)).astype(rows.dtype)
                    high = (percent[1] * whole + percent[1] * rest // 100).astype(rows.dtype)
                asking = Asking(rows, uids, low, high, k)
                for bucket in sorted(buckets, key=lambda b: -b.longest):
                    if (bucket.label == row["label"]) == same:
                        asking.meet(bucket, shape)
                flags = np.frombuffer(row["flags"], np.uint8)
                out = []
                for i, j, s, others, names in asking.lists():
                    own = None if flags[i] & _NAMELESS else int(ids[i])
                    positive = (None, None) if same else wants[i, j].tolist()
                    for score, other, name in zip(s.tolist(), others.tolist(), names.tolist(), strict=True):
                        out.append((int(uids[i]), own, j, *positive, name, other, int(score)))
                if out:
                    cols = list(zip(*out, strict=True))
                    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
                    names = ["anchor", "anchor_id", "band", "positive_id", "positive_score", "other", "other_id", "score"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    placed = blocks.repartition(parts, "part").sortWithinPartitions("part", "kind", "no")
    return placed.mapInArrow(search, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and band over all parts, with their rank."""
    order = Window.partitionBy("anchor", "band").orderBy(F.col("score").desc(), "other_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   percent: tuple[int, int] = (80, 100), id_col: str = "vec_id", vec_col: str = "vector",
                   label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of integer vectors.

    An anchor's positives are its first other rows of the same label by falling inner product, then
    by id, a null id last. For each positive the negatives are the first rows of other labels whose
    score is between percent[0] and percent[1] hundredths of the positive's. Rows with a null label, vector or
    component take no part. A shorter vector counts as filled with zeros. Rows that repeat an id are
    rows of their own, and each is an anchor if its id is one. An anchor without a positive, or
    without a negative, gives no row. Other columns are not looked at. Without rows, or without
    anchors, the result is empty. Products must fit 64 bits.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(label_col).cast("string").alias("label"), F.col(id_col).cast("long").alias("id"),
        F.when(is_anchor, _ANCHOR).otherwise(0).alias("flags"), F.col(vec_col).cast("array<long>").alias("vector"),
    ).where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rows = rows.withColumn("length", length)
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    size = rows.agg(
        F.count("*").alias("n"), F.coalesce(F.sum("flags"), F.lit(0)).alias("anchors"), F.max(F.size("vector")).alias("width"),
        F.coalesce(F.max(largest), F.lit(0)).alias("largest"), F.coalesce(F.max("length"), F.lit(0.0)).alias("length"),
    ).first()
    width = max(1, size["width"] or 0)
    kind = next((t for t in ("<i2", "<i4") if size["largest"] <= np.iinfo(t).max), "<i8")
    shape = Shape(width, kind, size["length"] < 2.0**53)
    cores = spark.sparkContext.defaultParallelism
    parts = max(-(-size["n"] * width * int(kind[-1]) // PART_BYTES), min(2 * cores, -(-size["n"] // 64)), 1)

    # Each label's rows, longest first, in ranges; equal rows too may be cut.
    order = ["label", F.col("length").desc(), "id", "place"]
    ranged = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    plain = [F.lit(None).cast("long").alias("uid"), F.lit(b"").alias("wants")]
    buckets = spool(_packed(ranged.select("label", "id", "flags", "vector", *plain), shape, BUCKET, 0), "buckets")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                flags = np.frombuffer(row["flags"], np.uint8)
                at = np.flatnonzero(flags & _ANCHOR)
                uids, ids = (np.frombuffer(row[c], np.int64)[at] for c in ("uids", "ids"))
                own = shape.rows(row["vectors"])[at]
                null = (flags[at] & _NAMELESS) > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["label"]] * len(at), pa.string()), pa.array(uids), pa.array(ids, mask=null),
                     pa.array(flags[at].astype(np.int32)), pa.array([v.tobytes() for v in own], pa.binary())],
                    ["label", "uid", "id", "flags", "vector"],
                )

    anchors = spool(buckets.mapInArrow(pick, "label string, uid long, id long, flags int, vector binary"), "anchors")

    def blocks(rows: DataFrame) -> DataFrame:
        """Blocks of anchors for one part each, without the part."""
        ways = max(1, min(2 * cores, size["anchors"] // BLOCK), size["anchors"] // (16 * BLOCK))
        ranged = rows.repartitionByRange(ways, "label", "uid").sortWithinPartitions("label", "uid")
        return _packed(ranged, shape, BLOCK, 1).drop("part")

    # First the anchors meet the parts that hold their own label.
    columns = buckets.columns
    own = buckets.select("part", "label").distinct()
    asked = blocks(anchors.withColumn("wants", F.lit(b""))).join(own, "label").select(*columns)
    near = _searched(buckets.unionByName(asked), parts, shape, positives, True, percent)
    found = spool(_first(near, positives), "positives")

    # Then, with the bands of their positives, all parts that may reach one.
    wanted = found.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("other_id").alias("id"), "score"))).alias("list")
    )  # at most `positives` entries
    asked = anchors.join(wanted, F.col("uid") == F.col("anchor")).drop("anchor")

    def wants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for entry in batch["list"].to_pylist():
                flat = np.zeros((positives, 2), np.int64)
                flat[:, 1] = -1  # a negative score has an empty band
                for j, x in enumerate(entry):
                    flat[j] = x["id"], x["score"]
                lists.append(flat.tobytes())
            keep = ["label", "uid", "id", "flags", "vector"]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], pa.array(lists, pa.binary())], [*keep, "wants"])

    asked = asked.mapInArrow(wants, "label string, uid long, id long, flags int, vector binary, wants binary")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")
    others = buckets.groupBy("part").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    asked = (
        blocks(asked).select("*", every).join(others, "part")
        .where((F.col("x") != F.col("label")) | (F.col("y") != F.col("label"))).select(*columns)
    )
    far = _searched(buckets.unionByName(asked), parts, shape, negatives, False, percent)
    nameless = lambda c: F.when(F.col(c) != int(_LAST), F.col(c))
    return _first(far, negatives).select(
        "anchor_id", nameless("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        nameless("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
