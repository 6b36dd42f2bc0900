"""Token ids as Parquet list columns, laid out for selective reads.

A row is a document: doc_id, its number of tokens, the tokens of its task before it, and its ids.
Rows are in ascending order of doc_id, file after file. The list of ids is dictionary or delta
encoded, the other columns delta encoded; row groups and pages are small enough that a range of
documents reads few of them, and the page index tells which. A reader of lengths and places never
touches the ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoprec.llm.common import steps, texts_of, worker_state
from shoprec.llm.token_ids import Encoder
from shoprec.session import work_dir

SCHEMA = "doc_id long, n_tokens long, before long, ids array<int>"
#: Bytes of text that a worker encodes at once.
STEP = 4 << 20
#: Ids that a worker hands on in one batch, about.
BATCH = 1 << 20


@dataclass(frozen=True)
class Layout:
    """How the files are laid out. `ids` is the encoding of the list column: "dictionary" keeps each
    distinct id once a row group and packs the places in it, "delta" packs the differences.
    A file holds about `file_bytes` of text, a row group `group_bytes`, a page at most `page_rows`
    documents and about `page_bytes`."""

    ids: str = "dictionary"
    file_bytes: int = 64 << 20
    group_bytes: int = 16 << 20
    page_bytes: int = 64 << 10
    page_rows: int = 512
    compression: str = "zstd"

    def __post_init__(self) -> None:
        if self.ids not in ("dictionary", "delta"):
            raise ValueError(f"no such encoding of ids: {self.ids}")

    def options(self) -> dict[str, str]:
        off = {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "n_tokens", "before")}
        return off | {
            "compression": self.compression,
            "parquet.writer.version": "PARQUET_2_0",  # the version with delta encodings
            "parquet.enable.dictionary#ids.list.element": str(self.ids == "dictionary").lower(),
            "parquet.dictionary.page.size": str(1 << 20),
            "parquet.block.size": str(self.group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.page.write-checksum.enabled": "true",
        }


def encoded(texts: DataFrame, tokenizer: str) -> DataFrame:
    """Rows of SCHEMA for the (doc_id, text) rows of each task, in their order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_state(f"ids_{tokenizer}", lambda: Encoder(tokenizer))
        before = 0
        for batch in batches:
            for step in steps(batch, most=STEP):
                ids, edges = coder.encode(step["text"])
                at = 0
                while at < step.num_rows:
                    to = max(at + 1, int(np.searchsorted(edges, edges[at] + BATCH, side="right")) - 1)
                    own = edges[at : to + 1]
                    lists = pa.ListArray.from_arrays(
                        pa.array(own - own[0], pa.int32()), pa.array(ids[own[0] : own[-1]].view(np.int32))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [step["doc_id"].slice(at, to - at), pa.array(np.diff(own)), pa.array(before + own[:-1]), lists],
                        ["doc_id", "n_tokens", "before", "ids"],
                    )
                    at = to
                before += int(edges[-1])

    return texts.mapInArrow(encode, SCHEMA)


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, layout: Layout = Layout(),  # noqa: B008
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ids of each document, END behind them, and return the folder (a new one of the
    session's shared folder unless named).

    A null or empty text is END alone. Rows come by doc_id, a null id first; rows of one id by a hash
    of the text, so a repeated id does not bind rows to one file and equal rows stay as often as they
    come. Other columns are not looked at. Without rows there are no tokens.
    """
    path = path or work_dir(docs.sparkSession, "tokens")
    texts = texts_of(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    width = docs.sparkSession.sparkContext.defaultParallelism
    files = max(1, -(-size // layout.file_bytes), min(2 * width, size // (layout.file_bytes // 16)))
    order = ["doc_id", "hash", "place"]
    placed = texts.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    rows = placed.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    encoded(rows, tokenizer).write.options(**layout.options()).parquet(path)
    return path


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files, with the number of the task that wrote them."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return spark.read.schema(SCHEMA).parquet(path).withColumn("part", part)


def file_starts(files: DataFrame) -> DataFrame:
    """(of, base, all) for each task's rows: the tokens before them, and their own. Only lengths are
    read for it, and only sums, one of each task, meet in one place."""
    sums = files.groupBy(F.col("part").alias("of")).agg(F.sum("n_tokens").alias("all"))
    earlier = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("base", F.coalesce(F.sum("all").over(earlier), F.lit(0)))


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """`rows` of `files` with `start`, the tokens of all rows before them."""
    starts = file_starts(files).drop("all")
    return rows.join(starts, rows["part"] == starts["of"]).withColumn("start", F.col("base") + F.col("before")).drop("of", "base")


def places(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens) of all documents, from the narrow columns alone."""
    files = read_files(spark, path)
    return with_starts(files, read_files(spark, path)).select("doc_id", "start", "n_tokens")


def documents_between(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """(doc_id, ids) with low <= doc_id <= high; statistics of row groups and pages skip the rest."""
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("doc_id").between(low, high)).select("doc_id", "ids")


def tokens_between(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(doc_id, start, ids) of the tokens with start <= place < stop, place counted over all files.
    A document that is cut gives the part inside, `start` is the place of its first id there.

    Sums of lengths tell which files hold the range, so only those are opened (the list is as long
    as the range, not the corpus), and in the first and last of them `before` skips pages.
    """
    files = read_files(spark, path)
    inside = (F.col("base") < stop) & (F.col("base") + F.col("all") > start)
    hit = {r["of"]: r["base"] for r in file_starts(files).where(inside).collect()}
    narrow = files.select("part", F.col("_metadata.file_path").alias("file"))
    names = narrow.where(F.col("part").isin(list(hit))).distinct().collect() if hit else []
    found = None
    for part, base in sorted(hit.items()):
        rows = spark.read.schema(SCHEMA).parquet(*[r["file"] for r in names if r["part"] == part])
        rows = rows.where((F.col("before") < stop - base) & (F.col("before") + F.col("n_tokens") > start - base))
        if base < start:
            # No row begins before its file, so the last row that begins at or before the range is the first asked.
            edge = spark.read.schema(SCHEMA).parquet(*[r["file"] for r in names if r["part"] == part])
            first = edge.where(F.col("before") <= start - base).agg(F.max("before")).first()[0]
            rows = rows.where(F.col("before") >= first)
        rows = rows.withColumn("start", F.col("before") + base)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = spark.createDataFrame([], SCHEMA).withColumn("start", F.col("before"))
    skipped = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    taken = F.least(F.lit(stop) - F.col("start"), F.col("n_tokens")) - skipped
    return found.select(
        "doc_id", (F.col("start") + skipped).alias("start"),
        F.slice("ids", (skipped + 1).cast("int"), taken.cast("int")).alias("ids"),
    )


def token_summary(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document as read from the files: the crc32 of its
    ids as little-endian 32-bit numbers, and as many of them as the list holds."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            edges = lists.offsets.to_numpy()
            data = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")
            crcs = [zlib.crc32(data[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.diff(edges).astype(np.int64)), batch["before"], batch["part"],
                 pa.array(crcs, pa.int64())],
                ["doc_id", "n_tokens", "before", "part", "ids_crc32"],
            )

    files = read_files(spark, path)
    kind = "doc_id long, n_tokens long, before long, part long, ids_crc32 long"
    return with_starts(files.mapInArrow(check, kind), files).select("doc_id", "start", "n_tokens", "ids_crc32")
