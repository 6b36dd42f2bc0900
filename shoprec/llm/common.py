"""Reading tables, intermediate tables in the shared folder, sub-batches of bounded size."""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprec.session import work_dir

#: Bytes of text that one step of a worker handles at once; a longer text is handled alone.
STEP_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spool(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, each later reader
    sees the same rows, and no executor's disk holds the only copy."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operator, dropped one by one when their last reader has run.

    A written table needs neither the shuffles that led to it nor the tables it was made from, so
    disk holds what is still to be read and not the whole history of a job.
    """

    #: Spark's setting to remove the shuffle files of a query when it ends.
    TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, str] = {}
        self.frames: dict[int, DataFrame] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        before = self.spark.conf.get(self.TIDY, "false")
        path = work_dir(self.spark, name)
        self.spark.conf.set(self.TIDY, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(self.TIDY, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)], self.frames[id(out)] = path, out  # the frame is held, so its id stays its own
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove tables written by this object; nothing may read them any more."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for frame in frames:
            self.frames.pop(id(frame))
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(frame)))
            path.getFileSystem(conf).delete(path, True)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty ones; all other columns are left behind, so that
    no column of the input can clash with those an operator makes."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def crc_mod(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def steps(batch: pa.RecordBatch, column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of text each, one row at least."""
    import numpy as np

    at, n = 0, batch.num_rows
    if n == 0:
        return
    col = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False))
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def worker_state(name: str, make: Callable[[], Any]) -> Any:
    """A value kept for the life of a Python worker, made on first use."""
    home = sys.modules.setdefault("_shoprec_worker_state", types.ModuleType("_shoprec_worker_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def id_crc(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
