"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark's setting to remove the shuffle files of a query when it ends.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def builder(app: str = "shoprec") -> SparkSession.Builder:
    """Session builder. Master, memory and shuffle width are left to spark-submit."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def shared_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, or None when it names none."""
    return spark.conf.get(CHECKPOINT_CONF, None) or None


def use_checkpoints(spark: SparkSession) -> bool:
    """Point the context at the shared folder; True when reliable checkpoints are available."""
    sc = spark.sparkContext
    folder = shared_dir(spark)
    if sc.getCheckpointDir() is None and folder:
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() is not None


def keep(df: DataFrame) -> DataFrame:
    """A result that several later steps read: a checkpoint in the shared folder, which outlives
    lost executors; without such a folder it is persisted."""
    if use_checkpoints(df.sparkSession):
        return df.checkpoint()
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile drops the shuffle files that led to it as soon as it is written; else they stay
    until the driver happens to collect its garbage."""
    before = spark.conf.get(_TIDY, "false")
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(_TIDY, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """As `keep`, for large results: a compressed table in the shared folder, whose shuffle files go."""
    spark = df.sparkSession
    if not use_checkpoints(spark):
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = work_dir(spark, name)
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove the files of results of `stored` that nothing reads any more; persisted ones are left to the caller."""
    for df in tables:
        if at := getattr(df, "_stored_at", None):
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(conf).delete(path, True)


def drop_files(spark: SparkSession) -> None:
    """Drop the shuffle files and stored blocks that nothing refers to any more.

    Spark does so when the driver's memory is collected, which a driver with much memory to spare seldom does.
    """
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder. Without one, a temporary folder in local mode only."""
    folder = shared_dir(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="shoprec-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"
