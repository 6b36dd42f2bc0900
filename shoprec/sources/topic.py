"""A folder of messages with numbered positions, read as a stream from any position.

Messages are lines of text files; a file's name is the position of its first line. The source is
written against Spark's Python Data Source interface and needs no connector package. Files are
opened through Arrow's file systems, which reach local and remote stores alike.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "message_folder"
SCHEMA = "value string, offset bigint"


def _source() -> type[DataSource]:
    """The source as local classes, which travel whole to the workers."""

    class Span(InputPartition):
        def __init__(self, path: str, first: int, start: int, end: int) -> None:
            self.path, self.first, self.start, self.end = path, first, start, end

    class Reader(DataSourceStreamReader):
        def __init__(self, options: dict) -> None:
            self.folder = options["path"]
            self.begin = options.get("startingoffsets", "earliest")
            self.lines: dict[str, int] = {}  # lines of files counted so far; a file is written once

        def _files(self) -> list[tuple[int, str]]:
            from pyarrow import fs

            system, path = fs.FileSystem.from_uri(self.folder) if ":/" in self.folder else (fs.LocalFileSystem(), self.folder)
            found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
            return sorted((int(f.base_name[:-4]), f.path) for f in found if f.base_name[:-4].isdigit() and f.base_name.endswith(".txt"))

        def _system(self):
            from pyarrow import fs

            return fs.FileSystem.from_uri(self.folder)[0] if ":/" in self.folder else fs.LocalFileSystem()

        def _end(self) -> int:
            files = self._files()
            if not files:
                return 0
            first, path = files[-1]
            if path not in self.lines:
                n = 0
                with self._system().open_input_stream(path) as f:
                    while block := f.read(1 << 20):
                        n += block.count(b"\n")
                self.lines[path] = n
            return first + self.lines[path]

        def initialOffset(self) -> dict:
            if self.begin == "latest":
                return {"position": self._end()}
            if self.begin == "earliest":
                files = self._files()
                return {"position": files[0][0] if files else 0}
            return {"position": int(self.begin)}

        def latestOffset(self) -> dict:
            return {"position": self._end()}

        def partitions(self, start: dict, end: dict) -> list[Span]:
            files, a, b = self._files(), start["position"], end["position"]
            stops = [*[first for first, _ in files[1:]], b][: len(files)]
            spans = [Span(p, f, max(a, f), min(b, stop)) for (f, p), stop in zip(files, stops, strict=True)]
            return [s for s in spans if s.start < s.end]

        def read(self, partition: Span) -> Iterator[tuple]:
            import io

            with self._system().open_input_stream(partition.path) as f:
                for at, line in enumerate(io.TextIOWrapper(f, "utf-8", newline="\n"), partition.first):
                    if at >= partition.end:
                        return
                    if at >= partition.start:
                        yield line.rstrip("\n"), at

    class MessageFolder(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema) -> Reader:
            return Reader(dict(self.options))

    return MessageFolder


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(_source())


def read_messages(spark: SparkSession, folder: str, start: str | int = "latest") -> DataFrame:
    """Stream of (value, offset) from `start`: "latest", "earliest" or a position. A stream that goes on
    from its checkpoint keeps its own place."""
    register(spark)
    return spark.readStream.format(FORMAT).option("startingOffsets", str(start)).load(folder)


def publish(messages: DataFrame, folder: str, first: int = 0) -> int:
    """Write (value, place) rows in order of `place` as the positions from `first`; returns the next one.

    One file a task. The numbers of rows of the tasks are all that the driver sees. Line breaks inside a
    message become spaces.
    """
    ordered = messages.select(F.translate("value", "\r\n", "  ").alias("value"), "place")
    spark = messages.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = ordered.repartitionByRange(width, "place").sortWithinPartitions("place")
    parts = parts.withColumn("part", F.spark_partition_id()).persist()
    try:
        sizes = {r["part"]: r["n"] for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect()}
        starts, at = {}, first
        for part in sorted(sizes):
            starts[part], at = at, at + sizes[part]

        def write(batches):
            import uuid

            import pyarrow as pa
            from pyarrow import fs

            system, path = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
            system.create_dir(path)
            out, name, part = None, f"{path}/_{uuid.uuid4().hex}", None
            for batch in batches:
                if batch.num_rows:
                    if out is None:
                        out, part = system.open_output_stream(name), batch["part"][0].as_py()
                    out.write("".join(f"{v or ''}\n" for v in batch["value"].to_pylist()).encode())
            if out is not None:
                out.close()
                system.move(name, f"{path}/{starts[part]:020d}.txt")  # a repeated task puts the same file there
                yield pa.RecordBatch.from_arrays([pa.array([starts[part]])], ["first"])

        parts.mapInArrow(write, "first bigint").count()
    finally:
        parts.unpersist()
    return at
