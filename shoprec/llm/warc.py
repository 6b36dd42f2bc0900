"""WARC archives of pages, and capture histories merged from their sorted index runs.

Pages are written as WARC/1.1 records, one gzip member each, into files in the shared folder. Equal
payloads are stored once: the page with the largest id as `response`, the others as `revisit`
records that refer to it. Reading a file back gives its captures sorted by URL key and time, a run.
Runs are exchanged by ranges of that key, and in each range a loser tree merges them, so that the
result is in the order of the key over all archives.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import spool, steps
from shoprec.llm.merging import merge_runs
from shoprec.session import work_dir

#: Uncompressed bytes after which a task begins another file.
FILE_BYTES = 128 << 20
#: Date of the pages of a table without times.
UNDATED = datetime(2000, 1, 1, tzinfo=timezone.utc)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then the path and query; null gives an empty key."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    tail = parts.path or "/"
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + tail + (
        f"?{parts.query}" if parts.query else ""
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _header(pairs: list[tuple[str, str | int | None]]) -> bytes:
    """Header lines; control characters of a value are percent-encoded, null values left out."""
    lines = ["WARC/1.1"]
    for name, value in pairs:
        if value is not None:
            text = "".join(quote(c) if ord(c) < 32 or ord(c) == 127 else c for c in str(value))
            lines.append(f"{name}: {text}")
    return "\r\n".join([*lines, "", ""]).encode()


def record(page_id: int | None, url: str | None, when: datetime, payload: bytes | None, size: int,
           digest: str, refers_to: int | None) -> bytes:
    """One WARC record; without a payload it is a revisit."""
    revisit = payload is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload or b"")
    head = _header([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", when.strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", _PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None),
        ("Page-ID", page_id),
        ("Refers-To-Page-ID", refers_to if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ])
    return head + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, HTTP header and payload of one record; ValueError where it is malformed."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("block of another length than stated")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, http, payload


def members(stream, block: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, contents) of the gzip members of a stream, one in memory at a time."""
    at, data = 0, stream.read(block)
    while data:
        unzip, out, used = zlib.decompressobj(31), [], 0
        while True:
            out.append(unzip.decompress(data))
            used += len(data)
            if unzip.eof:
                break
            data = stream.read(block)
            if not data:
                raise ValueError("the file ends within a record")
        data = unzip.unused_data
        used -= len(data)
        yield at, b"".join(out)
        at += used
        data = data or stream.read(block)


def _store(path: str):
    """File system and path within it, for any store Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  time_col: str | None = None, least: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row; returns (path, records) of the files written.

    Payload: the html as UTF-8, null as empty. Of rows with equal payloads of at least `least`
    bytes those with the largest id are responses, the others revisits; rows that repeat that id
    with the same payload are responses too, and so are all when each id is null. Rows without a
    time are dated by their id, in seconds from UNDATED. No row: no file. Each task attempt writes
    files of its own, and only those of attempts that succeeded are in the result.
    """
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    when = F.unix_timestamp(F.col(time_col).cast("timestamp")) if time_col else F.lit(None).cast("long")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        html.alias("payload"), when.alias("seconds"),
    ).withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    # The largest id of each payload: partial maxima first, so a hot payload is a few rows.
    kept = spool(rows.where(F.col("size") >= least).groupBy("sha").agg(F.max("page_id").alias("keeper")), "kept")
    revisit = (F.col("size") >= least) & F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    marked = rows.join(kept, "sha", "left").select(
        "page_id", "url", "seconds", "sha", "size",
        F.when(~revisit, F.col("payload")).alias("payload"), F.when(revisit, F.col("keeper")).alias("keeper"),
    )
    folder = work_dir(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, count = None, "", 0, 0
        store = None
        done: list[tuple[str, int]] = []
        for row in (r for batch in batches for step in steps(batch, "payload") for r in step.to_pylist()):
            if out is None:
                path, size, count = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                store, at = _store(path)
                store.create_dir(at.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(at, compression=None)
            digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
            dated = row["seconds"] if row["seconds"] is not None else None
            seconds = timedelta(seconds=(row["page_id"] or 0) % (1 << 31))
            day = datetime.fromtimestamp(dated, timezone.utc) if dated is not None else UNDATED + seconds
            raw = record(row["page_id"], row["url"], day, row["payload"], row["size"], digest, row["keeper"])
            zip_ = zlib.compressobj(1, zlib.DEFLATED, 31)
            out.write(zip_.compress(raw) + zip_.flush())
            size, count = size + len(raw), count + 1
            if size >= file_bytes:
                out.close()
                done.append((path, count))
                out = None
        if out is not None:
            out.close()
            done.append((path, count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
            ["path", "records"],
        )

    return spool(marked.mapInArrow(write, "path string, records long"), "warc-files")


CAPTURES = (
    "run string, place long, url_key string, time string, page_id long, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long, offset long"
)


def read_archives(files: DataFrame) -> DataFrame:
    """The captures in the files of (path): for each file a run sorted by URL key, time and page.

    A response's digest and length are those of the payload read, and a digest other than the
    header's raises; a revisit's are those of the payload it refers to.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for path in batch["path"].to_pylist():
                store, at = _store(path)
                run = []
                with store.open_input_stream(at, compression=None) as stream:
                    for offset, raw in members(stream):
                        fields, http, payload = parse(raw)
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(http.decode().rpartition("Content-Length: ")[2])
                        if kind == "response":
                            size = len(payload)
                            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                                raise ValueError(f"{path}, {offset}: payload and digest differ")
                        page, refers = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                        run.append((
                            url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"],
                            None if page is None else int(page), size, digest, kind,
                            None if refers is None else int(refers), offset,
                        ))
                run.sort(key=lambda r: (r[0], r[1], -1 if r[2] is None else r[2], r[7]))
                cols = list(zip(*[(path, i, *r) for i, r in enumerate(run)], strict=True))
                schema = pa.schema([
                    ("run", pa.string()), ("place", pa.int64()), ("url_key", pa.string()), ("time", pa.string()),
                    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("offset", pa.int64()),
                ])
                if cols:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema
                    )

    n = max(1, files.count())
    return spool(files.select("path").repartition(n).mapInArrow(read, CAPTURES), "captures")


def histories(captures: DataFrame) -> DataFrame:
    """Captures in the order of URL key, time and page over all runs; equal keys by run and offset.

    Ranges are cut on the whole key, so a URL with very many captures spreads over ranges.
    """
    names = [f.name for f in captures.schema]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*[batch[c].to_pylist() for c in names], strict=True):
                key = (row[2], row[3], -1 if row[4] is None else row[4], row[0], row[1])
                runs.setdefault(row[0], []).append((key, row))
        for run in runs.values():  # a run that came in several pieces is put in order first
            if any(a[0] > b[0] for a, b in zip(run, run[1:], strict=False)):
                run.sort()
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            cols = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, schema.field(n).type) for c, n in zip(cols, names, strict=True)], names
            )

        for _, row in merge_runs(runs[r] for r in sorted(runs)):
            out.append(row)
            if len(out) == 20_000:
                yield flushed()
                out = []
        if out:
            yield flushed()

    ranged = captures.repartitionByRange("url_key", "time", "page_id", "run", "place")
    return ranged.mapInArrow(merge, captures.schema)
