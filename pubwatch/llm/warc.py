"""WARC archives of pages: an index of every record, and coalesced byte-range reads through it.

Each record is a gzip member of its own, so a record can be read alone. The tasks that write the
archives return offset, length, URL and digest per record; those rows are the index, and only
archives that the index names count. A task that runs twice writes a second file under another
name, which nothing refers to. Reading starts from index rows: they are sorted by archive and
offset, neighbours join into one read, and the members are cut out of it.

Archives lie in a store that pyarrow opens (``file:``, ``s3:``, ``gs:``, ``hdfs:``) and that all
executors share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
BATCH_ROWS = 512
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "archive string, offset bigint, length bigint, url string, payload_digest string,"
    " record_type string, id {id}, refers_to {id}"
)


def _record_id(key: object) -> str:
    return f"<urn:record:{key}>"


def _line(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict, captured: str) -> bytes:
    """One WARC record; ``row`` has id, url, payload, digest, payload_bytes, refers_to."""
    revisit = row["refers_to"] is not None
    body = b"" if revisit else row["payload"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(row['id'])}",
        f"WARC-Date: {captured}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
        f"Content-Length: {len(http) + len(body)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_line(row['url'])}")
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(row['refers_to'])}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Archive:
    """The open file of a task; a new one starts when it is full."""

    def __init__(self, root: str) -> None:
        self.store, self.root = fs.FileSystem.from_uri(root)
        self.store.create_dir(self.root, recursive=True)
        self.file = None

    def add(self, data: bytes) -> tuple[str, int]:
        if self.file is None:
            self.name, self.size = f"{uuid.uuid4().hex}.warc.gz", 0
            self.file = self.store.open_output_stream(f"{self.root}/{self.name}", compression=None)
        self.file.write(data)
        place = self.name, self.size
        self.size += len(data)
        if self.size >= ARCHIVE_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def write_archives(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    captured: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row below ``root``; the index of the records, as a lazy table.

    Write the index before using it: every evaluation writes archives anew. Of rows with equal
    payloads of at least ``min_bytes`` bytes, those with the smallest id are responses, the others
    revisits that refer to it.

    * A NULL payload counts as empty; a NULL URL leaves the URL header out.
    * A NULL id is never referred to: a group without any id consists of responses.
    * Rows that repeat the smallest id are all responses.
    * An empty table writes no archive; other columns are neither read nor stored.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    same = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("sha1", "payload_bytes")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .drop("n")
    )
    marked = rows.join(same, ["sha1", "payload_bytes"], "left")
    again = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    marked = marked.select(
        "id",
        "url",
        F.when(~again, F.col("payload")).alias("payload"),
        "sha1",
        "payload_bytes",
        F.when(again, F.col("first_id")).alias("refers_to"),
    )
    kind = marked.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(root)
        for batch in batches:
            index = []
            for start in range(0, batch.num_rows, BATCH_ROWS):
                for row in batch.slice(start, BATCH_ROWS).to_pylist():
                    row["digest"] = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    data = gzip.compress(record(row, captured), compresslevel=6, mtime=0)
                    name, offset = archive.add(data)
                    kept = "response" if row["refers_to"] is None else "revisit"
                    index.append(
                        (name, offset, len(data), row["url"], row["digest"], kept, row["id"], row["refers_to"])
                    )
            if index:
                columns = zip(*index, strict=True)
                types = [
                    pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                    batch.schema.field("id").type, batch.schema.field("id").type,
                ]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    arrays,
                    ["archive", "offset", "length", "url", "payload_digest", "record_type", "id", "refers_to"],
                )
        archive.close()

    return marked.mapInArrow(run, INDEX.format(id=kind))


def _ranges(entries: list[dict]) -> Iterator[list[dict]]:
    """Index rows of one archive by offset, cut into runs that one read fetches."""
    run: list[dict] = []
    for e in entries:
        if run:
            end = run[-1]["offset"] + run[-1]["length"]
            if e["offset"] - end > GAP_BYTES or e["offset"] + e["length"] - run[0]["offset"] > READ_BYTES:
                yield run
                run = []
        run.append(e)
    if run:
        yield run


def read_records(selected: DataFrame, root: str) -> DataFrame:
    """The records of the selected index rows: id, url, record_type, payload, payload_bytes,
    payload_digest, refers_to.

    Digest and size of a response come from the payload read; a revisit has no payload, and both
    come from its headers. Rows of one archive are read by one task: an archive has a bounded size.
    """
    kind = selected.schema["id"].dataType.simpleString()
    places = selected.select("archive", "offset", "length", "id", "refers_to")
    # index rows are small beside what they point to, so tasks are dealt by the bytes to read
    size = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(selected.sparkSession.sparkContext.defaultParallelism, -(-size // ARCHIVE_BYTES))
    sorted_places = places.repartition(tasks, "archive").sortWithinPartitions("archive", "offset")
    schema = (
        f"id {kind}, url string, record_type string, payload binary, payload_bytes bigint,"
        f" payload_digest string, refers_to {kind}"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            key = batch.schema.field("id").type
            by_archive: dict[str, list[dict]] = {}
            for entry in batch.to_pylist():
                by_archive.setdefault(entry["archive"], []).append(entry)
            for name, entries in by_archive.items():
                with store.open_input_file(f"{base}/{name}") as file:
                    for group in _ranges(entries):
                        yield _read(file, group, key)

    return sorted_places.mapInArrow(run, schema)


def _read(file: pa.NativeFile, group: list[dict], key: pa.DataType) -> pa.RecordBatch:
    first = group[0]["offset"]
    data = file.read_at(group[-1]["offset"] + group[-1]["length"] - first, first)
    rows = []
    for e in group:
        at = e["offset"] - first
        headers, payload = parse(gzip.decompress(data[at : at + e["length"]]))
        kept = headers["warc-type"]
        if kept == "response":
            size, digest = len(payload), base32_sha1(payload)
        else:
            size = int(headers["x-payload-length"])
            digest = headers["warc-payload-digest"].removeprefix("sha1:")
            if headers["warc-refers-to"] != _record_id(e["refers_to"]):
                raise ValueError(f"record {headers['warc-record-id']} is not what its index row says")
        if headers["warc-record-id"] != _record_id(e["id"]):
            raise ValueError(f"no record of {e['id']} at {e['offset']}")
        rows.append(
            (e["id"], headers.get("warc-target-uri"), kept, payload, size, digest, e["refers_to"])
        )
    types = [key, pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), key]
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    names = ["id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    return pa.RecordBatch.from_arrays(arrays, names)
