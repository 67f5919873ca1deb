"""WARC archives compressed with a shared dictionary.

A file begins with a skippable frame that holds a Zstandard dictionary built from archived records; every record
after it is a frame of its own, compressed with that dictionary, so single records can be read by offset. Payloads
seen before are written as revisit records that refer to the response.

Files are written by the tasks under names of their own attempt; only the files of successful attempts are listed
in the manifest, so a repeated task leaves at most an unlisted file behind.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import fresh_path, settle

# The skippable frame that marks a dictionary, and the magic number of a compressed frame.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"

# Bounds of the dictionary and of the different payloads it is built from; they are chosen by hash over the whole
# table, and longer ones than SAMPLE_BYTES are taken as far as shorter ones leave room.
DICTIONARY_BYTES = 64 << 10
SAMPLE_PAYLOADS = 400
SAMPLE_BYTES = 8 << 10
LEVEL = 3
# Fixed value: the capture time of pages that state none, so that equal tables give equal archives.
NO_DATE = "1970-01-01T00:00:00Z"
# A task begins a new file beyond this many compressed bytes.
FILE_BYTES = 64 << 20
# Shared payloads are looked up by broadcast up to this many (about 100 bytes each), by shuffle beyond.
BROADCAST_PAYLOADS = 200_000
# Files beyond this many share reading tasks.
MOST_READERS = 10_000
_READ_BYTES = 64 << 10
_BATCH_BYTES = 4 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def _record(kind: str, record_id: str, url: str, payload: bytes, payload_digest: str, payload_bytes: int,
            refers_to: str | None, date: str = NO_DATE) -> bytes:
    """One record of WARC 1.1. Its block is an HTTP response: a head and the payload, of a revisit the head alone,
    with the digest and length of the payload that it stands for."""
    def clean(value: str) -> str:
        return "".join(c if c.isprintable() else "%" + c.encode("utf-8", "replace").hex() for c in value)

    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
             f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{payload_digest}",
             f"X-Payload-Length: {payload_bytes}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _urn(page_id: int | None, copy: int) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{copy}"


def build_dictionary(pages: DataFrame) -> bytes:
    """A dictionary of bounded size, trained on the records of a bounded number of different payloads.

    Payloads are drawn by their hash, so only numbers are ranked and copies count once; they are read after. Where
    there is too little to train on, the records themselves are the dictionary; it is empty for an empty table only.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce(F.col("url"), F.lit("")).alias("url"),
                        payload.alias("payload"), F.xxhash64(payload).alias("draw"))
    drawn = (rows.groupBy("draw").agg(F.max(F.octet_length("payload")).alias("size"))
             .orderBy("draw").limit(SAMPLE_PAYLOADS).collect())
    if not drawn:
        return b""
    most = _longest([row["size"] for row in drawn], SAMPLE_PAYLOADS * SAMPLE_BYTES)
    chosen = (rows.where(F.col("draw") <= drawn[-1].draw)
              .select("draw", F.struct("page_id", "url").alias("page"), F.substring("payload", 1, most).alias("start"))
              .groupBy("draw").agg(F.min("page").alias("page"), F.first("start").alias("start")).collect())
    samples = sorted(_record("response", _urn(row.page.page_id, 0), row.page.url, bytes(row.start), digest(row.start),
                             len(row.start), None) for row in chosen)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=200, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little to learn from
        return b"".join(samples)[:DICTIONARY_BYTES]


def _longest(sizes: list[int], total: int) -> int:
    """The length to cut at so that all together have at most ``total`` bytes; nothing is cut if they have."""
    left = total
    for k, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - k) > left:
            return left // (len(sizes) - k)
        left -= size
    return max(1, *sizes)


def _with_holders(pages: DataFrame, date: Column) -> DataFrame:
    """Every page with its ``copy`` number and, where an equal payload is elsewhere, the page that is its response."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce(F.col("url"), F.lit("")).alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("sha1"), date.alias("date"))
    groups = (rows.groupBy("sha1", "page_id").agg(F.count("*").alias("copies"))
              .groupBy("sha1").agg(F.max("page_id").alias("holder"), F.sum("copies").alias("pages"),
                                   F.max("copies").alias("most")))
    shared = settle(groups.where("pages > 1").select(F.col("sha1").alias("_sha1"), "holder", "most"), "shared_payloads")
    if shared.count() <= BROADCAST_PAYLOADS:
        shared = F.broadcast(shared)
    held = rows.join(shared, F.col("sha1") == F.col("_sha1"), "left").drop("_sha1")
    single = held.where(F.col("most").isNull() | (F.col("most") == 1)).withColumn("copy", F.lit(0).cast("long"))
    # Rows equal in id and payload: the one stored first is copy 0, the others are numbered as they were stored.
    repeated = settle(held.where("most > 1").withColumn("_row", F.monotonically_increasing_id() + 1), "repeated_pages")
    first = repeated.groupBy(F.col("sha1").alias("_sha1"), F.col("page_id").alias("_id")).agg(F.min("_row").alias("_first"))
    numbered = (repeated.join(first, (F.col("sha1") == F.col("_sha1")) & F.col("page_id").eqNullSafe(F.col("_id")))
                .withColumn("copy", F.when(F.col("_row") == F.col("_first"), 0).otherwise(F.col("_row")))
                .select(*single.columns))
    return single.unionByName(numbered)


def write(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, captured_at: str | None = None) -> DataFrame:
    """Write all ``pages(page_id, url, html)`` under ``folder``; the manifest ``path, records, bytes`` of the files.

    Of pages with equal payloads of at least ``min_revisit_bytes`` the one with the largest page_id is the response
    and the others revisit it. Rows that are equal in id and payload are one response and revisits of it; if no page
    of a payload has an id, each of them is a response. A null url or html is empty. ``captured_at`` names a timestamp
    column for the records' date, in UTC by the session's zone; without it, or where it is null, the date is ``NO_DATE``.
    Other columns are not read. A page of any length is one record, held whole by one task. An empty table gives an
    empty manifest and no file.
    """
    zone = F.current_timezone()
    stated = F.lit(None).cast("string") if captured_at is None else F.date_format(
        F.to_utc_timestamp(F.col(f"`{captured_at}`"), zone), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = _with_holders(pages, F.coalesce(stated, F.lit(NO_DATE)))
    dictionary = build_dictionary(pages)
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, shared.value)
        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(6)), strict=True):
                page_id, url, payload, copy, holder, date = (v.as_py() for v in row)
                held = holder is not None and len(payload) >= min_revisit_bytes and (page_id, copy) != (holder, 0)
                files.add(_record("revisit" if held else "response", _urn(page_id, copy), url, payload, digest(payload),
                                  len(payload), _urn(holder, 0) if held else None, date))
        yield files.close()

    return settle(rows.select("page_id", "url", "payload", "copy", "holder", "date")
                  .mapInArrow(run, "path string, records long, bytes long"), "warc_manifest")


class _Files:
    """The files one task attempt writes."""

    def __init__(self, folder: str, dictionary: bytes):
        self.folder, self.dictionary = folder, dictionary
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True)
        self.stream = None
        self.done: list[tuple[str, int, int]] = []

    def add(self, record: bytes) -> None:
        if self.stream is None:
            system, base = _open(self.folder)
            system.create_dir(base, recursive=True)
            name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.zst"
            self.path, self.records, self.size = f"{self.folder}/{name}", 0, 0
            self.stream = system.open_output_stream(f"{base}/{name}")
            if self.dictionary:
                self._put(struct.pack("<II", DICTIONARY_FRAME, len(self.dictionary)) + self.dictionary)
        self._put(self.compressor.compress(record))
        self.records += 1
        if self.size > FILE_BYTES:
            self._finish()

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def _finish(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((self.path, self.records, self.size))
            self.stream = None

    def close(self) -> pa.RecordBatch:
        self._finish()
        columns = list(zip(*self.done, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "records", "bytes"])


def records(path: str) -> Iterator[bytes]:
    """The records of a file, one at a time; the dictionary comes from the file itself."""
    system, name = _open(path)
    with system.open_input_stream(name) as stream:
        held = stream.read(8)
        known = None
        if len(held) == 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_FRAME:
            known = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", held[4:])[0]))
            held = b""
        reader = zstandard.ZstdDecompressor(dict_data=known)
        while True:
            if not held and not (held := stream.read(_READ_BYTES)):
                return
            frame, parts = reader.decompressobj(), []
            while not frame.eof:
                if not held and not (held := stream.read(_READ_BYTES)):
                    raise ValueError(f"{path} ends inside a record")
                parts.append(frame.decompress(held))
                held = frame.unused_data
            yield b"".join(parts)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[:int(headers["Content-Length"])]


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP head of a record's block."""
    return block.partition(b"\r\n\r\n")[2]


def read(manifest: DataFrame) -> DataFrame:
    """Every record of the listed files: its page, kind, payload and what the headers say of it.

    ``payload`` is null for a revisit. One task reads a file, record by record.
    """
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("url", pa.string()),
                        ("payload", pa.binary())])

    def page(urn: str | None) -> int | None:
        number = urn.strip("<>").split(":")[2] if urn else ""
        return int(number) if number else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for headers, block in map(parse, records(path)):
                    revisit, payload = headers["WARC-Type"] == "revisit", payload_of(block)
                    stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and digest(payload) != stated:
                        raise ValueError(f"{path}: the payload of {headers['WARC-Record-ID']} is damaged")
                    rows.append({"page_id": page(headers["WARC-Record-ID"]), "record_type": headers["WARC-Type"],
                                 "refers_to": page(headers.get("WARC-Refers-To")),
                                 "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": stated,
                                 "url": headers["WARC-Target-URI"], "payload": None if revisit else payload})
                    size += len(block)
                    if size > _BATCH_BYTES or len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    # An explicit number of tasks: adaptive execution would put a list of so few bytes into one.
    files = max(1, min(manifest.count(), MOST_READERS))
    return manifest.select("path").repartition(files, "path").mapInArrow(
        run, "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, url string, "
             "payload binary")


def archive_folder(df: DataFrame) -> str:
    return fresh_path(df.sparkSession, "warc")
