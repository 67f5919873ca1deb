"""Exports of mixed encodings to clean UTF-8 lines, with a manifest and a quarantine.

One pass per file takes its SHA-256 and decides its encoding: byte-order mark, else UTF-8 if every byte
agrees, else the declared encoding. It streams, so a file of any size costs constant memory, and files
run in parallel. Lines of byte-oriented encodings are then read by Spark's own splittable reader; only
UTF-16 and UTF-32 files, which cannot be split at a byte, are decoded one file per task.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.workspace import settle

# the small functions below run on executors, which need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCK = 4 << 20
_BATCH = 20_000
# Byte-order marks; the 32-bit mark begins with the 16-bit one and is tried first.
_MARKS = (
    (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF8, "utf-8-sig"),
    (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))
_WIDE = ("utf-16", "utf-32")
# Bytes of a wide file that one task reads; a multiple of every code unit.
WIDE_RANGE = 16 << 20
MOST_TASKS = 10_000

FINGERPRINT = (
    "path string, source string, declared string, encoding_used string, sha256_in string, bytes_in bigint, "
    "decodable boolean, ascii_only boolean, ends_with_newline boolean")


def _open(path: str):
    """The file for reading, from any place in it."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", path)
    filesystem, inner = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(inner)


class _Probe:
    """Whether a byte stream decodes strictly, block by block."""

    def __init__(self, encoding: str):
        self.decoder = codecs.getincrementaldecoder(encoding)("strict")
        self.ok = True

    def feed(self, block: bytes, final: bool = False) -> None:
        if self.ok:
            try:
                self.decoder.decode(block, final)
            except UnicodeDecodeError:
                self.ok = False


def _fingerprint(path: str, declared: str) -> dict:
    digest, size, last, ascii_only = hashlib.sha256(), 0, b"", True
    with _open(path) as stream:
        first = stream.read(_BLOCK)
        marked = next((e for mark, e in _MARKS if first.startswith(mark)), None)
        probes = {e: _Probe(e) for e in ([marked] if marked else ["utf-8", declared])}
        block = first
        while block:
            digest.update(block)
            size += len(block)
            last = block[-4:]
            ascii_only = ascii_only and block.isascii()
            for probe in probes.values():
                probe.feed(block)
            block = stream.read(_BLOCK)
    for probe in probes.values():
        probe.feed(b"", final=True)
    used = marked or ("utf-8" if probes["utf-8"].ok else declared)
    newline = "\n".encode("utf-8" if used not in _WIDE else used + "-le")
    ends = last.endswith(newline) or (used in _WIDE and last.endswith("\n".encode(used + "-be")))
    return {
        "path": path, "declared": declared, "encoding_used": used, "sha256_in": digest.hexdigest(),
        "bytes_in": size, "decodable": probes[used].ok, "ascii_only": ascii_only, "ends_with_newline": ends}


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in FINGERPRINT.split(", ")]
    for pdf in batches:
        rows = [{"source": s, **_fingerprint(p, d)} for p, s, d in zip(pdf.path, pdf.source, pdf.declared)]
        yield pd.DataFrame(rows, columns=columns)


def fingerprints(spark: SparkSession, folders: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per file. ``folders``: source name -> (file or folder, declared encoding).

    A source whose path does not exist has no row; ``input_faults`` reports it.
    """
    listing = spark.createDataFrame([], "path string, source string, declared string")
    for source, (path, declared) in folders.items():
        try:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        listing = listing.unionByName(
            found.select("path", F.lit(source).alias("source"), F.lit(declared).alias("declared")))
    # a listing is tiny; an explicit number of tasks keeps large files from sharing one
    return listing.repartition(max(1, min(listing.count(), MOST_TASKS))).mapInPandas(_fingerprints, FINGERPRINT)


def _byte_order(encoding: str, head: bytes) -> tuple[str, int]:
    """Codec of one byte order, and bytes of the byte-order mark, from the first bytes of a file."""
    for order in ("le", "be"):
        codec = f"{encoding}-{order}"
        if head.startswith("\ufeff".encode(codec)):
            return codec, len("\ufeff".encode(codec))
    return f"{encoding}-{'le' if sys.byteorder == 'little' else 'be'}", 0


def _read(stream, size: int) -> bytes:
    """As many bytes as asked for, fewer only at the end."""
    parts = []
    while size and (block := stream.read(size)):
        parts.append(block)
        size -= len(block)
    return b"".join(parts)


def _line_start(stream, at: int, limit: int, newline: bytes) -> int:
    """The first place from ``at`` on where a line begins; ``limit`` if none does before it."""
    unit = len(newline)
    place = at - unit
    stream.seek(place)
    while place + unit < limit and (block := _read(stream, _BLOCK)):
        hit = block.find(newline)
        while hit >= 0 and hit % unit:  # the end of one code unit and the beginning of the next
            hit = block.find(newline, hit + 1)
        if hit >= 0:
            return min(place + hit + unit, limit)
        place += len(block)
    return limit


def _range_lines(stream, size: int, encoding: str, start: int, stop: int) -> Iterator[list[str]]:
    """The lines of a wide file that begin in ``[start, stop)``, in pieces; each is read to its end, wherever that is.

    A line feed is a code unit of its own, never half of a surrogate pair, so what lies between two of them decodes
    alone. A range inside a long line stops at its own end, so only the line's first range reads all of it.
    """
    stream.seek(0)
    codec, mark = _byte_order(encoding, _read(stream, 4))
    newline = "\n".encode(codec)
    stop = min(stop, size)
    begin = _line_start(stream, start, stop, newline) if start else 0
    if begin >= stop:
        return
    begin = max(begin, mark)
    left = (size if stop == size else _line_start(stream, stop, size, newline)) - begin
    stream.seek(begin)
    decoder, rest = codecs.getincrementaldecoder(codec)("strict"), []
    while left and (block := _read(stream, min(_BLOCK, left))):
        left -= len(block)
        first, *others = decoder.decode(block).split("\n")
        rest.append(first)
        if others:
            yield ["".join(rest), *others[:-1]]
            rest = [others[-1]]
    tail = "".join(rest) + decoder.decode(b"", True)
    if tail:
        yield [tail]


def _wide_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, encoding, size, start, stop in zip(pdf.path, pdf.encoding_used, pdf.bytes_in, pdf.start, pdf.stop):
            seen = 0
            with _open(path) as stream:
                for lines in _range_lines(stream, size, encoding, start, stop):
                    for k in range(0, len(lines), _BATCH):
                        part = lines[k:k + _BATCH]
                        yield pd.DataFrame({"path": path, "text": part, "at": range(seen, seen + len(part)), "block": start})
                        seen += len(part)


def _ranges(files: DataFrame, size: int) -> DataFrame:
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes_in") - 1, F.lit(0)), F.lit(size).cast("bigint")))
    return files.select("path", "encoding_used", "bytes_in", start.alias("start")).withColumn("stop", F.col("start") + size)


def _decoder(encoding: str):
    @F.pandas_udf(T.StringType())
    def decode(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: None if b is None else bytes(b).decode(encoding, "strict"))

    return decode


@F.pandas_udf(T.StringType())
def _composed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def _is_ascii(text: Column) -> Column:
    return F.is_valid_utf8(text) & (F.octet_length(text) == F.char_length(text))


def text_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of UTF-8 files with ``path``, the ``block`` of the file they were read in, and ``at``.

    ``at`` grows along a block, so the first lines of a file are those of block 0 with the smallest ``at``,
    wherever the file was split.
    """
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))


def normalised_lines(spark: SparkSession, files: DataFrame, wide_range: int = WIDE_RANGE) -> DataFrame:
    """Lines of every decodable file: (path, block, at, source, line, crlf, nfc_changed).

    ``files`` is a stored result of ``fingerprints``. Files of plain ASCII never leave the JVM; of the
    others Python sees only lines that hold a character outside ASCII. A UTF-16 or UTF-32 file is read by a task for every
    ``wide_range`` bytes, a multiple of four. The file list goes through the driver, the files do not.
    """
    if wide_range <= 0 or wide_range % 4:
        raise ValueError("wide_range must be a positive multiple of four")
    good = files.filter("decodable")
    byte_files: dict[tuple[str, str], list[str]] = {}
    for row in good.filter(~F.col("encoding_used").isin(*_WIDE)).select(
            "path", "source", "encoding_used", "ascii_only").collect():
        kind = "ascii" if row["ascii_only"] else row["encoding_used"]
        byte_files.setdefault((row["source"], kind), []).append(row["path"])
    wide = good.filter(F.col("encoding_used").isin(*_WIDE))
    parts = []
    pieces = wide.groupBy("source").agg(F.sum(F.ceil(F.col("bytes_in") / wide_range)).alias("n")).orderBy("source")
    for row in pieces.collect():
        ranges = _ranges(wide.filter(F.col("source") == row["source"]), wide_range)
        own = ranges.repartition(max(1, min(row["n"], MOST_TASKS))).mapInPandas(
            _wide_lines, "path string, text string, at bigint, block bigint")
        parts.append(_clean(own, row["source"], compose=True))
    for (source, encoding), paths in byte_files.items():
        raw = text_lines(spark, paths)
        if encoding == "utf-8-sig":
            raw = raw.withColumn("text", F.regexp_replace("text", "^\ufeff", ""))
        elif encoding not in ("ascii", "utf-8"):
            exotic = F.when(~_is_ascii(F.col("text")), F.col("text").cast("binary"))
            raw = raw.withColumn("text", F.coalesce(_decoder(encoding)(exotic), F.col("text")))
        parts.append(_clean(raw, source, compose=encoding != "ascii"))
    lines = spark.createDataFrame([], "path string, block bigint, at bigint, source string, line string, crlf boolean, "
                                      "nfc_changed boolean")
    for part in parts:
        lines = lines.unionByName(part)
    return lines


def _clean(lines: DataFrame, source: str, compose: bool) -> DataFrame:
    """Unify line ends and compose accents, keeping count of what was changed."""
    crlf = F.col("text").endswith("\r")
    bare = F.when(crlf, F.expr("left(text, char_length(text) - 1)")).otherwise(F.col("text"))
    cut = lines.withColumns({"crlf": crlf, "bare": bare})
    if compose:
        cut = cut.withColumn("composed", _composed(F.when(~_is_ascii(F.col("bare")), F.col("bare"))))
    else:
        cut = cut.withColumn("composed", F.lit(None).cast("string"))
    changed = F.col("composed").isNotNull() & (F.col("composed") != F.col("bare"))
    return cut.select("path", "block", "at", F.lit(source).alias("source"), F.coalesce("composed", "bare").alias("line"),
                      "crlf", changed.alias("nfc_changed"))


def _plain(path: Column) -> Column:
    """The readers spell a local path with one or three slashes."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a file from lines that come file by file and in order; nothing but the digest at work is held."""
    def row(path: str, digest) -> pa.RecordBatch:
        bare = digest.hexdigest()
        digest.update(b"\n")
        return pa.RecordBatch.from_pydict({"path": [path], "bare": [bare], "ended": [digest.hexdigest()]})

    at, digest = None, None
    for batch in batches:
        for path, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if path == at:
                digest.update(b"\n")
            else:
                if digest:
                    yield row(at, digest)
                at, digest = path, hashlib.sha256()
            digest.update(line)
    if digest:
        yield row(at, digest)


def output_digests(lines: DataFrame) -> DataFrame:
    """``path`` and the hash of every file's normalised lines, ``ended`` by a line feed or left ``bare`` of the last one.

    A hash is made in order, so a file is one task; its lines are sorted there by Spark, which spills, and streamed.
    """
    ordered = lines.repartition("path").sortWithinPartitions("path", "block", "at").select("path", "line")
    return ordered.mapInArrow(_digests, "path string, bare string, ended string")


def manifest(files: DataFrame, lines: DataFrame) -> DataFrame:
    """Audit trail per file: encoding used, SHA-256 of the bytes read and of the lines kept, line ends, composition.

    ``lines`` is a stored table; ``dst`` names the folder it lies in.
    """
    stored = lines.inputFiles()
    dst = stored[0].rsplit("/", 1)[0] if stored else None
    counted = lines.groupBy(_plain(F.col("path")).alias("__p")).agg(
        F.count("*").alias("rows"), F.count_if("crlf").alias("crlf_stripped"),
        F.bool_or("nfc_changed").alias("nfc_changed"), F.sum(F.octet_length("line") + 1).alias("bytes_out"))
    digests = output_digests(lines).select(_plain(F.col("path")).alias("__p"), "bare", "ended")
    # Of a file with nothing but its byte-order mark the hash of nothing is left.
    kept = F.when(F.col("ended").isNull() & F.col("decodable"), hashlib.sha256().hexdigest()).otherwise(
        F.when(F.col("ends_with_newline"), F.col("ended")).otherwise(F.col("bare")))
    added = F.when(F.col("ends_with_newline") | F.col("rows").isNull(), 0).otherwise(1)
    return (files.withColumn("__p", _plain(F.col("path"))).join(counted, "__p", "left").join(digests, "__p", "left")
            .select("path", "source", "declared", "encoding_used", "sha256_in", "bytes_in", "decodable", kept.alias("sha256_out"),
                    F.lit(dst).cast("string").alias("dst"),
                    F.coalesce("nfc_changed", F.lit(False)).alias("nfc_changed"),
                    F.coalesce("crlf_stripped", F.lit(0)).alias("crlf_stripped"),
                    (F.coalesce("bytes_out", F.lit(0)) - added).alias("bytes_out"),
                    (F.coalesce("rows", F.lit(0)) - added).alias("lines")))


def input_faults(files: DataFrame, required: list[str]) -> DataFrame:
    """What must stop a run: required sources without a file, and files that do not decode."""
    spark = files.sparkSession
    wanted = spark.createDataFrame([(r,) for r in required], "source string")
    missing = wanted.join(files.select("source").distinct(), "source", "left_anti").select(
        "source", F.lit("missing").alias("fault"), F.lit(None).cast("string").alias("path"))
    return missing.unionByName(files.filter("not decodable").select(
        "source", F.lit("undecodable").alias("fault"), "path"))


def require_inputs(files: DataFrame, required: list[str], named: int = 20) -> None:
    """Stop rather than reconcile half-read text. All faults are stored; the message counts them and names some."""
    faults = settle(input_faults(files, required), "input_faults")
    count = faults.count()
    if count:
        some = "; ".join(f"{r['source']} {r['fault']} {r['path'] or ''}".strip()
                         for r in faults.orderBy("source", "path").limit(named).collect())
        raise ValueError(f"{count} quarantined inputs, listed in {faults.inputFiles()[0].rsplit('/', 1)[0]}: {some}")
