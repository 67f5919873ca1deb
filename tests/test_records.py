import csv
import hashlib
import io
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import reconcile as runs
from ledgerloom.sources import normalise, records, registry

SCHEMA = "path string, block long, at long, line string"


def python_records(text, sep=","):
    """The physical lines that make up each record, by Python's reader."""
    reader, lines, before, out = None, text.split("\n"), 0, []
    reader = csv.reader(io.StringIO(text, newline=""), delimiter=sep)
    for _ in reader:
        out.append("\n".join(lines[before:reader.line_num]))
        before = reader.line_num
    return out


def text_of(rng, n, sep=","):
    cells = ["a", "", '"quoted"', '"two\nlines"', '"\n\n"', '"a ""b"" c"', '"x,y;\nz"', '12" disk', '"""\n"""']
    return "\n".join(sep.join(rng.choices(cells, k=rng.randint(1, 4))) for _ in range(n))


@pytest.mark.parametrize("sep", [",", ";", "|"])
def test_records_as_a_reader_finds_them(spark, sep):
    """Every file cut into blocks at random places; some blocks lie wholly inside a quoted field."""
    rng, rows, expected = random.Random(sep), [], []
    for k in range(25):
        text = text_of(rng, rng.randint(1, 15), sep) if k else "plain\nlines"
        block = 0
        for at, line in enumerate(text.split("\n")):
            block += 1000 * (rng.random() < 0.3)
            rows.append((f"f{k}", block, at * 3 + (block > 0) * (1 << 33), line))
        expected += [(f"f{k}", r) for r in python_records(text, sep)]
    rng.shuffle(rows)
    found = records.joined_records(spark.createDataFrame(rows, SCHEMA), sep)
    assert found.columns == ["path", "block", "at", "line"]
    # Empty lines are no records for Python's reader, and dropped later on here.
    assert sorted((r.path, r.line) for r in found.collect() if r.line) == sorted(e for e in expected if e[1])
    assert records.joined_records(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_quote_never_closed_takes_the_rest(spark):
    rows = [("f", 0, 1, "a"), ("f", 0, 2, 'b,"c'), ("f", 100, 3, "d"), ("f", 200, 4, "e"), ("g", 0, 1, "x")]
    found = records.joined_records(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.path, r.block, r.at, r.line) for r in found) == [
        ("f", 0, 1, "a"), ("f", 0, 2, 'b,"c\nd\ne'), ("g", 0, 1, "x")]


def test_long_lines_are_read_once(spark):
    line = '"' + 'x""' * 200_000 + '",' + "y," * 200_000
    found = records.joined_records(spark.createDataFrame([("f", 0, 1, line), ("f", 0, 2, '"open'), ("f", 0, 3, "end\"")], SCHEMA))
    assert sorted(len(r.line) for r in found.collect()) == [10, len(line)]


def test_files_split_inside_quotes(spark, tmp_path):
    """Read through the encoding path of a run, with blocks of a few hundred bytes."""
    notes = [f"note {k}\n\nsays \"\"{'z' * (k % 90)}\"\", and\nmore" for k in range(300)]
    (tmp_path / "one.csv").write_text("id,note\r\n" + "".join(f'{k},"{n}"\r\n' for k, n in enumerate(notes)), newline="")
    (tmp_path / "two.csv").write_text("note,id\nplain,999\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        files = normalise.fingerprints(spark, {"notes": (str(tmp_path), "utf-8")})
        lines = normalise.normalised_lines(spark, files)
        assert lines.select("block").distinct().count() > 20
        parsed = registry.parse_files(lines, registry.SourceSpec("notes", ""))
        assert parsed.columns == ["id", "note"]
        assert {int(r.id): r.note for r in parsed.collect()} == {
            **{k: n.replace('""', '"') for k, n in enumerate(notes)}, 999: "plain"}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_ingest_reads_quoted_breaks(spark, tmp_path):
    (tmp_path / "log.csv").write_text('id,comment\n1,"a\nb"\n2,c\n')
    specs = {"payment_engine_log": registry.SourceSpec("payment_engine_log", str(tmp_path / "log.csv"))}
    staged, manifest = runs.ingest(spark, specs, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in staged["payment_engine_log"].collect()) == [("1", "a\nb"), ("2", "c")]
    assert manifest.first().lines == 4


def test_manifest_hashes_what_is_kept(spark, tmp_path):
    """By Python's own hash, with and without a last line end, a file of nothing but its mark, and accents put together."""
    contents = {"a.csv": b"x,\xc3\xa9\r\ny\n", "b.csv": b"e\xcc\x81 no end", "c.csv": b"\xff\xfe", "d.csv": "wide é\r\nend\n".encode("utf-16"),
                "e.csv": b"\n\n"}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    files = normalise.settle(normalise.fingerprints(spark, {"s": (str(tmp_path), "cp1252")}), "fingerprints")
    lines = normalise.settle(normalise.normalised_lines(spark, files), "lines")
    found = {r.path.rsplit("/", 1)[1]: r for r in normalise.manifest(files, lines).collect()}
    for name, data in contents.items():
        text = unicodedata.normalize("NFC", data.decode("utf-16" if name in ("c.csv", "d.csv") else "utf-8")).replace("\r\n", "\n").encode()
        row = found[name]
        assert row.sha256_out == hashlib.sha256(text).hexdigest(), name
        assert row.sha256_in == hashlib.sha256(data).hexdigest() and row.bytes_in == len(data)
        assert (row.bytes_out, row.lines) == (len(text), text.count(b"\n")), name
        assert row.dst and row.dst.rsplit("/", 1)[1].startswith("lines-")


WIDE_TEXT = "a\n\nb\u0a0a\u000a\u0a00\U0001f600" + "\U0001f600" * 40 + "\n\u0100\u0a00\n" + "long " * 50 + "\nend"


@pytest.mark.parametrize("codec", ["utf-16-le", "utf-16-be", "utf-32-le", "utf-32-be"])
@pytest.mark.parametrize("end", ["", "\n", "\n\n"])
@pytest.mark.parametrize("marked", [True, False])
def test_ranges_of_a_wide_file_give_its_lines_once(codec, end, marked):
    text = WIDE_TEXT + end
    data = (("\ufeff" if marked else "") + text).encode(codec)
    if not marked and codec.endswith("be"):
        data = ("\ufeff" + text).encode(codec)  # without a mark the machine's own order is meant
    want = text.split("\n")
    want = want[:-1] if not want[-1] else want
    for step in (4, 8, 12, 64, 1 << 20):
        got = []
        for start in range(0, len(data), step):
            for lines in normalise._range_lines(io.BytesIO(data), len(data), codec[:6], start, start + step):
                got += lines
        assert got == want, (codec, step)


def test_a_wide_file_is_read_by_several_tasks(spark, tmp_path):
    rows = [f'{k};"two\nlines \U0001f600";{"e\u0301" * (k % 7)}' for k in range(500)]
    (tmp_path / "wide.csv").write_bytes(("k;t;e\n" + "\n".join(rows)).encode("utf-16"))
    (tmp_path / "mark.csv").write_bytes(b"\xff\xfe")
    files = normalise.fingerprints(spark, {"wide": (str(tmp_path), "utf-8")}).cache()
    lines = normalise.normalised_lines(spark, files, 4096)
    tasks = lines.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 3
    text = unicodedata.normalize("NFC", "\n".join(rows))
    assert [r.line for r in lines.orderBy("block", "at").collect()] == ("k;t;e\n" + text).split("\n")
    # records that span lines are put together over the ranges
    whole = records.joined_records(lines.select("path", "block", "at", "line"), ";").orderBy("block", "at").collect()
    assert [r.line for r in whole[1:]] == [unicodedata.normalize("NFC", r) for r in rows]
    with pytest.raises(ValueError):
        normalise.normalised_lines(spark, files, 6)
