import struct

import zstandard
from pyarrow import fs

from ledgerloom.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages(n=120):
    body = "<html><head><title>{}</title></head><body>" + "<p>the same words of a page</p>" * 20 + "</body></html>"
    rows = [(k, f"http://example.org/{k}", body.format(k)) for k in range(n)]
    return rows + [(200, "http://a", rows[3][2]), (201, "b", rows[3][2]), (202, None, None), (203, "x\r\ny", ""),
                   (None, "n", "only here"), (None, "n", rows[5][2]), (7, "again", rows[7][2]), (7, "again", rows[7][2]),
                   (204, "long", "é" * 300_000)]


def archived(spark, tmp_path, rows, **options):
    manifest = warc.write(spark.createDataFrame(rows, SCHEMA), f"file://{tmp_path}/warc", **options)
    return manifest, warc.read(manifest).collect()


def test_round_trip_and_revisits(spark, tmp_path):
    rows = pages()
    manifest, got = archived(spark, tmp_path, rows)
    assert len(got) == len(rows) == sum(r.records for r in manifest.collect())
    holders = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        holders[data] = max(holders.get(data, -1), -1 if page_id is None else page_id)
    by_digest = {warc.digest(data): (len(data), holder) for data, holder in holders.items()}
    assert sorted(str(r.page_id) for r in got) == sorted(str(r[0]) for r in rows)
    responses = {}
    for r in got:
        size, holder = by_digest[r.payload_digest]
        assert r.payload_bytes == size
        if r.record_type == "response":
            assert r.refers_to is None and warc.digest(bytes(r.payload)) == r.payload_digest
            assert r.payload_digest not in responses and r.page_id == (None if holder == -1 else holder)
            responses[r.payload_digest] = r
        else:
            assert r.record_type == "revisit" and r.refers_to == holder and r.payload is None
    assert set(responses) == set(by_digest)


def test_small_payloads_are_responses(spark, tmp_path):
    _, got = archived(spark, tmp_path, [(1, "", ""), (2, "", None), (3, "", "x" * 50), (4, "", "x" * 50)], min_revisit_bytes=10)
    assert {r.page_id: (r.record_type, r.refers_to) for r in got} == {
        1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_every_file_carries_its_dictionary_and_single_frames(spark, tmp_path):
    manifest, _ = archived(spark, tmp_path, pages())
    for row in manifest.collect():
        system, name = fs.FileSystem.from_uri(row.path)
        data = system.open_input_stream(name).read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.DICTIONARY_FRAME and len(data) == row.bytes
        dictionary = zstandard.ZstdCompressionDict(data[8:8 + size])
        at, frames = 8 + size, 0
        while at < len(data):  # each record by its offset, with nothing but the dictionary
            assert data[at:at + 4] == warc.ZSTD_MAGIC
            one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            headers, block = warc.parse(one.decompress(data[at:]))
            payload = warc.payload_of(block)
            assert len(payload) == (int(headers["X-Payload-Length"]) if headers["WARC-Type"] == "response" else 0)
            at, frames = len(data) - len(one.unused_data), frames + 1
        assert frames == row.records


def test_records_have_what_the_format_demands(spark, tmp_path):
    """Mandatory fields in every record; each block is an HTTP response of which a plain parser makes the payload."""
    rows = [(1, "http://a", "one"), (2, "http://b", "one"), (3, None, "x\r\n\r\ny"), (4, "u", None)]
    df = spark.createDataFrame([(*r, d) for r, d in zip(rows, ("2024-05-06 07:08:09", None, None, None))], SCHEMA + ", seen string")
    df = df.withColumn("seen", df.seen.cast("timestamp"))
    manifest = warc.write(df, f"file://{tmp_path}/dated", captured_at="seen")
    dates, payloads = {}, {}
    for row in manifest.collect():
        for record in warc.records(row.path):
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            headers, block = warc.parse(record)
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Target-URI"} <= set(headers)
            assert headers["Content-Type"] == "application/http; msgtype=response"
            assert len(record) == record.index(b"\r\n\r\n") + 4 + len(block) + 4
            status, *fields = block.partition(b"\r\n\r\n")[0].split(b"\r\n")
            assert status == b"HTTP/1.1 200 OK" and b"Content-Length: " + headers["X-Payload-Length"].encode() in fields
            page = int(headers["WARC-Record-ID"].split(":")[2])
            dates[page], payloads[page] = headers["WARC-Date"], (headers["WARC-Type"], warc.payload_of(block))
    assert dates == {1: "2024-05-06T07:08:09Z", 2: warc.NO_DATE, 3: warc.NO_DATE, 4: warc.NO_DATE}
    assert payloads == {1: ("revisit", b""), 2: ("response", b"one"), 3: ("response", b"x\r\n\r\ny"), 4: ("response", b"")}
    assert {r.page_id: r.payload and bytes(r.payload) for r in warc.read(manifest).collect()} == {
        1: None, 2: b"one", 3: b"x\r\n\r\ny", 4: b""}


def test_without_pages_and_with_other_columns(spark, tmp_path):
    manifest, got = archived(spark, tmp_path, [])
    assert got == [] and manifest.count() == 0
    df = spark.createDataFrame([(1, "u", "h", "mine", 9)], SCHEMA + ", payload string, copy int")
    assert [r.page_id for r in warc.read(warc.write(df, f"file://{tmp_path}/other")).collect()] == [1]


def test_a_dictionary_whatever_the_rows(spark, tmp_path):
    """Copies, empty pages and too few pages leave no file without a dictionary."""
    body = "<html>" + "<p>words of a page</p>" * 30
    tables = {"copies": [(None, None, body)] * 500 + [(k, f"u{k}", f"{body}{k}") for k in range(20)],
              "empty": [(k, f"u{k}", "") for k in range(500)], "one": [(1, "u", body)]}
    for name, rows in tables.items():
        manifest, got = archived(spark, tmp_path / name, rows)
        assert len(got) == len(rows)
        for row in manifest.collect():
            system, path = fs.FileSystem.from_uri(row.path)
            magic, size = struct.unpack("<II", system.open_input_stream(path).read(8))
            assert magic == warc.DICTIONARY_FRAME and 8 <= size <= warc.DICTIONARY_BYTES


def test_samples_are_whole_where_the_bound_allows():
    assert warc._longest([10, 2000, 9000], 20_000) == 9000
    assert warc._longest([10, 2000, 90_000], 20_000) == 17_990
    assert warc._longest([9000] * 4, 20_000) == 5000 and warc._longest([0], 20_000) == 1
