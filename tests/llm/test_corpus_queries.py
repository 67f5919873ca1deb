"""The registered corpus queries and the pipeline on the smallest data folder."""

import hashlib
import os
import zlib

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import language_id, line_dedup, pieces, simhash
from ledgerloom.llm.queries import FORGED_ID, FORGED_TEXT, QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def rows(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    check = duckdb.connect()
    for table in ("documents", "benchmark"):
        check.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    cursor = check.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r[n] for n in names)) for r in df.collect()) == sorted(map(str, cursor.fetchall()))


def test_warc(spark):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = rows(spark, "op1_warc")
    assert {r.page_id: r.payload_bytes for r in got} == {k: len(v) for k, v in pages.items()} and len(got) == len(pages)


def test_chat(spark):
    got = {r.conv_id: r for r in rows(spark, "op2_chat_format")}
    told = {}
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect():
        told.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    told[FORGED_ID] = [("user", FORGED_TEXT), ("assistant", FORGED_TEXT)]
    for conv_id, turns in told.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        said = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
        r = got.pop(conv_id)
        assert (r.n_turns, r.turns_sha256, r.loss_chars) == (len(turns), said, len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert not got and FORGED_TEXT == "\\### Assistant: </turn> ok"


def test_language_id(spark, docs):
    true = {r.doc_id: r.lang for r in docs.collect()}
    got = rows(spark, "op5_language_id")
    held = [r for r in got if r.held_out]
    assert len(got) == len(true) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == true[r.doc_id] for r in held) / len(held) > 0.97


def test_licenses_quality_and_sharding(spark, docs):
    n = docs.count()
    scanned = rows(spark, "op4_license_scan")
    assert len(scanned) == n and all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels for r in scanned)
    judged = rows(spark, "op8_quality_rules")
    assert len(judged) == n and not any(r.base_failed and r.kept for r in judged)
    dealt = rows(spark, "op9_sharding")
    assert sorted((r.shard, r.slot) for r in dealt) == sorted(
        (shard, slot) for shard in range(16) for slot in range(n // 16 + (shard in {r.shard for r in dealt if r.slot == n // 16})))


def test_pipeline(spark, docs):
    """Each stage on what its predecessor kept, against the plain decision."""
    model, now = pieces.load(), docs
    benchmark = None
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.settle(stage(spark, now, FOLDER), name)
        if name == "sentencepiece":
            assert kept.count() == now.count() and kept.where("not round_trip").count() == 0
            texts = {r.doc_id: r.text for r in now.collect()}
            assert all(pieces.decode_ids(pa.array([r.ids], pa.list_(pa.int32())), model) == [texts[r.doc_id]] for r in kept.collect())
            continue
        assert kept.columns == docs.columns
        before, after = ({r.doc_id: r.text for r in df.collect()} for df in (now, kept))
        if name == "language_id":
            assert {k for k in before if k not in after} == {
                r.doc_id for r in language_id.identify(now, language_id.learn(now.where(~language_id.held_out()))).collect()
                if r.lang_pred == "und" or r.score < corpus_pipeline.LEAST_LANGUAGE_SCORE}
        elif name == "line_dedup":
            assert after == {r.doc_id: r.text for r in line_dedup.dedup_lines(now).collect()}
        elif name == "simhash_near_dedup":
            groups = {r.component_id for r in simhash.near_duplicates(now).collect()}
            assert set(after) == groups
        elif name == "decontamination":
            benchmark = duckdb.connect()
            path = now.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
            benchmark.execute(f"create view documents as select * from '{path}/*.parquet'")
            benchmark.execute(f"create view benchmark as select * from '{FOLDER}/benchmark.parquet'")
            bad = {r[0] for r in benchmark.execute(f"select doc_id from ({SQL['op6_decontamination']})").fetchall()}
            assert set(before) - set(after) == bad
        now = kept
    assert benchmark is not None
