import zlib
from collections import Counter

from ledgerloom.llm import sharding

SCHEMA = "doc_id long, source string, text string"


def test_law_mixture_and_slots(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"s{k % 7}", "text é " * (k % 11)) for k in range(1003)]
    got = sharding.interleave(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = {k: t for k, _, t in rows}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {
        k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts.items()}
    counts = Counter(r.shard for r in got)
    assert sorted(counts) == list(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    for source, total in Counter(r.source for r in got).items():
        own = Counter(r.shard for r in got if r.source == source)
        assert all(abs(own[shard] - total / 16) <= 2 for shard in range(16))


def test_order_is_seeded_and_repeatable(spark):
    docs = spark.createDataFrame([(k, "s", str(k)) for k in range(200)], SCHEMA)
    at = lambda df: {r.doc_id: (r.shard, r.slot) for r in df.collect()}
    first = at(sharding.interleave(docs))
    assert at(sharding.interleave(docs.repartition(5))) == first != at(sharding.interleave(docs, seed=1))


def test_edges(spark, monkeypatch):
    rows = [(1, None, None, "x", 1), (1, None, None, "x", 1), (None, "s", "", "x", 1), (2, "s", "long " * 100_000, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA + ", shard string, slot int")
    monkeypatch.setattr(sharding, "BROADCAST_SOURCES", 0)
    got = sharding.interleave(docs, shards=3).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == [
        ("1", 1, 0), ("1", 1, 0), ("2", 500_001, zlib.crc32(b"long " * 100_000)), ("None", 1, 0)]
    assert sharding.interleave(docs.limit(0)).count() == 0
