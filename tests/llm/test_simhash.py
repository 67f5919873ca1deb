import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """doc_id -> fingerprint to doc_id -> smallest reachable doc_id."""
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def texts():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=5)) for _ in range(60)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 300))) for _ in range(60)]
    out = base + base[:10]
    for text in base[:30]:
        changed = text.split()
        changed[rng.randrange(len(changed))] = "other"
        out.append(" ".join(changed))
    return out + [None, "", " \t\n", "one", "ONE", "two words", "Ä" * 5, "long " * 20_000]


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = {i: brute_fingerprint(t) for i, t in rows}
    assert {r.doc_id: r.fingerprint % 2 ** 64 for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == brute_components(prints)


def test_links_of_dense_and_chained_fingerprints(spark):
    """A dense ball, a chain of steps of three bits, and random ones; long runs are walked, short ones paired."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    ball = [centre] + [centre ^ 1 << a for a in range(64)] + [centre ^ 1 << a ^ 1 << b for a in range(20) for b in range(a)]
    chain = [rng.getrandbits(64)]
    for step in range(12):
        chain.append(chain[-1] ^ (0b111 << 3 * step))
    prints = dict(enumerate(ball + chain + [rng.getrandbits(64) for _ in range(100)]))
    df = spark.createDataFrame([(p - 2 ** 64 if p >> 63 else p,) for p in set(prints.values())], "fingerprint long")
    roots = {r.node % 2 ** 64: r.root for r in components(simhash.links(df)).collect()}
    expected = brute_components(prints)
    groups = {}
    for i, p in prints.items():
        groups.setdefault(expected[i], set()).add(roots.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len({g.pop() for g in groups.values()}) == len(groups)


def test_components_of_odd_links(spark):
    links = [(1, 2), (2, 1), (3, 2), (4, 4), (None, 5), (9, 8), (8, 7), (7, 6), (1, 2)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "low long, high long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6}
    assert components(spark.createDataFrame([], "low long, high long")).count() == 0


def test_one_row_of_a_group_stays(spark):
    same = "the same text of some words here"
    rows = [(4, same, "a", 1), (2, same, "b", 2), (2, same, "b", 2), (None, same, "c", 3), (None, None, None, None),
            (7, "", "d", 4), (8, "quite another text that stands alone", "e", 5), (8, same, "x", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string, component_id long")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [
        (2, same, "b", 2), (7, "", "d", 4), (8, "quite another text that stands alone", "e", 5)]
    assert simhash.keep_one(docs.limit(0)).count() == 0
    named = simhash.near_duplicates(spark.createDataFrame([(None, "alone"), (None, "alone")], SCHEMA)).collect()
    assert [r.component_id for r in named] == [None, None]


def test_names_that_clash(spark):
    names = ["doc_id", "text", "_text_hash", "row", "copies", "root", "a.b"]
    rows = [(1, "the same text", 1, "a", 2, "b", "c"), (2, "the same text", 3, "d", 4, "e", "f")]
    kept = simhash.keep_one(spark.createDataFrame(rows, names))
    assert kept.columns == names and list(map(tuple, kept.collect())) == rows[:1]


def test_every_distance_of_every_radius(spark):
    """Each pair within the radius is linked, whichever of the two has an even number of bits; others are not."""
    rng = random.Random(8)
    for radius in (0, 1, 2, 3, 4):
        pairs = []
        for distance in range(1, 6):
            for _ in range(12):
                one = rng.getrandbits(64)
                pairs.append((one, one ^ sum(1 << b for b in rng.sample(range(64), distance)), distance))
        signed = [(p - 2 ** 64 if p >> 63 else p,) for pair in pairs for p in pair[:2]]
        found = {frozenset((r.low % 2 ** 64, r.high % 2 ** 64))
                 for r in simhash.links(spark.createDataFrame(signed, "fingerprint long"), radius).collect()}
        assert found == {frozenset(pair[:2]) for pair in pairs if pair[2] <= radius}
    assert simhash.links(spark.createDataFrame([], "fingerprint long")).count() == 0


def test_half_of_many_fingerprints(spark, monkeypatch):
    """Longer runs than are compared on a half go by whole variants, wherever a batch ends; they lose no link."""
    rng = random.Random(21)
    low = rng.getrandbits(32)
    prints = {low | rng.getrandbits(32) << 32 for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)}
    for one in list(prints)[:60]:
        prints.add(one ^ sum(1 << b for b in rng.sample(range(64), 3)))
    numbered = dict(enumerate(sorted(prints)))
    expected = brute_components(numbered)
    df = spark.createDataFrame([(p - 2 ** 64 if p >> 63 else p,) for p in prints], "fingerprint long")
    variants = []
    whole = simhash._links_by_variants
    for longest, batch_rows in ((2081, "10000"), (8, "10000"), (8, "7"), (0, "10000")):
        monkeypatch.setattr(simhash, "_LONG_RUN", longest)
        monkeypatch.setattr(simhash, "_links_by_variants", lambda crowd, radius: variants.append(crowd.count()) or whole(crowd, radius))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
        try:
            roots = {r.node % 2 ** 64: r.root for r in components(simhash.links(df)).collect()}
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        groups = {}
        for i, p in numbered.items():
            groups.setdefault(expected[i], set()).add(roots.get(p, p))
        assert all(len(g) == 1 for g in groups.values()) and len({g.pop() for g in groups.values()}) == len(groups)
    assert variants[0] == 0 and 300 <= variants[1] == variants[2] < len(prints) == variants[3]


def test_rows_emitted_grow_with_the_fingerprints(spark, monkeypatch):
    """Random fingerprints, of which more share a half the more there are, emit no whole variants."""
    rng = np.random.default_rng(5)
    n = 40_000
    df = spark.createDataFrame(pa.table({"fingerprint": rng.integers(-2 ** 63, 2 ** 63, n)}))
    emitted = []
    monkeypatch.setattr(simhash, "_links_by_variants", lambda crowd, radius: emitted.append(crowd.count()) or crowd.selectExpr(
        "fingerprint as low", "fingerprint as high"))
    assert simhash.links(df).count() == 0 and emitted == [0]
