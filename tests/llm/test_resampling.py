import hashlib
import math
import random
import re
import zlib

import pytest

from ledgerloom.llm import resampling as R

SCHEMA = "doc_id long, text string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def runs(text, longest):
    w = words(text)
    return [" ".join(w[a:a + n]) for n in range(1, longest + 1) for a in range(len(w) - n + 1)]


def brute(docs, target, longest=1, buckets=R.BUCKETS, percent=10, least=20, seed=2024):
    bucket = {}

    def counts(texts):
        total = [0] * buckets
        for text in texts:
            for f in runs(text, longest):
                bucket[f] = zlib.crc32(f.encode()) % buckets
                total[bucket[f]] += 1
        return total

    s, t = counts(x for _, x in docs), counts(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        f = runs(text, longest)
        weight = sum(gain[bucket[x]] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(words(text)), len(f), weight, score, None])
    eligible = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, *r[1:4]))
    for rank, row in enumerate(eligible[:percent * len(eligible) // 100], 1):
        row[5] = rank
    return sorted(map(str, map(tuple, rows)))


def corpus(n=150):
    rng = random.Random(4)
    return [(k, rng.choice([" ", "\n", ", "]).join(rng.choices(["The", "of", "é", "x1", "Rust", "zebra", "日本", "k" * 40], k=rng.randint(0, 60))))
            for k in range(n)]


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(1, R.BUCKETS, 10), (3, 64, 30), (2, 70_000, 50)])
def test_against_brute_force(spark, longest, buckets, percent):
    docs, target = corpus(), ["the Rust of zebra", "rust rust", None, ""]
    found = R.resample(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(t,) for t in target], "text string"),
                       longest=longest, buckets=buckets, percent=percent)
    assert sorted(str(tuple(r)) for r in found.collect()) == brute(docs, target, longest, buckets, percent)


def test_odd_rows(spark):
    many = " ".join(["word"] * 60_000)
    docs = [(1, None), (None, "a b " * 20), (2, ""), (3, many), (4, "a b " * 20), (4, "a b " * 20), (5, "...!")]
    df = spark.createDataFrame([(*d, 1) for d in docs], SCHEMA + ", found int")
    none = spark.createDataFrame([], "text string")
    assert sorted(str(tuple(r)) for r in R.resample(df, none, percent=50).collect()) == brute(docs, [], percent=50)
    assert R.resample(df.limit(0), none).count() == 0


def test_sample_returns_whole_rows(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in corpus()], SCHEMA + ", `a.b` string")
    target = spark.createDataFrame([("rust",)], "text string")
    drawn = R.resample(docs, target).where("rank is not null").select("doc_id").collect()
    found = R.sample(docs, target)
    assert found.columns == docs.columns and {r.doc_id for r in found.collect()} == {r.doc_id for r in drawn}


@pytest.mark.parametrize("words", [1, 2, 3])
def test_overlapped_spans(words):
    text = R.collapsed("  One, two;three\tFOUR é5 ".encode())
    assert text == "one two three four é5".encode()
    spans = [m.span() for m in R.span_pattern(words).finditer(text, overlapped=True)]
    cut = text.split(b" ")
    assert [text[a:b] for a, b in spans] == [b" ".join(cut[k:k + words]) for k in range(len(cut) - words + 1)]
