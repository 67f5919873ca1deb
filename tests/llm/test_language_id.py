import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language_id as L

SCHEMA = "doc_id long, text string, lang string"
VOCABULARY = {"en": "the and of to in is that for it was on with as be at by this have from".split(),
              "de": "der die und das nicht ist ein zu mit sich für auf den von dem werden auch".split(),
              "fr": "le la les et des est un une pour dans que qui sur pas avec être sont".split()}


def corpus(n=300):
    rng = random.Random(7)
    langs = sorted(VOCABULARY)
    rows = []
    for k in range(n):
        lang = langs[0] if k % 3 == 0 else rng.choice(langs)
        rows.append((k, " ".join(rng.choices(VOCABULARY[lang], k=rng.randint(3, 60))), lang))
    return rows


@pytest.fixture(scope="module")
def filters(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    return L.learn(docs.where(~L.held_out()))


def test_held_out_accuracy(spark, filters):
    docs = spark.createDataFrame(corpus(), SCHEMA).withColumn("held", L.held_out())
    rows = L.identify(docs, filters).where("held").collect()
    assert len(rows) > 60 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_split_is_crc32_of_the_id_as_text(spark):
    import zlib

    rows = spark.range(50).select(F.col("id").alias("doc_id")).withColumn("held", L.held_out()).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert spark.sql("select cast(null as long) as doc_id").select(L.held_out()).first()[0] is False


def test_filters_have_every_learned_ngram(spark, filters):
    """No false negatives: a text of a language's words is known nearly whole; a bit set by chance is rare."""
    for number, lang in enumerate(filters.languages):
        grams = [g for g in L._grams(" ".join(VOCABULARY[lang]))]
        hits = 0
        for found in grams:
            masks = filters.planes[number // 8][next(iter(L._slots(found)))]
            for slots in L._slots(found):
                masks = masks & filters.planes[number // 8][slots]
            hits += int((masks >> (number % 8) & 1).sum())
        assert hits > 0.4 * sum(map(len, grams))
    assert (filters.chance < 0.01).all()


def test_many_languages_need_several_planes(spark):
    rows = [(k, f"{chr(97 + k)}{chr(98 + k)}{chr(99 + k)}{chr(100 + k)} " * 20, f"l{k:02}") for k in range(20)]
    filters = L.learn(spark.createDataFrame(rows, SCHEMA))
    assert filters.planes.shape[0] == 3
    found = L.identify(spark.createDataFrame(rows, SCHEMA), filters).collect()
    assert [r.lang_pred for r in found] == [r.lang for r in found]


def test_edges(spark, filters):
    long = "der die und das " * 100_000
    rows = [(1, None, "en", 0.5), (2, "", None, 0.5), (3, "12 34 !?", "en", 0.5), (None, "the and of", "en", 0.5),
            (4, long, None, 0.5), (4, long, None, 0.5), (5, "x", None, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _score double")
    got = L.identify(docs, filters)
    assert got.columns == [*docs.columns, "lang_pred", "score"]
    assert [r.lang_pred for r in got.collect()][:6] == ["und", "und", "und", "en", "de", "de"]
    assert got.collect()[6].lang_pred in filters.languages
    none = L.learn(docs.limit(0))
    assert none.languages == () and {r.lang_pred for r in L.identify(docs, none).collect()} == {"und"}
    assert L.identify(docs.limit(0), filters).count() == 0
