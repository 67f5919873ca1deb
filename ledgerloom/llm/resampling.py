"""Importance resampling: draw the documents that look most like a target collection.

Separators of a text are collapsed to single spaces; an overlapped scan with lookarounds at the word ends then emits
every run of one to ``n`` words as a span, whose bytes are counted by their CRC in a fixed number of buckets. The
logarithm of how much more frequent a bucket is in the target than in the corpus is its gain; a document's weight is the
mean gain of its features, and a seeded Gumbel draw on top of it makes the highest scores a sample without replacement.

A text is scanned once: its buckets are stored, two bytes a feature, and serve the corpus counts, the weights and
nothing else. Counts are made in the tasks, so at most a row a bucket and task is shuffled; the gains, one number a
bucket, are the only thing that goes to all tasks. Scores are put in order by range partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import utf8
from ledgerloom.operators.ordering import ranked
from ledgerloom.sources.workspace import settle

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Gains and draws are whole numbers of so many parts.
PARTS = 1000

_GAPS = regex.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def collapsed(text: bytes) -> bytes:
    """The words of a text, A-Z lowered, with a space between them and none before or after."""
    return _GAPS.sub(b" ", text.translate(_LOWER)).strip(b" ")


def span_pattern(words: int) -> regex.Pattern[bytes]:
    """Finds, searched with overlaps, every run of so many words in a collapsed text."""
    return regex.compile(rb"(?<![^ ])[^ ]+" + rb"(?: [^ ]+){%d}" % (words - 1) * (words > 1) + rb"(?![^ ])")


def features(text: bytes, longest: int) -> Iterator[bytes]:
    """Every run of 1 to ``longest`` consecutive words of a collapsed text, repeats included."""
    for words in range(1, longest + 1):
        for found in span_pattern(words).finditer(text, overlapped=True):
            yield found[0]


def bucketed(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``texts`` (any columns and ``text``) with ``n_words`` and ``found``, the buckets of all features, in place of ``text``.

    ``found`` holds 16-bit numbers, 32-bit ones where there are more buckets than that.
    """
    names = [c for c in texts.columns if c != "text"]
    rows = texts.select(*[F.col(f"`{c}`") for c in names], F.col("text").cast("string").alias("text"))
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in utf8(batch.column(len(names))):
                text = collapsed(text)
                counts.append(text.count(b" ") + 1 if text else 0)
                found.append((np.fromiter((zlib.crc32(f) for f in features(text, longest)), np.uint32) % buckets)
                             .astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(counts, pa.int64()), pa.array(found, pa.binary())],
                names=[*names, "n_words", "found"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(run, ", ".join([*fields, "n_words long", "found binary"]))


def _kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket stands in ``found``: added up in the tasks, then by bucket."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for one in batch.column(0):
                total += np.bincount(np.frombuffer(one.as_py(), kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    rows = found.select("found").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():  # at most one row a bucket
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket speaks for the target, in ``PARTS``, with one count added to every bucket."""
    buckets = len(corpus)
    odds = ((target + 1).astype(float) * float(target.dtype.type(corpus.sum()) + buckets)
            / ((corpus + 1).astype(float) * float(target.sum() + buckets)))
    return np.floor(PARTS * np.log(odds)).astype(np.int64)


def _weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with ``n_features`` and ``weight`` in place of the buckets."""
    kind, names = _kind(len(gain)), [c for c in found.columns if c != "found"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, weights = [], []
            for one in batch.column(len(names)):
                each = np.frombuffer(one.as_py(), kind)
                counts.append(len(each))
                weights.append(int(gain[each].sum()) // len(each) if len(each) else 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(counts, pa.int64()), pa.array(weights, pa.int64())],
                names=[*names, "n_features", "weight"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "found"]
    return (found.select(*[F.col(f"`{c}`") for c in names], "found")
            .mapInArrow(run, ", ".join([*fields, "n_features long", "weight long"])))


def drawn_by(seed: int, doc_id: Column) -> Column:
    """The Gumbel draw of a document in ``PARTS``, by the hash of seed and id; a null id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-PARTS * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``.

    ``target`` has ``text``. Of the rows with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are
    drawn: the highest scores, ties to the smaller doc_id, a null id before all. ``rank`` is 1, 2, 3... in that order and
    null for the others. A null or empty text has no features and weight 0; a very long one takes two bytes a feature;
    repeated rows are each ranked, in any order among themselves; an empty corpus gives no rows, and an empty target
    speaks for no bucket but by how rare it is. Other columns are not read.
    """
    found = settle(bucketed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), longest, buckets), "buckets")
    gain = gains(bucket_counts(found, buckets), bucket_counts(bucketed(target.select("text"), longest, buckets), buckets))
    scored = settle(_weighted(found, gain).withColumn("score", F.col("weight") + drawn_by(seed, F.col("doc_id"))), "scores")
    eligible = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_words"), F.col("n_features"), F.col("weight")]
    placed = ranked(scored.where(eligible), order, "__place", "drawn")
    drawn = placed.count() * percent // 100
    rank = F.when(F.col("__place") < drawn, F.col("__place") + 1).cast("long")
    return (placed.withColumn("rank", rank).drop("__place")
            .unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("long"))))


def sample(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn rows of ``docs`` whole, with all their columns; ``doc_id`` names a row and isn't null."""
    drawn = resample(docs, target, **how).where("rank is not null").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(drawn, docs["doc_id"] == drawn["__drawn"], "left_semi")


# The CRC, a byte at a time, by the table of its polynomial; words are hashed once each.
ORACLE_SQL = r"""
with recursive table_steps as (
  select b::bigint as b, b::bigint as c, 0 as k from range(256) t(b)
  union all
  select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from table_steps where k < 8
), crc_table as (select list(c order by b) as t from table_steps where k = 8),
texts as (
  select row_number() over () as row, doc_id, 0 as target, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as t from documents
  union all
  select null, null, 1, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  from benchmark
), words as (
  select row, target, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from texts
), counted as (select row, target, word, count(*) as n from words group by all),
different as (
  select word, hex(encode(word)) as h from (select distinct word from counted)
), hashed as (
  select word, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, length(h) // 2), lambda i:
      (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 10000 as bucket
  from different, crc_table
), per_bucket as (
  select bucket, coalesce(sum(n) filter (target = 0), 0) as s, coalesce(sum(n) filter (target = 1), 0) as t
  from counted join hashed using (word) group by bucket
), totals as (select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from per_bucket),
gain as (
  select bucket, floor(1000 * ln((t + 1)::double * (all_s + 10000)::double
                                 / ((s + 1)::double * (all_t + 10000)::double)))::bigint as g
  from per_bucket, totals
), weights as (
  select row, sum(n)::bigint as n_features, floor(sum(n * g)::double / sum(n))::bigint as weight
  from counted join hashed using (word) join gain using (bucket) where target = 0 group by row
), scores as (
  select d.row, d.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint
      + 0.5::double) / 4294967296::double)))::bigint as score
  from texts d left join weights using (row) where d.target = 0
), placed as (
  select row, row_number() over (order by score desc, doc_id nulls first) as place, count(*) over () as eligible
  from scores where n_features >= 20
)
select doc_id, n_features, weight, score, case when place <= eligible * 10 // 100 then place end as rank
from scores left join placed using (row)
"""
