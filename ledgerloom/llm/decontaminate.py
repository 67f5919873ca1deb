"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A document is contaminated by a benchmark item if ``WINDOW`` consecutive words of it equal ``WINDOW`` consecutive
words of the item in all but ``SUBSTITUTED`` places. Seeds find the candidates: a seed hashes the words at the
places of a fixed mask and ignores the places between, so words exchanged there don't matter. The masks were
chosen so that for every two places of a window at least one mask, laid somewhere in the window, avoids both:
no overlap within the bound is missed. Every hit is then verified word by word on the windows around it.

The text is never shuffled: the seeds of the benchmark are broadcast in blocks of bounded size, and each block
is one pass over the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import packed, same, text_hash
from ledgerloom.sources.workspace import settle

WINDOW = 13
SUBSTITUTED = 2
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
# Items shorter than a window must stand in the text whole and unchanged; below this many words they aren't sought.
MIN_WORDS = 5
# Seeds broadcast at once; each carries at most 2 * WINDOW words of its item.
BLOCK_SEEDS = 200_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seeds(worded: DataFrame, masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """``worded`` with a row for each place ``at`` and mask: the hash ``seed`` of the words under the mask.

    Places past the end are left out of a hash; such seeds find nothing that stands verification. The outer
    explodes keep Catalyst from evaluating the words a second time in a filter.
    """
    placed = worded.withColumn("at", F.explode_outer(
        F.when(F.size("words") >= MIN_WORDS, F.sequence(F.lit(0), F.size("words") - 1))))
    hashes = [F.xxhash64(F.lit(number), *[F.get("words", F.col("at") + place) for place in mask])
              for number, mask in enumerate(masks)]
    return placed.withColumn("seed", F.explode_outer(F.array(*hashes)))


def _masks_for(items: DataFrame) -> tuple[tuple[int, ...], ...]:
    """The production masks and, for each length of a short item that occurs, a mask without a gap."""
    lengths = (items.select(F.size("item_words").alias("n")).where(F.col("n").between(MIN_WORDS, WINDOW - 1))
               .distinct().collect())
    return MASKS + tuple(tuple(range(n)) for n in sorted(row.n for row in lengths))


def _item_seeds(items: DataFrame, masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Seeds of the benchmark: long items by the spaced masks, short ones whole, with the words around them."""
    found = None
    for number, mask in enumerate(masks):
        span, n = mask[-1] + 1, F.size("item_words")
        rightly = n >= WINDOW if number < len(MASKS) else n == span
        placed = items.where(rightly).withColumn("at", F.explode(F.sequence(F.lit(0), n - span)))
        first = F.greatest(F.col("at") + span - WINDOW, F.lit(0))
        own = placed.select(
            "item_id", F.xxhash64(F.lit(number), *[F.get("item_words", F.col("at") + k) for k in mask]).alias("seed"),
            (F.col("at") - first).alias("item_at"), F.lit(span).alias("item_span"),
            F.least(n, F.lit(WINDOW)).alias("window"), F.slice("item_words", first + 1, F.lit(2 * WINDOW)).alias("item_words"))
        found = own if found is None else found.unionByName(own)
    return found.distinct()


def _windows(hits: DataFrame) -> DataFrame:
    """A row for each window around each hit: the equal words, and the place in the document where it starts."""
    window = F.col("window")
    low = F.greatest(F.lit(0), F.col("item_at") + F.col("item_span") - window, -F.col("shift"))
    high = F.least(F.col("item_at"), F.size("item_words") - window, F.col("n_words") - window - F.col("shift"))
    laid = hits.withColumn("start", F.explode_outer(F.when(low <= high, F.sequence(low, high))))
    equal = F.aggregate(F.sequence(F.lit(0), window - 1), F.lit(0), lambda total, k: total + F.when(
        F.get("words", F.col("shift") + F.col("start") + k - F.col("from")) == F.get("item_words", F.col("start") + k), 1)
        .otherwise(0))
    return laid.where("start is not null").select(
        "doc_id", "text_hash", "item_id", "window", equal.alias("equal_words"),
        (F.col("shift") + F.col("start")).alias("first_word"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``item_id``, ``equal_words``, ``window`` and ``first_word`` of each overlap.

    One row for each row of ``docs`` (by doc_id and text) and benchmark item that overlap, with the best window
    found: the most equal words of ``window``, and the smallest word place (from 0) where it starts. Words are
    runs of letters and digits in lower case. A null or empty text overlaps nothing, and neither do items of
    fewer than five words. Null ids are ids like others; repeated rows and repeated items count once; of equally good
    windows the first counts; texts of any length are read whole; empty tables give an empty result; other columns
    aren't read.
    """
    items = benchmark.select(F.col("item_id").cast("long"), _words(F.col("text")).alias("item_words")).distinct()
    masks = _masks_for(items)
    seeds = settle(_item_seeds(items, masks), "benchmark_seeds")
    blocks = max(1, -(-seeds.count() // BLOCK_SEEDS))
    worded = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("text_hash"),
                         _words(F.col("text")).alias("words"))
    laid = _seeds(worded, masks)
    # What a hit needs of its document: the words that windows around it can reach.
    shift = F.col("at") - F.col("item_at")
    reach = F.greatest(shift, F.lit(0))
    found = None
    for block in range(blocks):
        own = seeds.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == block)
        hits = laid.join(F.broadcast(own), "seed").select(
            "doc_id", "text_hash", "item_id", "item_at", "item_span", "window", "item_words", shift.alias("shift"),
            F.size("words").alias("n_words"), reach.alias("from"), F.slice("words", reach + 1, F.lit(3 * WINDOW)).alias("words"))
        # The shuffle of the few hits also ends the generated code of the many places, which would get too long for
        # the JVM to compile.
        hits = _windows(hits.repartition("doc_id", "text_hash", "item_id")).where(
            F.col("equal_words") >= F.col("window") - F.when(F.col("window") == WINDOW, SUBSTITUTED).otherwise(0))
        found = hits if found is None else found.unionByName(hits)
    best = found.groupBy("doc_id", "text_hash", "item_id", "window", "equal_words").agg(
        F.min("first_word").alias("first_word"))
    return (best.groupBy("doc_id", "text_hash", "item_id", "window")
            .agg(F.max(F.struct("equal_words", "first_word")).alias("best"))
            .select("doc_id", "text_hash", "item_id", "best.equal_words", "window", "best.first_word"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, unchanged, with every column whatever its name.

    Null and empty texts overlap nothing and stay; repeated rows go or stay together; an empty table or benchmark is
    allowed.
    """
    found = settle(contaminated(docs, benchmark).select("doc_id", F.col("text_hash").alias("_text_hash")).distinct(),
                   "contaminated")
    rows = packed(docs)
    return rows.join(found, same(rows, found, "doc_id", "_text_hash"), "left_anti").select("row.*")


# The same by another way: two exchanged words of 13 leave four equal ones in a row, which fix the alignment.
ORACLE_SQL = """
with doc_words as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as words
  from documents),
items as (
  select distinct item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as words
  from benchmark),
doc_places as (select doc_id, words, unnest(range(len(words) - 3)) as at from doc_words where len(words) >= 5),
item_places as (select item_id, words, unnest(range(len(words) - 3)) as at from items where len(words) >= 5),
aligned as (
  select distinct d.doc_id, i.item_id, d.at - i.at as shift, d.words as dw, i.words as iw,
    least(len(i.words), 13) as w
  from doc_places d join item_places i on list_slice(d.words, d.at + 1, d.at + 4) = list_slice(i.words, i.at + 1, i.at + 4)),
windows as (
  select *, unnest(range(greatest(0, -shift), least(len(iw) - w, len(dw) - w - shift) + 1)) as s from aligned),
scored as (
  select doc_id, item_id, w, shift + s as first_word,
    len(list_filter(range(w), lambda k: dw[shift + s + k + 1] = iw[s + k + 1])) as equal_words
  from windows),
hits as (select * from scored where equal_words >= w - if(w = 13, 2, 0))
select doc_id, item_id, max(equal_words) as equal_words, any_value(w) as "window",
  arg_min(first_word, (-equal_words, first_word)) as first_word
from hits group by doc_id, item_id
"""
