"""Language identification with bit-sliced Bloom filters over character n-grams.

One filter per language would need as many look-ups as languages. Here all filters share their slots: a slot
holds one bit per language, so the AND of an n-gram's slots is the set of all languages that contain it. The
bits set for each language over a text's n-grams are counted, corrected for the share that the filter's fill
sets by chance, and the language with the most remaining n-grams is chosen.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import give_back

UNDETERMINED = "und"
ORDERS = (3, 4)
# Bounds of learning: about so many documents a language, chosen by the hash of their text.
SAMPLE_PER_LANGUAGE = 2_000
# An n-gram belongs to a language if it occurs so often in the sample, and so often beside the language that
# has it most; else a few foreign words would put their n-grams into every filter.
LEAST_COUNT = 3
LEAST_SHARE = 0.05
SLOT_BITS = 21
# Odd multipliers; the top bits of the products are the slots of an n-gram.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_STEP = np.uint64(0x100000001B3)
_SLICE = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of a text, in slices: letters in lower case, one space for anything between."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return
    keep = letter | np.concatenate(([True], letter[:-1]))
    codes = np.concatenate(([32], np.where(letter, codes, 32)[keep], [32])).astype(np.uint64)
    for start in range(0, len(codes), _SLICE):
        part = codes[start:start + _SLICE + max(ORDERS) - 1]
        for order in ORDERS:
            grams = np.full(max(0, min(len(part) - order + 1, _SLICE)), order, np.uint64)
            for k in range(order):
                grams = grams * _STEP + part[k:k + len(grams)]
            if len(grams):
                yield grams


def _slots(grams: np.ndarray) -> Iterator[np.ndarray]:
    for multiplier in MULTIPLIERS:
        yield (grams * np.uint64(multiplier)) >> np.uint64(64 - SLOT_BITS)


@dataclass(frozen=True)
class Filters:
    """``planes[p][slot]`` has a bit for each of the languages 8 p to 8 p + 7; ``chance`` is the false-positive rate."""

    languages: tuple[str, ...]
    planes: np.ndarray
    chance: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and the corrected share of n-grams it contains; ties go to the first name."""
        counts, total = np.zeros(8 * len(self.planes), np.int64), 0
        for grams in _grams(text or ""):
            total += len(grams)
            slots = list(_slots(grams))
            for number, plane in enumerate(self.planes):
                masks = plane[slots[0]] & plane[slots[1]] & plane[slots[2]]
                counts[8 * number:8 * number + 8] += np.bincount(masks, minlength=256) @ _BITS
        if not total or not self.languages:
            return UNDETERMINED, 0.0
        share = counts[:len(self.languages)] / total
        corrected = np.clip((share - self.chance) / np.maximum(1 - self.chance, 1e-9), 0, 1)
        best = int(np.argmax(corrected))
        return self.languages[best], float(corrected[best])


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _counted(sample: DataFrame) -> DataFrame:
    """``lang``, ``gram`` and how often it occurs; counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_language: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_language.setdefault(lang, []).extend(_grams(text))
            for lang, grams in by_language.items():
                if grams:
                    gram, count = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(count)],
                        names=["lang", "gram", "count"])
            del by_language
            give_back()

    return sample.mapInArrow(run, "lang string, gram long, count long").groupBy("lang", "gram").agg(
        F.sum("count").alias("count"))


def learn(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Filters:
    """Filters from ``text`` and ``lang`` of ``docs``; rows where either is null teach nothing.

    What reaches the driver is one row a language and at most 2 ** SLOT_BITS slots of a filter plane, whatever
    the number of documents.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sizes = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(sizes))
    planes = np.zeros((max(1, -(-len(languages) // 8)), 1 << SLOT_BITS), np.uint8)
    if not languages:
        return Filters((), planes, np.zeros(0))
    spark = docs.sparkSession
    known = spark.createDataFrame([(lang, number, min(1.0, sample_per_language / sizes[lang]))
                                   for number, lang in enumerate(languages)], "lang string, number int, share double")
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < F.col("share") * float(1 << 40)
    counted = _counted(rows.join(F.broadcast(known), "lang").where(drawn).select("lang", "text"))
    # Rates are against all n-grams of the language, so a language with few documents isn't outvoted.
    rates = _rates(counted)
    most = F.max("rate").over(Window.partitionBy("gram"))
    own = (rates.withColumn("most", most).where(F.col("count") >= LEAST_COUNT)
           .where(F.col("rate") >= LEAST_SHARE * F.col("most")).join(F.broadcast(known), "lang"))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, number = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            for found in _slots(grams):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((number // 8).astype(np.int32)), pa.array(found.astype(np.int32)),
                     pa.array((1 << (number % 8)).astype(np.int32))], names=["plane", "slot", "mask"])

    filled = (own.select("gram", "number").mapInArrow(slots, "plane int, slot int, mask int")
              .groupBy("plane", "slot").agg(F.bit_or("mask").alias("mask")))
    for batch in filled.toArrow().to_batches():
        planes[batch.column(0).to_numpy(), batch.column(1).to_numpy()] = batch.column(2).to_numpy().astype(np.uint8)
    fill = [float((planes[k // 8] >> (k % 8) & 1).mean()) for k in range(len(languages))]
    return Filters(languages, planes, np.array(fill) ** len(MULTIPLIERS))


def _rates(counted: DataFrame) -> DataFrame:
    totals = counted.groupBy("lang").agg(F.sum("count").alias("all"))
    return counted.join(F.broadcast(totals), "lang").withColumn("rate", F.col("count") / F.col("all"))


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; the text is all a prediction sees.

    A null text or one without a letter is ``und`` with score 0. One pass without a shuffle; repeated rows are
    predicted alike, other columns pass unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def predict(text):
        import pandas as pd

        return pd.DataFrame([shared.value.predict(t) for t in text], columns=["lang_pred", "score"])

    marked = docs.withColumn("_found", predict("text"))
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns], "_found.lang_pred", "_found.score")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 by 3; a null id doesn't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
