"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits differ in at most half the radius in one of their 32-bit halves. Every distinct
fingerprint emits its halves and, where a half has an odd number of set bits, the half's variants of one flipped bit (at
radius 3): an odd distance changes even to odd, so halves one bit apart meet on the even one. Rows meet by shuffle on
equal halves and are verified on all bits: some 34 rows a fingerprint, whatever the input.

Only where more meet on one half than can be compared there, whole variants do the same with all 64 bits: of radius 3
the even fingerprints emit one flip and the odd ones two, and few can meet on each. The work is on distinct
fingerprints: copies are one row however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import packed, same, text_hash, utf8
from ledgerloom.llm.components import components
from ledgerloom.sources.workspace import settle

SHINGLE_WORDS = 3
RADIUS = 3
HASH_SEED = 42
_HALF = 32
# Variants are written in batches of about this many rows.
_BATCH_ROWS = 200_000
# Runs of equal variants up to this length are compared pair by pair, longer ones by a walk over the links, which gives
# no more links than rows.
_SHORT_RUN = 4
# Of halves, no longer run is compared: no more can meet on a whole variant at radius 3 either.
_LONG_RUN = 2081
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text as an unsigned integer; zero for a text without a word.

    A-Z are lowered, words are split at ASCII white space, shingles count as often as they occur, and a text
    with fewer words than a shingle is one shingle. A bit is set where over half the shingle hashes set it.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, HASH_SEED) for s in shingles], dtype=np.uint64)
    starts = np.arange(0, len(hashes), 255)
    majority = 0
    for shift in range(8):
        # Eight counters a word, one in each byte; 255 hashes can't overflow them.
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, starts)
        counts = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > len(hashes)):
            majority |= 1 << (8 * int(byte) + shift)
    return majority


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash`` and the signed ``fingerprint`` of every row; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle_words) for t in utf8(batch.column(2))), np.uint64,
                                batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                                             names=["doc_id", "text_hash", "fingerprint"])

    return (docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, fingerprint long"))


def _links_of_runs(keys: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints with equal keys; ``keys`` are sorted. Long runs give a spanning forest."""
    lows, highs = [], []
    edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    lengths = np.diff(edges)
    run_of = np.repeat(np.arange(len(lengths)), lengths)
    short = lengths[run_of] <= _SHORT_RUN
    for gap in range(1, min(_SHORT_RUN, int(lengths.max(initial=0)))):
        meets = np.flatnonzero((run_of[gap:] == run_of[:-gap]) & short[gap:])
        if not len(meets):
            break
        near = meets[np.bitwise_count(prints[meets] ^ prints[meets + gap]) <= radius]
        lows.append(prints[near])
        highs.append(prints[near + gap])
    for run in np.flatnonzero(lengths > _SHORT_RUN):
        unseen = prints[edges[run]:edges[run + 1]]
        frontier: list[np.ndarray] = []
        while len(unseen):
            if not frontier:
                frontier, unseen = [unseen[:1]], unseen[1:]
            at, rest = frontier[-1][0], frontier[-1][1:]
            frontier = frontier[:-1] + ([rest] if len(rest) else [])
            near = np.bitwise_count(unseen ^ at) <= radius
            if near.any():
                found, unseen = unseen[near], unseen[~near]
                lows.append(np.full(len(found), at))
                highs.append(found)
                frontier.append(found)
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *lows]), np.concatenate([empty, *highs])


def _flips(bits: int, most: int) -> list[int]:
    return [sum(1 << bit for bit in chosen) for size in range(most + 1) for chosen in combinations(range(bits), size)]


def _emitted(value: Column, bits: int, radius: int) -> Column:
    """The variants by which values within ``radius`` bits meet: odd values flip a bit more if the radius is odd."""
    few, many = _flips(bits, radius // 2), _flips(bits, radius - radius // 2)
    return F.explode(F.when(F.bit_count(value) % 2 == 1, F.lit(many)).otherwise(F.lit(few)))


def _met(radius: int):
    """Links of rows ``variant``, ``fingerprint`` that come sorted by variant, whose length is known to be bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_prints = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
            found = np.concatenate([held_prints, batch.column(1).to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last run may go on
            held_keys, held_prints = keys[cut:], found[cut:]
            yield _linked(keys[:cut], found[:cut], radius)
        yield _linked(held_keys, held_prints, radius)

    return run


def _linked(keys: np.ndarray, found: np.ndarray, radius: int) -> pa.RecordBatch:
    low, high = _links_of_runs(keys, found, radius)
    return pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], names=["low", "high"])


def _met_on_halves(radius: int):
    """As ``_met`` for variants of halves; the fingerprints of runs too long to compare come as ``low`` with no ``high``."""

    def judged(keys: np.ndarray, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[:len(keys)])
        lengths = np.diff(np.concatenate([starts, [len(keys)]]))
        long = np.repeat(lengths > _LONG_RUN, lengths)
        crowd = np.unique(found[long])
        yield pa.RecordBatch.from_arrays([pa.array(crowd.view(np.int64)), pa.nulls(len(crowd), pa.int64())], names=["low", "high"])
        kept = ~long
        if radius // 2 == 1 and len(keys):
            # Halves that are equal or one bit apart meet on one of themselves; where all got by a flip, none need to.
            halves = np.where(keys >> _HALF == 0, found.view(np.int64) & ((1 << _HALF) - 1), (found >> np.uint64(_HALF)).view(np.int64))
            own = halves == keys & ((1 << _HALF) - 1)
            kept &= np.repeat(np.add.reduceat(own.astype(np.int64), starts) > 0, lengths)
        yield _linked(keys[kept], found[kept], radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_prints = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
            found = np.concatenate([held_prints, batch.column(1).to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last run may go on
            yield from judged(keys[:cut], found[:cut])
            held_keys, held_prints = keys[cut:], found[cut:]
            if len(held_keys) > _LONG_RUN:  # told now; what stays tells the rest of the run that it is long
                yield from judged(held_keys, held_prints)
                held_keys, held_prints = held_keys[:_LONG_RUN + 1], held_prints[:_LONG_RUN + 1]
        yield from judged(held_keys, held_prints)

    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``low`` and ``high``: links that connect every two distinct fingerprints within ``radius`` bits.

    Those that meet in a run of many are joined by a spanning forest of that run instead of by all pairs, so a dense
    group of near copies stays linear; components are the same. A half can be that of any number of fingerprints: those
    of longer runs than ``_LONG_RUN`` meet again on whole variants, which at radius 3 are reached from at most 2,081
    fingerprints. So no task holds more than that, whatever the input.
    """
    low_half = F.col("fingerprint").bitwiseAND(F.lit((1 << _HALF) - 1))
    halves = F.array(low_half, F.shiftrightunsigned("fingerprint", _HALF))
    emitted = (prints.select("fingerprint", F.posexplode(halves).alias("half", "value"))
               .select("fingerprint", "half", "value", _emitted(F.col("value"), _HALF, radius // 2).alias("flip"))
               .select(F.shiftleft(F.col("half").cast("long"), _HALF)
                       .bitwiseOR(F.col("value").bitwiseXOR(F.col("flip"))).alias("variant"), "fingerprint"))
    near = settle(emitted.repartition("variant").sortWithinPartitions("variant")
                  .mapInArrow(_met_on_halves(radius), "low long, high long"), "near")
    crowded = near.where("high is null").select(F.col("low").alias("fingerprint")).distinct()
    return near.where("high is not null").unionByName(_links_by_variants(crowded, radius))


def _links_by_variants(prints: DataFrame, radius: int) -> DataFrame:
    """``links`` by whole variants."""
    few = np.array(_flips(64, radius // 2), np.uint64)
    many = np.array(_flips(64, radius - radius // 2), np.uint64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy().view(np.uint64)
            odd = np.bitwise_count(found) % 2 == 1
            for chosen, flips in ((found[~odd], few), (found[odd], many)):
                step = max(1, _BATCH_ROWS // len(flips))
                for at in range(0, len(chosen), step):
                    own = chosen[at:at + step]
                    variants = (own[:, None] ^ flips).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(variants.view(np.int64)), pa.array(np.repeat(own, len(flips)).view(np.int64))],
                        names=["variant", "fingerprint"])

    return (prints.mapInArrow(emit, "variant long, fingerprint long")
            .repartition("variant").sortWithinPartitions("variant").mapInArrow(_met(radius), "low long, high long"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fingerprint`` (signed), ``component_id`` and ``root`` of every row.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` differing bits. A null
    text has fingerprint zero and is linked like any other; a null doc_id is in its component but names it only
    if no other id does (then null). ``root`` is the smallest fingerprint of the component. Repeated rows are
    repeated in the result, texts of any length are read whole, an empty table gives an empty result; other columns
    are not read.
    """
    printed = settle(fingerprints(docs, shingle_words), "fingerprints")
    classes = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(classes.select("fingerprint"), radius))
    rooted = (classes.join(roots, classes["fingerprint"] == roots["node"], "left")
              .select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")))
    named = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first_id").alias("component_id"))
    named = (rooted.join(named, rooted["root"] == named["_root"])
             .select(F.col("fingerprint").alias("_fingerprint"), "root", "component_id"))
    return (printed.join(named, printed["fingerprint"] == named["_fingerprint"])
            .select("doc_id", "text_hash", "fingerprint", "component_id", "root"))


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group: the one with the smallest doc_id.

    Rows of one doc_id in one group stand in order of their text's hash; copies of a row become one row. Every column
    comes back whatever its name; an empty table gives an empty one.
    """
    found = near_duplicates(docs, shingle_words, radius)
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "text_hash", "copies"))
    kept = settle(rows.groupBy("root").agg(first.alias("first"))
                  .select("first.doc_id", F.col("first.text_hash").alias("_text_hash"), "first.copies"), "kept")
    hashed = packed(docs)
    rows = hashed.join(kept, same(hashed, kept, "doc_id", "_text_hash"), "left_semi")
    if not kept.where("copies > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "_text_hash"])
    return rows.select("row.*")
