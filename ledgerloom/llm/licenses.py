"""License scan: an exact set-similarity join of text blocks with license notices.

A block matches a template if it holds at least ``CONTAINMENT`` of the template's different words. Words stand in
one global order, rarest in the corpus first. A template with ``n`` words of which ``need`` must be found can't
match a block that has none of its first ``n - need + 1`` words (prefix filter); a block with fewer than ``need``
template words is too short (length filter); and the first shared word bounds the overlap by what is left behind it
on either side (positional filter). What passes is verified, so no matching block is missed and none is wrong. Blocks
are at least twice as long as the template, so a notice that stands word for word lies whole in one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import same, text_hash, utf8
from ledgerloom.sources.workspace import settle

CONTAINMENT = 0.9
# Blocks of this many words begin at every half block, so a notice of up to half a block lies whole in one; for longer
# templates the length is doubled until it does.
BLOCK_WORDS = 128

# Phrases and labels of the base scan.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# The wording of public license notices, by SPDX-like label.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mit": "Released under the MIT License",
    "mit-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction",
}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _words(text: bytes) -> list[bytes]:
    """Words of a text: runs of digits, letters a-z and anything beyond ASCII, A-Z lowered."""
    return _WORD.findall(text.lower())


def _phrase_pattern(phrase: str) -> re.Pattern[bytes]:
    gap = rb"[^0-9a-z\x80-\xff]+"
    return re.compile(rb"(?<![0-9a-z\x80-\xff])" + gap.join(w.encode() for w in phrase.split())
                      + rb"(?![0-9a-z\x80-\xff])")


def _base_places(low: bytes, patterns: dict[str, re.Pattern[bytes]]) -> tuple[int, list[tuple[int, str]]]:
    """The number of words, and the word place and label of every phrase."""
    inside = _IN_WORD[np.frombuffer(low, np.uint8)]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begins = np.flatnonzero(starts)
    hits = [(m.start(), label) for label, pattern in patterns.items() for m in pattern.finditer(low)]
    places = np.searchsorted(begins, [at for at, _ in hits]).tolist()
    return len(begins), [(place, label) for place, (_, label) in zip(places, hits, strict=True)]


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> Counter:
    """How often each word of the vocabulary occurs in all texts; one row a word and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in utf8(batch.column(0)):
                total.update([w for w in _words(text) if w in vocabulary])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                         names=["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return Counter({bytes(row.word): row.n for row in rows.collect()})


def _need(size: int, containment: float) -> int:
    return ceil(containment * size - 1e-9)


def _half_block(n_words: int) -> int:
    half = BLOCK_WORDS // 2
    while half < n_words:
        half *= 2
    return half


def _scan(docs: DataFrame, place: dict[bytes, int], prefixes: dict[int, set[bytes]]) -> DataFrame:
    """Base scan of every row, and the template words (in global order) of the blocks with a prefix word.

    ``prefixes`` has the prefix words of the templates by half the length of their blocks.
    """
    names = ["doc_id", "text_hash", "n_words", "places", "found", "blocks"]
    patterns = {label: _phrase_pattern(phrase) for phrase, label in BASE_PHRASES.items()}
    prefix = frozenset().union(*prefixes.values())

    def blocks_of(low: bytes) -> list[dict]:
        words = _WORD.findall(low)
        if prefix.isdisjoint(words):
            return []
        at = sorted((k, w) for k, w in enumerate(words) if w in place)
        return [block for half, first in prefixes.items() for block in blocks_at(at, half, first)]

    def blocks_at(at: list[tuple[int, bytes]], half: int, prefix: set[bytes]) -> list[dict]:
        starts = {s for k, w in at if w in prefix for s in (k // half * half, (k // half - 1) * half) if s >= 0}
        by_half: dict[int, set[int]] = {}
        for k, word in at:
            by_half.setdefault(k // half, set()).add(place[word])
        none: set[int] = set()
        return [{"block": s, "half": half, "tokens": sorted(by_half.get(s // half, none) | by_half.get(s // half + 1, none))}
                for s in sorted(starts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places, labels, blocks = [], [], [], []
            for text in utf8(batch.column(2)):
                low = text.lower()
                n, found = _base_places(low, patterns)
                counts.append(n)
                places.append([p for p, _ in found])
                labels.append(sorted({label for _, label in found}))
                blocks.append(blocks_of(low))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(places, pa.list_(pa.int64())),
                 pa.array(labels, pa.list_(pa.string())),
                 pa.array(blocks, pa.list_(pa.struct([("block", pa.int64()), ("half", pa.int64()), ("tokens", pa.list_(pa.int32()))])))],
                names=names)

    return (docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, n_words long, places array<long>, found array<string>, "
                             "blocks array<struct<block: long, half: long, tokens: array<int>>>"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> tuple[DataFrame, DataFrame]:
    """The scan of every row, and the matches: ``doc_id, text_hash, block, template, overlap, containment``.

    The first has ``doc_id, text_hash, n_words, n_base, first_word, last_word, base_labels, labels, score``; score is
    1 where a base phrase stands, else the best containment at or over the threshold, else 0. A match's ``block`` is
    the word place where the block begins; a template longer than half of ``BLOCK_WORDS`` has longer blocks of its own,
    others keep theirs. A notice spread by other words over more than half a block can be lost. A null or empty text has no words and no labels; rows equal in doc_id and
    text are scanned alike; null ids are ids like others; texts of any length are read whole, in time that grows with
    their length; empty tables give empty results; other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    worded = {label: _words(text.encode()) for label, text in templates.items()}
    sets = {label: set(words) for label, words in worded.items()}
    vocabulary = set().union(*sets.values())
    counts = word_counts(docs, vocabulary)
    order = sorted(vocabulary, key=lambda w: (counts[w], w))
    place = {word: k for k, word in enumerate(order)}
    rows, prefixes = [], {}
    for label, words in sorted(sets.items()):
        tokens = sorted(place[w] for w in words)
        need, half = _need(len(tokens), containment), _half_block(len(worded[label]))
        for at, token in enumerate(tokens[:len(tokens) - need + 1] if tokens else []):
            rows.append((label, half, token, at, tokens, need))
            prefixes.setdefault(half, set()).add(order[token])
    index = docs.sparkSession.createDataFrame(
        rows, "template string, half long, token int, at int, template_tokens array<int>, need int")
    scanned = settle(_scan(docs, place, prefixes), "license_scan")

    blocks = (scanned.select("doc_id", "text_hash", F.explode("blocks").alias("b"))
              .select("doc_id", "text_hash", "b.block", "b.half", "b.tokens").distinct())
    tokens = blocks.select("doc_id", "text_hash", "block", "half", "tokens", F.posexplode("tokens").alias("block_at", "token"))
    key = ["doc_id", "text_hash", "block", "template"]
    first = (tokens.join(F.broadcast(index), ["token", "half"]).where(F.size("tokens") >= F.col("need"))
             .groupBy(*key).agg(F.min(F.struct("at", "block_at", "need", "template_tokens", "tokens")).alias("first"))
             .select(*key, "first.*"))
    left = F.least(F.size("template_tokens") - F.col("at"), F.size("tokens") - F.col("block_at"))
    matches = (first.where(left >= F.col("need"))
               .withColumn("overlap", F.size(F.array_intersect("tokens", "template_tokens")))
               .where("overlap >= need")
               .select(*key, "overlap", (F.col("overlap") / F.size("template_tokens")).alias("containment")))
    matches = settle(matches, "license_matches")

    best = matches.groupBy("doc_id", "text_hash").agg(F.collect_set("template").alias("matched"),
                                                      F.max("containment").alias("best"))
    joined = scanned.join(best, same(scanned, best, "doc_id", "text_hash"), "left")
    labels = F.array_distinct(F.concat("found", F.coalesce("matched", F.array().cast("array<string>"))))
    result = joined.select(
        scanned["doc_id"], scanned["text_hash"], "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join(F.array_sort("found"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
    return result, matches
