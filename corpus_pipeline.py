"""From raw documents to token ids: the stages in order, each on what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, language_id, line_dedup, pieces, simhash
from ledgerloom.llm.common import on_workers, table
from ledgerloom.sources.workspace import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A document is kept if at least this share of its n-grams is known in the language found for it.
LEAST_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that knows their n-grams, go; the others pass unchanged."""
    on_workers(spark)
    filters = language_id.learn(docs.where(~language_id.held_out()))
    found = language_id.identify(docs.select(F.struct("*").alias("row"), "text"), filters)
    sure = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.where(sure).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line are taken out of the texts; ``n_chars`` follows the text."""
    cleaned = line_dedup.cleaned(docs)
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("text").cast("long"))
    return cleaned.select(row.alias("row")).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    on_workers(spark)
    return simhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_pieces`` and ``ids`` of every document, and whether the ids give the text back."""
    on_workers(spark)
    model = pieces.model_of(spark)
    coded = pieces.encode(docs, model, checked=True)
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontaminate_benchmark),
    ("sentencepiece", encode_pieces),
]

# Fingerprints and trained filters can't be put in SQL; tests hold the stages against plain decisions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
