"""Small helpers the corpus operators share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def on_workers(spark: SparkSession) -> None:
    """Let Python workers find this package wherever they are started; a cluster has it at the same path or installed."""
    root, environment = str(Path(__file__).parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_hash(text: Column) -> Column:
    """With the document id this names a row: rows equal in both are copies and share every decision."""
    return F.xxhash64(text, F.isnull(text))


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``_text_hash`` and all columns as one ``row``, so that no name of theirs can clash with an operator's."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("_text_hash"),
                       F.struct("*").alias("row"))


def give_back() -> None:
    """Return memory this process no longer uses to the system: a Python worker stays for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The strings of an Arrow column as UTF-8 bytes, one at a time; a null is empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the named columns, null equal to null."""
    condition = None
    for name in names:
        one = left[name].eqNullSafe(right[name])
        condition = one if condition is None else condition & one
    return condition
