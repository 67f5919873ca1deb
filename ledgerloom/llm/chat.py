"""Conversations as training text with a loss mask, and back.

Turns of a conversation are dealt to one task and sorted there by Spark; the compiled template then takes them one
at a time and its output is stored in chunks, so a conversation of any length needs the memory of one turn and one
chunk. Reading back streams the chunks in the same way.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.template import compile_template, unescape
from ledgerloom.sources.workspace import settle

TEMPLATE = (
    "{% for m in messages %}<turn {{ m.role | escape }}>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}")
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.DOTALL)
CHUNK_CHARS = 256 << 10
_BATCH_CHUNKS = 16

_FORMATTED = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("text", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*((value.as_py() for value in column) for column in batch.columns), strict=True)


def _batches(rows: Iterator[dict[str, Any]], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[dict[str, Any]] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``conv_id``, ``chunk`` (from 0), ``text`` and ``loss`` (spans of the text that are trained on).

    Turns go by ``turn`` (null first), turns of equal number by role and text; repeated rows are repeated turns. A
    null role or text is empty, rows without conv_id are one conversation of their own, and other columns are not
    read. The template is compiled on the driver first, so a faulty one fails at once.
    """
    compile_template(template)
    turns = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                 F.coalesce(F.col("role"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(chunks(batches), _FORMATTED, _BATCH_CHUNKS)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        render = compile_template(template)
        for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
            number, parts, size, loss = 0, [], 0, []
            for text, trained in render(messages=({"role": r[2], "text": r[3]} for r in rows)):
                if size > chunk_chars:
                    yield {"conv_id": conv_id, "chunk": number, "text": "".join(parts), "loss": loss}
                    number, parts, size, loss = number + 1, [], 0, []
                if trained and text:
                    loss.append({"start": size, "end": size + len(text)})
                parts.append(text)
                size += len(text)
            yield {"conv_id": conv_id, "chunk": number, "text": "".join(parts), "loss": loss}

    return settle(turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        run, "conv_id long, chunk long, text string, loss array<struct<start: long, end: long>>"), "formatted")


def turns_of(chunks: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Role and text of every turn in the chunks of one conversation."""
    held = ""
    for chunk in chunks:
        held, end = held + chunk, 0
        while found := _TURN.match(held, end):
            end = found.end()
            yield unescape(found[1]), unescape(found[2])
        held = held[end:]
    if held:
        raise ValueError(f"not a turn: {held[:40]!r}")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation with counts and digests of what its stored text says.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(digests(batches), schema, 1000)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
            row = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
            said, trained = hashlib.sha256(), hashlib.sha256()

            def texts(rows=rows, row=row, trained=trained) -> Iterator[str]:
                for _, _, text, loss in rows:
                    row["formatted_chars"] += len(text)
                    for span in loss:
                        part = unescape(text[span["start"]:span["end"]])
                        row["loss_chars"] += len(part)
                        trained.update(part.encode("utf-8", "surrogatepass"))
                    yield text

            for role, text in turns_of(texts()):
                row["n_turns"] += 1
                said.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            yield row | {"turns_sha256": said.hexdigest(), "loss_sha256": trained.hexdigest()}

    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
