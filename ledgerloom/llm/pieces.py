"""SentencePiece encoding and decoding with a relational lattice.

A text is cut where no piece can reach across, which gives words; the different words go through the lattice once,
however often they occur. Bounded substrings of a word are exploded and joined to the piece table; the edges found are
grouped by word, and a fold with Spark's ``aggregate`` keeps the best score of each place and the pieces that lead
there (Viterbi). Words of any length are taken apart into ranges of places first, so no row of the explosion holds
more than a range.

Pieces that no best segmentation can use, because shorter pieces spell the same at a better score, are left out of the
table: for a model whose scores are merge ranks these are two thirds.

Texts are stored as numbers into the vocabulary of their block, some tens of megabytes of text. The vocabularies, not
the texts, go through the shuffles to the lattice and come back as ids to their block: the larger the block, the fewer
words. Tasks cut, number and decode the texts of a block in small parts, so that a block costs them little memory.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import give_back, utf8
from ledgerloom.sources.workspace import fresh_path

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Fixed value: what an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0

# Texts are stored and brought together with their ids in blocks of about so many bytes, which share a vocabulary. They
# are numbered in parts of about so many bytes, and cut in parts of them.
BLOCK_BYTES = 36 << 20
PART_BYTES = 4 << 20
_CUT_BYTES = 1 << 20
# Rows whose texts and ids are put together at a time.
_ROWS = 500
# Places of a word that are exploded and folded together.
RANGE = 512
# An edge is one whole number: where it ends in its range, how long it is and the piece's id.
_LENGTH_BITS, _ID_BITS = 6, 24


@dataclass(frozen=True)
class Model:
    """The pieces by id, their scores, and the ids of the unknown piece and of the first byte piece (or -1)."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    normal: tuple[bool, ...]
    unknown: int
    first_byte: int

    @functools.cached_property
    def longest(self) -> int:
        return max((len(p) for p, usual in zip(self.pieces, self.normal, strict=True) if usual), default=1)

    @functools.cached_property
    def spelt(self) -> pa.Array:
        """The UTF-8 bytes of each id; control and unknown pieces have none."""
        low = self.first_byte
        return pa.array([piece.replace(SPACE, " ").encode("utf-8", "surrogatepass") if usual else
                         bytes([k - low]) if low >= 0 and low <= k < low + 256 else b""
                         for k, (piece, usual) in enumerate(zip(self.pieces, self.normal, strict=True))], pa.large_binary())

    def words(self) -> list[tuple[str, int, float]]:
        return [(p, k, self.scores[k]) for k, p in enumerate(self.pieces) if self.normal[k]]

    @functools.cached_property
    def useful(self) -> list[tuple[str, int, float]]:
        """The words that may stand in a best segmentation: no shorter pieces spell them at a better score."""
        scores = {piece: score for piece, _, score in self.words()}

        def in_parts(piece: str) -> float:
            best = [0.0] + [float("-inf")] * len(piece)
            for end in range(1, len(piece) + 1):
                best[end] = max((best[start] + scores.get(piece[start:end], float("-inf")) for start in range(end)
                                 if end - start < len(piece)), default=float("-inf"))
            return best[-1]

        return [(piece, k, score) for piece, k, score in self.words() if in_parts(piece) <= score]

    @functools.cached_property
    def unknown_score(self) -> float:
        return min((score for _, _, score in self.words()), default=0.0) - UNKNOWN_PENALTY


def load(path: str = MODEL) -> Model:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = tuple(model.id_to_piece(k) for k in ids)
    byte = [k for k in ids if model.is_byte(k)]
    return Model(pieces, tuple(float(model.get_score(k)) for k in ids),
                 tuple(not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))
                       for k in ids), model.unk_id(), byte[0] if len(byte) == 256 else -1)


class Cutter:
    """Cuts texts between characters that stand side by side in no piece, so no piece reaches across a cut."""

    def __init__(self, model: Model):
        pieces = [p for p, _, _ in model.useful if len(p) > 1]
        chars = sorted({c for p in pieces for c in p})
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.kinds = len(chars) + 1
        joined = np.zeros((self.kinds, self.kinds), bool)
        for piece in pieces:
            kinds = self.kind[[ord(c) for c in piece]]
            joined[kinds[:-1], kinds[1:]] = True
        self.kind[ord(" ")] = self.kind[ord(SPACE)]
        self.apart = ~joined.ravel()

    def words(self, texts: Iterable[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts in a row, each text with a space before it, and how many each text has.

        Spaces are as in the text; an empty text has no words.
        """
        texts = list(texts)
        sizes = np.array([len(text) for text in texts], np.int64)
        data = b" " * bool(sizes.any()) + b" ".join([text for text in texts if text])
        del texts
        starts = np.cumsum(np.concatenate([[0], sizes[sizes > 0] + 1]))
        kind = np.int32 if len(data) < 1 << 31 else np.int64
        cuts, at, last = [], 0, 0
        while at < len(data):
            end = min(at + _CUT_BYTES, len(data))
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
            chars = np.frombuffer(data[at:end].decode("utf-8").encode("utf-32-le"), np.uint32)
            kinds = self.kind[chars]
            widths = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
            places = at + np.cumsum(widths) - widths
            cut = self.apart[np.concatenate([[last], kinds[:-1]]) * self.kinds + kinds]
            cut[np.searchsorted(places, starts[np.searchsorted(starts, at):np.searchsorted(starts, end)])] = True
            # A batch of texts is well under 2 GB, so places fit in 32 bits unless one text fills that alone.
            cuts.append(places[cut].astype(kind))
            at, last = end, int(kinds[-1])
        offsets = np.concatenate([*cuts, np.array([len(data)], kind)])
        del cuts
        words = pa.Array.from_buffers(pa.string() if kind is np.int32 else pa.large_string(), len(offsets) - 1,
                                      [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        counts = np.zeros(len(sizes), np.int64)
        counts[sizes > 0] = np.diff(np.searchsorted(offsets, starts.astype(kind)))
        return words, counts


@functools.lru_cache(maxsize=2)
def _cutter(model: Model) -> Cutter:
    return Cutter(model)


# --- the lattice ------------------------------------------------------------------------------------------------


def _parts_of(code: Column) -> tuple[Column, Column, Column]:
    """End, length and id of an edge."""
    length = (1 << _LENGTH_BITS) - 1
    return (F.shiftright(code, _LENGTH_BITS + _ID_BITS).cast("int"),
            F.lit(length) - F.shiftright(code, _ID_BITS).bitwiseAND(F.lit(length)).cast("int"),
            code.bitwiseAND(F.lit((1 << _ID_BITS) - 1)))


def _step_of(at: Column, piece: Column) -> Column:
    """A step of a path, as one whole number: where the piece begins, and its id."""
    return F.shiftleft(at.cast("bigint"), _ID_BITS).bitwiseOR(piece.cast("bigint"))


def _viterbi(edges: Column) -> Column:
    """The best path of a word of one range.

    Edges come sorted by end and then by start, so of equal scores the longest last piece wins. The state has an entry
    for each place reached: the best score up to it and the steps that lead there. It grows by an entry whenever an
    edge reaches a new place; places come in order since every character is an edge.
    """
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<bigint>").alias("path")))

    def read(edge: Column) -> Column:
        end, length, piece = _parts_of(edge["code"])
        return F.struct(end.alias("end"), (end - length).alias("start"), edge["score"].alias("score"),
                        F.array(_step_of(end - length, piece)).alias("step"))

    def step(state: Column, edge: Column) -> Column:
        before = F.get(state, edge["start"])
        score = before["score"] + edge["score"]
        entry = F.array(F.struct(score.alias("score"), F.concat(before["path"], edge["step"]).alias("path")))
        return (F.when(F.size(state) == edge["end"], F.concat(state, entry))
                .when(score > F.get(state, edge["end"])["score"], F.concat(F.slice(state, F.lit(1), edge["end"]), entry))
                .otherwise(state))

    return F.aggregate(F.transform(edges, read), start, step, lambda state: F.element_at(state, -1)["path"])


def _fold_ranges(ranges: Column, state: Column, fold, near: str) -> Column:
    """Fold each range from the state the one before left, and string together what each range gives as ``near``.

    A state is copied at every step, so what was gathered in earlier ranges stays outside of the state that goes
    through a range: ``fold(state, range)`` returns the next state, whose ``near`` is taken out.
    """
    far = F.array().cast("array<array<bigint>>")

    def step(held: Column, part: Column) -> Column:
        # A transform over one item names the range's result, which is used twice.
        return F.get(F.transform(F.array(fold(held["state"], part)), lambda s: F.struct(
            s.alias("state"), F.concat(held["far"], F.array(s[near])).alias("far"))), F.lit(0))

    return F.aggregate(ranges, F.struct(state.alias("state"), far.alias("far")), step, lambda held: F.flatten(held["far"]))


def _viterbi_long(ranges: Column, longest: int) -> Column:
    """For a word of many ranges, the pieces that end at each place from 1, as ``id * 64 + length``.

    Entries for all places would be copied for every edge. Here the state holds the scores of the last ``longest``
    places, the place at work, and the pieces of the best edges to the places of this range.
    """
    none = F.array().cast("array<bigint>")
    start = F.struct(F.array().cast("array<double>").alias("scores"), F.lit(0).alias("end"), F.lit(0.0).alias("score"),
                     none.alias("backs"))

    def fold(state: Column, part: Column) -> Column:
        def step(s: Column, k: Column) -> Column:
            end, length, piece = _parts_of(F.get(part["codes"], k))
            end = end + part["range"] * RANGE
            new = end != s["end"]
            scores = F.when(new, F.slice(F.concat(s["scores"], F.array(s["score"])),
                                         F.greatest(F.size(s["scores"]) + 2 - longest, F.lit(1)), F.lit(longest))
                            ).otherwise(s["scores"])
            score = F.get(scores, F.size(scores) - length) + F.get(part["scores"], k)
            better = new | (score > s["score"])
            back = F.array((piece * 64 + length).cast("bigint"))
            return F.struct(
                scores.alias("scores"), end.alias("end"), F.when(better, score).otherwise(s["score"]).alias("score"),
                F.when(new, F.concat(s["backs"], back))
                .when(better, F.concat(F.slice(s["backs"], F.lit(1), F.size(s["backs"]) - 1), back))
                .otherwise(s["backs"]).alias("backs"))

        begin = F.struct(state["scores"].alias("scores"), state["end"].alias("end"), state["score"].alias("score"), none.alias("backs"))
        return F.aggregate(F.sequence(F.lit(0), F.size(part["codes"]) - 1), begin, step)

    return _fold_ranges(ranges, start, fold, "backs")


def _walked_long(backs: Column) -> Column:
    """The path, last step first, from the pieces that ``_viterbi_long`` decided; also walked in ranges."""
    none = F.array().cast("array<bigint>")
    # Each range brings its own part of ``backs``, so that no step has to look into all of it.
    groups = F.transform(F.sequence(F.floor((F.size(backs) - 1) / RANGE).cast("int"), F.lit(0), F.lit(-1)), lambda g: F.struct(
        (g * RANGE).alias("first"), F.slice(backs, g * RANGE + 1, F.lit(RANGE)).alias("backs")))

    def fold(state: Column, group: Column) -> Column:
        def step(s: Column, k: Column) -> Column:
            place, back = group["first"] + k, F.get(group["backs"], k - 1)
            at = (place - back % 64).cast("int")
            return F.when(s["at"] == place, F.struct(at.alias("at"), F.concat(
                s["path"], F.array(_step_of(at, F.shiftright(back, 6)))).alias("path"))).otherwise(s)

        return F.aggregate(F.sequence(F.size(group["backs"]), F.lit(1), F.lit(-1)),
                           F.struct(state["at"].alias("at"), none.alias("path")), step)

    return _fold_ranges(groups, F.struct(F.size(backs).alias("at"), none.alias("path")), fold, "path")


def word_key(word: Column) -> Column:
    """What a word is grouped by: itself, or its hash if it is longer than a range.

    No other word begins with U+0000, as no piece holds that character.
    """
    return F.when(F.length(word) <= RANGE, word).otherwise(F.concat(F.lit("\0"), F.sha2(word, 256)))


def _ranges(words: DataFrame, model: Model) -> DataFrame:
    """``key`` and ``ranges`` of each word: the sorted edges that end in a range, their scores, and its own characters."""
    spark, longest = words.sparkSession, max(len(p) for p, _, _ in model.useful)
    if longest >= 1 << _LENGTH_BITS or len(model.pieces) > 1 << _ID_BITS:
        raise ValueError("pieces are too long or too many")
    table = spark.createDataFrame(pa.table({
        "piece": pa.array([p for p, _, _ in model.useful]), "id": pa.array([k for _, k, _ in model.useful], pa.int32()),
        "score": pa.array([x for _, _, x in model.useful], pa.float64())}))
    lengths: dict[str, set[int]] = {}
    for piece, _, _ in model.useful:
        lengths.setdefault(piece[:2], {1}).add(len(piece))
    begins = spark.createDataFrame(pa.table({
        "begin": pa.array(list(lengths)), "lengths": pa.array([sorted(x) for x in lengths.values()], pa.list_(pa.int32()))}))
    # Both tables are the model's: tens of thousands of short strings, whatever the corpus.
    n, first, last = F.col("n"), F.col("first"), F.col("last")
    parts = (words.select("key", F.translate("word", " ", SPACE).alias("word"), F.length("word").alias("n"))
             .withColumn("range", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / RANGE).cast("int"))))
             .withColumn("first", F.greatest(F.col("range") * RANGE - (longest - 1), F.lit(0)))
             .withColumn("last", F.least(n, (F.col("range") + 1) * RANGE))
             .select("key", "range", "first", "last", F.col("word").substr(first + 1, last - first).alias("chars")))
    places = parts.withColumn("at", F.explode(F.sequence(first, last - 1)))
    spans = (places.withColumn("begin", F.col("chars").substr(F.col("at") - first + 1, F.lit(2)))
             .join(F.broadcast(begins), "begin", "left")
             .withColumn("length", F.explode(F.coalesce("lengths", F.array(F.lit(1)))))
             .withColumn("end", F.col("at") + F.col("length") - F.col("range") * RANGE)
             .where((F.col("end") > 0) & (F.col("at") + F.col("length") <= last)))
    code = (F.shiftleft(F.col("end").cast("bigint"), _LENGTH_BITS + _ID_BITS)
            .bitwiseOR(F.shiftleft((F.lit((1 << _LENGTH_BITS) - 1) - F.col("length")).cast("bigint"), _ID_BITS))
            .bitwiseOR(F.coalesce("id", F.lit(model.unknown)).cast("bigint")))
    edges = (spans.withColumn("piece", F.col("chars").substr(F.col("at") - first + 1, F.col("length")))
             .join(F.broadcast(table), "piece", "left").where("id is not null or length = 1")
             .select("key", "range", "first", "chars", F.struct(
                 code.alias("code"), F.coalesce("score", F.lit(model.unknown_score)).alias("score")).alias("edge")))
    sorted_edges = F.sort_array(F.collect_list("edge"))
    grouped = edges.groupBy("key", "range").agg(sorted_edges.alias("edges"), F.first("chars").alias("chars"), F.first("first").alias("first"))
    own = F.col("chars").substr(F.col("range") * RANGE - F.col("first") + 1, F.lit(RANGE))
    return grouped.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("range", "edges", own.alias("chars")))).alias("ranges"))


def _encoded(words: DataFrame, model: Model) -> DataFrame:
    """``key`` and ``ids`` for the different words of ``words(key, word)``."""
    ranges, longest = F.col("ranges"), max(len(p) for p, _, _ in model.useful)
    short = F.size(ranges) == 1
    # In two arrays of numbers the edges of a long word take a third of the room.
    packed = F.transform(ranges, lambda r: F.struct(
        r["range"].alias("range"), F.transform(r["edges"], lambda e: e["code"]).alias("codes"),
        F.transform(r["edges"], lambda e: e["score"]).alias("scores")))
    decided = _ranges(words, model).select(
        "key", F.array_join("ranges.chars", "").alias("word"),
        F.when(short, _viterbi(F.get(ranges, F.lit(0))["edges"])).alias("path"),
        F.when(~short, _viterbi_long(packed, longest)).alias("backs"))
    path = decided.select("key", "word", F.coalesce("path", F.reverse(_walked_long(F.col("backs")))).alias("path"))
    mask = F.lit((1 << _ID_BITS) - 1)
    plain = F.transform("path", lambda step: step.bitwiseAND(mask).cast("int"))
    if model.first_byte < 0:
        return path.select("key", plain.alias("ids"))

    def bytes_of(step: Column) -> Column:
        char = F.encode(F.col("word").substr(F.shiftright(step, _ID_BITS).cast("int") + 1, F.lit(1)), "utf-8")
        each = F.transform(F.sequence(F.lit(1), F.octet_length(char)), lambda k: (
            F.conv(F.hex(F.substring(char, k, F.lit(1))), 16, 10).cast("int") + model.first_byte))
        piece = step.bitwiseAND(mask).cast("int")
        return F.when(piece == model.unknown, each).otherwise(F.array(piece))

    ids = F.when(F.array_contains(plain, F.lit(model.unknown)), F.flatten(F.transform("path", bytes_of))).otherwise(plain)
    return path.select("key", ids.alias("ids"))


def encode_words(words: DataFrame, model: Model) -> DataFrame:
    """``word`` and its ``ids`` for the different words of ``words(word)``, none of them empty.

    A character that no piece has becomes its bytes where the model has byte pieces, else the unknown piece.
    """
    keyed = words.select("word", word_key(F.col("word")).alias("key")).repartition("key")
    return keyed.join(_encoded(keyed, model), "key").select("word", "ids")


# --- texts ------------------------------------------------------------------------------------------------------


def _parts(batch: pa.RecordBatch, part_bytes: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Consecutive rows of about ``part_bytes``, and the bytes of their texts."""
    start = size = 0
    for row, text in enumerate(utf8(batch.column(1))):
        size += len(text)
        if size >= part_bytes:
            yield batch.slice(start, row + 1 - start), size
            start, size = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start), size


def _numbered(part: pa.RecordBatch, vocabulary: pa.Array, cutter: Cutter) -> tuple[dict, pa.Array]:
    """The texts of ``part`` as numbers into ``vocabulary``, and the words it has to be continued by."""
    words, counts = cutter.words(utf8(part.column(1)))
    coded = words.dictionary_encode()
    del words
    different, indices = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
    # Frequent words get low numbers. Byte by byte, the high ones being mostly zero, numbers take little room; so do
    # words of one frequency, in order of the alphabet.
    order = pc.sort_indices(different).to_numpy()
    order = order[np.argsort(-np.bincount(indices, minlength=len(different))[order], kind="stable")]
    known = pc.index_in(different, value_set=vocabulary)
    place = known.fill_null(-1).to_numpy().copy()
    new = order[place[order] < 0]
    place[new] = np.arange(len(vocabulary), len(vocabulary) + len(new), dtype=np.int32)
    planes = np.ascontiguousarray(place[indices].view(np.uint8).reshape(-1, 4).T)
    rows = pa.record_batch([part.column(0), part.column(1).is_null(), pa.array(counts)], names=["doc_id", "absent", "size"])
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as stream:
        stream.write_batch(rows)
    packed = pa.Codec("zstd", 9).compress(pa.py_buffer(planes), asbytes=True)
    return {"rows": sink.getvalue().to_pybytes(), "numbers": packed, "n": len(indices)}, different.take(pa.array(new))


def _in_numbers(docs: DataFrame, model: Model) -> DataFrame:
    """Blocks of documents: their number, the different words in them, and each text as numbers of its words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    block_bytes, part_bytes = BLOCK_BYTES, min(PART_BYTES, BLOCK_BYTES)
    schema = pa.schema([("block", pa.int64()), ("words", pa.list_(pa.string())), ("parts", pa.list_(pa.struct(
        [("rows", pa.binary()), ("numbers", pa.binary()), ("n", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, block = _cutter(shared.value), TaskContext.get().partitionId() << 32
        words, parts, size = pa.array([], pa.string()), [], 0

        def stored() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                pa.array([parts], schema.field("parts").type)], schema=schema)

        for batch in batches:
            for part, n_bytes in _parts(batch, part_bytes):
                numbered, new = _numbered(part, words, cutter)
                words = pa.concat_arrays([words, new])
                parts.append(numbered)
                size += n_bytes
                del numbered, new
                give_back()
                if size >= block_bytes:
                    yield stored()
                    block, words, parts, size = block + 1, words[:0], [], 0
        if parts:
            yield stored()

    return docs.mapInArrow(run, "block long, words array<string>, parts array<struct<rows: binary, numbers: binary, n: long>>")


def _slices(data: pa.Array, bounds: np.ndarray) -> Iterator[bytes]:
    """What stands between two bounds, given in items, of a binary array; one after another."""
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset:][bounds].tolist()
    view = memoryview(data.buffers()[2] or b"")
    for a, b in zip(offsets, offsets[1:], strict=False):
        yield bytes(view[a:b])


def _ids_of(left: pa.Table, right: pa.Table, model: Model | None) -> pa.Table:
    """The rows of a block with the text and ids their word numbers stand for; ``right`` has each number's ids.

    With a model the ids are decoded again, and whether that gives the text takes the place of the text.
    """
    give_back()  # what the worker's last tasks left
    order = pa.array(np.argsort(right.column("number").to_numpy()))
    ids = right.column("ids").combine_chunks().take(order)
    schema = pa.schema([("doc_id", pa.int64()), ("round_trip", pa.bool_()) if model else ("text", pa.string()), ("ids", pa.list_(ids.type.value_type))])
    words = left.column("words").combine_chunks().flatten().cast(pa.large_binary())
    out = []
    for part in left.column("parts").combine_chunks().flatten():
        part = part.as_py()
        planes = pa.decompress(part["numbers"], part["n"] * 4, codec="zstd", asbytes=True)
        numbers = pa.array(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.int32).ravel())
        del planes
        rows, at = pa.ipc.open_stream(part["rows"]).read_next_batch(), 0
        counts, absent = rows.column(2).to_numpy(), rows.column(1).to_numpy(zero_copy_only=False)
        # A few rows at a time, so that what is taken out of the vocabulary stays small.
        for first in range(0, rows.num_rows, _ROWS):
            some = slice(first, first + _ROWS)
            bounds = np.concatenate([[0], np.cumsum(counts[some])])
            own = numbers.slice(at, int(bounds[-1]))
            at += int(bounds[-1])
            found, spelt = ids.take(own), words.take(own)
            texts = pa.array([None if gone else text[1:] for gone, text in zip(absent[some], _slices(spelt, bounds), strict=True)],
                             pa.binary()).cast(pa.string())
            flat = found.flatten()
            sizes = np.diff(found.offsets.to_numpy())
            ends = np.concatenate([[0], np.cumsum(sizes)])[bounds].astype(np.int32)
            coded = pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(absent[some]))
            if model:
                texts = pa.array([a == b for a, b in zip(decode_ids(coded, model), texts.to_pylist(), strict=True)])
            out.append(pa.RecordBatch.from_arrays([rows.column(0)[some], texts, coded], schema=schema))
        del numbers, rows, part
        give_back()
    return pa.Table.from_batches(out, schema)


def encode(docs: DataFrame, model: Model, checked: bool = False) -> DataFrame:
    """``doc_id``, ``text`` and ``ids`` of every row.

    ``checked`` has the ids decoded in the tasks that encode; ``round_trip`` then takes the place of ``text`` and says
    whether they give it back, null being equal to null.

    The ids are the best-scoring segmentation of the whole text, with a space put before it as the model does; of equal
    scores the longest last piece wins. A null text has null ids, an empty one none. A very long text is one row of its
    block; a very long word, such as a run of a million spaces, has all its edges in one row, 16 bytes each. Repeated
    rows are each encoded, an empty table gives no rows, null ids are ids like others, and other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = _bucketed(_in_numbers(docs, model), "block", "numbered_texts")
    # Both branches read the same columns and so the same shuffle: the different words, and the blocks to which their
    # ids go. A word is its own key but for very long ones, which travel beside theirs.
    spelt = F.when(F.length("word") > RANGE, F.col("word"))
    words = (blocks.select("block", F.posexplode("words").alias("number", "word"))
             .select("block", "number", word_key(F.col("word")).alias("key"), spelt.alias("spelt")).repartition("key"))
    different = (words.groupBy("key").agg(F.first("spelt").alias("spelt"), F.min("block").alias("block"), F.min("number").alias("number"))
                 .where("block is not null and number is not null").select("key", F.coalesce("spelt", "key").alias("word")))
    # Spelt is null but for those few. Ids travel, and stay in the tasks, in 16 bits each where there are few enough of them.
    narrow = "array<smallint>" if len(model.pieces) <= 1 << 15 else "array<int>"
    brought = words.join(_encoded(different, model), "key").select(
        F.col("block").alias("of_block"), "number", F.col("ids").cast(narrow).alias("ids"), "spelt")
    shared = docs.sparkSession.sparkContext.broadcast(model) if checked else None

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        return _ids_of(left, right, shared.value if shared else None)

    coded = blocks.groupBy("block").cogroup(brought.groupBy("of_block")).applyInArrow(
        joined, f"doc_id long, {'round_trip boolean' if checked else 'text string'}, ids {narrow}")
    return coded.withColumn("ids", F.col("ids").cast("array<int>"))


def _bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """``df`` stored in buckets of ``key`` under the shared folder, so that a join by the key doesn't move it again."""
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, key).option("compression", "zstd")
    writer.option("path", fresh_path(spark, label)).saveAsTable(name, format="parquet")
    return spark.table(name)


def decode_ids(ids: pa.ListArray, model: Model) -> list[str | None]:
    """The texts of some lists of ids: pieces and byte pieces joined, and the space put before taken off."""
    # The offsets of a sliced array don't begin at zero.
    bounds = ids.offsets.to_numpy().astype(np.int64)
    joined = model.spelt.take(ids.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])))
    return [text.decode("utf-8", "replace").removeprefix(" ") if there else None
            for there, text in zip(ids.is_valid().to_pylist(), _slices(joined, bounds - bounds[0]), strict=True)]


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` with the text ``decoded`` from ``ids``; null ids give a null text, no ids an empty one.

    Control and unknown pieces have no text. What was encoded comes back whole, but for the model's own space
    mark (U+2581), which comes back as a space.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        texts = (decode_ids(ids.slice(k, _ROWS).cast(pa.list_(pa.int32())), shared.value) for k in range(0, len(ids), _ROWS))
        return pa.array([text for some in texts for text in some], pa.string())

    return encoded.withColumn("decoded", run("ids"))


def model_of(spark: SparkSession, setting: str = "ledgerloom.pieces.model") -> Model:
    """The model at the path the session names, or the default."""
    return load(spark.conf.get(setting, MODEL))
