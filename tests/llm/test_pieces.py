import random
import resource

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from ledgerloom.llm import pieces
from ledgerloom.llm.common import give_back

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def unigram():
    """The library's own Viterbi over the same pieces and scores."""
    spec = proto.ModelProto()
    with open(pieces.MODEL, "rb") as stream:
        spec.ParseFromString(stream.read())
    spec.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    return sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())


def brute(text, model):
    """The best total score over a whole text, without cutting it into words."""
    marked = pieces.SPACE + text.replace(" ", pieces.SPACE)
    known = {p: s for p, _, s in model.words()}
    best = [0.0] + [float("-inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        for start in range(max(0, end - model.longest), end):
            score = known.get(marked[start:end], model.unknown_score if end - start == 1 else float("-inf"))
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def score(ids, model):
    low, total, k = model.first_byte, 0.0, 0
    while k < len(ids):
        if model.normal[ids[k]]:
            total, k = total + model.scores[ids[k]], k + 1
        else:  # an unknown character: its UTF-8 bytes
            lead = ids[k] - low
            total, k = total + model.unknown_score, k + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
    return total


TEXTS = ["Hello world, this is a test.", "  two  spaces\n\ttab ", "übergröße naïve 東京 \U0001f600 end", "", " ", "x", "a" * 3000,
         "Die Würde des Menschen ist unantastbar.", "https://example.org/a?b=c&d=e#f", "\x00\x01 control", "ſ́combining"]


def test_best_scores_and_round_trip(spark, model):
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choices("abet nios.,é\n", k=rng.randint(1, 200))) for _ in range(60)]
    docs = spark.createDataFrame([*enumerate(texts), (-1, None)], SCHEMA)
    checked = pieces.encode(docs, model, checked=True).collect()
    assert all(r.round_trip for r in checked) and {r.doc_id for r in checked if r.ids is None} == {-1}
    coded = pieces.decode(pieces.encode(docs, model).where("text is not null"), model).collect()
    assert {r.doc_id: r.ids for r in checked if r.ids is not None} == {r.doc_id: r.ids for r in coded}
    assert {r.doc_id: r.decoded for r in coded} == dict(enumerate(texts))
    for row in coded:
        assert not row.text or score(row.ids, model) == brute(row.text, model)


def test_words_as_the_library_has_them(spark, model, unigram):
    """Short words, where the library's single-precision sums are exact."""
    rng = random.Random(9)
    words = {"".join(rng.choices("aeinorst", k=rng.randint(1, 12))) for _ in range(400)}
    df = spark.createDataFrame([(pieces.SPACE + w,) for w in words], "word string")
    assert {r.word[1:]: r.ids for r in pieces.encode_words(df, model).collect()} == {w: unigram.encode(w) for w in words}


def test_a_text_that_does_not_come_back_is_told(spark, model):
    """The model spells U+2581 and the space alike."""
    docs = spark.createDataFrame([(1, "a b"), (2, f"a{pieces.SPACE}b")], SCHEMA)
    assert {r.doc_id: r.round_trip for r in pieces.encode(docs, model, checked=True).collect()} == {1: True, 2: False}


def test_freed_memory_goes_back_to_the_system():
    """Small pieces freed below one in use stay with the process until they are given back."""
    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize()

    held = [bytes(2_000) for _ in range(60_000)]
    top, full = held[-1], resident()
    del held
    give_back()
    assert full - resident() > 60_000_000 and len(top) == 2_000


def test_blocks_of_any_size(spark, model, monkeypatch):
    texts = [(k, f"common words and rare{k} ones " * 3) for k in range(40)] + [(None, "null id"), (1, None), (1, None), (2, "")]
    docs = spark.createDataFrame([(*t, "extra", 0) for t in texts], "doc_id long, text string, word string, block int")
    usual = sorted(map(str, pieces.encode(docs, model).collect()))
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 100)
    monkeypatch.setattr(pieces, "_CUT_BYTES", 7)
    monkeypatch.setattr(pieces, "_ROWS", 2)
    assert sorted(map(str, pieces.encode(docs, model).collect())) == usual and len(usual) == len(texts)
    assert pieces.encode(docs.limit(0), model).count() == 0


def test_parts_of_a_block_share_its_vocabulary(spark, model, monkeypatch):
    """However small the parts that are numbered, a word stands once in its block, and texts and ids come back whole."""
    texts = [(k, f"common words and rare{k % 9} ones " * 3) for k in range(60)] + [(None, "null id"), (60, None), (61, "")]
    docs = spark.createDataFrame(texts, SCHEMA).coalesce(1)
    usual = sorted(map(str, pieces.encode(docs, model).collect()))
    monkeypatch.setattr(pieces, "PART_BYTES", 100)
    (block,) = pieces._in_numbers(docs, model).collect()
    assert len(block.parts) > 30 and len(block.words) == len(set(block.words)) < 20
    assert sorted(map(str, pieces.encode(docs, model).collect())) == usual and len(usual) == len(texts)
    checked = pieces.encode(docs, model, checked=True).collect()
    assert all(row.round_trip for row in checked) and sorted(str(row.ids) for row in checked) == sorted(
        str(row.ids) for row in pieces.encode(docs, model).collect())


@pytest.mark.parametrize("text", ["ab" * 5_000, " " * 20_000, "é" * 511 + "=" * 514 + " x", "-" * 1023, "a" * 1025])
def test_very_long_words(spark, model, text):
    row = pieces.decode(pieces.encode(spark.createDataFrame([(1, text)], SCHEMA), model), model).first()
    assert row.decoded == text and score(row.ids, model) == brute(text, model)


def test_ranges_give_what_whole_words_give(spark, model, monkeypatch):
    rng = random.Random(12)
    words = ["".join(rng.choices("aeinorst-= ", k=rng.randint(1, 60))) for _ in range(120)]
    df = spark.createDataFrame([(w,) for w in set(words)], "word string")
    whole = {r.word: r.ids for r in pieces.encode_words(df, model).collect()}
    monkeypatch.setattr(pieces, "RANGE", 7)
    assert {r.word: r.ids for r in pieces.encode_words(df, model).collect()} == whole


def test_pieces_left_out_are_never_best(model):
    """Any text of theirs is spelt better by shorter pieces, and all characters stay."""
    useful = {p for p, _, _ in model.useful}
    left = [w for w in model.words() if w[0] not in useful]
    known = {p: s for p, _, s in model.useful}
    assert len(left) > 10_000 and {p for p, _, _ in model.words() if len(p) == 1} <= useful
    for piece, _, own in random.Random(2).sample(left, 300):
        best = [0.0] + [float("-inf")] * len(piece)
        for end in range(1, len(piece) + 1):
            best[end] = max(best[start] + known.get(piece[start:end], float("-inf")) for start in range(end))
        assert best[-1] > own
