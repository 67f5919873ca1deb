import random
import re

from ledgerloom.llm import decontaminate as d

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]


def brute(docs, items):
    """Every window of every document against every window of every item."""
    out = {}
    for doc_id, text in docs:
        dw = words(text)
        for item_id, item in items:
            iw = words(item)
            n = min(d.WINDOW, len(iw))
            if len(iw) < d.MIN_WORDS:
                continue
            need = n - (d.SUBSTITUTED if n == d.WINDOW else 0)
            best = max(((sum(a == b for a, b in zip(dw[i:i + n], iw[j:j + n], strict=True)), i)
                        for i in range(len(dw) - n + 1) for j in range(len(iw) - n + 1)), default=(0, 0), key=lambda x: x[0])
            if best[0] >= need:
                out[doc_id, item_id] = (best[0], n)
    return out


def corpus(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 9, 12, 13, 14, 20, 40])))) for k in range(30)]
    docs = []
    for doc_id in range(80):
        text = rng.choices(vocabulary, k=rng.randint(0, 60))
        if doc_id % 2:
            piece = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):
                piece[rng.randrange(len(piece))] = "changed"
            text[10:10] = piece
        docs.append((doc_id, ", ".join(text).upper()))
    return docs, items


def test_against_brute_force(spark):
    for seed in (2, 3):
        docs, items = corpus(seed)
        found = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
        assert {(r.doc_id, r.item_id): (r.equal_words, r.window) for r in found} == brute(docs, items)


def test_masks_avoid_any_two_places():
    for a in range(d.WINDOW):
        for b in range(a):
            assert any(a - at not in mask and b - at not in mask
                       for mask in d.MASKS for at in range(d.WINDOW - mask[-1]))


def test_in_blocks_as_at_once(spark, monkeypatch):
    docs, items = (spark.createDataFrame(rows, schema) for rows, schema in zip(corpus(), (DOCS, ITEMS), strict=True))
    usual = sorted(map(tuple, d.contaminated(docs, items).collect()), key=str)
    monkeypatch.setattr(d, "BLOCK_SEEDS", 100)
    assert sorted(map(tuple, d.contaminated(docs, items).collect()), key=str) == usual


def test_edges(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(1, None, "s", 0), (2, "", "s", 0), (3, "clean", "s", 0), (None, item, "s", 0), (4, "x " * 60_000 + item, "s", 1),
            (5, "clean", "s", 0), (5, "so " + item, "s", 0), (5, "clean", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, seed string, at int")
    items = spark.createDataFrame([(None, item), (7, None), (8, ""), (9, item), (9, item)], ITEMS)
    found = d.contaminated(docs, items).collect()
    assert sorted(((r.doc_id, r.item_id, r.first_word) for r in found), key=str) == sorted(
        [(doc, i, at) for doc, at in ((None, 0), (4, 60_000), (5, 1)) for i in (None, 9)], key=str)
    kept = d.decontaminate(docs, items)
    assert kept.columns == docs.columns
    # of the rows of one id only the overlapping one goes
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for r in docs.collect() if r.text in (None, "", "clean")]))
    assert d.contaminated(docs.limit(0), items).count() == 0
    assert d.decontaminate(docs, items.limit(0)).count() == len(rows)


def test_names_that_clash(spark):
    names = ["doc_id", "text", "_text_hash", "row", "seed", "words", "a.b"]
    rows = [(1, "clean text", 1, "a", 2, "b", "c"), (2, "so " + " ".join(map(str, range(20))), 3, "d", 4, "e", "f")]
    kept = d.decontaminate(spark.createDataFrame(rows, names), spark.createDataFrame([(1, " ".join(map(str, range(13))))], ITEMS))
    assert kept.columns == names and list(map(tuple, kept.collect())) == rows[:1]


def test_no_python_on_the_path(spark):
    docs, items = corpus()
    plan = d.decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert "Python" not in plan._jdf.queryExecution().toString()
