import random

from ledgerloom.llm import line_dedup

SCHEMA = "doc_id long, text string"


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute(docs):
    """Every line against every earlier one; docs are (doc_id, text) with different ids."""
    seen, out = [], {}
    for doc_id, text in sorted(docs):
        lines, kept = text.split("\n"), []
        for line in lines:
            words = line.lower().split()
            if not any(c.isalnum() for c in line):
                kept.append(line)
                continue
            earlier = any(words == w or (min(len(words), len(w)) >= line_dedup.MIN_WORDS and within_one_edit(words, w))
                          for w in seen)
            if words not in seen:
                seen.append(words)
            if not earlier:
                kept.append(line)
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def corpus():
    rng = random.Random(1)
    words = [f"word{k}" for k in range(12)]
    lines = [" ".join(rng.choices(words, k=rng.choice([2, 3, 4, 5, 6, 9, 10]))) for _ in range(60)]
    docs = []
    for doc_id in range(60):
        own = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(lines).split()
            match rng.randrange(6):
                case 0:
                    line[rng.randrange(len(line))] = "changed"
                case 1:
                    line.insert(rng.randrange(len(line) + 1), rng.choice(words))
                case 2:
                    del line[rng.randrange(len(line))]
                case 3:
                    line = [w.upper() for w in line]
            own.append(rng.choice(["", " "]) + "  ".join(line))
        docs.append((doc_id, "\n".join([*own, "", "---", rng.choice(["short", "Ünd", "7", "短い行"])])))
    return docs


def test_against_brute_force(spark):
    docs = corpus()
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got} == brute(docs)


def test_looked_up_by_shuffle_as_by_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    usual = sorted(map(tuple, line_dedup.dedup_lines(docs).collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, line_dedup.dedup_lines(docs).collect())) == usual


def test_edges(spark):
    line = "a line that is long enough to count"
    rows = [(1, None, "x", 0), (2, "", "x", 0), (3, line, "x", 0), (3, line, "x", 0), (4, line + "\n\n" + line, "y", 1),
            (None, line, "z", 2), (5, line.replace("long", "short") + "\n" + "x" * 50_000, "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, n int")
    got = {(r.doc_id, r.words): (r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs).collect()}
    # a null id comes first; copies of a row lose the same lines; a long word is a line like others
    assert got == {(1, "x"): (None, None, None), (2, "x"): ("", 1, 0), (3, "x"): ("", 1, 1), (4, "y"): ("", 3, 2),
                   (None, "z"): (line, 1, 0), (5, "y"): ("x" * 50_000, 2, 1)}
    assert line_dedup.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_dropped"]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_no_python_on_the_path(spark):
    plan = line_dedup.dedup_lines(spark.createDataFrame(corpus(), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_names_that_clash(spark):
    """Columns named like the operator's own pass unchanged, but for the two counts, which only ``cleaned`` keeps."""
    names = ["doc_id", "text", "row", "lines", "kept", "dropped", "_text_hash", "_lines", "_doc_id", "a.b", "n_lines", "n_dropped"]
    rows = [(1, "one line\nanother line", *"abcdefghij"), (2, "another line\n)\nthird line", *"klmnopqrst")]
    docs = spark.createDataFrame(rows, names)
    found = line_dedup.dedup_lines(docs)
    assert found.columns == names
    assert sorted(map(tuple, found.collect())) == [
        (1, "one line\nanother line", *"abcdefgh", 2, 0), (2, ")\nthird line", *"klmnopqr", 3, 1)]
    assert sorted(map(tuple, line_dedup.cleaned(docs).select("row.*").collect())) == rows
