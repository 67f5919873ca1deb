import random
import re

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for k in range(len(w) - 2):
        windows.setdefault(tuple(w[k:k + 3]), []).append(k)
    covered = {k + d for at in windows.values() if len(at) > 1 for k in at for d in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def corpus(n=900):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgé", k=rng.randint(2, 9))) for _ in range(500)]
    rows = []
    for k in range(n):
        text = rng.choices(vocabulary, k=rng.randint(60, 400))
        for at in range(rng.randint(9, 30), len(text), 30):
            text[at] += ".\n"
        rows.append((k, " ".join(text), rng.choice(["en", "en", "de"]), "hot" if k % 3 else f"s{k % 5}"))
    return rows


def test_statistics_against_brute_force():
    rng = random.Random(1)
    texts = ["", "a", "a b", "a b c", "a b c a b c", "x x x x x", " \n\n a\na\na ", "é#ü $%\n", "a b\x85c d", "a\x1cb"]
    texts += [" ".join(rng.choices("abc", k=60)) + "\n" * rng.randint(0, 3) for _ in range(40)]
    for text in texts:
        n, chars, symbols, _, dup, repeated = quality.statistics(text.encode())
        assert (n, chars, symbols, dup, repeated) == brute(text), text


def test_outliers_go_and_clean_documents_stay(spark):
    rows = corpus()
    rng = random.Random(2)
    junk = [(10_000 + k, " ".join(f"#$%|&<>{rng.random()}#$%|" for _ in range(200)), "en", "hot") for k in range(20)]
    odd = [(20_000, None, "en", "hot"), (20_001, "few words", None, None), (20_002, "a b c " * 100, "en", "hot"),
           (20_003, rows[0][1], None, None), (20_003, rows[0][1], None, None)]
    got = quality.judged(spark.createDataFrame(rows + junk + odd, SCHEMA).withColumn("stratum", F.lit("mine"))).collect()
    kept = {}
    for r in got:
        kept.setdefault(r.doc_id, []).append(r.kept)
    assert len(got) == len(rows) + len(junk) + len(odd)
    assert sum(not kept[r[0]][0] for r in rows) == 0
    assert not any(kept[r[0]][0] for r in junk)
    assert kept[20_000] == kept[20_001] == kept[20_002] == [False] and kept[20_003] == [True, True]
    failed = {r.doc_id: r.base_failed for r in got}
    assert failed[20_000] and failed[20_001] and failed[20_002] and not failed[10_000]


def test_estimate_resists_a_fifth_of_outliers(spark):
    """Centre and spread of the clean part, where the plain ones would be far off."""
    rng = np.random.default_rng(0)
    clean = rng.normal([5, 2, 1, 0.5, 0.5], [1, 0.3, 1, 0.3, 0.3], (2000, 5))
    far = rng.normal([15, 9, 9, 5, 5], 0.2, (500, 5))
    rows = [("s", row.tolist()) for row in np.concatenate([clean, far])]
    best = quality.minimum_covariance_determinant(spark.createDataFrame(rows, "stratum string, features array<double>")).first()
    assert np.abs(np.array(best.centre) - clean.mean(axis=0)).max() < 0.15
    spread = np.sqrt(np.diag(np.linalg.inv(np.array(best.inverse).reshape(5, 5) * best.chi)))
    assert (spread > 0.6 * clean.std(axis=0)).all() and (spread < 1.7 * np.maximum(clean.std(axis=0), quality.FLOORS)).all()


def test_too_few_documents(spark):
    rows = corpus(5)
    assert {r.kept for r in quality.judged(spark.createDataFrame(rows, SCHEMA)).collect()} == {True}
    assert quality.judged(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


def test_left_over_strata_are_measured_by_the_whole_table(spark):
    def junk(at, n, lang):
        return [(at + k, " ".join(f"#$%|&<>{at + k}.{j}#$%|" for j in range(200)), lang, "hot") for k in range(n)]

    def kept(rows):
        got = quality.judged(spark.createDataFrame(rows, SCHEMA)).collect()
        assert all(r.distance is not None for r in got)
        return {r.doc_id: r.kept for r in got}

    rows = corpus()
    rare = [(5000 + k, rows[k][1], None, "rare") for k in range(20)]
    for n in (10, 250):  # left-over rows under and over the size of a stratum, the latter nearly all junk
        few = [row for k in range(n // 10) for row in junk(10_000 + 10 * k, 10, f"rare {k}")]
        found = kept(rows + rare + few)
        assert all(found[row[0]] for row in rows + rare) and not any(found[row[0]] for row in few)
    small = corpus(150)
    found = kept(small + junk(10_000, 5, "en"))
    assert all(found[row[0]] for row in small) and not any(found[10_000 + k] for k in range(5))
