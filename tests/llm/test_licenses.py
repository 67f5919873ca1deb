import random
import re

from ledgerloom.llm import licenses

SCHEMA = "doc_id long, text string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, templates):
    half, out = licenses.BLOCK_WORDS // 2, {}
    for doc_id, text in docs:
        w = words(text)
        places = sorted((k, label) for phrase, label in licenses.BASE_PHRASES.items() for k in range(len(w))
                        if w[k:k + len(phrase.split())] == phrase.split())
        matched = {}
        for start in range(0, max(len(w), 1), half):
            block = set(w[start:start + licenses.BLOCK_WORDS])
            for label, template in templates.items():
                t = set(words(template))
                share = len(t & block) / len(t)
                if len(t & block) >= licenses._need(len(t), licenses.CONTAINMENT):
                    matched[label] = max(matched.get(label, 0), share)
        base = {label for _, label in places}
        score = 1.0 if places else max(matched.values(), default=0.0)
        out[doc_id] = (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                       ",".join(sorted(base)), ",".join(sorted(base | set(matched))), score)
    return out


def corpus():
    rng = random.Random(6)
    filler = ["the", "of", "license", "under", "Version", "2", "é", "x1", "permission", "software", "any"]
    docs = []
    for k in range(120):
        text = rng.choices(filler, k=rng.randint(0, 200))
        if k % 2:
            notice = rng.choice(list(licenses.TEMPLATES.values())).split()
            if k % 4 == 1:
                del notice[rng.randrange(len(notice))]
            text[len(text) // 2:len(text) // 2] = notice
        if k % 5 == 0:
            text += rng.choice(["CC-BY", "cc\nby", "All rights, reserved.", "General Public License"]).split(" ")
        docs.append((k, rng.choice([" ", "\n", ", "]).join(text)))
    return docs


def test_against_brute_force(spark):
    docs = corpus()
    got, _ = licenses.scan(spark.createDataFrame(docs, SCHEMA))
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
            for r in got.collect()} == {k: (*v[:6], round(v[6], 9)) for k, v in brute(docs, licenses.TEMPLATES).items()}


def test_edges(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 1), (3, "accès by cc by", "a", 1), (3, "accès by cc by", "a", 1),
            (None, "Released under the MIT License.", "a", 1), (4, "word " * 100_000 + "all rights reserved", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, block int")
    got, matches = licenses.scan(docs)
    found = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.base_labels, r.labels) for r in got.collect()), key=str)
    assert found == sorted([(1, 0, 0, None, "", ""), (2, 0, 0, None, "", ""), (3, 4, 1, 2, "cc-by", "cc-by"),
                            (3, 4, 1, 2, "cc-by", "cc-by"), (None, 5, 0, None, "", "mit"),
                            (4, 100_003, 1, 100_000, "reserved", "reserved")], key=str)
    assert [(r.doc_id, r.template, r.overlap) for r in matches.collect()] == [(None, "mit", 5)]
    assert licenses.scan(docs.limit(0))[0].count() == 0


def test_long_templates_are_found_wherever_they_stand(spark):
    templates = {"short": "Released under the MIT License"}
    templates |= {f"long{n}": " ".join(f"t{n}x{k}" for k in range(n)) for n in (64, 65, 100, 128, 300)}
    rows, expected = [], set()
    for label, text in templates.items():
        for at in (0, 1, 33, 63, 64, 100, 127, 500, 599):
            expected.add((len(rows), label))
            rows.append((len(rows), "f " * at + text + " f" * 40))
    # The words of the short notice spread over a block of the long templates are no match.
    rows.append((len(rows), " ".join(w + " f" * 80 for w in templates["short"].split()) + " " + templates["long300"]))
    expected.add((len(rows) - 1, "long300"))
    _, matches = licenses.scan(spark.createDataFrame(rows, SCHEMA), templates)
    found = {(r.doc_id, r.template, r.containment) for r in matches.collect()}
    assert {(doc_id, label) for doc_id, label, share in found} == expected
    assert expected == {(doc_id, label) for doc_id, label, share in found if share == 1}


def test_many_hits_in_one_text(spark):
    """Five megabytes of one phrase: a hit costs the same wherever it stands."""
    n = 5_000_000 // 6
    row = licenses.scan(spark.createDataFrame([(1, "cc by " * n)], SCHEMA))[0].first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (2 * n, n, 0, 2 * n - 2)
