import random

import numpy as np
import pytest

from tallyport.llm import qgram_filter as Q


def plain(text):
    return " ".join("".join(c.lower() if "A" <= c <= "Z" else c for c in text).split(" "))


def edits_within(item, text):
    """Fewest edits that make some stretch of text the item, by the full table."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        for j in range(1, len(text) + 1):
            new[j] = min(row[j - 1] + (text[j - 1] != c), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + "z" + text[at + 1 :], text[:at] + "q" + text[at:]])
    return text


@pytest.fixture(scope="module")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 8))) for _ in range(60)]


def test_against_full_alignment(words):
    rng = random.Random(5)
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, make(rng.randint(6, 16))) for i in range(6)]
    texts = []
    for _ in range(60):
        item = rng.choice(items)[1]
        texts.append(make(rng.randint(0, 12)) + " " + edited(rng, item, rng.randint(0, 8)) + " " + make(rng.randint(0, 12)))
    index = Q.build_index(items)
    got = {(a, b): e for a, b, e in Q.find(index, texts)}
    want = {}
    for a, text in enumerate(texts):
        for (b, item), budget in zip(items, index.budget):
            edits = edits_within(plain(item), plain(" ".join(text.split())))
            if edits <= budget:
                want[a, b] = edits
    assert got == want
    assert len(want) > 15


def test_normal_form():
    text = "".join(map(chr, Q.normalise("  The\n\tQUICK  Ärger \n")))
    assert text == "the quick Ärger"


@pytest.mark.parametrize("q", [1, 2, 3, 5, 8, 12, 13])
def test_gram_hashes_tell_grams_apart(q):
    rng = random.Random(q)
    c = np.array([rng.choice([97, 98, 300]) for _ in range(400)], np.uint32)
    grams = [tuple(c[i : i + q]) for i in range(len(c) - q + 1)]
    hashes = Q.gram_hashes(c, q).tolist()
    assert len(hashes) == len(grams)
    assert len(set(zip(grams, hashes))) == len(set(grams)) == len(set(hashes))


def test_tables(spark, words):
    rng = random.Random(8)
    item = " ".join(rng.choice(words) for _ in range(15))
    docs = spark.createDataFrame(
        [(1, f"x {item.upper()} y", "a"), (1, f"x {item} y", "a"), (2, None, "b"), (3, "", "c"), (4, "other text", "d"),
         (None, item, "e"), (5, ("w " * 60_000) + item, "f")],
        "doc_id long, text string, item_id string",
    )
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (10, "short"), (None, item)], "item_id long, text string")
    got = sorted((r.doc_id or -1, r.item_id, r.edits) for r in Q.matches(docs, bench).collect())
    assert got == sorted((d, i, 0) for d in (1, 1, 5, -1) for i in (7, 8))
    left = Q.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 2, 3, 4]
    assert Q.matches(docs.limit(0), bench).count() == 0
    assert Q.matches(docs, bench.limit(0)).count() == 0


def test_a_clean_text_stays_beside_its_namesake(spark, words):
    rng = random.Random(12)
    item = " ".join(rng.choice(words) for _ in range(15))
    docs = spark.createDataFrame([(1, f"x {item} y"), (1, "clean"), (2, "clean")], "doc_id long, text string")
    left = Q.decontaminate(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert sorted(map(tuple, left.collect())) == [(1, "clean"), (2, "clean")]


def test_blocks_find_the_same(spark, words, monkeypatch):
    rng = random.Random(9)
    items = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(9)]
    docs = spark.createDataFrame([(i, f"a b {t} c") for i, t in enumerate(items)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = sorted(map(tuple, Q.matches(docs, bench).collect()))
    monkeypatch.setattr(Q, "BLOCK_CHARS", 100)
    assert sorted(map(tuple, Q.matches(docs, bench).collect())) == whole
    assert len(whole) >= 9
