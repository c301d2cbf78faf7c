"""The scan against plain loops over every relative position."""

import random
import re
from collections import Counter

import pytest

from tallyport.llm import license_scan as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
SCHEMA = "doc_id long, text string, label string, places int, words string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def stands(seq, part):
    return any(tuple(part[i : i + len(seq)]) == seq for i in range(len(part)))


def brute_places(file, one):
    """All (start, matched) of a template, from every relative position there is."""
    found = []
    n, s = len(one.words), one.slack
    for p in range(-n - s, len(file) + s):
        same = lambda i: any(0 <= p + i + d < len(file) and file[p + i + d] == one.words[i] for d in range(-s, s + 1))
        matched = sum(map(same, range(n)))
        if matched >= one.need and all(stands(q, file[max(0, p - s) : max(0, p + n + s)]) for q in one.phrases):
            found.append((p, matched))
    groups = []
    for place in found:
        if groups and place[0] - groups[-1][-1][0] <= s:
            groups[-1].append(place)
        else:
            groups.append([place])
    best = [max(g, key=lambda x: (x[1], -x[0])) for g in groups]
    return [(max(0, p), m) for p, m in best]


def brute(text, templates=L.TEMPLATES):
    file = words(text)
    places = sorted((t, *p) for t, one in enumerate(templates) for p in brute_places(file, one))
    return file, places


def expected(text):
    file, places = brute(text)
    base = [i for q in PHRASES for i in range(len(file)) if tuple(file[i : i + len(q)]) == q]
    base_labels = {label for q, label in PHRASES.items() if stands(q, file)}
    return (
        len(file), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)),
        ",".join(sorted({L.TEMPLATES[t].label for t, _, _ in places})),
        max((m / len(L.TEMPLATES[t].words) for t, _, m in places), default=0.0),
    )


def texts():
    rng = random.Random(5)
    vocabulary = sorted({w for t in L.TEMPLATES for w in t.words}) + ["été", "x", "lorem", "12", "中文"]
    out = ["", None, " \n", "MIT LICENSE", "mit-license/Apache\x7flicense", "mit licenses", "the GNU General\n * Public\tLicense, version 3",
           "MIT License MIT License mit mit license", "ä" * 50, "Ａpache license", "license", "mit"]
    for one in L.TEMPLATES:
        whole = list(one.words)
        out.append(" ".join(whole))
        for _ in range(4):  # words left out, put in and changed
            some = [w for w in whole if rng.random() > 0.15]
            for _ in range(rng.randrange(4)):
                some.insert(rng.randrange(len(some) + 1), rng.choice(vocabulary))
            before = rng.choices(vocabulary, k=rng.randrange(30))
            out.append(" ".join(before + some + rng.choices(vocabulary, k=rng.randrange(30)) + rng.choice([[], whole])))
    return out + [" ".join(rng.choices(vocabulary, k=200)) for _ in range(20)]


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in L.digest(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)).collect()}
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == pytest.approx(expected(text)), text


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in L.digest(docs).collect()}
    for r in docs.collect():
        file = words(r.text)
        base = [i for q in PHRASES for i in range(len(file)) if tuple(file[i : i + len(q)]) == q]
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(file), len(base), min(base, default=None), max(base, default=None))


def test_rarity_counts_documents_and_changes_no_result(spark):
    docs = spark.createDataFrame([(1, "license license mit"), (2, "License apache"), (None, None), (2, "License apache")], "doc_id long, text string")
    counts, files = L.rarity(docs)
    assert files == 4 and (counts["license"], counts["mit"], counts["apache"]) == (3, 1, 2) and "gnu" not in counts
    rng = random.Random(1)
    index = L.Index(L.TEMPLATES, {w: rng.randrange(100) for t in L.TEMPLATES for w in t.words}, 100)
    for text in texts():
        file = index.read(text or "")
        assert sorted(index.places(file)) == brute(text)[1]


def test_rare_words_are_looked_up():
    index = L.Index(L.TEMPLATES, Counter({"license": 90, "mit": 3}), 100)
    held = {(t, i) for places in index.postings.values() for t, i in places}
    assert (0, 0) in held and (0, 1) not in held
    for t, one in enumerate(L.TEMPLATES):
        assert sum(1 for u, _ in held if u == t) == len(one.words) - one.need + 1


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(["word"] * 700 + ["MIT", "License"] * 400 + ["ünï"] * 50)
    index = L.Index(L.TEMPLATES)
    whole = index.read(text)
    monkeypatch.setattr(L, "PIECE", 64)
    assert index.read(text).tolist() == whole.tolist() and len(whole) == 1550
    assert len([p for p in index.places(whole) if p[0] == 0]) == 400


def test_odd_rows(spark):
    rows = [(None, "mit license", "a", 1, "b"), (1, "mit license", "a", 1, "b"), (1, "mit license", "a", 1, "b"), (2, None, None, None, None)]
    got = sorted((r.doc_id or 0, r.n_base, r.labels, r.score) for r in L.digest(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 1, "mit", 1.0), (1, 1, "mit", 1.0), (1, 1, "mit", 1.0), (2, 0, "", 0.0)]
    assert L.digest(spark.createDataFrame([], SCHEMA)).count() == 0
