import random
import re
from collections import Counter, defaultdict

import pytest

from tallyport.llm import minhash_dedup as M
from tallyport.llm.components import components


def brute(rows, size, percent):
    """doc_id -> (set size, smallest doc_id reachable), by comparing all pairs that share a shingle."""
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        shingles = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets[doc_id] = shingles or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for s in sets[i]:
            holders[s].append(i)
        for j, same in shared.items():
            if 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_given_documents(spark, sf_dir, size, percent):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    result = M.near_duplicates(docs, size, percent)
    assert got(result) == brute(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in result.collect())


def test_large_group_with_outsiders(spark):
    """One text with many small edits: most copies link to it, some only to each other, some to nothing."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 3, 85)
    assert got(M.near_duplicates(docs, 3, 85)) == want
    assert len({c for _, c in want.values()}) > 3


def edited(n, most, seed=11):
    """One text with up to `most` edits in each of n - 1 copies."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def test_rounds_carry_nodes_not_members(spark, monkeypatch):
    """What is kept for the rounds is a row a node or a bucket, and no pair is confirmed twice."""
    kept = []
    stored = M.stored

    def noted(df, name):
        kept.append((name, out := stored(df, name)))
        return out

    monkeypatch.setattr(M, "stored", noted)
    rows = edited(160, 6)
    want = brute(rows, 3, 85)
    assert got(M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)) == want
    linked = [tuple(sorted(r)) for name, df in kept if name == "links" for r in df.select("node", "label").collect()]
    assert len(linked) == len(set(linked)) > 50
    for name, df in kept:
        if {"node", "key"} <= set(df.columns):
            assert df.count() <= len(rows), name


def test_many_short_rounds(spark, monkeypatch):
    """Places are dealt out over many rounds, and some nodes have theirs only in the last."""
    monkeypatch.setattr(M, "FIRST_PIVOTS", 1)
    monkeypatch.setattr(M, "PIVOT_GROWTH", 3)
    rows = edited(90, 8, seed=5)
    want = brute(rows, 3, 85)
    assert got(M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)) == want
    assert len({c for _, c in want.values()}) > 3


def test_odd_rows(spark):
    rows = [
        (5, "A b c D", "x"), (3, "a B C d", "x"), (5, "A b c D", "x"), (7, None, "x"), (8, "", "x"), (9, " \n\t", "x"),
        (10, "one two", "x"), (11, "ONE  TWO", "x"), (12, "one", "x"), (None, "a b c d", "x"), (13, "w " * 60_000, "x"),
        (14, "ﬁ x y z", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    result = [tuple(r) for r in M.near_duplicates(docs, 3, 85).collect()]
    assert sorted(result, key=lambda r: (r[0] is None, r[0] or 0)) == [
        (3, 2, 3, True), (5, 2, 3, False), (5, 2, 3, False), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True),
        (10, 1, 10, True), (11, 1, 10, False), (12, 1, 12, True), (13, 1, 13, True), (14, 1, 14, True),
        (None, 2, None, True),
    ]
    left = M.keep_one(docs, 3, 85)
    assert left.columns == docs.columns and left.count() == 9
    assert M.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    """Rows that repeat a kept doc_id, and rows with one doc_id and several texts."""
    rng = random.Random(3)
    one, two, three, four, five = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(5))
    near = one + " more"
    rows = [
        (1, one), (1, one), (1, one), (2, near), (3, one), (3, two), (4, three), (4, four), (5, four), (6, five), (6, five + " more"),
        (7, None), (7, None), (8, ""), (8, ""), (8, None), (9, ""), (None, one), (None, one),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = M.keep_one(docs, 3, 85)
    have = sorted(map(tuple, left.collect()), key=repr)
    six = [r for r in have if r[0] == 6]
    assert len(six) == 1 and six[0] in rows
    want = [
        (1, one), (3, two), (4, three), (4, four), (7, None), (8, ""), (8, None), (9, ""), (None, one), (None, one),
    ]
    assert sorted([*want, *six], key=repr) == have


def test_components(spark):
    rng = random.Random(2)
    links = {(max(a, b), min(a, b)) for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(220)) if a != b}
    links |= {(i + 1, i) for i in range(1000, 1040)}
    parent = {}
    top = lambda i: i if parent.get(i, i) == i else top(parent[i])
    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    want = {n: top(n) for pair in links for n in pair if top(n) != n}
    frame = spark.createDataFrame(list(links), "node long, label long")
    assert {r.node: r.label for r in components(frame).collect()} == want


def test_few_minima_make_many_tables():
    for percent in (80, 85, 95):
        m = M.sub_bands(percent)
        one = (percent / 100) ** M.ROWS
        assert 1 - (1 - (1 - one) ** m) ** 2 <= M.MISS
        assert 2 * m * M.ROWS < m * m * 2 * M.ROWS
