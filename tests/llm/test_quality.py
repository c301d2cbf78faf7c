import zlib

import numpy as np
import pytest

from tallyport.llm import quality_gam as Q
from tallyport.llm import rule_ledger as R


def test_learns_curves_and_interactions():
    rng = np.random.default_rng(0)
    x = rng.random((6000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 0] < 0.7) ^ ((x[:, 1] > 0.5) & (x[:, 2] > 0.5))).astype(float)
    model = Q.fit(x[:4000], y[:4000])
    assert ((model.probability(x[4000:]) >= 0.5) == y[4000:]).mean() > 0.93
    assert {1, 2} in [set(p) for p in model.pairs]
    alone = Q.Gam(model.base, model.edges, model.tables)
    assert np.log(model.probability(x[y == 1])).mean() > np.log(alone.probability(x[y == 1])).mean()


def test_scores_are_sums_of_bins():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    model = Q.fit(x, (x[:, 0] + x[:, 1] > 1).astype(float))
    for row in x[:20]:
        total = model.base
        for i, table in enumerate(model.tables):
            total += table[np.searchsorted(model.edges[i], row[i], side="right")]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[np.searchsorted(model.coarse[a], row[a], side="right"), np.searchsorted(model.coarse[b], row[b], side="right")]
        assert model.logit(row[None])[0] == pytest.approx(total)


@pytest.mark.parametrize("y,low,high", [([], 0.49, 0.51), ([1, 1], 0.99, 1.0), ([0, 0], 0.0, 0.01)])
def test_one_kind_of_label(y, low, high):
    model = Q.fit(np.zeros((len(y), 3)), np.array(y, float))
    assert low <= model.probability(np.zeros((1, 3)))[0] <= high


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    result = Q.digest(docs, labels)
    rows = {r.doc_id: r for r in result.collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.97


def test_labels_of_held_out_rows_change_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    spoilt = labels.selectExpr("doc_id", f"IF({Q.HOLD_OUT}, 1 - quality, quality) AS quality")
    scores = lambda lab: {r.doc_id: r.score for r in Q.digest(docs, lab).collect()}
    assert scores(labels) == scores(spoilt)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good words here", 0.1), (1, "good words here", 0.1), (2, None, 0.2), (3, "", 0.3), (None, "x", 0.4), (4, "a " * 60_000, 0.5)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 7), (None, 1)], "doc_id long, quality int")
    got = Q.digest(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert Q.digest(docs.limit(0), labels).count() == 0
    assert Q.keep_good(docs, labels.limit(0)).columns == docs.columns


def brute(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    lines, seen, dup = [x for x in text.split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_measures(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame(
        [(901, None), (902, ""), (903, " \n\n"), (904, "a b a b a b a"), (905, "x\x1cy z\n" * 3), (906, "é " * 60_000), (None, "a")],
        "doc_id long, text string",
    )
    got = {r.doc_id: tuple(r)[1:6] for r in R.digest(docs.select("doc_id", "text").unionByName(odd)).collect()}
    for r in [*docs.limit(60).collect(), *odd.filter("doc_id <> 906 OR doc_id IS NULL").collect()]:
        assert got[r.doc_id] == brute(r.text or ""), r.doc_id
    assert got[906] == (60_000, 60_000, 0, 0, 60_000)
    assert R.digest(odd.limit(0)).count() == 0


def test_policies_and_ablation(spark, sf_dir):
    rows = R.ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")).persist()
    bits = [r.bits for r in rows.collect()]
    for version, rules in R.POLICIES.items():
        mask = R.mask(rules)
        assert [r.kept for r in R.apply_policy(rows, version).collect()] == [b & mask == 0 for b in bits]
        for r in R.ablation(rows, version).collect():
            bit = 1 << R.BIT[r.rule]
            assert (r.n_failed, r.n_only_by_this) == (sum(b & bit > 0 for b in bits), sum(b & mask == bit for b in bits))
            assert r.n_rejected == sum(b & mask > 0 for b in bits)
    rows.unpersist()
