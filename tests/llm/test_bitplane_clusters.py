"""Bit planes against plain integers, and the clusters against a plain k-means."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyport.llm import bitplane_clusters as B

SCHEMA = "vec_id long, embedding array<float>, cluster string, planes int"


def brute(rows, clusters=16, rounds=3):
    """What the contract says, with Python integers."""
    kept = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    drawn = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "none"
    centroids = [v for _, v in sorted(kept, key=lambda r: drawn(r[0]))[:clusters]]
    apart = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        own = [apart(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            some = [v for (_, v), c in zip(kept, own) if c == k]
            centroids[k] = [sum(x) // len(some) for x in zip(*some)] if some else centroids[k]
    out = [(i, *apart(v)) for i, v in kept]
    inertia = {k: sum(d for _, d, c in out if c == k) for k in range(len(centroids))}
    named = lambda k: hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), named(c)) for i, d, c in out), key=str)


def got(spark, rows, schema=SCHEMA):
    df = B.digest(spark.createDataFrame([(*r, "x", 1) for r in rows], schema))
    return sorted(map(tuple, df.collect()), key=str)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.4, 64)]) for i in range(300)]
    rows += [(1000 + i, [0.25] * 64) for i in range(40)]  # one vector many times
    rows += [(2000, [0.5] * 32 + [-0.5] * 32), (2000, [0.5] * 32 + [-0.5] * 32), (None, [0.125] * 64)]
    rows += [(3000, [300.0] * 64), (3001, [-1e5] * 64)]  # other widths
    rows += [(1, None), (2, []), (3, [0.0] * 63), (4, [0.0] * 63 + [None]), (5, [0.0] * 63 + [float("nan")]), (6, [float("inf")] * 64), (7, [0.0] * 65)]
    assert got(spark, rows) == brute(rows)


def test_few_and_none(spark):
    rows = [(5, [0.1] * 64), (9, [-0.1] * 64), (7, [0.1] * 64)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == [] and got(spark, [(1, None)]) == []


def test_double_and_great_components(spark):
    rows = [(i, [float((-1) ** i * 2**35 * (k == 0) + i) for k in range(64)]) for i in range(3)]
    schema = "vec_id int, embedding array<double>, distance string, x int"
    # All three start a cluster; integers beyond 2^40 are exact, as are distances between them.
    assert [r[2] for r in got(spark, rows, schema)] == [0, 0, 0]
    assert B.planes(spark.createDataFrame([(1, [1e300] * 64)], "vec_id int, embedding array<double>")).count() == 0
    far = B.Centroids([[2**40] * 64])
    _, distance = far.nearest(B.pack(np.full((1, 64), -(2**40)), 42))
    assert distance.tolist() == [64 * (2**41) ** 2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**20), 2**20), min_size=64, max_size=64), min_size=1, max_size=5))
def test_planes(vectors):
    values = np.array(vectors, np.int64)
    count = int(B.plane_count(values).max())
    packed = B.pack(values, count)
    assert [B.unpack(p) for p in packed.tolist()] == vectors
    assert (B.dots(packed, packed) == values @ values.T).all() and (B.norms(packed) == (values**2).sum(axis=1)).all()
    assert B.column_sums(packed) == values.sum(axis=0).tolist()
    wider = B.pack(values, count + 3)  # the sign repeats, nothing changes
    assert (B.dots(wider, packed) == values @ values.T).all()


@pytest.mark.parametrize("value,count", [(0, 1), (-1, 1), (1, 2), (-2, 2), (127, 8), (128, 9), (-128, 8), (-129, 9)])
def test_width(value, count):
    assert B.plane_count(np.full((1, 64), value)).tolist() == [count]
