"""The trie of conversation prefixes against plain dictionaries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyport.llm import art
from tallyport.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node int, parent int"


def turn_id(role, text):
    told = f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
    return hashlib.sha256(told).digest()[:16]


def brute(rows):
    """What the contract says, by dictionaries of tuples."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append(((turn is not None, turn or 0), turn_id(role, text), (role or "", text or "")))
    own = {c: [t[2] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(donor, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, convs in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(convs) - 1) * len(n[-1][1]) if n else 0
    ends = lambda n: ",".join(map(str, sorted(c for c in members[n] if built[c] == n))).encode()
    return sorted(
        (min(convs), len(n), min(members[n[:-1]]) if n else -1, len(convs), children[n], leaves[n], saved[n], hashlib.sha256(ends(n)).hexdigest())
        for n, convs in members.items()
    )


def got(spark, rows, **limits):
    df = P.digest(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA), **limits)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def test_given_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert got(spark, rows) == brute(rows)


def test_shared_beginnings_and_odd_rows(spark):
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 60), *range(200, 260), *range(505, 520), -3, -101, 10**12]:
        turns = [rng.choice(["a", "b", "", "é𝄞"]) for _ in range(rng.randrange(1, 9))]
        rows += [(c, t, rng.choice(["user", "assistant", None, ""]) if t > 1 else "user", x) for t, x in enumerate(turns)]
    rows += [(c, t, "user", "same") for c in range(1000, 1090) for t in range(3)]  # one large group of copies
    rows += [(7, None, None, None), (7, None, "user", "first"), (7, 0, "z", "tie"), (7, 0, "z", "tie"), (None, 0, "user", "lost")]
    rng.shuffle(rows)
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [1, 4, 64])
def test_long_conversations_in_blocks(spark, block):
    rows = [(300, t, "user", str(t // 40)) for t in range(150)] + [(301, t, "user", str(t // 40)) for t in range(150)]
    rows += [(302, t, "user", str(t // 40) if t < 131 else "other") for t in range(140)] + [(303, 0, "user", "0")]
    assert got(spark, rows, block=block) == brute(rows)


def test_trees_emptied_and_lists_cut(spark):
    """Results do not depend on when a task's trees are emptied or an end list is cut."""
    rows = [(c, t, "user", f"{c % 3 if t else 0}") for c in range(400) for t in range(8)]
    assert got(spark, rows, held=2000, piece=16) == brute(rows)


def test_nothing_and_turnless(spark):
    assert got(spark, []) == [] and got(spark, [(None, 1, "a", "b")]) == []
    lone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    want = [(lone, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert got(spark, [(lone, 0, "user", "x")]) == want == brute([(lone, 0, "user", "x")])


def test_columns_equal_their_plain_forms(spark):
    one = turn_id("user", "x") + (1).to_bytes(4, "big")
    df = spark.createDataFrame([(one, 77)], "id binary, depth long")
    row = df.select(*P.turn_sum_columns(F.col("id"), F.col("depth"))).first()
    assert tuple(row) == P.turn_sums(one, 77)
    keys = df.select(P.node_key_column(F.col("depth"), [F.lit(i) for i in (1, 2, 2**40, 4)])).first()
    assert bytes(keys[0]) == P.node_key(77, (1, 2, 2**40, 4))


keys = st.lists(st.lists(st.sampled_from([b"aa", b"ab", b"ba", b"\x00\xff", b"zz"]), max_size=6).map(b"".join), max_size=40)


@settings(max_examples=200, deadline=None)
@given(keys)
def test_tree(some):
    tree = art.Tree(lambda a, b: a + b)
    for key in some:
        tree.put(key, 1)
    found = {}
    for _, above, before, path, held in tree.nodes():
        assert (above is None) == (not before and not path)
        for at in range(len(before) + 1, len(before + path) + 1):
            found[(before + path)[:at]] = held
    want = Counter(key[:at] for key in some for at in range(1, len(key) + 1))
    assert found == want


def test_layouts_grow():
    for count, kind in ((4, art.Few), (5, art.Few), (16, art.Few), (17, art.Indexed), (48, art.Indexed), (49, art.Direct), (256, art.Direct)):
        tree = art.Tree(lambda a, b: a + b)
        order = list(range(count))
        random.Random(count).shuffle(order)
        for byte in order:
            tree.put(bytes([byte, 7, 7, 7]), 1)
        tree.put(bytes([order[0], 7, 9, 9]), 1)
        assert type(tree.root.children) is kind and (kind is not art.Few or tree.root.children.room == (4 if count == 4 else 16))
        paths = sorted(before + path for _, _, before, path, _ in tree.nodes())
        assert [p for p in paths if len(p) == 4] == sorted([bytes([b, 7, 7, 7]) for b in order] + [bytes([order[0], 7, 9, 9])])
        # Paths are compressed: one node a key, one where two part, and the root.
        assert len(paths) == count + 3
