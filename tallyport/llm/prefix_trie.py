"""Trie of conversation prefixes, by adaptive radix trees over turn ids.

A turn id has a fixed width: 16 bytes of the sha256 of role and text, and the text's length
in code points, big-endian. A conversation's key is its turn ids one after the other, cut
into blocks of BLOCK turns, so no key grows with its conversation. What stands before a block
is known by four running sums of hashes of (turn id, depth), which are added up over ranges
of blocks. Every task puts its blocks into one adaptive radix tree for each such beginning
(`tallyport.llm.art`) and emits what the tree holds at turn-aligned byte depths only; equal
nodes of different tasks are then added up by their key. So a first turn that a third of all
conversations share is one row a task, and not one group.

Sums over subtrees need no rounds. The nodes whose smallest member is conversation c form one
path; its last node is where c ends. The tokens saved on that path, and whether it ends in a
leaf, are weights of c. A second pass of the trees adds them up over each node's members,
which is right but for the part of the node's own path above it: a running sum over the path.

Defined results: rows without conv_id belong to no conversation; a NULL role or text is the
empty one; a NULL turn comes first; rows of equal turn are ordered by their turn id, and each
counts; a conversation that is left without turns belongs to the root only; conversations are
rebuilt from c - c % 100 with the sign of c, as `%` has it; an empty table gives no rows;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.functions.ranges import running_before
from tallyport.llm.art import Tree
from tallyport.llm.common import map_arrow, stored

BLOCK = 64
WIDTH = 20
# Bytes of keys that are held in trees at once.
HELD_BYTES = 16_000_000
# Bytes of joined ids in one piece of an end list.
PIECE = 1 << 16
SUMS = ("s0", "s1", "s2", "s3")
BEFORE = ("b0", "b1", "b2", "b3")


def node_key(depth: int, sums: tuple[int, ...]) -> bytes:
    return hashlib.sha256(struct.pack(">5q", depth, *sums)).digest()[:16]


ROOT = node_key(0, (0, 0, 0, 0))


def node_key_column(depth: Column, sums: list[Column]) -> Column:
    """`node_key` on columns."""
    words = [F.unhex(F.lpad(F.hex(c.cast("long")), 16, "0")) for c in (depth, *sums)]
    return F.unhex(F.substring(F.sha2(F.concat(*words), 256), 1, 32))


def turn_sums(turn_id: bytes, depth: int) -> tuple[int, ...]:
    """Four 32-bit numbers that stand for a turn at a depth."""
    return struct.unpack(">4I", hashlib.sha256(turn_id + struct.pack(">q", depth)).digest()[:16])


def turn_sum_columns(turn_id: Column, depth: Column) -> list[Column]:
    """`turn_sums` on columns."""
    digest = F.sha2(F.concat(turn_id, F.unhex(F.lpad(F.hex(depth), 16, "0"))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, row, id) of every turn, stored."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    length = F.unhex(F.lpad(F.hex(F.char_length(text)), 8, "0"))
    return stored(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            F.monotonically_increasing_id().alias("row"),
            F.concat(F.unhex(F.substring(F.sha2(told, 256), 1, 32)), length).alias("id"),
        ),
        "turns",
    )


def positioned(turns: DataFrame) -> DataFrame:
    """(conv_id, id, position from 1): running counts, so a long conversation is not one task's."""
    rows = running_before(turns, ["conv_id"], ["turn", "id", "row"], {"before": F.lit(1)})
    return stored(rows.select("conv_id", "id", (F.col("before") + 1).alias("position")), "positions")


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others: their turns (conv_id, depth, id), and all conversations.

    Conversation c takes its first crc32(c) % `most` turns from c - c % `every`, then goes
    on with its own turns after as many.
    """
    rows = positioned(turns)
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("own")).select(
        "conv_id", "own", (F.crc32(F.col("conv_id").cast("string")) % most).alias("taken"),
        (F.col("conv_id") - F.col("conv_id") % every).alias("donor"),
    )
    heads = rows.where(F.col("position") < most).select(F.col("conv_id").alias("donor"), "position", "id")
    had = convs.where(F.col("conv_id") == F.col("donor")).select("donor", F.col("own").alias("there"))
    found = convs.join(had, "donor", "left").withColumn("got", F.least("taken", F.coalesce("there", F.lit(0))))
    taken = found.join(heads, "donor").where("position <= got").select("conv_id", F.col("position").alias("depth"), "id")
    kept = rows.join(found.select("conv_id", "taken", "got"), "conv_id").where("position > taken").select(
        "conv_id", (F.col("position") - F.col("taken") + F.col("got")).alias("depth"), "id"
    )
    return taken.unionByName(kept), convs.select("conv_id")


def blocks_of(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """Turns (conv_id, depth, id) in blocks: turn ids in order, their sums and those before the block; stored."""
    number = F.expr(f"(depth - 1) div {size}").alias("block")
    rows = turns.select("conv_id", number, "depth", "id", *[c.alias(n) for n, c in zip(SUMS, turn_sum_columns(F.col("id"), F.col("depth")))])
    blocks = rows.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("depth", "id"))).alias("turns"), F.count("*").alias("n"),
        *[F.sum(n).alias(n) for n in SUMS],
    )
    blocks = blocks.select("conv_id", "block", F.col("turns.id").alias("ids"), "n", *SUMS)
    return stored(running_before(blocks, ["conv_id"], ["block"], {b: F.col(s) for b, s in zip(BEFORE, SUMS)}), "blocks")


def _grown(trees: dict, size: int) -> Iterator[tuple]:
    """(node, parent, depth, chars, a, b) of every node of the trees."""
    for (block, *sums), tree in trees.items():
        ends: dict[int, tuple[int, ...]] = {}
        for number, above, before, path, (a, b) in tree.nodes():
            key, now = before + path, ends[above] if above is not None else tuple(sums)
            for at in range(len(before) // WIDTH, len(key) // WIDTH):
                depth = block * size + at + 1
                turn_id = key[at * WIDTH : (at + 1) * WIDTH]
                then = tuple(x + y for x, y in zip(now, turn_sums(turn_id, depth)))
                yield node_key(depth, then), node_key(depth - 1, now), depth, int.from_bytes(turn_id[16:], "big"), a, b
                now = then
            ends[number] = now


def nodes_of(blocks: DataFrame, first: str, second: str, first_min: bool, size: int = BLOCK, most: int = HELD_BYTES) -> DataFrame:
    """Every node with two values over its members: the minimum or sum of `first`, the sum of `second`.

    `size` is the turns of a block. A task's trees are emptied when they hold `most` bytes;
    what they emit is added up by node.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = (lambda x, y: (min(x[0], y[0]), x[1] + y[1])) if first_min else (lambda x, y: (x[0] + y[0], x[1] + y[1]))
        names = ["node", "parent", "depth", "chars", "a", "b"]
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

        def emitted(trees: dict) -> Iterator[pa.RecordBatch]:
            rows = []
            for row in _grown(trees, size):
                rows.append(row)
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        trees: dict[tuple, Tree] = {}
        held = 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for block, ids, a, b, *before in zip(*columns):
                beginning = (block, *before)
                if beginning not in trees:
                    trees[beginning] = Tree(merge)
                key = b"".join(ids)
                trees[beginning].put(key, (a, b))
                held += len(key) + 200
                if held >= most:
                    yield from emitted(trees)
                    trees, held = {}, 0
        yield from emitted(trees)

    slim = blocks.select("block", "ids", F.expr(first).cast("long").alias("a"), F.expr(second).cast("long").alias("b"), *BEFORE)
    parts = map_arrow(slim, work, "node binary, parent binary, depth long, chars long, a long, b long")
    return parts.groupBy("node", "parent", "depth", "chars").agg(
        (F.min if first_min else F.sum)("a").alias("a"), F.sum("b").alias("b")
    )


def end_hashes(ends: DataFrame, most: int = PIECE) -> DataFrame:
    """(node, ends_sha256) of ends (node, conv_id): sha256 of the ids in order, joined by commas.

    Ranges of (node, conv_id) hash the nodes that lie in them whole. The first and the last
    node of a range may go on in others: their ids leave as joined pieces, which pass through
    one hash in order, as sha256 must; it holds a piece of `most` bytes at a time, however long
    the list.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, number, ids, size, start, cut, out = None, 0, [], 0, None, False, []

        def leave(whole: bool) -> None:
            """The ids so far: as a hash if they are all of the node, else as a piece."""
            text = ",".join(ids).encode()
            out.append((node, None, None, hashlib.sha256(text).hexdigest()) if whole else (node, start, text, None))

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.binary(), pa.int64(), pa.binary(), pa.string()]
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["node", "start", "piece", "sha"])

        for batch in batches:
            for now, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if now != node or size >= most:
                    if node is not None:
                        leave(now != node and number > 1 and not cut)
                    cut = now == node
                    number += now != node
                    node, ids, size, start = now, [], 0, conv_id
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
            if len(out) >= 1000:
                yield batch_of()
        if node is not None:
            leave(False)
        yield batch_of()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            for now, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if now == node:
                    digest.update(b"," + piece)
                else:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = now, hashlib.sha256(piece)
        if node is not None:
            done.append((node, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"]
        )

    ranges = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    parts = stored(map_arrow(ranges, pieces, "node binary, start long, piece binary, sha string"), "ends")
    open_ends = parts.where("sha IS NULL").repartition("node").sortWithinPartitions("node", "start").select("node", "piece")
    return parts.where("sha IS NOT NULL").select("node", F.col("sha").alias("ends_sha256")).unionByName(
        map_arrow(open_ends, joined, "node binary, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK, held: int = HELD_BYTES, piece: int = PIECE) -> DataFrame:
    """The nodes of turns (conv_id, depth, id) of all conversations (conv_id), those without turns included."""
    blocks = blocks_of(turns, block)
    members = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    top = members.where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("chars"), "conv_id", "n_convs",
    )
    nodes = nodes_of(blocks, "conv_id", "1", True, block, held).withColumnsRenamed({"a": "conv_id", "b": "n_convs"})
    nodes = stored(nodes.unionByName(top), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    own = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(F.lit(0))
    nodes = stored(
        nodes.join(children, "node", "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "own": own}), "nodes"
    )

    # Weights of each conversation that is the smallest member of a node, added up over members.
    weights = nodes.groupBy("conv_id").agg(
        F.sum("own").alias("tokens"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf")
    ).where("tokens > 0 OR leaf > 0")
    weights = stored(weights, "weights")
    below = nodes_of(blocks.join(weights, "conv_id"), "leaf", "tokens", False, block, held).select("node", "a", "b")
    whole = weights.agg(F.sum("leaf").alias("a"), F.sum("tokens").alias("b")).select(F.lit(ROOT).alias("node"), "a", "b")
    # What the node's own path has saved above it does not belong to its subtree.
    above = running_before(nodes, ["conv_id"], ["depth"], {"above": F.col("own")})

    ends = convs.join(
        blocks.groupBy("conv_id").agg(F.sum("n").alias("length"), *[F.sum(s).alias(s) for s in SUMS]), "conv_id", "left"
    ).select("conv_id", F.coalesce(node_key_column(F.col("length"), [F.col(s) for s in SUMS]), F.lit(ROOT)).alias("node"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # All children of the root have one key: they are joined with its one row, the others by key.
    near = above.where("depth = 1").join(F.broadcast(parents.where(F.col("parent") == F.lit(ROOT)).limit(1)), "parent")
    far = above.where("depth > 1").join(parents, "parent")
    top = above.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    rows = top.unionByName(near).unionByName(far)
    return (
        rows.join(below.unionByName(whole), "node").join(end_hashes(ends, piece), "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("a").alias("n_leaves"),
            (F.col("b") - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "node", "parent",
        )
    )


def digest(conversations: DataFrame, **limits: int) -> DataFrame:
    """The query's columns for the rebuilt conversations."""
    turns, convs = rebuilt(turn_ids(conversations))
    return prefix_trie(turns, convs, **limits).drop("node", "parent")


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text of ASCII characters as DuckDB SQL."""
    byte = "list_reduce(list_prepend(xor(crc, code), [0::BIGINT for i in range(8)]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"[ascii(letter)::BIGINT for letter in string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, code: {byte}), 4294967295)"


ORACLE = f"""
WITH t AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                  length(coalesce(text, '')) AS c FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({{'k': k, 'c': c}} ORDER BY turn NULLS FIRST, k) AS own FROM t GROUP BY conv_id),
h AS (SELECT conv_id, own, {_crc32('conv_id::VARCHAR')} % 6 AS h, conv_id - conv_id % 100 AS donor FROM l),
b AS (SELECT h.conv_id, coalesce(l.own[1:h.h], []) || h.own[h.h + 1:] AS turns FROM h LEFT JOIN l ON l.conv_id = h.donor),
p AS (SELECT conv_id, len(turns) AS total, turns, unnest(range(0, len(turns) + 1)) AS depth FROM b),
q AS (SELECT conv_id, depth, total, array_to_string([x.k for x in turns[1:depth]], ',') AS node,
             array_to_string([x.k for x in turns[1:depth - 1]], ',') AS parent, turns[depth].c AS c,
             [array_to_string([x.k for x in turns[1:d]], ',') for d in range(0, depth + 1)] AS up FROM p),
n AS (SELECT node, depth, any_value(parent) AS parent, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce((count(*) - 1) * any_value(c), 0) AS saved,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
      FROM q GROUP BY node, depth),
k AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.parent = n.node AND k.depth = n.depth),
s AS (SELECT top, d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
      FROM (SELECT unnest(up) AS top, unnest(range(0, depth + 1)) AS d, n_children, saved FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, m.ends_sha256
FROM m JOIN s ON s.top = m.node AND s.d = m.depth LEFT JOIN n u ON m.depth > 0 AND u.node = m.parent AND u.depth = m.depth - 1
"""
