"""Near duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Two collections of m sub-bands of r minima each are kept for a set. Every pair of a
sub-band from the first and one from the second is the key of a hash table: m * m tables
of 2 * r minima each from only 2 * m * r minima, where independent tables would need
m * m * 2 * r. A pair at the threshold misses all tables with probability
1 - (1 - (1 - s**r)**m)**2, at most MISS here; m follows from the threshold.

Sets that are equal are one node, named by their smallest doc_id. Buckets of the tables are
not expanded into pairs. First its head, the node of most buckets, is compared with its bucket's
other members, on full sets; what links is drawn together to components, and nodes of one
component need no comparison. In each later round the nodes outside the head's component
whose place in the bucket, a hash of the node, is among the next ones are compared with the
rest: those of the head's component and those whose turn is to come. Components only grow,
so the place alone tells who has had a turn; nothing is noted down, and after the last place
every pair is done. Between rounds only the labels of nodes are kept, not the members of
buckets. A pair is compared only in the first bucket that both share, and only if sizes and
parities allow the similarity: slots in which the parities of two sets differ are a lower
bound on the members in which the sets differ. So every pair of a
bucket is either compared or already connected, and a group of copies costs about one
comparison a copy.

Skew: bucket statistics and pivots are grouped aggregates with partial sums, and hot keys
otherwise meet only joins, which Spark splits. Nothing is broadcast by hint or collected.

Defined results: NULL and empty texts and texts without words have no shingles, are linked
with nothing and are kept; rows without doc_id are likewise their own, with a NULL
component, and kept; for `near_duplicates` rows that repeat a doc_id are one document,
represented by the text with the smallest hash if they differ, and `keep_one` judges each
row by its own text; an empty table gives an empty result; other columns
are not read by `near_duplicates` and pass through `keep_one` untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import free_name, map_arrow, slices, stored, with_row_key
from tallyport.llm.components import components
from tallyport.llm.hashing import GOLDEN, minhashes, mix, set_hash, shingle_sets

SHINGLE = 5
PERCENT = 80
ROWS = 3  # minima in a sub-band
MISS = 4e-4
PARITY_BITS = 512
FIRST_PIVOTS, PIVOT_GROWTH = 64, 64  # places of a bucket in the second round, and times more up to each later one
PLACE = "shiftright((xxhash64(node) & 2147483647) * n, 31)"  # of a node among its bucket's n, by chance


def sub_bands(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Sub-bands of each collection so that a pair at the threshold is missed less often than `miss`."""
    one = (percent / 100) ** rows
    if one >= 1:
        return 1
    return max(1, math.ceil(math.log(miss / 2) / math.log(1 - one)))


def parity(members: np.ndarray) -> np.ndarray:
    """For each of PARITY_BITS slots whether an odd number of members falls into it, as longs.

    Two sets differ in as many members as their parities differ in slots, at least.
    """
    slots = np.bincount((members >> np.uint64(11)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS)
    return np.packbits((slots & 1).astype(np.uint8)).view(np.int64)


def _signatures(shingle: int, m: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = [t or "" for t in whole.column(1).to_pylist()]
            for a, b in slices(texts):
                sets = list(shingle_sets(texts[a:b], shingle))
                full = [i for i, s in enumerate(sets) if len(s)]
                subs: list = [None] * (b - a)
                if full:
                    low = minhashes([sets[i] for i in full], 2 * m * ROWS).reshape(len(full), 2 * m, ROWS)
                    bands = np.broadcast_to(np.arange(1, 2 * m + 1, dtype=np.uint64), (len(full), 2 * m)).copy()
                    for r in range(ROWS):
                        bands = mix(bands * GOLDEN + low[:, :, r])
                    for i, row in zip(full, bands.astype(np.int64)):
                        subs[i] = row
                names, parities = [set_hash(s) for s in sets], [parity(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        whole.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([h[0] for h in names], pa.int64()), pa.array([h[1] for h in names], pa.int64()),
                        pa.array(subs, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "subs", "parity"],
                )

    return work


def _full_sets(shingle: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts, want = whole.column(1).to_pylist(), list(zip(*(whole.column(i).to_pylist() for i in (2, 3))))
            for a, b in slices(texts):
                sets = list(shingle_sets(texts[a:b], shingle))
                right = [i for i, s in enumerate(sets) if set_hash(s) == want[a + i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        whole.column(0).take(pa.array([a + i for i in right], pa.int64())),
                        pa.array([sets[i].tobytes() for i in right], pa.binary()),
                    ],
                    names=["node", "members"],
                )

    return work


def _confirm(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                linked.append(100 * same >= percent * (len(both) - same))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(linked, pa.bool_())) for c in batch.columns[:2]], names=["node", "label"]
            )

    return work


def _held(nodes: DataFrame, m: int) -> DataFrame:
    """(node, size, parity, keys) of the nodes that share a bucket, with their buckets, one of each with equal content.

    Two nodes are compared in the first bucket they share, and the text that others were
    copied from has the most.
    """
    keys = (
        nodes.select("node", F.explode(F.slice("subs", 1, m)).alias("a"), F.slice("subs", m + 1, m).alias("b"))
        .select("node", "a", F.explode("b").alias("b"))
        .select(F.xxhash64("a", "b").alias("key"), "node")
    )
    found = keys.groupBy("key").agg(
        F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"),
        F.sum(F.shiftright(F.xxhash64("node"), 20)).alias("content"),
    ).filter("lo <> hi")
    distinct = found.groupBy("n", "lo", "hi", "content").agg(F.min("key").alias("key")).select("key")
    shared = keys.join(distinct, "key").groupBy("node").agg(F.collect_set("key").alias("keys"))
    return shared.join(nodes.select("node", "size", "parity"), "node")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of `docs` (doc_id, text)."""
    m = sub_bands(percent)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    signed = stored(
        map_arrow(slim, _signatures(shingle, m), "doc_id long, n_shingles long, h1 long, h2 long, subs array<long>, parity array<long>"),
        "signatures",
    )
    usable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    named = usable.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"))
    chosen = named.groupBy("node").agg(F.min_by(F.struct("h1", "h2"), F.struct("h1", "h2")).alias("h"))
    chosen = chosen.select("node", "h.h1", "h.h2")
    nodes = stored(
        usable.join(chosen, ["h1", "h2"])
        .filter("doc_id = node")
        .select("node", F.col("n_shingles").alias("size"), "h1", "h2", "subs", "parity")
        .dropDuplicates(["node"]),
        "nodes",
    )
    links = _links(slim, nodes, m, shingle, percent)
    named_rows = signed.drop("subs", "parity").join(named, ["h1", "h2"], "left")
    return (
        named_rows.join(links, "node", "left")
        .select(
            "doc_id", "n_shingles",
            F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id"))
            .otherwise(F.coalesce("label", "node")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _links(slim: DataFrame, nodes: DataFrame, m: int, shingle: int, percent: int) -> DataFrame:
    """(node, label) of the components that confirmed links make, without the smallest node of each."""
    held = stored(_held(nodes, m), "held")
    wanted = held.select("node").join(nodes.select("node", "h1", "h2"), "node")
    sets = stored(
        map_arrow(
            slim.join(wanted, slim.doc_id == wanted.node).select("node", F.coalesce("text", F.lit("")), "h1", "h2"),
            _full_sets(shingle), "node long, members binary",
        ),
        "sets",
    )
    differ = " + ".join(f"bit_count(parity[{i}] ^ p_parity[{i}])" for i in range(PARITY_BITS // 64))

    def confirmed(members: DataFrame, pivots: DataFrame, due: str) -> DataFrame:
        """Links of pivots with members of their buckets that are `due` and have another label."""
        pairs = (
            members.join(pivots, "key")
            .filter(
                f"node <> p_node AND label <> p_label AND {due}"
                f" AND 100 * least(size, p_size) >= {percent} * greatest(size, p_size)"
                f" AND {100 + percent} * ({differ}) <= {100 - percent} * (size + p_size)"
                " AND key = array_min(array_intersect(keys, p_keys))"
            )
            .select("node", F.col("p_node").alias("label"))
        )
        both = (
            pairs.join(sets.select("node", F.col("members").alias("x")), "node")
            .join(sets.select(F.col("node").alias("label"), F.col("members").alias("y")), "label")
            .select("node", "label", "x", "y")
        )
        return stored(map_arrow(both, _confirm(percent), "node long, label long"), "links")

    pivot = [F.col(c).alias(f"p_{c}") for c in ("node", "label", "size", "keys", "parity")]
    # Every node is its own label at first, and the heaviest of each bucket the pivot.
    now = held.withColumn("label", F.col("node"))
    heads = stored(
        held.select("node", F.size("keys").alias("weight"), F.explode("keys").alias("key")).groupBy("key")
        .agg(F.max(F.struct("weight", "node")).alias("head"), F.count("*").alias("n"))
        .select("key", F.col("head.node").alias("head"), "n"),
        "heads",
    )
    first = heads.select("key", F.col("head").alias("node")).join(now, "node").select("key", *pivot)
    links = components(confirmed(_members(now), first, "true"))
    largest = heads.agg(F.max("n")).first()[0] or 0
    low, high = 0, FIRST_PIVOTS
    while largest > 2:
        now = held.join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
        ruled = heads.join(links.withColumnsRenamed({"node": "head", "label": "ruling"}), "head", "left")
        ruled = ruled.withColumn("ruling", F.coalesce("ruling", "head"))
        turns = (
            _members(now.select("node", "label", "keys")).drop("keys").join(ruled, "key")
            .filter(f"label <> ruling AND {PLACE} >= {low} AND {PLACE} < {high}")
            .select("key", "node", "n", "head", "ruling")
        )
        pivots = turns.join(now, "node").select("key", "n", "head", "ruling", *pivot)
        due = f"node <> head AND (label = ruling OR {PLACE} >= {high} OR {PLACE} >= {low} AND node < p_node)"
        fresh = confirmed(_members(now), pivots, due)
        if not fresh.isEmpty():
            links = components(links.unionByName(fresh))
        if high >= largest:
            break
        low, high = high, high * PIVOT_GROWTH
    return links


def _members(nodes: DataFrame) -> DataFrame:
    """One row for each bucket of a node."""
    return nodes.withColumn("key", F.explode("keys"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`docs` with one row of each near-duplicate group, of its smallest doc_id; all columns stay.

    Rows are judged by their own text: of rows that repeat a doc_id and a text one stays,
    and a doc_id's other texts stand for themselves. Rows without doc_id are kept.
    """
    key = free_name(docs.columns, "row_key")
    rows = with_row_key(docs, key)
    known = rows.filter("doc_id IS NOT NULL")
    found = near_duplicates(known.select(F.col(key).alias("doc_id"), "text"), shingle, percent)
    named = known.select(F.col(key).alias("_row"), F.col("doc_id").alias("_id"), F.sha2("text", 256).alias("_text"))
    # Texts without shingles have no group: only a row's exact copies are one with it.
    alone = F.col("n_shingles") == 0
    groups = stored(
        found.join(named, found.doc_id == named["_row"]).select(
            "_row", "_id", F.when(~alone, F.col("component_id")).alias("_group"),
            F.when(alone, F.struct("_id", "_text")).alias("_same"),
        ),
        "groups",
    )
    stays = groups.groupBy("_group", "_same").agg(F.min(F.struct("_id", "_row")).alias("m")).select(F.col("m._row").alias("_row"))
    gone = groups.join(stays, "_row", "left_anti").select("_row")
    return rows.join(gone, rows[key] == gone["_row"], "left_anti").drop(key)
