"""Benchmark decontamination by the q-gram lemma in diagonal bands, verified by alignment.

A stretch of text within k edits of an item of m characters shares at least
m - q + 1 - k * q of its character q-grams, and their diagonals (place in the text less
place in the item) spread over at most k. So hits are counted in bands of diagonals, 2 * w
wide and overlapping by w > k; only bands that reach the bound are aligned, inside the
band, and a document is contaminated by an item if a stretch with at most k edits exists.
k is RATE of the item's length, less where the bound would reach nothing.

Both sides are compared in lower case (A to Z) with white space collapsed. Documents are
read once and not shuffled. The benchmark is a stated query set: it is taken in blocks of
at most BLOCK_CHARS characters, each of which is collected, indexed and broadcast, so no
broadcast exceeds that size whatever the benchmark's.

Defined results: NULL and empty texts contain nothing; items shorter than 2 * q characters
are not searched (they occur by chance); equal items are each found; an item that matches
at several places gives one row with its best; documents that repeat give a row each; an
empty table on either side gives no rows; other columns are not read by `matches` and pass
through `decontaminate`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import free_name, map_arrow, slices, with_row_key
from tallyport.llm.hashing import mix

Q = 12
RATE = 0.05
BLOCK_CHARS = 4_000_000
TABLE_BITS = 23
BASE, WRAP = 0x9E3779B97F4A7C55, 1 << 64


def normalise(text: str) -> np.ndarray:
    """Code points, A to Z in lower case, runs of ASCII white space as one space, none at the ends."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (c == 32) | ((c >= 9) & (c <= 13))
    keep = ~(space & np.concatenate([[True], space[:-1]])) if len(c) else space
    c = np.where(space, 32, np.where((c >= 65) & (c <= 90), c + 32, c)).astype(np.uint32)[keep]
    return c[:-1] if len(c) and c[-1] == 32 else c


def gram_hashes(c: np.ndarray, q: int) -> np.ndarray:
    """A hash for each place at which q characters begin, by doubling."""
    if len(c) < q:
        return np.zeros(0, np.uint64)
    span, power, known = 1, BASE, c.astype(np.uint64) + np.uint64(1)
    done, total, shift = 0, None, 1
    while True:
        if q & span:
            part = known[done : done + len(c) - q + 1] * np.uint64(shift)
            total = part if total is None else total + part
            done, shift = done + span, shift * power % WRAP
        if span * 2 > q:
            return mix(total)
        known = known[:-span] + known[span:] * np.uint64(power)
        power = power * power % WRAP
        span *= 2


@dataclass
class Index:
    """q-grams of a block of items: sorted hashes, where each begins in `item` and `at`, and a filter."""

    q: int
    ids: list[int]
    items: list[np.ndarray]
    budget: np.ndarray
    bound: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    present: np.ndarray


def build_index(rows: list[tuple[int, str]], q: int = Q, rate: float = RATE) -> Index:
    known = [(i, normalise(t or "")) for i, t in rows if i is not None]
    known = [(i, c) for i, c in known if len(c) >= 2 * q]
    sizes = np.array([len(c) for _, c in known], np.int64)
    budget = np.minimum((sizes * rate).astype(np.int64), (sizes - q) // q)
    grams = [gram_hashes(c, q) for _, c in known]
    flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(known)), [len(g) for g in grams])
    at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    hashes, first = np.unique(flat[order], return_index=True)
    present = np.zeros(1 << TABLE_BITS, bool)
    present[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    return Index(
        q, [i for i, _ in known], [c for _, c in known], budget, sizes - q + 1 - budget * q,
        hashes, np.append(first, len(flat)), item[order], at[order], present,
    )


def candidates(index: Index, text: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(text number, item, first diagonal of the band) of bands that reach their item's bound.

    `text` is several normalised texts one after another, ending at `ends`.
    """
    grams = gram_hashes(text, index.q)
    where = np.flatnonzero(index.present[(grams >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
    slot = np.searchsorted(index.hashes, grams[where])
    slot[slot == len(index.hashes)] = 0
    right = index.hashes[slot] == grams[where] if len(index.hashes) else np.zeros(0, bool)
    where, slot = where[right], slot[right]
    n = index.first[slot + 1] - index.first[slot]
    if not n.sum():
        return []
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    posting = np.repeat(index.first[slot], n) + within
    where, item = np.repeat(where, n), index.item[posting]
    owner = np.searchsorted(ends, where, side="right")
    # Few hits of an item in a text, whatever their diagonals, cannot reach the bound.
    pair = owner * len(index.items) + item
    _, inverse, count = np.unique(pair, return_inverse=True, return_counts=True)
    enough = count[inverse] >= index.bound[item]
    where, item, owner, posting = where[enough], item[enough], owner[enough], posting[enough]
    if not len(where):
        return []
    diagonal = where - index.at[posting] + (1 << 20)
    width = index.budget[item] + 1
    band = diagonal // width
    both = np.concatenate([np.stack([owner, item, band], 1), np.stack([owner, item, band - 1], 1)])
    found, count = np.unique(both, axis=0, return_counts=True)
    found = found[count >= index.bound[found[:, 1]]]
    return [(int(o), int(i), int(b) * int(index.budget[i] + 1) - (1 << 20)) for o, i, b in found]


def align(item: np.ndarray, window: np.ndarray, budget: int, first: int, last: int) -> int | None:
    """Fewest edits that make a stretch of `window` the item, on diagonals first..last; None above budget.

    Row by row over the item; cell j of a row is diagonal first - budget + j.
    """
    low, high = first - budget, last + budget
    at = np.arange(low, high + 1)
    step = np.arange(len(at))
    far = budget + 1
    row = np.where((at >= 0) & (at <= len(window)), 0, far)
    for i, c in enumerate(item):
        place = at + i
        inside = (place >= 0) & (place < len(window))
        same = np.zeros(len(at), bool)
        same[inside] = window[place[inside]] == c
        down = np.append(row[1:], far) + 1
        new = np.minimum(np.where(inside, row + ~same, far), down)
        new = np.minimum(np.minimum.accumulate(new - step) + step, far)
        reach = at + i + 1
        row = np.where((reach >= 0) & (reach <= len(window)), new, far)
        if row.min() >= far:
            return None
    best = int(row.min())
    return best if best <= budget else None


def find(index: Index, texts: list[str]) -> Iterator[tuple[int, int, int]]:
    """(text number, item id, edits) for each item that a text contains."""
    coded = [normalise(t) for t in texts]
    gap = np.full(1, 0x110000, np.uint32)  # no character: grams over two texts match nothing
    ends = np.cumsum([len(c) + 1 for c in coded])
    joined = np.concatenate([x for c in coded for x in (c, gap)]) if coded else gap
    best: dict[tuple[int, int], int] = {}
    for owner, item, diagonal in candidates(index, joined, ends):
        budget, pattern, text = int(index.budget[item]), index.items[item], coded[owner]
        if best.get((owner, item)) == 0:
            continue
        begin = int(ends[owner]) - len(text) - 1
        first = diagonal - begin
        low = max(0, first - budget)
        window = text[low : first + 2 * budget + 2 + len(pattern) + budget]
        edits = 0 if _contains(window, pattern) else align(pattern, window, budget, first - low, first - low + 2 * budget + 1)
        if edits is not None:
            best[owner, item] = min(edits, best.get((owner, item), edits))
    for (owner, item), edits in sorted(best.items()):
        yield owner, index.ids[item], edits


def _contains(window: np.ndarray, pattern: np.ndarray) -> bool:
    whole, part = window.tobytes(), pattern.tobytes()
    at = whole.find(part)
    while at > 0 and at % 4:
        at = whole.find(part, at + 1)
    return at >= 0


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, edits: one row for each document and item it contains."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * total / BLOCK_CHARS)) if total > BLOCK_CHARS else 1
    schema = "doc_id long, item_id long, edits int"
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        index = build_index([(r.item_id, r.text) for r in rows], q, rate)
        if not index.items:
            continue
        shipped = spark.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                texts = [t or "" for t in whole.column(1).to_pylist()]
                for a, b in slices(texts):
                    hits = list(find(shipped.value, texts[a:b]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            whole.column(0).take(pa.array([a + h[0] for h in hits], pa.int64())),
                            pa.array([h[1] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int32()),
                        ],
                        names=["doc_id", "item_id", "edits"],
                    )

        part = map_arrow(slim, work, schema)
        found = part if blocks == 1 else found.unionByName(part)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """`docs` without the rows whose text contains an item; rows without doc_id stay."""
    key = free_name(docs.columns, "row_key")
    rows = with_row_key(docs, key)
    searched = rows.filter("doc_id IS NOT NULL").select(F.col(key).alias("doc_id"), "text")
    dirty = matches(searched, benchmark, q, rate).select(F.col("doc_id").alias("_dirty")).distinct()
    return rows.join(dirty, rows[key] == dirty["_dirty"], "left_anti").drop(key)
