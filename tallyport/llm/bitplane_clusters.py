"""Centroid clustering by popcounts: vectors as bit planes, exact integer distances.

A component x becomes the integer floor(scale * x). Bit b of the 64 components of a vector,
in two's complement, is one 64-bit word: its b-th plane. A vector has as many planes as its
largest component needs; the last one is the sign and weighs minus its power of two. A dot
product is the sum over pairs of planes of weight times weight times the popcount of their
AND, so squared distances are exact. `planes` packs the table once; every round reads only
planes, and what it gathers is one sum for each cluster, component and task.

Defined results: a vector that is NULL, has not 64 components, or has one that is NULL, not
finite or beyond 2^62 when scaled is left out; rows that repeat count each, and share a
cluster; equal distances go to the smaller cluster number; a row without vec_id is assigned
like others but starts no cluster unless there are too few; rows that share a vec_id and differ
are ordered by their planes; with fewer vectors than clusters there are as many clusters as vectors;
a distance or sum that fits no long is NULL; an empty table gives no rows; other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import map_arrow, stored

WIDTH = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
MOST_BITS = 62
# Vectors that are worked on at once: what a step holds stays in the cache.
ROWS = 4096
LONG = 2**63


def weights(count: int) -> list[int]:
    """What each of `count` planes weighs; the last is the sign."""
    return [1 << b for b in range(count - 1)] + [-(1 << (count - 1))]


def plane_count(values: np.ndarray) -> np.ndarray:
    """Planes that each row of integers needs, one at least."""
    largest = (values ^ (values >> 63)).max(axis=1)
    count = np.ones(len(values), np.int64)
    for b in range(int(largest.max(initial=0)).bit_length()):
        count += largest >> b > 0
    return count


def pack(values: np.ndarray, count: int) -> np.ndarray:
    """The planes of rows of 64 integers: one unsigned word each, component k in bit k."""
    out = np.empty((len(values), count), np.uint64)
    for b in range(count):
        bits = ((values >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def unpack(planes: list[int]) -> list[int]:
    """The components of one vector of planes."""
    return [sum(w * (p >> k & 1) for w, p in zip(weights(len(planes)), planes)) for k in range(WIDTH)]


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of rows of planes with rows of planes, Python integers where 64 bits may not hold them."""
    wide = left.shape[1] + right.shape[1] > MOST_BITS - 8
    out = np.zeros((len(left), len(right)), object if wide else np.int64)
    for (i, a), (j, b) in product(enumerate(weights(left.shape[1])), enumerate(weights(right.shape[1]))):
        out += np.bitwise_count(left[:, i, None] & right[None, :, j]).astype(out.dtype) * (a * b)
    return out


def norms(planes: np.ndarray) -> np.ndarray:
    """Exact squared lengths of rows of planes."""
    count = planes.shape[1]
    out = np.zeros(len(planes), object if 2 * count > MOST_BITS - 8 else np.int64)
    for (i, a), (j, b) in product(enumerate(weights(count)), enumerate(weights(count))):
        if i <= j:
            out += np.bitwise_count(planes[:, i] & planes[:, j]).astype(out.dtype) * (a * b * (1 + (i < j)))
    return out


def column_sums(planes: np.ndarray) -> list[int]:
    """The sum of each component over rows of planes."""
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8), axis=1, bitorder="little")
    counts = bits.sum(axis=0, dtype=np.int64).reshape(planes.shape[1], WIDTH).tolist()
    return [sum(w * c[k] for w, c in zip(weights(planes.shape[1]), counts)) for k in range(WIDTH)]


@dataclass(frozen=True)
class Centroids:
    """Integer centroids with their planes; they are few, so they travel with the code."""

    components: list[list[int]]

    def __post_init__(self):
        values = np.array(self.components, np.int64).reshape(-1, WIDTH)
        object.__setattr__(self, "planes", pack(values, int(plane_count(values).max())))
        object.__setattr__(self, "norms", norms(self.planes))

    def nearest(self, planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of planes its cluster, the smaller of equally near ones, and the squared distance."""
        apart = norms(planes)[:, None] + self.norms[None, :] - 2 * dots(planes, self.planes)
        cluster = apart.argmin(axis=1)
        return cluster, apart[np.arange(len(planes)), cluster]

    def sha256(self, cluster: int) -> str:
        return hashlib.sha256(",".join(map(str, self.components[cluster])).encode()).hexdigest()


def _by_width(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and planes of the rows of a batch, rows of one width and few together."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for count in np.unique(lengths):
        places = np.flatnonzero(lengths == count)
        for at in range(0, len(places), ROWS):
            some = places[at : at + ROWS]
            yield some, column.take(pa.array(some)).flatten().to_numpy().view(np.uint64).reshape(-1, count)


def planes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, planes) of the vectors that are kept, stored: 8 bytes a plane instead of 64 floats."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), WIDTH), False)
            ids, column = batch.column(0).filter(whole), batch.column(1).filter(whole)
            for at in range(0, len(ids), ROWS):
                x = column.slice(at, ROWS).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
                with np.errstate(all="ignore"):
                    x = np.floor(x * float(scale))
                    good = (np.abs(x) < 2.0**MOST_BITS).all(axis=1)
                values, own = x[good].astype(np.int64), ids.slice(at, ROWS).filter(pa.array(good))
                counts = plane_count(values)
                for count in np.unique(counts):
                    some = counts == count
                    words = pack(values[some], int(count)).view(np.int64)
                    ends = pa.array(np.arange(0, words.size + 1, count), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [own.filter(pa.array(some)), pa.ListArray.from_arrays(ends, pa.array(words.ravel()))], names=["vec_id", "planes"]
                    )

    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return stored(map_arrow(slim, work, "vec_id long, planes array<long>"), "planes")


def first_centroids(packed: DataFrame, clusters: int = CLUSTERS, seed: int = 1) -> Centroids | None:
    """The vectors with the smallest sha256 of `seed:vec_id`, None without any vector."""
    drawn = F.coalesce(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), F.lit("none"))
    rows = packed.select("planes", drawn.alias("drawn")).orderBy("drawn", "planes").limit(clusters).collect()
    return Centroids([unpack(r["planes"]) for r in rows]) if rows else None


def moved(packed: DataFrame, now: Centroids) -> Centroids:
    """Each centroid replaced by the floor of its vectors' means; one without vectors stays."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for _, words in _by_width(batch.column(0)):
                cluster, _ = now.nearest(words)
                for c in np.unique(cluster).tolist():
                    own = words[cluster == c]
                    before = totals.get(c, [0] * (WIDTH + 1))
                    totals[c] = [a + b for a, b in zip(before, [*column_sums(own), len(own)])]
        rows = [(c, k, total) for c, sums in totals.items() for k, total in enumerate(sums)]
        kinds = pa.int32(), pa.int32(), pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["cluster", "component", "total"]
        )

    sums = map_arrow(packed.select("planes"), work, "cluster int, component int, total decimal(38,0)")
    # One row for each cluster and component, and one for the cluster's size.
    total = {(r[0], r[1]): int(r[2]) for r in sums.groupBy("cluster", "component").agg(F.sum("total").cast("string")).collect()}
    return Centroids([
        [total[c, k] // total[c, WIDTH] for k in range(WIDTH)] if (c, WIDTH) in total else own
        for c, own in enumerate(now.components)
    ])


def assigned(packed: DataFrame, now: Centroids) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, words in _by_width(batch.column(1)):
                cluster, distance = now.nearest(words)
                if distance.dtype == object:
                    distance = [d if d < LONG else None for d in distance]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(places)), pa.array(cluster.astype(np.int32)), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    return map_arrow(packed.select("vec_id", "planes"), work, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1, **columns
) -> tuple[DataFrame, Centroids | None]:
    """Every vector's cluster and distance, stored, and the centroids they were measured against."""
    packed = planes(vectors, **columns)
    now = first_centroids(packed, clusters, seed)
    for _ in range(rounds if now else 0):
        now = moved(packed, now)
    none = "CAST(NULL AS {}) AS {}".format
    if now is None:
        return packed.selectExpr("vec_id", none("INT", "cluster"), none("LONG", "distance")), None
    return stored(assigned(packed, now), "clusters"), now


def digest(vectors: DataFrame) -> DataFrame:
    """The query's columns: each vector with the sums over its cluster and over all."""
    rows, now = cluster(vectors)
    # One sum for each cluster; NULL where the cluster has a distance that fits no long.
    exact = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")).cast("string"))
    sums = {r[0]: r[1] and int(r[1]) for r in rows.groupBy("cluster").agg(exact).collect()} if now else {}
    every = None if None in sums.values() else sum(sums.values())
    fits = lambda n: F.lit(n if n is not None and n < LONG else None).cast("long")
    by_cluster = lambda made: F.get(F.array(*map(made, range(len(now.components)))), F.col("cluster")) if now else None
    return rows.select(
        "vec_id", "cluster", "distance",
        (by_cluster(lambda c: fits(sums.get(c))) if now else fits(None)).alias("cluster_inertia"),
        fits(every).alias("inertia"),
        (by_cluster(lambda c: F.lit(now.sha256(c))) if now else F.lit(None).cast("string")).alias("centroid_sha256"),
    )


def _round_sql(n: int) -> str:
    """Assignment `a<n>` to the centroids `c<n>`, and the centroids after it."""
    return f"""
d{n} AS MATERIALIZED (SELECT r, cluster, list_sum(list_transform(list_zip(e, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                      FROM v, c{n}),
a{n} AS MATERIALIZED (SELECT r, cluster, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1),
s{n} AS (SELECT cluster, i, sum(x)::HUGEINT AS s, count(*) AS n
         FROM (SELECT cluster, unnest(e) AS x, unnest(range(1, {WIDTH} + 1)) AS i FROM a{n} JOIN v USING (r)) GROUP BY ALL),
m{n} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{n} GROUP BY cluster),
c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{n} LEFT JOIN m{n} USING (cluster))"""


ORACLE = f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}),
c0 AS MATERIALIZED (SELECT (k - 1)::INTEGER AS cluster, e AS c
                    FROM (SELECT e, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), e) AS k FROM v) WHERE k <= {CLUSTERS}),
{','.join(_round_sql(n) for n in range(ROUNDS + 1))}
SELECT vec_id, cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} USING (cluster)
"""
