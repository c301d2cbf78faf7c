"""Ordered work whose keys need not fit into one task.

Rows are dealt out in ranges of (key, order) that Spark balances by sampling. What a range
needs from the ranges before it is a summary of one row for each key and range, combined
over a window that has as many rows as a key has ranges. NULL is a key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyport.session import new_folder


def join_same(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of equal names where NULL equals NULL; the columns come from the left."""
    keys = {c: f"_right_{c}" for c in on}
    renamed = right.withColumnsRenamed(keys)
    same = [F.col(c).eqNullSafe(F.col(keys[c])) for c in on]
    return left.join(renamed, same, how).drop(*keys.values())


def in_ranges(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Adds `out`, the number of the range of `order` that a row lies in.

    Stored, as ranges are sampled: read again, every row must lie where it lay. A range
    holds rows of many small keys, or a part of a large one.
    """
    path = new_folder(df.sparkSession, "ranges")
    df.repartitionByRange(*order).withColumn(out, F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def running_before(df: DataFrame, by: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds for each of `sums` its total over the rows of the same key before this one.

    `order` must be total within a key; sums must not be NULL and are 0 on a key's first row.
    """
    rows = in_ranges(df.withColumns({f"_add_{n}": c for n, c in sums.items()}), [*by, *order], "_range")
    inside = W.partitionBy(*by, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    none = lambda c: F.coalesce(c, F.lit(0))
    carried = (
        rows.groupBy(*by, "_range")
        .agg(*[F.sum(f"_add_{n}").alias(f"_add_{n}") for n in sums])
        .select(*by, "_range", *[none(F.sum(f"_add_{n}").over(earlier)).alias(f"_carry_{n}") for n in sums])
    )
    local = rows.withColumns({n: none(F.sum(f"_add_{n}").over(inside)) for n in sums})
    return (
        join_same(local, carried, [*by, "_range"])
        .withColumns({n: F.col(n) + F.col(f"_carry_{n}") for n in sums})
        .drop("_range", *[f"_{kind}_{n}" for kind in ("add", "carry") for n in sums])
    )
