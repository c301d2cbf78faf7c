"""Exact quantiles per group, without gathering any group in one task.

Values are counted per distinct value, and the counts are dealt out in ranges of (group,
value) that Spark balances by sampling. A running total over a group's ranges tells which
range holds each wanted rank, and only those ranges are ordered by value. However the
values lie, a group with a third of all rows is spread over as many ranges as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyport.functions.ranges import in_ranges, join_same


def interpolated_ranks(percent: float, total: Column) -> tuple[Column, Column, Column]:
    """Lower rank, upper rank and the fraction between them."""
    position = (total - 1) * F.lit(percent / 100.0)
    low = F.floor(position)
    return low, F.ceil(position), position - low


def nearest_rank(percent: float, total: Column) -> Column:
    """Closest rank, halves to even."""
    return F.least(total - 1, F.bround((total - 1) * F.lit(percent / 100.0), 0).cast("bigint"))


def exact_quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    interpolated: dict[str, float] | None = None,
    nearest: dict[str, float] | None = None,
) -> DataFrame:
    """One row per group with the named percentiles (0 to 100) as DOUBLE; NULL is a group like any other."""
    interpolated, nearest = interpolated or {}, nearest or {}
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    counts = in_ranges(counts, [*by, "_v"], "_bin")
    over_bins = W.partitionBy(*by).orderBy("_bin")
    bins = (
        counts.groupBy(*by, "_bin")
        .agg(F.sum("_c").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(over_bins) - F.col("_rows"))
        .withColumn("_n", F.sum("_rows").over(W.partitionBy(*by)))
    )
    n = F.col("_n")
    ranks: dict[str, Column] = {}
    for name, percent in interpolated.items():
        low, high, _ = interpolated_ranks(percent, n)
        ranks[f"{name}_low"], ranks[f"{name}_high"] = low, high
    for name, percent in nearest.items():
        ranks[name] = nearest_rank(percent, n)
    wanted = F.array(
        *[F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("rank")) for name, rank in ranks.items()]
    )
    hits = bins.withColumn(
        "_wanted",
        F.filter(
            wanted,
            lambda w: (w["rank"] >= F.col("_before")) & (w["rank"] < F.col("_before") + F.col("_rows")),
        ),
    ).where(F.size("_wanted") > 0)

    within = W.partitionBy(*by, "_bin").orderBy("_v")
    found = (
        join_same(counts, hits.select(*by, "_bin", "_before", "_n", "_wanted"), [*by, "_bin"])
        .withColumn("_from", F.col("_before") + F.sum("_c").over(within) - F.col("_c"))
        .withColumn("_hit", F.explode("_wanted"))
        .where((F.col("_hit.rank") >= F.col("_from")) & (F.col("_hit.rank") < F.col("_from") + F.col("_c")))
    )
    picked = found.groupBy(*by).agg(
        F.max("_n").alias("_n"),
        *[F.max(F.when(F.col("_hit.name") == name, F.col("_v"))).alias(f"_at_{name}") for name in ranks],
    )
    columns = []
    for name, percent in interpolated.items():
        fraction = interpolated_ranks(percent, n)[2]
        low, high = F.col(f"_at_{name}_low"), F.col(f"_at_{name}_high")
        columns.append((low + (high - low) * fraction).alias(name))
    columns += [F.col(f"_at_{name}").alias(name) for name in nearest]
    return picked.select(*by, *columns)
