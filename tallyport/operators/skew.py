"""How evenly candidate keys would spread records over the log's partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.functions.keys import log_partition


def balance(counts: DataFrame, by: list[str], partitions: int) -> DataFrame:
    """Balance figures from (group, partition, rows), empty partitions included."""
    grouped = counts.groupBy(*by).agg(
        F.sum("rows").alias("total_events"),
        F.max("rows").alias("_hot"),
        F.min("rows").alias("_cold"),
        F.count(F.lit(1)).alias("_filled"),
        F.array_sort(F.collect_list(F.struct("partition", "rows"))).alias("_filled_rows"),
    )
    empty = F.lit(partitions) - F.col("_filled")
    cold = F.when(empty > 0, F.lit(0)).otherwise(F.col("_cold"))
    ideal = F.col("total_events") / partitions
    by_partition = F.map_from_entries("_filled_rows")
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(partitions - 1)),
        lambda p: F.coalesce(F.element_at(by_partition, p), F.lit(0).cast("bigint")),
    )
    return grouped.select(
        *by,
        "total_events",
        F.array_join(dense.cast("array<string>"), ",").alias("per_partition"),
        F.round(ideal, 1).alias("ideal_per_partition"),
        F.round(F.col("_hot") / ideal, 3).alias("imbalance_ratio"),
        F.round(100 * F.col("_hot") / F.col("total_events"), 2).alias("hottest_partition_pct"),
        F.round(100 * cold / F.col("total_events"), 2).alias("coldest_partition_pct"),
        empty.cast("bigint").alias("empty_partitions"),
    )


def partition_skew(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """Balance under each candidate key, with its number of distinct keys.

    Records are counted per distinct key first, so each key is hashed once and a hot
    key reaches the shuffle as one row per map task.
    """
    stacked = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("candidate"), F.col(k).cast("string").alias("key")) for k in keys])
        ).alias("_kv")
    ).select("_kv.*")
    per_key = stacked.groupBy("candidate", "key").agg(F.count(F.lit(1)).alias("_rows"))
    counts = (
        per_key.withColumn("partition", log_partition(F.col("key"), partitions))
        .groupBy("candidate", "partition")
        .agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("_keys"))
    )
    distinct = counts.groupBy("candidate").agg(F.sum("_keys").alias("distinct_keys"))
    return balance(counts, ["candidate"], partitions).join(distinct, "candidate")


def partition_observed(log: DataFrame) -> DataFrame:
    """Records per partition as they arrived; the mean is over partitions that have any."""
    counts = log.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("rows"))
    return counts.groupBy("topic").agg(
        F.sum("rows").alias("total_events"),
        F.count(F.lit(1)).alias("partitions_seen"),
        F.max("rows").alias("hottest"),
        F.round(F.max("rows") / F.avg("rows"), 3).alias("imbalance_ratio"),
    )
