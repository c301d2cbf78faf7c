"""Keyed writes on plain parquet.

A serving table is a folder of batch deltas: each micro-batch owns the folder
`write_id=<n>` and overwrites it when it is re-run, so a replayed batch changes
nothing and a batch never costs more than its own rows. Readers keep the last write
of each key over the deltas and what they were merged into (`operators.compaction`).
`upsert_partitions` is the copy-on-write form for batch tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyport.operators.compaction import read_live


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest `order` of each key.

    Spark prunes to one row per key before the shuffle, so a key with very many
    versions costs each map task one row.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def write_delta(
    df: DataFrame, path: str, write_id: int, folders: list[str] | None = None, order: list[str] | None = None
) -> None:
    """Write one batch of a serving table; re-running it replaces the same folder."""
    write_folders(df, f"{path}/write_id={write_id}", folders, order)


def write_folders(df: DataFrame, path: str, folders: list[str] | None = None, order: list[str] | None = None) -> None:
    """Overwrite `path`, split into folders by columns, in `order` inside their files.

    A folder with very many rows is shared out over several tasks.
    """
    if folders:
        columns = [F.desc(o.removesuffix(" desc")) if o.endswith(" desc") else F.col(o) for o in order or []]
        df = df.hint("rebalance", *folders).sortWithinPartitions(*folders, *columns)
    writer = df.write.mode("overwrite")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.parquet(path)


def read_latest(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """Last write per key over all live folders."""
    return latest_per_key(read_live(spark, path), keys, order)


def partial_upsert(old: DataFrame, new: DataFrame, keys: list[str], update: dict[str, Column | None]) -> DataFrame:
    """Insert unmatched rows whole; on a match replace only the `update` columns.

    A value of None takes the column from the new row, a Column is evaluated instead.
    `new` must hold each key once.
    """
    o, n = old.alias("o"), new.alias("n").withColumn("_new", F.lit(True))
    joined = o.withColumn("_old", F.lit(True)).join(n, keys, "full_outer")
    inserted = F.col("_old").isNull()
    columns = []
    for name in old.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        before = F.col(f"o.{name}")
        after = F.col(f"n.{name}") if name in new.columns else F.lit(None)
        if name in update:
            value = update[name] if update[name] is not None else after
            columns.append(F.when(F.col("_new"), value).otherwise(before).alias(name))
        else:
            columns.append(F.when(inserted, after).otherwise(before).alias(name))
    return joined.select(*columns)


def read_partial(spark: SparkSession, path: str, keys: list[str], update: list[str]) -> DataFrame:
    """A table of deltas under the rule of `partial_upsert`, resolved on reading.

    Each key has the row of its first delta with the `update` columns of its last, so
    a load writes only its own rows and never the table.
    """
    rows = spark.read.option("basePath", path).parquet(path)
    kept = [c for c in rows.columns if c not in (*keys, *update, "write_id")]
    resolved = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*kept), "write_id").alias("_first"), F.max_by(F.struct(*update), "write_id").alias("_last")
    )
    return resolved.select(*keys, "_first.*", "_last.*")


def upsert_partitions(
    spark: SparkSession, path: str, staging: str, new: DataFrame, keys: list[str], order: list[str], partition: str
) -> None:
    """Rewrite only the partitions that `new` touches, keeping the latest row per key.

    The merged partitions are written to `staging` first and swapped in from there, so
    no plan overwrites what it reads, and a crash during the swap loses nothing: the
    staged copy is complete and the swap can be repeated. `keys` must contain or
    determine `partition`.
    """
    low, high = new.agg(F.min(partition), F.max(partition)).first()
    if low is None:
        return
    current = spark.read.parquet(path).where(F.col(partition).between(low, high))
    touched = current.join(new.select(partition).distinct(), partition, "left_semi")
    merged = latest_per_key(touched.unionByName(new), keys, order)
    merged.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(staging)
    (
        spark.read.parquet(staging)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
