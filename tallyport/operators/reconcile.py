"""Reconciliation by identity: what entered against what landed.

Every record is followed by its own identity, so an event counted twice on one side
can never hide one that is missing on the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def raw_identity() -> Column:
    """Event id, or the log coordinates of a record without one."""
    coordinates = F.concat_ws("/", "_topic", F.col("_partition").cast("string"), F.col("_offset").cast("string"))
    return F.coalesce("event_id", coordinates)


def quarantine_identity() -> Column:
    coordinates = F.concat_ws(
        "/", "source_topic", F.col("source_partition").cast("string"), F.col("source_offset").cast("string")
    )
    return F.coalesce("event_id", coordinates)


def follow(parsed: DataFrame, written: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row per identity: messages, and on which sides it was seen.

    The three sides are stacked and grouped, so all are shuffled once, after partial
    aggregation.
    """
    def side(rows: DataFrame, identity: Column, messages: int, is_written: int, is_quarantined: int) -> DataFrame:
        return rows.select(
            identity.alias("identity"),
            F.lit(messages).alias("_messages"),
            F.lit(is_written).alias("_written"),
            F.lit(is_quarantined).alias("_quarantined"),
        )

    sides = (
        side(parsed, raw_identity(), 1, 0, 0)
        .unionByName(side(written, F.col("event_id"), 0, 1, 0))
        .unionByName(side(quarantined, quarantine_identity(), 0, 0, 1))
    )
    seen = sides.groupBy("identity").agg(
        F.sum("_messages").alias("messages"),
        (F.max("_written") == 1).alias("written"),
        (F.max("_quarantined") == 1).alias("quarantined"),
    )
    status = (
        F.when((F.col("messages") == 0) & F.col("quarantined") & ~F.col("written"), "never_logged")
        .when(F.col("messages") == 0, "unexpected")
        .when(F.col("written") & F.col("quarantined"), "written_and_quarantined")
        .when(F.col("written"), "written")
        .when(F.col("quarantined"), "quarantined")
        .otherwise("lost")
    )
    return seen.withColumn("status", status)


def reconcile_identity(followed: DataFrame) -> DataFrame:
    """Identities and messages per status."""
    return followed.groupBy("status").agg(
        F.count(F.lit(1)).alias("identities"), F.sum("messages").alias("messages")
    )


def lost(followed: DataFrame) -> DataFrame:
    """Each lost record by name."""
    return followed.where(F.col("status") == "lost")


def reconcile_totals(followed: DataFrame) -> DataFrame:
    """One row of totals; `unaccounted` counts identities seen on neither side."""
    logged = F.col("messages") > 0
    totals = followed.agg(
        F.sum("messages").alias("messages_persisted"),
        F.sum(F.when(logged, F.col("messages") - 1).otherwise(0)).alias("duplicates"),
        F.count_if(logged).alias("expected_distinct"),
        F.count_if(logged & F.col("written")).alias("written_distinct"),
        F.count_if(logged & F.col("quarantined")).alias("quarantined_distinct"),
        F.count_if(logged & F.col("written") & F.col("quarantined")).alias("partial_write_overlap"),
        F.count_if(F.col("status") == "lost").alias("unaccounted"),
        F.count_if(F.col("status") == "never_logged").alias("never_logged"),
    )
    return totals.withColumn(
        "silent_loss_pct",
        F.round(100 * F.col("unaccounted") / F.nullif(F.col("expected_distinct"), F.lit(0)), 4),
    )
