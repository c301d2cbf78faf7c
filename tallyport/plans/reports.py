"""Batch reports worked out from a classified log and the attempts of its writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.operators import parse
from tallyport.operators.reconcile import raw_identity
from tallyport.operators.retry import retry_outcomes


def batch_reports(classified: DataFrame, attempts: DataFrame, run_id: Column, latency_ms: Column) -> DataFrame:
    """One report per run and batch of the log, in the shape the stream writes."""
    outcomes = retry_outcomes(attempts)
    per_event = outcomes.groupBy("event_id").agg(
        F.count_if(F.col("succeeded")).alias("_ok"),
        F.sum("retries").alias("_retries"),
        F.count_if(F.col("outcome") == "retried").alias("_retried"),
        F.count_if(F.col("outcome") == "exhausted").alias("_exhausted"),
    )
    # Records without an event id join on their coordinates: as NULL keys they would all
    # meet in one task.
    rows = (
        classified.withColumn("run_id", run_id)
        .withColumn("batch_id", F.col("batch_no"))
        .withColumn("_key", raw_identity())
    )
    route = F.col("route")
    zero = F.lit(0).cast("bigint")
    waited = F.when((route == parse.OK) & (latency_ms >= 0), latency_ms)
    total = lambda c: F.coalesce(F.sum(c), zero)
    counted = (
        rows.join(per_event.withColumnRenamed("event_id", "_key"), "_key", "left")
        .groupBy("run_id", "batch_id")
        .agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if(route == parse.UNPARSEABLE).alias("unparseable"),
            F.count_if(route == parse.INVALID).alias("invalid"),
            F.count_if(route.isin(parse.LATE, parse.DROPPED)).alias("late"),
            (F.count_if(F.col("failure_stage").isNotNull()) + F.count_if(F.col("_exhausted") > 0)).alias("dlq"),
            total("_ok").alias("rows_written"),
            total("_ok").alias("successes"),
            total("_retries").alias("retries_before_success"),
            total("_retried").alias("retried_writes"),
            total("_retries").alias("retried_writes_retries"),
            total("_exhausted").alias("failures_exhausted"),
            total(waited).alias("latency_sum_ms"),
            F.count(waited).alias("latency_count"),
            F.coalesce(F.max(waited), zero).alias("latency_max_ms"),
        )
    )
    errors = attempts.where(F.col("error").isNotNull()).groupBy("event_id", "error").agg(
        F.count(F.lit(1)).alias("_count")
    )
    reasons = (
        rows.select("run_id", "batch_id", "_key")
        .join(errors.withColumnRenamed("event_id", "_key"), "_key")
        .groupBy("run_id", "batch_id", "error")
        .agg(F.sum("_count").alias("_count"))
        .groupBy("run_id", "batch_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("error", "_count"))).alias("failure_reasons"))
    )
    return counted.join(reasons, ["run_id", "batch_id"], "left")
