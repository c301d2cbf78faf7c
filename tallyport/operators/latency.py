"""Latency samples and their report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.functions.quantiles import exact_quantiles
from tallyport.functions.ranges import join_same
from tallyport.functions.timing import minute_bucket

SAMPLE_SCALE = 1_000_000
RETENTION_HOURS = 24


def sampled(event_id: Column, run_id: Column, rate: float) -> Column:
    """Deterministic sampling: the same events are chosen on every recomputation."""
    return F.pmod(F.xxhash64(event_id, run_id), F.lit(SAMPLE_SCALE)) < int(rate * SAMPLE_SCALE)


def latency_samples(df: DataFrame, run_id: Column, batch_id: Column, rate: float = 1.0) -> DataFrame:
    """Latency rows of a share of the written events; negative latencies are left out."""
    rows = df.withColumn("run_id", run_id).withColumn("batch_id", batch_id)
    if rate < 1.0:
        rows = rows.where(sampled(F.col("event_id"), F.col("run_id"), rate))
    return (
        rows.withColumn("latency_ms", F.col("written_at_ms") - F.col("produced_at_ms"))
        .where(F.col("latency_ms") >= 0)
        .select(
            "run_id",
            minute_bucket(F.col("produced_at_ms")).alias("minute_bucket"),
            "event_id",
            "produced_at_ms",
            "written_at_ms",
            "latency_ms",
            "batch_id",
        )
    )


def write_samples(samples: DataFrame, path: str, write_id: int) -> None:
    """Folder per batch, below it one per run, so a run is read without the others."""
    samples.write.mode("overwrite").partitionBy("run_id").parquet(f"{path}/write_id={write_id}")


def unexpired(samples: DataFrame, now_ms: Column) -> DataFrame:
    """Samples younger than the retention."""
    oldest = (now_ms - RETENTION_HOURS * 3_600_000) / 60000
    return samples.where(F.col("minute_bucket") >= F.floor(oldest))


def _tenths(name: str) -> Column:
    """One decimal, half up; noise behind the sixth decimal must not decide a tie."""
    return F.round(F.round(name, 6), 1)


def latency_report(samples: DataFrame, by: list[str]) -> DataFrame:
    """Exact percentiles, extremes, mean and shares under one second and half a second."""
    totals = samples.groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
        (F.sum("latency_ms") / F.count(F.lit(1))).alias("_mean"),
        F.count_if(F.col("latency_ms") < 1000).alias("_under_1s"),
        F.count_if(F.col("latency_ms") < 500).alias("_under_500"),
    )
    percentiles = exact_quantiles(
        samples, by, "latency_ms", {"p50": 50, "p90": 90, "p95": 95, "p99": 99, "p999": 99.9}
    )
    best = (
        F.when(F.col("p99") < 1000, "p99")
        .when(F.col("p95") < 1000, "p95")
        .when(F.col("p50") < 1000, "p50")
        .otherwise("none")
    )
    share = lambda part: F.round(100 * F.col(part) / F.col("samples"), 3)
    return join_same(totals, percentiles, by).select(
        *by,
        "samples",
        "min_ms",
        *[_tenths(p).alias(f"{p}_ms") for p in ("p50", "p90", "p95", "p99", "p999")],
        "max_ms",
        _tenths("_mean").alias("mean_ms"),
        best.alias("sub_second_at"),
        share("_under_1s").alias("pct_under_1s"),
        share("_under_500").alias("pct_under_500ms"),
    )
