"""Batch reports, run summaries, repeated-run statistics, sweeps, histograms, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyport.functions.quantiles import exact_quantiles
from tallyport.functions.ranges import join_same
from tallyport.functions.sequences import counter_rate, held_intervals, trailing_slope, vector_increase
from tallyport.functions.timing import time_bucket
from tallyport.operators.retry import merge_counters
from tallyport.session import small_side
from tallyport.sources.schemas import BATCH_REPORT_SCHEMA

# Upper bounds of the batch-duration and latency histograms, rule
# thresholds (lag, seconds, rates) and how long each must hold, in seconds.
DURATION_BOUNDS = [0.1, 0.25, 0.5, 1, 2, 3, 5, 8, 13, 21, 34, 60]
LATENCY_BOUNDS = [10, 25, 50, 100, 200, 350, 500, 750, 1000, 1500, 2500, 5000, 10000, 30000]
LAG_RISING_HOLD = 300
LAG_HIGH, LAG_HIGH_HOLD = 100_000, 120
BATCH_P95_SECONDS, BATCH_P95_HOLD = 10, 180
DLQ_RATE, DLQ_RATE_HOLD = 1, 300
RETRY_RATE, RETRY_RATE_HOLD = 5, 300
EXHAUSTED_HOLD = 60
PRODUCER_SHARE, PRODUCER_HOLD = 0.95, 120

REPORT_SUMS = [
    "input_rows", "unparseable", "invalid", "late", "dlq", "rows_written", "successes",
    "retries_before_success", "retried_writes", "retried_writes_retries", "failures_exhausted",
    "latency_sum_ms", "latency_count",
]


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Batch reports as JSON lines; lines that do not parse are skipped."""
    return spark.read.schema(BATCH_REPORT_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def run_summary(reports: DataFrame, by: list[str]) -> DataFrame:
    """One row per run from its batch reports."""
    flagged = reports.withColumn("batches", F.lit(1)).withColumn(
        "non_empty_batches", (F.col("input_rows") > 0).cast("int")
    )
    merged = merge_counters(
        flagged, by, REPORT_SUMS + ["batches", "non_empty_batches"], ["latency_max_ms"], "failure_reasons"
    )
    ratio = lambda part, whole, digits: F.round(
        F.col(part) / F.nullif(F.col(whole), F.lit(0)), digits
    )
    return (
        merged.withColumn("write_amplification", ratio("rows_written", "input_rows", 3))
        .withColumn(
            "avg_retries_to_success_all_writes",
            F.coalesce(ratio("retries_before_success", "successes", 5), F.lit(0.0)),
        )
        .withColumn(
            "avg_retries_among_retried_writes",
            F.coalesce(ratio("retried_writes_retries", "retried_writes", 3), F.lit(0.0)),
        )
        .withColumn("mean_e2e_latency_ms", ratio("latency_sum_ms", "latency_count", 2))
    )


def batch_duration_percentiles(reports: DataFrame, by: list[str], seconds: str) -> DataFrame:
    """Nearest-rank percentiles of the batch durations of each run, 4 decimals."""
    picked = exact_quantiles(
        reports, by, seconds, nearest={"batch_seconds_p50": 50, "batch_seconds_p95": 95, "batch_seconds_p99": 99}
    )
    return picked.select(*by, *[F.round(c, 4).alias(c) for c in picked.columns if c not in by])


def run_stats(df: DataFrame, by: list[str], value: str, ok: str) -> DataFrame:
    """Mean, median, extremes, sample deviation and geometric mean over repeated runs."""
    v = F.col(value)
    moments = df.where(v.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(v), 3).alias("mean"),
        F.round(F.min(v), 3).alias("min"),
        F.round(F.max(v), 3).alias("max"),
        F.round(F.coalesce(F.stddev_samp(v), F.lit(0.0)), 3).alias("stdev"),
        F.round(F.exp(F.avg(F.ln(F.when(v > 0, v)))), 3).alias("geometric_mean"),
        F.bool_and(ok).alias("all_ok"),
    )
    median = exact_quantiles(df, by, value, {"median": 50})
    return join_same(moments, median.withColumn("median", F.round("median", 3)), by)


def first_after(df: DataFrame, faults: DataFrame, by: list[str], ts: str, good: Column) -> DataFrame:
    """First good row after each group's fault time, and the seconds until then."""
    key = F.struct(ts, "batch_id")
    after = (
        join_same(df, small_side(faults), by)
        .where((F.col(ts) > F.col("fault_at")) & good)
        .groupBy(*by, "fault_at")
        .agg(F.min(key).alias("_first"))
    )
    seconds = (F.unix_micros(F.col(f"_first.{ts}")) - F.unix_micros("fault_at")) / 1e6
    return join_same(faults, after, [*by, "fault_at"], "left").select(
        *by,
        "fault_at",
        F.col("_first.batch_id").alias("recovery_batch_id"),
        F.round(seconds, 3).alias("recovery_seconds"),
        F.col("_first").isNotNull().alias("recovered"),
    )


def step_verdict(
    steps: DataFrame, max_drain_ratio: float = 0.25, min_attainment: float = 95, max_growth: int = 5
) -> DataFrame:
    """Whether a load step was sustained, and what speaks against it."""
    drain_ratio = F.col("drain_seconds") / F.nullif(F.col("duration_seconds"), F.lit(0))
    against = F.array(
        F.when(drain_ratio > max_drain_ratio, "slow_drain"),
        F.when(F.coalesce("attainment_pct", F.lit(0.0)) < min_attainment, "producer_below_target"),
        F.when(F.col("growth_run") > max_growth, "lag_grew"),
        F.when(~F.coalesce("drained", F.lit(False)), "not_drained"),
        F.when(F.col("unaccounted") > 0, "unaccounted"),
    )
    return (
        steps.withColumn("drain_ratio", F.round(F.coalesce(drain_ratio, F.lit(0.0)), 4))
        .withColumn("failed_because", F.filter(against, lambda x: x.isNotNull()))
        .withColumn("sustained", F.size("failed_because") == 0)
    )


def sustained_prefix(steps: DataFrame, by: list[str], rate: str, ok: str) -> DataFrame:
    """Highest rate below which every step held, NULL when the lowest failed.

    That is the highest rate under the lowest failing one: two aggregates, no ordering.
    """
    failing = steps.groupBy(*by).agg(F.min(F.when(~F.col(ok), F.col(rate))).alias("_fails_at"))
    below = F.col("_fails_at").isNull() | (F.col(rate) < F.col("_fails_at"))
    return (
        join_same(steps, small_side(failing), by)
        .groupBy(*by)
        .agg(F.max(F.when(below, F.col(rate))).alias("sustained_rate"), F.count(F.lit(1)).alias("steps"))
    )


def histogram(df: DataFrame, by: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Cumulative counts per upper bound, the last one unbounded."""
    v = F.col(value)
    cumulative = [F.count_if(v <= F.lit(float(b))) for b in bounds] + [F.count(v)]
    return df.groupBy(*by).agg(F.array(*cumulative).alias("cumulative"))


def histogram_quantile(q: float, cumulative: Column, bounds: list[float]) -> Column:
    """Quantile by linear interpolation inside the bucket that holds the rank.

    The lowest bucket starts at zero; a rank in the unbounded bucket gives the highest
    finite bound.
    """
    edges = F.array(*[F.lit(float(b)) for b in bounds])
    total = F.element_at(cumulative, -1)
    rank = total * F.lit(q)
    at = F.size(F.filter(cumulative, lambda c: c < rank))
    upper = F.get(edges, at)
    lower = F.when(at == 0, 0.0).otherwise(F.get(edges, at - 1))
    before = F.when(at == 0, 0).otherwise(F.get(cumulative, at - 1))
    inside = F.get(cumulative, at) - before
    return (
        F.when(total == 0, F.lit(None))
        .when(at >= len(bounds), F.lit(float(bounds[-1])))
        .otherwise(lower + (upper - lower) * F.try_divide(rank - before, inside))
    )


def sum_by(rates: DataFrame, series: list[str], label: str, ts: str, value: str, step_seconds: int) -> DataFrame:
    """Sum over series per label at even steps, the last sample of a step counting."""
    step = F.timestamp_seconds(time_bucket(F.col(ts), step_seconds) * step_seconds)
    last = (
        rates.withColumn("step", step)
        .groupBy("step", *series)
        .agg(F.max_by(value, F.struct(ts, "event_id")).alias("_value"))
    )
    return last.groupBy("step", label).agg(F.sum("_value").alias(value), F.count(F.lit(1)).alias("series"))


def lag_rising(lag: DataFrame, by: list[str], window_seconds: int, hold_seconds: int) -> DataFrame:
    """Intervals over which the slope of the lag stayed positive."""
    slopes = trailing_slope(lag, by, "ts", "value", window_seconds)
    return held_intervals(slopes, by, "ts", "event_id", F.col("slope") > 0, hold_seconds)


def lag_high(lag: DataFrame, by: list[str], threshold: float, hold_seconds: int) -> DataFrame:
    return held_intervals(lag, by, "ts", "event_id", F.col("value") > threshold, hold_seconds)


def producer_below_target(
    actual: DataFrame, target: DataFrame, by: list[str], hold_seconds: int, share: float = PRODUCER_SHARE
) -> DataFrame:
    """Intervals over which a producer with a target ran below a share of it."""
    both = join_same(actual, target, [*by, "ts"]).withColumn("event_id", F.lit(0))
    short = (F.col("target_rate") > 0) & (F.col("actual_rate") < F.col("target_rate") * share)
    return held_intervals(both, by, "ts", "event_id", short, hold_seconds)


def rate_above(rates: DataFrame, by: list[str], column: str, threshold: float, hold_seconds: int) -> DataFrame:
    """Intervals over which a rate or increase stayed above its threshold."""
    return held_intervals(rates, by, "ts", "event_id", F.col(column) > threshold, hold_seconds)


# Rules on counters: which counter, its rate or increase, the threshold, and how long it must hold.
COUNTER_RULES = {
    "dlq_rate_high": ("dlq", "rate", DLQ_RATE, DLQ_RATE_HOLD),
    "writes_exhausted": ("exhausted", "increase", 0, EXHAUSTED_HOLD),
    "retry_rate_high": ("retries", "rate", RETRY_RATE, RETRY_RATE_HOLD),
    "deliveries_failing": ("delivery_failures", "increase", 0, EXHAUSTED_HOLD),
}


def counter_rules(
    samples: DataFrame, by: list[str], kind: str, value: str, window_seconds: int, rules: dict[str, tuple] | None = None
) -> dict[str, DataFrame]:
    """Fired intervals of each counter rule; `kind` names the counter of a sample."""
    rates = counter_rate(samples, [*by, kind], "ts", value, "event_id", window_seconds)
    return {
        name: rate_above(rates.where(F.col(kind) == counter), by, column, threshold, hold)
        for name, (counter, column, threshold, hold) in (rules or COUNTER_RULES).items()
    }


def sliding_quantiles(
    counters: DataFrame, by: list[str], cumulative: str, bounds: list[float], window_seconds: int, quantiles: dict[str, float]
) -> DataFrame:
    """Quantiles at each sample of a histogram's counters, of what came in over the last `window_seconds`."""
    grown = vector_increase(counters, by, "ts", cumulative, len(bounds) + 1, "event_id", window_seconds)
    return grown.withColumns({name: histogram_quantile(q, F.col("increase"), bounds) for name, q in quantiles.items()})


def duration_p95(samples: DataFrame, by: list[str], value: str, window_seconds: int) -> DataFrame:
    """p95 of durations per window of `window_seconds`, as a series."""
    bucket = time_bucket(F.col("ts"), window_seconds)
    rows = samples.withColumn("ts", F.timestamp_seconds((bucket + 1) * window_seconds))
    filled = histogram(rows, [*by, "ts"], value, DURATION_BOUNDS)
    return filled.select(
        *by,
        "ts",
        F.lit(0).alias("event_id"),
        histogram_quantile(0.95, F.col("cumulative"), DURATION_BOUNDS).alias("p95"),
    )


def alerts(named: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """Fired intervals of several rules in one table."""
    parts = [
        fired.select(F.lit(rule).alias("rule"), *by, "active_since", "fired_at", "last_active", "samples")
        for rule, fired in named.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def append_alerts(rows: DataFrame, path: str) -> None:
    """Alert records, one JSON line each, with the time they were raised; raised again they replace themselves."""
    rows.withColumn("at", F.current_timestamp()).write.mode("overwrite").json(path)


def lag_samples(log_counts: DataFrame, by: list[str]) -> DataFrame:
    """Offsets behind the end of the log after each batch, from rows per batch and partition.

    For a source that reports no lag of its own: what the log holds at the end less
    what had been read, per partition, then the extremes over partitions. Partitions
    that a batch did not touch count as well.
    """
    partitions = log_counts.groupBy(*by).agg(F.collect_set("partition").alias("_partitions"))
    every = (
        log_counts.select(*by, "batch_id")
        .distinct()
        .transform(join_same, small_side(partitions), by)
        .select(*by, "batch_id", F.explode("_partitions").alias("partition"))
    )
    filled = join_same(every, log_counts, [*by, "batch_id", "partition"], "left").fillna({"rows": 0})
    so_far = W.partitionBy(*by, "partition").orderBy("batch_id").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*by, "partition")
    return (
        filled.withColumn("_behind", F.sum("rows").over(whole) - F.sum("rows").over(so_far))
        .groupBy(*by, "batch_id")
        .agg(
            F.max("_behind").alias("max_offsets_behind"),
            F.min("_behind").alias("min_offsets_behind"),
            F.round(F.avg("_behind"), 3).alias("avg_offsets_behind"),
        )
    )
