"""Retried writes: outcomes, accounting, and delivery to an external store."""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.ranges import join_same
from tallyport.functions.timing import backoff_delay_ms
from tallyport.session import small_side
from tallyport.sources.files import Storage

# Attempts per write and waits between them.
MAX_ATTEMPTS = 4
SCHEDULE_MS = [1000, 2000, 4000]
JITTER_RATIO = 0.1


def with_backoff(
    attempts: DataFrame,
    max_attempts: int = MAX_ATTEMPTS,
    schedule_ms: list[int] | None = None,
    jitter_ratio: float = 0.0,
) -> DataFrame:
    """Adds the wait after each failed attempt; none after the last or a permanent failure."""
    schedule = SCHEDULE_MS if schedule_ms is None else schedule_ms
    wait = backoff_delay_ms(F.col("attempt") - 1, schedule, jitter_ratio, F.col("event_id"))
    waits = ~F.col("ok") & ~F.col("permanent") & (F.col("attempt") < max_attempts)
    return attempts.withColumn("backoff_ms", F.when(waits, wait).otherwise(0.0))


def retry_outcomes(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS, **backoff) -> DataFrame:
    """One row per write (event and table) from its attempts.

    Retries are attempts less one for a write that succeeded; a write that did not
    keeps its attempts for the quarantine record.
    """
    last = F.col("attempts") >= max_attempts
    return (
        with_backoff(attempts, max_attempts, **backoff)
        .groupBy("event_id", "table")
        .agg(
            F.count(F.lit(1)).cast("int").alias("attempts"),
            F.bool_or("ok").alias("succeeded"),
            F.bool_or("permanent").alias("_permanent"),
            F.max_by("error", "attempt").alias("last_error"),
            F.sum("backoff_ms").alias("backoff_ms"),
        )
        .withColumn(
            "outcome",
            F.when(F.col("succeeded") & (F.col("attempts") == 1), "first_try")
            .when(F.col("succeeded"), "retried")
            .when(F.col("_permanent"), "permanent")
            .when(last, "exhausted")
            .otherwise("in_flight"),
        )
        .withColumn("retries", F.when(F.col("succeeded"), F.col("attempts") - 1).otherwise(0))
        .drop("_permanent")
    )


def exhausted_writes(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS, **backoff) -> DataFrame:
    """The `retry_outcomes` of writes that ran out of attempts.

    All attempts of such a write failed, so only failed attempts are grouped. What a write that
    got through looks like without its successes is taken out again afterwards.
    """
    key = ["event_id", "table"]
    through = F.coalesce(F.col("ok"), F.lit(False))
    seeming = small_side(
        retry_outcomes(attempts.where(~through), max_attempts, **backoff).where(F.col("outcome") == "exhausted")
    )
    succeeded = join_same(attempts.where(through).select(*key), seeming.select(*key), key, "left_semi")
    return join_same(seeming, succeeded, key, "left_anti")


def retry_accounting(attempts: DataFrame, by: list[str], max_attempts: int = MAX_ATTEMPTS, **backoff) -> DataFrame:
    """Totals per group, with failure reasons as a map."""
    outcomes = retry_outcomes(attempts, max_attempts, **backoff)
    lost = F.col("outcome").isin("exhausted", "permanent")
    totals = outcomes.groupBy(*by).agg(
        F.sum("attempts").alias("attempts"),
        F.count_if(F.col("succeeded")).alias("successes"),
        F.count_if(lost).alias("failures_exhausted"),
        F.sum("retries").alias("retries_before_success"),
        F.count_if(F.col("outcome") == "retried").alias("retried_writes"),
        F.round(F.sum("backoff_ms"), 1).alias("total_backoff_ms"),
    )
    reasons = (
        attempts.where(F.col("error").isNotNull())
        .groupBy(*by, "error")
        .agg(F.count(F.lit(1)).alias("_count"))
        .groupBy(*by)
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("error", "_count")))).alias("failure_reasons"))
    )
    average = lambda part, whole, digits: F.coalesce(
        F.round(F.col(part) / F.nullif(F.col(whole), F.lit(0)), digits), F.lit(0.0)
    )
    return (
        join_same(totals, reasons, by, "left")
        .withColumn("avg_retries_to_success", average("retries_before_success", "successes", 4))
        .withColumn("avg_retries_among_retried", average("retries_before_success", "retried_writes", 3))
    )


def merge_counters(parts: DataFrame, by: list[str], sums: list[str], maxima: list[str], reasons: str) -> DataFrame:
    """Adds up partial counters per group; the reason maps are added key by key."""
    totals = parts.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxima]
    )
    merged = (
        parts.select(*by, F.explode(reasons).alias("_reason", "_count"))
        .groupBy(*by, "_reason")
        .agg(F.sum("_count").alias("_count"))
        .groupBy(*by)
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_reason", "_count")))).alias(reasons))
    )
    return join_same(totals, merged, by, "left")


def reasons_text(reasons: Column) -> Column:
    """'A=1,B=2' from a reason map, '' when there is none."""
    parts = F.transform(F.array_sort(F.map_entries(reasons)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return F.coalesce(F.array_join(parts, ","), F.lit(""))


# A write function takes a batch of rows and returns one error per row: None for a
# row that was written, 'Name: text' for a passing failure, '!Name: text' for one
# that would fail for ever.
WriteFn = Callable[[pd.DataFrame], "list[str | None]"]


@dataclass(frozen=True)
class RetryPolicy:
    """`permanent` names the exceptions of a write that would be raised for ever."""

    max_attempts: int = MAX_ATTEMPTS
    schedule_ms: tuple[int, ...] = tuple(SCHEDULE_MS)
    jitter_ratio: float = JITTER_RATIO
    permanent: tuple[type[Exception], ...] = (ValueError, TypeError, KeyError)

    def waits(self, batch_key: str) -> list[float]:
        """All waits between the attempts of one batch, in milliseconds.

        The schedule's last step repeats as often as needed. Jitter is a hash of the
        batch and the round: batches spread out, and a task run again waits the same.
        """
        rounds = max(self.max_attempts - 1, 0)
        steps = [*self.schedule_ms[:rounds], *self.schedule_ms[-1:] * (rounds - len(self.schedule_ms))]
        spread = [zlib.crc32(f"{batch_key}/{n}".encode()) / 2**31 - 1 for n in range(len(steps))]
        return [max(0.0, step * (1 + self.jitter_ratio * s)) for step, s in zip(steps, spread)] or [0.0] * rounds

    def attempt(self, write: WriteFn, batch: pd.DataFrame) -> list[str | None]:
        """Errors of one write; an exception counts for every row of its batch."""
        try:
            return list(write(batch))
        except Exception as error:
            text = f"{'!' * isinstance(error, self.permanent)}{type(error).__name__}: {error}"
            return [text] * len(batch)


DELIVERY_SCHEMA = "event_id string, attempts int, succeeded boolean, last_error string, backoff_ms double"
LEDGER_SCHEMA = DELIVERY_SCHEMA + ", task int"


def deliver(rows: DataFrame, write: WriteFn, policy: RetryPolicy = RetryPolicy(), sleep=time.sleep) -> DataFrame:
    """Write to an external store in Arrow batches and return each event's outcome.

    The failures of a batch are retried together after the scheduled wait, so a batch
    waits once per round and not once per row. A task that is run again writes again:
    the store must upsert by key.
    """

    def attempt_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            result = pd.DataFrame(
                {"event_id": batch["event_id"], "attempts": 0, "succeeded": False, "last_error": None, "backoff_ms": 0.0}
            )
            left = batch.index
            waits = policy.waits(str(batch["event_id"].iloc[0]) if len(batch) else "")
            for attempt in range(1, policy.max_attempts + 1):
                errors = pd.Series(policy.attempt(write, batch.loc[left]), index=left, dtype=object)
                failed = errors.notna()
                result.loc[left, "attempts"] = attempt
                result.loc[left[~failed], "succeeded"] = True
                result.loc[left[failed], "last_error"] = errors[failed].str.removeprefix("!")
                left = left[failed & ~errors.fillna("").str.startswith("!")]
                if left.empty or attempt == policy.max_attempts:
                    break
                wait = waits[attempt - 1]
                result.loc[left, "backoff_ms"] += wait
                sleep(wait / 1000)
            yield result

    return rows.mapInPandas(attempt_all, DELIVERY_SCHEMA)


def deliver_once(rows: DataFrame, write: WriteFn, policy: RetryPolicy, ledger: str) -> DataFrame:
    """`deliver` with a ledger: what has an outcome there is not delivered again.

    Every task's outcomes become lasting when the task commits, not when the job ends, so
    after a crash only the rows of tasks in flight are delivered a second time. A later
    call reads the outcomes of the calls before it and tries what has none; once a call
    has ended there is nothing left to do.
    """
    spark, storage = rows.sparkSession, Storage(rows.sparkSession, ledger)
    before = storage.matching("try=*")
    if not storage.matching("try=*/_SUCCESS"):
        if before:
            rows = rows.join(read_ledger(spark, ledger).select("event_id"), "event_id", "left_anti")
        tried = deliver(rows, write, policy).withColumn("task", F.spark_partition_id())
        # Version 2 of the committer moves a task's file into place as the task commits.
        tried.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{ledger}/try={len(before)}")
    return read_ledger(spark, ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The outcomes in a ledger; `try` is the call that brought them."""
    return spark.read.schema(LEDGER_SCHEMA + ", try int").option("basePath", ledger).parquet(ledger)
