"""Durations, hours, retry delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def earlier_by(moment: Column, spec: str) -> Column:
    """`moment` less an interval such as '2 minutes', read as Spark reads intervals."""
    return moment - F.expr(f"INTERVAL '{spec}'")


def event_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def minute_bucket(epoch_ms: Column) -> Column:
    return F.floor(epoch_ms / 60000).cast("bigint")


def time_bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(ts) / seconds).cast("bigint")


def backoff_delay_ms(
    retry_index: Column,
    schedule_ms: list[int],
    jitter_ratio: float = 0.0,
    seed_on: Column | None = None,
) -> Column:
    """Wait before retry `retry_index` (from 0), clamped to the end of the schedule.

    Jitter is uniform in +/- ratio and derived from `seed_on` and the index, so a
    recomputed task gets the same delays. An empty schedule means no wait.
    """
    if not schedule_ms:
        return F.lit(0.0)
    steps = F.array(*[F.lit(float(ms)) for ms in schedule_ms])
    base = F.element_at(steps, F.least(retry_index + 1, F.lit(len(schedule_ms))).cast("int"))
    if jitter_ratio <= 0:
        return base
    key = F.xxhash64(seed_on if seed_on is not None else retry_index, retry_index)
    unit = F.pmod(key, F.lit(1_000_003)) / F.lit(1_000_002.0)
    return F.greatest(F.lit(0.0), base * (F.lit(1.0 - jitter_ratio) + unit * (2 * jitter_ratio)))
