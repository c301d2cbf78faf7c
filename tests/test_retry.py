"""Retry outcomes, accounting and delivery with golden values."""

import time
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyport.operators import retry

SCHEMA = "event_id string, table string, attempt int, ok boolean, error string, permanent boolean"


def attempts(spark, *writes):
    rows = []
    for event, errors, ok in writes:
        rows += [(event, "t", i + 1, False, e.lstrip("!"), e.startswith("!")) for i, e in enumerate(errors)]
        if ok:
            rows.append((event, "t", len(errors) + 1, True, None, False))
    return spark.createDataFrame(rows, SCHEMA)


def test_outcomes(spark):
    df = attempts(
        spark,
        ("first", [], True),
        ("third", ["TimeoutError", "TimeoutError"], True),
        ("never", ["TimeoutError"] * 4, False),
        ("wrong", ["!ValueError"], False),
    )
    got = {r["event_id"]: r for r in retry.retry_outcomes(df).collect()}
    assert (got["first"]["attempts"], got["first"]["retries"], got["first"]["outcome"]) == (1, 0, "first_try")
    assert (got["third"]["attempts"], got["third"]["retries"], got["third"]["backoff_ms"]) == (3, 2, 3000.0)
    assert (got["never"]["attempts"], got["never"]["outcome"], got["never"]["backoff_ms"]) == (4, "exhausted", 7000.0)
    assert (got["wrong"]["attempts"], got["wrong"]["outcome"], got["wrong"]["backoff_ms"]) == (1, "permanent", 0.0)


def test_no_backoff_still_retries(spark):
    df = attempts(spark, ("a", ["E", "E"], True))
    row = retry.retry_outcomes(df, schedule_ms=[]).first()
    assert (row["attempts"], row["retries"], row["backoff_ms"]) == (3, 2, 0.0)


def test_average_counts_retries_not_attempts(spark):
    df = attempts(spark, ("a", ["E", "E"], True), ("b", [], True), ("c", [], True), ("d", [], True))
    row = retry.retry_accounting(df, ["table"]).first()
    assert (row["successes"], row["retries_before_success"], row["avg_retries_to_success"]) == (4, 2, 0.5)
    assert row["failure_reasons"] == {"E": 2}


def test_counters_merge_key_by_key(spark):
    parts = spark.createDataFrame(
        [("r", 5, 4, 2, {"WriteTimeout": 2}), ("r", 3, 3, 1, {"WriteTimeout": 1, "Unavailable": 1})],
        "run string, attempts long, successes long, retries long, reasons map<string,long>",
    )
    row = retry.merge_counters(parts, ["run"], ["attempts", "successes", "retries"], [], "reasons").first()
    assert (row["attempts"], row["successes"], row["retries"]) == (8, 7, 3)
    assert row["reasons"] == {"WriteTimeout": 3, "Unavailable": 1}


def failing_store():
    """A store that fails an event as often as its id says; 'x' ids are refused for ever."""
    tries: dict[str, int] = {}

    def write(batch: pd.DataFrame) -> list:
        out = []
        for event in batch["event_id"]:
            tries[event] = tries.get(event, 0) + 1
            if event.startswith("x"):
                out.append("!InvalidRequest: refused")
            else:
                out.append("WriteTimeout: slow" if tries[event] <= int(event.split("-")[1]) else None)
        return out

    return write


def test_deliver(spark):
    events = spark.createDataFrame([(f"e-{n}",) for n in range(7)] + [("x-0",)], "event_id string").coalesce(1)
    policy = retry.RetryPolicy(schedule_ms=(1, 2, 4), jitter_ratio=0)
    got = {r["event_id"]: r for r in retry.deliver(events, failing_store(), policy, sleep=lambda s: None).collect()}
    for n in range(4):
        assert (got[f"e-{n}"]["attempts"], got[f"e-{n}"]["succeeded"]) == (n + 1, True)
    for n in range(4, 7):
        assert (got[f"e-{n}"]["attempts"], got[f"e-{n}"]["succeeded"]) == (4, False)
        assert got[f"e-{n}"]["backoff_ms"] == 7.0
    assert (got["x-0"]["attempts"], got["x-0"]["last_error"]) == (1, "InvalidRequest: refused")


def test_policy():
    plain = retry.RetryPolicy(max_attempts=9, jitter_ratio=0)
    assert plain.waits("k") == [1000, 2000, 4000, 4000, 4000, 4000, 4000, 4000]
    assert retry.RetryPolicy(schedule_ms=()).waits("k") == [0.0] * 3
    assert retry.RetryPolicy(max_attempts=1).waits("k") == []
    assert retry.RetryPolicy(max_attempts=2, jitter_ratio=0).waits("k") == [1000]


def test_jitter_spreads_batches_and_repeats():
    policy = retry.RetryPolicy()
    firsts = [policy.waits(f"event-{n}")[0] for n in range(400)]
    assert all(900 <= w <= 1100 for w in firsts) and len(set(firsts)) > 390
    assert min(firsts) < 920 and max(firsts) > 1080 and abs(sum(firsts) / 400 - 1000) < 15
    assert policy.waits("event-7") == policy.waits("event-7")


@pytest.mark.parametrize("error,attempts", [(TimeoutError("slow"), 4), (ValueError("wrong"), 1)])
def test_exceptions_are_outcomes(spark, error, attempts):
    def write(batch):
        raise error

    events = spark.createDataFrame([("a",), ("b",)], "event_id string").coalesce(1)
    policy = retry.RetryPolicy(schedule_ms=(), jitter_ratio=0)
    for row in retry.deliver(events, write, policy, sleep=lambda s: None).collect():
        assert (row["attempts"], row["succeeded"]) == (attempts, False)
        assert row["last_error"] == f"{type(error).__name__}: {error}"


def test_a_crash_delivers_only_what_has_no_outcome(spark, folder):
    """The job dies in one task; the tasks that had committed are not delivered again."""
    events = spark.range(40).select(F.col("id").cast("string").alias("event_id")).repartitionByRange(4, F.col("event_id").cast("int"))
    calls = f"{folder}/calls"

    def store(fails):
        def write(batch):
            with open(calls, "a") as told:
                told.writelines(f"{i}\n" for i in batch["event_id"])
            if fails and "39" in set(batch["event_id"]):
                time.sleep(2)  # the other tasks commit meanwhile
                raise KeyboardInterrupt
            return [None] * len(batch)

        return write

    Path(folder).mkdir(parents=True)
    policy = retry.RetryPolicy(schedule_ms=(), jitter_ratio=0)
    with pytest.raises(Exception, match="KeyboardInterrupt"):
        retry.deliver_once(events, store(True), policy, f"{folder}/ledger")
    held = {r["event_id"] for r in retry.read_ledger(spark, f"{folder}/ledger").collect()}
    assert held and "39" not in held
    done = retry.deliver_once(events, store(False), policy, f"{folder}/ledger").collect()
    assert sorted(int(r["event_id"]) for r in done) == list(range(40)) and {r["try"] for r in done} == {0, 1}
    told = Counter(Path(calls).read_text().split())
    assert all(told[i] == 1 for i in held) and all(told[str(i)] == 2 for i in range(40) if str(i) not in held)
    again = retry.deliver_once(events, store(True), policy, f"{folder}/ledger")
    assert again.count() == 40 and Counter(Path(calls).read_text().split()) == told


def test_exhausted_writes_are_those_of_all_outcomes(spark):
    df = attempts(
        spark,
        ("first", [], True),
        ("third", ["TimeoutError"] * 2, True),
        ("fifth", ["TimeoutError"] * 4, True),
        ("never", ["TimeoutError"] * 3 + ["Unavailable"], False),
        ("wrong", ["TimeoutError"] * 4 + ["!ValueError"], False),
        ("short", ["TimeoutError"], False),
        (None, ["TimeoutError"] * 4, True),
    ).unionByName(spark.createDataFrame([("open", "t", n, None, None, None) for n in range(4)] + [("never", "u", 1, True, None, False)], SCHEMA))
    found = retry.exhausted_writes(df)
    whole = retry.retry_outcomes(df).where("outcome = 'exhausted'")
    assert found.columns == whole.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    assert {r["event_id"] for r in found.collect()} == {"never", "open"}
    nulls = df.where("event_id IS NULL AND NOT ok")
    assert [r["attempts"] for r in retry.exhausted_writes(nulls).collect()] == [4]
