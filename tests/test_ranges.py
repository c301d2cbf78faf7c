"""Series and groups cut into sampled ranges: the cuts change nothing, and no range is much larger than another."""

import random
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F
from test_functions import T0, by_run, frame

from tallyport.functions import ranges, sequences
from tallyport.functions.quantiles import exact_quantiles
from tallyport.operators import latency, retry, telemetry


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """As many ranges as there are shuffle partitions, however few the rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", before)


def dense_day(seed, n=600):
    """A hot series of one day whose runs are longer than its ranges, and small ones beside it."""
    rng = random.Random(seed)
    rows, value = [], 0.0
    for i in range(n):
        value = value + 1 if rng.random() < 0.99 else rng.choice([0.0, None, value])
        rows.append((None if seed % 2 else "hot", i, T0 + timedelta(seconds=i // 3), value))
        value = value or 0.0
    rows += [(name, n + 10 * k + j, T0 + timedelta(seconds=j), float(j % 4)) for k, name in enumerate("abcd") for j in range(5)]
    return rows


def rising(items):
    best = length = 0
    for a, b in zip(items, items[1:]):
        up = a[3] is not None and b[3] is not None and b[3] > a[3]
        length = length + 1 if up else 0
        best = max(best, length)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_rising_runs_over_many_ranges(spark, seed):
    rows = dense_day(seed)
    got = sequences.longest_rising_run(frame(spark, rows), ["run"], "ts", "v", "id").collect()
    want = {run: rising(sorted(items, key=lambda r: (r[2], r[1]))) for run, items in by_run(rows).items()}
    assert {r["run"]: r["longest_rising_run"] for r in got} == want and max(want.values()) > 60


def test_one_rise_through_all_ranges(spark):
    rows = [("up", i, T0 + timedelta(seconds=i), float(i)) for i in range(400)]
    rows += [("down", i, T0 + timedelta(seconds=i), float(-i)) for i in range(400)]
    got = sequences.longest_rising_run(frame(spark, rows), ["run"], "ts", "v", "id").collect()
    assert {r["run"]: r["longest_rising_run"] for r in got} == {"up": 399, "down": 0}


@pytest.mark.parametrize("hold", [0, 20, 1000])
def test_holds_over_many_ranges(spark, hold):
    rows, want = dense_day(3), []
    for run, items in by_run(rows).items():
        streak = []
        for r in [*items, (run, None, None, None)]:
            if r[3] is not None and r[3] > 2:
                streak.append(r)
                continue
            fired = [x[2] for x in streak if x[2] - streak[0][2] >= timedelta(seconds=hold)]
            if fired:
                want.append((run or "", streak[0][2], fired[0], streak[-1][2], len(streak)))
            streak = []
    got = sequences.held_intervals(frame(spark, rows), ["run"], "ts", "id", F.col("v") > 2, hold).collect()
    assert sorted((r["run"] or "", r["active_since"], r["fired_at"], r["last_active"], r["samples"]) for r in got) == sorted(want)


def test_a_series_of_one_day_is_shared_out(spark):
    """One series, one day: no range above twice the median."""
    day = spark.range(40_000).selectExpr("'a' AS run", "id", "timestamp_seconds(1709251200 + id) AS ts", "double(id) AS v")
    cut = sequences.in_series_ranges(day, ["run"], ["ts", "id"]).groupBy("_bucket").count().collect()
    sizes = [r["count"] for r in cut]
    assert len(sizes) == 13 and max(sizes) <= 2 * median(sizes)


def test_running_sums(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, "x", "x", "x", "y"]), i, rng.randint(-5, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i long, n long")
    got = {r["i"]: (r["before"], r["rows"]) for r in ranges.running_before(df, ["k"], ["i"], {"before": F.col("n"), "rows": F.lit(1)}).collect()}
    want, total, count = {}, {}, {}
    for k, i, n in rows:
        want[i] = (total.get(k, 0), count.get(k, 0))
        total[k], count[k] = total.get(k, 0) + n, count.get(k, 0) + 1
    assert got == want


def test_unknown_samples_do_not_swallow_an_increase(spark):
    values = [10.0, None, 30.0, None, None, 5.0, None]
    rows = [("a", i, T0 + timedelta(seconds=10 * i), v) for i, v in enumerate(values)]
    got = {r["id"]: (r["samples"], r["increase"]) for r in sequences.counter_rate(frame(spark, rows), ["run"], "ts", "v", "id", 600).collect()}
    assert got == {0: (1, 0.0), 1: (1, 0.0), 2: (2, 20.0), 3: (2, 20.0), 4: (2, 20.0), 5: (3, 25.0), 6: (3, 25.0)}
    # A frame that begins with an unknown sample still leaves the step into it out.
    short = {r["id"]: r["increase"] for r in sequences.counter_rate(frame(spark, rows), ["run"], "ts", "v", "id", 20).collect()}
    assert short == {0: 0.0, 1: 0.0, 2: 20.0, 3: 0.0, 4: 0.0, 5: 0.0, 6: 0.0}


def test_null_groups_stay(spark):
    """NULL is a group like any other, alone and as a part of a key."""
    rows = [(g, h, float(v)) for g in (None, "a") for h in (None, 1) for v in range(4)]
    df = spark.createDataFrame(rows, "g string, h int, v double")
    key = lambda r: (r["g"], r["h"])
    every = {(g, h) for g in (None, "a") for h in (None, 1)}
    assert {key(r): r["m"] for r in exact_quantiles(df, ["g", "h"], "v", {"m": 50}).collect()} == dict.fromkeys(every, 1.5)
    stats = telemetry.run_stats(df.withColumn("ok", F.lit(True)), ["g", "h"], "v", "ok").collect()
    assert {key(r): (r["n"], r["median"]) for r in stats} == dict.fromkeys(every, (4, 1.5))
    report = latency.latency_report(df.withColumn("latency_ms", F.col("v").cast("long")), ["g", "h"]).collect()
    assert {key(r): (r["samples"], r["p50_ms"]) for r in report} == dict.fromkeys(every, (4, 1.5))
    steps = df.withColumn("ok", F.col("v") < 2)
    assert {key(r): r["sustained_rate"] for r in telemetry.sustained_prefix(steps, ["g", "h"], "v", "ok").collect()} == dict.fromkeys(every, 1.0)


def test_null_groups_keep_reasons_and_recoveries(spark):
    tried = spark.createDataFrame(
        [("e", None, 1, False, "Timeout", False), ("e", None, 2, True, None, False)],
        "event_id string, table string, attempt int, ok boolean, error string, permanent boolean",
    )
    row = retry.retry_accounting(tried, ["table"]).first()
    assert (row["retries_before_success"], row["failure_reasons"]) == (1, {"Timeout": 1})
    parts = spark.createDataFrame([(None, 1, 2, {"A": 1}), (None, 3, 4, {"A": 2})], "run string, n int, m int, why map<string,int>")
    merged = retry.merge_counters(parts, ["run"], ["n"], ["m"], "why").first()
    assert (merged["n"], merged["m"], merged["why"]) == (4, 4, {"A": 3})
    at = datetime(2024, 1, 1)
    batches = spark.createDataFrame([(None, 1, at + timedelta(seconds=9), True)], "run string, batch_id int, ts timestamp, good boolean")
    faults = spark.createDataFrame([(None, at)], "run string, fault_at timestamp")
    row = telemetry.first_after(batches, faults, ["run"], "ts", F.col("good")).first()
    assert (row["recovered"], row["recovery_batch_id"], row["recovery_seconds"]) == (True, 1, 9.0)
