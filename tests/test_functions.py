"""Key, time, quantile and sequence functions against golden values and brute force."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyport.functions import sequences
from tallyport.functions.keys import canonical_uuid, log_partition
from tallyport.functions.quantiles import exact_quantiles
from tallyport.functions.timing import backoff_delay_ms, earlier_by
from tallyport.operators import telemetry

T0 = datetime(2024, 3, 1, 23, 58)


def column(spark, kind, values, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", expr(F.col("x")).alias("y"))
    return [r["y"] for r in df.orderBy("i").collect()]


def test_city_keys_land_where_the_log_puts_them(spark):
    # Published layout of the eight city keys over six partitions.
    layout = {"nyc": 0, "chi": 3, "bos": 3, "sfo": 5, "lax": 5, "sea": 2, "aus": 4, "mia": 4}
    assert column(spark, "string", list(layout), lambda x: log_partition(x, 6)) == list(layout.values())


def test_partition_of_non_ascii_and_short_keys(spark):
    def murmur2(data):
        m, h = 0x5BD1E995, 0x9747B28C ^ len(data)
        whole = len(data) // 4 * 4
        for i in range(0, whole, 4):
            k = int.from_bytes(data[i:i + 4], "little") * m & 0xFFFFFFFF
            h = h * m & 0xFFFFFFFF ^ (k ^ k >> 24) * m & 0xFFFFFFFF
        if len(data) % 4:
            h = (h ^ int.from_bytes(data[whole:], "little")) * m & 0xFFFFFFFF
        h = (h ^ h >> 13) * m & 0xFFFFFFFF
        return (h ^ h >> 15) & 0x7FFFFFFF

    keys = ["", "a", "ab", "abc", "abcd", "zürich", "東京-駅", "x" * 200]
    assert column(spark, "string", keys, lambda x: log_partition(x, 6)) == [murmur2(k.encode()) % 6 for k in keys]


def test_uuid_spellings(spark):
    plain = "0f8fad5b-d9cb-469f-a165-70867728950e"
    forms = [plain, plain.upper(), plain.replace("-", ""), "{" + plain + "}", "urn:uuid:" + plain, plain[:-1], "x", None]
    assert column(spark, "string", forms, canonical_uuid) == [plain] * 5 + [None] * 3


@pytest.mark.parametrize("spec,seconds", [("2 minutes", 120), ("1 minute", 60), ("3 hours", 10800), ("500 milliseconds", 0.5)])
def test_lateness(spark, spec, seconds):
    moment = F.lit("2024-01-08 12:00:00").cast("timestamp")
    row = spark.range(1).select((F.unix_micros(moment) - F.unix_micros(earlier_by(moment, spec))).alias("us")).first()
    assert row["us"] == seconds * 1_000_000


def test_no_lateness(spark):
    with pytest.raises(Exception, match="INTERVAL|interval"):
        spark.range(1).select(earlier_by(F.current_timestamp(), "soon")).collect()
    none = spark.range(1).select(earlier_by(F.lit(None).cast("timestamp"), "2 minutes").alias("t")).first()
    assert none["t"] is None


def test_backoff(spark):
    schedule = [1000, 2000, 4000]
    assert column(spark, "int", [0, 1, 2, 7], lambda x: backoff_delay_ms(x, schedule)) == [1000, 2000, 4000, 4000]
    assert column(spark, "int", [0, 5], lambda x: backoff_delay_ms(x, [])) == [0.0, 0.0]
    jittered = column(spark, "int", [0] * 200, lambda x: backoff_delay_ms(x, [1000], 0.1, F.col("i")))
    assert all(900 <= d <= 1100 for d in jittered) and len(set(jittered)) > 50


def test_quantiles_of_values_close_together(spark):
    rows = [("g", n / 1e7) for n in range(3001)] + [("h", 1.7e12 + n) for n in range(1001)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"p50": 50}, {"n99": 99}).collect()}
    assert got["g"]["p50"] == pytest.approx(1500 / 1e7) and got["g"]["n99"] == pytest.approx(2970 / 1e7)
    assert got["h"]["p50"] == 1.7e12 + 500 and got["h"]["n99"] == 1.7e12 + 990


def test_quantiles_of_a_hot_group(spark):
    rng = np.random.default_rng(3)
    groups = {
        "hot": np.concatenate([np.full(900, 7.25), rng.exponential(20, 300)]),
        "negative": rng.normal(0, 50, 101),
        "one": np.array([3.5]),
        "two": np.array([-1.0, 4.0]),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = exact_quantiles(df, ["g"], "v", {"p50": 50, "p95": 95, "p999": 99.9}, {"n50": 50, "n99": 99})
    got = {r["g"]: r for r in out.collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in (("p50", 50), ("p95", 95), ("p999", 99.9)):
            assert got[g][name] == pytest.approx(np.percentile(values, p), rel=1e-12, abs=1e-12)
        ordered = sorted(values)
        for name, p in (("n50", 0.5), ("n99", 0.99)):
            assert got[g][name] == ordered[min(len(ordered) - 1, round(p * (len(ordered) - 1)))]


def series(seed, n=400):
    """Two series over several days, one of them hot, with equal times and long gaps."""
    rng = random.Random(seed)
    rows, at = [], {"hot": T0, "cold": T0}
    for i in range(n):
        name = "hot" if rng.random() < 0.85 else "cold"
        at[name] += timedelta(seconds=rng.choice([0, 20, 60, 600, 7200, 90000 if rng.random() < 0.1 else 30]))
        rows.append((name, i, at[name], float(rng.randint(0, 9))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "run string, id long, ts timestamp, v double")


def by_run(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_longest_rising_run(spark, seed):
    rows = series(seed)
    want = {}
    for run, items in by_run(rows).items():
        best = length = 0
        for a, b in zip(items, items[1:]):
            length = length + 1 if b[3] > a[3] else 0
            best = max(best, length)
        want[run] = best
    got = sequences.longest_rising_run(frame(spark, rows), ["run"], "ts", "v", "id").collect()
    assert {r["run"]: r["longest_rising_run"] for r in got} == want


def test_rising_run_across_a_bucket_edge(spark):
    rows = [("a", i, T0 + timedelta(hours=10 * i), float(i)) for i in range(8)]
    got = sequences.longest_rising_run(frame(spark, rows), ["run"], "ts", "v", "id").first()
    assert got["longest_rising_run"] == 7
    falling = [("a", i, T0 + timedelta(hours=i), float(-i)) for i in range(5)]
    assert sequences.longest_rising_run(frame(spark, falling), ["run"], "ts", "v", "id").first()[1] == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_counter_rate(spark, seed):
    rows, width = series(seed), 5400
    want = {}
    for run, items in by_run(rows).items():
        for at in items:
            inside = [x for x in items if timedelta(0) <= at[2] - x[2] <= timedelta(seconds=width)]
            inside = [x for x in inside if x[2] <= at[2]]
            grown = sum((b[3] - a[3]) if b[3] >= a[3] else b[3] for a, b in zip(inside, inside[1:]))
            want[at[1]] = (len(inside), grown)
    got = sequences.counter_rate(frame(spark, rows), ["run"], "ts", "v", "id", width).collect()
    assert {r["id"]: (r["samples"], r["increase"]) for r in got} == want


def test_trailing_slope(spark):
    rows, width = series(5), 7200
    want = {}
    for run, items in by_run(rows).items():
        for at in items:
            inside = [x for x in items if timedelta(0) <= at[2] - x[2] <= timedelta(seconds=width)]
            xs = np.array([(x[2] - T0).total_seconds() for x in inside])
            if len(inside) >= 2:
                spread = ((xs - xs.mean()) ** 2).sum()
                ys = np.array([x[3] for x in inside])
                want[at[1]] = float(((xs - xs.mean()) * (ys - ys.mean())).sum() / spread) if spread else None
    got = {r["id"]: r["slope"] for r in sequences.trailing_slope(frame(spark, rows), ["run"], "ts", "v", width).collect()}
    assert set(got) == set(want)
    for key, slope in want.items():
        assert (got[key] is None) == (slope is None)
        assert slope is None or got[key] == pytest.approx(slope, rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("apart", [1, 500_000, 5_000_000])
def test_slope_of_short_frames_at_any_time_of_day(spark, apart):
    midnight = datetime(2024, 3, 1)
    rows = []
    for i, at in enumerate((0, 43_200, 80_000, 86_399)):
        for j, v in enumerate((1e9 + 3.0, 1e9 + 5.0)):
            rows.append((f"r{i}", 2 * i + j, midnight + timedelta(seconds=at, microseconds=apart * j), v))
    rows += [("same", 90 + j, midnight + timedelta(seconds=80_000), float(j)) for j in range(3)]
    rows += [("flat", 95 + j, midnight + timedelta(seconds=80_000 + 7 * j), 0.1) for j in range(5)]
    got = {r["id"]: r["slope"] for r in sequences.trailing_slope(frame(spark, rows), ["run"], "ts", "v", 7200).collect()}
    for i in range(4):
        assert got[2 * i + 1] == pytest.approx(2 / (apart / 1e6), rel=1e-9)
    assert [got[90 + j] for j in range(3)] == [None] * 3 and [got[95 + j] for j in range(1, 5)] == [0.0] * 4


def test_short_frames_of_a_dense_day(spark):
    """Two points in each frame, after a day of samples a second."""
    day = spark.range(86_400).selectExpr(
        "'a' AS run", "id", "timestamp_seconds(1709251200 + id) AS ts", "1e6 + id % 7 + id / 1000 AS v"
    )
    got = sequences.trailing_slope(day, ["run"], "ts", "v", 1).select("id", "slope", (F.col("id") % 7 == 0).alias("falls"))
    wrong = got.where(F.abs(F.col("slope") - F.when(F.col("falls"), -5.999).otherwise(1.001)) > 1e-6)
    assert got.count() == 86_399 and wrong.count() == 0


def test_null_is_a_series(spark):
    rows = [(None if i < 4 else "b", i, T0 + timedelta(minutes=i % 4), float(i % 4)) for i in range(8)]
    df = frame(spark, rows)
    slopes = {r["id"]: r["slope"] for r in sequences.trailing_slope(df, ["run"], "ts", "v", 600).collect()}
    assert slopes == {i: pytest.approx(1 / 60) for i in (1, 2, 3, 5, 6, 7)}
    rates = {r["id"]: r["increase"] for r in sequences.counter_rate(df, ["run"], "ts", "v", "id", 600).collect()}
    assert rates == {i: i % 4 for i in range(8)}
    rising = telemetry.lag_rising(df.withColumnRenamed("v", "value").withColumnRenamed("id", "event_id"), ["run"], 600, 60)
    assert {r["run"]: r["samples"] for r in rising.collect()} == {None: 3, "b": 3}
    runs = sequences.longest_rising_run(df, ["run"], "ts", "v", "id").collect()
    assert {r["run"]: r["longest_rising_run"] for r in runs} == {None: 3, "b": 3}


@pytest.mark.parametrize("hold", [0, 600, 100_000])
def test_held_intervals(spark, hold):
    rows = series(6)
    want = []
    for run, items in by_run(rows).items():
        streak = []
        for r in items + [(run, None, None, -1.0)]:
            if r[3] > 3:
                streak.append(r)
                continue
            fired = [x[2] for x in streak if x[2] - streak[0][2] >= timedelta(seconds=hold)]
            if fired:
                want.append((run, streak[0][2], fired[0], streak[-1][2], len(streak)))
            streak = []
    got = sequences.held_intervals(frame(spark, rows), ["run"], "ts", "id", F.col("v") > 3, hold).collect()
    found = [(r["run"], r["active_since"], r["fired_at"], r["last_active"], r["samples"]) for r in got]
    assert sorted(found) == sorted(want)


def test_histogram_quantile_edges(spark):
    df = spark.createDataFrame([("low", 0.05), ("high", 500.0), ("mid", 4.0), ("mid", 4.5)], "g string, v double")
    filled = telemetry.histogram(df, ["g"], "v", telemetry.DURATION_BOUNDS)
    q = telemetry.histogram_quantile(0.5, F.col("cumulative"), telemetry.DURATION_BOUNDS)
    got = {r["g"]: r["q"] for r in filled.select("g", q.alias("q")).collect()}
    assert got["low"] == pytest.approx(0.05)
    assert got["high"] == 60.0
    assert got["mid"] == pytest.approx(4.0)
