"""Ordered work over long series, cut into sampled ranges or spans of time.

A window partitioned by series alone would put a hot series into one task. Here the
partition is (series, range), with ranges that Spark balances by sampling: a series gets as
many as its rows need, whatever its rate. What a range needs from earlier rows comes from a
summary of one row a range: the last row before it (`with_previous`), the latest mark
(`with_last_mark`), the rise or hold that is still open at its end (`longest_rising_run`,
`held_intervals`). Frames take markers from the span before (`_with_frames`). Results equal
those of the uncut window. NULL is a series like any other; rows without a time are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyport.functions.ranges import in_ranges, join_same
from tallyport.session import new_folder


def in_series_ranges(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds `_bucket`, the sampled range of (series, order) of each row with a time; stored.

    `order` starts with the time and is total inside a series.
    """
    return in_ranges(df.where(F.col(order[0]).isNotNull()), [*by, *order], "_bucket")


def _with_carry(df: DataFrame, by: list[str], local: Column, summary: Column, carry, out: str) -> DataFrame:
    """Local value of each row, or else what earlier buckets hand over."""
    over_buckets = W.partitionBy(*by).orderBy("_bucket")
    handed = (
        df.groupBy(*by, "_bucket")
        .agg(summary.alias("_summary"))
        .select(*by, "_bucket", carry(F.col("_summary"), over_buckets).alias("_carry"))
    )
    return (
        join_same(df.withColumn("_local", local), handed, [*by, "_bucket"])
        .withColumn(out, F.coalesce("_local", "_carry"))
        .drop("_local", "_carry")
    )


def with_previous(df: DataFrame, by: list[str], order: list[str], columns: list[str], out: str) -> DataFrame:
    """Adds struct `out`: `columns` of the row before, NULL on the first row of a series.

    `df` must come from `in_series_ranges` with the same series and order.
    """
    value = F.struct(*columns)
    local = F.lag(value).over(W.partitionBy(*by, "_bucket").orderBy(*order))
    return _with_carry(
        df, by, local, F.max_by(value, F.struct(*order)), lambda s, w: F.lag(s).over(w), out
    )


def with_last_mark(df: DataFrame, by: list[str], order: list[str], mark: Column, out: str) -> DataFrame:
    """Adds `out`: the order key of the latest row up to this one where `mark` holds."""
    key = F.when(mark, F.struct(*order))
    rows = W.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return _with_carry(
        df,
        by,
        F.max(key).over(rows),
        F.max(key),
        lambda s, w: F.max(s).over(w.rowsBetween(W.unboundedPreceding, -1)),
        out,
    )


def numbered(df: DataFrame, order: list[str], out: str, first: int = 1, ranges: int | None = None) -> DataFrame:
    """Rows of `df` with consecutive numbers in `order`, without ordering them in one task.

    Ranges of the order are stored sorted; a row's number is its place in its range plus
    the rows of the ranges before, of which there is one count a range. Without `ranges` Spark
    draws small ones together by their compressed size, which for long texts is a small part of what a sort holds.
    """
    path = new_folder(df.sparkSession, "numbered")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    df.repartitionByRange(*([] if ranges is None else [ranges]), *order).sortWithinPartitions(*order).withColumns(
        {"_range": F.spark_partition_id(), "_place": place}
    ).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(starts, "_range").withColumn(out, F.col("_before") + F.col("_place") + first).drop(
        "_range", "_place", "_before"
    )


def longest_rising_run(df: DataFrame, by: list[str], ts: str, value: str, tie: str) -> DataFrame:
    """Length of the longest strictly rising run (n rises count n, none counts 0).

    A scan: every range of a series is summed up by its rows, its first and last value, the
    rises it begins with, those it ends with and the longest inside. Ranges that rise from
    end to end pass on what they were handed, so the open run before a range is a running
    sum since the last range that did not.
    """
    order = [ts, tie]
    rows = in_series_ranges(df, by, order)
    inside = W.partitionBy(*by, "_bucket").orderBy(*order)
    first = F.row_number().over(inside) == 1
    rises = rows.withColumn("_first", first).withColumn(
        "_rises", F.when(F.col("_first"), False).otherwise(F.coalesce(F.col(value) > F.lag(value).over(inside), F.lit(False)))
    )
    # Breaks before a row number the runs of a range; run 0 is the one it begins with.
    breaks = F.sum((~F.col("_rises") & ~F.col("_first")).cast("bigint")).over(inside.rowsBetween(W.unboundedPreceding, 0))
    key = F.struct(*order)
    runs = rises.withColumn("_run", breaks).groupBy(*by, "_bucket", "_run").agg(
        F.sum(F.col("_rises").cast("bigint")).alias("_length"),
        F.min_by(F.struct(value), key).alias("_from"), F.max_by(F.struct(value), key).alias("_to"),
    )
    parts = runs.groupBy(*by, "_bucket").agg(
        F.max("_length").alias("_longest"), F.max("_run").alias("_breaks"),
        F.min_by("_length", "_run").alias("_prefix"), F.max_by("_length", "_run").alias("_suffix"),
        F.min_by("_from", "_run").alias("_from"), F.max_by("_to", "_run").alias("_to"),
    )
    ranges = W.partitionBy(*by).orderBy("_bucket")
    joined = F.coalesce(F.col(f"_from.{value}") > F.lag("_to").over(ranges)[value], F.lit(False))
    # A chain of ranges through which one run goes on; a range with a break begins the next chain.
    linked = parts.withColumn("_joined", joined).withColumn(
        "_opens", F.when(F.col("_joined") & (F.coalesce(F.lag("_breaks").over(ranges), F.lit(1)) == 0), 0).otherwise(1)
    )
    chained = linked.withColumn("_chain", F.sum("_opens").over(ranges.rowsBetween(W.unboundedPreceding, 0)))
    earlier = W.partitionBy(*by, "_chain").orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    # What the chain's first range was handed: the open end of the range before it, if its first value rises from that.
    handed = F.when(F.col("_joined"), 1 + F.lag("_suffix").over(ranges)).otherwise(0)
    start = F.when(F.col("_opens") == 1, handed).otherwise(1)
    through = chained.withColumn("_start", start).withColumn("_open", F.sum(F.col("_start") + F.col("_prefix")).over(earlier))
    return through.groupBy(*by).agg(F.max(F.greatest("_open", "_longest")).alias("longest_rising_run"))


def _with_frames(
    df: DataFrame, by: list[str], ts: str, seconds: int, parts: dict[str, tuple[Callable[[Column], Column], Column, Column]]
) -> DataFrame:
    """Adds what each of `parts` comes to over the last `seconds` up to each row, in two halves.

    Linear in the rows. Time is cut into spans as long as a frame, so a frame is the end of
    one span and the beginning of the next: `_head_<part>` is the aggregate over the row's
    own span up to its instant, `_tail_<part>` that over the span before from the frame's
    start on. Nothing is subtracted, so no digits are lost to rows outside the frame. A part
    is its aggregate, its value as head and its value as tail; values may use `_micros` and
    `_into`, the microseconds since the span began. Rows at one instant share a frame. A
    marker at the start of its frame takes each row to the span before, so nothing is joined.
    """
    span = max(1, seconds * 1_000_000)
    rows = (
        df.where(F.col(ts).isNotNull()).withColumn("_micros", F.unix_micros(ts))
        .withColumn("_into", F.pmod("_micros", F.lit(span)))
        .withColumn("_span", F.expr(f"(_micros - _into) div {span}"))
    )
    series = W.partitionBy(*by, "_span")
    up_to = series.orderBy("_micros").rangeBetween(W.unboundedPreceding, W.currentRow)
    own = rows.withColumns({f"_head_{n}": agg(head).over(up_to) for n, (agg, head, _) in parts.items()})
    ends = rows.select(
        *by, "_span", F.col("_micros").alias("_at"), F.lit(None).cast(own.schema).alias("_row"),
        *[tail.alias(f"_in_{n}") for n, (_, _, tail) in parts.items()],
    )
    marks = own.select(
        *by, (F.col("_span") - 1).alias("_span"), (F.col("_micros") - span).alias("_at"), F.struct("*").alias("_row"),
        *[F.lit(None).cast(ends.schema[f"_in_{n}"].dataType).alias(f"_in_{n}") for n in parts],
    )
    since = series.orderBy(F.desc("_at")).rangeBetween(W.unboundedPreceding, W.currentRow)
    both = ends.unionByName(marks).withColumns({f"_tail_{n}": agg(F.col(f"_in_{n}")).over(since) for n, (agg, _, _) in parts.items()})
    return both.where("_row IS NOT NULL").select("_row.*", *[f"_tail_{n}" for n in parts])


def _frame_columns(parts: dict) -> list[str]:
    """Columns that `_with_frames` adds."""
    return ["_micros", "_into", "_span", *[f"_{half}_{n}" for half in ("head", "tail") for n in parts]]


def trailing_slope(df: DataFrame, by: list[str], ts: str, value: str, seconds: int) -> DataFrame:
    """Least-squares slope per second over the last `seconds`; frames of one point are left out.

    From sums of x, y, xy and xx. x is whole microseconds from the start of the row's span
    and its sums are exact, so points at one instant, which have no slope, are told from
    points a microsecond apart. y is taken from a value of its span, so an offset costs no digits.
    """
    known = F.col(value).isNotNull()
    y = F.col(value).cast("double")
    whole = lambda c: F.when(known, c.cast("decimal(19,0)"))
    head, tail = whole(F.col("_into")), whole(F.col("_into") - max(1, seconds * 1_000_000))
    # The least finite value of the span; the window is over columns that `_with_frames` adds.
    level = F.min(F.when(F.abs(y) < float("inf"), y)).over(W.partitionBy(*by, "_span"))
    above = F.when(known, y - F.coalesce(level, F.lit(0.0)))
    parts = {
        "n": (F.count, y, y), "x": (F.sum, head, tail), "xx": (F.sum, head * head, tail * tail),
        "level": (F.max, level, level), "y": (F.sum, above, above),
        "xy": (F.sum, head.cast("double") * above, tail.cast("double") * above),
    }
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    step = F.coalesce(F.col("_tail_level") - F.col("_head_level"), F.lit(0.0))
    framed = (
        _with_frames(df, by, ts, seconds, parts)
        .withColumn("points", zero("_head_n") + zero("_tail_n"))
        .where("points >= 2")
        .withColumns({
            "_x": zero("_head_x") + zero("_tail_x"), "_xx": zero("_head_xx") + zero("_tail_xx"),
            "_y": zero("_head_y") + zero("_tail_y") + step * zero("_tail_n"),
            "_xy": zero("_head_xy") + zero("_tail_xy") + step * zero("_tail_x").cast("double"),
        })
        .withColumn("_mid", F.expr("(_x div points)").cast("decimal(19,0)"))
        .withColumn("_rest", (F.col("_x") - F.col("_mid") * F.col("points")).cast("double"))
        # Exact, and zero only if all points are at one instant.
        .withColumn("_apart", F.col("_xx") - 2 * F.col("_mid") * F.col("_x") + F.col("_mid") * F.col("_mid") * F.col("points"))
    )
    n, rest = F.col("points"), F.col("_rest")
    sxx = F.col("_apart").cast("double") - rest * rest / n
    sxy = F.col("_xy") - F.col("_mid").cast("double") * F.col("_y") - rest * F.col("_y") / n
    return framed.withColumn("slope", F.when(F.col("_apart") > 0, sxy / sxx * 1e6)).drop(
        "_x", "_xx", "_y", "_xy", "_mid", "_rest", "_apart", *_frame_columns(parts)
    )


def counter_rate(df: DataFrame, by: list[str], ts: str, value: str, tie: str, seconds: int) -> DataFrame:
    """Increase and rate of a counter over the last `seconds`, allowing for resets.

    A drop means the counter restarted, so the new value is the whole step. The
    increase is the sum of steps between samples inside the frame; nothing is
    extrapolated to the frame's edges.
    """
    order = [ts, tie]
    # Steps go from one known value to the next, over samples without a value.
    known = in_series_ranges(df.where(F.col(value).isNotNull()), by, order)
    stepped = with_previous(known, by, order, [value], "_prev").drop("_bucket")
    before, now = F.col(f"_prev.{value}"), F.col(value)
    step = F.when(before.isNull(), 0.0).when(now >= before, now - before).otherwise(now).cast("double")
    stepped = stepped.withColumn("_step", step).drop("_prev").unionByName(
        df.where(F.col(value).isNull()).withColumn("_step", F.lit(0.0))
    )
    # The first known sample's step reaches out of the frame.
    first = F.when(now.isNotNull(), F.struct(F.col("_micros"), F.col(tie).alias("_tie"), F.col("_step")))
    parts = {
        "step": (F.sum, F.col("_step"), F.col("_step")), "n": (F.count, now, now), "first": (F.min, first, first),
    }
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (
        _with_frames(stepped, by, ts, seconds, parts)
        .withColumn("samples", zero("_head_n") + zero("_tail_n"))
        .withColumn(
            "increase",
            zero("_head_step") + zero("_tail_step") - F.coalesce(F.coalesce("_tail_first", "_head_first")["_step"], F.lit(0.0)),
        )
        .withColumn("rate", F.col("increase") / seconds)
        .drop("_step", *_frame_columns(parts))
    )


def vector_increase(df: DataFrame, by: list[str], ts: str, vector: str, size: int, tie: str, seconds: int) -> DataFrame:
    """Adds `increase`: what each of `size` counters in an array grew by over the last `seconds`.

    As `counter_rate`, for the buckets of a histogram at once: a bucket that drops has
    restarted, and samples without counters are stepped over.
    """
    order = [ts, tie]
    known = in_series_ranges(df.where(F.col(vector).isNotNull()), by, order)
    stepped = with_previous(known, by, order, [vector], "_prev").drop("_bucket")
    step = F.zip_with(
        F.col(f"_prev.{vector}"), F.col(vector), lambda before, now: F.when(now >= before, now - before).otherwise(now)
    )
    none = F.array(*[F.lit(0).cast("bigint")] * size)
    stepped = stepped.withColumn("_steps", F.coalesce(step.cast("array<bigint>"), none)).drop("_prev")
    each = [F.col("_steps")[i] for i in range(size)]
    first = F.struct(F.col("_micros"), F.col(tie).alias("_tie"), F.col("_steps"))
    parts = {**{f"s{i}": (F.sum, c, c) for i, c in enumerate(each)}, "first": (F.min, first, first)}
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    began = F.coalesce("_tail_first", "_head_first")["_steps"]
    grown = F.array(*[zero(f"_head_s{i}") + zero(f"_tail_s{i}") - began[i] for i in range(size)])
    return _with_frames(stepped, by, ts, seconds, parts).withColumn("increase", grown).drop("_steps", *_frame_columns(parts))


def held_intervals(
    df: DataFrame, by: list[str], ts: str, tie: str, condition: Column, hold_seconds: int
) -> DataFrame:
    """Intervals over which `condition` held long enough to fire.

    One row per interval that fired: first true sample, the sample at which it had
    held for `hold_seconds`, last true sample, number of true samples.
    """
    order = [ts, tie]
    rows = in_series_ranges(df.withColumn("_on", F.coalesce(condition, F.lit(False))), by, order)
    marked = with_last_mark(rows, by, order, ~F.col("_on"), "_off")
    island = F.coalesce(
        F.concat_ws(":", F.unix_micros(F.col(f"_off.{ts}")).cast("string"), F.col(f"_off.{tie}").cast("string")),
        F.lit(""),
    )
    on = marked.where("_on").withColumn("_island", island).select(*by, "_island", "_bucket", ts)
    whole = W.partitionBy(*by, "_island")
    held_by = F.timestamp_micros(F.unix_micros("_start") + hold_seconds * 1_000_000)
    parts = (
        on.groupBy(*by, "_island", "_bucket")
        .agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.min("_lo").over(whole))
        .withColumn("_end", F.max("_hi").over(whole))
        .withColumn("_samples", F.sum("_rows").over(whole))
        .withColumn("_fires", F.min(F.when(F.col("_hi") >= held_by, F.col("_bucket"))).over(whole))
        .where(F.col("_bucket") == F.col("_fires"))
        .select(*by, "_island", "_bucket", "_start", "_end", "_samples")
    )
    return (
        join_same(on, parts, [*by, "_island", "_bucket"])
        .where(F.col(ts) >= held_by)
        .groupBy(*by, "_island")
        .agg(
            F.first("_start").alias("active_since"),
            F.min(ts).alias("fired_at"),
            F.first("_end").alias("last_active"),
            F.first("_samples").alias("samples"),
        )
        .drop("_island")
    )
