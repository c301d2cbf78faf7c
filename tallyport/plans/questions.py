"""The five analytical questions, on the wide table and on the star schema.

Every pair returns the same rows. Windows are half open and in UTC. A window of the
star is a range of date keys on the fact itself, so that the scan skips row groups;
dim_date is joined where its attributes are asked for. Facts are added up by their keys first
and the groups joined, so a dimension meets as many rows as it has keys, not as many as there
are facts. Spark broadcasts a dimension because its files are small, and would shuffle one
that is not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP_DRIVERS = 25


def revenue() -> Column:
    return F.round(F.sum("fare_amount"), 2).cast("double").alias("revenue")


def trip_count() -> Column:
    return F.count(F.lit(1)).alias("trips")


def mean(column: str, digits: int) -> Column:
    return F.round(F.sum(column).cast("double") / F.count(column), digits)


def completed(wide: DataFrame, start: str, end: str) -> DataFrame:
    """Completed trips of a window of the wide table."""
    return wide.where(
        (F.col("status") == "completed")
        & (F.col("event_time") >= F.lit(start).cast("timestamp"))
        & (F.col("event_time") < F.lit(end).cast("timestamp"))
    )


def by_keys(facts: DataFrame, *keys: Column | str) -> DataFrame:
    """Facts added up by their keys: what all answers are made of, but for distinct counts."""
    return facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_trips"), F.sum("fare_amount").alias("_fares"), F.count("fare_amount").alias("_fared"),
        F.sum("distance_km").alias("_km"), F.count("distance_km").alias("_measured"), F.count_if("is_surged").alias("_surged"),
    )


def summed_trips() -> Column:
    return F.sum("_trips").alias("trips")


def summed_revenue() -> Column:
    return F.round(F.sum("_fares"), 2).cast("double").alias("revenue")


def summed_mean(total: str, count: str, digits: int) -> Column:
    return F.round(F.sum(total).cast("double") / F.sum(count), digits)


def _key(day: str) -> int:
    return int(day.replace("-", ""))


def completed_facts(fact: DataFrame, start: str, end: str) -> DataFrame:
    """Completed facts of a window, as a range of date keys."""
    return fact.where(F.col("is_completed") & (F.col("date_key") >= _key(start)) & (F.col("date_key") < _key(end)))


def q1_wide(wide: DataFrame, start: str, end: str) -> DataFrame:
    """Revenue and trips by region by day."""
    return (
        completed(wide, start, end)
        .groupBy("region", F.to_date("event_time").alias("day"))
        .agg(trip_count(), revenue())
        .orderBy("region", "day")
    )


def q1_star(fact: DataFrame, dims: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    return (
        by_keys(completed_facts(fact, start, end), "city_key", "date_key")
        .join(dims["dim_city"], "city_key")
        .groupBy("region", "date_key")
        .agg(summed_trips(), summed_revenue())
        .join(dims["dim_date"], "date_key")
        .select("region", F.col("full_date").alias("day"), "trips", "revenue")
        .orderBy("region", "day")
    )


def q2_wide(wide: DataFrame, start: str, end: str) -> DataFrame:
    """Top drivers by revenue, ties by driver id."""
    return (
        completed(wide, start, end)
        .groupBy("driver_id")
        .agg(trip_count(), revenue())
        .orderBy(F.desc("revenue"), "driver_id")
        .limit(TOP_DRIVERS)
    )


def q2_star(fact: DataFrame, dims: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    return (
        completed_facts(fact, start, end)
        .groupBy("driver_key")
        .agg(trip_count(), revenue())
        .join(dims["dim_driver"], "driver_key")
        .select("driver_id", "trips", "revenue")
        .orderBy(F.desc("revenue"), "driver_id")
        .limit(TOP_DRIVERS)
    )


def q3_wide(wide: DataFrame, start: str, end: str) -> DataFrame:
    """Weekend against weekday by vehicle class."""
    return (
        completed(wide, start, end)
        .groupBy("vehicle_class", F.dayofweek("event_time").isin(1, 7).alias("is_weekend"))
        .agg(trip_count(), revenue(), mean("fare_amount", 2).alias("avg_fare"))
        .orderBy("vehicle_class", "is_weekend")
    )


def q3_star(fact: DataFrame, dims: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    return (
        by_keys(completed_facts(fact, start, end), "vehicle_key", "date_key")
        .join(dims["dim_vehicle"], "vehicle_key")
        .join(dims["dim_date"], "date_key")
        .groupBy("vehicle_class", "is_weekend")
        .agg(summed_trips(), summed_revenue(), summed_mean("_fares", "_fared", 2).alias("avg_fare"))
        .orderBy("vehicle_class", "is_weekend")
    )


def q4_wide(wide: DataFrame, start: str, end: str) -> DataFrame:
    """Demand by city by hour of day."""
    return (
        completed(wide, start, end)
        .groupBy("city_name", F.hour("event_time").alias("hour_of_day"))
        .agg(trip_count(), mean("distance_km", 3).alias("avg_distance"), revenue())
        .orderBy("city_name", "hour_of_day")
    )


def q4_star(fact: DataFrame, dims: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    return (
        by_keys(completed_facts(fact, start, end), "city_key", "hour_of_day")
        .join(dims["dim_city"], "city_key")
        .groupBy("city_name", "hour_of_day")
        .agg(summed_trips(), summed_mean("_km", "_measured", 3).alias("avg_distance"), summed_revenue())
        .orderBy("city_name", "hour_of_day")
    )


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2).alias("surge_pct")


def q5_wide(wide: DataFrame, start: str, end: str) -> DataFrame:
    """Share of surged trips by city by ISO week."""
    year = F.extract(F.lit("YEAROFWEEK"), F.col("event_time")).cast("int")
    surged = F.count_if(F.col("surge_multiplier") > 1.0)
    return (
        completed(wide, start, end)
        .groupBy("city_name", year.alias("iso_year"), F.weekofyear("event_time").alias("iso_week"))
        .agg(trip_count(), surged.alias("surged_trips"), _share(surged, F.count(F.lit(1))), revenue())
        .orderBy("city_name", "iso_year", "iso_week")
    )


def q5_star(fact: DataFrame, dims: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    surged = F.sum("_surged")
    return (
        by_keys(completed_facts(fact, start, end), "city_key", "date_key")
        .join(dims["dim_city"], "city_key")
        .join(dims["dim_date"], "date_key")
        .groupBy("city_name", "iso_year", "iso_week")
        .agg(summed_trips(), surged.alias("surged_trips"), _share(surged, F.sum("_trips")), summed_revenue())
        .orderBy("city_name", "iso_year", "iso_week")
    )


PAIRS: dict[str, tuple[Callable[..., DataFrame], Callable[..., DataFrame]]] = {
    "q1": (q1_wide, q1_star),
    "q2": (q2_wide, q2_star),
    "q3": (q3_wide, q3_star),
    "q4": (q4_wide, q4_star),
    "q5": (q5_wide, q5_star),
}


def normalised(df: DataFrame) -> DataFrame:
    """Rows as text: numbers with a fraction at 2 decimals, dates in ISO form."""
    def text(name: str, kind: str) -> Column:
        if kind == "double" or kind == "float" or kind.startswith("decimal"):
            return F.format_string("%.2f", F.col(name).cast("double")).alias(name)
        return F.col(name).cast("string").alias(name)

    return df.select(*[text(name, kind) for name, kind in df.dtypes])


def diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference of two results: rows that one side has more often.

    Both sides are stacked and counted with opposite sign: one shuffle, and NULLs
    compare as equal.
    """
    left = normalised(a).withColumn("_side", F.lit(1))
    right = normalised(b).select(*a.columns).withColumn("_side", F.lit(-1))
    return (
        left.unionByName(right)
        .groupBy(*a.columns)
        .agg(F.sum("_side").alias("surplus"))
        .where(F.col("surplus") != 0)
    )


def compare(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Row counts of both sides and the number of differing rows."""
    zero = F.lit(0).cast("bigint")

    def part(rows: DataFrame, **counts: Column) -> DataFrame:
        columns = ("wide_rows", "star_rows", "only_wide", "only_star")
        return rows.agg(F.lit(name).alias("query"), *[counts.get(c, F.max(zero)).alias(c) for c in columns])

    surplus = F.col("surplus")
    parts = (
        part(a, wide_rows=F.count(F.lit(1)))
        .unionByName(part(b, star_rows=F.count(F.lit(1))))
        .unionByName(
            part(
                diff(a, b),
                only_wide=F.sum(F.greatest(surplus, zero)),
                only_star=F.sum(F.greatest(-surplus, zero)),
            )
        )
    )
    summed = parts.groupBy("query").agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("wide_rows", "star_rows", "only_wide", "only_star")]
    )
    same = (F.col("only_wide") == 0) & (F.col("only_star") == 0) & (F.col("wide_rows") == F.col("star_rows"))
    return summed.withColumn("equivalent", same)
