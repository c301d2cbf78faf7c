"""Wide table and star schema from the same trips.

Both forms are kept in folders by period and sorted by time inside their files, so that
a window reads only its folders and its row groups. Dimensions are a few files of a few
rows; Spark broadcasts them by their size on disk and would shuffle one that grew.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.sequences import numbered
from tallyport.operators.key_map import extend_keys
from tallyport.session import new_folder, together
from tallyport.sources.adapters import WIDE_COLUMNS

# Driver tenure bands, and days added to dim_date on either side.
TENURE_BANDS = ["new", "established", "veteran"]
DATE_PADDING = 2

FACT_COLUMNS = [
    "trip_id", "date_key", "driver_key", "duration_sec", "pickup_zone_id", "fare_amount", "distance_km",
    "surge_multiplier", "city_key", "vehicle_key", "payment_key", "hour_of_day", "is_completed", "is_surged",
]


@dataclass(frozen=True)
class Labels:
    """Values of a corpus that mean premium vehicle and cash payment."""

    premium: tuple[str, ...]
    cash: tuple[str, ...]


TRIP_LABELS = Labels(premium=("1-URGENT", "2-HIGH"), cash=("R",))
RIDE_LABELS = Labels(premium=("xl", "black"), cash=("cash",))


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def dim_date(spark: SparkSession, start: str, end: str, padding: int = DATE_PADDING) -> DataFrame:
    """Calendar of [start, end) with a few days more on either side."""
    first, last = F.date_sub(F.lit(start).cast("date"), padding), F.date_add(F.lit(end).cast("date"), padding)
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("iso_week"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def enumerated(df: DataFrame, natural: str, key: str, attributes: list[str]) -> DataFrame:
    """Distinct values of `natural`, numbered from 1 in order, with their attributes."""
    values = df.groupBy(natural).agg(*[F.max(a).alias(a) for a in attributes]) if attributes else df.select(
        natural
    ).distinct()
    return numbered(values, [natural], key).select(F.col(key).cast("int").alias(key), natural, *attributes)


def dim_city(trips: DataFrame) -> DataFrame:
    return enumerated(trips, "city_id", "city_key", ["city_name", "region"]).withColumn(
        "country", F.col("city_name")
    )


def dim_vehicle(trips: DataFrame, labels: Labels) -> DataFrame:
    tier = F.when(F.col("vehicle_class").isin(*labels.premium), "premium").otherwise("standard")
    return enumerated(trips, "vehicle_class", "vehicle_key", []).withColumn("tier", tier)


def dim_payment(trips: DataFrame, labels: Labels) -> DataFrame:
    return enumerated(trips, "payment_type", "payment_key", []).withColumn(
        "is_cashless", ~F.col("payment_type").isin(*labels.cash)
    )


def dim_driver(keys: DataFrame) -> DataFrame:
    """Drivers by their lasting keys (key, driver_id); any text may be a driver's id."""
    band = F.element_at(F.array(*map(F.lit, TENURE_BANDS)), (F.col("key") % len(TENURE_BANDS) + 1).cast("int"))
    return keys.select(F.col("key").alias("driver_key"), "driver_id", band.alias("tenure_band"))


def fact(trips: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Narrow fact rows: surrogate keys for names, calendar and flags worked out once."""
    return (
        trips.join(dims["dim_city"].select("city_id", "city_key"), "city_id", "left")
        .join(dims["dim_vehicle"].select("vehicle_class", "vehicle_key"), "vehicle_class", "left")
        .join(dims["dim_payment"].select("payment_type", "payment_key"), "payment_type", "left")
        .withColumn("date_key", date_key(F.col("event_time")))
        .join(dims["dim_driver"].select("driver_id", "driver_key"), "driver_id", "left")
        .withColumn("hour_of_day", F.hour("event_time"))
        .withColumn("is_completed", F.col("status") == "completed")
        .withColumn("is_surged", F.col("surge_multiplier") > 1.0)
        .select(*FACT_COLUMNS)
    )


# Days a folder of a large table covers, finest first, and the rows it should hold.
GRAINS = {"day": ("yyyyMMdd", 1), "month": ("yyyyMM01", 30), "year": ("yyyy0101", 365)}
ROWS_PER_FOLDER = 2_000_000


def grain_for(rows: int, start: str, end: str) -> str:
    """Finest folder that still holds enough rows, so small data is not cut to pieces."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days
    per_day = rows / max(days, 1)
    return next((g for g, (_, covers) in GRAINS.items() if per_day * covers >= ROWS_PER_FOLDER), "year")


def period(day: Column, grain: str) -> Column:
    """Date key of the first day of the folder a day belongs to."""
    return F.date_format(day, GRAINS[grain][0]).cast("int")


def write_by_period(
    df: DataFrame, period_key: Column, order: Column, path: str, columns: list[Column | str] | None = None
) -> None:
    """Folder per period, rows in time order; a very large folder is split over tasks.

    `columns` are made of the rows where they are written: only what they are made of is moved and sorted.
    """
    (
        df.withColumn("period", period_key)
        .hint("rebalance", "period")
        .sortWithinPartitions("period", order)
        .select(*columns or df.columns, "period")
        .write.mode("overwrite")
        .partitionBy("period")
        .parquet(path)
    )


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    grain: str
    _tables: dict[str, DataFrame] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        """A table of the warehouse; its files are listed once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.root}/{name}")
        return self._tables[name]

    @property
    def wide(self) -> DataFrame:
        return self.read("trips_wide")

    @property
    def fact(self) -> DataFrame:
        return self.read("fact_trip")

    def dims(self) -> dict[str, DataFrame]:
        return {n: self.read(n) for n in ("dim_date", "dim_city", "dim_driver", "dim_vehicle", "dim_payment")}

    def window(self, name: str, start: str, end: str) -> DataFrame:
        """The folders of a table that can hold rows of [start, end)."""
        first = period(F.lit(start).cast("date"), self.grain)
        last = period(F.lit(end).cast("date"), self.grain)
        return self.read(name).where(F.col("period").between(first, last)).drop("period")


def load(
    spark: SparkSession, trips: DataFrame, rows: int, labels: Labels, start: str, end: str, name: str,
    at: Column | None = None, columns: list[Column] | None = None,
) -> Warehouse:
    """Write both forms of a corpus of about `rows` trips. The fact is built from the
    written wide rows, so the source is read and joined once.

    `trips` are wide rows, or narrower ones with their time `at` and the wide `columns` to be made of them.
    """
    at = F.col("event_time") if at is None else at
    house = Warehouse(spark, new_folder(spark, f"warehouse-{name}"), grain_for(rows, start, end))
    write_by_period(
        trips, period(at, house.grain), at, f"{house.root}/trips_wide", columns or WIDE_COLUMNS
    )
    wide = house.wide
    made = {
        "dim_date": dim_date(spark, start, end),
        "dim_city": dim_city(wide),
        "dim_driver": dim_driver(extend_keys(spark, f"{house.root}/driver_keys", wide, "driver_id")),
        "dim_vehicle": dim_vehicle(wide, labels),
        "dim_payment": dim_payment(wide, labels),
    }
    together(
        spark,
        [partial(d.write.mode("overwrite").parquet, f"{house.root}/{dim_name}") for dim_name, d in made.items()],
    )
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    write_by_period(fact(wide, house.dims()), period(day, house.grain), F.col("date_key"), f"{house.root}/fact_trip")
    return house


def fk_violations(fact_rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key is missing in a dimension, per dimension.

    Keys are counted before the anti-join, so it handles distinct keys and not fact rows.
    """
    out = None
    for dim, key in (
        ("dim_city", "city_key"), ("dim_date", "date_key"), ("dim_driver", "driver_key"),
        ("dim_vehicle", "vehicle_key"), ("dim_payment", "payment_key"),
    ):
        used = fact_rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        orphans = used.join(dims[dim].select(key), key, "left_anti").agg(
            F.lit(dim).alias("dimension"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"),
            F.count(F.lit(1)).alias("orphan_keys"),
        )
        out = orphans if out is None else out.unionByName(orphans)
    return out


def storage_report(house: Warehouse) -> DataFrame:
    """Files, bytes and rows of each table, and the fact's size relative to the wide table."""
    out = None
    for name in ("trips_wide", "fact_trip", "dim_date", "dim_city", "dim_driver", "dim_vehicle", "dim_payment"):
        files = (
            house.read(name)
            .groupBy(F.col("_metadata.file_path").alias("_file"))
            .agg(F.max("_metadata.file_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        )
        one = files.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("files"),
            F.sum("_bytes").alias("bytes"),
            F.sum("_rows").alias("rows"),
        )
        out = one if out is None else out.unionByName(one)
    wide_bytes = out.where("table_name = 'trips_wide'").select(F.col("bytes").alias("_wide")).scalar()
    return out.withColumn("share_of_wide", F.round(F.col("bytes") / wide_bytes, 4))
