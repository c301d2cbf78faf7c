"""Surrogate keys that last: a map from names to numbers that only grows.

Every load adds the names the map has not, numbered in order after the greatest key so far.
A name keeps its key whatever comes later, and needs no number of its own. Loads have
folders of their own; one that died is written again before it counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.sequences import numbered
from tallyport.sources.files import Storage


def _loads(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(f.split("/")[0].partition("=")[2]) for f in Storage(spark, path).matching("load=*/_SUCCESS"))


def read_keys(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """(key, name, load) of all complete loads."""
    schema = "key bigint, name string, load int"
    loads = _loads(spark, path)
    if not loads:
        return spark.createDataFrame([], schema).withColumnRenamed("name", name)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/load={n}" for n in loads])
    return rows.withColumnRenamed("name", name)


def extend_keys(spark: SparkSession, path: str, names: DataFrame, name: str) -> DataFrame:
    """The map after the names of a load have got keys; NULL is no name. One load at a time."""
    known, loads = read_keys(spark, path), _loads(spark, path)
    fresh = names.select(F.col(name).alias("name")).where("name IS NOT NULL").distinct()
    top = 0
    if loads:
        fresh = fresh.join(known.select("name"), "name", "left_anti")
        top = known.agg(F.max("key")).first()[0] or 0
    load = loads[-1] + 1 if loads else 0
    numbered(fresh, ["name"], "key", first=top + 1).select("key", "name").write.mode("overwrite").parquet(f"{path}/load={load}")
    return read_keys(spark, path, name)
