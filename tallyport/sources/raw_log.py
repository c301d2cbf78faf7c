"""The raw event log: batch and streaming readers, publishing, end offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.sources.schemas import RAW_SCHEMA

# Bytes of a row group before compression: a large file of the log is read by many tasks.
ROW_GROUP_BYTES = 8 << 20

RAW_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp", "replay_count"]


def read_raw_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream the log from files; `max_files` bounds what one trigger takes."""
    reader = spark.readStream.schema(RAW_SCHEMA).format("parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int = 200_000,
    starting: str = "latest",
) -> DataFrame:
    """Stream the log from Kafka (needs the connector package on the classpath).

    A range of offsets that the broker no longer has ends the query with an error.
    """
    loaded = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", str(max_offsets))
        .option("failOnDataLoss", "true")
        .option("includeHeaders", "true")
        .load()
    )
    return from_kafka(loaded)


def read_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Whole topic, earliest to latest, committing nothing."""
    loaded = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .option("includeHeaders", "true")
        .load()
    )
    return from_kafka(loaded)


def from_kafka(records: DataFrame) -> DataFrame:
    replays = F.expr(
        "try_cast(cast(element_at(filter(headers, h -> h.key = 'replay_count'), 1).value as string) as int)"
    )
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.coalesce(replays, F.lit(0)).alias("replay_count"),
    )


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Keyed publish with acks=all; replay_count goes into a record header."""
    (
        messages.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.array(
                F.struct(
                    F.lit("replay_count").alias("key"),
                    F.col("replay_count").cast("string").cast("binary").alias("value"),
                )
            ).alias("headers"),
        )
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.acks", "all")
        .save()
    )


def publish_files(messages: DataFrame, path: str) -> None:
    """Append messages to a file-backed log."""
    messages.select(*RAW_COLUMNS).write.mode("append").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)


def end_offsets(log: DataFrame) -> DataFrame:
    """Next offset and message count of each partition of each topic."""
    return log.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("messages"),
    )
