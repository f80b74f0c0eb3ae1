"""Streaming sources and sinks for call events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.messages import EVENT_SCHEMA, parse_message


def events_from_json(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Call events from JSON files; the file limit paces a replay and bounds each micro-batch."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return typed(reader.json(path))


def events_from_kafka(spark: SparkSession, servers: str, topic: str, from_latest: bool = True,
                      offsets_per_trigger: int | None = None) -> DataFrame:
    """Call events from a topic. A replay is ``from_latest=False`` with a new checkpoint folder."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", "latest" if from_latest else "earliest"))
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return typed(reader.load().select(parse_message(F.col("value").cast("string")).alias("e")).select("e.*"))


def typed(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.timestamp_seconds("timestamp"))


def publish(events: DataFrame, path: str) -> None:
    """Write a batch of events as JSON messages stamped with the time of production."""
    stamped = events.withColumn("produced_at", F.unix_micros(F.current_timestamp()) / 1_000_000)
    stamped.write.mode("append").json(path)


def publish_to_kafka(events: DataFrame, servers: str, topic: str) -> None:
    stamped = events.withColumn("produced_at", F.unix_micros(F.current_timestamp()) / 1_000_000)
    (stamped.select(F.col("phone_number").alias("key"), F.to_json(F.struct("*")).alias("value")).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def deduplicated(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated event ids that arrive within the watermark delay."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def append_parquet(stream: DataFrame, path: str, checkpoint: str, bounded: bool = True) -> StreamingQuery:
    """Append a stream to a parquet log, exactly once per checkpoint folder.

    ``bounded`` stops after everything available at the start. A new log is a new pair of folders.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer).start()
