"""Reading messages, files and archives, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.operators.ingest import normalise, telemetry_columns
from fleetpulse.schema import (
    CLOUD_SCHEMA,
    EDGE_ALERT_SCHEMA,
    FEEDBACK_SCHEMA,
    HISTORY_COLUMNS,
    HISTORY_SCHEMA,
    SEED_SCHEMA,
    WIRE_SCHEMA,
)

# Topic names.
RAW_TOPIC = "raw-sensor-data"
ALERT_TOPIC = "edge-alerts"
CLOUD_TOPIC = "cloud-data"
CONTROLLER_TOPIC = "controller-metrics"


def read_messages(
    spark: SparkSession,
    topics: list[str],
    *,
    fmt: str = "kafka",
    servers: str = "localhost:9092",
    path: str | None = None,
    streaming: bool = True,
    starting: str = "latest",
    max_files: int | None = None,
    max_offsets: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Messages with ``topic`` and ``value``.

    ``max_files`` and ``max_offsets`` bound what a micro-batch takes from files or from Kafka, so
    that the first batch after an outage is no larger than others.

    ``fmt="kafka"`` subscribes to the topics (the Kafka package must be on the class path).
    ``fmt="files"`` reads text files, one message per line, below ``path/topic=<name>/``.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        if not streaming and starting == "latest":
            starting = "earliest"
        if streaming and max_offsets:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets)
        return (
            reader.format("kafka")
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting)
            .load()
            .select("topic", F.col("value").cast("string").alias("value"))
        )
    if fmt == "files":
        reader = reader.format("text").schema("value string, topic string")
        if streaming and max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        # Topic folders are partitions, so the topic filter prunes whole folders.
        return reader.load(path).where(F.col("topic").isin(topics)).select("topic", "value")
    raise ValueError(f"unknown message format: {fmt}")


def first_of_each(messages: DataFrame, within: str) -> DataFrame:
    """A stream of messages without those whose id came before on their topic.

    Ids are kept for at least ``within`` from their arrival, so state does not grow with the history;
    what is sent again later than that counts as new. Time is that of arrival: no message is late.
    Messages without a ``message_id`` are all kept.
    """
    named = F.coalesce(F.get_json_object("value", "$.message_id"), F.expr("uuid()"))
    arrived = messages.withColumns({"_id": named, "_arrived": F.current_timestamp()})
    first = arrived.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["topic", "_id"])
    return first.drop("_id", "_arrived")


def for_topic(messages: DataFrame, topic: str) -> DataFrame:
    return messages.where(F.col("topic") == topic)


def parse_cloud(messages: DataFrame) -> DataFrame:
    """Readings sent to the cloud, with their routing tags."""
    data = messages.select(F.from_json("value", CLOUD_SCHEMA).alias("d")).select("d.*")
    return data.select(*telemetry_columns(), "routing", "latency_ms")


def parse_alerts(messages: DataFrame) -> DataFrame:
    return messages.select(F.from_json("value", EDGE_ALERT_SCHEMA).alias("a")).select("a.*")


def parse_feedback(messages: DataFrame) -> DataFrame:
    """Retrain notices. Other messages on the topic are ignored."""
    parsed = messages.select(F.from_json("value", FEEDBACK_SCHEMA).alias("f")).select("f.*")
    return parsed.where(F.col("type") == "retrain_complete")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines archive as telemetry.

    For a folder written by a stream Spark reads only files its commit log names, so a reader
    never sees a file that is half written.
    """
    return normalise(spark.read.schema(WIRE_SCHEMA).json(path))


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    seed = spark.read.schema(SEED_SCHEMA).option("header", True).csv(path)
    full = seed.withColumn("timestamp", F.lit(None).cast("double")).withColumn(
        "connected_to", F.lit(None).cast("array<string>")
    )
    return normalise(full).drop("event_time", "connected_to")


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(HISTORY_SCHEMA).option("header", True).csv(path)
    return rows.select(
        F.timestamp_micros(F.round(F.col("timestamp") * 1e6).cast("bigint")).alias("event_time"),
        *[F.col(f"`{w}`").alias(c) for w, c in HISTORY_COLUMNS.items() if c != "event_time"],
    )
