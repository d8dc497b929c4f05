"""Writing archives, history files and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.expressions import epoch_seconds
from fleetpulse.operators.ingest import wire_struct
from fleetpulse.schema import HISTORY_COLUMNS

# Fixed value: records of an archive file where many small ones are wanted.
SMALL_FILE_ROWS = 500

# Messages of a compressed file, which one task reads whole: some 15 MB.
MESSAGE_FILE_ROWS = 500_000


def archive_rows(telemetry: DataFrame) -> DataFrame:
    """Telemetry under its wire names, the layout of the archive."""
    return telemetry.select(wire_struct(telemetry).alias("r")).select("r.*")


def write_archive(telemetry: DataFrame, path: str, file_rows: int | None = None) -> None:
    """Append to the archive. A file holds a partition, or at most ``file_rows`` records."""
    rows = archive_rows(telemetry)
    rows.write.mode("append").option("maxRecordsPerFile", file_rows or 0).json(path)


def archive_stream(
    telemetry: DataFrame, path: str, checkpoint: str, file_rows: int | None = None, **trigger
):
    """Streaming archive. The commit log in the folder is what readers go by."""
    writer = (
        archive_rows(telemetry)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", file_rows or 0)
        .outputMode("append")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def history_rows(cloud: DataFrame) -> DataFrame:
    """Cloud-routed readings in the column order of the history file."""
    return cloud.select(
        *[
            (epoch_seconds(F.col(c)) if c == "event_time" else F.col(c)).alias(w)
            for w, c in HISTORY_COLUMNS.items()
        ]
    )


def write_history(cloud: DataFrame, path: str) -> None:
    """Append to the history. Missing values are written as blanks."""
    history_rows(cloud).write.mode("append").option("header", True).option("nullValue", "").csv(path)


def history_stream(cloud: DataFrame, path: str, checkpoint: str, **trigger):
    writer = (
        history_rows(cloud)
        .writeStream.format("csv")
        .option("path", path)
        .option("header", True)
        .option("nullValue", "")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def as_messages(df: DataFrame, value=None) -> DataFrame:
    """One JSON message per row. ``value`` defaults to a struct of all columns."""
    body = F.struct(*df.columns) if value is None else value
    return df.select(F.to_json(body).alias("value"))


def write_messages(
    messages: DataFrame,
    topic: str,
    *,
    fmt: str = "kafka",
    servers: str = "localhost:9092",
    path: str | None = None,
    file_rows: int = MESSAGE_FILE_ROWS,
) -> None:
    """Send messages to a Kafka topic, or add them to ``path/topic=<name>/`` as text files.

    The files are compressed, and hold at most ``file_rows`` messages each.
    """
    if fmt == "kafka":
        (
            messages.select("value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .save()
        )
    elif fmt == "files":
        (
            messages.select("value")
            .write.mode("append")
            .option("maxRecordsPerFile", file_rows)
            .text(f"{path}/topic={topic}", compression="gzip")
        )
    else:
        raise ValueError(f"unknown message format: {fmt}")
