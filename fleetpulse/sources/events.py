"""Telemetry derived from the ``events`` test table.

The test tables hold no telemetry, so each event stands for one reading: the user is the
machine, ``value`` and ``props.k`` drive the sensors, and the machine number gives the
neighbours. All of it is arithmetic that SQL engines agree on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions.expressions import simulated_rtt, unit_draw


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def utc(ts: str) -> Column:
    """Wall-clock column as an instant in UTC, whatever the session time zone is."""
    return F.timestamp_micros(
        F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")
    )


def machine_name(number: Column) -> Column:
    return F.concat(F.lit("M"), number.cast("string"))


def neighbours(machine: Column, machines: Column) -> Column:
    """One to three neighbours by number, the machine itself removed."""
    steps = [(7, 1), (13, 5), (31, 11)]
    names = [machine_name((machine * a + b) % machines) for a, b in steps]
    listed = F.slice(F.array(*names), F.lit(1), (F.lit(1) + machine % 3).cast("int"))
    return F.array_remove(listed, machine_name(machine))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry columns plus ``event_id`` (row key), ``latency_ms``, ``draw`` and ``edge_id``."""
    events = read_events(spark, sf_dir)
    machines = events.agg((F.max("user_id") + 1).alias("machines")).scalar()
    key, user = F.col("event_id"), F.col("user_id")
    k = F.from_json("props", "k int").getField("k")
    return events.select(
        key,
        machine_name(user).alias("machine_id"),
        F.col("event_type").alias("machine_type"),
        (F.lit(295.0) + key % 11).alias("air_temp"),
        (F.lit(305.0) + key % 13).alias("process_temp"),
        (F.lit(1250.0) + F.col("value") * 5).alias("rotational_speed"),
        F.col("value").alias("torque"),
        F.floor(k * 5 / 2).cast("int").alias("tool_wear"),
        (F.col("event_type") == "error").cast("int").alias("machine_failure"),
        utc("ts").alias("event_time"),
        neighbours(user, machines).alias("connected_to"),
        simulated_rtt(key).alias("latency_ms"),
        unit_draw(key, "sample").alias("draw"),
        F.concat(F.lit("edge-"), (user % 8).cast("string")).alias("edge_id"),
    )
