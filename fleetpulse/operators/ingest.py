"""From raw messages to telemetry rows, and the row-level work around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.expressions import epoch_seconds, from_epoch_seconds
from fleetpulse.operators.distribute import lookup_join
from fleetpulse.params import ScaleLimits
from fleetpulse.schema import COLUMN_OF, FEATURES, WIRE_SCHEMA


def parse_telemetry(df: DataFrame, value_col: str = "value", keep: list[str] | None = None):
    """JSON messages (text or bytes) to telemetry columns.

    A malformed message gives a row of nulls, a bad field gives a null field.
    ``keep`` names source columns to carry along, such as the raw value itself.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), WIRE_SCHEMA).alias("_data")
    rows = df.select(*(keep or []), parsed)
    return rows.select(*(keep or []), *telemetry_columns("_data."))


def normalise(df: DataFrame) -> DataFrame:
    """Wire-named columns (from files that are already parsed) to telemetry columns."""
    return df.select(*telemetry_columns())


def telemetry_columns(prefix: str = "") -> list:
    """Wire fields as telemetry columns."""
    out = []
    for wire, name in COLUMN_OF.items():
        source = F.col(f"{prefix}`{wire}`")
        out.append((from_epoch_seconds(source) if name == "event_time" else source).alias(name))
    return out


def wire_struct(df: DataFrame, extra: list[str] | None = None):
    """Struct with the wire names, as sent in a message. ``extra`` columns keep their name."""
    fields = []
    for wire, name in COLUMN_OF.items():
        if name in df.columns:
            source = epoch_seconds(F.col(name)) if name == "event_time" else F.col(name)
            fields.append(source.alias(wire))
    return F.struct(*fields, *[F.col(c) for c in extra or []])


def to_wire_json(df: DataFrame, extra: list[str] | None = None, keep: list[str] | None = None):
    """One JSON message per row in ``value``."""
    return df.select(*(keep or []), F.to_json(wire_struct(df, extra)).alias("value"))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined): a row without a machine cannot be keyed."""
    return parsed.where(F.col("machine_id").isNotNull()), parsed.where(F.col("machine_id").isNull())


def topology_enrich(
    telemetry: DataFrame, topology: DataFrame, limits: ScaleLimits = ScaleLimits()
) -> DataFrame:
    """Attach ``connected_to`` by machine, an empty list for an unknown one, and stamp the time.

    The event time is kept where there is one.
    """
    rows = telemetry.drop("connected_to")
    joined = lookup_join(rows, topology.select("machine_id", "connected_to"), "machine_id",
                         limits=limits)
    joined = joined.withColumn(
        "connected_to", F.coalesce("connected_to", F.array().cast("array<string>"))
    )
    stamp = F.current_timestamp()
    if "event_time" in rows.columns:
        stamp = F.coalesce(F.col("event_time"), stamp)
    return joined.withColumn("event_time", stamp)


def drop_self_loops(df: DataFrame) -> DataFrame:
    return df.withColumn("connected_to", F.array_remove("connected_to", F.col("machine_id")))


def drop_missing(df: DataFrame) -> DataFrame:
    return df.dropna(subset=FEATURES)


def default_missing(df: DataFrame) -> DataFrame:
    """Name for a reading without a machine, current time for one without a time."""
    return df.withColumn("machine_id", F.coalesce("machine_id", F.lit("UNKNOWN"))).withColumn(
        "event_time", F.coalesce("event_time", F.current_timestamp())
    )


def nest_alert(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Edge alert: the reading nested under the alert's own fields, and the columns to ``keep``."""
    return default_missing(df.withColumn("_reading", wire_struct(df))).select(
        epoch_seconds(F.col("event_time")).alias("timestamp"),
        F.col("_reading").alias("original_data"),
        F.col("latency_ms"),
        F.lit("edge_anomaly").alias("alert_type"),
        F.col("machine_id").alias("product_id"),
        *(keep or []),
    )


def tag_offload(df: DataFrame) -> DataFrame:
    """Mark readings sent to the cloud. ``latency_ms`` is already on the row."""
    return df.withColumn("routing", F.lit("cloud_offload"))


def min_rows_gate(df: DataFrame, needed: int) -> DataFrame:
    """One row saying whether there are at least ``needed`` rows. Stops reading once there are."""
    return df.limit(needed).agg((F.count(F.lit(1)) >= needed).alias("enough"))


def has_rows(df: DataFrame, needed: int) -> bool:
    return min_rows_gate(df, needed).first()["enough"]


def sample_limit(df: DataFrame, max_records: int | None = None, order_cols=("event_time",)):
    """The first ``max_records`` rows in a fixed order. The default keeps every row."""
    return df if max_records is None else df.orderBy(*order_cols).limit(max_records)
