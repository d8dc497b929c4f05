"""Data model: wire schema, column names and serving-table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the telemetry messages on the wire.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("Product ID", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Air temperature [K]", T.DoubleType()),
        T.StructField("Process temperature [K]", T.DoubleType()),
        T.StructField("Rotational speed [rpm]", T.DoubleType()),
        T.StructField("Torque [Nm]", T.DoubleType()),
        T.StructField("Tool wear [min]", T.IntegerType()),
        T.StructField("Machine failure", T.IntegerType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("connected_to", T.ArrayType(T.StringType())),
    ]
)

# Wire name -> column name used everywhere after ingestion. ``timestamp`` (epoch seconds)
# becomes ``event_time``.
COLUMN_OF = {
    "Product ID": "machine_id",
    "Type": "machine_type",
    "Air temperature [K]": "air_temp",
    "Process temperature [K]": "process_temp",
    "Rotational speed [rpm]": "rotational_speed",
    "Torque [Nm]": "torque",
    "Tool wear [min]": "tool_wear",
    "Machine failure": "machine_failure",
    "timestamp": "event_time",
    "connected_to": "connected_to",
}

FEATURES = ["air_temp", "process_temp", "rotational_speed", "torque", "tool_wear"]

TELEMETRY_COLUMNS = list(COLUMN_OF.values())

# The cloud history file: wire names plus the two routing columns, in file order (fixed values).
HISTORY_COLUMNS = {
    "timestamp": "event_time",
    "Air temperature [K]": "air_temp",
    "Process temperature [K]": "process_temp",
    "Rotational speed [rpm]": "rotational_speed",
    "Torque [Nm]": "torque",
    "Tool wear [min]": "tool_wear",
    "routing": "routing",
    "latency_ms": "latency_ms",
}

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("Air temperature [K]", T.DoubleType()),
        T.StructField("Process temperature [K]", T.DoubleType()),
        T.StructField("Rotational speed [rpm]", T.DoubleType()),
        T.StructField("Torque [Nm]", T.DoubleType()),
        T.StructField("Tool wear [min]", T.IntegerType()),
        T.StructField("routing", T.StringType()),
        T.StructField("latency_ms", T.IntegerType()),
    ]
)

# A seed file has the telemetry fields without the two that are added on the way.
SEED_SCHEMA = T.StructType(
    [f for f in WIRE_SCHEMA.fields if f.name not in ("timestamp", "connected_to")]
)

EDGE_ALERT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("original_data", WIRE_SCHEMA),
        T.StructField("latency_ms", T.IntegerType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
    ]
)

# A reading on the cloud topic: the reading itself plus its routing tags.
CLOUD_SCHEMA = T.StructType(
    WIRE_SCHEMA.fields
    + [T.StructField("routing", T.StringType()), T.StructField("latency_ms", T.IntegerType())]
)

FEEDBACK_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("records_trained", T.IntegerType()),
        T.StructField("training_loss", T.DoubleType()),
        T.StructField("timestamp", T.DoubleType()),
    ]
)

# Serving tables: schema, primary key, and the column that decides which write is newest.
SERVING_TABLES = {
    "realtime_alerts": (
        "machine_id string, alert_time timestamp, latency_ms int, air_temp double, "
        "process_temp double, rotational_speed double, torque double, tool_wear int, "
        "prediction_score double",
        ["machine_id", "alert_time"],
        "alert_time",
    ),
    "machine_states": (
        "machine_id string, last_update timestamp, status string, air_temp double, torque double",
        ["machine_id"],
        "last_update",
    ),
    "pagerank_scores": (
        "machine_id string, pagerank double, last_computed timestamp",
        ["machine_id"],
        "last_computed",
    ),
    "failure_communities": (
        "community_id string, machine_id string",
        ["community_id", "machine_id"],
        None,
    ),
    "community_risk": (
        "community_id string, risk_score double, member_count int, critical_count int, "
        "avg_pagerank double, last_computed timestamp",
        ["community_id"],
        "last_computed",
    ),
    "controller_state": (
        "controller_id string, latency_threshold double, cloud_sample_rate double, "
        "retrain_interval int, edge_anomaly_rate double, cloud_backlog int, avg_rtt double, "
        "last_updated timestamp",
        ["controller_id"],
        "last_updated",
    ),
}
