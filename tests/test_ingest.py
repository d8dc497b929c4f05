import json

from pyspark.sql import functions as F

from fleetpulse.operators import ingest
from fleetpulse.schema import EDGE_ALERT_SCHEMA, TELEMETRY_COLUMNS
from fleetpulse.sources import readers, writers

MESSAGE = {
    "Product ID": "L1",
    "Type": "L",
    "Air temperature [K]": 298.1,
    "Process temperature [K]": 308.6,
    "Rotational speed [rpm]": 1551,
    "Torque [Nm]": 42.8,
    "Tool wear [min]": 3,
    "Machine failure": 0,
    "timestamp": 1704067207.5,
    "connected_to": ["L2", "L1"],
    "unknown": "dropped",
}


def parse(spark, *values):
    return ingest.parse_telemetry(spark.createDataFrame([(v,) for v in values], "value string"))


def test_parse_keeps_known_fields(spark):
    row = parse(spark, json.dumps(MESSAGE)).first()
    assert list(row.asDict()) == TELEMETRY_COLUMNS
    assert (row.machine_id, row.rotational_speed, row.tool_wear) == ("L1", 1551.0, 3)
    assert row.connected_to == ["L2", "L1"]


def test_parse_accepts_bytes(spark):
    raw = spark.createDataFrame([(json.dumps(MESSAGE).encode(),)], "value binary")
    assert ingest.parse_telemetry(raw).first().machine_id == "L1"


def test_malformed_message_and_bad_field(spark):
    bad_field = json.dumps({**MESSAGE, "Tool wear [min]": 5.5})
    broken, partial = parse(spark, "bad", bad_field).collect()
    assert all(value is None for value in broken)
    assert partial.tool_wear is None and partial.machine_id == "L1" and partial.torque == 42.8


def test_split_malformed(spark):
    usable, malformed = ingest.split_malformed(parse(spark, "bad", json.dumps(MESSAGE)))
    assert (usable.count(), malformed.count()) == (1, 1)


def test_wire_round_trip(spark, readings):
    back = ingest.parse_telemetry(ingest.to_wire_json(readings))
    rows = readings.select(*TELEMETRY_COLUMNS)
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0


def test_topology_defaults_to_no_neighbours(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "machine_id string")
    known = spark.createDataFrame([("a", ["b"])], "machine_id string, connected_to array<string>")
    got = {r.machine_id: r for r in ingest.topology_enrich(rows, known).collect()}
    assert got["a"].connected_to == ["b"] and got["b"].connected_to == []
    assert got["a"].event_time is not None


def test_self_loops(spark):
    df = spark.createDataFrame([("a", ["a", "b", "a"])], "machine_id string, connected_to array<string>")
    assert ingest.drop_self_loops(df).first().connected_to == ["b"]


def test_defaults(spark):
    df = spark.createDataFrame([(None, None)], "machine_id string, event_time timestamp")
    row = ingest.default_missing(df).first()
    assert row.machine_id == "UNKNOWN" and row.event_time is not None


def test_alert_has_its_documented_layout(spark, readings):
    alert = ingest.nest_alert(readings)
    assert [f.name for f in alert.schema.fields] == [f.name for f in EDGE_ALERT_SCHEMA.fields]
    messages = writers.as_messages(alert)
    back = readers.parse_alerts(messages)
    assert back.where("original_data.`Product ID` = product_id").count() == readings.count()


def test_gate(spark):
    assert ingest.has_rows(spark.range(100), 100)
    assert not ingest.has_rows(spark.range(99), 100)
    assert not ingest.has_rows(spark.range(0), 1)


def test_sample_limit_keeps_all_by_default(spark, readings):
    assert ingest.sample_limit(readings).count() == readings.count()
    first = ingest.sample_limit(readings, 10, ["event_time", "event_id"])
    assert first.count() == 10


def test_feedback_ignores_other_messages(spark):
    values = [
        {"type": "retrain_complete", "records_trained": 500, "training_loss": 0.5, "timestamp": 1.0},
        {"type": "heartbeat"},
    ]
    df = spark.createDataFrame([(json.dumps(v),) for v in values], "value string")
    assert [r.records_trained for r in readers.parse_feedback(df).collect()] == [500]


def test_history_blanks_for_missing_values(spark, readings, tmp_path):
    rows = ingest.tag_offload(readings.withColumn("torque", F.lit(None).cast("double")))
    path = str(tmp_path / "history")
    writers.write_history(rows.coalesce(1), path)
    text = [r.value for r in spark.read.text(path).collect()]
    header = (
        "timestamp,Air temperature [K],Process temperature [K],Rotational speed [rpm],"
        "Torque [Nm],Tool wear [min],routing,latency_ms"
    )
    assert text[0] == header and all(line.split(",")[4] == "" for line in text[1:])
    assert readers.read_history_csv(spark, path).where("torque IS NULL").count() == rows.count()


def test_archive_files_are_capped(spark, tmp_path):
    base = spark.range(1200).coalesce(1).withColumn("machine_id", F.lit("a"))
    path = str(tmp_path / "archive")
    writers.write_archive(base, path, writers.SMALL_FILE_ROWS)
    sizes = spark.read.text(path).groupBy(F.input_file_name()).count().select("count").collect()
    assert sorted(r[0] for r in sizes) == [200, 500, 500]
