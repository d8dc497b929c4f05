"""The registered queries. Each takes (spark, sf_dir) and reads the test tables.

Doubles are rounded to six digits at the very end, and instants are given as microseconds, so
that other engines can be compared value by value.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.expressions import simulated_rtt
from fleetpulse.operators import controller as ctl
from fleetpulse.operators import graph, iforest, ingest, ml, risk, scoring
from fleetpulse.params import ControllerParams, IsolationParams, ScaleLimits
from fleetpulse.plans import jobs, serving
from fleetpulse.plans.preview import preview
from fleetpulse.schema import FEATURES
from fleetpulse.session import cut, work_path, write_once
from fleetpulse.sources import readers, writers
from fleetpulse.sources.events import read_events, telemetry, utc
from fleetpulse.sources.tables import KeyedTable, SnapshotTable
from fleetpulse.streaming import nodes
from fleetpulse.streaming.controller import controller_backlog, controller_states, controller_stream
from fleetpulse.streaming.scored import GraphContext, alert_feed, stream_scored

ORDER = ["event_time", "event_id"]
SLOW = "prediction_score = -1.0"

_shared: dict = {}


def reset() -> None:
    """Forget intermediate tables, so that the next query computes all it needs."""
    _shared.clear()


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    """Tables several queries start from, computed once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def graph_tables(spark: SparkSession, sf_dir: str) -> jobs.GraphTables:
    return _once(
        spark, sf_dir, "graph", lambda: jobs.graph_tables(telemetry(spark, sf_dir))
    )


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make():
        return write_once(graph_tables(spark, sf_dir).context(), "context")

    return _once(spark, sf_dir, "context", make)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.graph_scored(telemetry(spark, sf_dir), context(spark, sf_dir))


def judged(spark: SparkSession, sf_dir: str, single: bool = False) -> DataFrame:
    """Readings with the base verdict, ready for routing."""
    rows = scoring.base_scored(telemetry(spark, sf_dir))
    if single:
        rows = rows.withColumn("edge_id", F.lit(ControllerParams().controller_id))
    return rows.select(
        "event_id", "event_time", "edge_id", "machine_id", *FEATURES, "latency_ms", "draw",
        "prediction_score",
    )


def routing(spark: SparkSession, sf_dir: str, single: bool = False) -> jobs.RoutingRun:
    return _once(
        spark,
        sf_dir,
        f"routing-{single}",
        lambda: jobs.run_routing(judged(spark, sf_dir, single), SLOW, ORDER),
    )


def six(df: DataFrame) -> DataFrame:
    """Comparable values: rounded doubles, instants in microseconds, lists as text."""
    out = []
    for field in df.schema.fields:
        column: Column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            out.append(F.round(column, 6).alias(field.name))
        elif isinstance(field.dataType, T.TimestampType):
            out.append(F.unix_micros(column).alias(field.name.replace("_time", "") + "_us"))
        elif isinstance(field.dataType, T.ArrayType):
            out.append(F.array_join(column.cast("array<string>"), ",").alias(field.name))
        else:
            out.append(column)
    return df.select(*out)


READING = [
    "machine_id", "machine_type", *FEATURES, "machine_failure", "event_time", "connected_to",
]


# --- sources -------------------------------------------------------------------------------


def _raw_messages(spark, sf_dir) -> str:
    """Folder of telemetry messages on the raw topic."""
    path = work_path(spark, "topics")
    rows = telemetry(spark, sf_dir)
    writers.write_messages(ingest.to_wire_json(rows), readers.RAW_TOPIC, fmt="files", path=path)
    return path


def _drain(df: DataFrame, label: str) -> DataFrame:
    """Run a stream to the end of its input and read what it wrote."""
    spark, path = df.sparkSession, work_path(df.sparkSession, label)
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def src_kafka_json(spark, sf_dir):
    path = _raw_messages(spark, sf_dir)
    messages = readers.read_messages(spark, [readers.RAW_TOPIC], fmt="files", path=path)
    return six(_drain(ingest.parse_telemetry(messages), "parsed"))


def src_multi_topic(spark, sf_dir):
    path = work_path(spark, "topics")
    rows = ctl.route_readings(scoring.base_scored(telemetry(spark, sf_dir)))
    alerts = writers.as_messages(ingest.nest_alert(ctl.edge_alerts(rows, SLOW)))
    cloud = ingest.tag_offload(rows.where("to_cloud"))
    offload = ingest.to_wire_json(cloud, ["routing", "latency_ms"])
    writers.write_messages(alerts, readers.ALERT_TOPIC, fmt="files", path=path)
    writers.write_messages(offload, readers.CLOUD_TOPIC, fmt="files", path=path)
    both = readers.read_messages(
        spark, [readers.ALERT_TOPIC, readers.CLOUD_TOPIC], fmt="files", path=path, streaming=False
    )
    from_edge = readers.parse_alerts(readers.for_topic(both, readers.ALERT_TOPIC)).select(
        F.lit(readers.ALERT_TOPIC).alias("topic"),
        F.col("product_id").alias("machine_id"),
        "latency_ms",
    )
    to_cloud = readers.parse_cloud(readers.for_topic(both, readers.CLOUD_TOPIC)).select(
        F.lit(readers.CLOUD_TOPIC).alias("topic"), "machine_id", "latency_ms"
    )
    return from_edge.unionByName(to_cloud)


def src_feedback(spark, sf_dir):
    """Retrain notices, one per trigger, among other controller messages."""
    path = work_path(spark, "topics")
    cloud = ctl.route_readings(telemetry(spark, sf_dir)).where("to_cloud")
    notices = ctl.retrain_trigger(cloud, ORDER).select(
        F.lit("retrain_complete").alias("type"),
        F.col("records").cast("int").alias("records_trained"),
        (F.lit(1.0) / F.col("records")).alias("training_loss"),
        F.lit(0.0).alias("timestamp"),
    )
    other = routing(spark, sf_dir).states.select(
        F.col("action").alias("type"), F.col("retrain_interval").alias("records_trained")
    )
    for rows in (notices, other):
        writers.write_messages(
            writers.as_messages(rows), readers.CONTROLLER_TOPIC, fmt="files", path=path
        )
    stream = readers.read_messages(spark, [readers.CONTROLLER_TOPIC], fmt="files", path=path)
    return six(_drain(readers.parse_feedback(stream), "feedback")).select(
        "type", "records_trained", "training_loss"
    )


def src_archive_json(spark, sf_dir):
    path = work_path(spark, "archive")
    writers.write_archive(telemetry(spark, sf_dir), path, writers.SMALL_FILE_ROWS)
    return six(readers.read_archive(spark, path))


def _archived(spark, sf_dir) -> str:
    messages = readers.read_messages(
        spark, [readers.RAW_TOPIC], fmt="files", path=_raw_messages(spark, sf_dir)
    )
    path = work_path(spark, "archive")
    writers.archive_stream(
        ingest.parse_telemetry(messages), path, f"{path}-checkpoint", availableNow=True
    ).awaitTermination()
    return path


def src_stable_snapshot(spark, sf_dir):
    """The archive of a stream, next to files that the stream never committed."""
    path = _archived(spark, sf_dir)
    stray = writers.archive_rows(telemetry(spark, sf_dir).where("machine_failure = 1"))
    stray.write.mode("append").json(f"{path}/unfinished")
    return six(readers.read_archive(spark, path))


def src_csv(spark, sf_dir):
    path = work_path(spark, "seed")
    seed = writers.archive_rows(telemetry(spark, sf_dir)).drop("timestamp", "connected_to")
    seed.write.option("header", True).csv(path)
    return six(readers.read_seed_csv(spark, path))


def src_serving_table(spark, sf_dir):
    table = SnapshotTable.named(work_path(spark, "serving"), "pagerank_scores")
    ranks = graph_tables(spark, sf_dir).ranks
    table.replace(ranks.withColumn("last_computed", F.current_timestamp()))
    return six(
        table.read(spark).select(
            F.col("machine_id").alias("pr_machine_id"), F.col("pagerank").alias("pr_score")
        )
    )


# --- sinks ---------------------------------------------------------------------------------


def sink_alerts_append(spark, sf_dir):
    """The alert log after batches that cross days, overlap, and reach its third level."""
    table = replace(KeyedTable.named(work_path(spark, "serving"), "realtime_alerts"), fanout=2)
    alerts = write_once(scoring.project_alerts(scored(spark, sf_dir)), "alerts")
    for batch in range(4):
        part = F.pmod(F.xxhash64("machine_id"), F.lit(4)) == batch
        table.upsert(alerts.where(part | (F.col("tool_wear") > 240)), batch)  # some are written again
    return six(table.read(spark))


def sink_states_upsert(spark, sf_dir):
    table = KeyedTable.named(work_path(spark, "serving"), "machine_states")
    states = scoring.project_states(scored(spark, sf_dir))
    table.upsert(states.where("status = 'CRITICAL'"), 0)
    table.upsert(states.where("status = 'HEALTHY'"), 1)
    table.compact(spark)
    return six(table.read(spark))


def _snapshot(spark, name, df):
    table = SnapshotTable.named(work_path(spark, "serving"), name)
    columns = T.StructType.fromDDL(table.schema).names
    if "last_computed" in columns:
        df = df.withColumn("last_computed", F.current_timestamp())
    table.replace(df.where(F.lit(False)))
    table.replace(df)
    return six(table.read(spark).drop("last_computed"))


def sink_pagerank(spark, sf_dir):
    return _snapshot(spark, "pagerank_scores", graph_tables(spark, sf_dir).ranks)


def sink_communities(spark, sf_dir):
    return _snapshot(spark, "failure_communities", named(graph_tables(spark, sf_dir).communities))


def sink_risk(spark, sf_dir):
    return _snapshot(spark, "community_risk", graph_tables(spark, sf_dir).risk)


def named(df: DataFrame) -> DataFrame:
    return df.select("community_id", "machine_id")


def sink_controller_state(spark, sf_dir):
    table = KeyedTable.named(work_path(spark, "serving"), "controller_state")
    table.upsert(ctl.controller_latest(routing(spark, sf_dir).trace), 0)
    return six(table.read(spark).drop("last_updated"))


def sink_archive_batches(spark, sf_dir):
    path = work_path(spark, "archive")
    writers.write_archive(telemetry(spark, sf_dir), path, writers.SMALL_FILE_ROWS)
    files = spark.read.text(path).groupBy(F.input_file_name()).agg(F.count("*").alias("rows"))
    return files.agg(
        F.sum("rows").alias("rows"),
        (F.max("rows") <= writers.SMALL_FILE_ROWS).alias("within_limit"),
    )


def sink_cloud_history(spark, sf_dir):
    path = work_path(spark, "history")
    cloud = ctl.route_readings(gaps(telemetry(spark, sf_dir))).where("to_cloud")
    writers.write_history(ingest.tag_offload(cloud), path)
    back = readers.read_history_csv(spark, path)
    return six(back.withColumn("tool_wear", F.col("tool_wear").cast("double")))


def sink_kafka_json(spark, sf_dir):
    path = work_path(spark, "topics")
    rows = ctl.route_readings(scoring.base_scored(telemetry(spark, sf_dir)))
    alerts = ingest.nest_alert(ctl.edge_alerts(rows, SLOW))
    writers.write_messages(writers.as_messages(alerts), readers.ALERT_TOPIC, fmt="files", path=path)
    sent = readers.read_messages(
        spark, [readers.ALERT_TOPIC], fmt="files", path=path, streaming=False
    )
    return _flat_alerts(readers.parse_alerts(sent))


def _flat_alerts(alerts: DataFrame) -> DataFrame:
    return six(
        alerts.select(
            "alert_type",
            "product_id",
            "latency_ms",
            F.round(F.col("timestamp") * 1e6).cast("bigint").alias("event_us"),
            F.col("original_data.`Tool wear [min]`").alias("tool_wear"),
            F.col("original_data.`Torque [Nm]`").alias("torque"),
        )
    )


def sink_model(spark, sf_dir):
    """Predictions of the saved model against those of the model in memory."""
    path = work_path(spark, "model")
    train, test = _split(spark, sf_dir)
    model = _forest(spark, sf_dir)
    ml.save_model(model, path)
    ml.save_model(model, path)
    again = ml.rf_predict(ml.load_model(path), test).select(
        "event_id", F.col("prediction").alias("loaded")
    )
    both = ml.rf_predict(model, test).join(again, "event_id")
    return both.agg(
        F.count("*").alias("rows"), F.count_if(F.col("prediction") != F.col("loaded")).alias("differ")
    )


def show_preview(spark, sf_dir):
    return six(preview(graph_tables(spark, sf_dir).ranks, 5, ["machine_id"], show=False))


# --- projections and filters ---------------------------------------------------------------


def parse_telemetry(spark, sf_dir):
    messages = ingest.to_wire_json(telemetry(spark, sf_dir), keep=["event_id"])
    return six(ingest.parse_telemetry(messages, keep=["event_id"]))


def _with_damage(spark, sf_dir) -> DataFrame:
    """Messages in which every sign-up event is cut off in the middle."""
    rows = telemetry(spark, sf_dir)
    messages = ingest.to_wire_json(rows, keep=["event_id", "machine_type"])
    cut_off = F.substring("value", 1, 40)
    return messages.withColumn(
        "value", F.when(F.col("machine_type") == "signup", cut_off).otherwise(F.col("value"))
    ).select("event_id", "value")


def quarantine_malformed(spark, sf_dir):
    parsed = ingest.parse_telemetry(_with_damage(spark, sf_dir), keep=["event_id"])
    usable, malformed = ingest.split_malformed(parsed)
    return usable.select("event_id", F.lit("usable").alias("kind")).unionAll(
        malformed.select("event_id", F.lit("malformed").alias("kind"))
    )


def project_alerts(spark, sf_dir):
    return six(scoring.project_alerts(scored(spark, sf_dir)))


def project_states(spark, sf_dir):
    return six(scoring.project_states(scored(spark, sf_dir)))


def filter_anomalies(spark, sf_dir):
    rows = scoring.filter_anomalies(scored(spark, sf_dir))
    return six(rows.select("event_id", "machine_id", "tool_wear", "rotational_speed"))


def _topology(spark, sf_dir) -> DataFrame:
    """Neighbours of all machines; every fifth has a list that is missing."""
    known = F.substring("machine_id", 2, 20).cast("bigint") % 5 != 0
    rows = telemetry(spark, sf_dir).withColumn("connected_to", F.when(known, F.col("connected_to")))
    lists = rows.groupBy("machine_id").agg(F.max("connected_to").alias("connected_to"))
    return write_once(lists, "topology")


def topology_enrich(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select("event_id", "machine_id", "event_time")
    return six(ingest.topology_enrich(rows, _topology(spark, sf_dir)))


def drop_self_loops(spark, sf_dir):
    """Neighbour lists with the machine itself added in front."""
    rows = telemetry(spark, sf_dir).select(
        "event_id",
        "machine_id",
        F.concat(F.array("machine_id"), F.col("connected_to")).alias("connected_to"),
    )
    return six(ingest.drop_self_loops(rows))


def gaps(rows: DataFrame) -> DataFrame:
    """Readings that lack a sensor: torque for sign-ups, tool wear for views."""
    return rows.withColumn(
        "torque", F.when(F.col("machine_type") != "signup", F.col("torque"))
    ).withColumn("tool_wear", F.when(F.col("machine_type") != "view", F.col("tool_wear")))


def drop_missing(spark, sf_dir):
    return six(ingest.drop_missing(gaps(telemetry(spark, sf_dir))).select("event_id", *FEATURES))


def default_missing(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    known = F.col("machine_type") != "click"
    rows = rows.withColumn("machine_id", F.when(known, F.col("machine_id"))).withColumn(
        "event_time", F.when(known, F.col("event_time"))
    )
    filled = ingest.default_missing(rows)
    return filled.select(
        "event_id", "machine_id", F.col("event_time").isNotNull().alias("has_time")
    )


def nest_alert(spark, sf_dir):
    rows = ctl.route_readings(scoring.base_scored(telemetry(spark, sf_dir)))
    return _flat_alerts(ingest.nest_alert(ctl.edge_alerts(rows, SLOW)))


def tag_offload(spark, sf_dir):
    rows = ctl.route_readings(telemetry(spark, sf_dir)).where("to_cloud")
    return ingest.tag_offload(rows).select("event_id", "machine_id", "routing", "latency_ms")


def min_rows_gate(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    gates = [
        ("training", rows, 100),
        ("history", ctl.route_readings(rows).where("to_cloud"), 50),
        ("edges", graph.graph_edges(rows), 1),
        ("batch", rows.where("tool_wear > 1000"), 1),
    ]
    parts = [
        ingest.min_rows_gate(df, n).select(F.lit(name).alias("gate"), "enough")
        for name, df, n in gates
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sample_limit(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select("event_id", "machine_id", "event_time")
    return six(ingest.sample_limit(rows, 100, ORDER))


# --- joins ---------------------------------------------------------------------------------


def join_pagerank(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select("event_id", "machine_id")
    return six(scoring.join_pagerank(rows, graph_tables(spark, sf_dir).ranks))


def join_community(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select("event_id", "machine_id")
    return scoring.join_community(rows, graph_tables(spark, sf_dir).communities)


def join_risk(spark, sf_dir):
    tables = graph_tables(spark, sf_dir)
    rows = telemetry(spark, sf_dir).select("event_id", "machine_id")
    return six(scoring.join_risk(scoring.join_community(rows, tables.communities), tables.risk))


def graph_context(spark, sf_dir):
    return six(context(spark, sf_dir))


def join_community_rank(spark, sf_dir):
    tables = graph_tables(spark, sf_dir)
    return six(risk.join_community_rank(tables.communities, tables.ranks))


# --- aggregates ----------------------------------------------------------------------------


def graph_nodes(spark, sf_dir):
    return graph.graph_nodes(telemetry(spark, sf_dir))


def graph_edges(spark, sf_dir):
    return graph.graph_edges(telemetry(spark, sf_dir))


def _members(spark, sf_dir):
    tables = graph_tables(spark, sf_dir)
    return risk.join_community_rank(tables.communities, tables.ranks)


def community_agg(spark, sf_dir):
    return six(risk.community_agg(_members(spark, sf_dir)))


def median_rank(spark, sf_dir):
    return six(risk.median_rank(_members(spark, sf_dir)))


def risk_norm_max(spark, sf_dir):
    return six(risk.risk_norm_max(risk.community_agg(_members(spark, sf_dir))))


def batch_adjust_stats(spark, sf_dir):
    return six(scoring.batch_adjust_stats(scored(spark, sf_dir)))


def feature_minmax(spark, sf_dir):
    """Scaled features, one of them constant."""
    rows = telemetry(spark, sf_dir).withColumn("process_temp", F.lit(7.0))
    return six(ml.feature_minmax(rows.select("event_id", *FEATURES)))


def edge_run_stats(spark, sf_dir):
    return six(ctl.edge_run_stats(routing(spark, sf_dir).routed, SLOW))


# --- risk and scoring ----------------------------------------------------------------------


def community_risk(spark, sf_dir):
    return six(graph_tables(spark, sf_dir).risk)


def graph_adjustment(spark, sf_dir):
    """Adjustment per reading; the risk of critical communities is missing."""
    tables = graph_tables(spark, sf_dir)
    some = tables.risk.withColumn("risk_score", F.when(F.col("risk_score") < 0.9, F.col("risk_score")))
    ctx = risk.graph_context(tables.ranks, tables.communities, some)
    rows = scoring.with_context(telemetry(spark, sf_dir), ctx)
    return six(rows.select("event_id", "machine_id", "risk_score", "graph_adjustment"))


def graph_scored(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return six(rows.select("event_id", "machine_id", "graph_adjustment", "prediction_score"))


def base_scored(spark, sf_dir):
    rows = scoring.base_scored(gaps(telemetry(spark, sf_dir)))
    return six(
        rows.select("event_id", "community_id", "risk_score", "pr_score", "prediction_score")
    )


# --- graph ---------------------------------------------------------------------------------


def pagerank(spark, sf_dir):
    return six(graph.pagerank(*jobs.machine_graph(telemetry(spark, sf_dir))))


def label_propagation(spark, sf_dir):
    return graph.label_propagation(*jobs.machine_graph(telemetry(spark, sf_dir)))


def graph_build(spark, sf_dir):
    """Edges whose two machines are nodes, over the nodes and edges of all rows."""
    rows = telemetry(spark, sf_dir)
    return graph.graph_build(cut(graph.graph_nodes(rows)), graph.graph_edges(rows))[1]


# --- machine learning ----------------------------------------------------------------------


def rf_features(spark, sf_dir):
    rows = ml.rf_features(gaps(telemetry(spark, sf_dir)))
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array("features")
    return six(
        rows.select("event_id", *[values[i].alias(f"f{i}") for i in range(len(FEATURES))])
    )


def _split(spark, sf_dir):
    return ml.rf_split(telemetry(spark, sf_dir), F.col("event_id"))


def _forest(spark, sf_dir):
    return _once(spark, sf_dir, "forest", lambda: ml.rf_train(_split(spark, sf_dir)[0]))


def rf_split(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return train.select("event_id", F.lit("train").alias("part")).unionAll(
        test.select("event_id", F.lit("test").alias("part"))
    )


def rf_train(spark, sf_dir):
    """Importance of each feature in the trained forest, taken from the training rows."""
    model = ml.rf_train(_split(spark, sf_dir)[0])
    importance = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(value)) for name, value in zip(FEATURES, importance)],
        "feature string, importance double",
    )


def rf_predict(spark, sf_dir):
    rows = ml.rf_predict(_forest(spark, sf_dir), _split(spark, sf_dir)[1])
    return rows.select("event_id", "machine_failure", "prediction")


def rf_evaluate(spark, sf_dir):
    rows = ml.rf_predict(_forest(spark, sf_dir), _split(spark, sf_dir)[1])
    return ml.rf_evaluate(rows)


def rank_metrics(spark, sf_dir):
    """What the evaluation says of a plain rule: wear as the score, more than 200 as the verdict."""
    rows = telemetry(spark, sf_dir).withColumn("prediction", (F.col("tool_wear") > 200).cast("double"))
    return six(ml.evaluate(rows, F.col("tool_wear"), TINY))


def _isolation(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    return _once(spark, sf_dir, "isolation", lambda: iforest.iforest_fit(rows, "event_id"))


def iforest_fit(spark, sf_dir):
    return six(iforest.iforest_fit(telemetry(spark, sf_dir), "event_id"))


def iforest_score(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    result = write_once(
        iforest.iforest_score(rows, _isolation(spark, sf_dir)).select(
            "event_id", "machine_id", "anomaly_score"
        ),
        "isolation",
    )
    return iforest.iforest_flag(result, iforest.iforest_threshold(result, IsolationParams()))


def iforest_refreshed(spark, sf_dir):
    """The forest of an edge that learned the first half of the month, then the second."""
    rows, learner = telemetry(spark, sf_dir), jobs.EdgeLearner(work_path(spark, "learner"), "event_id")
    early = F.coalesce(F.col("event_time") < F.timestamp_seconds(F.lit(1705276800)), F.lit(True))  # 15 January 2024
    for number, part in enumerate((rows.where(early), rows.where(~early))):
        learner.learn(part, number)
    return six(learner.model(rows, 2, jobs.EdgeModel(rows.limit(0), 1.0)).forest)


def edge_model_alerts(spark, sf_dir):
    """Alerts of the whole edge job: the saved forest judges, the controller routes."""
    rows, path = telemetry(spark, sf_dir), work_path(spark, "edge-model")
    jobs.train_edge_model(rows, "event_id", path)
    run = jobs.run_edge(rows, jobs.load_edge_model(spark, path), ORDER)
    return _flat_alerts(ingest.nest_alert(ctl.edge_alerts(run.routed, "prediction = -1")))


def recon_error(spark, sf_dir):
    return six(ml.recon_error(gaps(telemetry(spark, sf_dir)), keep=["event_id"]))


# --- routing and controller ----------------------------------------------------------------


def simulated_rtt_(spark, sf_dir):
    return read_events(spark, sf_dir).select(
        "event_id", simulated_rtt(F.col("event_id")).alias("rtt_ms")
    )


def route_readings(spark, sf_dir):
    rows = routing(spark, sf_dir).routed
    return rows.select("event_id", "edge_id", "window_no", "seq", "to_cloud")


def edge_alerts(spark, sf_dir):
    rows = ctl.edge_alerts(routing(spark, sf_dir).routed, SLOW)
    return _flat_alerts(ingest.nest_alert(rows))


def controller_windows(spark, sf_dir):
    windowed = ctl.assign_windows(
        ctl.number_messages(judged(spark, sf_dir), ORDER), ControllerParams().window_size
    )
    return ctl.controller_windows(windowed, SLOW).select(
        "edge_id",
        "window_no",
        "messages",
        F.round(F.col("rtt_sum") / F.col("messages"), 6).alias("mean_rtt"),
        F.size("outlier_draw").cast("bigint").alias("outliers"),
    )


def controller_fold(spark, sf_dir):
    return six(routing(spark, sf_dir, True).states)


def controller_fold_many(spark, sf_dir):
    return six(routing(spark, sf_dir).states)


def controller_latest(spark, sf_dir):
    return six(ctl.controller_latest(routing(spark, sf_dir).trace).drop("last_updated"))


def _cloud(spark, sf_dir):
    return routing(spark, sf_dir).routed.where("to_cloud")


def retrain_trigger(spark, sf_dir):
    return six(ctl.retrain_trigger(_cloud(spark, sf_dir), ORDER))


def retrain_feedback(spark, sf_dir):
    """The notice of retraining on the whole cloud history, and the loss of a model without components."""
    found = ml.read_moments(ml.moments(_cloud(spark, sf_dir)))
    notice, bare = jobs.retrain_on(spark, found), jobs.retrain_on(spark, found, k=0)
    loss = F.round(bare.select("training_loss").scalar(), 6)
    return notice.select(
        "type", "records_trained", (F.col("training_loss") >= 0).alias("has_loss"), loss.alias("bare_loss")
    )


def retrain_moments(spark, sf_dir):
    """Covariances of the scaled features of the cloud history, from the merged moments of its parts."""
    history, held = _cloud(spark, sf_dir), None
    for part in range(4):
        some = history.where(F.pmod(F.xxhash64("event_time"), F.lit(4)) == part)
        held = ml.merge_moments(held, ml.read_moments(ml.moments(some)))
    spans = held.highs - held.lows
    rows = [
        (held.n, a, b, round(float(held.products[i, j] / held.n / spans[i] / spans[j]), 6) + 0.0)
        for i, a in enumerate(FEATURES)
        for j, b in enumerate(FEATURES)
    ]
    return spark.createDataFrame(rows, "records bigint, feature string, other string, covariance double")


def cloud_backlog(spark, sf_dir):
    return ctl.cloud_backlog(routing(spark, sf_dir).routed)


# --- serving queries -----------------------------------------------------------------------


def _alerts(spark, sf_dir):
    return scoring.project_alerts(scored(spark, sf_dir))


def _states(spark, sf_dir):
    return scoring.latest_state(scored(spark, sf_dir))


def _placed(df: DataFrame) -> DataFrame:
    """The rows with their place in the order given: the order is part of the result."""
    return df.coalesce(1).withColumn("position", F.monotonically_increasing_id())


def latest_alerts(spark, sf_dir):
    return six(_placed(serving.latest_alerts(_alerts(spark, sf_dir))))


def alert_ticker(spark, sf_dir):
    return six(_placed(serving.alert_ticker(_alerts(spark, sf_dir))))


def sensor_series(spark, sf_dir):
    return six(_placed(serving.sensor_series(_alerts(spark, sf_dir))))


def states_snapshot(spark, sf_dir):
    return six(serving.states_snapshot(_states(spark, sf_dir)))


def fleet_summary(spark, sf_dir):
    return six(serving.fleet_summary(_states(spark, sf_dir)))


def machines_by_status(spark, sf_dir):
    states = _states(spark, sf_dir)
    critical = serving.machines_by_status(states, True).withColumn("list", F.lit("critical"))
    healthy = serving.machines_by_status(states, False).withColumn("list", F.lit("healthy"))
    return six(critical.unionByName(healthy))


def pagerank_board(spark, sf_dir):
    return six(serving.pagerank_board(graph_tables(spark, sf_dir).ranks))


def pagerank_top10(spark, sf_dir):
    return six(serving.pagerank_top10(graph_tables(spark, sf_dir).ranks))


def community_members(spark, sf_dir):
    return six(serving.community_members(graph_tables(spark, sf_dir).communities))


def community_top5(spark, sf_dir):
    return six(serving.community_top5(graph_tables(spark, sf_dir).communities))


def _controllers(spark, sf_dir):
    return ctl.controller_latest(routing(spark, sf_dir).trace)


def controller_lookup(spark, sf_dir):
    states = _controllers(spark, sf_dir)
    found = serving.controller_lookup(states, "edge-3")
    return six(
        found.unionByName(serving.controller_lookup(states, "edge-none")).drop("last_updated")
    )


def controller_card(spark, sf_dir):
    return serving.controller_card(
        serving.controller_lookup(_controllers(spark, sf_dir), "edge-3")
    )


def latency_bands(spark, sf_dir):
    """Delivery of each event: sent at its time, received a round trip plus its wear later."""
    rows = telemetry(spark, sf_dir)
    rows = rows.withColumn(
        "received",
        F.timestamp_micros(
            F.unix_micros("event_time")
            + (F.col("latency_ms") + F.col("tool_wear")).cast("bigint") * 1000
        ),
    ).withColumn("connected", F.col("machine_failure") == 0)
    bands = serving.latency_bands(rows, "event_time", "received", "connected")
    return bands.select("event_id", "delay_ms", "band")


def alert_feed_(spark, sf_dir):
    """A tick of the feed after the scoring stream has run."""
    root = _scored_stream(spark, sf_dir)
    out = f"{root}/emitted"
    ticks = readers.read_messages(
        spark, [readers.RAW_TOPIC], fmt="files", path=_raw_messages(spark, sf_dir)
    )
    alert_feed(
        ticks,
        root,
        lambda alerts, _: alerts.write.mode("overwrite").parquet(out),
        f"{root}/feed-checkpoint",
        availableNow=True,
    ).awaitTermination()
    served = spark.read.parquet(out)
    return six(served.withColumn("server_time", F.col("server_time").isNotNull()))


# --- streaming -----------------------------------------------------------------------------


def _scored_stream(spark, sf_dir) -> str:
    """Run the scoring stream with graph context over two batches that overlap in time.

    The second run has a new checkpoint, as after a reset: it gets all messages once more.
    """
    root, topics = work_path(spark, "stream"), work_path(spark, "topics")
    jobs.save_graph_tables(graph_tables(spark, sf_dir), root)
    rows = telemetry(spark, sf_dir)
    first = F.col("machine_type").isin("error", "signup", "purchase")
    for run, part in enumerate((rows.where(first), rows.where(~first))):
        writers.write_messages(
            ingest.to_wire_json(part), readers.RAW_TOPIC, fmt="files", path=topics
        )
        messages = readers.read_messages(spark, [readers.RAW_TOPIC], fmt="files", path=topics)
        stream_scored(
            ingest.parse_telemetry(messages),
            root,
            f"{root}/checkpoint-{run}",
            compact_every=1,
            availableNow=True,
        ).awaitTermination()
    return root


def stream_scored_(spark, sf_dir):
    root = _scored_stream(spark, sf_dir)
    alerts = KeyedTable.named(root, "realtime_alerts").read(spark)
    return six(alerts)


def latest_state(spark, sf_dir):
    """Machine states left by the stream: by event time, in whatever order readings came."""
    root = _scored_stream(spark, sf_dir)
    return six(KeyedTable.named(root, "machine_states").read(spark))


def context_refresh(spark, sf_dir):
    """Graph context before the graph job, after it, before the time is up, and after a reload.

    Between the last two the stored risk becomes 0, so that a reload that fails to happen shows.
    """
    root, time_now = work_path(spark, "refresh"), [0.0]
    cache = GraphContext(spark, root, 60.0, lambda: time_now[0])
    before = cache.get()
    jobs.run_graph_job(telemetry(spark, sf_dir), root)
    loaded = cache.get()
    rows, counts = telemetry(spark, sf_dir), []

    def count(kind: str, ctx) -> None:
        verdicts = scoring.graph_scored(rows, ctx).agg(
            F.lit(kind).alias("kind"),
            F.count("*").alias("readings"),
            F.count_if(F.col("prediction_score") == -1).alias("critical"),
        )
        counts.append(cut(verdicts))  # a reload lets go of the frame before

    count("before", before)
    count("after", loaded)
    tables = jobs.load_graph_tables(spark, root)
    harmless = jobs.GraphTables(
        tables.ranks.drop("last_computed"),
        tables.communities,
        tables.risk.withColumn("risk_score", F.lit(0.0)).drop("last_computed"),
    )
    jobs.save_graph_tables(harmless, root)
    time_now[0] = 59.0
    count("too soon", cache.get())
    time_now[0] = 61.0
    count("reloaded", cache.get())
    return reduce(DataFrame.unionByName, counts)


def archive_stream(spark, sf_dir):
    return six(readers.read_archive(spark, _archived(spark, sf_dir)))


def controller_stream_(spark, sf_dir):
    """Controllers fed in two batches, the first half of the month and the second."""
    root, source = work_path(spark, "controller"), work_path(spark, "judged")
    rows = judged(spark, sf_dir)
    early = F.col("event_time") < F.timestamp_seconds(F.lit(1705276800))  # 15 January 2024
    for part in (rows.where(early), rows.where(~early)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        controller_stream(
            stream, root, f"{root}/checkpoint", SLOW, ORDER, availableNow=True
        ).awaitTermination()
    return six(controller_states(spark, root).drop("last_updated"))


@dataclass(frozen=True)
class BaseVerdict:
    """Stands in for the edge model: the verdict of the base thresholds, which SQL can repeat."""

    def judge(self, rows):
        return scoring.base_scored(rows).withColumn("prediction", F.col("prediction_score"))


def _nodes(spark, sf_dir) -> tuple[str, str]:
    """Edge and cloud as streams: readings in, messages between them. (root, topics)"""

    def run():
        root, topics, source = (work_path(spark, n) for n in ("nodes", "node_topics", "readings"))

        def send(messages, topic):
            writers.write_messages(messages, topic, fmt="files", path=topics)

        rows = telemetry(spark, sf_dir).drop("connected_to")
        rows.write.parquet(source)
        readings = spark.readStream.schema(rows.schema).parquet(source)
        nodes.edge_stream(
            readings, f"{root}/edge", f"{root}/edge-checkpoint", BaseVerdict(), send, ORDER,
            availableNow=True,
        ).awaitTermination()
        both = readers.read_messages(
            spark, [readers.ALERT_TOPIC, readers.CLOUD_TOPIC], fmt="files", path=topics
        )
        nodes.cloud_stream(
            both, f"{root}/cloud", f"{root}/cloud-checkpoint", send, availableNow=True
        ).awaitTermination()
        return root, topics

    return _once(spark, sf_dir, "nodes", run)


def edge_stream(spark, sf_dir):
    """Alerts that the edge sent and the cloud stored."""
    root, _ = _nodes(spark, sf_dir)
    return _flat_alerts(spark.read.parquet(f"{root}/cloud/alerts"))


def cloud_stream(spark, sf_dir):
    """Records that reached the cloud's history, and whether a retrain notice was sent for them."""
    root, topics = _nodes(spark, sf_dir)
    history = readers.read_history_csv(spark, f"{root}/cloud/history")
    sent = readers.read_messages(
        spark, [readers.CONTROLLER_TOPIC], fmt="files", path=topics, streaming=False
    )
    notice = readers.parse_feedback(sent).first()
    rows = ml.apply_linear_code(history, ml.load_code(spark, f"{root}/cloud/model/*"))
    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("tool_wear").alias("wear"),
        F.lit(notice["records_trained"]).cast("bigint").alias("trained"),
        (F.abs(F.avg("recon_error") - notice["training_loss"]) < 1e-9).alias("model_agrees"),
    )


def messages_once(spark, sf_dir):
    """What the cloud holds after the edge's batch ran three times, once after the cloud had read."""
    root, topics = work_path(spark, "once"), work_path(spark, "once_topics")
    rows = telemetry(spark, sf_dir).drop("connected_to")

    def send(messages, topic):
        writers.write_messages(messages, topic, fmt="files", path=topics)

    for runs in (2, 1):
        for _ in range(runs):
            nodes.edge_batch(rows, 0, f"{root}/edge", BaseVerdict(), send, ORDER)
        both = readers.read_messages(spark, [readers.ALERT_TOPIC, readers.CLOUD_TOPIC], fmt="files", path=topics)
        nodes.cloud_stream(
            both, f"{root}/cloud", f"{root}/cloud-checkpoint", send, availableNow=True
        ).awaitTermination()
    history = readers.read_history_csv(spark, f"{root}/cloud/history").select(F.lit("history").alias("kept"), "tool_wear")
    alerts = _flat_alerts(spark.read.parquet(f"{root}/cloud/alerts")).select(F.lit("alerts").alias("kept"), "tool_wear")
    return history.unionByName(alerts).groupBy("kept").agg(
        F.count(F.lit(1)).alias("records"), F.sum("tool_wear").cast("bigint").alias("wear")
    )


def backlog_notices(spark, sf_dir):
    """Backlog per window where a notice goes out with every 500th record of all edges."""
    routed = routing(spark, sf_dir).routed
    notices = ctl.retrain_trigger(routed.where("to_cloud"), ORDER).select(F.col("event_time").alias("notice_time"))
    return ctl.cloud_backlog(routed, feedback=notices)


def feedback_loop(spark, sf_dir):
    """Edge and cloud in turns: the notices for the first half of the month reach the edge with the second."""
    root, topics, source = (work_path(spark, n) for n in ("loop", "loop_topics", "loop_readings"))

    def send(messages, topic):
        writers.write_messages(messages, topic, fmt="files", path=topics)

    def listen(*names):
        return readers.read_messages(spark, list(names), fmt="files", path=topics)

    send(spark.createDataFrame([("{}",)], "value string"), readers.CONTROLLER_TOPIC)  # not a notice
    rows = telemetry(spark, sf_dir).drop("connected_to")
    early = F.col("event_time") < F.timestamp_seconds(F.lit(1705276800))  # 15 January 2024
    for part in (rows.where(early), rows.where(~early)):
        part.write.mode("append").parquet(source)
        nodes.edge_stream(
            spark.readStream.schema(rows.schema).parquet(source), f"{root}/edge", f"{root}/edge-checkpoint",
            BaseVerdict(), send, ORDER, notices=readers.parse_feedback(listen(readers.CONTROLLER_TOPIC)),
            availableNow=True,
        ).awaitTermination()
        nodes.cloud_stream(
            listen(readers.ALERT_TOPIC, readers.CLOUD_TOPIC), f"{root}/cloud", f"{root}/cloud-checkpoint", send,
            availableNow=True,
        ).awaitTermination()
    return controller_backlog(spark, f"{root}/edge")


# The same operators where nothing may be broadcast, keys are hot early and graphs are bucketed.
TINY = ScaleLimits(broadcast_bytes=0, hot_rows=200, bucket_rows=50, page_rows=4, block_rows=16)


def pagerank_large(spark, sf_dir):
    return six(graph.pagerank(*jobs.machine_graph(telemetry(spark, sf_dir)), limits=TINY))


def label_propagation_large(spark, sf_dir):
    return graph.label_propagation(*jobs.machine_graph(telemetry(spark, sf_dir)), limits=TINY)


def graph_scored_large(spark, sf_dir):
    rows = scoring.graph_scored(telemetry(spark, sf_dir), context(spark, sf_dir), limits=TINY)
    return six(rows.select("event_id", "machine_id", "graph_adjustment", "prediction_score"))


def route_readings_large(spark, sf_dir):
    rows = jobs.run_routing(judged(spark, sf_dir), SLOW, ORDER, limits=TINY).routed
    return rows.select("event_id", "edge_id", "window_no", "seq", "to_cloud")


# SURVEY section 2 name -> query, for the names that differ from the function here.
_ALIASES = {
    "simulated_rtt": simulated_rtt_,
    "alert_feed": alert_feed_,
    "stream_scored": stream_scored_,
    "controller_stream": controller_stream_,
}

_NAMES = """
src_kafka_json src_multi_topic src_feedback src_archive_json src_stable_snapshot src_csv
src_serving_table
sink_alerts_append sink_states_upsert sink_pagerank sink_communities sink_risk
sink_controller_state sink_archive_batches sink_cloud_history sink_kafka_json sink_model
show_preview
parse_telemetry quarantine_malformed project_alerts project_states filter_anomalies
topology_enrich drop_self_loops drop_missing default_missing nest_alert tag_offload
min_rows_gate sample_limit
join_pagerank join_community join_risk graph_context join_community_rank
graph_nodes graph_edges community_agg median_rank risk_norm_max batch_adjust_stats
feature_minmax edge_run_stats
community_risk graph_adjustment graph_scored base_scored
pagerank label_propagation graph_build
rf_features rf_split rf_train rf_predict rf_evaluate rank_metrics iforest_fit iforest_score
iforest_refreshed edge_model_alerts recon_error
simulated_rtt route_readings edge_alerts controller_windows controller_fold
controller_fold_many controller_latest retrain_trigger retrain_feedback retrain_moments cloud_backlog
latest_alerts alert_ticker sensor_series states_snapshot fleet_summary machines_by_status
pagerank_board pagerank_top10 community_members community_top5 controller_lookup
controller_card latency_bands alert_feed
stream_scored context_refresh latest_state archive_stream controller_stream
edge_stream cloud_stream messages_once backlog_notices feedback_loop
pagerank_large label_propagation_large graph_scored_large route_readings_large
""".split()


def queries() -> dict:
    return {name: _ALIASES.get(name) or globals()[name] for name in _NAMES}
