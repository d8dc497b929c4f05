import json

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import iforest, ingest, ml, scoring
from fleetpulse.params import ControllerParams, IsolationParams
from fleetpulse.plans import jobs, serving
from fleetpulse.session import filesystem, shared_dir
from fleetpulse.sources import readers, writers
from fleetpulse.sources.tables import KeyedTable, SnapshotTable
from fleetpulse.streaming import nodes
from fleetpulse.streaming import scored as stream
from fleetpulse.streaming.controller import control_batch, controller_backlog, controller_states, controller_stream

PARAMS = ControllerParams(window_size=20, retrain_every=30)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def send(rows, path):
    writers.write_messages(ingest.to_wire_json(rows), readers.RAW_TOPIC, fmt="files", path=path)


def run_scoring(spark, topics, root):
    messages = readers.read_messages(spark, [readers.RAW_TOPIC], fmt="files", path=topics)
    stream.stream_scored(
        ingest.parse_telemetry(messages), root, f"{root}/checkpoint", compact_every=2, availableNow=True
    ).awaitTermination()


@pytest.mark.parametrize("with_graph", [False, True])
def test_stream_equals_batch(spark, readings, tmp_path, with_graph):
    topics, root = str(tmp_path / "topics"), str(tmp_path / "out")
    context = None
    if with_graph:
        assert jobs.run_graph_job(readings, root)
        context = jobs.load_graph_tables(spark, root).context()
    # The newest readings come first, so the later batches are late.
    for first, last in ((21, 31), (11, 20), (1, 10)):
        send(readings.where(F.dayofmonth("event_time").between(first, last)), topics)
        run_scoring(spark, topics, root)
    batch = scoring.graph_scored(readings, context)
    alerts = KeyedTable.named(root, "realtime_alerts").read(spark)
    assert same(alerts, scoring.project_alerts(batch))
    assert same(KeyedTable.named(root, "machine_states").read(spark), scoring.latest_state(batch))
    shown = stream.newest_alerts_table(root).read(spark)
    assert same(serving.latest_alerts(shown), serving.latest_alerts(alerts))


def test_replayed_batch_and_malformed_messages(spark, readings, tmp_path):
    root = str(tmp_path)
    bad = spark.createDataFrame([("{",), ("bad",)], "value string")
    batch = ingest.parse_telemetry(ingest.to_wire_json(readings).unionAll(bad))
    context = stream.GraphContext(spark, root)
    for _ in range(2):
        stream.score_batch(batch, 0, context, root)
    assert spark.read.parquet(f"{root}/quarantine").count() == 2
    states = KeyedTable.named(root, "machine_states").read(spark)
    assert states.count() == readings.select("machine_id").distinct().count()
    expected = scoring.project_alerts(scoring.base_scored(readings)).count()
    assert KeyedTable.named(root, "realtime_alerts").read(spark).count() == expected


def test_untimed_alerts_of_a_machine_stay_apart(spark, readings, tmp_path):
    root = str(tmp_path)
    one = scoring.filter_anomalies(scoring.base_scored(readings)).limit(1).select(*readings.columns)
    untimed = one.withColumn("event_time", F.lit(None).cast("timestamp"))
    five = untimed.withColumn("air_temp", F.explode(F.array(*(F.lit(float(x)) for x in (1, 2, 3, 3, 3)))))
    stream.score_batch(five, 0, stream.GraphContext(spark, root), root)
    log = KeyedTable.named(root, "realtime_alerts")
    log.compact(spark)
    for found in (log.read(spark), stream.newest_alerts_table(root).read(spark)):
        assert sorted(r.air_temp for r in found.collect()) == [1, 2, 3, 3, 3]
    assert same(log.read(spark), stream.newest_alerts_table(root).read(spark))
    log.upsert(scoring.project_alerts(scoring.base_scored(five)), 1)
    assert log.read(spark).count() == 10


def test_batch_without_alerts_writes_none(spark, readings, tmp_path):
    calm = readings.withColumn("tool_wear", F.lit(0)).withColumn("rotational_speed", F.lit(2000.0))
    stream.score_batch(calm, 0, stream.GraphContext(spark, str(tmp_path)), str(tmp_path))
    assert not KeyedTable.named(str(tmp_path), "realtime_alerts").exists(spark)
    assert KeyedTable.named(str(tmp_path), "machine_states").exists(spark)


def test_context_is_reloaded_after_its_time_and_kept_on_error(spark, readings, tmp_path, monkeypatch):
    now, root = [0.0], str(tmp_path)
    context = stream.GraphContext(spark, root, 60, lambda: now[0])
    assert context.get() is None
    jobs.run_graph_job(readings, root)
    first = context.get()
    assert first is not None and context.fits
    now[0] = 59
    assert context.get() is first
    now[0] = 61
    second = context.get()
    assert second is not first
    now[0] = 200

    def broken(*_):
        raise RuntimeError("store is down")

    monkeypatch.setattr(stream, "load_graph_tables", broken)
    assert context.get() is second


def test_archive_stream_is_what_readers_see(spark, readings, tmp_path):
    topics, archive = str(tmp_path / "topics"), str(tmp_path / "archive")
    send(readings, topics)
    messages = readers.read_messages(spark, [readers.RAW_TOPIC], fmt="files", path=topics)
    parsed = ingest.parse_telemetry(messages)
    writers.archive_stream(
        parsed, archive, str(tmp_path / "checkpoint"), writers.SMALL_FILE_ROWS, availableNow=True
    ).awaitTermination()
    writers.archive_rows(readings).write.mode("append").json(f"{archive}/stray")
    assert readers.read_archive(spark, archive).count() == readings.count()
    files = spark.read.json(archive).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] <= writers.SMALL_FILE_ROWS


def test_history_stream(spark, readings, tmp_path):
    topics, path = str(tmp_path / "topics"), str(tmp_path / "history")
    rows = ingest.tag_offload(readings)
    writers.write_messages(
        ingest.to_wire_json(rows, ["routing", "latency_ms"]), readers.CLOUD_TOPIC, fmt="files", path=topics
    )
    messages = readers.read_messages(spark, [readers.CLOUD_TOPIC], fmt="files", path=topics)
    writers.history_stream(
        readers.parse_cloud(messages), path, str(tmp_path / "checkpoint"), availableNow=True
    ).awaitTermination()
    back = readers.read_history_csv(spark, path)
    assert same(back, rows.select(*back.columns))


def test_feed_emits_the_newest_alerts(spark, readings, tmp_path):
    root, topics, seen = str(tmp_path / "out"), str(tmp_path / "topics"), []
    send(readings, topics)
    ticks = readers.read_messages(spark, [readers.RAW_TOPIC], fmt="files", path=topics)

    def emit(alerts, _):
        seen.append([r.alert_time for r in alerts.collect()])

    stream.alert_feed(ticks, root, emit, availableNow=True).awaitTermination()
    assert seen == []
    run_scoring(spark, topics, root)
    stream.alert_feed(ticks, root, emit, availableNow=True).awaitTermination()
    assert len(seen) == 1 and len(seen[0]) == 15 and seen[0] == sorted(seen[0], reverse=True)


def intermediate_tables(spark):
    fs, folder = filesystem(spark, f"{shared_dir(spark)}/fleetpulse")
    return len(fs.listStatus(folder)) if fs.exists(folder) else 0


def judged(readings):
    rows = scoring.base_scored(readings).select(
        "event_id", "event_time", "machine_id", "latency_ms", "draw",
        (F.col("prediction_score") == -1).alias("outlier"),
        # One edge sends most of the readings.
        F.when(F.col("event_id") % 3 > 0, "busy").otherwise(F.col("edge_id")).alias("edge_id"),
    )
    return rows


def test_controller_stream_equals_batch_in_time_order(spark, readings, tmp_path):
    rows, root, source = judged(readings), str(tmp_path / "out"), str(tmp_path / "in")
    order = ["event_time", "event_id"]
    made = []
    for low, high in ((1, 9), (9, 10), (10, 32)):
        before = intermediate_tables(spark)
        day = F.dayofmonth("event_time")
        rows.where((day >= low) & (day < high)).write.mode("append").parquet(source)
        controller_stream(
            spark.readStream.schema(rows.schema).parquet(source),
            root, f"{root}/checkpoint", "outlier", order, PARAMS, availableNow=True,
        ).awaitTermination()
        made.append(intermediate_tables(spark) > before)
    run = jobs.run_routing(rows, "outlier", order, PARAMS)
    assert set(made) == {False}, "the batches leave no intermediate tables behind"
    routed = spark.read.parquet(f"{root}/routed").select("event_id", "seq", "to_cloud")
    assert same(routed, run.routed.select("event_id", "seq", "to_cloud"))
    trace = spark.read.parquet(f"{root}/trace").drop("batch")
    assert same(trace, run.states)
    final = controller_states(spark, root, PARAMS)
    sent = run.routed.groupBy("edge_id").agg(F.count_if("to_cloud").alias("n")).collect()
    backlog = {r.controller_id: r.cloud_backlog for r in final.collect()}
    assert {r.edge_id: r.n % 30 for r in sent if r.edge_id in backlog} == backlog


def test_replayed_controller_batch(spark, readings, tmp_path):
    rows, root, order = judged(readings), str(tmp_path), ["event_time", "event_id"]
    half = F.dayofmonth("event_time") < 15
    control_batch(rows.where(half), 0, root, "outlier", order, PARAMS)
    results = []
    for _ in range(2):
        control_batch(rows.where(~half), 1, root, "outlier", order, PARAMS)
        results.append(controller_states(spark, root, PARAMS).drop("last_updated").collect())
    assert sorted(results[0]) == sorted(results[1])
    assert spark.read.parquet(f"{root}/routed").count() == readings.count()


def test_graph_tables_are_taken_together(spark, readings, tmp_path):
    root = str(tmp_path)
    assert jobs.load_graph_tables(spark, root) is None
    tables = jobs.graph_tables(readings)
    jobs.save_graph_tables(tables, root)
    SnapshotTable.named(root, "failure_communities").replace(tables.communities.limit(0))  # half a run
    loaded = jobs.load_graph_tables(spark, root)
    assert loaded.communities.count() == tables.communities.count() > 0
    twice = jobs.GraphTables(
        tables.ranks, tables.communities.unionByName(tables.communities.withColumn("community_id", F.lit("x"))), tables.risk
    )
    with pytest.raises(ValueError):
        jobs.save_graph_tables(twice, root)


def test_cloud_retrains_at_the_controllers_interval(spark, readings, tmp_path):
    root, sent = str(tmp_path), []
    rows = ingest.tag_offload(readings.orderBy("event_id").limit(250))
    messages = ingest.to_wire_json(rows, ["routing", "latency_ms"]).withColumn("topic", F.lit(readers.CLOUD_TOPIC))

    def send(df, topic):
        sent.append((topic, df.first().value))

    for batch_id, interval in ((0, 300), (0, 300), (1, 300), (2, 300)):
        nodes.cloud_batch(messages, batch_id, root, send, retrain_interval=interval)
    assert [t for t, _ in sent] == [readers.CONTROLLER_TOPIC] * 2  # at 500 and at 750 records
    assert '"records_trained":500' in sent[0][1] and '"records_trained":750' in sent[1][1]
    assert nodes._records(root).read(spark).first().records == 750


def test_cloud_reads_each_batch_once(spark, readings, tmp_path, monkeypatch):
    """A retraining takes what earlier batches left as moments, and gives the model of all records."""
    root, read, rows = str(tmp_path), [], ingest.tag_offload(readings)
    real = readers.read_history_csv
    monkeypatch.setattr(readers, "read_history_csv", lambda s, path: read.append(path) or real(s, path))
    for batch_id in range(3):
        part = rows.where(F.col("event_id") % 3 == batch_id)
        messages = ingest.to_wire_json(part, ["routing", "latency_ms"]).withColumn("topic", F.lit(readers.CLOUD_TOPIC))
        for _ in range(1 + batch_id % 2):  # the second batch is replayed
            nodes.cloud_batch(messages, batch_id, root, lambda *_: None, PARAMS)
    assert read == [f"{root}/history/batch={n}" for n in (0, 1, 1, 2)]
    history = real(spark, f"{root}/history")
    code, whole = ml.load_code(spark, f"{root}/model/batch=2"), ml.fit_linear_code(history)
    assert code.means == pytest.approx(whole.means) and code.ranges == pytest.approx(whole.ranges)
    assert ml.read_moments(nodes._moments(root).read(spark)).n == history.count() == readings.count()


class Fixed:
    """A model that finds nothing."""

    def judge(self, rows):
        return rows.withColumn("prediction", F.lit(1))


def test_edge_takes_readings_and_notices_in_order_of_time(spark, tmp_path):
    """Whatever batch they come in, with a delay that covers the disorder."""
    seconds = [[10, 20, 30, 70], [40, 50, 60], [], [200]]  # 70 comes before 40 to 60
    notices = [[55.0], [], [25.0], []]  # the first comes early, the second when 30 has been passed on
    readings, told, root = str(tmp_path / "r"), str(tmp_path / "n"), str(tmp_path / "edge")
    row = "event_id bigint, event_time timestamp, machine_id string, edge_id string, latency_ms int, draw double"
    notice = "type string, records_trained int, training_loss double, timestamp double"
    waiting = []
    for times, marks in zip(seconds, notices):
        made = spark.createDataFrame([(t,) for t in times], "t bigint").select(
            F.col("t").alias("event_id"), F.timestamp_seconds("t").alias("event_time"), F.lit("m").alias("machine_id"),
            F.lit("e").alias("edge_id"),
            F.lit(50).alias("latency_ms"), F.lit(0.5).alias("draw"),
        )
        made.write.mode("append").parquet(readings)
        spark.createDataFrame([("retrain_complete", 1, 0.0, m) for m in marks], notice).write.mode("append").parquet(told)
        nodes.edge_stream(
            spark.readStream.schema(row).parquet(readings), root, f"{root}-checkpoint", Fixed(), lambda *_: None,
            ["event_time", "event_id"], ControllerParams(window_size=2),
            notices=spark.readStream.schema(notice).parquet(told), delay=30.0, availableNow=True,
        ).awaitTermination()
        found = controller_backlog(spark, root).orderBy("window_no").collect()
        waiting.append([(r.window_no, r.cloud_messages, r.cloud_backlog) for r in found])
    assert waiting[0] == [(0, 2, 2), (1, 1, 3)]  # up to 40 is passed on
    assert waiting[1] == waiting[2] == [(0, 2, 2), (1, 2, 4)]  # only 40 more
    # The late notice has emptied all four, the one of 55 the reading of 50 as well.
    assert waiting[3] == [(0, 2, 2), (1, 2, 4), (2, 2, 1), (3, 1, 2)]


def test_edge_judges_with_a_forest_that_follows_the_readings(spark, readings, tmp_path):
    params = IsolationParams(trees=10, sample_size=32)
    source, root = str(tmp_path / "r"), str(tmp_path / "edge")
    learner = jobs.EdgeLearner(root, "event_id", params)
    rows, sent = readings.drop("connected_to"), []
    for part in (rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")):
        part.write.mode("append").parquet(source)
        nodes.edge_stream(
            spark.readStream.schema(rows.schema).parquet(source), root, f"{root}-checkpoint", Fixed(),
            lambda messages, topic: sent.append((topic, messages.count())), ["event_time", "event_id"], PARAMS,
            learner=learner, availableNow=True,
        ).awaitTermination()
    alerts = [n for topic, n in sent if topic == readers.ALERT_TOPIC]
    assert alerts[0] == 0 and max(alerts) > 0  # the first batch is judged by the model given
    learned = learner.model(rows, 10**9, None).forest
    assert same(learned, iforest.iforest_fit(readings, "event_id", params))


def test_messages_of_a_batch_that_ran_again_count_once(spark, readings, tmp_path):
    topics, root = str(tmp_path / "topics"), str(tmp_path / "nodes")
    rows = readings.drop("connected_to")
    halves = rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")

    def to_topic(messages, topic):
        writers.write_messages(messages, topic, fmt="files", path=topics)

    def cloud():
        both = readers.read_messages(spark, [readers.ALERT_TOPIC, readers.CLOUD_TOPIC], fmt="files", path=topics)
        nodes.cloud_stream(both, f"{root}/cloud", f"{root}/cloud-checkpoint", to_topic, availableNow=True).awaitTermination()

    def edge(half, number):
        nodes.edge_batch(half, number, f"{root}/edge", All(), to_topic, ["event_time", "event_id"], PARAMS)

    def plain(n):  # without ids: all are kept, equal ones too
        to_topic(spark.createDataFrame([('{"tool_wear": 1}',)] * n, "value string"), readers.CLOUD_TOPIC)

    edge(halves[0], 0)
    edge(halves[0], 0)  # twice in one batch of the cloud
    plain(3)
    cloud()
    edge(halves[0], 0)  # again in a later one, with new messages
    edge(halves[1], 1)
    plain(2)
    cloud()
    routed = spark.read.parquet(f"{root}/edge/routed")
    sent = routed.where("to_cloud").count()
    assert 0 < sent < routed.count()
    assert readers.read_history_csv(spark, f"{root}/cloud/history").count() == sent + 5
    assert spark.read.parquet(f"{root}/cloud/alerts").count() == routed.count() - sent
    assert SnapshotTable(f"{root}/cloud/records", "records bigint").read(spark).first().records == sent + 5


class All:
    """A model that takes every reading for an outlier."""

    def judge(self, rows):
        return rows.withColumn("prediction", F.lit(-1))


def test_message_files_are_compressed_and_bounded(spark, tmp_path):
    """Messages repeat their field names: as plain text they were most of what edge and cloud wrote."""
    sent = [json.dumps({"Product ID": f"M{i}", "Tool wear [min]": i % 7, "routing": "cloud_offload"}) for i in range(900)]
    rows = spark.createDataFrame([(m,) for m in sent], "value string").coalesce(1)
    writers.write_messages(rows, readers.CLOUD_TOPIC, fmt="files", path=str(tmp_path), file_rows=300)
    files = [f for f in (tmp_path / f"topic={readers.CLOUD_TOPIC}").iterdir() if f.name.startswith("part-")]
    assert len(files) == 3
    assert sum(f.stat().st_size for f in files) * 3 < sum(map(len, sent))
    got = readers.read_messages(spark, [readers.CLOUD_TOPIC], fmt="files", path=str(tmp_path), streaming=False)
    assert sorted(r.value for r in got.collect()) == sorted(sent)
