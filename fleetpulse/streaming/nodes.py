"""The edge and the cloud as streams that talk over topics.

The edge judges readings with its model, routes them under the controller, and sends alerts and
offloaded readings; notices of the cloud empty its backlog. The cloud keeps alerts and history, and after every so many records retrains
its model, saves it and sends a notice. Folders are named after the batch, so a replayed batch
overwrites what it wrote; its messages are sent again under the same ids, and the cloud takes each once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from fleetpulse.functions.expressions import epoch_seconds, from_epoch_seconds
from fleetpulse.operators import controller as ctl, ml
from fleetpulse.operators.ingest import nest_alert, tag_offload, wire_struct
from fleetpulse.params import ControllerParams, ScaleLimits
from fleetpulse.plans import jobs
from fleetpulse.session import scratch, write_once
from fleetpulse.sources import readers
from fleetpulse.sources.tables import SnapshotTable, commit_number
from fleetpulse.sources.writers import as_messages, history_rows
from fleetpulse.streaming.controller import control_batch

Send = Callable[[DataFrame, str], None]  # messages (with ``value``) and the topic they go to

OUTLIER = "prediction = -1"


def edge_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    model: jobs.EdgeModel,
    send: Send,
    order_cols: list[str],
    params: ControllerParams = ControllerParams(),
    limits: ScaleLimits = ScaleLimits(),
    notices: DataFrame | None = None,
) -> None:
    """Judge, route and send one micro-batch; the controller's state moves on below ``root``."""
    judged = model.judge(batch)
    control_batch(judged, batch_id, root, OUTLIER, order_cols, params, limits, notices)
    routed = batch.sparkSession.read.parquet(f"{root}/routed/batch={batch_id}")
    # The number of a reading at its edge is the same when the batch runs again.
    named = F.concat_ws(":", F.coalesce("edge_id", F.lit("")), F.col("seq").cast("string"))
    routed = routed.withColumn("message_id", named)
    alerts = nest_alert(ctl.edge_alerts(routed, OUTLIER), keep=["message_id"])
    send(as_messages(alerts), readers.ALERT_TOPIC)
    offloaded = tag_offload(routed.where("to_cloud"))
    body = wire_struct(offloaded, ["routing", "latency_ms", "message_id"])
    send(as_messages(offloaded, body), readers.CLOUD_TOPIC)


def released(rows: DataFrame, batch_id: int, root: str, delay: float) -> tuple[DataFrame, Callable[[], None]]:
    """The rows, of this batch and held back before, whose time has come, and how to note the rest.

    Time is that of the newest row so far, less ``delay`` seconds. Later rows are kept below
    ``root`` and come with a later batch; rows without a time come at once.
    """
    spark = rows.sparkSession
    clock = SnapshotTable(f"{root}/clock", "mark timestamp")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    held = SnapshotTable(f"{root}/held", columns)
    every = write_once(held.read(spark, before=batch_id).unionByName(rows), "arrived")
    newest = every.agg((F.max("event_time") - F.make_dt_interval(secs=F.lit(delay))).alias("mark"))
    marks = clock.read(spark, before=batch_id).unionByName(newest)
    mark = write_once(marks.agg(F.max("mark").alias("mark")), "mark")
    waits = F.coalesce(F.col("event_time") > mark.scalar(), F.lit(False))

    def note() -> None:
        held.replace(every.where(waits), version=batch_id)
        clock.replace(mark, version=batch_id)

    return every.where(~waits), note


def _records(root: str) -> SnapshotTable:
    return SnapshotTable(f"{root}/records", "records bigint")


def _moments(root: str) -> SnapshotTable:
    return SnapshotTable(f"{root}/moments", ml.MOMENTS)


def cloud_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    send: Send,
    params: ControllerParams = ControllerParams(),
    retrain_interval: int | None = None,
) -> None:
    """Store one micro-batch of messages by topic, and retrain when enough records have come.

    ``batch`` has ``topic`` and ``value``. ``retrain_interval`` is the controller's value where it
    shall apply; ``params.retrain_every`` otherwise.
    """
    spark, every = batch.sparkSession, retrain_interval or params.retrain_every
    alerts = readers.parse_alerts(readers.for_topic(batch, readers.ALERT_TOPIC))
    alerts.write.mode("overwrite").parquet(f"{root}/alerts/batch={batch_id}")
    cloud = history_rows(readers.parse_cloud(readers.for_topic(batch, readers.CLOUD_TOPIC)))
    folder = f"{root}/history/batch={batch_id}"
    cloud.write.mode("overwrite").option("header", True).option("nullValue", "").csv(folder)
    before = _records(root).read(spark, before=batch_id).first()
    seen = before["records"] if before else 0
    rows = readers.read_history_csv(spark, folder)
    records = seen + rows.count()
    # The model is fitted on all records so far from their moments: no batch is read a second time.
    newest = F.max(epoch_seconds(F.col("event_time")))
    held = ml.read_moments(_moments(root).read(spark, before=batch_id))
    found = ml.merge_moments(held, ml.read_moments(ml.moments(rows, at=newest)))
    if records // every > seen // every:
        notice = jobs.retrain_on(spark, found, params, path=f"{root}/model/batch={batch_id}")
        if notice is not None:
            send(as_messages(notice), readers.CONTROLLER_TOPIC)
    if found is not None:
        _moments(root).replace(found.frame(spark), version=batch_id)
    now = spark.range(1).select(F.lit(records).cast("bigint").alias("records"))
    _records(root).replace(now, version=batch_id)


def _start(rows: DataFrame, checkpoint: str, root: str, handle, trigger: dict):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                number = commit_number(spark, root, batch_id)
                with scratch(spark):
                    handle(batch, number)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def edge_stream(
    readings: DataFrame,
    root: str,
    checkpoint: str,
    model: jobs.EdgeModel,
    send: Send,
    order_cols: list[str],
    params: ControllerParams = ControllerParams(),
    notices: DataFrame | None = None,
    delay: float = 0.0,
    learner: jobs.EdgeLearner | None = None,
    **trigger,
):
    """Start the edge on readings with ``edge_id``, ``latency_ms`` and ``draw``.

    ``notices`` is the stream of retrain notices. Both are one stream, taken in the order of event
    time: what is newer than the newest so far less ``delay`` seconds waits for a later batch. A
    notice empties the backlog in the window that its time falls in.

    With a ``learner``, ``model`` judges the first batch, and each later one is judged by the forest
    of all readings before it.
    """

    def plain(batch: DataFrame, number: int, told: DataFrame | None = None) -> None:
        current = learner.model(batch, number, model) if learner else model
        edge_batch(batch, number, root, current, send, order_cols, params, notices=told)
        if learner:
            learner.learn(batch, number)

    def ordered(batch: DataFrame, number: int) -> None:
        rows, note = released(batch, number, root, delay)
        told = rows.where("_notice").select(F.col("event_time").alias("notice_time"))
        given = rows.where("NOT _notice").drop("_notice")
        plain(given, number, told)
        note()

    if notices is None:
        return _start(readings, checkpoint, root, plain, trigger)
    told = notices.select(from_epoch_seconds(F.col("timestamp")).alias("event_time"), F.lit(True).alias("_notice"))
    both = readings.withColumn("_notice", F.lit(False)).unionByName(told, allowMissingColumns=True)
    return _start(both, checkpoint, root, ordered, trigger)


def cloud_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    send: Send,
    params: ControllerParams = ControllerParams(),
    retrain_interval: int | None = None,
    within: str | None = "1 hour",
    **trigger,
):
    """Start the cloud on messages of the alert and cloud topics.

    A message that comes again ``within`` that time is left out; None takes all as they come.
    """

    def handle(batch: DataFrame, number: int) -> None:
        cloud_batch(batch, number, root, send, params, retrain_interval)

    taken = readers.first_of_each(messages, within) if within else messages
    return _start(taken, checkpoint, root, handle, trigger)
