"""Streaming scoring: readings in, alerts and machine states out."""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from fleetpulse.operators.distribute import fits_broadcast
from fleetpulse.operators.ingest import split_malformed
from fleetpulse.operators.scoring import (
    graph_scored,
    newest_per_key,
    project_alerts,
    project_states,
)
from fleetpulse.params import ScaleLimits, ScoringParams
from fleetpulse.plans.jobs import load_graph_tables
from fleetpulse.plans.serving import ALERT_COLUMNS, newest_alerts
from fleetpulse.schema import SERVING_TABLES
from fleetpulse.sources.tables import KeyedTable, SnapshotTable, commit_number

log = logging.getLogger("fleetpulse")


def newest_alerts_table(root: str) -> SnapshotTable:
    return SnapshotTable(f"{root}/latest_alerts", SERVING_TABLES["realtime_alerts"][0])


class GraphContext:
    """Graph context for the batches of a stream, reloaded when it is older than ``ttl`` seconds.

    A failed reload keeps the one before; without any the base thresholds apply.
    """

    def __init__(self, spark: SparkSession, root: str, ttl: float = 60.0, clock=time.monotonic):
        self._spark, self._root, self._ttl, self._clock = spark, root, ttl, clock
        self._frame: DataFrame | None = None
        self._loaded_at: float | None = None
        self.fits: bool | None = None

    def get(self) -> DataFrame | None:
        now = self._clock()
        fresh = self._loaded_at is not None and now - self._loaded_at < self._ttl
        if self._frame is not None and fresh:
            return self._frame
        try:
            tables = load_graph_tables(self._spark, self._root)
            if tables is None:
                return self._frame
            loaded = tables.context().persist(StorageLevel.MEMORY_AND_DISK)
            # The one pass that fills the cache also tells whether it can be broadcast.
            fits = fits_broadcast(loaded)
        except Exception as error:  # the stream goes on with the context it has
            log.warning("graph context not loaded: %s", error)
            return self._frame
        previous, self._frame, self._loaded_at, self.fits = self._frame, loaded, now, fits
        if previous is not None:
            previous.unpersist()
        return self._frame


def score_batch(
    batch: DataFrame,
    batch_id: int,
    context: GraphContext,
    root: str,
    params: ScoringParams = ScoringParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> None:
    """Score one micro-batch and write it below ``root``. A replayed batch id changes nothing.

    The scored rows are computed once, by the count that also says which tables have anything
    to write; the tables are then written side by side. Malformed messages go to
    ``quarantine``. ``latest_alerts`` keeps the newest alerts: the newest of those before and
    of this batch, so the display never reads the whole history.
    """
    batch_id = commit_number(batch.sparkSession, root, batch_id)
    known = context.get()
    scored = graph_scored(batch, known, params, limits, context.fits)
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        usable, malformed = split_malformed(scored)
        # Fixed here: the alerts are computed for each table, and the keys must be the same.
        now = F.timestamp_micros(F.lit(time.time_ns() // 1000))
        alerts, states = project_alerts(usable, now), project_states(usable)
        keyed = F.col("machine_id").isNotNull()
        adjustment = F.col("graph_adjustment")
        rows, good, alarming, mean, most, enriched = scored.agg(
            F.count(F.lit(1)),
            F.count_if(keyed),
            F.count_if(keyed & (F.col("prediction_score") == -1.0)),
            F.avg(adjustment),
            F.max(adjustment),
            F.count_if(adjustment > 0),
        ).first()
        log.info(
            "batch %d: %d readings, %d alerts, adjustment mean %s max %s, %d enriched",
            batch_id, rows, alarming, mean, most, enriched,
        )
        writes = []
        if rows > good:
            lost = malformed.select(*batch.columns).write.mode("overwrite")
            writes.append(lambda: lost.parquet(f"{root}/quarantine/batch={batch_id}"))
        if alarming:
            log_table = KeyedTable.named(root, "realtime_alerts")
            # Almost every alert has a key of its own: merging them is left to the readers.
            writes.append(lambda: log_table.upsert(alerts, batch_id, combine=False))
            writes.append(lambda: _keep_newest(alerts, batch_id, root))
        if good:
            state_table = KeyedTable.named(root, "machine_states")
            writes.append(lambda: state_table.upsert(states, batch_id))
        _side_by_side(batch.sparkSession, writes)
    finally:
        scored.unpersist()


def _keep_newest(alerts: DataFrame, batch_id: int, root: str) -> None:
    table = newest_alerts_table(root)
    shown = table.read(alerts.sparkSession, before=batch_id).unionByName(alerts)
    distinct = newest_per_key(shown, ["machine_id", "alert_time"], "alert_time")
    table.replace(newest_alerts(distinct), version=batch_id)


def _side_by_side(spark: SparkSession, writes: list) -> None:
    """Run independent writes as concurrent jobs. The first failure is raised."""
    if writes:
        with ThreadPoolExecutor(len(writes)) as pool:
            jobs = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
            for job in jobs:
                job.result()


def stream_scored(
    telemetry: DataFrame,
    root: str,
    checkpoint: str,
    ttl: float = 60.0,
    compact_every: int = 100,
    params: ScoringParams = ScoringParams(),
    **trigger,
):
    """Start the scoring stream on parsed telemetry. Returns the running query.

    States are compacted every ``compact_every`` batches, so that a reader merges a bounded number
    of slices; alerts are merged in levels as they come. Columns beside the telemetry, such as the raw message kept by
    ``parse_telemetry``, go to the quarantine with a malformed row.
    """
    spark = telemetry.sparkSession
    context = GraphContext(spark, root, ttl)

    def handle(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, batch_id, context, root, params)
        if compact_every and batch_id and batch_id % compact_every == 0:
            KeyedTable.named(root, "machine_states").compact(spark)

    writer = (
        telemetry.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def alert_feed(
    ticks: DataFrame, root: str, emit, checkpoint: str | None = None, **trigger
):
    """Call ``emit`` with the newest alerts at every trigger, once there are any.

    Each alert carries its score and the time it was served, from which a reader tells the latency.

    ``ticks`` is any stream that produces a row per period, such as the rate source. The
    default period is one second.
    """
    spark = ticks.sparkSession
    newest = newest_alerts_table(root)

    def handle(_: DataFrame, batch_id: int) -> None:
        if newest.exists(spark):
            shown = newest_alerts(newest.read(spark)).select(*ALERT_COLUMNS, "prediction_score")
            emit(shown.withColumn("server_time", F.current_timestamp()), batch_id)

    writer = ticks.writeStream.foreachBatch(handle)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
