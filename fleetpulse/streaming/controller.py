"""The routing controller on a stream.

The same operators as in the batch job, one micro-batch at a time. What a batch hands to the
next is one row per edge: messages seen, thresholds, records sent, and the summary of the
window that is not full yet. The rows are numbered and summarised in parallel even if one
edge sends most of them, which a keyed state operator would put into a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from fleetpulse.operators import controller as ctl
from fleetpulse.operators.distribute import lookup_join
from fleetpulse.params import ControllerParams, ScaleLimits
from fleetpulse.session import scratch, write_once
from fleetpulse.sources.tables import SnapshotTable

_STATE = (
    "edge_id string, window_no bigint, action string, latency_threshold double, "
    "cloud_sample_rate double, retrain_interval int, edge_anomaly_rate double, avg_rtt double, "
    "seen bigint, sent bigint, pending struct<window_no:bigint,messages:bigint,rtt_sum:double,"
    "outlier_latency:array<double>,outlier_draw:array<double>>, emptied bigint"
)


def _state_table(root: str) -> SnapshotTable:
    return SnapshotTable(f"{root}/state", _STATE)


def control_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    outlier,
    order_cols: list[str],
    params: ControllerParams = ControllerParams(),
    limits: ScaleLimits = ScaleLimits(),
    notices: DataFrame | None = None,
) -> None:
    """Route one micro-batch and advance the state of its edges.

    Writes ``routed``, ``trace`` and ``state`` below ``root``, each in a folder named after the
    batch. The state is read from the batch before, so a replay gives the same again.

    ``notices`` (notice_time) are the retrain notices that arrived with the batch. Each empties the
    backlog at its time, or when it arrives if that is later; ``backlog`` then has the records
    waiting at the end of each window, as far as the batch goes.
    """
    spark = batch.sparkSession
    before = _state_table(root).read(spark, before=batch_id)
    numbered = ctl.number_messages(batch, order_cols, limits)
    numbered = lookup_join(numbered, before.select("edge_id", "seen"), "edge_id", limits=limits)
    numbered = numbered.withColumn("seq", F.col("seq") + F.coalesce("seen", F.lit(0))).drop("seen")
    windowed = ctl.assign_windows(numbered, params.window_size)

    summaries = ctl.controller_windows(windowed, outlier, params, complete_only=False)
    open_before = before.where(F.col("pending").isNotNull()).select("edge_id", "pending.*")
    merged = write_once(
        summaries.unionByName(open_before)
        .groupBy("edge_id", "window_no")
        .agg(
            F.sum("messages").alias("messages"),
            F.sum("rtt_sum").alias("rtt_sum"),
            # Parts of one window: at most ``window_size`` entries together. Both lists are
            # gathered as pairs, so they stay in the same order.
            F.collect_list(F.struct("outlier_latency", "outlier_draw")).alias("_parts"),
        )
        .select(
            "edge_id",
            "window_no",
            "messages",
            "rtt_sum",
            F.flatten("_parts.outlier_latency").alias("outlier_latency"),
            F.flatten("_parts.outlier_draw").alias("outlier_draw"),
        ),
        "windows",
    )
    full = merged.where(F.col("messages") == params.window_size)
    started = before.where(F.col("window_no").isNotNull())
    states = write_once(ctl.controller_fold(full, params, started), "states")

    known = states.unionByName(started.select(*states.columns))
    routed = ctl.route_readings(windowed, known, params, limits)
    written = f"{root}/routed/batch={batch_id}"
    routed.write.mode("overwrite").parquet(written)
    routed = routed.sparkSession.read.schema(routed.schema).parquet(written)
    states.write.mode("overwrite").parquet(f"{root}/trace/batch={batch_id}")

    fields = [c for c in states.columns if c not in ("edge_id", "window_no")]
    newest = F.max_by(F.struct("window_no", *fields), "window_no").alias("_s")
    pending = F.struct(
        "window_no", "messages", "rtt_sum", "outlier_latency", "outlier_draw"
    ).alias("pending")
    last = None if notices is None else notices.agg(F.max("notice_time")).first()[0]
    earlier = F.coalesce(F.col("event_time") < F.lit(last), F.lit(True)) if last else F.lit(False)
    counts = routed.groupBy("edge_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("to_cloud").alias("_sent"),
        F.count_if(F.col("to_cloud") & earlier).alias("_emptied"),
    )
    sent, emptied = F.coalesce("sent", F.lit(0)), F.col("emptied")
    if last:
        emptied = sent + F.coalesce("_emptied", F.lit(0))
    elif notices is not None:
        emptied = F.coalesce("emptied", F.lit(0))
    if notices is not None:
        start = before.select("edge_id", F.col("sent").alias("_sent0"), F.col("emptied").alias("_emptied0"))
        known_sent = F.coalesce("_sent0", F.lit(0))
        waiting = known_sent + F.col("sent") - F.coalesce(known_sent + F.col("emptied"), F.col("_emptied0"), F.lit(0))
        (
            lookup_join(ctl.backlog_after(routed, notices, limits), start, "edge_id", limits=limits)
            .select("edge_id", "window_no", "cloud_messages", waiting.cast("int").alias("cloud_backlog"))
            .write.mode("overwrite").parquet(f"{root}/backlog/batch={batch_id}")
        )
    after = (
        before.select("edge_id", "seen", "sent", "emptied")
        .join(counts, "edge_id", "full")
        .join(known.groupBy("edge_id").agg(newest), "edge_id", "left")
        .join(
            merged.where(F.col("messages") < params.window_size).select("edge_id", pending),
            "edge_id",
            "left",
        )
        .select(
            "edge_id",
            F.col("_s.window_no").alias("window_no"),
            *[F.col(f"_s.{c}").alias(c) for c in fields],
            (F.coalesce("seen", F.lit(0)) + F.coalesce("_rows", F.lit(0))).alias("seen"),
            (sent + F.coalesce("_sent", F.lit(0))).alias("sent"),
            "pending",
            emptied.cast("bigint").alias("emptied"),
        )
    )
    _state_table(root).replace(after, version=batch_id)


def controller_states(
    spark: SparkSession, root: str, params: ControllerParams = ControllerParams()
) -> DataFrame:
    """Newest state per edge, in the layout of the ``controller_state`` table."""
    return _state_table(root).read(spark).where(F.col("window_no").isNotNull()).select(
        F.col("edge_id").alias("controller_id"),
        "latency_threshold",
        "cloud_sample_rate",
        "retrain_interval",
        "edge_anomaly_rate",
        F.coalesce(F.col("sent") - F.col("emptied"), F.col("sent") % params.retrain_every)
        .cast("int")
        .alias("cloud_backlog"),
        "avg_rtt",
        F.current_timestamp().alias("last_updated"),
    )


def controller_backlog(spark: SparkSession, root: str) -> DataFrame:
    """Records waiting at the end of each window, where the stream was given notices."""
    rows = spark.read.parquet(f"{root}/backlog")
    return rows.groupBy("edge_id", "window_no").agg(
        F.sum("cloud_messages").alias("cloud_messages"),
        F.max_by("cloud_backlog", "batch").alias("cloud_backlog"),
    )


def controller_stream(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    outlier,
    order_cols: list[str],
    params: ControllerParams = ControllerParams(),
    **trigger,
):
    """Start the controller on judged readings. Returns the running query."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                with scratch(batch.sparkSession):
                    control_batch(batch, batch_id, root, outlier, order_cols, params)
        finally:
            batch.unpersist()

    writer = (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
