"""Closed-loop routing between edge and cloud.

The thresholds are fixed inside a window of messages and a model's verdict on a reading does
not depend on where the reading goes. So the rows are judged, numbered and cut into windows in
parallel; only the short list of window summaries is folded in order, one state per edge; and
the thresholds are joined back to the rows to route them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.operators.distribute import as_of, fits_broadcast, number_rows, running_total
from fleetpulse.params import ControllerParams, ScaleLimits
from fleetpulse.session import ship, write_once

WINDOW_SCHEMA = (
    "edge_id string, window_no bigint, messages bigint, rtt_sum double, "
    "outlier_latency array<double>, outlier_draw array<double>"
)

STATE_SCHEMA = (
    "edge_id string, window_no bigint, action string, latency_threshold double, "
    "cloud_sample_rate double, retrain_interval int, edge_anomaly_rate double, avg_rtt double"
)


def _condition(outlier: Column | str) -> Column:
    """An outlier test, given as a column or as an SQL condition."""
    return F.expr(outlier) if isinstance(outlier, str) else outlier


def number_messages(
    rows: DataFrame, order_cols: list[str], limits: ScaleLimits = ScaleLimits()
) -> DataFrame:
    """Message number per edge, counted from 1, in ``seq``."""
    return number_rows(rows, ["edge_id"], order_cols, "seq", limits)


def assign_windows(numbered: DataFrame, size: int) -> DataFrame:
    """Window number per message, counted from 0."""
    return numbered.withColumn("window_no", F.floor((F.col("seq") - 1) / F.lit(size)))


def controller_windows(
    windowed: DataFrame, outlier, params: ControllerParams = ControllerParams(),
    complete_only: bool = True,
) -> DataFrame:
    """One summary per edge and window.

    Which outliers count depends on the thresholds then in force, so their latency and draw are
    kept, as two lists in the same order: at most one entry per message of the window. Outliers
    that go to the cloud under any threshold the start and the bounds allow are left out. So is a last window
    that is not full, because the controller does not act on it.
    """
    latency, draw = F.col("latency_ms").cast("double"), F.col("draw")
    may_count = (latency >= min(params.threshold_min, params.start_threshold)) & (
        draw >= min(params.sample_min, params.start_sample_rate)
    )
    pair = F.struct(latency.alias("latency"), draw.alias("draw"))
    summary = (
        windowed.groupBy("edge_id", "window_no")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum(latency).alias("rtt_sum"),
            F.collect_list(F.when(_condition(outlier) & may_count, pair)).alias("_pairs"),
        )
        .withColumn("outlier_latency", F.col("_pairs.latency"))
        .withColumn("outlier_draw", F.col("_pairs.draw"))
        .drop("_pairs")
    )
    return summary.where(F.col("messages") == params.window_size) if complete_only else summary


def _clamp(value: float, low: float, high: float) -> float:
    return max(low, min(high, value))


def _next_state(state: dict, messages: int, anomalies: int, rtt_sum: float, p: ControllerParams):
    """The state after one full window. Returns (state, action).

    The names of the actions are fixed values.
    """
    rate = p.rate_alpha * (anomalies / messages) + (1 - p.rate_alpha) * state["rate"]
    rtt = p.rtt_beta * (rtt_sum / messages) + (1 - p.rtt_beta) * state["rtt"]
    trend = rtt - state["rtt"]
    shift, sample, interval = 0.0, state["sample"], state["interval"]
    if rate > p.high_rate:
        action, shift = "EXPAND_CLOUD", p.threshold_step
        sample = min(sample + p.sample_step, p.sample_max)
        interval = max(interval - p.interval_down, p.interval_min)
    elif rate < p.low_rate:
        action, shift = "REDUCE_CLOUD", -p.threshold_step
        sample = max(sample - p.sample_step, p.sample_min)
        interval = min(interval + p.interval_up, p.interval_max)
    elif trend > p.rtt_trend:
        action, shift = "FINE_TUNE_EDGE", -p.threshold_fine
    elif trend < -p.rtt_trend:
        action, shift = "FINE_TUNE_CLOUD", p.threshold_fine
    else:
        action = "HOLD"
    threshold = _clamp(state["threshold"] + shift, p.threshold_min, p.threshold_max)
    return (
        {"threshold": threshold, "sample": sample, "interval": interval, "rate": rate, "rtt": rtt},
        action,
    )


def controller_fold(
    windows: DataFrame,
    params: ControllerParams = ControllerParams(),
    start: DataFrame | None = None,
) -> DataFrame:
    """State after every window, in order, per edge.

    The windows of an edge reach one task in order and pass through it in batches: only the
    current state is held. ``start`` gives the state (same columns) that some edges begin
    with; the others begin with the defaults.
    """
    begin = windows.select(*_columns(WINDOW_SCHEMA))
    for name in ("latency_threshold", "cloud_sample_rate", "edge_anomaly_rate", "avg_rtt"):
        begin = begin.withColumn(name, F.lit(None).cast("double"))
    begin = begin.withColumn("retrain_interval", F.lit(None).cast("int"))
    if start is not None:
        # The state an edge starts with travels as a window row of its own, before the others.
        seeds = start.select(
            "edge_id",
            F.lit(-1).cast("bigint").alias("window_no"),
            F.lit(0).cast("bigint").alias("messages"),
            F.lit(0.0).alias("rtt_sum"),
            F.array().cast("array<double>").alias("outlier_latency"),
            F.array().cast("array<double>").alias("outlier_draw"),
            "latency_threshold",
            "cloud_sample_rate",
            "edge_anomaly_rate",
            "avg_rtt",
            "retrain_interval",
        )
        begin = begin.unionByName(seeds)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edge, state = None, {}
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.edge_id != edge:
                    edge = row.edge_id
                    state = {
                        "threshold": params.start_threshold,
                        "sample": params.start_sample_rate,
                        "interval": params.start_interval,
                        "rate": params.start_rate,
                        "rtt": params.start_rtt,
                    }
                if row.window_no < 0:
                    state = {
                        "threshold": row.latency_threshold,
                        "sample": row.cloud_sample_rate,
                        "interval": int(row.retrain_interval),
                        "rate": row.edge_anomaly_rate,
                        "rtt": row.avg_rtt,
                    }
                    continue
                # An outlier was seen by the edge model only if it was not sent to the cloud.
                seen = int(
                    np.count_nonzero(
                        (row.outlier_latency >= state["threshold"])
                        & (row.outlier_draw >= state["sample"])
                    )
                )
                state, action = _next_state(state, row.messages, seen, row.rtt_sum, params)
                out.append(
                    (
                        edge, row.window_no, action, state["threshold"], state["sample"],
                        state["interval"], state["rate"], state["rtt"],
                    )
                )
            yield pd.DataFrame(out, columns=_columns(STATE_SCHEMA))

    ship(windows.sparkSession)
    ordered = begin.repartition("edge_id").sortWithinPartitions("edge_id", "window_no")
    return ordered.mapInPandas(fold, STATE_SCHEMA)


def _columns(ddl: str) -> list[str]:
    """Column names of a flat schema string."""
    return [part.split(" ")[0] for part in ddl.split(", ")]


def in_force(states: DataFrame, params: ControllerParams = ControllerParams()) -> DataFrame:
    """Threshold and sample rate that apply during a window: those set after the one before."""
    return states.select(
        "edge_id",
        (F.col("window_no") + 1).alias("window_no"),
        F.col("latency_threshold").alias("_threshold"),
        F.col("cloud_sample_rate").alias("_sample"),
    )


def route_readings(
    windowed: DataFrame,
    states: DataFrame | None = None,
    params: ControllerParams = ControllerParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> DataFrame:
    """Add ``to_cloud``: fast enough for the threshold, or drawn for the sample.

    Without states the starting thresholds apply to all rows. With them every row looks up its
    own window, a key that covers at most one window of rows.
    """
    if states is None:
        threshold, sample = F.lit(params.start_threshold), F.lit(params.start_sample_rate)
        rows = windowed
    else:
        applied = in_force(states, params)
        if fits_broadcast(applied, limits):
            applied = F.broadcast(applied)
        rows = windowed.join(applied, ["edge_id", "window_no"], "left")
        threshold = F.coalesce("_threshold", F.lit(params.start_threshold))
        sample = F.coalesce("_sample", F.lit(params.start_sample_rate))
    routed = rows.withColumn(
        "to_cloud", (F.col("latency_ms") < threshold) | (F.col("draw") < sample)
    )
    return routed.drop("_threshold", "_sample")


def edge_alerts(routed: DataFrame, outlier) -> DataFrame:
    """Readings judged at the edge and found to be outliers."""
    return routed.where(~F.col("to_cloud") & _condition(outlier))


def edge_run_stats(routed: DataFrame, outlier) -> DataFrame:
    """Messages, edge anomalies and the share sent to the cloud, in percent. One row."""
    return routed.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(~F.col("to_cloud") & _condition(outlier)).alias("anomalies"),
        (F.try_divide(F.count_if("to_cloud"), F.count(F.lit(1))) * 100).alias("cloud_pct"),
    )


def cloud_backlog(
    routed: DataFrame,
    params: ControllerParams = ControllerParams(),
    limits: ScaleLimits = ScaleLimits(),
    feedback: DataFrame | None = None,
) -> DataFrame:
    """Records waiting for the next retraining, at the end of every window.

    ``feedback`` (edge_id, window_no) says in which windows a retrain notice arrived: it empties
    the backlog. With ``notice_time`` instead, notices are for all edges and empty the backlog at
    that time. Without feedback, retraining empties it after every ``retrain_every`` cloud-routed
    records.
    """
    if feedback is not None and "notice_time" in feedback.columns:
        waiting = F.col("sent") - F.coalesce("emptied", F.lit(0))
        return backlog_after(routed, feedback, limits).select(
            "edge_id", "window_no", "cloud_messages", waiting.cast("int").alias("cloud_backlog")
        )
    # One row per window, stored because the running total reads it twice.
    per_window = write_once(
        routed.groupBy("edge_id", "window_no").agg(F.count_if("to_cloud").alias("cloud_messages")),
        "sent",
    )
    total = running_total(per_window, ["edge_id"], "window_no", "cloud_messages", "_sent", limits)
    waiting = F.col("_sent") % params.retrain_every
    if feedback is not None:
        notices = feedback.select("edge_id", "window_no", F.lit(True).alias("_notice")).distinct()
        total = total.join(notices, ["edge_id", "window_no"], "left")
        # One row per window, and the sum never falls: its largest value at a notice is the last.
        so_far = Window.partitionBy("edge_id").orderBy("window_no")
        emptied = F.max(F.when(F.col("_notice"), F.col("_sent"))).over(so_far)
        waiting = F.col("_sent") - F.coalesce(emptied, F.lit(0))
    return total.select(
        "edge_id", "window_no", "cloud_messages", waiting.cast("int").alias("cloud_backlog")
    )


def backlog_after(
    routed: DataFrame, notices: DataFrame, limits: ScaleLimits = ScaleLimits()
) -> DataFrame:
    """(edge_id, window_no, cloud_messages, sent, emptied) at the end of every window.

    ``sent`` counts the edge's cloud-routed records so far, ``emptied`` those among them from
    before the newest notice then known, null without one. A notice falls in the first window
    that reaches its time, and only the records of that window are looked at one by one. Records
    without a time count as sent before all others.
    """
    per_window = write_once(
        routed.groupBy("edge_id", "window_no").agg(
            F.count_if("to_cloud").alias("cloud_messages"), F.max("event_time").alias("_until")
        ),
        "sent",
    )
    total = running_total(per_window, ["edge_id"], "window_no", "cloud_messages", "sent", limits)
    # One row per window. A late message does not turn the time back.
    so_far = Window.partitionBy("edge_id").orderBy("window_no")
    total = total.withColumn("_until", F.max("_until").over(so_far))
    seen = as_of(total, notices.select("notice_time"), "_until", "notice_time", "_notice", limits=limits)
    seen = write_once(seen.withColumn("_at", F.col("_notice.notice_time")).drop("_notice", "_until"), "noticed")
    first = F.struct("window_no", (F.col("sent") - F.col("cloud_messages")).alias("before"))
    falls = seen.where("_at IS NOT NULL").groupBy("edge_id", "_at").agg(F.min(first).alias("_w"))
    falls = write_once(falls.select("edge_id", "_at", "_w.window_no", "_w.before"), "falls")
    earlier = F.coalesce(F.col("event_time") < F.col("_at"), F.lit(True))
    inside = (
        routed.where("to_cloud").select("edge_id", "window_no", "event_time")
        .join(falls, ["edge_id", "window_no"])
        .groupBy("edge_id", "_at")
        .agg(F.count_if(earlier).alias("_inside"))
    )
    emptied = falls.join(inside, ["edge_id", "_at"], "left").select(
        "edge_id", "_at", (F.col("before") + F.coalesce("_inside", F.lit(0))).alias("emptied")
    )
    return seen.join(emptied, ["edge_id", "_at"], "left").drop("_at")


def controller_trace(states: DataFrame, backlog: DataFrame) -> DataFrame:
    """Controller state per window, backlog included."""
    return states.join(
        backlog.select("edge_id", "window_no", "cloud_backlog"), ["edge_id", "window_no"], "left"
    )


def controller_latest(trace: DataFrame, updated=None) -> DataFrame:
    """Newest state per edge in the layout of the ``controller_state`` table."""
    values = [
        "window_no", "latency_threshold", "cloud_sample_rate", "retrain_interval",
        "edge_anomaly_rate", "cloud_backlog", "avg_rtt",
    ]
    newest = F.max_by(F.struct(*values), "window_no").alias("s")
    return trace.groupBy("edge_id").agg(newest).select(
        F.col("edge_id").alias("controller_id"),
        *[F.col(f"s.{v}") for v in values if v != "window_no"],
        (F.current_timestamp() if updated is None else updated).alias("last_updated"),
    )


def retrain_trigger(
    cloud: DataFrame,
    order_cols: list[str],
    params: ControllerParams = ControllerParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> DataFrame:
    """The records that complete a batch of ``retrain_every``, with the records seen by then."""
    numbered = number_rows(cloud.select(*order_cols), [], order_cols, "records", limits)
    return numbered.where(F.col("records") % params.retrain_every == 0).select(
        (F.col("records") / params.retrain_every).cast("bigint").alias("retrain_no"),
        "records",
        *order_cols,
    )


def retrain_feedback(
    errors: DataFrame, error_col: str = "recon_error", at: Column | None = None
) -> DataFrame:
    """The notice sent after a retraining: rows used and mean loss.

    Its time is ``at``, an aggregate over the rows in epoch seconds, or the present.
    """
    now = F.unix_micros(F.current_timestamp()) / 1e6
    return errors.agg(
        F.lit("retrain_complete").alias("type"),
        F.count(F.lit(1)).cast("int").alias("records_trained"),
        F.avg(error_col).alias("training_loss"),
        (now if at is None else F.coalesce(at, now)).alias("timestamp"),
    )


def retrain_notice(spark: SparkSession, records: int, loss: float, at: float | None = None) -> DataFrame:
    """The same notice where rows used and mean loss are known. Its time is ``at`` or the present."""
    now = F.unix_micros(F.current_timestamp()) / 1e6
    return spark.range(1).select(
        F.lit("retrain_complete").alias("type"),
        F.lit(records).cast("int").alias("records_trained"),
        F.lit(float(loss)).alias("training_loss"),
        (now if at is None else F.lit(float(at))).alias("timestamp"),
    )
