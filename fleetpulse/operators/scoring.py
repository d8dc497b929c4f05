"""Anomaly scoring of readings, with or without graph context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions.expressions import graph_adjustment, health_status, prediction_score
from fleetpulse.operators.distribute import lookup_join
from fleetpulse.params import ScaleLimits, ScoringParams

UNTIMED_PARTS = 64  # tasks over which untimed alerts of one machine are dealt


def join_pagerank(telemetry: DataFrame, ranks: DataFrame, limits=ScaleLimits()) -> DataFrame:
    lookup = ranks.select("machine_id", F.col("pagerank").alias("pr_score"))
    return lookup_join(telemetry, lookup, "machine_id", limits=limits)


def join_community(telemetry: DataFrame, communities: DataFrame, limits=ScaleLimits()):
    lookup = communities.select("machine_id", "community_id")
    return lookup_join(telemetry, lookup, "machine_id", limits=limits)


def join_risk(telemetry: DataFrame, risk: DataFrame, limits=ScaleLimits()) -> DataFrame:
    lookup = risk.select("community_id", "risk_score")
    return lookup_join(telemetry, lookup, "community_id", limits=limits)


def with_context(
    telemetry: DataFrame,
    context: DataFrame | None,
    params: ScoringParams = ScoringParams(),
    limits: ScaleLimits = ScaleLimits(),
    fits: bool | None = None,
) -> DataFrame:
    """Add rank, community, risk and the threshold adjustment. No context adjusts nothing."""
    if context is None:
        return (
            telemetry.withColumn("pr_score", F.lit(None).cast("double"))
            .withColumn("community_id", F.lit(None).cast("string"))
            .withColumn("risk_score", F.lit(None).cast("double"))
            .withColumn("graph_adjustment", F.lit(0.0))
        )
    joined = lookup_join(telemetry, context, "machine_id", limits=limits, fits=fits)
    return joined.withColumn(
        "graph_adjustment", graph_adjustment(F.col("risk_score"), F.col("pr_score"), params)
    )


def graph_scored(
    telemetry: DataFrame,
    context: DataFrame | None = None,
    params: ScoringParams = ScoringParams(),
    limits: ScaleLimits = ScaleLimits(),
    fits: bool | None = None,
) -> DataFrame:
    """Readings with ``graph_adjustment`` and ``prediction_score``.

    ``fits`` says that the context is known to be small enough to broadcast, or not.
    """
    return with_context(telemetry, context, params, limits, fits).withColumn(
        "prediction_score",
        prediction_score(
            F.col("tool_wear"), F.col("rotational_speed"), F.col("graph_adjustment"), params
        ),
    )


def base_scored(telemetry: DataFrame, params: ScoringParams = ScoringParams()) -> DataFrame:
    return graph_scored(telemetry, None, params)


def filter_anomalies(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("prediction_score") == -1.0)


def batch_adjust_stats(scored: DataFrame) -> DataFrame:
    """How strongly the graph moved the thresholds of a batch. One row."""
    adjustment = F.col("graph_adjustment")
    return scored.agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.avg(adjustment), F.lit(0.0)).alias("avg_adjustment"),
        F.coalesce(F.max(adjustment), F.lit(0.0)).alias("max_adjustment"),
        F.count_if(adjustment > 0).alias("enriched_count"),
    )


def _timed_apart(alerts: DataFrame, now: Column) -> DataFrame:
    """Give alerts without a time the present, each of a machine a microsecond of its own.

    Numbered within machine and hash part, so a busy machine is dealt over ``UNTIMED_PARTS`` tasks
    and repeated readings stay apart as well. The rest of the row settles the order.
    """
    untimed = alerts.where(F.col("alert_time").isNull())
    rest = [c for c in alerts.columns if c != "alert_time"]
    parted = untimed.withColumn("_part", F.pmod(F.xxhash64(*rest), F.lit(UNTIMED_PARTS)))
    number = F.row_number().over(Window.partitionBy("machine_id", "_part").orderBy(*rest))
    micros = F.unix_micros(now) + (number - 1) * UNTIMED_PARTS + F.col("_part")
    apart = parted.withColumn("alert_time", F.timestamp_micros(micros)).select(*alerts.columns)
    return alerts.where(F.col("alert_time").isNotNull()).unionByName(apart)


def project_alerts(scored: DataFrame, now: Column | None = None) -> DataFrame:
    """Alert rows, keyed by machine and event time; a reading without a time takes ``now``.

    Several alerts of a machine in one batch stay apart: those without a time get different
    microseconds from ``now`` on. Give a fixed ``now`` if the rows are computed more than once.
    """
    alerts = filter_anomalies(scored).select(
        "machine_id",
        F.col("event_time").alias("alert_time"),
        F.lit(0).alias("latency_ms"),
        "air_temp",
        "process_temp",
        "rotational_speed",
        "torque",
        "tool_wear",
        "prediction_score",
    )
    return _timed_apart(alerts, F.current_timestamp() if now is None else now)


def project_states(scored: DataFrame) -> DataFrame:
    """One state row per reading."""
    return scored.select(
        "machine_id",
        F.coalesce("event_time", F.current_timestamp()).alias("last_update"),
        health_status(F.col("prediction_score")).alias("status"),
        "air_temp",
        "torque",
    )


def newest_per_key(df: DataFrame, keys: list[str], newest_by: str | None) -> DataFrame:
    """One row per key: the newest one.

    Equal times are settled by the other columns, so the result does not depend on the order of
    arrival; a critical state goes before a healthy one. The maximum is taken before the shuffle as well, so a busy key costs one row per
    task.
    """
    rest = [c for c in df.columns if c not in keys and c != newest_by]
    if newest_by is None or (newest_by in keys and not rest):
        return df.dropDuplicates(keys)
    leading = [] if newest_by in keys else [newest_by]
    urgent = [(F.col("status") == "CRITICAL").alias("_urgent")] if "status" in rest else []
    best = F.max(F.struct(*[F.col(c) for c in leading], *urgent, *[F.col(c) for c in rest]))
    return (
        df.groupBy(*keys)
        .agg(best.alias("_best"))
        .select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])
    )


def latest_state(scored: DataFrame) -> DataFrame:
    """Newest state per machine by event time: a late reading does not replace a newer one."""
    return newest_per_key(project_states(scored), ["machine_id"], "last_update")
