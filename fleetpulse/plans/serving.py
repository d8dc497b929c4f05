"""Queries on the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions.expressions import latency_band, number_or_zero
from fleetpulse.operators.distribute import number_rows
from fleetpulse.params import ControllerParams, LatencyParams, ScaleLimits

ALERT_COLUMNS = [
    "machine_id", "alert_time", "air_temp", "process_temp", "rotational_speed", "tool_wear",
    "torque",
]

# Tool wear shown as a warning, and list lengths.
WEAR_WARNING = 200
ALERT_LIST = 15
TICKER_LIST = 5
LEADERBOARD = 10
CLUSTER_LIST = 5


def newest_alerts(alerts: DataFrame, n: int = ALERT_LIST) -> DataFrame:
    return alerts.orderBy(F.desc("alert_time"), "machine_id").limit(n)


def latest_alerts(alerts: DataFrame, n: int = ALERT_LIST) -> DataFrame:
    """The ``n`` newest alerts, newest first."""
    return newest_alerts(alerts, n).select(*ALERT_COLUMNS)


def _wear_flag() -> Column:
    return F.coalesce(F.col("tool_wear") > WEAR_WARNING, F.lit(False)).alias("wear_warning")


def alert_ticker(alerts: DataFrame, n: int = TICKER_LIST) -> DataFrame:
    """The newest alerts with display values; missing readings show as 0."""
    return latest_alerts(alerts, n).select(
        "machine_id",
        "alert_time",
        F.round(F.coalesce("rotational_speed", F.lit(0.0)), 0).alias("rotational_speed"),
        F.round(F.coalesce("air_temp", F.lit(0.0)), 1).alias("air_temp"),
        F.round(F.coalesce("torque", F.lit(0.0)), 1).alias("torque"),
        "tool_wear",
        _wear_flag(),
    )


def sensor_series(alerts: DataFrame, n: int = ALERT_LIST) -> DataFrame:
    """The newest alerts in time order, as a speed series."""
    return (
        latest_alerts(alerts, n)
        .orderBy("alert_time", "machine_id")
        .select("machine_id", "alert_time", "rotational_speed", _wear_flag())
    )


def states_snapshot(states: DataFrame) -> DataFrame:
    return states.select("machine_id", "last_update", "status", "air_temp", "torque")


def fleet_summary(states: DataFrame) -> DataFrame:
    """Fleet size, health and sensor ranges in one pass. One row, also for an empty fleet."""
    total, critical = F.count(F.lit(1)), F.count_if(F.col("status") == "CRITICAL")
    temp, torque = number_or_zero(F.col("air_temp")), number_or_zero(F.col("torque"))
    return states.agg(
        total.alias("total"),
        critical.alias("critical"),
        (total - critical).alias("healthy"),
        F.round(F.coalesce(F.try_divide(critical, total), F.lit(0.0)) * 100, 1).alias(
            "critical_pct"
        ),
        F.avg(temp).alias("avg_temp"),
        F.min(temp).alias("min_temp"),
        F.max(temp).alias("max_temp"),
        F.avg(torque).alias("avg_torque"),
        F.min(torque).alias("min_torque"),
        F.max(torque).alias("max_torque"),
    )


def machines_by_status(states: DataFrame, critical: bool) -> DataFrame:
    """Critical machines, or all the others."""
    is_critical = F.coalesce(F.col("status") == "CRITICAL", F.lit(False))
    return states_snapshot(states.where(is_critical if critical else ~is_critical))


def pagerank_board(ranks: DataFrame) -> DataFrame:
    """All ranks, highest first; a missing one counts as 0."""
    return ranks.orderBy(F.desc(F.coalesce("pagerank", F.lit(0.0))), "machine_id")


def pagerank_top10(ranks: DataFrame, n: int = LEADERBOARD) -> DataFrame:
    """Leaderboard. Ranks that agree to nine digits are ordered by name."""
    top = ranks.orderBy(F.desc(F.round("pagerank", 9)), "machine_id").limit(n)
    # The window runs over the ``n`` rows that are left.
    place = F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc(F.round("pagerank", 9)), "machine_id")
    )
    return top.select(
        place.alias("place"),
        "machine_id",
        F.round("pagerank", 6).alias("pagerank"),
        (place <= 3).alias("top_three"),
    )


def community_members(communities: DataFrame, limits: ScaleLimits = ScaleLimits()) -> DataFrame:
    """Members per community as sorted lists.

    A community may hold much of the fleet, so its list comes in pages of bounded length,
    numbered from 0. A community that fits one page has exactly one row.
    """
    numbered = number_rows(
        communities.select("community_id", "machine_id"),
        ["community_id"], ["machine_id"], "_no", limits,
    )
    return (
        numbered.withColumn("page", F.floor((F.col("_no") - 1) / limits.page_rows))
        .groupBy("community_id", "page")
        .agg(F.sort_array(F.collect_list("machine_id")).alias("machines"))
    )


def community_sizes(communities: DataFrame) -> DataFrame:
    return communities.groupBy("community_id").agg(F.count(F.lit(1)).alias("member_count"))


def community_top5(
    communities: DataFrame, n: int = CLUSTER_LIST, limits: ScaleLimits = ScaleLimits()
) -> DataFrame:
    """The largest communities with their members."""
    top = (
        community_sizes(communities)
        .orderBy(F.desc("member_count"), F.length("community_id"), "community_id")
        .limit(n)
    )
    # At most ``n`` rows, so the members are filtered where they are.
    members = communities.join(F.broadcast(top.select("community_id")), "community_id", "left_semi")
    return community_members(members, limits).join(F.broadcast(top), "community_id")


def controller_lookup(
    states: DataFrame, controller_id: str, params: ControllerParams = ControllerParams()
) -> DataFrame:
    """The state of one controller, or the defaults if it has not reported yet. One row."""
    defaults = {
        "latency_threshold": F.lit(params.start_threshold),
        "cloud_sample_rate": F.lit(params.start_sample_rate),
        "retrain_interval": F.lit(params.start_interval),
        "edge_anomaly_rate": F.lit(0.0),
        "cloud_backlog": F.lit(0),
        "avg_rtt": F.lit(0.0),
    }
    # An aggregate gives a row for no match as well, and the key filter reaches the scan.
    found = states.where(F.col("controller_id") == controller_id).agg(
        F.max(F.struct("last_updated", *defaults)).alias("s")
    )
    return found.select(
        F.lit(controller_id).alias("controller_id"),
        *[F.coalesce(F.col(f"s.{c}"), d).alias(c) for c, d in defaults.items()],
        F.col("s.last_updated").alias("last_updated"),
        F.col("s").isNotNull().alias("active"),
    )


def controller_card(controller: DataFrame) -> DataFrame:
    """Controller values as displayed."""
    return controller.select(
        "controller_id",
        F.round("latency_threshold").cast("int").alias("latency_threshold_ms"),
        F.round(F.col("cloud_sample_rate") * 100).cast("int").alias("cloud_sample_pct"),
        "retrain_interval",
        F.round(F.col("edge_anomaly_rate") * 100, 1).alias("anomaly_pct"),
        "cloud_backlog",
        F.round("avg_rtt").cast("int").alias("avg_rtt_ms"),
        F.when(F.col("active"), F.lit("ACTIVE")).otherwise(F.lit("WAITING")).alias("status"),
    )


def latency_bands(
    df: DataFrame,
    sent: str,
    received: str,
    connected: str | None = None,
    params: LatencyParams = LatencyParams(),
) -> DataFrame:
    """Delivery latency in milliseconds and its band, per row."""
    delay = F.unix_millis(F.col(received)) - F.unix_millis(F.col(sent))
    link = F.col(connected) if connected else None
    return df.withColumn("delay_ms", delay).withColumn(
        "band", latency_band(F.col("delay_ms"), link, params)
    )
