"""Column expressions. All of them stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetpulse.params import LatencyParams, ScoringParams

def unit_draw(key: Column, purpose: str) -> Column:
    """A number in [0, 1) that depends only on the key and the purpose, so re-runs agree.

    The leading 32 bits of an MD5 hash, which every SQL engine has. Draws of one key for
    different purposes are independent.
    """
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(purpose)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def text_key(*cols: Column) -> Column:
    """Integer key for rows identified by text rather than by a number."""
    return F.xxhash64(*cols)


def simulated_rtt(key: Column, params: LatencyParams = LatencyParams()) -> Column:
    """Uniform integer round-trip time between both bounds, drawn from the row key."""
    width = params.rtt_max - params.rtt_min + 1
    return (F.lit(params.rtt_min) + F.floor(unit_draw(key, "rtt") * F.lit(width))).cast("int")


def graph_adjustment(risk: Column, rank: Column, params: ScoringParams = ScoringParams()) -> Column:
    """Weighted sum of risk and rank. If either is missing the whole adjustment is 0."""
    total = F.coalesce(
        risk * F.lit(params.risk_weight) + rank * F.lit(params.rank_weight), F.lit(0.0)
    )
    return F.least(total, F.lit(1.0)) if params.clamp_adjustment else total


def prediction_score(
    tool_wear: Column, rpm: Column, adjustment: Column, params: ScoringParams = ScoringParams()
) -> Column:
    """-1 for an anomaly, 1 otherwise. Bounds are strict and a missing reading never triggers."""
    wear_limit = F.lit(params.base_tool_wear) - adjustment * F.lit(params.base_tool_wear)
    rpm_limit = F.lit(params.base_rpm) + adjustment * F.lit(params.rpm_span)
    worn = tool_wear > wear_limit
    slow = rpm < rpm_limit
    return F.when(worn | slow, F.lit(-1.0)).otherwise(F.lit(1.0))


def health_status(score: Column) -> Column:
    return F.when(score == -1.0, F.lit("CRITICAL")).otherwise(F.lit("HEALTHY"))


def latency_band(
    latency_ms: Column, connected: Column | None = None, params: LatencyParams = LatencyParams()
) -> Column:
    connected = F.lit(True) if connected is None else connected
    return (
        F.when(~connected, F.lit("critical"))
        .when(latency_ms < params.optimal_below, F.lit("optimal"))
        .when(latency_ms < params.moderate_below, F.lit("moderate"))
        .otherwise(F.lit("critical"))
    )


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(1e6)


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * F.lit(1e6)).cast("bigint"))


def number_or_zero(value: Column) -> Column:
    """Missing and NaN readings count as 0."""
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
