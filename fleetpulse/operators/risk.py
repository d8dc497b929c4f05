"""Per-community risk from ranks and communities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.distribute import exact_quantile, lookup_join
from fleetpulse.params import GraphParams, ScaleLimits

# Ranks are compared to the median at this precision, so that ranks that are equal but for
# the order of summation stay equal.
RANK_DIGITS = 9


def join_community_rank(communities: DataFrame, ranks: DataFrame) -> DataFrame:
    return communities.join(ranks.select("machine_id", "pagerank"), "machine_id")


def median_rank(members: DataFrame, params: GraphParams = GraphParams()) -> DataFrame:
    """One row with the discrete median rank, 1 when there are no members."""
    values = members.select(F.round("pagerank", RANK_DIGITS).alias("pagerank"))
    if params.median_rel_err > 0:
        accuracy = max(1, round(1 / params.median_rel_err))
        median = values.agg(F.percentile_approx("pagerank", 0.5, accuracy).alias("pagerank"))
    else:
        median = exact_quantile(values, "pagerank", 0.5)
    return median.select(F.coalesce("pagerank", F.lit(1.0)).alias("median_rank"))


def community_agg(members: DataFrame, params: GraphParams = GraphParams()) -> DataFrame:
    """Size, mean rank and number of members above the median, per community."""
    median = median_rank(members, params).scalar()
    above = members.withColumn(
        "_above", (F.round("pagerank", RANK_DIGITS) > median).cast("int")
    )
    return above.groupBy("community_id").agg(
        F.count(F.lit(1)).alias("member_count"),
        F.avg("pagerank").alias("avg_pagerank"),
        F.sum("_above").alias("critical_count"),
    )


def _raw_risk():
    return F.col("avg_pagerank") * F.log1p(F.col("member_count"))


def risk_norm_max(aggregated: DataFrame) -> DataFrame:
    """One row with the largest raw risk, 1 when there is none."""
    largest = F.max(_raw_risk())
    return aggregated.agg(
        F.when(largest.isNull() | (largest == 0), F.lit(1.0)).otherwise(largest).alias("norm_max")
    )


def community_risk(aggregated: DataFrame) -> DataFrame:
    """Raw risk relative to the riskiest community, which therefore has risk 1."""
    return aggregated.select(
        "community_id",
        F.least(F.lit(1.0), _raw_risk() / risk_norm_max(aggregated).scalar()).alias("risk_score"),
        F.col("member_count").cast("int").alias("member_count"),
        F.col("critical_count").cast("int").alias("critical_count"),
        "avg_pagerank",
    )


def graph_context(
    ranks: DataFrame,
    communities: DataFrame,
    risk: DataFrame,
    limits: ScaleLimits = ScaleLimits(),
) -> DataFrame:
    """Rank, community and risk joined to one row per machine.

    Readings then need a single join. Communities may hold a large share of the machines, so
    the risk is looked up by community with the hot-key aware join.
    """
    placed = lookup_join(
        communities.select("machine_id", "community_id"),
        risk.select("community_id", "risk_score"),
        "community_id",
        limits=limits,
    )
    return (
        ranks.select("machine_id", F.col("pagerank").alias("pr_score"))
        .join(placed, "machine_id", "full")
        .select("machine_id", "pr_score", "community_id", "risk_score")
    )


def duplicated_machines(communities: DataFrame) -> DataFrame:
    """Machines with more than one community. Must be empty, or readings would multiply."""
    return (
        communities.groupBy("machine_id")
        .agg(F.count(F.lit(1)).alias("communities"))
        .where(F.col("communities") > 1)
    )
