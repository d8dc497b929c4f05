"""Machine graph: nodes, edges, PageRank and label propagation as DataFrame loops.

Both loops store the edges once, from a certain size on bucketed on the key they are joined on.
An iteration then joins the buckets in place with one value per node and shuffles only the
messages, which are aggregated before the shuffle. Small graphs are left to adaptive
execution, which merges their partitions and broadcasts the values. A node with more edges than ``hot_rows`` gets a salt: its edges
spread over several buckets and its value is repeated once per salt, which makes at most one
copy per ``hot_rows`` edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.distribute import lookup_join
from fleetpulse.params import GraphParams, ScaleLimits
from fleetpulse.session import bucketed, cut


def graph_nodes(telemetry: DataFrame) -> DataFrame:
    return (
        telemetry.where(F.col("machine_id").isNotNull())
        .select(F.col("machine_id").alias("id"))
        .distinct()
    )


def graph_edges(telemetry: DataFrame) -> DataFrame:
    """Distinct directed edges. Missing and empty neighbour lists give none.

    A machine repeats its list with every reading, so the lists are reduced to distinct ones
    before they are exploded.
    """
    lists = telemetry.select("machine_id", "connected_to").where(
        F.col("machine_id").isNotNull() & (F.size("connected_to") > 0)
    )
    return (
        lists.distinct()
        .select(F.col("machine_id").alias("src"), F.explode("connected_to").alias("dst"))
        .where(F.col("dst").isNotNull())
        .distinct()
    )


def graph_build(
    nodes: DataFrame, edges: DataFrame, limits: ScaleLimits = ScaleLimits()
) -> tuple[DataFrame, DataFrame]:
    """Nodes and the edges that have a node on both ends."""
    valid = edges
    for end in ("dst", "src"):
        valid = lookup_join(
            valid, nodes.withColumnRenamed("id", end), end, how="left_semi", limits=limits
        )
    return nodes, valid


@dataclass(frozen=True)
class _Edges:
    """Edges with the ``degree`` of their key, and the salts of hot keys if there are any."""

    rows: DataFrame
    key: str
    hot: DataFrame | None
    join: str | None  # hint for the join with the node side; None leaves it to adaptive execution

    def attach(self, values: DataFrame) -> DataFrame:
        """Left join of one value per node to the edges of the node.

        For bucketed edges the node side is hashed per bucket: it has a single row per node and
        salt, so no bucket of it is large, and the edges are neither moved nor sorted. Buckets
        beyond ``bucket_rows``, of which there are ``max_buckets``, are sorted where they are.
        """
        on = [self.key]
        if self.hot is not None:
            on = [self.key, "salt"]
            salts = F.coalesce("salts", F.lit(1).cast("bigint"))
            values = (
                values.join(self.hot, self.key, "left")
                .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
                .drop("salts")
            )
        return self.rows.join(values.hint(self.join) if self.join else values, on, "left")


@contextmanager
def _by_key(edges: DataFrame, key: str, other: str, limits: ScaleLimits) -> Iterator[_Edges]:
    degrees = cut(edges.groupBy(key).agg(F.count(F.lit(1)).alias("degree")))
    total, largest = degrees.agg(F.sum("degree"), F.max("degree")).first()
    wanted = -(-(total or 0) // limits.bucket_rows)
    buckets = min(wanted, limits.max_buckets)
    rows, on, hot = edges.join(degrees, key), [key], None
    if (largest or 0) > limits.hot_rows:
        salts = F.ceil(F.col("degree") / limits.hot_rows).alias("salts")
        hot = cut(degrees.where(F.col("degree") > limits.hot_rows).select(key, salts))
        rows = lookup_join(edges, degrees.join(hot, key, "left"), key, "inner", limits)
        salt = F.pmod(F.xxhash64(other), F.coalesce("salts", F.lit(1).cast("bigint")))
        rows, on = rows.withColumn("salt", salt).drop("salts"), [key, "salt"]
    if buckets > 1:
        with bucketed(rows, on, buckets, "edges") as stored:
            yield _Edges(stored, key, hot, "shuffle_hash" if wanted == buckets else "merge")
    else:
        yield _Edges(cut(rows), key, hot, None)


def pagerank(
    nodes: DataFrame,
    edges: DataFrame,
    params: GraphParams = GraphParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> DataFrame:
    """Static PageRank with a fixed number of steps. Ranks sum to the number of nodes.

    Every rank starts at 1. A step is ``reset + (1 - reset) * sum(rank / out-degree)`` over
    the incoming edges; a node without outgoing edges passes nothing on, and the final ranks
    are rescaled to make up for that.
    """
    if params.pagerank_iters == 0:
        return nodes.select(F.col("id").alias("machine_id"), F.lit(1.0).alias("pagerank"))
    rank = F.lit(params.reset) + F.lit(1.0 - params.reset) * F.coalesce("received", F.lit(0.0))

    with _by_key(edges.select("src", "dst"), "src", "dst", limits) as out:
        shares = out.rows.withColumn("share", F.lit(1.0) / F.col("degree"))
        for step in range(1, params.pagerank_iters + 1):
            received = shares.groupBy("dst").agg(F.sum("share").alias("received"))
            if step % params.checkpoint_every == 0:
                received = cut(received)
            arriving = received.withColumnRenamed("dst", "src")
            shares = out.attach(arriving).withColumn("share", rank / F.col("degree"))
        ranks = cut(
            nodes.select("id")
            .join(received.withColumnRenamed("dst", "id"), "id", "left")
            .select("id", rank.alias("_rank"))
        )
    scale = ranks.agg((F.count(F.lit(1)) / F.sum("_rank")).alias("_scale"))
    return ranks.select(
        F.col("id").alias("machine_id"), (F.col("_rank") * scale.scalar()).alias("pagerank")
    )


def label_propagation(
    nodes: DataFrame,
    edges: DataFrame,
    params: GraphParams = GraphParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> DataFrame:
    """Synchronous label propagation over both edge directions.

    A node takes the most frequent label among its neighbours, the smallest one on a tie:
    the shorter name first, then by text, so numbered names compare by number. It has no vote
    of its own; a pair with edges both ways votes twice; a node without edges keeps its own
    label.
    """
    own = nodes.select(F.col("id").alias("community_id"), F.col("id").alias("machine_id"))
    if params.label_iters == 0:
        return own
    both = edges.select(F.col("src").alias("origin"), F.col("dst").alias("id")).unionAll(
        edges.select(F.col("dst").alias("origin"), F.col("src").alias("id"))
    )
    votes = both.groupBy("origin", "id").agg(F.count(F.lit(1)).alias("weight"))
    # The smallest (-count, length, label) is the most frequent and then smallest label.
    preference = F.min(F.struct(-F.col("n"), F.length("label"), F.col("label")))

    with _by_key(votes, "origin", "id", limits) as out:
        sent = out.rows.withColumn("label", F.col("origin"))
        for step in range(1, params.label_iters + 1):
            counted = sent.groupBy("id", "label").agg(F.sum("weight").alias("n"))
            chosen = counted.groupBy("id").agg(preference.getField("label").alias("label"))
            if step % params.checkpoint_every == 0:
                chosen = cut(chosen)
            sent = out.attach(chosen.withColumnRenamed("id", "origin"))
        return cut(
            own.join(chosen.withColumnRenamed("id", "machine_id"), "machine_id", "left").select(
                F.coalesce("label", "community_id").alias("community_id"), "machine_id"
            )
        )
