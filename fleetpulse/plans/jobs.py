"""The batch jobs: graph analytics, edge/cloud routing and model training."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.operators import controller as ctl
from fleetpulse.operators import graph, iforest, ml, risk
from fleetpulse.operators.ingest import has_rows
from fleetpulse.params import (
    ControllerParams,
    ForestParams,
    GraphParams,
    IsolationParams,
    ScaleLimits,
)
from fleetpulse.session import cut, scratch, write_once
from fleetpulse.sources.tables import SnapshotTable

log = logging.getLogger("fleetpulse")


@dataclass(frozen=True)
class GraphTables:
    ranks: DataFrame
    communities: DataFrame
    risk: DataFrame

    def context(self, limits: ScaleLimits = ScaleLimits()) -> DataFrame:
        return risk.graph_context(self.ranks, self.communities, self.risk, limits)


def machine_graph(
    telemetry: DataFrame, limits: ScaleLimits = ScaleLimits()
) -> tuple[DataFrame, DataFrame]:
    """Nodes and valid edges, stored: the readings are scanned once for each."""
    nodes = cut(graph.graph_nodes(telemetry))
    return nodes, cut(graph.graph_build(nodes, graph.graph_edges(telemetry), limits)[1])


def graph_tables(
    telemetry: DataFrame,
    params: GraphParams = GraphParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> GraphTables | None:
    """Ranks, communities and community risk. None when no machine is connected."""
    nodes, edges = machine_graph(telemetry, limits)
    if edges.isEmpty():
        return None
    ranks = cut(graph.pagerank(nodes, edges, params, limits))
    communities = graph.label_propagation(nodes, edges, params, limits)
    members = risk.join_community_rank(communities, ranks)
    aggregated = cut(risk.community_agg(members, params))
    risks = cut(risk.community_risk(aggregated))
    return GraphTables(ranks, communities, risks)


def run_graph_job(
    telemetry: DataFrame,
    root: str,
    params: GraphParams = GraphParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> bool:
    """Compute the graph tables and replace their snapshots below ``root``."""
    with scratch(telemetry.sparkSession):
        tables = graph_tables(telemetry, params, limits)
        if tables is None:
            log.warning("no connections between machines, graph tables left as they are")
            return False
        save_graph_tables(tables, root)
    return True


def _manifest(root: str) -> SnapshotTable:
    return SnapshotTable(f"{root}/graph_version", "version bigint")


def save_graph_tables(tables: GraphTables, root: str) -> None:
    """Replace the three snapshots below ``root`` together.

    All get one version number, and readers go by the manifest that names it, written last: they
    never see ranks of one run with communities of another. A machine with several communities
    would multiply its readings, so such tables are not taken.
    """
    spark = tables.ranks.sparkSession
    if not risk.duplicated_machines(tables.communities).isEmpty():
        raise ValueError("a machine has more than one community")
    number = _manifest(root).newest(spark) + 1
    now = F.current_timestamp().alias("last_computed")
    SnapshotTable.named(root, "pagerank_scores").replace(tables.ranks.select("*", now), version=number)
    SnapshotTable.named(root, "failure_communities").replace(tables.communities, version=number)
    SnapshotTable.named(root, "community_risk").replace(tables.risk.select("*", now), version=number)
    _manifest(root).replace(spark.range(number, number + 1).toDF("version"), version=number)


def load_graph_tables(spark: SparkSession, root: str) -> GraphTables | None:
    """The snapshots that were written together last, or None until there are any."""
    number = _manifest(root).newest(spark)
    if number < 0:
        return None
    names = ("pagerank_scores", "failure_communities", "community_risk")
    return GraphTables(*[SnapshotTable.named(root, n).read(spark, before=number + 1) for n in names])


@dataclass(frozen=True)
class RoutingRun:
    routed: DataFrame
    states: DataFrame
    trace: DataFrame


def run_routing(
    judged: DataFrame,
    outlier,
    order_cols: list[str],
    params: ControllerParams = ControllerParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> RoutingRun:
    """Route readings under the controller.

    ``judged`` has ``edge_id``, ``latency_ms`` and ``draw`` and whatever ``outlier`` needs;
    ``order_cols`` put the messages of an edge in a unique order.
    """
    windowed = ctl.assign_windows(ctl.number_messages(judged, order_cols, limits), params.window_size)
    states = write_once(
        ctl.controller_fold(ctl.controller_windows(windowed, outlier, params), params), "states"
    )
    routed = ctl.route_readings(windowed, states, params, limits)
    backlog = ctl.cloud_backlog(routed, params, limits)
    return RoutingRun(routed, states, ctl.controller_trace(states, backlog))


@dataclass(frozen=True)
class EdgeModel:
    """Isolation forest with its cut-off."""

    forest: DataFrame
    threshold: float

    def judge(self, rows: DataFrame, params: IsolationParams = IsolationParams()) -> DataFrame:
        """Complete readings with ``anomaly_score`` and ``prediction`` (-1 for an outlier)."""
        return iforest.iforest_flag(iforest.iforest_score(rows, self.forest, params), self.threshold)


def train_edge_model(
    rows: DataFrame, key: str, path: str | None = None, params: IsolationParams = IsolationParams()
) -> EdgeModel:
    """Fit the forest and its cut-off on all rows, and save both if a path is given."""
    forest = iforest.iforest_fit(rows, key, params)
    threshold = iforest.iforest_threshold(iforest.iforest_score(rows, forest, params), params)
    if path:
        saved = forest.withColumn("threshold", F.lit(threshold))
        saved.write.mode("overwrite").parquet(path)
    return EdgeModel(forest, threshold)


def load_edge_model(spark: SparkSession, path: str) -> EdgeModel:
    saved = spark.read.parquet(path)
    return EdgeModel(saved.drop("threshold"), saved.first()["threshold"])


@dataclass(frozen=True)
class EdgeLearner:
    """An edge model that follows the readings: one sketch of all batches so far, below ``root``.

    ``key`` must tell the readings of all batches apart. The forest equals the one fitted on all
    readings at once. Its cut-off is the exact quantile over the sketch's readings, a sample of at
    most ``trees * sample_size``, so that the cost of a batch does not grow with the history.
    """

    root: str
    key: str
    params: IsolationParams = IsolationParams()

    def _sketch(self, rows: DataFrame) -> SnapshotTable:
        fields = iforest.sketch_schema(rows, self.key).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        return SnapshotTable(f"{self.root}/sketch", columns)

    def learn(self, batch: DataFrame, number: int) -> None:
        """Add a batch. One that runs again starts from what was there before it."""
        table = self._sketch(batch)
        held = table.read(batch.sparkSession, before=number)
        both = held.unionByName(iforest.forest_sketch(batch, self.key, self.params))
        table.replace(iforest.merged_sketch(both, self.key, self.params), version=number)

    def model(self, rows: DataFrame, number: int, start: EdgeModel) -> EdgeModel:
        """The model for batch ``number``, from the batches before it; ``start`` if there are none."""
        sketch = self._sketch(rows).read(rows.sparkSession, before=number)
        if sketch.isEmpty():
            return start
        forest = iforest.grow_forest(sketch, self.key, self.params)
        sample = sketch.drop("tree_id", "place").dropDuplicates([self.key])
        scored = iforest.iforest_score(sample, forest, self.params)
        return EdgeModel(forest, iforest.iforest_threshold(scored, self.params))


def run_edge(
    readings: DataFrame,
    model: EdgeModel,
    order_cols: list[str],
    params: ControllerParams = ControllerParams(),
    limits: ScaleLimits = ScaleLimits(),
) -> RoutingRun:
    """Judge readings with the edge model and route them under the controller."""
    judged = model.judge(readings).drop("connected_to")
    return run_routing(judged, "prediction = -1", order_cols, params, limits)


def run_training(
    telemetry: DataFrame, key, path: str | None = None, params: ForestParams = ForestParams()
):
    """Train and evaluate the failure model. None when there are too few rows.

    Returns (model, metrics).
    """
    if not has_rows(telemetry, params.min_rows):
        log.warning("fewer than %d rows, nothing trained", params.min_rows)
        return None
    train, test = ml.rf_split(telemetry, key, params)
    model = ml.rf_train(train, params)
    metrics = ml.rf_evaluate(ml.rf_predict(model, test))
    if path:
        ml.save_model(model, path)
    return model, metrics


def run_retrain(
    history: DataFrame,
    params: ControllerParams = ControllerParams(),
    k: int = 4,
    path: str | None = None,
    at: Column | None = None,
) -> DataFrame | None:
    """Fit the reconstruction model on the cloud history and return the notice to send.

    One pass over the history, see ``retrain_on``. ``at``, an aggregate over the rows in epoch
    seconds, is the time of the notice.
    """
    return retrain_on(history.sparkSession, ml.read_moments(ml.moments(history, at=at)), params, k, path)


def retrain_on(
    spark: SparkSession,
    found: ml.Moments | None,
    params: ControllerParams = ControllerParams(),
    k: int = 4,
    path: str | None = None,
) -> DataFrame | None:
    """Fit the reconstruction model on moments, and return the notice to send.

    The model is saved if a path is given; ``ml.load_code`` and ``ml.apply_linear_code`` score
    with it. None when there are too few complete rows.
    """
    if found is None or found.n < params.retrain_min_rows:
        log.warning("fewer than %d complete rows, nothing trained", params.retrain_min_rows)
        return None
    code, loss = ml.code_of(found, k)
    if path:
        ml.save_code(spark, code, path)
    return ctl.retrain_notice(spark, found.n, loss, found.newest)
