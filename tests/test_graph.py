import random

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import graph, risk
from fleetpulse.params import GraphParams, ScaleLimits

SIX = [(1, 2), (1, 3), (2, 3), (3, 1), (4, 3), (5, 4), (5, 6), (6, 5)]
EIGHT = SIX + [(3, 7), (2, 8)]

RANKS = {
    "six": [
        1.8955565877091887, 0.9477673352284546, 2.041291335268927, 0.3387314883485718,
        0.4379217650962861, 0.3387314883485718,
    ],
    "eight": [
        1.112221633889201, 0.8102951890044409, 1.8008296842270926, 0.7533456581999302,
        0.9739468331537173, 0.7533456581999302, 1.112221633889201, 0.6837937094364875,
    ],
}
LABELS = {"six": "311365", "eight": "31136531"}
SALTED = ScaleLimits(hot_rows=1, broadcast_bytes=0, bucket_rows=2)


def frames(spark, edges):
    e = spark.createDataFrame([(str(a), str(b)) for a, b in edges], "src string, dst string")
    return e.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), e


def by_number(df, value):
    rows = sorted(df.collect(), key=lambda r: int(r.machine_id))
    return [r[value] for r in rows]


@pytest.mark.parametrize("limits", [ScaleLimits(), SALTED], ids=["plain", "salted"])
@pytest.mark.parametrize("name, edges", [("six", SIX), ("eight", EIGHT)])
def test_known_graphs(spark, name, edges, limits):
    nodes, e = frames(spark, edges)
    ranks = by_number(graph.pagerank(nodes, e, limits=limits), "pagerank")
    assert ranks == pytest.approx(RANKS[name], abs=1e-12)
    labels = by_number(graph.label_propagation(nodes, e, limits=limits), "community_id")
    assert "".join(labels) == LABELS[name]


def plain_pagerank(nodes, edges, steps):
    out = {n: [b for a, b in edges if a == n] for n in nodes}
    r = {n: 1.0 for n in nodes}
    for _ in range(steps):
        got = {n: 0.0 for n in nodes}
        for n in nodes:
            for m in out[n]:
                got[m] += r[n] / len(out[n])
        r = {n: 0.15 + 0.85 * got[n] for n in nodes}
    total = sum(r.values())
    return [r[n] * len(nodes) / total for n in nodes]


def plain_labels(nodes, edges, steps):
    label = {n: n for n in nodes}
    for _ in range(steps):
        votes = {n: {} for n in nodes}
        for a, b in edges:
            votes[b][label[a]] = votes[b].get(label[a], 0) + 1
            votes[a][label[b]] = votes[a].get(label[b], 0) + 1
        label = {
            n: min(votes[n], key=lambda v: (-votes[n][v], v)) if votes[n] else label[n] for n in nodes
        }
    return [str(label[n]) for n in nodes]


@pytest.mark.parametrize(
    "limits",
    [
        ScaleLimits(bucket_rows=20),
        ScaleLimits(hot_rows=5, broadcast_bytes=0),
        ScaleLimits(hot_rows=5, bucket_rows=20),
    ],
    ids=["buckets", "salts", "salted buckets"],
)
def test_graph_with_a_hub_against_plain_python(spark, limits):
    """Node 0 takes part in a third of the edges; node 60 has none."""
    rng = random.Random(3)
    edges = {(0, rng.randrange(1, 60)) for _ in range(40)} | {(rng.randrange(1, 60), 0) for _ in range(30)}
    edges |= {(a, b) for a, b in ((rng.randrange(60), rng.randrange(60)) for _ in range(140)) if a != b}
    edges, nodes = sorted(edges), list(range(61))
    _, e = frames(spark, edges)
    n = spark.createDataFrame([(str(i),) for i in nodes], "id string")
    params = GraphParams(checkpoint_every=2)
    assert by_number(graph.pagerank(n, e, params, limits), "pagerank") == pytest.approx(
        plain_pagerank(nodes, edges, 10), abs=1e-12
    )
    labels = by_number(graph.label_propagation(n, e, params, limits), "community_id")
    assert labels == plain_labels(nodes, edges, 5)


def test_empty_neighbour_lists_and_unknown_ends(spark):
    rows = spark.createDataFrame(
        [("a", ["b", "z"]), ("b", []), ("c", None), ("a", ["b"]), (None, ["a"])],
        "machine_id string, connected_to array<string>",
    )
    nodes, edges = graph.graph_nodes(rows), graph.graph_edges(rows)
    assert sorted(r.id for r in nodes.collect()) == ["a", "b", "c"]
    assert sorted(map(tuple, edges.collect())) == [("a", "b"), ("a", "z")]
    assert [tuple(r) for r in graph.graph_build(nodes, edges)[1].collect()] == [("a", "b")]


def test_no_steps(spark):
    nodes, e = frames(spark, SIX)
    none = GraphParams(pagerank_iters=0, label_iters=0)
    assert by_number(graph.pagerank(nodes, e, none), "pagerank") == [1.0] * 6
    assert by_number(graph.label_propagation(nodes, e, none), "community_id") == list("123456")


def test_risk_of_the_six_node_graph(spark):
    nodes, e = frames(spark, SIX)
    members = risk.join_community_rank(graph.label_propagation(nodes, e), graph.pagerank(nodes, e))
    assert risk.median_rank(members).first()[0] == pytest.approx(0.437921765)
    got = {r.community_id: r for r in risk.community_risk(risk.community_agg(members)).collect()}
    want = {
        "1": (2, 1.494529335, 2, 1.0),
        "3": (2, 1.117144038, 1, 0.747488866),
        "5": (1, 0.338731488, 0, 0.142998715),
        "6": (1, 0.437921765, 0, 0.184872832),
    }
    for community, (size, mean, critical, score) in want.items():
        row = got[community]
        assert (row.member_count, row.critical_count) == (size, critical)
        assert row.avg_pagerank == pytest.approx(mean, abs=1e-9)
        assert row.risk_score == pytest.approx(score, abs=1e-9)


def test_approximate_median_is_close(spark):
    members = spark.range(1000).select(F.lit("c").alias("community_id"), F.col("id").cast("double").alias("pagerank"))
    approx = risk.median_rank(members, GraphParams(median_rel_err=0.01)).first()[0]
    assert abs(approx - 499) <= 10


def test_risk_of_nothing(spark):
    empty = spark.createDataFrame([], "community_id string, machine_id string, pagerank double")
    assert risk.median_rank(empty).first()[0] == 1.0
    assert risk.risk_norm_max(risk.community_agg(empty)).first()[0] == 1.0
    assert risk.community_risk(risk.community_agg(empty)).count() == 0


def test_context_has_one_row_per_machine(spark, readings):
    from fleetpulse.plans.jobs import graph_tables

    tables = graph_tables(readings)
    machines = readings.select("machine_id").distinct().count()
    assert tables.context().count() == machines
    assert risk.duplicated_machines(tables.communities).count() == 0
    assert tables.ranks.agg(F.sum("pagerank")).first()[0] == pytest.approx(machines)
    assert tables.risk.agg(F.max("risk_score")).first()[0] == 1.0
    split = tables.context(ScaleLimits(broadcast_bytes=0, hot_rows=2))
    assert split.exceptAll(tables.context()).count() == 0


def test_graph_without_edges(spark):
    from fleetpulse.plans.jobs import graph_tables

    rows = spark.createDataFrame([("a", [])], "machine_id string, connected_to array<string>")
    assert graph_tables(rows) is None


def test_bucketed_edges_are_not_shuffled_again(spark, monkeypatch):
    """A step on bucketed edges exchanges only messages."""
    nodes, e = frames(spark, SIX)
    plans, store = [], graph.cut

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df)

    monkeypatch.setattr(graph, "cut", watched)
    params = GraphParams(pagerank_iters=2, checkpoint_every=2)
    graph.pagerank(nodes, e, params, ScaleLimits(bucket_rows=2))
    step = next(p for p in plans if "ShuffledHashJoin" in p)
    assert "Bucketed: true" in step and step.count("Exchange hashpartitioning(dst") == 2
    assert "Exchange hashpartitioning(src" not in step
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fleetpulse_")]


def bounded_buckets(spark, monkeypatch, loop):
    """Buckets made with a bound of 6, and the results with and without that bound."""
    rng = random.Random(7)
    _, e = frames(spark, list({(rng.randrange(40), rng.randrange(40)) for _ in range(150)}))
    nodes = e.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    made, original = [], graph.bucketed
    monkeypatch.setattr(
        graph, "bucketed", lambda df, keys, n, label: made.append(n) or original(df, keys, n, label)
    )
    bounded = sorted(loop(nodes, e, limits=ScaleLimits(bucket_rows=2, max_buckets=6)).collect())
    return made, bounded, sorted(loop(nodes, e, limits=ScaleLimits()).collect())


def test_buckets_of_label_propagation_are_bounded(spark, monkeypatch):
    """Every bucket is a task per step that reports to the driver: they do not grow with the edges."""
    made, bounded, plain = bounded_buckets(spark, monkeypatch, graph.label_propagation)
    assert made == [6] and bounded == plain


def test_buckets_of_pagerank_are_bounded(spark, monkeypatch):
    def rounded(*args, **kwargs):
        ranks = graph.pagerank(*args, **kwargs)
        return ranks.select("machine_id", F.round("pagerank", 9))

    made, bounded, plain = bounded_buckets(spark, monkeypatch, rounded)
    assert made == [6] and bounded == plain
