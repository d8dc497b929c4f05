import random

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import controller as ctl
from fleetpulse.params import ControllerParams, ScaleLimits
from fleetpulse.plans.jobs import run_routing

SMALL = ControllerParams(window_size=20, retrain_every=30)
OUTLIER = "outlier"

# window rate, window RTT -> action, threshold, sample, interval, rate EMA, RTT EMA
TRACE = [
    (0.0, 250, "REDUCE_CLOUD", 180, 0.15, 600, 0.0, 250.0),
    (0.2, 300, "FINE_TUNE_EDGE", 175, 0.15, 600, 0.06, 260.0),
    (0.2, 300, "FINE_TUNE_EDGE", 170, 0.15, 600, 0.102, 268.0),
    (0.6, 260, "EXPAND_CLOUD", 190, 0.20, 550, 0.2514, 266.4),
    (0.1, 200, "EXPAND_CLOUD", 210, 0.25, 500, 0.20598, 253.12),
    (0.0, 150, "FINE_TUNE_CLOUD", 215, 0.25, 500, 0.144186, 232.496),
]


def trace_windows(spark, trace=TRACE):
    rows = [
        ("e", i, 200, 200.0 * rtt, [450.0] * round(200 * rate), [0.99] * round(200 * rate))
        for i, (rate, rtt, *_) in enumerate(trace)
    ]
    return spark.createDataFrame(rows, ctl.WINDOW_SCHEMA)


def check_trace(rows, trace):
    assert len(rows) == len(trace)
    for row, (_, _, action, threshold, sample, interval, rate, rtt) in zip(rows, trace):
        assert row.action == action and row.retrain_interval == interval
        got = (row.latency_threshold, row.cloud_sample_rate, row.edge_anomaly_rate, row.avg_rtt)
        assert got == pytest.approx((threshold, sample, rate, rtt))


def test_known_trace(spark):
    check_trace(ctl.controller_fold(trace_windows(spark)).orderBy("window_no").collect(), TRACE)


def test_fold_resumes_from_a_given_state(spark):
    windows = trace_windows(spark)
    first = ctl.controller_fold(windows.where("window_no < 3"))
    start = first.where("window_no = 2")
    rest = ctl.controller_fold(windows.where("window_no >= 3"), start=start)
    check_trace(rest.orderBy("window_no").collect(), TRACE[3:])


def simulate(rows, p):
    """One message at a time, the way a single controller would see them."""
    s = dict(thr=p.start_threshold, smp=p.start_sample_rate, itv=p.start_interval, rate=0.0, rtt=250.0)
    routed, states, n, bad, rtt_sum = [], [], 0, 0, 0.0
    for key, latency, draw, outlier in rows:
        cloud = latency < s["thr"] or draw < s["smp"]
        routed.append((key, cloud))
        n, rtt_sum = n + 1, rtt_sum + latency
        bad += outlier and not cloud
        if n == p.window_size:
            old = s["rtt"]
            s["rate"] = 0.3 * (bad / n) + 0.7 * s["rate"]
            s["rtt"] = 0.2 * (rtt_sum / n) + 0.8 * s["rtt"]
            if s["rate"] > 0.15:
                s["thr"] += 20
                s["smp"], s["itv"] = min(s["smp"] + 0.05, 0.9), max(s["itv"] - 50, 200)
            elif s["rate"] < 0.02:
                s["thr"] -= 20
                s["smp"], s["itv"] = max(s["smp"] - 0.05, 0.1), min(s["itv"] + 100, 2000)
            elif s["rtt"] - old > 5:
                s["thr"] -= 5
            elif s["rtt"] - old < -5:
                s["thr"] += 5
            s["thr"] = max(100, min(400, s["thr"]))
            states.append(tuple(s.values()))
            n, bad, rtt_sum = 0, 0, 0.0
    return routed, states


def messages(seed, edges=("a", "a", "b"), count=900, noise=0.3):
    """Two thirds of the messages belong to one edge."""
    rng = random.Random(seed)
    return [
        (rng.choice(edges), i, rng.randint(50, 500), rng.random(), rng.random() < noise)
        for i in range(count)
    ]


SCHEMA = "edge_id string, event_id bigint, latency_ms int, draw double, outlier boolean"


@pytest.mark.parametrize(
    "noise, limits",
    [
        (0.0, ScaleLimits()),
        (0.12, ScaleLimits(broadcast_bytes=0, block_rows=4)),
        (0.5, ScaleLimits()),
        (1.0, ScaleLimits(block_rows=4)),
    ],
)
def test_routing_matches_a_sequential_controller(spark, noise, limits):
    data = messages(int(noise * 100), noise=noise)
    run = run_routing(spark.createDataFrame(data, SCHEMA), OUTLIER, ["event_id"], SMALL, limits)
    for edge in ("a", "b"):
        rows = [m[1:] for m in data if m[0] == edge]
        routed, states = simulate(rows, SMALL)
        got = run.routed.where(F.col("edge_id") == edge).orderBy("seq").collect()
        assert [(r.event_id, r.to_cloud) for r in got] == routed
        trace = run.trace.where(F.col("edge_id") == edge).orderBy("window_no").collect()
        assert len(trace) == len(states)
        sent = 0
        for i, (row, state) in enumerate(zip(trace, states)):
            mine = (
                row.latency_threshold, row.cloud_sample_rate, row.retrain_interval,
                row.edge_anomaly_rate, row.avg_rtt,
            )
            assert mine == pytest.approx(state, abs=1e-9)
            assert 100 <= mine[0] <= 400 and 0.1 <= mine[1] <= 0.9 and 200 <= mine[2] <= 2000
            sent += sum(c for _, c in routed[i * 20 : (i + 1) * 20])
            assert row.cloud_backlog == sent % 30


def test_every_message_goes_somewhere(spark):
    rows = spark.createDataFrame(messages(1), SCHEMA)
    routed = ctl.route_readings(rows)
    stats = ctl.edge_run_stats(routed, OUTLIER).first()
    cloud = routed.where("to_cloud").count()
    assert stats.processed == 900 and stats.cloud_pct == pytest.approx(cloud / 9)
    assert stats.anomalies == ctl.edge_alerts(routed, OUTLIER).count()
    assert routed.where("to_cloud <> (latency_ms < 200 OR draw < 0.2)").count() == 0


def test_stats_of_no_messages(spark):
    empty = ctl.route_readings(spark.createDataFrame([], SCHEMA))
    assert tuple(ctl.edge_run_stats(empty, OUTLIER).first()) == (0, 0, None)


def test_incomplete_window_is_not_acted_on(spark):
    rows = spark.createDataFrame(messages(2, edges=("a",), count=39), SCHEMA)
    run = run_routing(rows, OUTLIER, ["event_id"], SMALL)
    assert [r.window_no for r in run.states.collect()] == [0]


def test_retraining_after_every_full_batch(spark):
    rows = spark.createDataFrame(messages(3, count=100), SCHEMA)
    got = ctl.retrain_trigger(rows, ["event_id"], SMALL).orderBy("retrain_no").collect()
    assert [(r.retrain_no, r.records, r.event_id) for r in got] == [(1, 30, 29), (2, 60, 59), (3, 90, 89)]


def test_feedback_empties_the_backlog(spark):
    rows = [("a", w, True) for w in range(5) for _ in range(10)] + [("b", 0, True)]
    routed = spark.createDataFrame(rows, "edge_id string, window_no bigint, to_cloud boolean")
    notices = spark.createDataFrame([("a", 1), ("a", 3), ("c", 0)], "edge_id string, window_no bigint")
    found = ctl.cloud_backlog(routed, feedback=notices).collect()
    assert sorted((r.edge_id, r.window_no, r.cloud_backlog) for r in found) == [
        ("a", 0, 10), ("a", 1, 0), ("a", 2, 10), ("a", 3, 0), ("a", 4, 10), ("b", 0, 1),
    ]


def test_a_start_below_the_bounds_counts_every_outlier(spark):
    params = ControllerParams(window_size=4, start_threshold=50.0, start_sample_rate=0.0)
    rows = [("e", i, 60 + i, 0.01 * i, True) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("window_no", F.lit(0).cast("bigint"))
    summary = ctl.controller_windows(df, "outlier", params).first()
    assert len(summary.outlier_latency) == 4
