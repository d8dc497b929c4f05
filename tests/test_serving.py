import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetpulse.params import ScaleLimits
from fleetpulse.plans import serving

T0 = dt.datetime(2024, 1, 1)
STATES = "machine_id string, last_update timestamp, status string, air_temp double, torque double"
CONTROLLER = (
    "controller_id string, latency_threshold double, cloud_sample_rate double, retrain_interval int, "
    "edge_anomaly_rate double, cloud_backlog int, avg_rtt double, last_updated timestamp"
)


def test_summary_counts_missing_sensors_as_zero(spark):
    rows = [
        ("a", T0, "CRITICAL", 300.0, None),
        ("b", T0, "HEALTHY", None, 10.0),
        ("c", T0, None, float("nan"), 20.0),
    ]
    got = serving.fleet_summary(spark.createDataFrame(rows, STATES)).first()
    assert tuple(got) == (3, 1, 2, 33.3, 100.0, 0.0, 300.0, 10.0, 0.0, 20.0)


def test_summary_of_an_empty_fleet(spark):
    got = serving.fleet_summary(spark.createDataFrame([], STATES)).first()
    assert tuple(got)[:4] == (0, 0, 0, 0.0)


def test_every_machine_is_on_one_list(spark):
    rows = [("a", T0, "CRITICAL", 1.0, 1.0), ("b", T0, "HEALTHY", 1.0, 1.0), ("c", T0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, STATES)
    lists = [[r.machine_id for r in serving.machines_by_status(df, c).collect()] for c in (True, False)]
    assert lists == [["a"], ["b", "c"]]


@pytest.fixture(scope="module")
def alerts(spark):
    return spark.range(40).select(
        F.concat(F.lit("m"), F.col("id") % 7).alias("machine_id"),
        F.timestamp_seconds(F.col("id") * 10).alias("alert_time"),
        F.when(F.col("id") != 39, F.lit(300.04)).alias("air_temp"),
        F.lit(310.0).alias("process_temp"),
        F.lit(1400.6).alias("rotational_speed"),
        F.when(F.col("id") != 38, (F.col("id") * 10).cast("int")).alias("tool_wear"),
        F.lit(40.26).alias("torque"),
    )


def test_newest_alerts_and_series(alerts):
    newest = [r.alert_time for r in serving.latest_alerts(alerts).collect()]
    assert len(newest) == 15 and newest == sorted(newest, reverse=True)
    series = [r.alert_time for r in serving.sensor_series(alerts).collect()]
    assert series == newest[::-1]


def test_ticker(alerts):
    first, second, *_ = rows = serving.alert_ticker(alerts).collect()
    assert len(rows) == 5
    assert (first.air_temp, first.rotational_speed, first.torque) == (0.0, 1401.0, 40.3)
    assert first.wear_warning and second.tool_wear is None and not second.wear_warning


def test_leaderboard(spark):
    rows = [(f"m{i:02d}", float(i // 2)) for i in range(30)] + [("none", None)]
    ranks = spark.createDataFrame(rows, "machine_id string, pagerank double")
    top = serving.pagerank_top10(ranks).orderBy("place").collect()
    assert [r.machine_id for r in top][:4] == ["m28", "m29", "m26", "m27"]
    assert [r.top_three for r in top] == [True] * 3 + [False] * 7
    board = [r.machine_id for r in serving.pagerank_board(ranks).collect()]
    assert len(board) == 31 and set(board[-3:]) == {"m00", "m01", "none"}


def test_members_come_in_bounded_pages(spark):
    df = spark.range(100).select(
        F.when(F.col("id") < 70, "big").otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("community_id"),
        F.format_string("m%03d", "id").alias("machine_id"),
    )
    pages = serving.community_members(df, ScaleLimits(page_rows=20)).collect()
    assert max(len(p.machines) for p in pages) == 20 and sum(len(p.machines) for p in pages) == 100
    big = sorted((p.page, p.machines) for p in pages if p.community_id == "big")
    assert [m for _, ms in big for m in ms] == [f"m{i:03d}" for i in range(70)]
    top = serving.community_top5(df, 2).collect()
    assert [(r.community_id, r.member_count) for r in sorted(top, key=lambda r: -r.member_count)] == [
        ("big", 70), ("c0", 10),
    ]


def test_unknown_controller_shows_defaults(spark):
    row = ("x", 180.0, 0.15, 600, 0.0444, 3, 251.6, T0)
    states = spark.createDataFrame([row], CONTROLLER)
    missing = serving.controller_lookup(states, "y").first()
    assert tuple(missing) == ("y", 200.0, 0.2, 500, 0.0, 0, 0.0, None, False)
    found = serving.controller_lookup(states, "x")
    assert tuple(found.first()) == (*row, True)
    assert tuple(serving.controller_card(found).first()) == ("x", 180, 15, 600, 4.4, 3, 252, "ACTIVE")
