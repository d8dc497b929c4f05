import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fleetpulse.sources.tables import KeyedTable, SnapshotTable, commit_number

T0 = dt.datetime(2024, 1, 1)


def states(spark, *rows):
    data = [(m, T0 + dt.timedelta(seconds=s), status, 1.0, 2.0) for m, s, status in rows]
    return spark.createDataFrame(
        data, "machine_id string, last_update timestamp, status string, air_temp double, torque double"
    )


def content(df):
    return sorted((r.machine_id, r.status) for r in df.collect())


def test_newest_state_wins_whatever_the_order(spark, tmp_path):
    table = KeyedTable.named(str(tmp_path), "machine_states")
    assert not table.exists(spark) and table.read(spark).count() == 0
    table.upsert(states(spark, ("a", 5, "new"), ("a", 1, "old"), ("b", 1, "only")), 0)
    table.upsert(states(spark, ("a", 3, "late"), ("c", 1, "only")), 1)
    assert content(table.read(spark)) == [("a", "new"), ("b", "only"), ("c", "only")]


def test_replay_changes_nothing(spark, tmp_path):
    table = KeyedTable.named(str(tmp_path), "machine_states")
    for _ in range(3):
        table.upsert(states(spark, ("a", 1, "x")), 0)
        table.upsert(states(spark, ("a", 2, "y")), 1)
    assert content(table.read(spark)) == [("a", "y")]


def test_compaction_keeps_the_content(spark, tmp_path):
    table = KeyedTable.named(str(tmp_path), "machine_states")
    for batch in range(6):
        table.upsert(states(spark, ("a", batch, f"s{batch}"), (f"m{batch}", 1, "x")), batch)
        if batch % 2:
            table.compact(spark)
            table.compact(spark)
        assert table.read(spark).count() == batch + 2
    assert ("a", "s5") in content(table.read(spark))
    left = sorted(p.name for p in (tmp_path / "machine_states").iterdir())
    assert left == ["slice=batch-4", "slice=batch-5", "slice=merged-3", "slice=merged-5"]


def test_snapshot_is_replaced_as_a_whole(spark, tmp_path):
    table = SnapshotTable.named(str(tmp_path), "failure_communities")
    df = spark.createDataFrame([("1", "a"), ("1", "b")], "community_id string, machine_id string")
    table.replace(df)
    table.replace(df.where("machine_id = 'a'"))
    assert [r.machine_id for r in table.read(spark).collect()] == ["a"]
    assert table.read(spark, before=1).count() == 2


def test_unfinished_version_is_ignored(spark, tmp_path):
    table = SnapshotTable.named(str(tmp_path), "failure_communities")
    df = spark.createDataFrame([("1", "a")], "community_id string, machine_id string")
    table.replace(df)
    (tmp_path / "failure_communities" / "version=1").mkdir()
    assert table.read(spark).count() == 1
    assert table.replace(df.withColumn("machine_id", F.lit("z"))) == 1
    assert table.read(spark).first().machine_id == "z"


def test_only_recent_versions_stay(spark, tmp_path):
    table = SnapshotTable.named(str(tmp_path), "failure_communities")
    df = spark.createDataFrame([("1", "a")], "community_id string, machine_id string")
    for _ in range(4):
        table.replace(df)
    assert sorted(p.name for p in (tmp_path / "failure_communities").iterdir()) == ["version=2", "version=3"]


def test_numbers_go_on_after_a_restart(spark, tmp_path):
    """A stream with a new checkpoint counts its batches from 0 again; its rows still come last."""
    root, table = str(tmp_path), KeyedTable.named(str(tmp_path), "machine_states")
    sc = spark.sparkContext
    try:
        for run, status in (("first", "HEALTHY"), ("second", "CRITICAL")):
            sc.setLocalProperty("sql.streaming.queryId", run)
            for batch in (0, 1, 1):
                number = commit_number(spark, root, batch)
                table.upsert(states(spark, ("a", 5, status), (f"{run}{batch}", 1, status)), number)
            if run == "first":
                table.compact(spark)
        assert commit_number(spark, root, 0) == 2
    finally:
        sc.setLocalProperty("sql.streaming.queryId", None)
    names = [m for m, _ in content(table.read(spark))]
    assert names == ["a", "first0", "first1", "second0", "second1"]
    assert ("a", "CRITICAL") in content(table.read(spark))


def test_critical_wins_a_tie(spark, tmp_path):
    table = KeyedTable.named(str(tmp_path), "machine_states")
    table.upsert(states(spark, ("a", 5, "CRITICAL"), ("b", 5, "HEALTHY")), 0)
    table.upsert(states(spark, ("a", 5, "HEALTHY"), ("b", 5, "CRITICAL")), 1)
    assert content(table.read(spark)) == [("a", "CRITICAL"), ("b", "CRITICAL")]


def alert_rows(spark, numbers, score=-1.0):
    """One alert a number: ten machines, a tenth of a day apart."""
    rows = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    columns = {"latency_ms": F.lit(0), "tool_wear": F.col("n").cast("int"), "prediction_score": F.lit(score)}
    for name in ("air_temp", "process_temp", "rotational_speed", "torque"):
        columns[name] = F.col("n").cast("double")
    return rows.select(
        F.concat(F.lit("M"), F.col("n") % 10).alias("machine_id"),
        F.timestamp_seconds(F.col("n") * 8640).alias("alert_time"),
        *[c.alias(name) for name, c in columns.items()],
    )


def wear(df):
    return sorted(r.tool_wear for r in df.collect())


def test_day_log_rewrites_little_and_lists_little(spark, tmp_path):
    log = replace(KeyedTable.named(str(tmp_path), "realtime_alerts"), fanout=3)
    batches = 30
    for batch in range(batches):
        # Most rows are of the day of the batch's ten, some of the first day, some are written again.
        log.upsert(alert_rows(spark, [batch, 5 * batch // 2, 1000 + batch, 0]), batch, combine=False)
        assert len(list(tmp_path.glob("realtime_alerts/commit=*"))) <= 2
    expected = {n for b in range(batches) for n in (b, 5 * b // 2, 1000 + b, 0)}
    assert wear(log.read(spark)) == sorted(expected)
    commit = log.commit(spark)
    assert commit.rewritten <= 8 * batches  # three days a batch at most, rewritten log3(30) times at most
    for day in {r.day for r in commit.runs}:
        levels = [r.level for r in commit.runs if r.day == day]
        assert all(levels.count(x) < 3 for x in levels)
    assert max(r.level for r in commit.runs) >= 2
    assert wear(log.read(spark, 1, 2)) == sorted(n for n in expected if 10 <= n < 30)
    live = {r.path for r in commit.runs} | set(commit.replaced)
    on_disk = {str(p.relative_to(tmp_path / "realtime_alerts")) for p in tmp_path.glob("realtime_alerts/runs/*/day=*")}
    assert live <= on_disk
    log.compact(spark)
    assert wear(log.read(spark)) == sorted(expected)
    assert len({r.day for r in log.commit(spark).runs}) == len(log.commit(spark).runs)


def test_day_log_batch_is_in_as_a_whole_or_not(spark, tmp_path, monkeypatch):
    log = replace(KeyedTable.named(str(tmp_path), "realtime_alerts"), fanout=2)
    log.upsert(alert_rows(spark, [1, 2]), 0)
    with monkeypatch.context() as broken:
        broken.setattr(type(log), "_write_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.upsert(alert_rows(spark, [3, 4]), 1)
    assert wear(log.read(spark)) == [1, 2]
    log.upsert(alert_rows(spark, [3]), 1)
    log.upsert(alert_rows(spark, [9]), 1)  # in already
    assert wear(log.read(spark)) == [1, 2, 3]
    assert commit_number(spark, str(tmp_path), 7) == 7
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "another")
    try:
        assert commit_number(spark, str(tmp_path), 0) == 2
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
