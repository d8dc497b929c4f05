import pytest
from pyspark.sql import functions as F

from fleetpulse.functions import expressions as E
from fleetpulse.operators import scoring
from fleetpulse.params import ScoringParams

CASES = [
    # tool wear, rpm, adjustment, score
    (200, 1300.0, 0.0, 1.0),
    (201, 1500.0, 0.0, -1.0),
    (10, 1299.9, 0.0, -1.0),
    (None, 1200.0, 0.0, -1.0),
    (None, None, 0.0, 1.0),
    (150, 1500.0, 0.3, -1.0),
    (10, 1350.0, 0.3, -1.0),
    (140, 1360.0, 0.3, 1.0),
]


def test_score_bounds_are_strict_and_nulls_do_not_trigger(spark):
    df = spark.createDataFrame(CASES, "wear int, rpm double, adj double, want double")
    score = E.prediction_score(F.col("wear"), F.col("rpm"), F.col("adj"))
    assert df.withColumn("got", score).where("got <> want").count() == 0


@pytest.mark.parametrize(
    "risk, rank, want", [(1.0, 2.0, 1.0), (None, 2.0, 0.0), (1.0, None, 0.0), (0.5, 1.0, 0.5)]
)
def test_adjustment_is_zero_when_a_part_is_missing(spark, risk, rank, want):
    df = spark.createDataFrame([(risk, rank)], "risk double, rank double")
    got = df.select(E.graph_adjustment(F.col("risk"), F.col("rank"))).first()[0]
    assert got == pytest.approx(want)


def test_adjustment_is_clamped_only_on_request(spark):
    df = spark.createDataFrame([(1.0, 9.0)], "risk double, rank double")
    free = E.graph_adjustment(F.col("risk"), F.col("rank"))
    clamped = E.graph_adjustment(
        F.col("risk"), F.col("rank"), ScoringParams(clamp_adjustment=True)
    )
    assert tuple(df.select(free, clamped).first()) == (pytest.approx(3.1), 1.0)


def test_draws_lie_in_range_for_any_key(spark):
    keys = [0, 1, -1, 2**31, 2**62, -(2**62), 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for row in df.select(E.unit_draw(F.col("k"), "any"), E.simulated_rtt(F.col("k"))).collect():
        assert 0 <= row[0] < 1 and 50 <= row[1] <= 500


def test_draw_is_the_head_of_a_hash(spark):
    import hashlib

    df = spark.range(50).select("id", E.unit_draw(F.col("id"), "x").alias("u"))
    for row in df.collect():
        assert row["u"] == int(hashlib.md5(f"{row['id']}:x".encode()).hexdigest()[:8], 16) / 2**32


def test_sampling_does_not_depend_on_the_latency(spark):
    df = spark.range(200_000).select(
        E.simulated_rtt(F.col("id")).alias("rtt"), (E.unit_draw(F.col("id"), "sample") < 0.2).alias("s")
    )
    shares = df.groupBy(F.floor(F.col("rtt") / 10)).agg(F.avg(F.col("s").cast("int")).alias("p")).collect()
    assert all(abs(r["p"] - 0.2) < 0.05 for r in shares)


def test_latency_bands(spark):
    df = spark.createDataFrame(
        [(199, True), (200, True), (499, True), (500, True), (10, False)],
        "ms bigint, up boolean",
    )
    got = [r[0] for r in df.select(E.latency_band(F.col("ms"), F.col("up"))).collect()]
    assert got == ["optimal", "moderate", "moderate", "critical", "critical"]


def test_epoch_round_trip(spark):
    seconds = [0.0, 1704067207.179575, 1706659032.194062]
    df = spark.createDataFrame([(s,) for s in seconds], "s double")
    back = df.select(E.epoch_seconds(E.from_epoch_seconds(F.col("s")))).collect()
    assert [r[0] for r in back] == seconds


def test_stats_of_an_empty_batch(spark):
    empty = spark.createDataFrame([], "graph_adjustment double")
    assert tuple(scoring.batch_adjust_stats(empty).first()) == (0, 0.0, 0.0, 0)
