import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetpulse.operators import distribute as D
from fleetpulse.params import ScaleLimits

TINY = ScaleLimits(broadcast_bytes=0, hot_rows=50, block_rows=16)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, and some without a group."""
    group = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 7)
    return spark.range(3000).select(group.alias("g"), F.xxhash64("id").alias("o")).persist()


@pytest.mark.parametrize("limits", [ScaleLimits(), TINY])
@pytest.mark.parametrize("group", [["g"], []])
def test_numbers_match_row_number(skewed, group, limits):
    got = D.number_rows(skewed, group, ["o"], "no", limits)
    by = Window.partitionBy(*(group or [F.lit(0)])).orderBy("o")
    assert got.count() == skewed.count()
    assert got.withColumn("want", F.row_number().over(by)).where("no <> want").count() == 0


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_quantile_is_the_discrete_one(spark, p):
    rng = random.Random(7)
    values = [rng.choice([1.5, 2.5, rng.random() * 10]) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = sorted(values)[max(1, -(-len(values) * p // 1).__int__()) - 1]
    assert D.exact_quantile(df, "v", p).first()[0] == want


def test_quantile_of_nothing_and_of_ten(spark):
    assert D.exact_quantile(spark.range(1, 11), "id", 0.5).first()[0] == 5
    assert D.exact_quantile(spark.range(0), "id", 0.5).first()[0] is None


def test_running_total(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("g"), F.floor(F.col("id") / 3).alias("pos"), (F.col("id") % 11).alias("v")
    )
    got = D.running_total(df, ["g"], "pos", "v", "t", TINY)
    by = Window.partitionBy("g").orderBy("pos")
    assert got.withColumn("want", F.sum("v").over(by)).where("t <> want").count() == 0
    assert got.count() == 500


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("limits", [ScaleLimits(), TINY, ScaleLimits(broadcast_bytes=0)])
def test_lookup_join_is_a_join(spark, skewed, how, limits):
    lookup = spark.range(5).select(F.col("id").alias("g"), (F.col("id") * 10).alias("z"))
    got, want = D.lookup_join(skewed, lookup, "g", how, limits), skewed.join(lookup, "g", how)
    assert sorted(got.columns) == sorted(want.columns)
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_every_key_above_the_bound_is_hot(skewed):
    counts = {r["g"]: r["n"] for r in skewed.groupBy("g").agg(F.count("*").alias("n")).collect() if r["g"] is not None}
    hot = {r["g"]: r["_parts"] for r in D.hot_keys(skewed, "g", ScaleLimits(hot_rows=1)).collect()}
    assert hot == {g: n for g, n in counts.items() if n > 1}


def test_rows_of_a_hot_key_are_dealt(spark, skewed):
    """Beyond the broadcast bound the rows of a hot key meet their lookup row in several parts."""
    lookup = spark.range(5).select(F.col("id").alias("g"), F.lit(1).alias("z"))
    joined = D.lookup_join(skewed, lookup, "g", "left", TINY)
    assert "_part" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_measured_size_counts_text_and_lists(spark):
    df = spark.createDataFrame([("abc", ["x", "yy"]), (None, None)], "a string, b array<string>")
    assert D.measured_bytes(df) == 2 * 32 + 3 + (4 + 32)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_as_of_equals_plain_version(spark, keys):
    rng = random.Random(4)
    times = [None, *range(0, 40, 3), 12, 12]
    left = [(i, rng.choice("ab"), rng.choice(times)) for i in range(300)] + [(500, "a", 12)] * 200
    right = [(rng.choice("ab"), rng.choice(times), v) for v in range(12)]
    found = D.as_of(
        spark.createDataFrame(left, "i int, k string, t int").repartition(3),
        spark.createDataFrame(right, "k string, at int, v int"),
        "t", "at", "hit", keys,
    )

    def plain(k, t):
        known = [(at, k2, v) for k2, at, v in right if at is not None and t is not None and at <= t and (not keys or k2 == k)]
        best = max(known, key=lambda r: (r[0], r[1], r[2]), default=None)
        return None if best is None else (best[1], best[0], best[2])

    made = [(r.i, r.k, r.t, r.hit and tuple(r.hit)) for r in found.collect()]
    assert sorted(map(repr, made)) == sorted(repr((*row, plain(row[1], row[2]))) for row in left)
