import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import iforest, ml
from fleetpulse.params import ForestParams, IsolationParams, ScaleLimits
from fleetpulse.plans import jobs
from fleetpulse.schema import FEATURES


def matrix(df):
    return df.select(*FEATURES).toPandas().to_numpy(dtype=float)


def scaled(x):
    span = x.max(0) - x.min(0)
    span[span == 0] = 1
    return (x - x.min(0)) / span


def test_minmax_maps_a_constant_to_zero(spark, readings):
    rows = readings.withColumn("torque", F.lit(7.0))
    got = matrix(ml.feature_minmax(rows))
    assert got == pytest.approx(scaled(matrix(rows)), abs=1e-12)
    assert (got[:, 3] == 0).all()


@pytest.mark.parametrize("k", [1, 2, 4, 5])
def test_reconstruction_error_against_svd(spark, readings, k):
    x = scaled(matrix(readings.orderBy("event_id")))
    centred = x - x.mean(0)
    _, _, v = np.linalg.svd(centred, full_matrices=False)
    rest = centred - centred @ v[:k].T @ v[:k]
    got = ml.recon_error(readings, k, keep=["event_id"]).orderBy("event_id").toPandas()
    assert got["recon_error"].to_numpy() == pytest.approx((rest**2).sum(1) / 5, abs=1e-9)
    assert (got["recon_error"] >= 0).all()


def test_reconstruction_skips_incomplete_rows(spark, readings):
    rows = readings.withColumn("torque", F.when(F.col("event_id") % 2 == 0, F.col("torque")))
    assert ml.recon_error(rows).count() == rows.where("torque IS NOT NULL").count()
    code = ml.fit_linear_code(rows)
    errors = ml.apply_linear_code(rows, code)
    assert errors.where("torque IS NULL AND recon_error IS NOT NULL").count() == 0
    assert ml.recon_error(rows.limit(0)).count() == 0


def test_retraining_needs_enough_rows(spark, readings):
    assert jobs.run_retrain(readings.limit(49)) is None
    notice = jobs.run_retrain(readings).first()
    assert notice.type == "retrain_complete" and notice.records_trained == readings.count()
    assert notice.training_loss > 0


def test_merged_moments_give_the_code_of_all_rows(spark, readings):
    rows = readings.withColumn("torque", F.col("torque") + F.pmod(F.xxhash64("event_id"), F.lit(97)))
    rows = rows.withColumn("torque", F.when(F.col("event_id") % 11 > 0, F.col("torque")))
    held = None
    for part in (3, 0, 1, 2, 4):  # of unequal sizes, the last one empty
        some = rows.where(F.least(F.col("event_id") % 7, F.lit(3)) == part)
        newest = F.max(F.unix_timestamp("event_time").cast("double"))
        held = ml.merge_moments(held, ml.read_moments(ml.moments(some, at=newest)))
    held = ml.read_moments(held.frame(spark))
    x = matrix(rows.where("torque IS NOT NULL"))
    assert held.n == len(x) and held.newest == readings.agg(F.max(F.unix_timestamp("event_time"))).first()[0]
    assert held.products / held.n == pytest.approx(np.cov(x.T, bias=True), rel=1e-9, abs=1e-9)
    code, loss = ml.code_of(held, k=2)
    whole = ml.fit_linear_code(rows, k=2)
    assert code.means == pytest.approx(whole.means) and code.ranges == pytest.approx(whole.ranges)
    for a, b in zip(code.components, whole.components):
        assert abs(np.dot(a, b)) == pytest.approx(1)
    errors = ml.apply_linear_code(rows, code).agg(F.avg("recon_error")).first()[0]
    assert errors > 1e-3 and loss == pytest.approx(errors)
    assert ml.read_moments(ml.moments(rows.limit(0))) is None


def test_split_does_not_depend_on_partitioning(spark, readings):
    train, test = ml.rf_split(readings, F.col("event_id"))
    again, _ = ml.rf_split(readings.repartition(7), F.col("event_id"))
    assert train.select("event_id").exceptAll(again.select("event_id")).count() == 0
    assert train.count() + test.count() == readings.count()
    assert 0.75 < train.count() / readings.count() < 0.85


def test_metrics_against_counts_by_hand(spark):
    rows = [(1, 1.0)] * 6 + [(1, 0.0)] * 2 + [(0, 1.0)] * 3 + [(0, 0.0)] * 9
    got = ml.rf_metrics(spark.createDataFrame(rows, "machine_failure int, prediction double")).first()
    f1, f0 = 12 / (12 + 3 + 2), 18 / (18 + 3 + 2)
    want = ((8 * f1 + 12 * f0) / 20, 15 / 20, 6 / 9, 6 / 8, f1)
    assert tuple(got) == pytest.approx(want)


def test_weighted_f1_is_the_one_of_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = [(1, 1.0)] * 6 + [(1, 0.0)] * 2 + [(0, 1.0)] * 3 + [(0, 0.0)] * 9
    df = spark.createDataFrame(rows, "machine_failure int, prediction double")
    evaluator = MulticlassClassificationEvaluator(labelCol=ml.LABEL, metricName="f1")
    assert ml.rf_metrics(df).first().weighted_f1 == pytest.approx(evaluator.evaluate(df))


@pytest.mark.parametrize("limits", [ScaleLimits(), ScaleLimits(block_rows=3)])
def test_area_is_the_share_of_pairs_in_order(spark, limits):
    rng = np.random.default_rng(5)
    rows = [(int(y), float(s), float(s > 4)) for y, s in zip(rng.integers(0, 2, 60), rng.integers(0, 9, 60))]
    df = spark.createDataFrame(rows, "machine_failure int, s double, prediction double").repartition(5)
    bad, good = ([s for y, s, _ in rows if y == label] for label in (1, 0))
    pairs = [(a > b) + (a == b) / 2 for a in bad for b in good]
    got = ml.evaluate(df, F.col("s"), limits).first()
    assert got.area_under_roc == pytest.approx(np.mean(pairs))
    assert tuple(got)[:5] == pytest.approx(tuple(ml.rf_metrics(df).first()))
    one_kind = df.where("machine_failure = 1")
    assert ml.evaluate(one_kind, F.col("s"), limits).first().area_under_roc is None
    nothing = ml.evaluate(df.limit(0), F.col("s"), limits).first()
    assert nothing.area_under_roc is None and nothing.accuracy == 0


def test_forest_learns_a_visible_rule(spark, readings, tmp_path):
    rows = readings.withColumn("machine_failure", (F.col("tool_wear") > 150).cast("int"))
    path = str(tmp_path / "model")
    model, metrics = jobs.run_training(rows, F.col("event_id"), path, ForestParams(trees=5))
    got = metrics.first()
    assert got.f1 > 0.95 and got.weighted_f1 > 0.95 and got.area_under_roc > 0.95
    loaded = ml.rf_predict(ml.load_model(path), rows).select("prediction").collect()
    assert loaded == ml.rf_predict(model, rows).select("prediction").collect()
    assert jobs.run_training(rows.limit(99), F.col("event_id")) is None


SMALL = IsolationParams(trees=25, sample_size=64)


@pytest.fixture(scope="module")
def forest(readings):
    return iforest.iforest_fit(readings, "event_id", SMALL)


def test_trees_are_well_formed(spark, readings, forest):
    nodes = forest.toPandas()
    assert nodes["tree_id"].nunique() == 25 and len(nodes) <= 25 * (2 * 64 - 1)
    for _, tree in nodes.groupby("tree_id"):
        leaves = tree[tree["feature"] < 0]
        assert leaves["size"].sum() == 64 and tree["depth"].max() <= 6
    per_tree = iforest.tree_samples(readings, "event_id", SMALL).groupBy("tree_id").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("d")
    )
    assert per_tree.where("n <> 64 OR d <> 64").count() == 0


def test_forest_does_not_depend_on_partitioning(spark, readings, forest):
    again = iforest.iforest_fit(readings.repartition(5), "event_id", SMALL)
    assert again.exceptAll(forest).count() == 0 and again.count() == forest.count()


def test_outliers_and_contamination(spark, readings, forest):
    scored = iforest.iforest_score(readings, forest, SMALL).persist()
    low, high = scored.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < low < high < 1 and scored.count() == readings.count()
    cut_off = iforest.iforest_threshold(scored, SMALL)
    flagged = iforest.iforest_flag(scored, cut_off).where("prediction = -1").count()
    assert flagged / scored.count() == pytest.approx(0.05, abs=0.01)
    # A reading far outside is more of an outlier than any reading in the data.
    odd = readings.limit(1).withColumn("torque", F.lit(5000.0)).withColumn(
        "rotational_speed", F.lit(99999.0)
    ).withColumn("tool_wear", F.lit(9999))
    assert iforest.iforest_score(odd, forest, SMALL).first().anomaly_score > cut_off


def test_scores_against_a_walk_through_the_trees(spark, readings, forest):
    nodes = {(n.tree_id, n.node_id): n for n in forest.collect()}
    rows = readings.orderBy("event_id").limit(20)
    got = [r.anomaly_score for r in iforest.iforest_score(rows, forest, SMALL).orderBy("event_id").collect()]
    for x, score in zip(matrix(rows.orderBy("event_id")), got):
        lengths = []
        for tree in range(25):
            node = nodes[tree, 1]
            while node.feature >= 0:
                node = nodes[tree, node.left_id if x[node.feature] <= node.split else node.right_id]
            lengths.append(node.depth + iforest.path_normaliser(node.size))
        assert score == pytest.approx(2 ** (-np.mean(lengths) / iforest.path_normaliser(64)))


def test_path_normaliser():
    assert [iforest.path_normaliser(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert iforest.path_normaliser(256) == pytest.approx(10.244770920119117)


def test_edge_model_survives_saving_and_routes_every_reading(spark, readings, tmp_path):
    path, small = str(tmp_path / "edge"), SMALL
    model = jobs.train_edge_model(readings, "event_id", path, small)
    loaded = jobs.load_edge_model(spark, path)
    assert loaded.threshold == model.threshold
    first = model.judge(readings, small).select("event_id", "prediction")
    assert first.exceptAll(loaded.judge(readings, small).select("event_id", "prediction")).count() == 0
    run = jobs.run_edge(readings, loaded, ["event_time", "event_id"])
    assert run.routed.count() == readings.count()
    assert run.routed.where("NOT to_cloud AND prediction = -1").count() <= first.where("prediction = -1").count()


def test_forest_of_no_rows(spark, readings):
    none = readings.limit(0)
    forest = iforest.iforest_fit(none, "event_id", SMALL)
    assert forest.collect() == []
    scored = iforest.iforest_score(readings, forest, SMALL)
    assert {r.anomaly_score for r in scored.select("anomaly_score").distinct().collect()} == {0.5}
    assert iforest.iforest_threshold(iforest.iforest_score(none, forest, SMALL), SMALL) == 1.0


def test_every_tree_gets_its_rows_when_the_first_bound_is_too_low(spark, readings):
    few = readings.orderBy("event_id").limit(300)
    params = IsolationParams(trees=40, sample_size=50)
    counts = iforest.tree_samples(few, "event_id", params).groupBy("tree_id").count().collect()
    assert len(counts) == 40 and {r["count"] for r in counts} == {50}


def test_sketches_of_batches_give_the_forest_of_all_rows(spark, readings, forest, tmp_path):
    start = jobs.EdgeModel(forest, 0.5)
    learner = jobs.EdgeLearner(str(tmp_path / "edge"), "event_id", SMALL)
    parts = [readings.where(F.col("event_id") % 3 == n) for n in range(3)]
    assert learner.model(readings, 0, start) is start
    for number in (0, 1, 1, 2):  # the second batch runs twice
        learner.learn(parts[number], number)
    learned = learner.model(readings, 3, start)
    assert learned.forest.exceptAll(forest).count() == 0 == forest.exceptAll(learned.forest).count()
    early = learner.model(readings, 2, start).forest
    some = iforest.iforest_fit(parts[0].unionByName(parts[1]), "event_id", SMALL)
    assert early.exceptAll(some).count() == 0 == some.exceptAll(early).count()
    share = learned.judge(readings, SMALL).where("prediction = -1").count() / readings.count()
    assert share == pytest.approx(0.05, abs=0.02)


def test_sample_rows_are_those_with_the_smallest_places(spark, readings):
    """Against a sort of all rows, with repeated keys among them."""
    import hashlib

    rows = readings.unionByName(readings.where("event_id % 50 = 0"))
    got = iforest.forest_sketch(rows.repartition(7), "event_id", SMALL).select("tree_id", "place", "event_id")
    found = sorted(map(tuple, got.collect()))
    ids = [r.event_id for r in rows.select("event_id").collect()]
    words = {x: hashlib.md5(f"{x}:forest-{SMALL.seed}".encode()).hexdigest() for x in ids}
    want = []
    for tree in range(SMALL.trees):
        places = [
            ((int(words[x][:8], 16) + tree * (2 * int(words[x][8:16], 16) + 1)) % 2**32, x) for x in ids
        ]
        want += [(tree, place, x) for place, x in sorted(places)[: SMALL.sample_size]]
    assert found == sorted(want)


def _training_rows(spark, n):
    rows = [(float(i % 11), float(i % 13), 1000.0 + i, float(i % 7), i % 250, int(i % 250 > 200)) for i in range(n)]
    columns = "air_temp double, process_temp double, rotational_speed double, torque double, tool_wear int, machine_failure int"
    return spark.createDataFrame(rows, columns).coalesce(1)


def _fitted_on(monkeypatch, train, limits):
    """Rows per partition of what the forest is fitted on, and its predictions."""
    sizes, fit = [], ml.Pipeline.fit

    def watched(self, rows, *args):
        sizes.extend(r[1] for r in rows.groupBy(F.spark_partition_id()).count().collect())
        return fit(self, rows, *args)

    monkeypatch.setattr(ml.Pipeline, "fit", watched)
    model = ml.rf_train(train, ForestParams(trees=5), limits)
    return sizes, [r.prediction for r in ml.rf_predict(model, train).select("prediction").collect()]


def test_no_task_of_the_forest_holds_many_rows(spark, monkeypatch):
    """One task read a whole partition of the cached training rows, thirty times its share of the file."""
    sizes, found = _fitted_on(monkeypatch, _training_rows(spark, 1000), ScaleLimits(task_rows=100))
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) <= 120
    assert sum(p == (i % 250 > 200) for i, p in enumerate(found)) > 950


def test_small_partitions_stay_as_they_are(spark, monkeypatch):
    sizes, _ = _fitted_on(monkeypatch, _training_rows(spark, 300), ScaleLimits())
    assert sizes == [300]


def test_saved_forest_of_dealt_rows_predicts_the_same(spark, tmp_path):
    train, path = _training_rows(spark, 400), str(tmp_path / "model")
    model = ml.rf_train(train, ForestParams(trees=5), ScaleLimits(task_rows=50))
    ml.save_model(model, path)
    both = [ml.rf_predict(m, train).select("prediction").collect() for m in (model, ml.load_model(path))]
    assert both[0] == both[1] and {r.prediction for r in both[0]} == {0.0, 1.0}
