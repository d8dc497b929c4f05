"""Failure prediction and reconstruction error on the five sensor features."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.expressions import unit_draw
from fleetpulse.operators.distribute import number_rows, running_total
from fleetpulse.operators.ingest import drop_missing
from fleetpulse.params import ForestParams, ScaleLimits
from fleetpulse.schema import FEATURES
from fleetpulse.session import write_once

LABEL = "machine_failure"
_CODE_SCHEMA = (
    "features array<string>, means array<double>, ranges array<double>, "
    "components array<array<double>>"
)


def feature_assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip")


def rf_features(df: DataFrame) -> DataFrame:
    """Feature vector per row. Rows with a missing feature are skipped."""
    return feature_assembler().transform(df)


def rf_split(df: DataFrame, key: Column, params: ForestParams = ForestParams()):
    """(train, test) by row key: the same split however the rows are partitioned."""
    chosen = unit_draw(key, f"split-{params.seed}") < params.train_share
    return df.where(chosen), df.where(~chosen)


def dealt_evenly(rows: DataFrame, limits: ScaleLimits = ScaleLimits()) -> DataFrame:
    """The rows in partitions of about ``task_rows``, where one now has more than that."""
    sizes = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"))
    total, largest = sizes.agg(F.sum("rows"), F.max("rows")).first()
    if (largest or 0) <= limits.task_rows:
        return rows
    return rows.repartition(-(-total // limits.task_rows))


def rf_train(
    train: DataFrame, params: ForestParams = ForestParams(), limits: ScaleLimits = ScaleLimits()
) -> PipelineModel:
    """Random forest on the labelled rows.

    Spark ML keeps, for every row, its features and how often each tree draws it: some thirty times the row's
    share of a file, read whole by one task in each level. So no partition may hold many rows.
    """
    forest = RandomForestClassifier(
        labelCol=LABEL,
        featuresCol="features",
        numTrees=params.trees,
        maxDepth=params.depth,
        seed=params.seed,
    )
    rows = dealt_evenly(train.select(*FEATURES, LABEL), limits)
    return Pipeline(stages=[feature_assembler(), forest]).fit(rows)


def rf_predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def rf_metrics(predictions: DataFrame) -> DataFrame:
    """Weighted F1 plus accuracy and the figures of the failure class. One row.

    All of it follows from the counts per label and prediction, a handful of rows whatever the
    size of the input.
    """
    return _figures(_tallies(predictions, F.lit(0.0)))


def _tallies(rows: DataFrame, score: Column) -> DataFrame:
    """Counts of all rows, failures and others, by score and prediction."""
    label = F.col(LABEL).cast("double")
    return rows.groupBy(score.alias("score"), "prediction").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(label == 1).alias("failures"),
        F.count_if(label == 0).alias("others"),
    )


def _figures(tallies: DataFrame) -> DataFrame:
    def total(column: str, predicted: int | None = None) -> Column:
        value = F.col(column) if predicted is None else F.when(F.col("prediction") == predicted, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0)).cast("double")

    hits = tallies.agg(
        total("rows").alias("n"),
        total("failures", 1).alias("tp"),
        total("others", 1).alias("fp"),
        total("failures", 0).alias("fn"),
        total("others", 0).alias("tn"),
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    f1_failure = ratio(2 * tp, 2 * tp + fp + fn)
    f1_healthy = ratio(2 * tn, 2 * tn + fp + fn)
    return hits.select(
        ratio((tp + fn) * f1_failure + (tn + fp) * f1_healthy, n).alias("weighted_f1"),
        ratio(tp + tn, n).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        f1_failure.alias("f1"),
    )


def roc_area(tallies: DataFrame, limits: ScaleLimits = ScaleLimits()) -> DataFrame:
    """One row, ``area_under_roc``: how often a failure scores above another row, exactly.

    Equal scores count half; a missing score is below all others. Null unless there are both
    kinds. ``tallies`` counts ``failures`` and ``others`` by ``score``; the distinct scores are
    numbered and summed over blocks, so no task sorts all of them.
    """
    counts = (F.sum(c).alias(c) for c in ("failures", "others"))
    by_score = write_once(tallies.groupBy("score").agg(*counts), "scores")
    placed = number_rows(by_score, [], ["score"], "place", limits)
    ranked = running_total(placed, [], "place", "others", "up_to", limits)
    above = F.sum(F.col("failures") * (F.col("up_to") - F.col("others") / 2))
    pairs = F.sum("failures").cast("double") * F.sum("others")
    return ranked.agg(F.try_divide(above, pairs).alias("area_under_roc"))


def evaluate(rows: DataFrame, score: Column, limits: ScaleLimits = ScaleLimits()) -> DataFrame:
    """``rf_metrics`` and ``roc_area`` of rows with a label, a ``prediction`` and a score.

    The rows are read once; both follow from their counts by score and prediction.
    """
    tallies = write_once(_tallies(rows, score), "tallies")
    return _figures(tallies).withColumn("area_under_roc", roc_area(tallies, limits).scalar())


def rf_evaluate(predictions: DataFrame) -> DataFrame:
    """``evaluate`` of a forest's predictions, by its score of the failure class."""
    return evaluate(predictions, vector_to_array("rawPrediction")[1])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_ranges(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """One row with minimum and range per feature; a constant feature has range 1."""
    bounds = df.agg(
        *[F.min(c).cast("double").alias(f"{c}_min") for c in features],
        *[F.max(c).cast("double").alias(f"{c}_max") for c in features],
    )
    spans = {c: F.col(f"{c}_max") - F.col(f"{c}_min") for c in features}
    return bounds.select(
        *[F.col(f"{c}_min") for c in features],
        *[F.when(s == 0, F.lit(1.0)).otherwise(s).alias(f"{c}_range") for c, s in spans.items()],
    )


def feature_minmax(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Features scaled to [0, 1] by their range. A constant feature becomes 0."""
    found = feature_ranges(df, features)
    # One row of two numbers per feature, taken as a scalar subquery: nothing runs before the result.
    ranges = found.select(F.struct(*found.columns).alias("ranges")).scalar()
    return df.withColumns(
        {c: (F.col(c) - ranges[f"{c}_min"]) / ranges[f"{c}_range"] for c in features}
    )


@dataclass(frozen=True)
class LinearCode:
    """Main components of the scaled features: what a linear bottleneck of size ``k`` keeps."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    ranges: tuple[float, ...]
    components: tuple[tuple[float, ...], ...]


MOMENTS = (
    "n bigint, newest double, means array<double>, lows array<double>, highs array<double>, "
    "products array<array<double>>"
)


@dataclass(frozen=True)
class Moments:
    """What a linear code is fitted from: count, means, extremes and centred products of features.

    The moments of two sets of rows merge into those of their union, so a model over all rows so
    far needs no second look at them.
    """

    n: int
    newest: float | None  # time of the newest row, where one was asked for
    means: np.ndarray
    lows: np.ndarray
    highs: np.ndarray
    products: np.ndarray

    def merge(self, other: "Moments") -> "Moments":
        n, shift = self.n + other.n, other.means - self.means
        times = [t for t in (self.newest, other.newest) if t is not None]
        return Moments(
            n,
            max(times, default=None),
            self.means + shift * (other.n / n),
            np.minimum(self.lows, other.lows),
            np.maximum(self.highs, other.highs),
            self.products + other.products + np.outer(shift, shift) * (self.n * other.n / n),
        )

    def frame(self, spark) -> DataFrame:
        """One row, as ``read_moments`` reads it."""
        lists = (x.tolist() for x in (self.means, self.lows, self.highs, self.products))
        return spark.createDataFrame([(self.n, self.newest, *lists)], MOMENTS)


def moments(df: DataFrame, features: list[str] = FEATURES, at: Column | None = None) -> DataFrame:
    """The moments of the complete rows as one row, in a single pass. ``at`` aggregates their time."""
    columns = [F.col(c).cast("double") for c in features]
    n, size = F.count(F.lit(1)), range(len(features))
    products = [
        F.array(*[n * F.covar_pop(columns[min(i, j)], columns[max(i, j)]) for j in size]) for i in size
    ]
    return drop_missing(df).agg(
        n.alias("n"),
        (F.lit(None).cast("double") if at is None else at).alias("newest"),
        F.array(*map(F.avg, columns)).alias("means"),
        F.array(*map(F.min, columns)).alias("lows"),
        F.array(*map(F.max, columns)).alias("highs"),
        F.array(*products).alias("products"),
    )


def read_moments(row: DataFrame) -> Moments | None:
    """The moments in a one-row table; None without complete rows."""
    found = row.select("n", "newest", "means", "lows", "highs", "products").first()
    if found is None or found["n"] == 0:
        return None
    return Moments(found["n"], found["newest"], *(np.array(x, float) for x in found[2:]))


def merge_moments(held: Moments | None, more: Moments | None) -> Moments | None:
    return held.merge(more) if held and more else held or more


def code_of(found: Moments, k: int = 4, features: list[str] = FEATURES) -> tuple[LinearCode, float]:
    """The code of the rows that the moments are of, and their mean reconstruction error.

    The error of rebuilding a row, over all rows, is what the components left out vary by.
    """
    spans = found.highs - found.lows
    ranges = np.where(spans != 0, spans, 1.0)
    values, vectors = np.linalg.eigh(found.products / found.n / np.outer(ranges, ranges))
    kept = vectors[:, ::-1][:, :k].T  # eigenvalues are in ascending order
    # Rounding can leave a tiny negative value.
    loss = float(np.abs(values[: max(len(features) - k, 0)]).sum()) / len(features)
    code = LinearCode(
        tuple(features),
        tuple(found.means.tolist()),
        tuple(ranges.tolist()),
        tuple(map(tuple, kept.tolist())),
    )
    return code, loss


def fit_linear_code(
    df: DataFrame, k: int = 4, features: list[str] = FEATURES
) -> LinearCode | None:
    """Fit in a single pass over the rows; only their moments reach the driver.

    None without complete rows.
    """
    found = read_moments(moments(df, features))
    return None if found is None else code_of(found, k, features)[0]


def save_code(spark, code: LinearCode, path: str) -> None:
    """One row: features, means, ranges and components."""
    row = (list(code.features), list(code.means), list(code.ranges), [list(c) for c in code.components])
    spark.createDataFrame([row], _CODE_SCHEMA).write.mode("overwrite").parquet(path)


def load_code(spark, path: str) -> LinearCode:
    row = spark.read.schema(_CODE_SCHEMA).parquet(path).first()
    return LinearCode(*map(tuple, row[:3]), tuple(map(tuple, row[3])))


def apply_linear_code(df: DataFrame, code: LinearCode) -> DataFrame:
    """Add ``recon_error``: the squared error per feature of rebuilding the scaled row.

    An arithmetic expression over the row, so it needs neither vectors nor Python. A row with a
    missing feature has no error.
    """
    centred = [
        (F.col(c) - F.lit(mean)) / F.lit(span)
        for c, mean, span in zip(code.features, code.means, code.ranges)
    ]

    def total(terms):
        return reduce(lambda a, b: a + b, terms)

    left = total([c * c for c in centred])
    for component in code.components:
        projection = total([c * F.lit(weight) for c, weight in zip(centred, component)])
        left = left - projection * projection
    # Rounding can leave a tiny negative remainder. ``greatest`` would skip a missing value.
    error = F.when(left < 0, F.lit(0.0)).otherwise(left) / F.lit(float(len(code.features)))
    return df.withColumn("recon_error", error)


def recon_error(
    df: DataFrame, k: int = 4, features: list[str] = FEATURES, keep: list[str] | None = None
) -> DataFrame:
    """Reconstruction error of every complete row, the code fitted on the same rows.

    A linear stand-in for an autoencoder with a bottleneck of ``k``.
    """
    rows = drop_missing(df)
    code = fit_linear_code(rows, k, features)
    if code is None:
        rows = rows.withColumn("recon_error", F.lit(None).cast("double"))
    else:
        rows = apply_linear_code(rows, code)
    return rows.select(*(df.columns if keep is None else keep), "recon_error")
