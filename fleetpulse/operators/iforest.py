"""Isolation forest: trees built in parallel from small samples, rows scored in batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.operators.distribute import exact_quantile
from fleetpulse.operators.ingest import drop_missing
from fleetpulse.params import IsolationParams
from fleetpulse.schema import FEATURES
from fleetpulse.session import cut, ship

# A node: its feature and split, its children, or for a leaf the rows that ended there.
FOREST_SCHEMA = (
    "tree_id int, node_id int, feature int, split double, left_id int, right_id int, "
    "depth int, size int"
)

# One batch of rows: a series per feature.
Batch = Tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]

EULER_GAMMA = 0.5772156649015329

PARTS = 64  # in which sketches of tasks are merged before those of a tree come together


def path_normaliser(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _draw(seed: int, tree: int, node: int, purpose: str) -> float:
    """A number in [0, 1) that depends only on where it is used."""
    digest = hashlib.md5(f"{seed}:{tree}:{node}:{purpose}".encode()).hexdigest()
    return int(digest[:8], 16) / 2**32


def _grow(rows: np.ndarray, seed: int, tree: int, max_depth: int) -> list[tuple]:
    """Nodes of one tree. The root is 1, the children of node ``i`` are ``2 * i`` and the next."""
    nodes, waiting = [], [(1, rows, 0)]
    while waiting:
        node, part, depth = waiting.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= max_depth or len(part) <= 1 or len(usable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth, len(part)))
            continue
        feature = int(usable[int(_draw(seed, tree, node, "feature") * len(usable))])
        spread = high[feature] - low[feature]
        split = float(low[feature] + _draw(seed, tree, node, "split") * spread)
        split = min(split, float(np.nextafter(high[feature], low[feature])))  # both sides get rows
        below = part[:, feature] <= split
        nodes.append((node, feature, split, 2 * node, 2 * node + 1, depth, len(part)))
        waiting.append((2 * node, part[below], depth + 1))
        waiting.append((2 * node + 1, part[~below], depth + 1))
    return nodes


def sketch_schema(df: DataFrame, key: str) -> T.StructType:
    """Columns of a sketch of ``df``: the tree, the row's place in it, the row's key and features."""
    fields = [T.StructField("tree_id", T.IntegerType()), T.StructField("place", T.LongType())]
    return T.StructType(fields + [T.StructField(c, df.schema[c].dataType) for c in (key, *FEATURES)])


def _lowest(rows: pd.DataFrame, key: str, size: int) -> pd.DataFrame:
    ordered = rows.sort_values(["tree_id", "place", key], kind="stable")
    return ordered[ordered.groupby("tree_id").cumcount() < size]


def forest_sketch(
    df: DataFrame, key: str, params: IsolationParams = IsolationParams()
) -> DataFrame:
    """Per tree the ``sample_size`` rows with the smallest places, as a sketch that can be merged.

    Two words of one MD5 hash of the key give a row its place in the first tree and its step from
    tree to tree, so places in different trees are independent in pairs. A task goes through its rows
    once and holds the lowest of each tree so far; a row beyond the bounds of all trees costs no more
    than the comparison. At most ``trees * sample_size`` rows leave a task.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(f"forest-{params.seed}")))
    words = [F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") for at in (1, 9)]
    rows = drop_missing(df).select(key, *FEATURES, words[0].alias("_u"), words[1].alias("_v"))
    schema, size = sketch_schema(rows, key), params.sample_size
    trees = np.arange(params.trees, dtype=np.uint32)

    def lowest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, bound = None, np.full(params.trees, 2**32 - 1, dtype=np.uint32)
        for batch in batches:
            start = batch.pop("_u").to_numpy().astype(np.uint32)
            step = (2 * batch.pop("_v").to_numpy() + 1).astype(np.uint32)
            found = [np.empty((3, 0), np.int64)]
            for tree in trees:
                place = start + tree * step  # modulo 2^32
                near = np.flatnonzero(place <= bound[tree])
                if len(near) > size:
                    near = near[place[near] <= np.partition(place[near], size - 1)[size - 1]]
                found.append(np.stack([np.full(len(near), tree, np.int64), place[near].astype(np.int64), near]))
            tree_id, place, at = np.concatenate(found, axis=1)
            if len(at):
                more = batch.iloc[at].assign(tree_id=tree_id.astype(np.int32), place=place)
                held = _lowest(more if held is None else pd.concat([held, more]), key, size)
                full = held.groupby("tree_id")["place"].agg(["size", "max"])
                full = full[full["size"] == size]
                bound[full.index.to_numpy()] = full["max"].to_numpy()
        if held is not None:
            yield held[schema.names]

    return merged_sketch(rows.mapInPandas(lowest, schema), key, params)


def merged_sketch(
    sketches: DataFrame, key: str, params: IsolationParams = IsolationParams()
) -> DataFrame:
    """The lowest rows of each tree among all rows of one sketch or the union of several.

    That of a union is the sketch of all rows behind it. Sketches of tasks are merged by parts first,
    so that no task receives those of all tasks; a row that comes twice, from a batch that ran again,
    is to be left out before.
    """
    order = "place", key
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    by_part = Window.partitionBy("tree_id", "_part").orderBy(*order)
    by_tree = Window.partitionBy("tree_id").orderBy(*order)
    first = sketches.withColumn("_part", part).withColumn("_rank", F.row_number().over(by_part))
    few = first.where(F.col("_rank") <= params.sample_size).drop("_part", "_rank")
    ranked = few.withColumn("_rank", F.row_number().over(by_tree))
    return ranked.where(F.col("_rank") <= params.sample_size).drop("_rank")


def tree_samples(
    df: DataFrame, key: str, params: IsolationParams = IsolationParams()
) -> DataFrame:
    """``min(sample_size, rows)`` rows per tree, drawn from all rows by the hash of row and tree."""
    return forest_sketch(df, key, params).drop("place")


def grow_forest(
    sketch: DataFrame, key: str, params: IsolationParams = IsolationParams()
) -> DataFrame:
    """The forest of a sketch as a table of nodes: at most ``trees * (2 * sample_size - 1)`` rows."""
    max_depth = int(np.ceil(np.log2(max(params.sample_size, 2))))
    seed = params.seed

    def build(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(group[0])
        rows = pdf.sort_values(key)[FEATURES].to_numpy(dtype=float)
        nodes = _grow(rows, seed, tree, max_depth)
        out = pd.DataFrame(
            nodes, columns=["node_id", "feature", "split", "left_id", "right_id", "depth", "size"]
        )
        out.insert(0, "tree_id", tree)
        return out

    ship(sketch.sparkSession)
    return cut(sketch.groupBy("tree_id").applyInPandas(build, FOREST_SCHEMA))


def iforest_fit(
    df: DataFrame, key: str, params: IsolationParams = IsolationParams()
) -> DataFrame:
    """The forest fitted on all rows, from one pass over them."""
    ship(df.sparkSession)
    return grow_forest(forest_sketch(df, key, params), key, params)


def _tables(forest: DataFrame, params: IsolationParams):
    """The node table as arrays per tree, and the sample size. Bounded by the parameters.

    A leaf leads to itself, so a row that has arrived stays where it is.
    """
    trees, sample = [], 0
    for _, nodes in forest.toPandas().groupby("tree_id"):
        nodes = nodes.sort_values("node_id")
        leaf = (nodes["feature"] < 0).to_numpy()
        ids, here = nodes["node_id"].to_numpy(), np.arange(len(nodes))
        trees.append(
            (
                np.where(leaf, 0, nodes["feature"]).astype(np.int64),
                nodes["split"].to_numpy(),
                np.where(leaf, here, np.searchsorted(ids, nodes["left_id"])),
                np.where(leaf, here, np.searchsorted(ids, nodes["right_id"])),
                (nodes["depth"] + nodes["size"].map(path_normaliser)).to_numpy(),
                int(nodes["depth"].max()),
            )
        )
        sample = int(nodes["size"].max())
    return trees, sample


def iforest_score(
    df: DataFrame, forest: DataFrame, params: IsolationParams = IsolationParams()
) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1): the shorter the mean path, the closer to 1.

    Scores are rounded to nine digits, so that equal rows have equal ones however the paths are
    summed up. A forest without trees, grown from no rows, scores 0.5.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(_tables(forest, params))

    @F.pandas_udf("double")
    def score(batches: Iterator[Batch]) -> Iterator[pd.Series]:
        trees, sample = shared.value
        expected = max(path_normaliser(sample), 1e-12)
        for columns in batches:
            rows = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            values, first = rows.ravel(), np.arange(len(rows)) * rows.shape[1]
            total = np.zeros(len(rows))
            for feature, split, left, right, length, depth in trees:
                node = np.zeros(len(rows), dtype=np.int64)
                for _ in range(depth):
                    below = values.take(first + feature.take(node)) <= split.take(node)
                    node = np.where(below, left.take(node), right.take(node))
                total += length.take(node)
            yield pd.Series(np.exp2(-total / len(trees) / expected) if trees else total + 0.5)

    return drop_missing(df).withColumn("anomaly_score", F.round(score(*FEATURES), 9))


def iforest_threshold(scored: DataFrame, params: IsolationParams = IsolationParams()) -> float:
    """Score above which the ``contamination`` share of the training rows lies: the exact quantile.

    1, which no score passes, if there are no rows.
    """
    found = exact_quantile(scored.select("anomaly_score"), "anomaly_score", 1.0 - params.contamination)
    cut_off = found.first()[0]
    return 1.0 if cut_off is None else cut_off


def iforest_flag(scored: DataFrame, threshold: float) -> DataFrame:
    """Add ``prediction``: -1 for an outlier, 1 otherwise."""
    return scored.withColumn(
        "prediction", F.when(F.col("anomaly_score") > threshold, F.lit(-1)).otherwise(F.lit(1))
    )
