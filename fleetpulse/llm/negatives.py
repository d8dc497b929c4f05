"""Hard negatives by slot-decomposed selection.

The positives of an anchor ask for overlapping windows of scores: each from a share of the
positive's score to another. Their upper limits split the scores into disjoint slots. Every task
keeps the best few rows of each slot, the slots of all tasks are merged, and as slots follow each
other downwards, the answer to a window is the head of the list from its own slot on, cut at the
window's lower limit.

Anchors meet all rows in blocks: a bounded number of anchors is broadcast at a time, each task
multiplies blocks of its rows with them, and its results are stored before the next anchors go out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, fields, map_partition
from fleetpulse.operators.distribute import number_rows
from fleetpulse.session import write_once

ANCHOR_BYTES = 16 << 20  # vectors of the anchors that are broadcast at a time
TASK_ROWS = 250_000  # rows that a task compares with them, or fewer if that leaves cores idle
BLOCK = 2048  # rows, and anchors, multiplied at a time
MOST = 2**63 - 1


@dataclass(frozen=True)
class MiningParams:
    """Which rows are anchors, how many positives and negatives, and the window in percent."""

    anchor_every: int = 100
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: float = 256.0


def prepare(rows: DataFrame, params: MiningParams) -> DataFrame:
    """(row, id, label, v): rows that take part, numbered, with whole-number components.

    A row with a null label, vector or component, or a component that is not finite, is left out.
    Stored in parts of equal size, which later tasks read.
    """
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n // TASK_ROWS), min(cores, n // BLOCK))
    x = F.col("embedding")
    usable = F.col("label").isNotNull() & x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * params.scale).cast("double"))
    return write_once(
        rows.where(usable).repartition(parts).select(
            F.monotonically_increasing_id().alias("row"), F.col("vec_id").alias("id"), "label", scaled.alias("v")
        ),
        "vectors",
    )


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix. A shorter vector is filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; those beyond 64 bits are held at the bound."""
    bound = np.sqrt(2.0**53 / max(a.shape[1], 1))  # up to it every partial sum of doubles is exact
    large = [np.abs(m).max(axis=1, initial=0) > bound for m in (a, b)]
    small = [np.where(big[:, None], 0, m) for big, m in zip(large, (a, b))]
    out = (small[0] @ small[1].T).astype(np.int64)
    if not (large[0].any() or large[1].any()):
        return out
    whole = [[[int(x) for x in row] for row in m.tolist()] for m in (a, b)]
    for i, j in np.argwhere(large[0][:, None] | large[1]).tolist():
        out[i, j] = max(-MOST, min(MOST, sum(map(int.__mul__, whole[0][i], whole[1][j]))))
    return out


class Best:
    """The best ``k`` rows of each slot of each anchor among the rows seen so far."""

    def __init__(self, anchors: dict[str, np.ndarray], k: int, same_label: bool):
        self.of, self.k, self.same = anchors, k, same_label
        n, slots = anchors["limits"].shape
        self.floor = np.full((n, slots), -MOST, np.int64)  # the k-th best so far
        self.kept = {name: np.empty(0, np.int64) for name in ("anchor", "slot", "score", "null", "id", "row")}

    def add(self, v: np.ndarray, label: np.ndarray, ids: np.ndarray, null: np.ndarray, rows: np.ndarray) -> None:
        of = self.of
        for at in range(0, len(of["row"]), BLOCK):
            part = slice(at, at + BLOCK)
            s = scores(of["v"][part], v)
            allowed = (of["label"][part, None] == label) == self.same
            allowed &= (s >= of["least"][part, None]) & (s <= of["limits"][part, :1])
            if self.same:
                allowed &= of["row"][part, None] != rows
            a, r = np.nonzero(allowed)
            s = s[a, r]
            slot = (s[:, None] <= of["limits"][part][a]).sum(axis=1) - 1  # limits fall from slot to slot
            a += at
            better = s >= self.floor[a, slot]
            self._keep(a[better], slot[better], s[better], null[r[better]], ids[r[better]], rows[r[better]])

    def _keep(self, *new: np.ndarray) -> None:
        if not len(new[0]):
            return
        every = [np.concatenate((old, fresh)) for old, fresh in zip(self.kept.values(), new)]
        anchor, slot, score, null, ids, rows = every
        order = np.lexsort((rows, ids, null, -score, slot, anchor))
        group = anchor[order] * self.floor.shape[1] + slot[order]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        order, place = order[place < self.k], place[place < self.k]
        self.kept = {name: column[order] for name, column in zip(self.kept, every)}
        full = order[place == self.k - 1]
        self.floor[anchor[full], slot[full]] = score[full]


def _search(rows: DataFrame, anchors: DataFrame, blocks: int, width: int, k: int, same_label: bool) -> DataFrame:
    """(anchor, slot, score, id, row): the best rows of each slot of each anchor, per task.

    ``anchors`` has row, label, v, least (lowest score asked for), limits (falling) and block.
    """
    spark, found = rows.sparkSession, None
    for number in range(blocks):
        held = anchors.where(F.col("block") == number).orderBy("row").toArrow()
        if not held.num_rows:
            continue
        columns = {name: held.column(name).to_numpy() for name in ("row", "label", "least")}
        limits = held.column("limits").to_pylist()
        most = max(map(len, limits))
        # Slots that an anchor does not have lie below all scores asked for.
        columns["limits"] = np.array([x + [-MOST - 1] * (most - len(x)) for x in limits], np.int64)
        columns["v"] = _matrix(held.column("v"), width)
        sent = spark.sparkContext.broadcast(columns)

        def run(batches: Batches) -> Iterator[dict]:
            best = Best(sent.value, k, same_label)
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    row, ids, label, v = batch.slice(at, BLOCK).columns
                    null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                    best.add(_matrix(v, width), label.to_numpy(), ids, null, row.to_numpy())
            kept = best.kept
            if len(kept["anchor"]):
                ids = pa.array(kept["id"], mask=kept["null"] == 1)
                yield {**kept, "anchor": sent.value["row"][kept["anchor"]], "id": ids}

        schema = fields("anchor bigint", "slot int", "score bigint", "id bigint", "row bigint")
        made = write_once(map_partition(rows, run, schema), "slots")
        sent.destroy()
        found = made if found is None else found.unionByName(made)
    if found is None:
        return rows.sparkSession.createDataFrame([], "anchor bigint, slot int, score bigint, id bigint, row bigint")
    return found


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group, with ``place`` from 0. Each task sends ``k`` of a group."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < k)


def hard_negatives(rows: DataFrame, params: MiningParams = MiningParams()) -> DataFrame:
    """One row per anchor, positive and negative: ids, rank and both scores.

    ``rows`` has vec_id, embedding and label. Rows with a null label, vector or component, or a
    component that is not finite, take no part. Scores are inner products of components scaled
    and rounded down; a shorter vector counts as filled up with zeros, and a component or score
    beyond 64 bits is held at the bound. Ties go to the smaller id, a null id last. Repeated rows are rows of
    their own: a copy of an anchor is one of its positives. Anchors without positives, and
    positives without negatives in their window, have no rows; an empty table gives none.
    Other columns are not read.
    """
    prepared = prepare(rows, params)
    width = max(prepared.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    each = max(1, ANCHOR_BYTES // (8 * width))
    chosen = prepared.where(F.col("id") % params.anchor_every == 0)
    numbered = write_once(
        number_rows(chosen, [], ["row"], "number").withColumn("block", F.floor((F.col("number") - 1) / each)), "anchors"
    )
    blocks = numbered.agg(F.max("block")).first()[0]
    blocks = 0 if blocks is None else blocks + 1

    any_score = numbered.select("*", F.lit(-MOST).alias("least"), F.array(F.lit(MOST)).alias("limits"))
    near = _first(_search(prepared, any_score, blocks, width, params.positives, True), ["anchor"], params.positives)
    # The whole numbers between the two shares of the positive's score, in exact decimals.
    score = F.col("score").cast("decimal(38,0)")
    down = lambda share: F.floor(score * share / 100).cast("bigint")
    windows = near.select(
        "anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        (-F.floor(-score * params.low / 100)).cast("bigint").alias("low"), down(params.high).alias("high"),
    ).where("low <= high")
    windows = write_once(windows, "windows")

    limits = windows.groupBy("anchor").agg(
        F.min("low").alias("least"), F.sort_array(F.collect_set("high"), asc=False).alias("limits")
    )
    asking = write_once(numbered.join(limits, numbered["row"] == limits["anchor"]).drop("anchor"), "asking_anchors")
    found = _search(prepared, asking, blocks, width, params.negatives, False)
    best = _first(found, ["anchor", "slot"], params.negatives)
    # At most positives * negatives of them, slot after slot: in the order of falling scores.
    listed = best.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("slot", "place", "score", "id"))).alias("all")
    )
    joined = windows.join(listed, "anchor").join(
        asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "limits"), "anchor"
    )
    own = F.array_position("limits", F.col("high")) - 1
    tail = F.slice(F.filter("all", lambda x: x["slot"] >= own), 1, params.negatives)
    inside = F.filter(tail, lambda x: x["score"] >= F.col("low"))
    answered = joined.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "x"))
    return answered.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"),
        "positive_score", F.col("x.score").alias("negative_score"),
    )


def relabelled(rows: DataFrame) -> DataFrame:
    """The rows with the labels of every seventh id moved on by one, of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select("vec_id", "embedding", moved.alias("label"))
