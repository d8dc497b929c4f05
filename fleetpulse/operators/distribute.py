"""Ordering and joining that hold when one key carries a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.params import ScaleLimits
from fleetpulse.session import shuffle_partitions, write_once

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def measured_bytes(df: DataFrame) -> int:
    """Size of a join side in memory, measured over all of its rows."""
    variable = []
    for field in df.schema.fields:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            variable.append(F.octet_length(column))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            variable.append(F.octet_length(F.array_join(column, ",")) + F.size(column) * 16)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            variable.append(F.octet_length(F.to_json(F.struct(column))) * 2)
    extra = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in variable], F.lit(0))
    rows, more = df.agg(F.count(F.lit(1)), F.sum(extra.cast("bigint"))).first()
    return rows * 16 * len(df.columns) + (more or 0)


def fits_broadcast(df: DataFrame, limits: ScaleLimits = ScaleLimits()) -> bool:
    return measured_bytes(df) <= limits.broadcast_bytes


def hot_keys(df: DataFrame, key: str, limits: ScaleLimits = ScaleLimits()) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and over how many parts their rows are dealt."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / limits.hot_rows).alias("_parts")
    return counts.where(F.col("_n") > limits.hot_rows).select(key, parts)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    limits: ScaleLimits = ScaleLimits(),
    fits: bool | None = None,
) -> DataFrame:
    """Join a large side to a lookup with one row per key.

    The lookup is evaluated for its size first, so it should be a stored or persisted one.
    ``fits`` skips that when the caller has measured it already.

    * A lookup whose measured size is below the bound is broadcast: the large side stays put.
    * Beyond the bound both sides are shuffled on the key and a part number. Rows of a hot key
      are dealt over parts and its lookup row is repeated for each, and rows without a key are
      spread, so no task receives a whole hot group.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    if fits_broadcast(right, limits) if fits is None else fits:
        return left.join(F.broadcast(right), key, how)
    return _split_join(left, right, key, how, write_once(hot_keys(left, key, limits), "hot_keys"))


def _split_join(left: DataFrame, right: DataFrame, key: str, how: str, hot: DataFrame) -> DataFrame:
    spread = F.lit(shuffle_partitions(left.sparkSession))
    parts = F.when(F.col(key).isNull(), spread).otherwise(F.coalesce("_parts", F.lit(1)))
    dealt = left.join(hot, key, "left").withColumn(
        "_part", F.pmod(F.monotonically_increasing_id(), parts)
    )
    every = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)).cast("bigint") - 1)
    repeated = right.join(hot, key, "left").withColumn("_part", F.explode(every)).drop("_parts")
    return dealt.drop("_parts").join(repeated, [key, "_part"], how).drop("_part")


def number_rows(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    name: str = "row_no",
    limits: ScaleLimits = ScaleLimits(),
) -> DataFrame:
    """Consecutive numbers from 1 per group in the given order, for groups of any size.

    ``row_number`` would put a whole group into one task. Here the rows are range-partitioned
    on group and order, numbered inside each partition, and shifted by the number of rows of
    the same group in earlier partitions. ``order_cols`` must be unique within a group. The
    ranges are sampled, so the numbered rows are written once before they are read twice.
    Adaptive execution may merge neighbouring ranges; their order stays.
    """
    cols = [*group_cols, *order_cols]
    placed = write_once(
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_pos", _ROW_BITS))

    keys = [*group_cols, "_part"]
    spans = placed.groupBy(*keys).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy(*(group_cols or [F.lit(0)])).orderBy("_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    shifts = spans.select(
        *keys,
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    # One row per partition and group it touches: far below the row count of the input.
    if fits_broadcast(shifts, limits):
        shifts = F.broadcast(shifts)
    same = reduce(
        lambda a, b: a & b, [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    )
    kept = [F.col(f"p.{c}") for c in df.columns]
    return (
        placed.alias("p")
        .join(shifts.alias("s"), same)
        .select(*kept, (F.col("p._pos") + F.col("s._shift")).alias(name))
    )


def exact_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """One row with the smallest value whose rank reaches ``p``: the discrete quantile.

    Equal values are counted together first, so only the distinct ones are ordered, and no
    task holds them all.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    spread = write_once(
        counts.repartitionByRange(column)
        .withColumn("_part", F.spark_partition_id()),
        "quantile",
    )
    parts = spread.groupBy("_part").agg(F.sum("_n").alias("_rows"))
    # One row per partition. The windows run over these, not over the values.
    everything = Window.partitionBy(F.lit(0))
    through = everything.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    located = parts.select(
        "_part",
        (F.sum("_rows").over(through) - F.col("_rows")).alias("_before"),
        F.col("_rows"),
        F.greatest(
            F.ceil(F.sum("_rows").over(everything) * F.lit(p)), F.lit(1).cast("bigint")
        ).alias("_target"),
    ).where(
        (F.col("_before") < F.col("_target"))
        & (F.col("_target") <= F.col("_before") + F.col("_rows"))
    )
    # Only the one range partition that holds the target is left at this point.
    inside = Window.partitionBy("_part").orderBy(column)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        spread.join(F.broadcast(located.select("_part", "_before", "_target")), "_part")
        .withColumn("_through", F.col("_before") + F.sum("_n").over(inside))
        .where(F.col("_through") >= F.col("_target"))
        .agg(F.min(column).alias(column))
    )


def running_total(
    df: DataFrame,
    group_cols: list[str],
    position: str,
    value: str,
    name: str,
    limits: ScaleLimits = ScaleLimits(),
) -> DataFrame:
    """Running sum of ``value`` by a dense integer ``position`` inside each group.

    Two levels: totals per block of positions, then sums inside each block. A long group is
    spread over as many tasks as it has blocks.
    """
    blocked = df.withColumn("_block", F.floor(F.col(position) / F.lit(limits.block_rows)))
    keys = [*group_cols, "_block"]
    totals = blocked.groupBy(*keys).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*group_cols).orderBy("_block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*keys).orderBy(position)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.join(starts, keys)
        .withColumn(name, F.col("_start") + F.sum(value).over(inside))
        .drop("_block", "_start")
    )


def as_of(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    name: str,
    keys: list[str] | None = None,
    limits: ScaleLimits = ScaleLimits(),
) -> DataFrame:
    """Every left row with the newest right row that is not later, as a struct called ``name``.

    Rows of both sides are put in one order of time, by ranges, so neither one key nor one busy
    moment meets in a task, and no pair of rows is made that is not in the result. What is valid
    at the end of a range is carried over to the next. A left row without a time, or with none
    before it, gets null; right rows without a time are not used. Of right rows with the same time
    the one with the larger values counts. ``keys``, where given, must be equal on both sides.
    """
    keys = keys or []
    own, other = F.struct(*left.columns), F.struct(*right.columns)
    tagged = [
        left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.xxhash64(own).alias("_mix"), own.alias("_own")),
        right.where(F.col(right_time).isNotNull()).select(
            *keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.lit(0).cast("bigint").alias("_mix"), other.alias(name)
        ),
    ]
    order = ["_t", "_side", "_mix"]
    together = tagged[0].unionByName(tagged[1], allowMissingColumns=True)
    placed = write_once(
        together.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "as_of"
    )
    newest = F.max(F.when(F.col("_side") == 0, F.struct("_t", name)))
    inside = Window.partitionBy(*keys, "_part").orderBy("_t", "_side")
    known = newest.over(inside)  # up to the row, and those equal to it in time and side
    ends = placed.groupBy(*keys, "_part").agg(newest.alias("_end"))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and key in it.
    carried = ends.select(*keys, "_part", F.max("_end").over(earlier).alias("_carried"))
    if fits_broadcast(carried, limits):
        carried = F.broadcast(carried)
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_part"]])
    rows = placed.withColumn("_known", known).where("_side = 1").alias("l").join(carried.alias("c"), same)
    found = F.when(F.col("_t").isNotNull(), F.greatest("_known", "_carried")[name])
    return rows.select("l._own.*", found.alias(name))
