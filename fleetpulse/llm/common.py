"""What the operators share: reading tables, Arrow batches in and out, intervals."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetpulse.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Batches = Iterator[pa.RecordBatch]


def map_partition(
    df: DataFrame, run: Callable[[Batches], Iterator[dict[str, Iterable]]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` for a function that yields columns by name instead of batches."""
    ship(df.sparkSession)
    arrow = to_arrow_schema(schema)

    def batches_of(batches: Batches) -> Batches:
        for columns in run(batches):
            yield to_batch(columns, arrow)

    return df.mapInArrow(batches_of, schema)


def map_batches(
    df: DataFrame,
    rows: Callable[[dict[str, pa.Array]], dict[str, Iterable]],
    schema: T.StructType,
    most: int = 1000,
) -> DataFrame:
    """Apply ``rows`` (columns in, columns out) to up to ``most`` rows of a partition at a time."""
    names = list(df.columns)

    def run(batches: Batches) -> Iterator[dict[str, Iterable]]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                yield rows({n: part.column(i) for i, n in enumerate(names)})

    return map_partition(df, run, schema)


def to_batch(columns: dict[str, Iterable], arrow: pa.Schema) -> pa.RecordBatch:
    """Columns by name as one record batch of the given schema."""
    arrays = []
    for field in arrow:
        values = columns[field.name]
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        if isinstance(values, pa.Array):
            arrays.append(values if values.type == field.type else values.cast(field.type))
        else:
            arrays.append(pa.array(values, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


_KINDS = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
}


def fields(*spec: str | T.StructField) -> T.StructType:
    """A schema from ``"name type"`` strings, ``type`` possibly ``array<type>``, or fields."""
    made = []
    for item in spec:
        if isinstance(item, str):
            name, kind = item.split()
            if kind.startswith("array<"):
                item = T.StructField(name, T.ArrayType(_KINDS[kind[6:-1]]))
            else:
                item = T.StructField(name, _KINDS[kind])
        made.append(item)
    return T.StructType(made)


def as_field(df: DataFrame, column: str, name: str) -> T.StructField:
    return T.StructField(name, df.schema[column].dataType)


def text_key(text: str = "text") -> Column:
    """128-bit key of a text: rows with the same text share it. A null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open spans, in order. Spans that touch become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(first)[1:] - 1, len(starts) - 1)
    return starts[first], ends[last]
