"""Token ids in files: canonical length-limited Huffman codes in independent blocks.

Code lengths come from the counts of all ids by package-merge and are at most ``LIMIT`` bits; the
codes follow from the lengths alone. A file holds blocks of whole documents. A block lists its
documents and their lengths, its bits, and the bit offset of every ``STRIDE``-th id: a reader can
start at any of these, and decodes all stretches of a block side by side with one table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import Batches, as_field, fields, map_partition
from fleetpulse.session import write_once

LIMIT = 16  # bits of the longest code, and of the decoding table's index
STRIDE = 256  # ids between two bit-offset checkpoints
BLOCK_IDS = 1 << 19  # ids of a block, unless one document has more


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each id's code, 0 for ids that do not occur: optimal under the limit.

    Package-merge: in each of ``limit`` rounds the items, and the pairs of the round before, are
    merged by weight; an id's code has as many bits as rounds in which it is among the chosen.
    """
    used = np.flatnonzero(counts)
    n = len(used)
    lengths = np.zeros(len(counts), np.int64)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    rounds, merged = [], weights
    is_item = np.ones(n, bool)
    rounds.append(is_item)
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((weights, pairs))
        place = np.argsort(both, kind="stable")
        merged = both[place]
        rounds.append(place < n)
    take, bits = 2 * n - 2, np.zeros(n, np.int64)
    for is_item in reversed(rounds):
        items = int(is_item[:take].sum())
        bits[:items] += 1
        take = 2 * (take - items)
    lengths[order] = bits
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.int64)
    code, bits = 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[lengths[order] > 0].tolist():
        code <<= int(lengths[i]) - bits
        bits = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """By the next ``limit`` bits: the id whose code they begin with, and its length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = (1 << (limit - lengths[order])).astype(np.int64)
    ids = np.zeros(1 << limit, np.uint32)
    bits = np.ones(1 << limit, np.uint8)
    total = int(spans.sum())
    ids[:total] = np.repeat(order, spans)
    bits[:total] = np.repeat(lengths[order], spans)
    return ids, bits


def encode(
    ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, stride: int = STRIDE
) -> tuple[bytes, np.ndarray]:
    """The bits of the ids, first bit highest, and the bit offset of every ``stride``-th id."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = ends - sizes
    # A code of up to 16 bits touches three bytes; bits of different codes never overlap.
    spread = codes[ids] << (24 - sizes - (at & 7))
    first, n_bytes = at >> 3, (total + 7) // 8
    out = np.zeros(n_bytes + 3, np.int64)
    for k, shift in enumerate((16, 8, 0)):
        part = np.bincount(first, weights=(spread >> shift) & 255, minlength=n_bytes + 3)
        out[k:] += part[: len(out) - k].astype(np.int64)
    return out[:n_bytes].astype(np.uint8).tobytes(), at[::stride]


def decode(
    bits: bytes, marks: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray]
) -> np.ndarray:
    """The ids of all stretches, in order. A stretch begins at bit ``marks`` and has ``sizes`` ids.

    One step decodes the next id of every stretch that has one, by a look at 16 bits.
    """
    ids, lengths = table
    raw = np.frombuffer(bits + bytes(4), np.uint8).astype(np.uint32)
    words = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]  # 32 bits from each byte on
    order = np.argsort(-sizes, kind="stable")
    at, most = marks[order].astype(np.int64), int(sizes.max(initial=0))
    going = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(most), "right")
    out = np.zeros((most, len(sizes)), np.uint32)
    for step, lanes in enumerate(going.tolist()):
        here = at[:lanes]
        peek = (words[here >> 3] >> (16 - (here & 7)).astype(np.uint32)) & 0xFFFF
        out[step, :lanes] = ids[peek]
        here += lengths[peek]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return out.T[back][np.arange(most) < sizes[:, None]]


def count_ids(tokens: DataFrame, width: int, vocabulary: int) -> np.ndarray:
    """Occurrences of each id over all rows; summed by task, at most a vocabulary to the driver."""

    def run(batches: Batches) -> Iterator[dict]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                ids = b"".join(batch.column(0).slice(at, 1000).to_pylist())
                total += np.bincount(np.frombuffer(ids, f"<u{width}"), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield {"id": used, "n": total[used]}

    counted = map_partition(tokens.select("ids"), run, fields("id int", "n bigint"))
    counts = np.zeros(vocabulary, np.int64)
    for row in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


def write_files(tokens: DataFrame, width: int, vocabulary: int, path: str) -> None:
    """Write the ids of all rows (_id, ids, n) in ascending order of _id.

    ``<path>/codes`` has the length of each id's code. ``<path>/blocks`` has one file per range of
    ids; a file's blocks are numbered in order. Rows with the same _id are ordered by their ids;
    null ids come first. A row without ids is kept with size 0, and an empty table gives no
    blocks.
    """
    spark = tokens.sparkSession
    lengths = code_lengths(count_ids(tokens, width, vocabulary))
    used = np.flatnonzero(lengths)
    table = spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, bits int")
    table.coalesce(1).write.parquet(f"{path}/codes")
    shared = spark.sparkContext.broadcast((lengths, canonical_codes(lengths)))

    def block_rows(batches: Batches) -> Iterator[dict]:
        size, code = shared.value
        held: list[tuple] = []
        waiting, block, start = 0, 0, 0

        def close() -> dict:
            keys, counts, ids = zip(*held)
            bits, marks = encode(np.frombuffer(b"".join(ids), f"<u{width}"), size, code)
            return {
                "block": [block], "start": [start], "n_ids": [waiting], "bits": [bits],
                "marks": [marks], "doc_ids": [list(keys)], "doc_sizes": [counts],
            }

        for batch in batches:
            for key, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if held and waiting + n > BLOCK_IDS:
                    yield close()
                    held, waiting, block, start = [], 0, block + 1, start + waiting
                held.append((key, n, ids))
                waiting += n
        if held:
            yield close()

    key = as_field(tokens, "_id", "_id")
    keyed = tokens.select("_id", "n", "ids", F.crc32("ids").alias("tie"))
    placed = keyed.repartitionByRange("_id", "tie").sortWithinPartitions("_id", "tie", "ids")
    blocks = map_partition(
        placed.select("_id", "n", "ids"),
        block_rows,
        fields(
            "block bigint", "start bigint", "n_ids bigint", "bits binary", "marks array<bigint>",
            T.StructField("doc_ids", T.ArrayType(key.dataType)), "doc_sizes array<bigint>",
        ),
    )
    numbered = blocks.withColumn("file", F.spark_partition_id())
    numbered.write.option("compression", "none").parquet(f"{path}/blocks")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(_id, start, n, ids): all documents of a folder, ids as four little-endian bytes each.

    ``start`` counts the ids of all documents before this one. Blocks are decoded independently.
    """
    codes = spark.read.parquet(f"{path}/codes").collect()  # a vocabulary at most
    lengths = np.zeros(max((r["id"] for r in codes), default=0) + 1, np.int64)
    for r in codes:
        lengths[r["id"]] = r["bits"]
    shared = spark.sparkContext.broadcast(decoding_table(lengths))
    blocks = spark.read.parquet(f"{path}/blocks")

    # One row per file: what the files before it hold. Stored, so that its size is known to the join.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("file").agg(F.sum("n_ids").alias("total"))
    offsets = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    placed = blocks.join(write_once(offsets, "file_offsets"), "file")

    def rows(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            for start, bits, marks, keys, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.array(sizes, np.int64)
                flat = decode(bits, np.array(marks, np.int64), _stretches(int(counts.sum())), shared.value)
                ends = np.cumsum(counts)
                for at in range(0, len(keys), 1000):
                    some = slice(at, at + 1000)
                    spans = zip((ends - counts)[some].tolist(), ends[some].tolist())
                    yield {
                        "_id": keys[some], "start": start + (ends - counts)[some], "n": counts[some],
                        "ids": [flat[a:b].astype("<u4").tobytes() for a, b in spans],
                    }

    key = T.StructField("_id", blocks.schema["doc_ids"].dataType.elementType)
    return map_partition(
        placed.select(F.col("start") + F.col("before"), "bits", "marks", "doc_ids", "doc_sizes"),
        rows,
        fields(key, "start bigint", "n bigint", "ids binary"),
    )


def _stretches(n: int) -> np.ndarray:
    """Ids between two checkpoints: full strides and what is left."""
    sizes = np.full(-(-n // STRIDE), STRIDE, np.int64)
    if len(sizes):
        sizes[-1] = n - (len(sizes) - 1) * STRIDE
    return sizes
