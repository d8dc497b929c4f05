"""Fill-in-the-middle rows: texts cut in three and put together in another order.

A cut is a number of code points, a text is UTF-8 bytes. The byte at which a code point begins is
found in a set of all such bytes, held in containers of 64 KiB of text as in roaring bitmaps: a
sorted array where few code points begin, a bitmap where many do, runs where they follow each
other. Cumulative cardinalities say in which container the k-th member lies, and a select inside
that container says where. Both cuts of a text are asked for at once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import as_field, fields, map_batches

# Marks before the parts, and shares in percent.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90
SPM_BELOW = 20

CHUNK = 1 << 16  # bytes of text per container
_ARRAY_MOST = 4096  # members up to which a sorted array is smaller than a bitmap


# -- boundary sets ----------------------------------------------------------------------------


@dataclass(frozen=True)
class ArrayContainer:
    members: np.ndarray  # sorted, 16 bits each

    def select(self, k: int) -> int:
        return int(self.members[k])


@dataclass(frozen=True)
class RunContainer:
    firsts: np.ndarray
    ends: np.ndarray  # members up to and with each run

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.ends, k, "right"))
        before = int(self.ends[run - 1]) if run else 0
        return int(self.firsts[run]) + k - before


@dataclass(frozen=True)
class BitmapContainer:
    words: np.ndarray  # 64 members each, the lowest bit first
    ends: np.ndarray  # members up to and with each word

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.ends, k, "right"))
        word, left = int(self.words[at]), k - (int(self.ends[at - 1]) if at else 0)
        for _ in range(left):
            word &= word - 1  # drop the lowest member
        return at * 64 + (word & -word).bit_length() - 1


def container(mask: np.ndarray):
    """The members of up to ``CHUNK`` positions in the smallest of the three forms."""
    members = np.flatnonzero(mask)
    breaks = np.flatnonzero(np.diff(members) != 1)
    runs = len(breaks) + (len(members) > 0)
    if 4 * runs <= min(2 * len(members), CHUNK // 8):
        last = np.append(breaks, len(members) - 1) if runs else breaks
        first = np.append(0, breaks + 1) if runs else breaks
        return RunContainer(members[first].astype(np.uint16), (last + 1).astype(np.int32))
    if len(members) <= _ARRAY_MOST:
        return ArrayContainer(members.astype(np.uint16))
    bits = np.packbits(mask, bitorder="little")
    words = np.append(bits, np.zeros(-len(bits) % 8, np.uint8)).view("<u8")
    return BitmapContainer(words, np.cumsum(np.bitwise_count(words), dtype=np.int32))


class Boundaries:
    """Where the code points of a UTF-8 text begin."""

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        chunks = [data[at : at + CHUNK] for at in range(0, len(data), CHUNK)]
        masks = [(chunk & 0xC0) != 0x80 for chunk in chunks]
        self.size = len(raw)
        self.containers = [container(mask) for mask in masks]
        self.ends = np.cumsum([int(np.count_nonzero(mask)) for mask in masks], dtype=np.int64)
        self.count = int(self.ends[-1]) if masks else 0

    def select(self, ks: list[int]) -> list[int]:
        """Byte at which the k-th code point begins, from 0. As many as there are: the end."""
        which = np.searchsorted(self.ends, ks, "right").tolist()
        out = []
        for k, at in zip(ks, which):
            if at == len(self.containers):
                out.append(self.size)
            else:
                before = int(self.ends[at - 1]) if at else 0
                out.append(at * CHUNK + self.containers[at].select(k - before))
        return out


# -- rows -------------------------------------------------------------------------------------


def draws(key: str) -> list[int]:
    """Four 32-bit numbers that depend on the id alone."""
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearrange(raw: bytes, key: str) -> tuple[int, str, int | None, int | None, bytes]:
    """(code points, form, code points before the middle and in it, output) of one text."""
    points = Boundaries(raw)
    n, (h1, h2, h3, h4) = points.count, draws(key)
    if not raw or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_FROM:
        return n, "plain", None, None, raw
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = points.select([low, high])
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", low, high - low, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", low, high - low, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text again. A rearranged text holds no marks, so the first of each is the one put in."""
    if form == "plain":
        return output
    inner = SUFFIX if form == "psm" else PREFIX
    first, rest = output[len(PREFIX) :].split(inner, 1)
    second, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (first, second) if form == "psm" else (second, first)
    return prefix + middle + suffix


def rearranged(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, n, form, prefix_chars, middle_chars, output.

    ``n`` and the parts are in code points; the parts are null in a plain row. A null text counts
    as empty, and empty texts stay plain. The draws depend on the id alone: rows with the same id
    are cut at the same shares, and a null id draws like an empty one. Texts of any length are
    cut whole; an empty table gives no rows; other columns are not read.
    """

    def rows(columns):
        ids = ["" if i is None else str(i) for i in columns["key"].to_pylist()]
        made = [rearrange(raw, key) for raw, key in zip(columns["raw"].to_pylist(), ids)]
        names = ("n", "form", "prefix_chars", "middle_chars", "output")
        return {"_id": columns["_id"], **dict(zip(names, zip(*made) if made else ([],) * 5))}

    key = F.col(id_col).cast("string").alias("key")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    schema = fields(
        as_field(docs, id_col, "_id"), "n bigint", "form string", "prefix_chars bigint", "middle_chars bigint",
        "output binary",
    )
    made = map_batches(docs.select(F.col(id_col).alias("_id"), key, raw), rows, schema)
    return made.withColumn("output", F.col("output").cast("string")).withColumnRenamed("_id", id_col)


def restored(rows: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """Adds the text that each row was made of. Rows without an output have none.

    The same as ``restore``, in column functions: the parts lie between the first of each mark.
    """
    return rows.withColumn(name, _restored(F.col(output), F.col(form)))


def _restored(output: Column, form: Column) -> Column:
    marks = [F.lit(m.decode()) for m in (PREFIX, SUFFIX, MIDDLE)]
    inner = F.when(form == "psm", marks[1]).otherwise(marks[0])
    inner_at, middle_at = F.position(inner, output), F.position(marks[2], output)
    first = F.substring(output, F.lit(4), inner_at - 4)
    second = F.substring(output, inner_at + 3, middle_at - inner_at - 3)
    middle = F.substring(output, middle_at + 3, F.length(output))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(first, middle, second))
        .otherwise(F.concat(second, middle, first))
    )
