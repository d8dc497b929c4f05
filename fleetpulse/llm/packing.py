"""Sequence packing by non-negative least squares over a length histogram.

Documents are cut into full windows and one shorter piece. The combinations of up to three lengths
that fill a window exactly are enumerated, how often to use each is solved against the histogram
of the shorter pieces, and the counts are rounded to what the histogram has. The pieces left over
are packed greedily, longest first; the one that does not fit into the rest of a window is cut
there. At most one window of the whole corpus is left partly empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, as_field, fields, map_partition
from fleetpulse.operators.distribute import number_rows
from fleetpulse.session import write_once

WINDOW = 1024  # tokens of a sequence
ROUNDS = 100  # of the solver; what it leaves is packed greedily


def combinations(histogram: np.ndarray) -> np.ndarray:
    """All ways to fill a window with two or three lengths that occur; absent thirds are 0."""
    window = len(histogram)
    low = np.arange(1, window // 2 + 1)
    pairs = np.stack((np.zeros_like(low), low, window - low), axis=1)
    made = [pairs]
    for a in range(1, window // 3 + 1):
        b = np.arange(a, (window - a) // 2 + 1)
        made.append(np.stack((np.full_like(b, a), b, window - a - b), axis=1))
    every = np.concatenate(made)
    has = histogram > 0
    has[0] = True
    return every[has[every].all(axis=1)]


def solve_repeats(combos: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative repeat counts whose lengths come closest to the histogram in least squares.

    An active-set method: combinations that the residual calls for most, no two sharing a length,
    join the active set together, fewer at a time once that no longer helps; those whose count
    would turn negative leave it.
    """
    target = histogram.astype(float)
    target[0] = 0
    scale = target.max(initial=0)
    if not len(combos) or not scale:
        return np.zeros(len(combos))
    target = target / scale

    def columns(which: np.ndarray) -> np.ndarray:
        out = np.zeros((len(target), len(which)))
        for k in range(3):
            np.add.at(out, (combos[which, k], np.arange(len(which))), 1.0)
        out[0] = 0
        return out

    def refit(active: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Least squares over the active set, leaving the counts of a step that stays positive."""
        counts, a = counts.copy(), columns(active)
        normal, right = a.T @ a, a.T @ target
        normal[np.diag_indices_from(normal)] += 1e-9
        while len(active):
            solved = np.linalg.solve(normal, right)
            if (solved > 0).all():
                counts[active] = solved
                break
            now = counts[active]
            falling = solved <= 0
            step = (now[falling] / np.maximum(now[falling] - solved[falling], 1e-300)).min()
            moved = now + step * (solved - now)
            moved[falling & (moved <= 1e-9)] = 0
            moved[falling & (now == 0)] = 0
            counts[active] = moved
            stays = np.flatnonzero(moved > 0)
            active, normal, right = active[stays], normal[np.ix_(stays, stays)], right[stays]
        return counts

    def residual_of(counts: np.ndarray) -> np.ndarray:
        active = np.flatnonzero(counts)
        left = target - columns(active) @ counts[active]
        left[0] = 0
        return left

    counts, residual, most = np.zeros(len(combos)), target, len(target)
    for _ in range(rounds):
        gain = residual[combos].sum(axis=1)
        gain[counts > 0] = -1
        order = np.argsort(-gain, kind="stable")[: 8 * len(target)]
        used, chosen = np.zeros(len(target), bool), []
        for j in order[gain[order] > 1e-7].tolist():
            lengths = combos[j][combos[j] > 0]
            if not used[lengths].any():
                used[lengths] = True
                chosen.append(j)
            if len(chosen) == most:
                break
        if not chosen:
            break
        trial = refit(np.append(np.flatnonzero(counts), chosen), counts)
        left = residual_of(trial)
        if np.linalg.norm(left) < np.linalg.norm(residual) * (1 - 1e-6):
            counts, residual = trial, left
        elif most == 1:
            break
        else:
            most = max(1, min(most, len(chosen)) // 4)  # too many at once: fewer combinations a round
    return counts * scale


def plan(histogram: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: rows (length, low, high, base, step).

    The piece of that length with number ``i`` from ``low`` up to ``high`` begins at
    ``base + (i - low) * step`` of a stream of windows. Some thousand rows whatever the corpus.
    """
    window = len(histogram)
    combos = combinations(histogram)
    repeats = solve_repeats(combos, histogram)
    free, taken = histogram.copy(), np.zeros(window, np.int64)
    rows, at = [], 0
    for j in np.argsort(-repeats, kind="stable").tolist():
        wanted = int(np.floor(repeats[j] + 0.5))
        if wanted <= 0:
            break
        lengths = [int(x) for x in combos[j] if x]
        times = min([wanted, *(int(free[x]) // lengths.count(x) for x in lengths)])
        if not times:
            continue
        offset = 0
        for x in lengths:
            rows.append((x, int(taken[x]), int(taken[x]) + times, at * window + offset, window))
            taken[x] += times
            free[x] -= times
            offset += x
        at += times
    position = at * window
    for x in range(window - 1, 0, -1):
        if free[x]:
            rows.append((x, int(taken[x]), int(taken[x] + free[x]), position, x))
            position += x * int(free[x])
    return rows


def pack(tokens: DataFrame, width: int, window: int = WINDOW) -> DataFrame:
    """One row per piece of each row of ``tokens`` (_id, ids of ``width`` bytes each, n).

    Columns: _id, start, length, ids_crc32 (over the ids as four bytes each), doc_tokens,
    sequence_id, offset. Each id lies in one piece; the pieces of a sequence follow each other
    without a gap. Repeated rows and null ids are documents of their own. A row without ids gives
    no piece, an empty table no rows.

    Lengths meet in one histogram of at most ``window`` rows. Numbers of the pieces of a length
    come from ranges of the rows, so a length that a third of the documents share is spread.
    """
    spark = tokens.sparkSession
    row = F.monotonically_increasing_id()
    stored = write_once(tokens.select("_id", "ids", "n", row.alias("row")), "packed_ids")
    lengths = stored.select("row", "n", (F.col("n") % window).alias("rest"))
    counted = {r["rest"]: r["k"] for r in lengths.groupBy("rest").agg(F.count(F.lit(1)).alias("k")).collect()}
    histogram = np.zeros(window, np.int64)
    for length, k in counted.items():
        histogram[length] = k
    numbered = number_rows(lengths, [], ["rest", "row"], "number")
    # The numbers run over all rows in order of length, so each length begins at a known one.
    first = np.cumsum(histogram) - histogram + 1
    slots = plan(np.where(np.arange(window) > 0, histogram, 0))
    end = max((base + (high - low - 1) * step + x for x, low, high, base, step in slots), default=0)
    table = spark.createDataFrame(
        [Row(rest=x, low=int(first[x]) + a, high=int(first[x]) + b, base=base, step=step) for x, a, b, base, step in slots],
        "rest bigint, low bigint, high bigint, base bigint, step bigint",
    )
    most = lengths.agg(F.max("n")).first()[0] or 0
    inside = (F.col("l.rest") == F.col("s.rest")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    placed = (
        numbered.alias("l")
        .join(F.broadcast(table.alias("s")), inside, "left")
        .select("row", "number", (F.col("base") + (F.col("number") - F.col("low")) * F.col("step")).alias("position"))
    )
    first_full, per_row = -(-end // window), int(most // window) + 1

    def cut(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            out = []
            for key, ids, n, number, position in zip(*(c.to_pylist() for c in batch.columns)):
                flat = np.frombuffer(ids, dtype=f"<u{width}").astype("<u4")
                pieces = [
                    (k * window, window, first_full + number * per_row + k, 0) for k in range(n // window)
                ]
                start = n - n % window
                while start < n:
                    offset = position % window
                    size = min(n - start, window - offset)
                    pieces.append((start, size, position // window, offset))
                    start, position = start + size, position + size
                for start, size, sequence, offset in pieces:
                    crc = zlib.crc32(flat[start : start + size])
                    out.append((key, start, size, crc, n, sequence, offset))
            if out:
                yield dict(zip(names, zip(*out)))

    names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = fields(as_field(stored, "_id", "_id"), *(f"{name} bigint" for name in names[1:]))
    joined = stored.join(placed.hint("shuffle_hash"), "row").select("_id", "ids", "n", "number", "position")
    return map_partition(joined, cut, schema)
