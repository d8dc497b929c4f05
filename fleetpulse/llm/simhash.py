"""SimHash near-duplicates by the generalised pigeonhole principle.

The distinct fingerprints are cut into partitions of correlated bits. Each partition gets a
threshold of its own, and the thresholds add up to ``max_bits - partitions + 1``: two
fingerprints within ``max_bits`` bits then agree within the threshold in at least one partition.
Dynamic programming picks the thresholds, and a comparison of the layouts their number, by the
candidates and probes they are expected to cost on the bit statistics of all fingerprints.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, as_field, fields, map_batches, map_partition
from fleetpulse.llm.components import component_roots
from fleetpulse.session import write_once

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
BLOCK = 16_384  # fingerprints of a bucket that one task compares with each other
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """SimHash of a text over word shingles, repeats counted. No words: zero."""
    words = WORDS.findall(text.translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[a:b], 42)
            for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        ]
    n = len(hashes)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):  # a very long text is counted piece by piece
        part = np.array(hashes[at : at + 65_536], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(_BITS[2 * votes > n].sum()) if (2 * votes > n).any() else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", shingle: int = 4) -> DataFrame:
    """(id, fp): one row per document. The fingerprint is a signed 64-bit integer."""

    def rows(columns):
        texts = columns["_text"].to_pylist()
        fps = np.array([fingerprint((t or "").encode(), shingle) for t in texts], dtype=np.uint64)
        return {"_id": columns["_id"], "fp": fps.view(np.int64)}

    slim = docs.select(F.col(id_col).alias("_id"), F.col("text").alias("_text"))
    return map_batches(slim, rows, fields(as_field(docs, id_col, "_id"), "fp bigint"))


# -- statistics over all fingerprints ---------------------------------------------------------


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits how often both are set: 64 x 64 sums."""

    def run(batches: Batches) -> Iterator[dict[str, np.ndarray]]:
        both, rows = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 65_536):
                part = values[at : at + 65_536]
                bits = ((part[:, None] & _BITS) != 0).astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
                rows += len(part)
        a, b = np.divmod(np.arange(4096), 64)
        yield {"a": np.append(a, -1), "b": np.append(b, -1), "n": np.append(both.ravel(), rows)}

    counted = map_partition(fps.select("fp"), run, fields("a int", "b int", "n bigint"))
    sums = counted.groupBy("a", "b").agg(F.sum("n").alias("n"))
    both, rows = np.zeros((64, 64)), 0
    for a, b, n in sums.collect():  # 4097 rows at most
        if a < 0:
            rows = n
        else:
            both[a, b] = n
    return rows, both


def _difference_moments(rows: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the indicator that two random fingerprints differ in a bit."""
    q11 = both / max(rows, 1)
    p = np.diag(q11)
    q10 = p[:, None] - q11
    q01 = p[None, :] - q11
    q00 = 1 - q11 - q10 - q01
    joint = 2 * (q11 * q00 + q10 * q01)
    mean = 2 * p * (1 - p)
    np.fill_diagonal(joint, mean)
    return mean, joint - np.outer(mean, mean)


def _group_bits(cov: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` groups of nearly equal width, correlated bits together."""
    scale = np.sqrt(np.clip(np.diag(cov), 1e-12, None))
    strength = np.abs(cov / np.outer(scale, scale))
    free, groups = set(range(64)), []
    for g in range(parts):
        width = 64 // parts + (g < 64 % parts)
        order = sorted(free)
        seed = max(order, key=lambda b: strength[b, order].sum())
        group = [seed]
        free.remove(seed)
        while len(group) < width:
            rest = sorted(free)
            best = rest[int(np.argmax(strength[np.ix_(rest, group)].sum(axis=1)))]
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _within(width: int, mean: float, var: float, most: int) -> list[float]:
    """P(at most t differing bits) for t up to ``most``: a beta-binomial with these moments."""
    p = min(max(mean / width, 1e-9), 1 - 1e-9)
    ratio = var / max(width * p * (1 - p), 1e-12)
    rho = min(max((ratio - 1) / max(width - 1, 1), 1e-6), 0.999)
    a, b = p * (1 / rho - 1), (1 - p) * (1 / rho - 1)
    log = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    probs = [math.comb(width, k) * math.exp(log(k + a, width - k + b) - log(a, b)) for k in range(most + 1)]
    return list(np.cumsum(probs))


@dataclass(frozen=True)
class Layout:
    """Bits of each partition and the threshold it is probed with (-1: not probed)."""

    groups: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]
    cost: float


def choose_layout(rows: int, both: np.ndarray, max_bits: int = 4) -> Layout:
    """The cheapest layout over 2 to ``max_bits + 1`` partitions."""
    mean, cov = _difference_moments(rows, both)
    best = None
    for parts in range(2, max_bits + 2):
        groups = _group_bits(cov, parts)
        total = max_bits - parts + 1
        costs = []  # by partition: cost of thresholds -1..total
        for g in groups:
            chance = _within(len(g), mean[g].sum(), cov[np.ix_(g, g)].sum(), max(total, 0) + parts)
            probes, row = 0, [0.0]
            for t in range(total + parts):
                probes += math.comb(len(g), t)
                row.append(rows * _masks(len(g), t) * 20.0 + rows * rows / 2 * chance[t])
            costs.append(row)
        # table[s]: cheapest way to reach the sum s + parts-so-far of thresholds
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for row in costs:
            step: dict[int, tuple[float, tuple[int, ...]]] = {}
            for used, (cost, chosen) in table.items():
                for t, price in enumerate(row, start=-1):
                    key, value = used + t, (cost + price, (*chosen, t))
                    if key not in step or value[0] < step[key][0]:
                        step[key] = value
            table = step
        cost, chosen = table[total]
        if best is None or cost < best.cost:
            best = Layout(tuple(map(tuple, groups)), chosen, cost)
    return best


def _masks(width: int, threshold: int) -> int:
    """Signatures of a fingerprint in a partition: one per choice of bits left out."""
    return math.comb(width, threshold)


# -- probing ----------------------------------------------------------------------------------


def _signatures(fps: np.ndarray, layout: Layout) -> Iterator[tuple[int, np.ndarray]]:
    """For every choice of ``t`` bits left out of a partition: its number, and the other bits."""
    number = 0
    for group, t in zip(layout.groups, layout.thresholds):
        if t < 0:
            continue
        mask = np.uint64(0)
        for b in group:
            mask |= _BITS[b]
        for left_out in combinations(group, t):
            keep = mask
            for b in left_out:
                keep &= ~_BITS[b]
            yield number, fps & keep
            number += 1


def link_bucket(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the fingerprints within ``max_bits`` bits of each other.

    Neighbours in sorted order are linked first. Then only those outside the largest group are
    compared with all: two members of one group need no link.
    """
    n = len(fps)
    parent = np.arange(n)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out_a, out_b = [], []

    def join(a: int, b: int) -> None:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            out_a.append(fps[a])
            out_b.append(fps[b])

    if n > 64:
        for turn in (0, 16, 32, 48):
            turned = (fps << np.uint64(turn)) | (fps >> np.uint64((64 - turn) % 64)) if turn else fps
            order = np.argsort(turned, kind="stable")
            for step in (1, 2, 3):
                a, b = order[:-step], order[step:]
                near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
                for x, y in zip(a[near].tolist(), b[near].tolist()):
                    join(x, y)
        roots = np.array([find(i) for i in range(n)])
        values, counts = np.unique(roots, return_counts=True)
        outside = np.flatnonzero(roots != values[np.argmax(counts)])
    else:
        outside = np.arange(n)
    for i in outside.tolist():
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= max_bits)
        for j in near.tolist():
            if j != i:
                join(i, j)
    return np.array(out_a, dtype=np.uint64), np.array(out_b, dtype=np.uint64)


def links(fps: DataFrame, layout: Layout, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints whose components are those of all close pairs.

    Fingerprints that share a signature meet in a bucket. A bucket larger than ``block`` is dealt
    out in blocks and each pair of blocks goes to a task of its own, so no task holds a whole
    hot bucket, and no close pair is missed.
    """

    def probe(batches: Batches) -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for number, part in _signatures(values, layout):
                cells = _mixed(part, number).view(np.int64)
                yield {"cell": cells, "fp": values.view(np.int64)}

    def compare(batches: Batches) -> Iterator[dict[str, np.ndarray]]:
        for keys, values in _whole_buckets(batches):
            a, b = _link_sorted(keys, values, max_bits)
            if len(a):
                yield {"a": a.view(np.int64), "b": b.view(np.int64)}

    probed = map_partition(fps.select("fp"), probe, fields("cell bigint", "fp bigint"))
    sizes = probed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    hot = write_once(
        sizes.where(F.col("n") > block).select("cell", F.ceil(F.col("n") / block).alias("blocks")),
        "hot_buckets",
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    others = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda x: F.least(x, own) * F.col("blocks") + F.greatest(x, own),
    )
    dealt = probed.join(hot, "cell", "left").select(
        "cell",
        F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(others)).alias("pair"),
        "fp",
    )
    met = dealt.repartition("cell", "pair").sortWithinPartitions("cell", "pair", "fp")
    return map_partition(met, compare, fields("a bigint", "b bigint"))


def _mixed(values: np.ndarray, number: int) -> np.ndarray:
    """One 64-bit cell for a signature and its number. Cells that collide only add comparisons."""
    x = values + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _whole_buckets(batches: Batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted rows as (bucket key, fingerprint) arrays in which every bucket is complete."""
    keys, values = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
    for batch in batches:
        cell, pair, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        keys = np.concatenate((keys, np.stack((cell, pair), axis=1)))
        values = np.concatenate((values, fp.view(np.uint64)))
        if not len(keys):
            continue
        goes_on = (keys == keys[-1]).all(axis=1)  # the last bucket may go on in the next batch
        first = int(np.argmax(goes_on))
        if first:
            yield keys[:first], values[:first]
            keys, values = keys[first:], values[first:]
    if len(keys):
        yield keys, values


def _link_sorted(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    changed = np.ones(len(keys), bool)
    changed[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    cuts = np.append(np.flatnonzero(changed), len(keys))
    sizes = np.diff(cuts)
    out_a, out_b = [], []
    for step in range(1, 9):  # buckets of up to nine: all pairs, all buckets at once
        at = np.flatnonzero((np.repeat(sizes, sizes) <= 9)[:-step] & ~_crosses(changed, step))
        close = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= max_bits]
        out_a.append(fps[close])
        out_b.append(fps[close + step])
    for at, n in zip(cuts[:-1][sizes > 9].tolist(), sizes[sizes > 9].tolist()):
        a, b = link_bucket(fps[at : at + n], max_bits)
        out_a.append(a)
        out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


def _crosses(changed: np.ndarray, step: int) -> np.ndarray:
    """Whether a new bucket begins between a row and the one ``step`` rows later."""
    begun = np.cumsum(changed)
    return begun[step:] != begun[:-step]


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", shingle: int = 4, max_bits: int = 4, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing
    bits, the row's own included; null ids count last. Rows without words have fingerprint zero and are linked
    like any other. Repeated ids and texts are rows of their own. Other columns are not read; an
    empty table gives no rows. Equal fingerprints are one node, so a large group of exact copies
    costs one row after a partial aggregate.
    """
    each = write_once(fingerprints(docs, id_col, shingle), "fingerprints")
    nodes = write_once(each.groupBy("fp").agg(F.min("_id").alias("least")), "distinct_fingerprints")
    rows, both = bit_counts(nodes)
    layout = choose_layout(rows, both, max_bits)
    roots = component_roots(links(nodes, layout, max_bits, block))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    low = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = placed.join(low, "root").select("fp", "component_id")
    return each.join(by_fp, "fp").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
