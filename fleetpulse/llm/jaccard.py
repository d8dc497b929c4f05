"""Similarity join of word n-gram sets with adaptive multi-match prefixes.

All shingles have one order, rare ones first. Two sets of the wanted similarity share at least ``m``
of the first ``size - least overlap + m`` shingles in that order, for every ``m``: the prefix for
``m`` matches. With one match it is the plain prefix filter.

1. Equal sets are one node. Shingles are counted in a fixed number of counters over all texts; the
   logarithm of the count, then the hash, gives the order.
2. Each node picks its ``m``. One match more is one more shingle to post; no more nodes can share
   ``m`` of its shingles than the estimated postings of these shingles divided by ``m``, and each
   of them has to be verified. The cheapest sum wins, so nodes with frequent shingles ask for more.
3. Shingles in the prefixes of two nodes or more are buckets. In each bucket all nodes are compared
   with one of them first, not the same in all buckets. What is linked by then need not be compared again, so a large group of
   near copies costs a row per node and bucket, not its pairs.
4. Pairs of nodes not yet linked are counted by shared bucket in small buckets, and matched inside
   one task in large ones. Those that share as many shingles as the less demanding of them asks
   for, and as their sizes require, are verified on their whole sets.

Whole sets take twice the room of the texts and are not stored. They are taken from the texts to count
shingles, to choose prefixes, and to verify pairs, then from one text of each node that a pair needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, as_field, fields, map_batches, map_partition
from fleetpulse.llm.components import component_roots
from fleetpulse.operators.distribute import lookup_join
from fleetpulse.session import write_alone, write_once

SHINGLE = 3
PERCENT = 90
COUNTERS = 1 << 22  # of shingles; they fix the size of what is broadcast, one byte for each
MATCHES = np.array([12, 16, 24, 32])  # shared prefix shingles to choose from; all of a smaller overlap
POSTING, CANDIDATE = 24.0, 1000.0  # bytes moved for a posting, and on average for a pair of nodes
CHANCE = 0.05  # other nodes with a shingle, at least: counters do not tell very rare ones apart
LEADERS = 8  # nodes that all others of a large bucket group are compared with first
SMALL = 64  # nodes of a bucket up to which its pairs are counted by a join
BLOCK = 2048  # nodes of a larger bucket that one task compares with each other
_CHUNK = 1 << 16  # counters sent in one row
_COLUMNS = 4096
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


# -- sets -------------------------------------------------------------------------------------


def shingles(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's word shingles, sorted. Fewer words: the whole sequence as one."""
    words = raw.translate(_LOWER).split()  # splits at the six ASCII white-space characters
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64)
    digest = xxhash.xxh3_64_intdigest
    each = np.fromiter(map(digest, words), np.uint64, len(words))
    n = len(each) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = (out + each[i : i + n]) * _ODD[i % 3]
        out ^= out >> np.uint64(31)
    return np.unique(out)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    offsets = column.offsets.to_numpy() - column.offsets[0].as_py() if len(column) else np.zeros(1, int)
    return (flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """(id, row, key, n, tokens): the shingle set of each row. ``key`` names the set, null if it is empty.

    ``row`` is a hash of id and text, by which a row is found again.
    """

    def rows(columns):
        sets = [shingles(raw, size) for raw in columns["raw"].to_pylist()]
        keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        kept = {c: columns[c] for c in ("_id", "row")}
        return kept | {"key": keys, "n": list(map(len, sets)), "tokens": _lists(sets)}

    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    row = _row(id_col).alias("row")
    schema = fields(as_field(docs, id_col, "_id"), "row bigint", "key binary", "n bigint", "tokens array<bigint>")
    return map_batches(docs.select(F.col(id_col).alias("_id"), row, raw), rows, schema)


def _row(id_col: str) -> Column:
    return F.xxhash64(id_col, "text")


# -- order ------------------------------------------------------------------------------------


def count_levels(sets: DataFrame, counters: int = COUNTERS) -> np.ndarray:
    """Level of each counter: eight times the binary logarithm of its count over all sets.

    Tasks send their counters compressed, in chunks that are added up apart from each other.
    """
    mask, chunk = np.uint64(counters - 1), min(_CHUNK, counters)

    def count(batches: Batches) -> Iterator[dict]:
        total = np.zeros(counters, np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(flat), 1 << 22):
                total += np.bincount((flat[at : at + (1 << 22)] & mask).astype(np.int64), minlength=counters)
        packed = [zstandard.compress(total[at : at + chunk].tobytes(), 1) for at in range(0, counters, chunk)]
        yield {"chunk": np.arange(len(packed)), "counts": packed}

    def add(batches: Batches) -> Iterator[dict]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, packed in zip(*(c.to_pylist() for c in batch.columns)):
                sums.setdefault(number, np.zeros(chunk, np.int64))
                sums[number] += np.frombuffer(zstandard.decompress(packed), np.int64)
        if sums:
            levels = [np.round(8 * np.log2(1.0 + x)).astype(np.uint8).tobytes() for x in sums.values()]
            yield {"chunk": list(sums), "counts": levels}

    schema = fields("chunk int", "counts binary")
    counted = map_partition(sets.select("tokens"), count, schema)
    levels = np.zeros(counters, np.uint8)
    for number, packed in map_partition(counted.repartition("chunk"), add, schema).collect():
        levels[number * chunk : (number + 1) * chunk] = np.frombuffer(packed, np.uint8)
    return levels


def least_overlap(n, percent: int = PERCENT):
    """Shingles that a set of ``n`` shares with any set similar to it, at least. Numbers or columns."""
    need = n * percent + 99
    return F.floor(need / 100) if isinstance(n, Column) else need // 100


def choose_matches(first: int, most: int, others: np.ndarray) -> int:
    """The cheapest number of matches for a node whose one-match prefix has ``first`` shingles.

    ``others`` estimates, in order, with how many other nodes it shares each shingle.
    """
    choices = MATCHES[MATCHES <= most]
    choices = choices if len(choices) else np.array([max(most, 1)])
    lengths = np.minimum(first + choices - 1, len(others))
    candidates = np.cumsum(others)[lengths - 1] / choices
    return int(choices[np.argmin(POSTING * lengths + CANDIDATE * candidates)])


def prefixes(sets: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """(id, row, key, n, matches, prefix): the number of matches of each set, and its prefix for them."""
    sent = sets.sparkSession.sparkContext.broadcast(levels)
    mask = np.uint64(len(levels) - 1)
    counts = np.exp2(np.arange(256) / 8.0) - 1
    # What a counter holds of other shingles, in the middle.
    others = np.maximum(counts - counts[int(np.median(levels))] - 1, CHANCE)

    def rows(columns):
        ns, matches, kept = columns["n"].to_pylist(), [], []
        for n, tokens in zip(ns, _arrays(columns["tokens"])):
            if not n:
                matches.append(0)
                kept.append(tokens)
                continue
            least = least_overlap(n, percent)
            level = sent.value[(tokens & mask).astype(np.int64)]
            order = np.argsort(level, kind="stable")
            m = choose_matches(n - least + 1, least, others[level[order]])
            matches.append(m)
            kept.append(tokens[order[: n - least + m]])
        given = {c: columns[c] for c in ("_id", "row", "key", "n")}
        return given | {"matches": matches, "prefix": _lists(kept)}

    schema = fields(
        sets.schema["_id"], "row bigint", "key binary", "n bigint", "matches int", "prefix array<bigint>"
    )
    return map_batches(sets, rows, schema)


# -- candidates -------------------------------------------------------------------------------


def buckets(ordered: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, key, n, matches, at): shingles in the prefixes of two nodes or more, each node once.

    Without nodes that have fewer of them than any link of theirs shares.
    """
    posted = ordered.select("key", "n", "matches", F.posexplode("prefix").alias("at", "token"))
    head = F.xxhash64("key")
    met = posted.groupBy("token").agg(F.min(head).alias("low"), F.max(head).alias("high"))
    live = write_once(met.where("low <> high").select("token"), "live_shingles")
    shared = write_once(lookup_join(posted, live, "token", "inner").dropDuplicates(["token", "key"]), "shared_shingles")
    # A similar set has nine tenths of the shingles or more, by ``PERCENT``, and asks for matches too.
    fewest = F.greatest(F.lit(1), F.least(F.lit(int(MATCHES[0])), F.floor(F.col("n") * percent * percent / 10_000)))
    own = shared.groupBy("key").agg(F.count(F.lit(1)).alias("own"), F.max("n").alias("n"))
    return shared.join(own.where(F.col("own") >= fewest).select("key"), "key")


def enough(matches, n, other_matches, other_n, percent: int = PERCENT):
    """Prefix shingles that a link shares at least. Numbers, arrays or columns.

    Two sets that are linked share ``overlap`` shingles. Of the first ``n - least overlap + matches``
    of a set all but ``n - overlap`` are shared, and the first of them lie in both prefixes.
    """
    overlap = (percent * (n + other_n) + 99 + percent) / (100 + percent)
    over = matches - least_overlap(n, percent), other_matches - least_overlap(other_n, percent)
    if isinstance(n, Column):
        return F.least(*over) + F.floor(overlap)
    return np.minimum(*over) + np.floor(overlap).astype(np.int64)


def _possible(n: Column, other: Column, percent: int) -> Column:
    return 100 * F.least(n, other) >= percent * F.greatest(n, other)


def star_pairs(shared: DataFrame, percent: int = PERCENT, leaders: int = LEADERS) -> DataFrame:
    """(a, b): in each bucket one node with all others, where both meet in two buckets or more.

    Shingles fall in ``leaders`` classes, and the nodes have another order in each of them, so the
    nodes of a large group meet several others and not always the same one.
    """
    turn = F.pmod("token", F.lit(leaders))
    one = F.min(F.struct(F.xxhash64("key", turn).alias("place"), "key", "n", "matches")).alias("one")
    first = write_once(shared.groupBy("token").agg(one), "bucket_heads")
    met = lookup_join(shared, first, "token", "inner").where(
        (F.col("key") != F.col("one.key")) & _possible(F.col("n"), F.col("one.n"), percent)
    )
    sides = F.least("key", "one.key").alias("a"), F.greatest("key", "one.key").alias("b")
    least = F.max(F.least("matches", "one.matches", F.lit(2))).alias("enough")
    pairs = met.groupBy(*sides).agg(F.count(F.lit(1)).alias("met"), least)
    return pairs.where("met >= enough").select("a", "b")


def whole_sets(keys: DataFrame, ordered: DataFrame, docs: DataFrame, id_col: str, size: int) -> DataFrame:
    """(key, n, tokens): the sets of ``keys``, each from the text of one row. No other text is moved."""
    rows = lookup_join(ordered.select("key", "row"), keys, "key", "left_semi").groupBy("key").agg(F.min("row").alias("row"))
    rows = write_once(rows.select("row").distinct(), "rows_of_candidates")
    texts = lookup_join(docs.select(id_col, "text", _row(id_col).alias("row")), rows, "row", "left_semi")
    # A row that comes twice, or has the hash of another one, is left out here or meets no pair.
    return shingle_sets(texts, id_col, size).select("key", "n", "tokens").dropDuplicates(["key"])


def verify(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int = PERCENT) -> DataFrame:
    """(a, b): the pairs that are links, by their whole sets, as ``sets_of`` gives them for their keys."""
    pairs = write_once(pairs, "candidates")
    keys = write_once(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys")
    asked = write_once(sets_of(keys), "sets_of_candidates")
    for side in ("a", "b"):
        pairs = pairs.join(asked.select(*(F.col(c).alias(side if c == "key" else f"{side}_{c}") for c in asked.columns)), side)
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    linked = 100 * shared >= percent * (F.col("a_n") + F.col("b_n") - shared)
    return write_once(pairs.where(linked).select("a", "b"), "links")


def counted_pairs(small: DataFrame, in_large: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): pairs of nodes with different roots that meet in small buckets, and often enough.

    ``in_large`` (key, more) says in how many large buckets a node is: so many of the matches may
    be missing here.
    """
    sides = [small.select("token", *(F.col(c).alias(f"{x}_{c}") for c in ("key", "n", "matches", "root"))) for x in "ab"]
    met = sides[0].join(sides[1], "token").where(
        (F.col("a_key") < F.col("b_key")) & (F.col("a_root") != F.col("b_root")) & _possible(F.col("a_n"), F.col("b_n"), percent)
    )
    pairs = met.groupBy(F.col("a_key").alias("a"), F.col("b_key").alias("b")).agg(
        F.count(F.lit(1)).alias("met"),
        F.max(enough(*(F.col(c) for c in ("a_matches", "a_n", "b_matches", "b_n")), percent)).alias("enough"),
    )
    for side in ("a", "b"):
        own = in_large.select(F.col("key").alias(side), F.col("more").alias(f"{side}_more"))
        pairs = pairs.join(own, side, "left")
    zero = F.lit(0)
    missing = F.least(F.coalesce("a_more", zero), F.coalesce("b_more", zero))
    return pairs.where(F.col("met") + missing >= F.col("enough")).select("a", "b")


def matched_pairs(large: DataFrame, ordered: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(a, b): pairs of nodes with different roots in large buckets that share enough of their prefixes.

    A bucket of more than ``block`` nodes is dealt out in blocks, and each pair of blocks goes to a
    task of its own. A pair comes from the bucket of the first shingle that both prefixes have, so
    from one bucket only, and from none if that is a small one.
    """
    groups = large.groupBy("token").agg(
        F.count(F.lit(1)).alias("met"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    mixed = write_once(
        groups.where("low <> high").select("token", F.ceil(F.col("met") / block).alias("blocks")), "mixed_buckets"
    )
    wanted = write_once(lookup_join(large, mixed, "token", "inner"), "mixed_nodes")
    keys = write_once(wanted.select("key").distinct(), "keys")
    heads = lookup_join(ordered.select("key", "prefix"), keys, "key", "left_semi").dropDuplicates(["key"])
    joined = wanted.join(heads, "key")
    own = F.pmod(F.xxhash64("key"), F.col("blocks"))
    others = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda x: F.least(x, own) * F.col("blocks") + F.greatest(x, own),
    )
    dealt = joined.select(
        "token", F.explode(others).alias("cell"), "key", "root", "n", "at", "matches", "prefix", own.alias("block"),
        "blocks",
    )
    met = dealt.repartition("token", "cell").sortWithinPartitions("token", "cell")

    def compare(batches: Batches) -> Iterator[dict]:
        for held in _cells(batches):
            a, b = _matching(held, percent)
            if len(a):
                yield {"a": a, "b": b}

    return map_partition(met, compare, fields("a binary", "b binary")).distinct()


def _cells(batches: Batches) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:2] != held[0][:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _matching(held: list[tuple], percent: int) -> tuple[list[bytes], list[bytes]]:
    """Pairs of a cell: different roots, possible sizes, and enough shared prefix shingles."""
    keys = [row[2] for row in held]
    numbers: dict[bytes, int] = {}
    root = np.array([numbers.setdefault(row[3], len(numbers)) for row in held])
    n, at, matches, block = (np.array([row[i] for row in held]) for i in (4, 5, 6, 8))
    if len(numbers) < 2:
        return [], []
    fits = np.triu(root[:, None] != root, 1)
    fits &= 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
    low, high = divmod(held[0][1], held[0][9])
    if low != high:  # pairs inside a block belong to the block's own cell
        fits &= block[:, None] != block
    i, j = np.nonzero(fits)
    if not len(i):
        return [], []
    sizes = np.array([len(row[7]) for row in held])
    flat = np.concatenate([np.array(row[7], np.int64) for row in held])
    owner = np.repeat(np.arange(len(held)), sizes)
    before = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < at[owner]
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    twice = count > 1
    column = np.where(twice, np.cumsum(twice) - 1, -1)[column]
    shared, earlier = np.zeros(len(i), np.int32), np.zeros(len(i), bool)
    for c in range(0, int(twice.sum()), _COLUMNS):
        some = (column >= c) & (column < c + _COLUMNS)
        marks = np.zeros((len(held), _COLUMNS), np.float32)
        marks[owner[some], column[some] - c] = 1
        shared += (marks @ marks.T)[i, j].astype(np.int32)
        marks[:] = 0
        some &= before
        marks[owner[some], column[some] - c] = 1
        earlier |= (marks @ marks.T)[i, j] > 0
    good = (shared >= enough(matches[i], n[i], matches[j], n[j], percent)) & ~earlier
    return [keys[x] for x in i[good].tolist()], [keys[x] for x in j[good].tolist()]


# -- the join ---------------------------------------------------------------------------------


def near_sets(
    docs: DataFrame, id_col: str = "doc_id", size: int = SHINGLE, percent: int = PERCENT, small: int = SMALL,
    block: int = BLOCK, counters: int = COUNTERS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    Two rows are linked when the sets of their word shingles have at least ``percent`` of their
    union in common. ``component_id`` is the smallest id reachable over links, the row's own
    included; null ids count last. A row without words, its text null or empty included, has no
    shingles and is linked with nothing: its component is its own id. Repeated rows and equal sets
    are linked. Texts of any length are taken whole; an empty table gives no rows; other columns
    are not read. Sets are those of 64-bit hashes of shingles. ``docs`` is read several times.
    """
    spark, sets = docs.sparkSession, shingle_sets(docs, id_col, size)
    ordered = write_alone(spark, lambda: prefixes(sets, count_levels(sets, counters), percent), "prefixes")
    each = ordered.select("_id", "key", "n")
    shared = write_alone(spark, lambda: buckets(ordered, percent), "buckets")

    def links(pairs: DataFrame) -> DataFrame:
        return verify(pairs, lambda keys: whole_sets(keys, ordered, docs, id_col, size), percent)

    roots = write_alone(spark, lambda: component_roots(links(star_pairs(shared, percent))), "roots")

    def components() -> DataFrame:
        placed = lookup_join(shared, roots.withColumnRenamed("node", "key"), "key")
        placed = placed.withColumn("root", F.coalesce("root", "key"))
        sizes = shared.groupBy("token").agg(F.count(F.lit(1)).alias("met"))
        hot = write_once(sizes.where(F.col("met") > small).select("token", F.lit(True).alias("large")), "large_buckets")
        placed = lookup_join(placed, hot, "token").withColumn("large", F.coalesce("large", F.lit(False)))
        placed = write_once(placed, "placed")
        large = placed.where("large")
        in_large = large.groupBy("key").agg(F.count(F.lit(1)).alias("more"))
        found = counted_pairs(placed.where("not large"), in_large, percent).unionByName(
            matched_pairs(large, ordered, percent, block)
        )
        more = links(found)
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        final = component_roots(known.unionByName(more))

        least = each.where("n > 0").groupBy("key").agg(F.min("_id").alias("least"))
        rooted = write_once(
            least.join(final, least["key"] == final["node"], "left").select("key", "least", F.coalesce("root", "key").alias("root")),
            "rooted",
        )
        low = write_once(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest_ids")
        return lookup_join(rooted, low, "root").select("key", "component_id")

    by_key = write_alone(spark, components, "components_of_sets")
    return lookup_join(each, by_key, "key").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
    )
