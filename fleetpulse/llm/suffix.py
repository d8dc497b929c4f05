"""Repeated passages by suffix arrays: every string of ``length`` bytes that occurs twice.

1. Equal texts are counted and kept once; each is cut into runs. A run is a stretch of string
   starts that share an anchor, the smallest hash of a short gram inside the string. Equal strings
   have equal anchors, so only runs of one anchor can repeat each other, and equal runs are counted
   once.
2. Distinct runs of an anchor go to a shard, which holds a bounded number of bytes. The shard leaves
   out starts whose strings have no equal by what surrounds their anchor. It sorts the other suffixes by Larsson-Sadakane refinement and takes the common prefixes of neighbours from
   Kasai's relation between successive suffixes. Strings with a common prefix of ``length`` repeat.
3. An anchor with more text than a shard holds is dealt over several. Their sorted strings are
   merged by binary search: each shard looks its strings up among those of the others.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import (
    Batches, as_field, fields, map_batches, map_partition, merge_spans, text_key,
)
from fleetpulse.operators.distribute import lookup_join
from fleetpulse.session import shuffle_partitions, work_path, write_once

LENGTH = 400  # bytes
PASSAGE_BYTES = 200  # strings in which passages are looked for; shorter than most of PASSAGE_WORDS
PASSAGE_WORDS = 50
GRAM = 32  # bytes that an anchor hashes; a power of two
SHARD_BYTES = 1 << 20
PARTS = 4  # of the distances to the anchor, for which surroundings are compared
CHUNK = 1 << 20  # bytes looked at in one go; positions in it fit the low bits of a key
_POSITION = np.uint64((1 << 24) - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


# -- anchors and runs -------------------------------------------------------------------------


def _doubled(values: np.ndarray, size: int, by: int) -> np.ndarray:
    """Hashes of twice the length from hashes of ``by`` bytes."""
    n = len(values) - by
    out = values[:n] * _ODD[by.bit_length() % 3] + (values[by : by + n] ^ _ODD[0])
    out ^= out >> np.uint64(31)
    return out


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    out = raw.astype(np.uint64) * _ODD[0] + _ODD[1]
    by = 1
    while by < gram:
        out = _doubled(out, gram, by)
        by *= 2
    out *= _ODD[2]
    return out ^ (out >> np.uint64(32))


def _window_minimum(keys: np.ndarray, window: int) -> np.ndarray:
    """Smallest key of each window: minima from both ends of blocks as long as a window."""
    n = len(keys)
    blocks = -(-n // window)
    padded = np.full(blocks * window, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - window + 1], ahead[window - 1 : n])


def gram_size(length: int) -> int:
    """Half a string at most, so that short strings have anchors too."""
    return min(GRAM, 1 << ((length // 2).bit_length() - 1)) if length > 1 else 1


def batch_runs(raws: list[bytes], length: int = LENGTH) -> Iterator[dict[str, np.ndarray]]:
    """Runs of several texts: number of the text, first start, end of starts, anchor, digest.

    ``ahead`` is how far behind the first start the anchor lies. It is the same for equal strings.

    Each start of a string lies in one run. Short texts are looked at together and long ones in
    parts.
    """
    gram = gram_size(length)
    waiting: list[tuple[int, int, bytes]] = []
    held = 0
    for number, raw in enumerate(raws):
        for at in range(0, len(raw) - length + 1, CHUNK):
            piece = raw[at : at + CHUNK + length - 1]
            if held and held + len(piece) > CHUNK:
                yield _runs(waiting, length, gram)
                waiting, held = [], 0
            waiting.append((number, at, piece))
            held += len(piece)
    if waiting:
        yield _runs(waiting, length, gram)


def _runs(pieces: list[tuple[int, int, bytes]], length: int, gram: int) -> dict[str, np.ndarray]:
    joined = b"".join(piece for _, _, piece in pieces)
    hashes = gram_hashes(np.frombuffer(joined, np.uint8), gram)
    keys = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    where = _window_minimum(keys, length - gram + 1) & _POSITION
    sizes = np.array([len(piece) for _, _, piece in pieces])
    begins = np.cumsum(sizes) - sizes
    starts = sizes - length + 1  # windows that reach into the next piece are passed over
    owner = np.repeat(np.arange(len(pieces)), starts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    anchor = where[begins[owner] + inside].astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(owner)))
    piece, low = owner[first], inside[first]
    at = begins[piece] + low
    digests = [
        xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in zip(at.tolist(), (at + count + length - 1).tolist())
    ]
    number = np.array([n for n, _, _ in pieces])
    offset = np.array([a for _, a, _ in pieces])
    return {
        "number": number[piece], "first": offset[piece] + low, "last": offset[piece] + low + count,
        "ahead": anchor[first] - at,
        "anchor": hashes[anchor[first]].view(np.int64), "digest": np.array(digests, np.uint64).view(np.int64),
    }


# -- one shard --------------------------------------------------------------------------------


def sorted_depth(n: int, length: int) -> tuple[int, int]:
    """By what factor a round deepens the order of ``n`` suffixes, and to what depth past ``length``.

    Three ranks fit a 64-bit key if each takes 21 bits, otherwise two do.
    """
    factor, depth = (3 if n < (1 << 21) - 1 else 2), 8
    while depth < length:
        depth *= factor
    return factor, depth


def suffix_array(raw: np.ndarray, factor: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` bytes, and each one's rank.

    The first eight bytes are sorted as numbers. Each round deepens the order by the ranks of the
    round before, and only groups of suffixes that are still equal are sorted again.
    """
    n = len(raw)
    padded = np.concatenate((raw, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # behind the last byte
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    width = np.uint64(64 // factor)
    h = 8
    while h < depth:
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        places = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(places):
            break
        suffixes = order[places]
        key = rank[suffixes].astype(np.uint64)
        for step in range(1, factor):
            behind = np.minimum(suffixes.astype(np.int64) + step * h, n)
            key = (key << width) | (rank[behind] + 1).astype(np.uint64)
        turn = np.argsort(key)
        order[places] = suffixes[turn]
        key = key[turn]
        fresh = np.append(True, key[1:] != key[:-1])
        new[places] = fresh
        rank[order[places]] = places[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        h *= factor
    return order, rank[:n]


def common_prefixes(raw: np.ndarray, order: np.ndarray, rank: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, counted up to ``depth``.

    Kasai: the suffix one byte further on has at least one byte less in common with its own
    predecessor, and exactly one less if the bytes before both are equal. So only the others are
    compared byte by byte, eight at a time. Suffixes left in one group agree to the full depth;
    their order among each other is open, so nothing is carried on from them.
    """
    n = len(raw)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    p = np.arange(n)
    tied = (before >= 0) & (rank[np.maximum(before, 0)] == rank)
    same_left = (p > 0) & (before > 0)
    same_left[same_left] = raw[p[same_left] - 1] == raw[before[same_left] - 1]
    alone = np.ones(n, bool)
    alone[order[:-1]] &= rank[order[:-1]] != rank[order[1:]]
    alone &= ~tied
    same_left[1:] &= alone[:-1]
    known = np.where(tied, depth, 0)
    fixed = tied | ~same_left
    todo = np.flatnonzero(~tied & ~same_left & (before >= 0))
    padded = np.concatenate((raw, np.zeros(depth + 8, np.uint8)))
    words = np.lib.stride_tricks.as_strided(padded, (n + depth, 8), (1, 1))
    for at in range(0, depth, 8):
        if not len(todo):
            break
        a, b = words[todo + at].view(np.uint64).ravel(), words[before[todo] + at].view(np.uint64).ravel()
        differ = a ^ b
        low = differ & (~differ + np.uint64(1))  # lowest set bit: the first byte that differs
        equal = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 8)
        known[todo] = np.minimum(at + equal, n - np.maximum(todo, before[todo]))
        todo = todo[(equal == 8) & (known[todo] == at + 8)]
    last = np.maximum.accumulate(np.where(fixed, p, 0))
    full = known[last] - (p - last)
    return np.clip(full, 0, depth)[order]


def equal_strings(raw: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A number for the string of ``length`` bytes at each start; equal strings share it."""
    factor, depth = sorted_depth(len(raw), length)
    order, rank = suffix_array(raw, factor, depth)
    prefix = common_prefixes(raw, order, rank, depth)
    number = np.empty(len(raw), np.int64)
    number[order] = np.cumsum(prefix < length)
    return number[starts]


def _string_digests(raw: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of the string at each start, from hashes of its power-of-two parts."""
    out = []
    for seed in (1, 2):
        level = (raw.astype(np.uint64) + np.uint64(seed)) * _ODD[seed]
        total, at, by = np.zeros(len(starts), np.uint64), 0, 1
        while by <= length:
            if length & by:
                total = (total ^ level[starts + at]) * _ODD[0]
                total ^= total >> np.uint64(29)
                at += by
            if by * 2 <= length:
                level = _doubled(level, length, by)
            by *= 2
        out.append(total.view(np.int64))
    return out[0], out[1]


# -- the corpus -------------------------------------------------------------------------------


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Consecutive rows with the same first value."""
    held: list[tuple] = []
    for row in rows:
        if held and row[0] != held[0][0]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _rows(batches: Batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


class Passages:
    """Repeated passages of a table of texts. Tables in the shared folder hold the steps."""

    def __init__(self, docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES):
        self.spark, self.length, self.shard_bytes = docs.sparkSession, length, shard_bytes
        text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
        keyed = docs.select(text_key().alias("key"), text.alias("raw"))
        # Copies meet as partial sums: one row per text and task, whatever their number.
        unique = keyed.groupBy("key").agg(F.first("raw").alias("raw"), F.count(F.lit(1)).alias("copies"))
        # Bucketed by key, so that later joins read the texts in place.
        name = self.name = f"texts_{uuid.uuid4().hex}"
        n = shuffle_partitions(self.spark)
        writer = unique.write.format("parquet").option("path", work_path(self.spark, "texts"))
        writer.option("compression", "zstd").bucketBy(n, "key").saveAsTable(name)
        self.texts = self.spark.table(name)
        self.spans = self._find()

    def _runs(self) -> DataFrame:
        length = self.length

        def run(batches: Batches) -> Iterator[dict]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    keys, raws = batch.slice(at, 1000).columns
                    for found in batch_runs(raws.to_pylist(), length):
                        yield {"key": keys.take(pa.array(found.pop("number"))), **found}

        long = self.texts.where(F.octet_length("raw") >= length).select("key", "raw")
        schema = fields("key binary", "first int", "last int", "ahead int", "anchor bigint", "digest bigint")
        return map_partition(long, run, schema)

    def _find(self) -> DataFrame:
        """(key, spans): repeated spans of each text that has any and occurs once."""
        tail = self.length - 1
        runs = write_once(self._runs(), "runs")
        met = runs.groupBy("anchor").agg(
            F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high")
        )
        # Stored, so that the join with all runs can be split where an anchor is frequent.
        met = write_once(
            met.where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed")), "repeated_anchors"
        )
        live = write_once(runs.join(met, "anchor"), "live_runs")
        each = live.groupBy("anchor", "digest").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first")).alias("one")
        )
        # Every run with the number of its equals, and whether it stands for them.
        counted = live.join(write_once(each, "distinct_runs"), ["anchor", "digest"]).withColumn(
            "stands", F.struct("key", "first") == F.col("one")
        )
        counted = write_once(counted.drop("one"), "counted_runs")
        again = counted.where("n > 1")
        whole = again.select("key", F.col("first").alias("a"), (F.col("last") + tail).alias("b"))
        partly = self._in_shards(counted.where("mixed and stands").drop("mixed", "stands"))
        spans = whole.unionByName(partly)
        return spans.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def _in_shards(self, distinct: DataFrame) -> DataFrame:
        """Spans of runs that repeat others in part, from the suffix arrays of all shards."""
        length, most = self.length, self.shard_bytes
        size = (F.col("last") - F.col("first") + length - 1).cast("bigint")
        load = distinct.groupBy("anchor").agg(F.sum(size).alias("bytes"))
        total = load.agg(F.sum("bytes")).first()[0] or 0
        shards = max(1, -(-total // most))
        hot = write_once(
            load.where(F.col("bytes") > most).select("anchor", F.ceil(F.col("bytes") / most).alias("parts")), "hot_anchors"
        )
        dealt = distinct.join(hot, "anchor", "left").withColumn("hot", F.col("parts").isNotNull())
        salt = F.pmod(F.xxhash64("digest"), F.col("parts"))
        shard = F.when(F.col("hot"), shards + F.pmod(F.xxhash64("anchor", salt), F.lit(1 << 60))).otherwise(
            F.pmod(F.xxhash64("anchor"), F.lit(shards))
        )
        own = ["first", "last", "n", "hot", "anchor", "ahead"]
        wanted = dealt.select("key", shard.alias("shard"), *own)
        piece = F.substring("raw", F.col("first") + 1, size.cast("int"))
        pieces = self.texts.select("key", "raw").join(wanted.hint("shuffle_hash"), "key")
        pieces = pieces.select("shard", "key", *own, piece.alias("piece"))
        spread = max(shuffle_partitions(self.spark), min(shards, 100_000))
        placed = pieces.repartition(spread, "shard").sortWithinPartitions("shard", "key", "first")

        # What the shards of hot anchors send on takes about twelve bytes for each of theirs.
        of_hot = hot.agg(F.sum("parts")).first()[0] or 0
        ranges = max(1, 12 * of_hot)

        def search(batches: Batches) -> Iterator[dict]:
            for held in _groups(_rows(batches)):
                yield from _search_shard(_met_again(held, length), length, ranges)

        found = write_once(map_partition(placed, search, _FOUND), "shard_results")
        local = found.where("range is null").select("key", "a", "b")
        return local.unionByName(self._across(found.where("range is not null"), ranges))

    def _across(self, strings: DataFrame, ranges: int) -> DataFrame:
        """Spans of strings of hot anchors that another shard has as well, one range at a time."""
        length = self.length

        def merge(batches: Batches) -> Iterator[dict]:
            for held in _groups(_rows(batches)):
                yield from _merge_range([row[1] for row in held], length)

        spread = max(shuffle_partitions(self.spark), min(ranges, 100_000))
        placed = strings.select("range", "strings").repartition(spread, "range").sortWithinPartitions("range")
        return map_partition(placed, merge, fields("key binary", "a int", "b int"))

    def _joined(self, spans: DataFrame) -> DataFrame:
        return self.texts.join(spans.hint("shuffle_hash"), "key", "left").select("key", "raw", "copies", "spans")

    def results(
        self, with_text: bool = False, least_words: int = 0, length: int | None = None, spans: DataFrame | None = None
    ) -> DataFrame:
        """(key, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of each distinct text.

        Spans of fewer than ``least_words`` whole words stay. ``spans`` for strings of another
        ``length`` can take the place of the own ones.
        """
        length = length or self.length

        def rows(columns):
            out = []
            for key, raw, copies, found in zip(*(columns[c].to_pylist() for c in ("key", "raw", "copies", "spans"))):
                a, b = _repeated(raw, copies, found, length)
                if least_words:
                    enough = _words_in(raw, a, b) >= least_words
                    a, b = a[enough], b[enough]
                cuts = [0, *np.stack((a, b), axis=1).ravel().tolist(), len(raw)]
                kept = b"".join(raw[x:y] for x, y in zip(cuts[::2], cuts[1::2]))
                row = (key, len(raw), len(raw) - len(kept), len(a), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "ignore")) if with_text else row)
            return dict(zip(schema.names, zip(*out)))

        kept = ["kept string"] if with_text else []
        schema = fields(
            "key binary", "n_bytes bigint", "n_removed bigint", "n_spans bigint", "kept_sha256 string", *kept
        )
        return map_batches(self._joined(self.spans if spans is None else spans), rows, schema, most=500)

    def regions(self, longer: int) -> DataFrame:
        """(key, n_passage_words, a, text): words in passages of each text, and its long regions.

        A region is a maximal repeated span of at least ``longer`` bytes: any longer string that
        repeats lies in one, here and elsewhere. Texts without regions have a row without one.
        """
        length = self.length

        def rows(columns):
            out = {name: [] for name in schema.names}
            for key, raw, copies, found in zip(*(columns[c].to_pylist() for c in ("key", "raw", "copies", "spans"))):
                a, b = _repeated(raw, copies, found, length)
                words = _words_in(raw, a, b)
                a, b = _repeated(raw, 1, found, length)  # what copies repeat anyway needs no regions
                long = [(x, raw[x:y]) for x, y in zip(a.tolist(), b.tolist()) if y - x >= longer] or [(None, None)]
                out["key"] += [key] * len(long)
                out["n_passage_words"] += [int(words[words >= PASSAGE_WORDS].sum())] * len(long)
                out["a"] += [x for x, _ in long]
                out["piece"] += [y for _, y in long]
            return out

        schema = fields("key binary", "n_passage_words bigint", "a int", "piece binary")
        made = map_batches(self._joined(self.spans), rows, schema, most=500)
        return made.select("key", "n_passage_words", "a", F.col("piece").cast("string").alias("text"))

    def whole_spans(self) -> DataFrame:
        """(key, spans) with copies taken into account: a text that occurs again is one span."""
        whole = F.array(F.struct(F.lit(0).alias("a"), F.octet_length("raw").alias("b")))
        again = (F.col("copies") > 1) & (F.octet_length("raw") >= self.length)
        joined = self._joined(self.spans)
        return joined.select("key", F.when(again, whole).otherwise(F.col("spans")).alias("spans")).where("spans is not null")

    def forget(self) -> None:
        """Take the table of texts out of the catalog. Its files stay in the shared folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _repeated(raw: bytes, copies: int, spans: list | None, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal repeated spans of a text; all of it if the text itself occurs again."""
    if copies > 1 and len(raw) >= length:
        return np.array([0]), np.array([len(raw)])
    pairs = np.array([(s["a"], s["b"]) for s in spans or []], np.int64).reshape(-1, 2)
    return merge_spans(pairs[:, 0], pairs[:, 1])


def _words_in(raw: bytes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that lie whole in each span."""

    def splits_word(at: int) -> bool:
        return 0 < at < len(raw) and not (raw[at - 1 : at].isspace() or raw[at : at + 1].isspace())

    counts = [
        max(0, len(raw[x:y].split()) - splits_word(x) - splits_word(y)) for x, y in zip(a.tolist(), b.tolist())
    ]
    return np.array(counts, np.int64)


_FOUND = fields("key binary", "a int", "b int", "range bigint", "strings binary")
_STRING = np.dtype([("h1", "<i8"), ("h2", "<i8"), ("start", "<i4"), ("key", "V16")])


def _met_again(held: list[tuple], length: int) -> list[tuple]:
    """The runs of a shard, cut to starts whose strings may have an equal: without anchor and ``ahead``.

    Equal strings have their anchor at the same distance. All strings of one run with distances
    from ``low`` to ``high`` hold the bytes from ``low`` before the anchor on to the end of the one
    with distance ``high``; where no other run of the anchor has the same bytes there, none of
    them has an equal. Runs of hot anchors stay whole, as their equals may be in other shards.
    """
    most = length - gram_size(length)
    step = -(-(most + 1) // PARTS)
    digest, mask = xxhash.xxh3_64_intdigest, (1 << 64) - 1
    seen: dict[int, int] = {}
    marks = []
    for _, _, first, last, _, hot, anchor, ahead, piece in held:
        own = []
        if not hot:
            for low in range((ahead - (last - first) + 1) // step * step, ahead + 1, step):
                same = piece[ahead - low : ahead - low - step + 1 + length]
                mark = digest(same, (anchor + low) & mask)
                seen[mark] = seen.get(mark, 0) + 1
                own.append((low, mark))
        marks.append(own)
    out = []
    for (shard, key, first, last, n, hot, _, ahead, piece), own in zip(held, marks):
        if hot:
            out.append((shard, key, first, last, n, hot, piece))
            continue
        kept: list[list[int]] = []  # stretches of starts, counted from the first
        for low, mark in reversed(own):  # the largest distance is that of the first start
            if seen[mark] > 1:
                a, b = max(0, ahead - low - step + 1), min(last - first, ahead - low + 1)
                if kept and kept[-1][1] == a:
                    kept[-1][1] = b
                else:
                    kept.append([a, b])
        out += [(shard, key, first + a, first + b, n, hot, piece[a : b + length - 1]) for a, b in kept]
    return out


def _search_shard(held: list[tuple], length: int, ranges: int) -> Iterator[dict]:
    """Spans that repeat inside a shard, and the sorted strings of its hot runs, cut into ranges."""
    if not held:
        return
    sizes = np.array([last - first for _, _, first, last, _, _, _ in held], np.int64)
    raw = np.frombuffer(b"".join(row[6] for row in held), np.uint8)
    begins = np.cumsum([0, *(len(row[6]) for row in held)])[:-1]
    owner = np.repeat(np.arange(len(held)), sizes)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    starts = begins[owner] + inside
    firsts = np.array([row[2] for row in held], np.int64)
    single = np.array([row[4] == 1 for row in held])
    hot = np.array([row[5] for row in held])
    number = equal_strings(raw, starts, length)
    counts = np.bincount(number)
    again = (counts[number] > 1) & single[owner]
    at = firsts[owner] + inside  # position in the own text
    hits = np.flatnonzero(again)
    if len(hits):
        new = np.append(True, (owner[hits][1:] != owner[hits][:-1]) | (np.diff(hits) != 1))
        low = hits[new]
        high = hits[np.append(np.flatnonzero(new)[1:], len(hits)) - 1]
        nothing = [None] * len(low)
        yield {
            "key": [held[i][1] for i in owner[low]], "a": at[low], "b": at[high] + length,
            "range": nothing, "strings": nothing,
        }
    if hot.any():
        some = np.flatnonzero(hot[owner])
        some = some[np.unique(number[some], return_index=True)[1]]  # each distinct string once
        sent = np.empty(len(some), _STRING)
        sent["h1"], sent["h2"] = _string_digests(raw, starts[some], length)
        # A string known to repeat is sent along so that others find it, without a start.
        known = (counts[number[some]] > 1) | ~single[owner[some]]
        sent["start"] = np.where(known, -1, at[some])
        sent["key"] = np.frombuffer(b"".join(held[i][1] for i in owner[some]), "V16")
        sent = sent[np.lexsort((sent["h2"], sent["h1"]))]
        share = (sent["h1"] >> 32) + (1 << 31)  # 32 bits, in the order of the digests
        cuts = np.searchsorted(share * ranges >> 32, np.arange(ranges + 1))
        filled = np.flatnonzero(np.diff(cuts))
        nothing = [None] * len(filled)
        yield {
            "key": nothing, "a": nothing, "b": nothing, "range": filled,
            "strings": [sent[cuts[r] : cuts[r + 1]].tobytes() for r in filled],
        }


def _merge_range(lists: list[bytes], length: int) -> Iterator[dict]:
    """Spans of strings that more than one of the sorted lists has.

    Each list holds a string once, so all are looked up in the merged order by binary search: a
    string found more than once there is in another list.
    """
    strings = np.concatenate([np.frombuffer(x, _STRING) for x in lists])
    pairs = np.empty(len(strings), dtype=[("h1", np.int64), ("h2", np.int64)])
    pairs["h1"], pairs["h2"] = strings["h1"], strings["h2"]
    merged = np.sort(pairs)
    places = np.searchsorted(merged, pairs, "right") - np.searchsorted(merged, pairs, "left")
    found = strings[(places > 1) & (strings["start"] >= 0)]
    if not len(found):
        return
    raw_keys = found["key"].tobytes()
    keys = [raw_keys[i : i + 16] for i in range(0, len(raw_keys), 16)]
    rows = sorted(zip(keys, found["start"].tolist()))
    first = [k for k in range(len(rows)) if not k or rows[k - 1] != (rows[k][0], rows[k][1] - 1)]
    last = [k - 1 for k in first[1:]] + [len(rows) - 1]
    yield {
        "key": [rows[k][0] for k in first], "a": [rows[k][1] for k in first],
        "b": [rows[k][1] + length for k in last],
    }


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    passage_bytes: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is each byte covered by a string of ``length`` bytes that also starts elsewhere, in
    the same text or another; overlaps count, matches never cross texts, and all strings are
    judged on the input. Texts are UTF-8 bytes, a null one is empty. Rows with the same text
    repeat each other whatever their ids; texts shorter than ``length`` are left as they are; an
    empty table gives no rows; other columns are not read.

    With ``passage_bytes``, below ``length``, repeated strings of that size are found first, and
    n_passage_words says how many words lie whole in repeated spans of ``PASSAGE_WORDS`` words or
    more. Strings of ``length`` are then looked for in those spans only, where all of them lie.
    """
    keyed = docs.select(F.col(id_col).alias("_id"), text_key().alias("key"))
    if passage_bytes is None:
        passages = Passages(docs, length, shard_bytes)
        found = write_once(passages.results(), "kept_texts")
    else:
        passages = Passages(docs, passage_bytes, shard_bytes)
        regions = write_once(passages.regions(length), "regions")
        inner = Passages(regions.where("a is not null").select("text"), length, shard_bytes)
        located = regions.where("a is not null").select(F.col("key").alias("_key"), "a", text_key().alias("key"))
        spans = located.join(write_once(inner.whole_spans(), "region_spans"), "key").select(
            F.col("_key").alias("key"),
            F.explode(F.transform("spans", lambda s: F.struct((s["a"] + F.col("a")).alias("a"), (s["b"] + F.col("a")).alias("b")))).alias("s"),
        )
        spans = spans.groupBy("key").agg(F.collect_list("s").alias("spans"))
        words = regions.groupBy("key").agg(F.max("n_passage_words").alias("n_passage_words"))
        found = write_once(passages.results(length=length, spans=spans).join(words, "key"), "kept_texts")
        inner.forget()
    passages.forget()
    return lookup_join(keyed, found, "key", "inner", fits=False).drop("key").withColumnRenamed("_id", id_col)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, least_words: int = 0
) -> DataFrame:
    """``docs`` with each text cut to what is not repeated, and a column n_removed (bytes).

    Repeated spans of fewer than ``least_words`` whole words stay. A character of which a byte
    goes, goes. A column of ``docs`` named n_removed is replaced.
    """
    passages = Passages(docs, length, shard_bytes)
    cut = passages.results(with_text=True, least_words=least_words).where("n_removed > 0")
    cut = write_once(cut.toDF(*(f"_cut_{c}" for c in cut.columns)), "kept_texts")
    passages.forget()
    columns = [c for c in docs.columns if c != "n_removed"]
    keyed = docs.select(*columns, text_key().alias("_cut_key"))
    joined = keyed.join(cut.select("_cut_key", "_cut_kept", "_cut_n_removed"), "_cut_key", "left")
    text = F.coalesce("_cut_kept", "text").alias("text")
    removed = F.coalesce("_cut_n_removed", F.lit(0).cast("bigint")).alias("n_removed")
    return joined.select(*(text if c == "text" else F.col(c) for c in columns), removed)
