"""Benchmark decontamination by winnowing.

From each window of consecutive k-gram hashes the smallest is kept as a fingerprint, in training
documents and in benchmark items alike. A shared span of ``window`` words contains a whole window
of grams, so both sides keep the same gram of it: no such span is missed. Fingerprints that meet
are extended word by word to the longest shared span, and spans shorter than a window are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, fields, map_partition, merge_spans, text_key
from fleetpulse.operators.distribute import lookup_join
from fleetpulse.session import write_once

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10  # words
GRAM = 5  # words of a fingerprint; grams in a window: WINDOW - GRAM + 1
BLOCK_BYTES = 16 << 20  # benchmark text held by a task at a time
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_NO = np.empty(0, np.int64)


def words_of(text: str | None) -> list[bytes]:
    return WORDS.findall((text or "").encode().translate(_LOWER))


def gram_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` word numbers."""
    if len(ids) < size:
        return np.empty(0, np.uint64)
    x = (ids + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    n = len(ids) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + x[i : i + n]
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash of every window, the last one on a tie."""
    if len(hashes) < window:
        return _NO
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    at = np.arange(len(views)) + window - 1 - views.argmin(axis=1)
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1]
    return at[first]


@dataclass
class Index:
    """A block of the benchmark: word numbers, item texts as numbers, fingerprints and where."""

    window: int = WINDOW
    gram: int = GRAM
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    items: list[str] = field(default_factory=list)
    texts: list[np.ndarray] = field(default_factory=list)
    prints: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    where: np.ndarray = field(default_factory=lambda: np.empty((0, 2), np.int64))
    short: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @staticmethod
    def build(rows: list[tuple[str, str | None]], window: int = WINDOW, gram: int = GRAM) -> Index:
        index = Index(window, gram)
        prints, where, short = [], [], {}
        for item, text in rows:
            numbers = [index.vocabulary.setdefault(w, len(index.vocabulary)) for w in words_of(text)]
            if not numbers:
                continue
            number, ids = len(index.items), np.array(numbers, np.int64)
            index.items.append(item)
            index.texts.append(ids)
            if len(ids) < window:  # such an item is one window: its whole hash is the fingerprint
                short.setdefault(len(ids), []).append((gram_hashes(ids, len(ids))[0], number))
                continue
            hashes = gram_hashes(ids, gram)
            at = winnow(hashes, window - gram + 1)
            prints.append(hashes[at])
            where.append(np.stack((np.full(len(at), number), at), axis=1))
        if prints:
            flat, places = np.concatenate(prints), np.concatenate(where)
            order = np.argsort(flat, kind="stable")
            index.prints, index.where = flat[order], places[order]
        for size, pairs in short.items():
            pairs.sort()
            index.short[size] = (
                np.array([h for h, _ in pairs], np.uint64),
                np.array([n for _, n in pairs], np.int64),
            )
        return index

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, set[str]]:
        """Spans of the words that lie in an occurring window, and the items of those windows."""
        if not words or not self.items:
            return _NO, _NO, set()
        number = self.vocabulary.get
        ids = np.fromiter((number(w, -1) for w in words), np.int64, len(words))
        starts, ends, items = [], [], set()
        if len(self.prints) and len(ids) >= self.window:
            hashes = gram_hashes(ids, self.gram)
            at = winnow(hashes, self.window - self.gram + 1)
            low = np.searchsorted(self.prints, hashes[at], "left")
            high = np.searchsorted(self.prints, hashes[at], "right")
            met = high > low
            done: dict[tuple[int, int], int] = {}  # by item and diagonal: end of the last span
            for p, a, b in zip(at[met].tolist(), low[met].tolist(), high[met].tolist()):
                for item, q in self.where[a:b].tolist():
                    if done.get((item, p - q), -1) > p:
                        continue
                    first, last = self._extend(ids, p, self.texts[item], q)
                    done[(item, p - q)] = last
                    if last - first >= self.window:
                        starts.append(first)
                        ends.append(last)
                        items.add(self.items[item])
        for size, (hashes, numbers) in self.short.items():
            own = gram_hashes(ids, size)
            low = np.searchsorted(hashes, own, "left")
            high = np.searchsorted(hashes, own, "right")
            for p in np.flatnonzero(high > low).tolist():
                for n in numbers[low[p] : high[p]].tolist():
                    if (ids[p : p + size] == self.texts[n]).all():
                        starts.append(p)
                        ends.append(p + size)
                        items.add(self.items[n])
        return np.array(starts, np.int64), np.array(ends, np.int64), items

    @staticmethod
    def _extend(ids: np.ndarray, p: int, text: np.ndarray, q: int) -> tuple[int, int]:
        n = min(len(ids) - p, len(text) - q)
        differ = ids[p : p + n] != text[q : q + n]
        right = int(differ.argmax()) if differ.any() else n
        n = min(p, q)
        differ = ids[p - n : p][::-1] != text[q - n : q][::-1]
        left = int(differ.argmax()) if differ.any() else n
        return p - left, p + right


_KEY = "_text_key"
_RESULT = ("n_words bigint", "hit_starts array<bigint>", "hit_ends array<bigint>", "items array<string>")


def find_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    window: int = WINDOW,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its columns, n_words, hit spans in words, and the items found.

    The benchmark goes to the tasks in blocks of measured size. Beyond one block, what a block
    hits is stored, by text, before the next is collected and sent, so driver and tasks hold one
    block at a time and any benchmark fits. Null texts have no words; items without words occur nowhere. Rows of the
    benchmark with the same item_id are one item; a null item_id is the item "". Repeated
    documents are judged each; empty tables give no hits. Columns of ``docs`` named like the
    results are replaced.
    """
    names = [n.split()[0] for n in _RESULT]
    texts = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.col("text").alias("text"),
    )
    size = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    shared = docs.sparkSession.sparkContext.broadcast

    def index_of(k: int):
        part = texts.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        return shared(Index.build(sorted((r["item"], r["text"] or "") for r in part.collect()), window, gram))

    plain = docs.drop(*names)
    if blocks == 1:
        return _search(plain, index_of(0), names)
    keyed = plain.withColumn(_KEY, text_key())
    stored = []
    for k in range(blocks):
        index = index_of(k)
        found = _search(keyed.select(_KEY, "text"), index, names).where(F.size("items") > 0)
        stored.append(write_once(found.drop("text", "n_words").dropDuplicates([_KEY]), "block_hits"))
        index.destroy()  # what it found is stored
    every = reduce(DataFrame.unionByName, stored)
    lists = (F.flatten(F.collect_list(n)).alias(n) for n in names[1:])
    merged = write_once(every.groupBy(_KEY).agg(*lists), "benchmark_hits")
    return _settle(lookup_join(keyed, merged, _KEY).drop(_KEY), names).select(*plain.columns, *names)


def _search(docs: DataFrame, index, names: list[str]) -> DataFrame:
    """The rows with what a block of the benchmark hits in them."""

    def run(batches: Batches) -> Iterator[dict]:
        block = index.value
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            out = []
            for text in columns["text"].to_pylist():
                words = words_of(text)
                starts, ends, items = block.hits(words)
                out.append((len(words), *merge_spans(starts, ends), sorted(items)))
            if out:
                yield columns | dict(zip(names, zip(*out)))

    return map_partition(docs, run, fields(*docs.schema, *_RESULT))


def _settle(docs: DataFrame, names: list[str]) -> DataFrame:
    """The rows with the number of their words, and spans and items of all blocks made one list."""
    kept = [f for f in docs.schema if f.name not in names]

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            out = []
            for text, starts, ends, items in zip(*(columns[n].to_pylist() for n in ("text", *names[1:]))):
                spans = merge_spans(np.array(starts or (), np.int64), np.array(ends or (), np.int64))
                out.append((len(words_of(text)), *spans, sorted(set(items or ()))))
            if out:
                yield columns | dict(zip(names, zip(*out)))

    return map_partition(docs, run, fields(*kept, *_RESULT))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, the items, contaminated."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col("text").alias("text"))
    found = find_spans(slim, benchmark, "_id", **options)
    hit = F.aggregate(
        F.zip_with("hit_ends", "hit_starts", lambda b, a: b - a), F.lit(0).cast("bigint"), lambda x, y: x + y
    )
    return found.select(
        F.col("_id").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        "items",
        (F.size("items") > 0).alias("contaminated"),
    )
