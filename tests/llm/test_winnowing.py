import re

import pytest

from fleetpulse.llm import winnowing
from tests.llm import cases


def plain(docs, bench, window=10):
    def words(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)

    windows = {}
    for item, text in bench:
        w, item = words(text), "" if item is None else str(item)
        if w and len(w) < window:
            windows.setdefault(tuple(w), set()).add(item)
        for i in range(len(w) - window + 1):
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for size in set(map(len, windows)):
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    items |= found
        out.append((doc, len(w), len(hit), len(items), tuple(sorted(items)), bool(hit)))
    return out


def bench(spark):
    a, b = cases.prose(20, 40), cases.prose(21, 12)
    return [
        (1, a), (2, b), (2, b + " tail"), (3, None), (None, cases.prose(3, 30)), (4, ""), (5, "One"),
        (6, "a b c"), (7, "Ünder the Bridge 42"), (8, a[: len(a) // 2]), (9, "x x x x x x x x x x x x"),
    ]


def documents():
    a, b = cases.prose(20, 40), cases.prose(21, 12)
    return cases.rows() + [
        (30, "start " + a + " end", None, None, 0), (31, a.upper().replace(" ", ", "), None, None, 0),
        (32, " ".join(a.split()[5:15]) + " and " + " ".join(a.split()[5:14]), None, None, 0),
        (33, b + " " + b + " " + b, None, None, 0), (34, "x " * 40, None, None, 0),
        (35, "ünder the bridge 42", None, None, 0),
    ]


@pytest.mark.parametrize("block_bytes", [winnowing.BLOCK_BYTES, 300])
def test_equals_plain_version(spark, block_bytes):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(documents(), cases.DOCS)
    for name in cases.CLASHING:
        docs = docs.withColumn(name, F.lit(name))
    items = spark.createDataFrame(bench(spark), "item_id bigint, text string").withColumn("item", F.lit(1))
    found = winnowing.decontaminate(docs, items, block_bytes=block_bytes)
    ours = [(r[0], r[1], r[2], r[3], tuple(r[4]), r[5]) for r in found.collect()]
    expected = plain([(r[0], r[1]) for r in documents()], bench(spark))
    assert sorted(ours, key=str) == sorted(expected, key=str)


def test_empty_tables(spark):
    docs, none = cases.edge(spark), spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in winnowing.decontaminate(docs, none).collect()} == {0}
    items = spark.createDataFrame(bench(spark), "item_id bigint, text string")
    assert winnowing.decontaminate(cases.empty(spark), items).collect() == []


def test_one_block_of_the_benchmark_at_a_time(spark, monkeypatch):
    sent, kept = [], []
    real = type(spark.sparkContext).broadcast

    def broadcast(self, value):
        made = real(self, value)
        if isinstance(value, winnowing.Index):
            assert len(sent) == len(kept), "the block before is gone"
            sent.append(value)
            destroy = made.destroy
            made.destroy = lambda *a: kept.append(value) or destroy(*a)
        return made

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    items = spark.createDataFrame(bench(spark), "item_id bigint, text string")
    docs = spark.createDataFrame(documents(), cases.DOCS)
    found = winnowing.find_spans(docs, items, block_bytes=300)
    assert found.columns == [*docs.columns, "n_words", "hit_starts", "hit_ends", "items"]
    assert len(sent) == len(kept) >= 5
    assert found.where("size(items) > 0").count() > 3
