import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm import simhash
from fleetpulse.llm.components import component_roots
from tests.llm import cases


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, most):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= most:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("block", [simhash.BLOCK, 2])
def test_equals_plain_version(spark, block):
    docs = cases.edge(spark)
    found = simhash.near_duplicates(docs, block=block).collect()
    given_rows = cases.rows()
    fps = [plain_fingerprint(r[1]) for r in given_rows]
    groups = plain_components(fps, 4)
    expected = []
    for row, fp, group in zip(given_rows, fps, groups):
        ids = [r[0] for r, g in zip(given_rows, groups) if g == group and r[0] is not None]
        expected.append((row[0], f"{fp:016x}", min(ids, default=None)))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert simhash.near_duplicates(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("block", [simhash.BLOCK, 50])
def test_finds_all_links_of_dense_groups(spark, block):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = set(rng.integers(0, 1 << 63, 200, dtype=np.uint64).tolist())
    for c in centre.tolist():
        for _ in range(150):
            x = c
            for b in rng.choice(64, rng.integers(0, 5), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp bigint")
    layout = simhash.choose_layout(*simhash.bit_counts(df))
    links = simhash.links(df, layout, block=block)
    made = {r["node"]: r["root"] for r in component_roots(links).collect()}
    ours = {}
    for x in fps:
        signed = x - (1 << 64) if x >> 63 else x
        ours.setdefault(made.get(signed, signed), set()).add(x)
    theirs = {}
    for x, g in zip(fps, plain_components(fps, 4)):
        theirs.setdefault(g, set()).add(x)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


@given(st.integers(1, 10**10), st.floats(0.01, 0.5), st.integers(0, 7))
@settings(max_examples=25, deadline=None)
def test_every_layout_keeps_the_pigeonhole(rows, p, most):
    both = np.full((64, 64), p * p * rows)
    np.fill_diagonal(both, p * rows)
    layout = simhash.choose_layout(rows, both, most) if most else None
    if layout:
        assert sorted(b for g in layout.groups for b in g) == list(range(64))
        assert sum(layout.thresholds) == most - len(layout.groups) + 1


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, 100 + i) for i in range(1, 60)]
    roots = component_roots(spark.createDataFrame([*chain, *star, (7, 7)], "a bigint, b bigint"))
    assert {r["root"] for r in roots.collect()} == {1, 100}
    assert roots.count() == 59 + 59
