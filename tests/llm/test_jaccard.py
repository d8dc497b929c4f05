import random
import re
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm import jaccard
from fleetpulse.session import shared_dir, write_alone
from tests.llm import cases


def plain_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2)))


def plain(rows, percent=90):
    sets = [plain_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, row in enumerate(rows):
        ids = [r[0] for k, r in enumerate(rows) if find(k) == find(i) and r[0] is not None]
        out.append((row[0], len(sets[i]), min(ids, default=None) if sets[i] else row[0]))
    return sorted(map(repr, out))


def found(docs, **options):
    return sorted(repr(tuple(r)) for r in jaccard.near_sets(docs, **options).collect())


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words)


def near_copies(seed, groups=6, each=25):
    """Groups of copies edited by different shares, short texts, and one line that many texts have."""
    rng, texts = random.Random(seed), []
    line = cases.prose(99, 12)
    for g in range(groups):
        words = cases.prose(seed + g, rng.randint(5, 150)).split()
        texts += [edited(rng, words, rng.choice((0, 0.005, 0.01, 0.02, 0.04))) for _ in range(each)]
    texts += [line + " " + cases.prose(seed + 50 + i, 1 + i % 3) for i in range(60)]
    texts += [rng.choice(("a", "b", "a b", "A  b", "a b c", "a b c d")) for _ in range(30)]
    return [(i, t, None, None, None) for i, t in enumerate(texts)]


def test_cases_equal_plain_version(spark):
    assert found(cases.edge(spark)) == plain(cases.rows())
    assert jaccard.near_sets(cases.empty(spark)).collect() == []
    blank = spark.createDataFrame([(1, " "), (2, None), (None, "")], "doc_id bigint, text string")
    assert found(blank) == sorted(map(repr, [(1, 0, 1), (2, 0, 2), (None, 0, None)]))


@pytest.mark.parametrize("seed, small, block, counters", [(1, 64, 2048, jaccard.COUNTERS), (2, 5, 7, 16), (3, 1, 2048, 1 << 16)])
def test_near_copies_equal_plain_version(spark, seed, small, block, counters):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, cases.DOCS).repartition(3)
    assert found(docs, small=small, block=block, counters=counters) == plain(rows)


@given(st.integers(0, 10**6), st.sampled_from([1, 2, 3, 5]), st.sampled_from([50, 80, 90]))
@settings(max_examples=60, deadline=None)
def test_similar_sets_share_their_prefixes(seed, matches, percent):
    rng = np.random.default_rng(seed)
    a = rng.choice(200, rng.integers(5, 80), replace=False)
    keep = a[rng.random(len(a)) < rng.uniform(0.7, 1)]
    b = np.union1d(keep, rng.choice(200, rng.integers(0, 6), replace=False) + 1000)
    union, shared = len(np.union1d(a, b)), len(np.intersect1d(a, b))
    if 100 * shared >= percent * union:
        order = rng.permutation(1300)
        heads = []
        for s in (a, b):
            s = sorted(s.tolist(), key=order.__getitem__)
            heads.append(set(s[: len(s) - jaccard.least_overlap(len(s), percent) + matches]))
        least = [min(matches, jaccard.least_overlap(len(s), percent)) for s in (a, b)]
        heads = [h if m == matches else set(sorted(s.tolist(), key=order.__getitem__)[: len(s) - jaccard.least_overlap(len(s), percent) + m]) for h, m, s in zip(heads, least, (a, b))]
        needed = jaccard.enough(least[0], len(a), least[1], len(b), percent)
        assert len(heads[0] & heads[1]) >= needed >= min(least)


def test_more_matches_where_shingles_are_frequent():
    rare, frequent = np.full(300, jaccard.CHANCE), np.full(300, 40.0)
    assert jaccard.choose_matches(31, 270, rare) < jaccard.choose_matches(31, 270, frequent)
    assert jaccard.choose_matches(1, 1, np.ones(1)) == 1


def test_whole_sets_are_not_stored(spark):
    """What lies in the shared folder afterwards is far smaller than eight bytes for each shingle of a text."""
    rows = [(i, cases.prose(1000 + i, 3000), None, None, None) for i in range(20)]
    rows += [(20 + i, text + " more", None, None, None) for i, (_, text, *_) in enumerate(rows[:5])]
    docs = spark.createDataFrame(rows, cases.DOCS)
    tables = Path(shared_dir(spark).removeprefix("file:")) / "fleetpulse"
    before = set(tables.glob("*"))
    got = {r.doc_id: r for r in jaccard.near_sets(docs, counters=1 << 10).collect()}
    assert [got[20 + i].component_id for i in range(5)] == list(range(5))
    made = set(tables.glob("*")) - before
    assert {p.name.rsplit("-", 1)[0] for p in made} == {"prefixes", "buckets", "roots", "components_of_sets"}
    stored = sum(f.stat().st_size for p in made for f in p.rglob("*.parquet"))
    assert stored < 4 * sum(r.n_shingles for r in got.values())


def test_setting_for_shuffle_files_is_put_back(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    within = []

    def make():
        within.append(spark.conf.get(setting))
        return spark.range(5).repartition(3)

    assert write_alone(spark, make, "rows").count() == 5
    assert within == ["true"] and spark.conf.get(setting) == before
