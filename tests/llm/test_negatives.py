import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def floats(values):
    return None if values is None else [None if x is None else float(np.float32(x)) for x in values]


def plain(rows):
    """The contract, pair by pair, in whole numbers of any size."""
    used = []
    for n, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            moved = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            used.append((n, i, moved, [math.floor(256 * x) for x in v]))
    out = []
    for n, anchor, label, v in used:
        if anchor is None or anchor % 100:
            continue
        ranked = [(-sum(map(int.__mul__, v, w)), i is None, i or 0, m, other) for m, i, other, w in used if m != n]
        ranked.sort()
        for ps, p_null, p, _, _ in [r for r in ranked if r[4] == label][:5]:
            inside = [r for r in ranked if r[4] != label and 30 * -ps <= 100 * -r[0] <= 90 * -ps][:10]
            for rank, (ns, q_null, q, _, _) in enumerate(inside, 1):
                out.append((anchor, None if p_null else p, rank, None if q_null else q, -ps, -ns))
    return sorted(out, key=repr)


def cases_of(seed, n, dims=4, spread=0.4):
    rng = random.Random(seed)
    centres = [[rng.uniform(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([0, 1, 2, 9])) for i in range(n)]
    rows += [(100, *rows[100][1:])] * 2  # copies of an anchor
    rows += [(i, [round(x, 1) for x in rows[3][1]], 1) for i in range(n, n + 30)]  # ties
    rows += [(None, rows[5][1], 2), (None, rows[5][1], 2), (900, None, 1), (901, rows[0][1], None)]
    rows += [(902, [0.5, None, 1.0, 0.1], 1), (903, [0.5, math.nan, 1.0, 0.1], 1), (904, [math.inf, 1.0, 1.0, 0.0], 1)]
    rows += [(1000, [], 1), (1001, [1.0], 1), (1100, [0.7, 0.9], 2)]
    return [(i, floats(v), label) for i, v, label in rows]


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("id", "row", "v", "score", "anchor", "slot", "place", "block", "limits", "number"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    found = negatives.hard_negatives(negatives.relabelled(df))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("anchor_bytes", [negatives.ANCHOR_BYTES, 64])
def test_equals_plain_version(spark, monkeypatch, anchor_bytes):
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", anchor_bytes)  # 64: two anchors at a time
    monkeypatch.setattr(negatives, "BLOCK", 100)
    rows = cases_of(3, 700)
    expected = plain(rows)
    assert len(expected) > 50 and run(spark, rows) == expected


def test_very_large_components(spark):
    rows = [(0, [1e15, 1.0], 1), (1, [1e15, 2.0], 1), (2, [6e14, -3.0], 2), (3, [8.5e14, 1e6], 2), (5, [1.0, 1.0], 3)]
    rows = [(i, floats(v), label) for i, v, label in rows]
    made = run(spark, [(i, v, 0 if i == 0 else label) for i, v, label in rows])
    assert [r[3] for r in made] == []  # scores at the bound are no higher than a positive's
    rows = [(0, [1e7, 1.0], 0), (1, [1e7, 2.0], 1), (2, [6e6, -3.0], 2), (3, [8.5e6, 1e3], 2), (5, [1.0, 1.0], 3)]
    rows = [(i, floats(v), label) for i, v, label in rows]
    assert run(spark, rows) == plain(rows) != []


def test_nothing_to_find(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert run(spark, [(100, [1.0], 1), (2, [1.0], 2)]) == []  # no positive


def test_window_tops_are_merged_over_tasks():
    """Slots of two parts of the rows, merged, hold the same as those of all rows."""
    rng = np.random.default_rng(7)
    v, label = rng.integers(-50, 50, (400, 3)).astype(float), rng.integers(0, 3, 400)
    ids, null = np.arange(400), np.zeros(400, np.int64)
    anchors = {
        "row": ids[:5], "label": label[:5], "v": v[:5], "least": np.full(5, -500),
        "limits": np.array([[4000, 2000, 100]] * 5),
    }
    best = negatives.Best(anchors, 10, False)
    for part in (slice(0, 150), slice(150, 400)):
        best.add(v[part], label[part], ids[part], null[part], ids[part])
    s = negatives.scores(v[:5], v)
    for a in range(5):
        for slot, (high, low) in enumerate(((4000, 2000), (2000, 100), (100, -501))):
            fits = [(-s[a, i], i) for i in range(400) if label[i] != label[a] and low < s[a, i] <= high]
            chosen = (best.kept["anchor"] == a) & (best.kept["slot"] == slot)
            assert best.kept["id"][chosen].tolist() == [i for _, i in sorted(fits)[:10]]
