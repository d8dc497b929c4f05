import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetpulse.llm import packing, tokens
from tests.llm import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, window, expected):
    """Every id in one piece, pieces of a sequence without a gap, crc of the very ids."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["_id"], r["doc_tokens"]), []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
    assert sum(r["length"] for r in rows) == sum(len(ids) for _, ids in expected)
    left = [(i, len(ids), ids) for i, ids in expected]
    for r in rows:
        assert any(
            r["_id"] == i and r["doc_tokens"] == n
            and zlib.crc32(ids[r["start"] : r["start"] + r["length"]].astype("<u4")) == r["ids_crc32"]
            for i, n, ids in left
        )
    padded = sum(window - sum(r["length"] for r in pieces) for pieces in by_sequence.values())
    assert padded < window


@pytest.mark.parametrize("window", [1024, 16])
def test_packs_every_id_once(spark, window):
    library = Tokenizer.from_file(PATH)
    made = tokens.tokenize(cases.edge(spark), PATH, "byte", 0)
    rows = packing.pack(made, tokens.id_bytes(PATH), window).collect()
    expected = [
        (r[0], np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [0])) for r in cases.rows()
    ]
    check(rows, window, expected)


def test_empty_table(spark):
    made = tokens.tokenize(cases.empty(spark), PATH, "byte", 0)
    assert packing.pack(made, 2).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    window = [16, 64, 257, 1024][seed]
    histogram = rng.integers(0, 50, window) * (rng.random(window) < 0.6)
    histogram[0] = 0
    histogram[int(rng.integers(1, window))] = 5000  # a length that most pieces share
    used = {}
    numbers = {}
    for length, low, high, base, step in packing.plan(histogram):
        numbers.setdefault(length, []).append((low, high))
        for i in range(high - low):
            for at in range(base + i * step, base + i * step + length, 1):
                assert at not in used
                used[at] = length
    for length, spans in numbers.items():
        assert sorted(spans)[0][0] == 0 and sorted(spans)[-1][1] == histogram[length]
        assert sum(b - a for a, b in spans) == histogram[length]
    assert len(used) == (np.arange(window) * histogram).sum()


def test_solution_explains_a_histogram_made_of_combinations():
    window = 128
    combos = packing.combinations(np.ones(window, np.int64))
    assert {tuple(c) for c in combos.tolist()} >= {(0, 1, 127), (0, 64, 64), (42, 43, 43), (1, 1, 126)}
    rng = np.random.default_rng(1)
    chosen = combos[rng.choice(len(combos), 30, replace=False)]
    histogram = np.zeros(window, np.int64)
    np.add.at(histogram, chosen.ravel(), 100)
    histogram[0] = 0
    found = packing.solve_repeats(packing.combinations(histogram), histogram)
    fitted = np.zeros(window)
    np.add.at(fitted, packing.combinations(histogram).ravel(), np.repeat(found, 3))
    assert (found >= 0).all()
    assert np.abs(fitted[1:] - histogram[1:]).sum() < 0.05 * histogram.sum()
