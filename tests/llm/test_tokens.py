import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetpulse.llm import huffman, tokens
from fleetpulse.session import work_path
from tests.llm import cases

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}


@pytest.mark.parametrize("kind", FILES)
def test_ids_of_the_library(kind):
    path = public_tokenizers.path(FILES[kind])
    library, rng = Tokenizer.from_file(path), random.Random(1)
    texts = [r[1] or "" for r in cases.rows()]
    plain = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(161, 0x180)]]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    texts += ["".join(c + "a" for c in plain), "".join("A" + c for c in plain), " ".join(plain)]
    texts += ["don't we'll I'VE 12 345  x\u0085y z", "a<|startoftext|>b", "İstanbul ΣΑΣ Ⱥ é"]
    got = tokens.encoder(kind, path).encode(texts)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_word_encoder_forgets_without_harm(monkeypatch):
    monkeypatch.setattr(tokens, "_MOST_CHUNKS", 5)
    path = public_tokenizers.path(FILES["word"])
    encoder, library = tokens.WordEncoder(path), Tokenizer.from_file(path)
    for k in range(6):
        text = cases.prose(k, 20)
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def kraft(lengths):
    return sum(2.0 ** -int(x) for x in lengths if x)


@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=300), st.integers(9, 16))
@settings(max_examples=60, deadline=None)
def test_codes_are_complete_limited_and_prefix_free(counts, limit):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, limit)
    used = counts > 0
    assert ((lengths > 0) == used).all() and lengths.max(initial=0) <= limit
    if used.sum() > 1:
        assert kraft(lengths) == pytest.approx(1.0)
    codes = huffman.canonical_codes(lengths)
    words = sorted(format(codes[i], f"0{lengths[i]}b") for i in np.flatnonzero(used))
    assert not any(b.startswith(a) for a, b in zip(words, words[1:]))


def test_lengths_are_optimal_without_a_limit_in_the_way():
    import heapq

    counts = np.random.default_rng(3).integers(1, 1000, 200)
    heap = [(int(c), i, (i,)) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    bits, n = np.zeros(200, int), 200
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for i in a[2] + b[2]:
            bits[i] += 1
        heapq.heappush(heap, (a[0] + b[0], n, a[2] + b[2]))
        n += 1
    assert (counts * huffman.code_lengths(counts)).sum() == (counts * bits).sum()


@given(st.lists(st.integers(0, 40), max_size=2000))
@settings(max_examples=40, deadline=None)
def test_stretches_round_trip(ids):
    ids = np.array(ids, dtype=np.int64)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=50))
    bits, marks = huffman.encode(ids, lengths, huffman.canonical_codes(lengths))
    sizes = huffman._stretches(len(ids))
    table = huffman.decoding_table(lengths)
    assert huffman.decode(bits, marks, sizes, table).tolist() == ids.tolist()
    for k in range(len(marks)):  # a reader can start at any checkpoint
        some = huffman.decode(bits, marks[k:], sizes[k:], table)
        assert some.tolist() == ids[k * huffman.STRIDE :].tolist()


def test_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 100)
    path = public_tokenizers.path(FILES["word"])
    made = tokens.tokenize(cases.edge(spark), path, "word", 2)
    folder = work_path(spark, "test_files")
    huffman.write_files(made, 2, tokens.vocabulary_size(path), folder)
    rows = sorted(huffman.read_files(spark, folder).collect(), key=lambda r: r["start"])
    library = Tokenizer.from_file(path)
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in cases.rows()]
    got = [(r["_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    ids = [-1 if r["_id"] is None else r["_id"] for r in rows]
    assert ids == sorted(ids)
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n"] for r in rows)])[:-1].tolist()
    assert all(zlib.crc32(r["ids"]) is not None and r["n"] * 4 == len(r["ids"]) for r in rows)


def test_no_rows(spark):
    path = public_tokenizers.path(FILES["word"])
    folder = work_path(spark, "no_files")
    huffman.write_files(tokens.tokenize(cases.empty(spark), path, "word", 2), 2, 50_000, folder)
    assert huffman.read_files(spark, folder).collect() == []
