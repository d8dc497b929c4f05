import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm import suffix
from tests.llm import cases


def plain(rows, length):
    raws = [(r[0], (r[1] or "").encode()) for r in rows]
    counts = Counter(hash(raw[p : p + length]) for _, raw in raws for p in range(len(raw) - length + 1))
    out = []
    for doc, raw in raws:
        change = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - length + 1):
            if counts[hash(raw[p : p + length])] > 1:
                change[p] += 1
                change[p + length] -= 1
        gone = np.cumsum(change)[: len(raw)] > 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    return sorted(((r["doc_id"], *r[1:]) for r in df.collect()), key=str)


@pytest.mark.parametrize("length, shard_bytes", [(400, suffix.SHARD_BYTES), (60, 2000)])
def test_equals_plain_version(spark, length, shard_bytes):
    found = suffix.deduplicate(cases.edge(spark), length=length, shard_bytes=shard_bytes)
    assert rows_of(found) == sorted(plain(cases.rows(), length), key=str)


def test_one_passage_in_many_documents(spark):
    """A hot anchor: more distinct surroundings than a shard holds, dealt out and merged again."""
    passage = cases.prose(1, 30)
    rows = [(i, f"{cases.prose(100 + i, 25)} {passage} {cases.prose(900 + i, 25)}") for i in range(60)]
    rows += [(100, passage * 3), (101, cases.prose(77, 60)), (102, cases.prose(100, 25)[20:] + passage)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = suffix.deduplicate(docs, length=80, shard_bytes=1500)
    assert rows_of(found) == sorted(plain(rows, 80), key=str)


def test_empty_and_short(spark):
    assert suffix.deduplicate(cases.empty(spark)).collect() == []
    docs = spark.createDataFrame([(1, "short"), (2, "short"), (3, None)], "doc_id bigint, text string")
    assert {r["n_removed"] for r in suffix.deduplicate(docs).collect()} == {0}


def test_remove_repeats_keeps_columns_and_whole_characters(spark):
    text = "é" * 300 + cases.prose(5, 20)
    rows = [(1, "a" + text), (2, "é" + text[:250] + "zz"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS key", "1 AS kept")
    found = {r["doc_id"]: r for r in suffix.remove_repeats(docs).collect()}
    assert found[3]["text"] is None and found[3]["n_removed"] == 0
    assert {r["key"] for r in found.values()} == {"x"} and found[1]["kept"] == 1
    for row in plain(rows, 400):
        assert found[row[0]]["n_removed"] == row[2]
    assert "é" not in found[1]["text"][1:] and found[1]["text"].endswith(cases.prose(5, 20)[-20:])


texts = st.lists(st.sampled_from([b"a", b"b", b"ab", b"aab", b"abaab" * 4, b"\x00", b"\xff"]), max_size=60)


@given(texts, st.sampled_from([3, 8, 11, 24, 50]))
@settings(max_examples=120, deadline=None)
def test_equal_strings(parts, length):
    raw = np.frombuffer(b"".join(parts) + b"a" * length, np.uint8)
    starts = np.arange(len(raw) - length + 1)
    number = suffix.equal_strings(raw, starts, length)
    strings = [raw[s : s + length].tobytes() for s in starts]
    pairs = set(zip(strings, number.tolist()))
    assert len(pairs) == len(set(strings)) == len(set(number.tolist()))


@pytest.mark.parametrize("factor", [2, 3])
def test_common_prefixes(factor):
    raw = np.random.default_rng(2).integers(0, 2, 3000).astype(np.uint8)
    raw[1000:2000] = raw[:1000]
    depth = 8 * factor**3
    order, rank = suffix.suffix_array(raw, factor, depth)
    found = suffix.common_prefixes(raw, order, rank, depth)
    for k in range(1, len(raw)):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        n = min(len(a), len(b), depth)
        differ = np.flatnonzero(a[:n] != b[:n])
        assert found[k] == (differ[0] if len(differ) else n)
        assert a[:depth].tobytes() <= b[:depth].tobytes()


@pytest.mark.parametrize("chunk", [suffix.CHUNK, 37])  # texts together, and texts in parts
@given(raws=st.lists(st.binary(max_size=200), max_size=8), length=st.integers(2, 40))
@settings(max_examples=60, deadline=None)
def test_equal_strings_have_equal_anchors(chunk, raws, length):
    raws = raws + raws[:2]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffix, "CHUNK", chunk)
        check_anchors(raws, length)


def check_anchors(raws, length):
    anchor, seen = {}, set()
    for part in suffix.batch_runs(raws, length):
        for n, first, last, a in zip(*(part[c].tolist() for c in ("number", "first", "last", "anchor"))):
            for p in range(first, last):
                assert (n, p) not in seen
                seen.add((n, p))
                assert anchor.setdefault(raws[n][p : p + length], a) == a
    assert len(seen) == sum(max(0, len(raw) - length + 1) for raw in raws)


def plain_passages(rows, length, least):
    """Of each row: its bytes, and its repeated spans of ``least`` whole words and more, with the words."""
    raws = [(r[1] or "").encode() for r in rows]
    counts = Counter(hash(raw[p : p + length]) for raw in raws for p in range(len(raw) - length + 1))
    for raw in raws:
        change = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - length + 1):
            if counts[hash(raw[p : p + length])] > 1:
                change[p] += 1
                change[p + length] -= 1
        gone = np.cumsum(change)[: len(raw)] > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        whole = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw)]
        found = [(a, b, sum(a <= x and y <= b for x, y in whole)) for a, b in zip(edges[::2], edges[1::2])]
        yield raw, [f for f in found if f[2] >= least]


def plain_cut(rows, length, least):
    out = []
    for raw, spans in plain_passages(rows, length, least):
        cuts = [0, *(x for a, b, _ in spans for x in (a, b)), len(raw)]
        out.append(b"".join(raw[x:y] for x, y in zip(cuts[::2], cuts[1::2])).decode("utf-8", "ignore"))
    return out


def passages():
    """Passages of 60 words between prose, copies, a passage twice in a text, parts of passages."""
    shared = [cases.prose(500 + k, 60) for k in range(3)]
    rows = [(i, f"{cases.prose(600 + i, 30)}\n{shared[i % 3]} {cases.prose(700 + i, 30)}") for i in range(9)]
    rows += [(20, shared[0]), (21, shared[0]), (22, f"{shared[1]} x {shared[1]}"), (23, shared[2][:250])]
    rows += [(24, cases.prose(800, 90)), (25, cases.prose(801, 90)), (26, cases.prose(801, 90)), (27, None)]
    rows += [(28, cases.prose(800, 90)[:300] + " " + cases.prose(802, 10)), (29, "é" + shared[0][100:])]
    return rows


@pytest.mark.parametrize("length, passage_bytes", [(400, 200), (300, 100)])
def test_passages_and_longer_strings_in_them(spark, length, passage_bytes):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = suffix.deduplicate(docs, length=length, passage_bytes=passage_bytes)
    assert rows_of(found.drop("n_passage_words")) == sorted(plain(rows, length), key=str)
    words = {r["doc_id"]: r["n_passage_words"] for r in found.collect()}
    spans = plain_passages(rows, passage_bytes, suffix.PASSAGE_WORDS)
    assert words == {r[0]: sum(s[2] for s in found) for r, (_, found) in zip(rows, spans)}
    assert words[0] >= 60
    edge = suffix.deduplicate(cases.edge(spark), length=length, passage_bytes=passage_bytes)
    assert rows_of(edge.drop("n_passage_words")) == sorted(plain(cases.rows(), length), key=str)


def test_remove_only_passages_of_enough_words(spark):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["text"] for r in suffix.remove_repeats(docs, 200, least_words=50).collect()}
    assert found == {r[0]: t if r[1] else r[1] for r, t in zip(rows, plain_cut(rows, 200, 50))}
    assert any(found[doc] != text for doc, text in rows)


def shard_of(raws, length):
    """All runs of some texts as the rows of one shard."""
    rows = []
    for part in suffix.batch_runs(raws, length):
        columns = (part[c].tolist() for c in ("number", "first", "last", "anchor", "ahead"))
        rows += [(0, n, a, b, 1, False, h, d, raws[n][a : b + length - 1]) for n, a, b, h, d in zip(*columns)]
    return rows


@given(raws=st.lists(st.lists(st.sampled_from([b"a", b"ab", b"abaab", b"\x00"]), max_size=30), max_size=6), length=st.integers(1, 40))
@settings(max_examples=80, deadline=None)
def test_no_start_of_a_repeated_string_is_left_out(raws, length):
    raws = [b"".join(parts) for parts in raws]
    held = shard_of(raws, length)
    kept = suffix._met_again(held, length)
    counts = Counter(raw[p : p + length] for raw in raws for p in range(len(raw) - length + 1))
    starts = [(n, p) for _, n, a, b, *_ in kept for p in range(a, b)]
    assert len(starts) == len(set(starts)) and set(starts) <= {(r[1], p) for r in held for p in range(r[2], r[3])}
    assert all(piece == raws[n][a : b + length - 1] for _, n, a, b, _, _, piece in kept)
    assert {(n, p) for n, raw in enumerate(raws) for p in range(len(raw) - length + 1) if counts[raw[p : p + length]] > 1} <= set(starts)


def test_runs_that_share_little_more_than_their_anchor_are_not_sorted():
    """Suffix sorting is most of the work: a short common phrase must not bring its surroundings in."""
    phrase, passage = cases.prose(1, 12), cases.prose(2, 60)
    apart = [f"{cases.prose(10 + i, 60)} {phrase} {cases.prose(50 + i, 60)}".encode() for i in range(8)]
    assert suffix._met_again(shard_of(apart, 200), 200) == []
    both = [f"{cases.prose(90 + i, 60)} {passage} {cases.prose(95 + i, 60)}".encode() for i in range(2)]
    starts = sum(b - a for _, _, a, b, *_ in suffix._met_again(shard_of(apart + both, 200), 200))
    repeated = 2 * (len(passage) + 2 - 199)
    assert repeated <= starts <= repeated + 4 * 43
    hot = [(*row[:5], True, *row[6:]) for row in shard_of(apart, 200)]
    assert [row[2:4] for row in suffix._met_again(hot, 200)] == [row[2:4] for row in hot]  # their equals may be elsewhere
