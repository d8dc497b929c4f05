import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm import middles
from tests.llm import cases


def plain(doc_id, text):
    """The contract, word for word, on code points."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def test_equals_plain_version(spark):
    rows = cases.rows()
    marks = [(100 + i, f"a<{m}>b" * 3, None, None, None) for i, m in enumerate("PSMXp")]
    near = [(200 + i, "<P" * 9 + "<" + "S>" * 9 + "<M<", None, None, None) for i in range(40)]
    docs = cases.edge(spark).select("doc_id", "text", "n", "kept", "raw", "key")
    more = spark.createDataFrame([*marks, *near], cases.DOCS).select("doc_id", "text")
    for name in ("n", "kept", "raw", "key"):
        more = more.selectExpr("*", f"'own' AS {name}")
    found = middles.restored(middles.rearranged(docs.unionByName(more))).collect()
    expected = [(r[0], *plain(r[0], r[1]), r[1] or "") for r in [*rows, *marks, *near]]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert middles.rearranged(cases.empty(spark)).collect() == []


@given(st.text(alphabet="aé日\U0001f600<PSM>", max_size=60), st.integers(0, 10**9))
@settings(max_examples=300, deadline=None)
def test_round_trip(text, doc_id):
    raw = text.encode()
    n, form, _, _, output = middles.rearrange(raw, str(doc_id))
    assert n == len(text) and middles.restore(output, form) == raw
    assert output.decode() == plain(doc_id, text)[4]


@pytest.mark.parametrize(
    "text, kind",
    [
        ("a" * 200_000, middles.RunContainer),
        ("é" * 100_000, middles.BitmapContainer),
        ("é" * 1000, middles.ArrayContainer),
        ("日a" * 60_000, middles.BitmapContainer),
        ("a" * 500 + "日" * 30_000 + "b" * 70_000, None),
    ],
)
def test_select_in_every_container(text, kind):
    points = middles.Boundaries(text.encode())
    assert points.count == len(text)
    if kind:
        assert isinstance(points.containers[0], kind)
    offsets = np.cumsum([0, *(len(c.encode()) for c in text)])
    ks = sorted({0, 1, len(text) - 1, len(text), *np.random.default_rng(1).integers(0, len(text), 500).tolist()})
    assert points.select(ks) == offsets[ks].tolist()
