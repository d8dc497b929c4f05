import re

import numpy as np

from fleetpulse.llm import weak_rules
from tests.llm import cases


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(hit)


def test_counts_equal_plain_version(spark):
    found = weak_rules.quality_rules(cases.edge(spark)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    ours = sorted((str(r["doc_id"]), *(r[n] for n in names), r["base_failed"]) for r in found)
    expected = []
    for row in cases.rows():
        if row[0] in (5, 6):  # too long for the plain version
            continue
        counts = plain(row[1])
        expected.append((str(row[0]), *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    assert sorted(expected) == [r for r in ours if r[0] not in ("5", "6")]
    assert len(found) == len(cases.rows())
    assert all(not r["kept"] for r in found if r["base_failed"])
    assert weak_rules.quality_rules(cases.empty(spark)).collect() == []


def test_line_counts():
    assert weak_rules.signals("a b\na b\n \n \nc\na b")[3] == 2


def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    votes = np.zeros((len(good), len(weak_rules.RULES)), int)
    right = np.linspace(0.65, 0.95, votes.shape[1])
    for j, accuracy in enumerate(right):
        says_good = np.where(rng.random(len(good)) < accuracy, good, ~good)
        votes[:, j] = np.where(rng.random(len(good)) < 0.2, 0, np.where(says_good, 2, 1))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = weak_rules.estimate(patterns, counts.astype(float))
    assert abs(found.good - 0.8) < 0.02
    spoken = found.by_rule[:, 1, 2] / found.by_rule[:, 1, 1:].sum(axis=1)
    assert np.abs(spoken - right).max() < 0.03


def test_agrees_with_labels(spark):
    """The labels are not used by the rules; the verdict meets them nearly everywhere."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "good")
    judged = weak_rules.quality_rules(docs).where("not base_failed").join(labels, "doc_id")
    rows = judged.select("kept", "good").collect()
    assert sum(r["kept"] == (r["good"] == 1) for r in rows) >= 0.97 * len(rows)
