"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are estimated.

Each rule votes good, bad or abstains on a document. How often a rule votes each way on good and
on bad documents is not known beforehand: expectation-maximisation estimates it from the votes of
all documents, counted by vote pattern. The posterior probability of a good document then replaces
a filter that every rule has to pass.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import as_field, fields, map_batches
from fleetpulse.session import write_once

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
KEEP = 0.5  # documents are kept from this posterior on

# Frequent function words of the languages served. Running text has them.
STOP_WORDS = frozenset(
    """the of and to in a is that it was for on are with as be at this by from
    le la les de des du et un une en que qui dans pour pas est sur au par avec
    der die das und ist ein eine zu den von mit sich auf für im dem nicht des
    el los las del y que en un una por con para su se es al lo no""".split()
)

SIGNALS = fields(
    "n_words bigint",
    "word_chars bigint",
    "n_symbols bigint",
    "n_dup_lines bigint",
    "n_repeat_words bigint",
    "n_lines bigint",
    "n_stop bigint",
    "n_alpha_words bigint",
    "n_letters bigint",
    "n_upper bigint",
    "n_exclaims bigint",
    "n_distinct_words bigint",
)


def signals(text: str | None) -> tuple[int, ...]:
    """The counts of ``SIGNALS`` for one text. A null text has no words and no lines."""
    text = text or ""
    words = WORDS.findall(text)
    n = len(words)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    ids: dict[str, int] = {}
    codes = [ids.setdefault(w, len(ids)) for w in words]
    stops = {i for w, i in ids.items() if w.strip(".,;:!?").lower() in STOP_WORDS}
    alpha = {i for w, i in ids.items() if any(c.isalpha() for c in w)}
    flat = np.array(codes, dtype=np.int64)
    counts = np.bincount(flat, minlength=len(ids))
    upper = sum(map(str.isupper, text))
    lower = sum(map(str.islower, text)) if upper else 0
    return (
        n,
        sum(map(len, words)),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(flat, len(ids)),
        len(lines),
        int(counts[list(stops)].sum()) if stops else 0,
        int(counts[list(alpha)].sum()) if alpha else 0,
        upper + lower,
        upper,
        text.count("!"),
        len(ids),
    )


def _repeated(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three words found at least twice."""
    if len(codes) < 4:
        return 0
    pairs = codes[:-1] * distinct + codes[1:]
    pairs = np.unique(pairs, return_inverse=True)[1]  # keeps the next product within 64 bits
    _, back, counts = np.unique(pairs[:-1] * distinct + codes[2:], return_inverse=True, return_counts=True)
    again = counts[back] > 1
    hit = np.zeros(len(codes), bool)
    for shift in range(3):
        hit[shift : shift + len(again)] |= again
    return int(hit.sum())


def with_signals(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    names = SIGNALS.fieldNames()

    def rows(columns):
        counted = [signals(t) for t in columns["_text"].to_pylist()]
        return {"_id": columns["_id"], **dict(zip(names, zip(*counted)))}

    slim = docs.select(F.col(id_col).alias("_id"), F.col("text").alias("_text"))
    schema = fields(as_field(docs, id_col, "_id"), *SIGNALS)
    return map_batches(slim, rows, schema).withColumnRenamed("_id", id_col)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Bad above ``bad`` or good up to ``good`` of a ratio; the other way round if ``low_is_bad``."""

    name: str
    part: str
    whole: str
    good: float
    bad: float
    low_is_bad: bool = False

    def vote(self) -> Column:
        """2 good, 1 bad, 0 abstains. A ratio of nothing abstains."""
        ratio = F.try_divide(F.col(self.part).cast("double"), F.col(self.whole).cast("double"))
        if self.low_is_bad:
            good, bad = ratio >= self.good, ratio < self.bad
        else:
            good, bad = ratio <= self.good, ratio > self.bad
        return F.when(bad, 1).when(good, 2).otherwise(0)


RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.1),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.2, 0.5),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.15, 0.3),
    Rule("stop_words", "n_stop", "n_words", 0.1, 0.03, low_is_bad=True),
    Rule("alphabetic", "n_alpha_words", "n_words", 0.9, 0.8, low_is_bad=True),
    Rule("capitals", "n_upper", "n_letters", 0.1, 0.4),
    Rule("exclamations", "n_exclaims", "n_words", 0.05, 0.3),
    Rule("word_length", "word_chars", "n_words", 10.0, 14.0),
    Rule("short_words", "word_chars", "n_words", 3.0, 2.0, low_is_bad=True),
    Rule("variety", "n_distinct_words", "n_words", 0.2, 0.1, low_is_bad=True),
)


@dataclass(frozen=True)
class Accuracies:
    """Share of good documents, and by rule and vote its probability on bad and good ones."""

    good: float
    by_rule: np.ndarray  # rules x {bad, good} x {abstain, bad, good}


def estimate(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9
) -> Accuracies:
    """Expectation-maximisation over vote patterns (rows of 0/1/2) and how often each occurs.

    Starts from the majority of the votes, so that "good" keeps its meaning. Counts are smoothed
    by one vote, and the class share is kept within 1 to 99 percent.
    """
    n_rules = patterns.shape[1]
    total = counts.sum()
    if not total:
        return Accuracies(0.5, np.full((n_rules, 2, 3), 1 / 3))
    votes = np.stack([patterns == v for v in range(3)], axis=2).astype(float)  # pattern, rule, vote
    bad_votes = (patterns == 1).sum(axis=1)
    good = np.where(bad_votes == 0, 0.95, np.where(bad_votes == 1, 0.4, 0.05))
    share, by_rule = 0.5, None
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])  # class, pattern
        summed = np.einsum("cp,prv->rcv", weight, votes) + 1.0
        by_rule = summed / summed.sum(axis=2, keepdims=True)
        share = min(max(weight[1].sum() / total, 0.01), 0.99)
        logit = math.log(share / (1 - share)) + np.einsum(
            "prv,rv->p", votes, np.log(by_rule[:, 1] / by_rule[:, 0])
        )
        now = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        done = np.abs(now - good).max() < tolerance
        good = now
        if done:
            break
    return Accuracies(float(share), by_rule)


def posterior(accuracies: Accuracies) -> Column:
    """Probability of a good document from its vote columns."""
    logit = F.lit(math.log(accuracies.good / (1 - accuracies.good)))
    for rule, odds in zip(RULES, np.log(accuracies.by_rule[:, 1] / accuracies.by_rule[:, 0])):
        vote = F.col(f"vote_{rule.name}")
        logit = logit + F.when(vote == 2, float(odds[2])).when(vote == 1, float(odds[1])).otherwise(
            float(odds[0])
        )
    return 1 / (1 + F.exp(-logit))


def quality_rules(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its counts, votes, posterior ``quality`` and ``kept``.

    ``kept`` is false where the base rules fail, else whether the posterior reaches ``KEEP``. A
    null or empty text has zero counts, abstains on every rule and fails the base rules. Repeated
    rows are judged and counted each; an empty table gives no rows; other columns are not read.
    The accuracies come from the votes of all rows, of which only the counts by pattern (at most
    three to the power of the rules) reach the driver.
    """
    counted = with_signals(docs, id_col)
    voted = write_once(
        counted.select("*", *(r.vote().cast("int").alias(f"vote_{r.name}") for r in RULES)),
        "quality_votes",
    )
    names = [f"vote_{r.name}" for r in RULES]
    rows = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = np.array([[r[n] for n in names] for r in rows], dtype=np.int64).reshape(-1, len(names))
    accuracies = estimate(patterns, np.array([r["n"] for r in rows], dtype=float))
    return (
        voted.withColumn("base_failed", base_failed())
        .withColumn("quality", posterior(accuracies))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))
    )
