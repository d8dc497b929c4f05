"""Quality by nearest-neighbour voting in a latent-semantic space.

The terms of a text are three-grams of character classes and a few graded proportions (repeated
words and lines, function words, capitals and the like), so they describe how a text is made and
not what it is about. A truncated singular value decomposition of labelled texts gives the latent
space. Their vectors are broadcast, every document is compared with all of them in blocks, and the
nearest vote with their similarity as weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import as_field, fields, map_batches
from fleetpulse.llm.weak_rules import SIGNALS, signals

PER_CLASS = 2000  # labelled documents of each class that are learned from and broadcast
NEIGHBOURS = 25
LATENT = 48
TERMS = 1024  # hashed three-grams; the graded proportions come on top
GRADES = 12
ACCEPT = 0.3  # documents with at least this score are predicted good

# Classes of bytes: letters, digits, spaces and line ends as groups, all other signs one by one.
_CLASSES = np.zeros(256, np.int64)
for _byte in range(256):
    if 97 <= _byte <= 122:
        _CLASSES[_byte] = 0
    elif 65 <= _byte <= 90:
        _CLASSES[_byte] = 1
    elif 48 <= _byte <= 57:
        _CLASSES[_byte] = 2
    elif _byte >= 128:
        _CLASSES[_byte] = 3
    elif _byte in b" \t":
        _CLASSES[_byte] = 4
    elif _byte in b"\r\n\v\f":
        _CLASSES[_byte] = 5
    elif _byte < 32 or _byte == 127:
        _CLASSES[_byte] = 6
    else:
        _CLASSES[_byte] = 7 + sum(
            1 for b in range(33, _byte) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)
        )
_KINDS = int(_CLASSES.max()) + 1
_GRAMS = _KINDS**3
_BUCKET = (np.arange(_GRAMS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(TERMS)
_BUCKET = _BUCKET.astype(np.int64)
_PAIRS = (  # proportions that are graded: part and whole of the signals of a text
    ("n_symbols", "n_words"),
    ("n_dup_lines", "n_lines"),
    ("n_repeat_words", "n_words"),
    ("n_stop", "n_words"),
    ("n_alpha_words", "n_words"),
    ("n_upper", "n_letters"),
    ("n_exclaims", "n_words"),
    ("n_distinct_words", "n_words"),
)
WIDTH = TERMS + (len(_PAIRS) + 2) * GRADES


def terms(text: str | None) -> np.ndarray:
    """Weights of the terms of a whole text, before those learned. Nothing but grades if empty."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    counts = np.zeros(TERMS, np.int64)
    step = 1 << 22  # a very long text is counted piece by piece
    for at in range(0, max(len(raw) - 2, 0), step):
        kinds = _CLASSES[raw[at : at + step + 2]]
        grams = (kinds[:-2] * _KINDS + kinds[1:-1]) * _KINDS + kinds[2:]
        counts += np.bincount(_BUCKET[grams], minlength=TERMS)
    out = np.zeros(WIDTH, np.float32)
    out[:TERMS] = np.sqrt(counts / max(counts.sum(), 1))
    values = dict(zip(SIGNALS.fieldNames(), signals(text)))
    ratios = [values[a] / max(values[b], 1) for a, b in _PAIRS]
    ratios.append(values["word_chars"] / max(values["n_words"], 1) / 20)
    ratios.append(np.log2(1 + values["n_words"]) / 16)
    for i, ratio in enumerate(ratios):
        # The square root spreads small proportions. A value is shared by the two grades around it.
        place = min(float(np.sqrt(ratio)), 1.0) * (GRADES - 1)
        low = min(int(place), GRADES - 2)
        out[TERMS + i * GRADES + low] = 1 - (place - low)
        out[TERMS + i * GRADES + low + 1] = place - low
    return out


@dataclass(frozen=True)
class Model:
    """Projection into the latent space, and the labelled vectors with label and vote weight."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    prior: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        out = (rows * self.idf) @ self.basis
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def score(self, rows: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Weighted share of label 1 among the nearest, all labelled vectors compared exactly."""
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        near = self.project(rows) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        similarity = np.clip(np.take_along_axis(near, top, axis=1), 0, 1) ** 8
        votes = similarity * self.weights[top]
        total = votes.sum(axis=1)
        share = (votes * self.labels[top]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.clip(np.where(total > 1e-12, share, self.prior), 0, 1)


def fit(rows: np.ndarray, labels: np.ndarray, class_rows: tuple[int, int], latent: int = LATENT) -> Model:
    """``class_rows``: labelled documents of class 0 and 1 overall, which the sample stands for."""
    total = sum(class_rows)
    prior = class_rows[1] / total if total else 0.5
    if not len(rows):
        none = np.empty(0)
        return Model(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.empty((0, 1)), none, none, prior)
    present = (rows > 0).sum(axis=0)
    idf = np.log((1 + len(rows)) / (1 + present)).astype(np.float32) + np.float32(0.1)
    basis = _leading(rows * idf, min(latent, len(rows)))
    sampled = np.array([(labels == c).sum() for c in (0, 1)])
    per_class = np.array(class_rows) / np.maximum(sampled, 1)
    weights = per_class[labels.astype(np.int64)]
    model = Model(idf, basis, np.empty(0), labels.astype(float), weights / weights.max(), prior)
    object.__setattr__(model, "vectors", model.project(rows))
    return model


def _leading(rows: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    start = np.random.default_rng(7).standard_normal((rows.shape[1], min(size + 16, rows.shape[1])))
    basis = start.astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :size].astype(np.float32)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept for testing; without an id it is."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(True))


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", per_class: int = PER_CLASS
) -> Model:
    """A model from up to ``per_class`` labelled documents of each class that are not held out.

    Rows of one id count once: the label is the one most of them carry (1 on a tie), the text the
    one that sorts first. Labels without an id, or for which there is no document, are not used.
    """
    known = (
        labels.where(F.col(label).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    # At most twice per_class rows of two numbers each.
    chosen = docs.select(F.col(id_col).alias("_id"), "text").join(F.broadcast(sample), "_id")

    def rows(columns):
        made = [terms(t).tobytes() for t in columns["text"].to_pylist()]
        return {"_id": columns["_id"], "label": columns["label"], "terms": made}

    schema = fields(as_field(docs, id_col, "_id"), "label int", "terms binary")
    found = map_batches(chosen.select("_id", "label", "text"), rows, schema)
    found = found.groupBy("_id").agg(F.min(F.struct("terms", "label")).alias("one"))
    got = found.select("_id", "one.*").orderBy("_id").collect()
    matrix = np.array([np.frombuffer(r["terms"], np.float32) for r in got], np.float32).reshape(-1, WIDTH)
    classes = np.array([r["label"] for r in got], np.int64)
    return fit(matrix, classes, (sizes.get(0, 0), sizes.get(1, 0)))


def classify(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """All columns of ``docs``, then score and predicted (1 if the score reaches ``accept``).

    Only the text is looked at, all of it; a null text counts as empty and has a score like any
    other. Rows are judged one by one, so repeated rows get equal scores; an empty table gives no
    rows. Columns of ``docs`` named score or predicted are replaced.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(columns):
        texts = columns["text"].to_pylist()
        scores = shared.value.score(np.array([terms(t) for t in texts], np.float32))
        return {**columns, "score": scores, "predicted": (scores >= accept).astype(np.int32)}

    return map_batches(docs, rows, fields(*docs.schema, "score double", "predicted int"), most=500)
