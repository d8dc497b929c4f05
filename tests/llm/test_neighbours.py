import numpy as np

from fleetpulse.llm import neighbours
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = neighbours.learn(docs, labels)
    scored = neighbours.classify(docs.select("doc_id", "text"), model).join(labels, "doc_id")
    rows = scored.where(neighbours.held_out()).select("predicted", "quality", "score").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    assert all(r["predicted"] == 1 for r in rows if r["quality"] == 1)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_cases(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 0, 0), (5, 1, 0), (7, 1, None), (None, 1, 0), (8, None, 0), (99, 1, 0), (13, 0, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    docs = cases.edge(spark)
    model = neighbours.learn(docs, labels)
    found = neighbours.classify(docs, model)
    rows = found.collect()
    assert len(rows) == len(cases.rows()) and set(found.columns) == set(docs.columns)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"], r["score"]) == r["score"]
    assert neighbours.classify(cases.empty(spark), model).collect() == []


def test_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    model = neighbours.learn(cases.edge(spark), labels)
    assert {r["score"] for r in neighbours.classify(cases.edge(spark), model).collect()} == {0.5}


def test_vote_equals_plain_version():
    rng = np.random.default_rng(0)
    rows = rng.random((60, neighbours.WIDTH), dtype=np.float32)
    labels = rng.integers(0, 2, 60)
    model = neighbours.fit(rows, labels, (100, 900), latent=8)
    queries = rng.random((9, neighbours.WIDTH), dtype=np.float32)
    got = model.score(queries, neighbours=7)
    for q, score in zip(model.project(queries), got):
        near = model.vectors @ q
        top = np.argsort(-near)[:7]
        weight = np.clip(near[top], 0, 1) ** 8 * model.weights[top]
        assert abs(score - (weight * labels[top]).sum() / weight.sum()) < 1e-4


def test_training_never_sees_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(neighbours.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (neighbours.learn(docs, x) for x in (labels, turned))
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.labels, b.labels)
