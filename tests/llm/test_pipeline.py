import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from fleetpulse.llm import neighbours, suffix, tokens
from fleetpulse.session import write_once
from tests.llm import cases
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_suffix import plain_cut
from tests.llm.test_winnowing import plain as plain_windows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    """Input and output rows of every stage."""
    docs, made = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = write_once(stage(spark, docs, SF), name)
        made.append((name, docs.columns, docs.collect(), out.columns, out.collect()))
        docs = out
    return {name: rest for name, *rest in made}


def test_stages(results):
    assert list(results) == ["quality_classifier", "near_dedup", "repeat_dedup", "decontamination", "packing"]
    for name in list(results)[:-1]:
        assert results[name][0] == results[name][2] == corpus_pipeline.COLUMNS


def test_quality_keeps_what_it_accepts(spark, results):
    _, given, _, kept = results["quality_classifier"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = neighbours.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = model.score(np.array([neighbours.terms(r["text"]) for r in given]))
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r, s in zip(given, scores) if s >= 0.3)


def test_one_document_of_each_group(results):
    _, given, _, kept = results["near_dedup"]
    groups = plain_components([plain_fingerprint(r["text"]) for r in given], 4)
    first = {}
    for r, g in zip(given, groups):
        first[g] = min(first.get(g, r), r, key=lambda x: x["doc_id"])
    assert sorted(map(tuple, kept)) == sorted(map(tuple, first.values()))


def test_repeated_passages_are_cut(results):
    _, given, _, kept = results["repeat_dedup"]
    texts = plain_cut([(r["doc_id"], r["text"]) for r in given], suffix.PASSAGE_BYTES, suffix.PASSAGE_WORDS)
    expected = []
    for row, text in zip(given, texts):
        if text == row["text"]:
            expected.append(tuple(row))
        elif text:
            expected.append((row["doc_id"], text, row["lang"], row["source"], len(text)))
    assert sorted(map(tuple, kept)) == sorted(expected) and any(t != r["text"] for r, t in zip(given, texts))


def test_benchmark_documents_go(spark, results):
    _, given, _, kept = results["decontamination"]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in plain_windows([(r["doc_id"], r["text"]) for r in given], bench) if not r[2]}
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in given if r["doc_id"] in clean)
    assert len(kept) < len(given)


def test_everything_kept_is_packed(results):
    _, given, _, pieces = results["packing"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = tokens.encoder("byte", path).encode([r["text"] or "" for r in given])
    rows = [{**r.asDict(), "_id": r["doc_id"]} for r in pieces]
    check(rows, 1024, [(r["doc_id"], np.append(i, 0)) for r, i in zip(given, ids)])


def test_edge_rows_go_through(spark, tmp_path):
    """Nulls, repeats, empty and long texts, clashing columns; and a table without rows."""
    for made, folder in ((cases.edge(spark), "edge"), (cases.empty(spark), "empty")):
        made.write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/{folder}/labels.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/{folder}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/edge").collect()
    assert rows and all(r["length"] > 0 for r in rows)
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []


def test_near_copies_with_null_and_repeated_ids(spark):
    rows = [r for r in cases.rows() if r[0] not in (5, 6)]
    docs = spark.createDataFrame(rows, cases.DOCS)
    kept = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    groups = plain_components([plain_fingerprint(r[1]) for r in rows], 4)
    assert len(kept) == len(set(groups))
    for group in set(groups):
        members = [r for r, g in zip(rows, groups) if g == group]
        ids = [r[0] for r in members if r[0] is not None]
        assert any(k["doc_id"] == min(ids, default=None) and k["text"] in [m[1] for m in members] for k in kept)
