import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from verification import compare, oracles, queries

# Operators whose result is a fitted model: checked for rows here, in detail elsewhere.
MODELS = {
    "rf_train", "rf_predict", "rf_evaluate", "edge_model_alerts",
}

QUICK = """fleet_summary graph_scored base_scored community_risk label_propagation pagerank_top10
controller_fold_many route_readings community_members sink_states_upsert src_archive_json
parse_telemetry rf_split latency_bands graph_adjustment""".split()


def test_flagship(spark):
    row = entry.entry(spark).first()
    assert row.total == 15 and row.critical + row.healthy == row.total


def test_every_query_has_sql_except_the_models():
    own = set(queries.queries())
    assert own <= set(entry.queries())
    assert own - set(entry.oracle_sql()) == MODELS
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_against_sql(spark, name):
    assert compare.compare(spark, compare.duck(SF), SF, name) == ""


def test_whole_tables_are_read():
    """Limits appear only where a short list is the feature."""
    limited = {n for n, sql in oracles.oracle_sql().items() if re.search(r"\blimit\b", sql, re.I)}
    assert limited == {
        "show_preview", "sample_limit", "latest_alerts", "alert_feed", "alert_ticker",
        "sensor_series", "community_top5",
    }


def test_shared_tables_can_be_forgotten(spark):
    queries.graph_tables(spark, SF)
    queries.reset()
    assert not queries._shared


@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_imports_without_the_training_data_operators(tmp_path, keep_pipeline):
    repo = Path(entry.__file__).resolve().parent
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if keep_pipeline or name != "corpus_pipeline.py":
            shutil.copy(repo / name, tmp_path)
    for name in ("fleetpulse", "verification"):
        shutil.copytree(repo / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n[:2] == 'op' for n in e.queries()))"
    ran = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert ran.stdout.split() == [str(len(queries.queries())), "False"], ran.stderr
