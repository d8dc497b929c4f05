"""Times the headline queries from the test tables.

``community_risk`` is the whole graph job, ``flagship`` the fleet summary with it. Queries that read
the graph tables find them stored, as they do when the job has run before them; all others start
with nothing kept from the one before. ``micro_batch`` has the seconds that the scoring stream takes for
100 readings, graph context loaded: median and 95th percentile.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores,
``BENCH_QUERIES`` a comma-separated subset.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fleetpulse.plans import jobs  # noqa: E402
from fleetpulse.session import build_session, work_path  # noqa: E402
from fleetpulse.sources.events import telemetry  # noqa: E402
from fleetpulse.streaming.scored import GraphContext, score_batch  # noqa: E402
from verification import queries as registered  # noqa: E402

HEADLINE = """parse_telemetry base_scored graph_edges pagerank label_propagation community_risk
graph_scored fleet_summary latest_alerts community_members feature_minmax recon_error
route_readings controller_fold_many retrain_trigger rf_evaluate iforest_fit iforest_score
sink_states_upsert stream_scored controller_stream""".split()

GRAPH_READERS = """graph_scored fleet_summary latest_alerts community_members sink_states_upsert
stream_scored""".split()


def run(spark, sf_dir: str, name: str) -> tuple[float, int]:
    """Seconds to compute every column of the whole result, and its rows."""
    if name in GRAPH_READERS:
        registered.context(spark, sf_dir)
    else:
        registered.reset()
    began = time.perf_counter()
    df = registered.queries()[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - began
    return seconds, df.count()


def micro_batches(spark, sf_dir: str, batches: int = 20, rows: int = 100) -> dict[str, float]:
    """Seconds per micro-batch of the scoring stream."""
    root = work_path(spark, "bench_stream")
    jobs.save_graph_tables(registered.graph_tables(spark, sf_dir), root)
    context = GraphContext(spark, root, ttl=3600.0)
    readings = telemetry(spark, sf_dir).where(f"event_id < {batches * rows}").persist()
    readings.count()
    took = []
    for n in range(batches):
        part = readings.where(f"event_id >= {n * rows} and event_id < {(n + 1) * rows}")
        began = time.perf_counter()
        score_batch(part, n, context, root)
        took.append(time.perf_counter() - began)
    took = sorted(took[2:])  # the first two load the context and compile
    return {"p50": round(took[len(took) // 2], 3), "p95": round(took[int(len(took) * 0.95)], 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM, the Python workers and the file listing before the clock runs.
    run(spark, sf_dir, "fleet_summary")
    seconds, rows = {}, {}
    for name in names:
        took, count = run(spark, sf_dir, name)
        seconds[name], rows[name] = round(took, 3), count
    registered.reset()
    began = time.perf_counter()
    registered.queries()["fleet_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds["flagship"] = round(time.perf_counter() - began, 3)
    latency = micro_batches(spark, sf_dir)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_out": rows,
                "micro_batch": latency,
                "readings_in": events,
                "cpus": int(cpus),
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
