"""The registered queries in SQL, written for DuckDB over the same tables."""

from __future__ import annotations

from fleetpulse.params import ControllerParams, GraphParams

# --- building blocks: name -> (names it needs, text) -----------------------------------------


def _draw(key: str, purpose: str) -> str:
    return f"(('0x' || left(md5({key} || ':{purpose}'), 8))::BIGINT / 4294967296.0::DOUBLE)"


_PARTS: dict[str, tuple[list[str], str]] = {}


def _part(name: str, needs: list[str], text: str) -> None:
    _PARTS[name] = (needs, text)


_part("fleet", [], "SELECT max(user_id) + 1 AS n FROM events")
_part(
    "tel",
    ["fleet"],
    f"""
    SELECT event_id, 'M' || user_id AS machine_id, event_type AS machine_type,
           295.0::DOUBLE + event_id % 11 AS air_temp, 305.0::DOUBLE + event_id % 13 AS process_temp,
           1250.0::DOUBLE + value * 5 AS rotational_speed, value AS torque,
           (CAST(regexp_extract(props, '[0-9]+') AS INTEGER) * 5) // 2 AS tool_wear,
           CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS machine_failure,
           epoch_us(ts) AS event_us,
           list_filter(
             list_slice(['M' || ((user_id * 7 + 1) % n), 'M' || ((user_id * 13 + 5) % n),
                         'M' || ((user_id * 31 + 11) % n)], 1, 1 + user_id % 3),
             lambda x: x <> 'M' || user_id) AS connected_to,
           CAST(50 + floor({_draw('event_id', 'rtt')} * 451) AS INTEGER) AS latency_ms,
           {_draw('event_id', 'sample')} AS draw,
           'edge-' || (user_id % 8) AS edge_id
    FROM events, fleet""",
)
_part("nodes", ["tel"], "SELECT DISTINCT machine_id AS id FROM tel")
_part(
    "all_edges",
    ["tel"],
    "SELECT DISTINCT machine_id AS src, unnest(connected_to) AS dst FROM tel",
)
_part(
    "edges",
    ["all_edges", "nodes"],
    "SELECT src, dst FROM all_edges WHERE src IN (SELECT id FROM nodes) AND dst IN (SELECT id FROM nodes)",
)
_part("deg", ["edges"], "SELECT src, count(*) AS d FROM edges GROUP BY src")
_part("pr0", ["nodes"], "SELECT id, 1.0::DOUBLE AS r FROM nodes")
for _i in range(1, GraphParams().pagerank_iters + 1):
    _part(
        f"pr{_i}",
        ["nodes", "edges", "deg", f"pr{_i - 1}"],
        f"""
        SELECT n.id, 0.15 + 0.85 * coalesce(s.s, 0.0) AS r FROM nodes n
        LEFT JOIN (SELECT e.dst, sum(p.r / d.d) AS s FROM edges e
                   JOIN pr{_i - 1} p ON p.id = e.src JOIN deg d ON d.src = e.src
                   GROUP BY e.dst) s ON s.dst = n.id""",
    )
_LAST = GraphParams().pagerank_iters
_part(
    "ranks",
    [f"pr{_LAST}"],
    f"""SELECT id AS machine_id, r * ((SELECT count(*) FROM pr{_LAST}) /
        (SELECT sum(r) FROM pr{_LAST})) AS pagerank FROM pr{_LAST}""",
)
_part(
    "links",
    ["edges"],
    "SELECT src AS a, dst AS b FROM edges UNION ALL SELECT dst, src FROM edges",
)
_part("lp0", ["nodes"], "SELECT id, id AS label FROM nodes")
for _i in range(1, GraphParams().label_iters + 1):
    _part(
        f"lp{_i}",
        ["nodes", "links", f"lp{_i - 1}"],
        f"""
        SELECT n.id, coalesce(v.label, n.id) AS label FROM nodes n LEFT JOIN (
          SELECT id, label FROM (
            SELECT l.b AS id, p.label, count(*) AS c FROM links l
            JOIN lp{_i - 1} p ON p.id = l.a GROUP BY l.b, p.label)
          QUALIFY row_number() OVER (PARTITION BY id
                                     ORDER BY c DESC, CAST(label[2:] AS BIGINT)) = 1
        ) v ON v.id = n.id""",
    )
_part(
    "comm",
    [f"lp{GraphParams().label_iters}"],
    f"SELECT label AS community_id, id AS machine_id FROM lp{GraphParams().label_iters}",
)
_part(
    "members",
    ["comm", "ranks"],
    "SELECT c.machine_id, c.community_id, r.pagerank FROM comm c JOIN ranks r USING (machine_id)",
)
_part(
    "median",
    ["members"],
    "SELECT quantile_disc(round(pagerank, 9), 0.5) AS median_rank FROM members",
)
_part(
    "agg",
    ["members", "median"],
    """SELECT community_id, count(*) AS member_count, avg(pagerank) AS avg_pagerank,
       count(*) FILTER (WHERE round(pagerank, 9) > (SELECT median_rank FROM median)) AS critical_count
       FROM members GROUP BY community_id""",
)
_part("norm", ["agg"], "SELECT max(avg_pagerank * ln(1 + member_count)) AS norm_max FROM agg")
_part(
    "risk",
    ["agg", "norm"],
    """SELECT community_id,
       least(1.0, avg_pagerank * ln(1 + member_count) / (SELECT norm_max FROM norm)) AS risk_score,
       CAST(member_count AS INTEGER) AS member_count,
       CAST(critical_count AS INTEGER) AS critical_count, avg_pagerank FROM agg""",
)
_part(
    "ctx",
    ["ranks", "comm", "risk"],
    """SELECT machine_id, r.pagerank AS pr_score, c.community_id, k.risk_score
       FROM ranks r FULL JOIN comm c USING (machine_id) LEFT JOIN risk k USING (community_id)""",
)
_part(
    "adj",
    ["tel", "ctx"],
    """SELECT t.*, c.pr_score, c.community_id, c.risk_score,
       coalesce(c.risk_score * 0.4::DOUBLE + c.pr_score * 0.3::DOUBLE, 0.0) AS graph_adjustment
       FROM tel t LEFT JOIN ctx c USING (machine_id)""",
)
_SCORE = """CASE WHEN tool_wear > 200.0::DOUBLE - {a} * 200.0::DOUBLE
            OR rotational_speed < 1300.0::DOUBLE + {a} * 200.0::DOUBLE
            THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END"""
_part(
    "scored",
    ["adj"],
    f"SELECT *, {_SCORE.format(a='graph_adjustment')} AS prediction_score FROM adj",
)
_part("base", ["tel"], f"SELECT *, {_SCORE.format(a='0.0')} AS prediction_score FROM tel")
_part(
    "alerts",
    ["scored"],
    """SELECT machine_id, event_us AS alert_us, 0 AS latency_ms, air_temp, process_temp,
       rotational_speed, torque, tool_wear, prediction_score
       FROM scored WHERE prediction_score = -1""",
)
_part(
    "states_all",
    ["scored"],
    """SELECT machine_id, event_us AS last_update_us,
       CASE WHEN prediction_score = -1 THEN 'CRITICAL' ELSE 'HEALTHY' END AS status,
       air_temp, torque FROM scored""",
)
_part(
    "states",
    ["states_all"],
    """SELECT * FROM states_all QUALIFY row_number() OVER (
       PARTITION BY machine_id ORDER BY last_update_us DESC) = 1""",
)
# Routing with the starting thresholds.
_part(
    "routed0",
    ["base"],
    "SELECT *, latency_ms < 200 OR draw < 0.2::DOUBLE AS to_cloud FROM base",
)


def _controller(tag: str, edge: str) -> None:
    """Windows, the fold over them and the routed rows, for a choice of edges."""
    p = ControllerParams()
    _part(
        f"num{tag}",
        ["base"],
        f"""SELECT * REPLACE ({edge} AS edge_id),
            row_number() OVER (PARTITION BY {edge} ORDER BY event_us, event_id) AS seq FROM base""",
    )
    _part(
        f"wnd{tag}",
        [f"num{tag}"],
        f"SELECT *, (seq - 1) // {p.window_size} AS window_no FROM num{tag}",
    )
    _part(
        f"win{tag}",
        [f"wnd{tag}"],
        f"""SELECT edge_id, window_no, count(*) AS messages, avg(latency_ms) AS mean_rtt,
            coalesce(list({{'l': latency_ms, 'd': draw}}) FILTER (
              WHERE prediction_score = -1 AND latency_ms >= 100 AND draw >= 0.1::DOUBLE), [])
              AS outliers
            FROM wnd{tag} GROUP BY edge_id, window_no HAVING count(*) = {p.window_size}""",
    )
    seen = "len(list_filter(w.outliers, lambda o: o.l >= f.thr AND o.d >= f.smp))"
    _part(
        f"fold{tag}",
        [f"win{tag}"],
        f"""
        SELECT edge_id, -1::BIGINT AS window_no, 'START' AS action, 200.0::DOUBLE AS thr,
               0.2::DOUBLE AS smp, 500 AS itv, 0.0::DOUBLE AS rate, 250.0::DOUBLE AS rtt
        FROM (SELECT DISTINCT edge_id FROM win{tag})
        UNION ALL
        SELECT edge_id, window_no, action,
          greatest(100.0::DOUBLE, least(400.0::DOUBLE, thr + CASE action
            WHEN 'EXPAND_CLOUD' THEN 20.0::DOUBLE WHEN 'REDUCE_CLOUD' THEN -20.0::DOUBLE
            WHEN 'FINE_TUNE_EDGE' THEN -5.0::DOUBLE WHEN 'FINE_TUNE_CLOUD' THEN 5.0::DOUBLE
            ELSE 0.0::DOUBLE END)),
          CASE action WHEN 'EXPAND_CLOUD' THEN least(smp + 0.05::DOUBLE, 0.9::DOUBLE)
            WHEN 'REDUCE_CLOUD' THEN greatest(smp - 0.05::DOUBLE, 0.1::DOUBLE) ELSE smp END,
          CASE action WHEN 'EXPAND_CLOUD' THEN greatest(itv - 50, 200)
            WHEN 'REDUCE_CLOUD' THEN least(itv + 100, 2000) ELSE itv END,
          rate, rtt
        FROM (
          SELECT *, CASE WHEN rate > 0.15::DOUBLE THEN 'EXPAND_CLOUD'
              WHEN rate < 0.02::DOUBLE THEN 'REDUCE_CLOUD'
              WHEN rtt - old_rtt > 5 THEN 'FINE_TUNE_EDGE'
              WHEN rtt - old_rtt < -5 THEN 'FINE_TUNE_CLOUD' ELSE 'HOLD' END AS action
          FROM (
            SELECT w.edge_id, w.window_no, f.thr, f.smp, f.itv, f.rtt AS old_rtt,
              0.3::DOUBLE * ({seen} / 200.0::DOUBLE) + 0.7::DOUBLE * f.rate AS rate,
              0.2::DOUBLE * w.mean_rtt + 0.8::DOUBLE * f.rtt AS rtt
            FROM fold{tag} f
            JOIN win{tag} w ON w.edge_id = f.edge_id AND w.window_no = f.window_no + 1))""",
    )
    _part(
        f"state{tag}",
        [f"fold{tag}"],
        f"SELECT * FROM fold{tag} WHERE window_no >= 0",
    )
    _part(
        f"route{tag}",
        [f"wnd{tag}", f"fold{tag}"],
        f"""SELECT w.*, w.latency_ms < coalesce(f.thr, 200.0::DOUBLE)
              OR w.draw < coalesce(f.smp, 0.2::DOUBLE) AS to_cloud
            FROM wnd{tag} w LEFT JOIN fold{tag} f
            ON f.edge_id = w.edge_id AND f.window_no + 1 = w.window_no""",
    )
    _part(
        f"backlog{tag}",
        [f"route{tag}"],
        f"""SELECT edge_id, window_no, cloud_messages,
            CAST(sum(cloud_messages) OVER (PARTITION BY edge_id ORDER BY window_no) % {p.retrain_every}
                 AS INTEGER) AS cloud_backlog
            FROM (SELECT edge_id, window_no, count(*) FILTER (WHERE to_cloud) AS cloud_messages
                  FROM route{tag} GROUP BY edge_id, window_no)""",
    )
    _part(
        f"latest{tag}",
        [f"state{tag}", f"backlog{tag}"],
        f"""SELECT s.edge_id AS controller_id, round(s.thr, 6) AS latency_threshold,
            round(s.smp, 6) AS cloud_sample_rate, s.itv AS retrain_interval,
            round(s.rate, 6) AS edge_anomaly_rate, b.cloud_backlog, round(s.rtt, 6) AS avg_rtt
            FROM state{tag} s JOIN backlog{tag} b USING (edge_id, window_no)
            QUALIFY row_number() OVER (PARTITION BY s.edge_id ORDER BY window_no DESC) = 1""",
    )


_controller("1", "'edge_controller_v1'")
_controller("8", "edge_id")
_part(
    "looked_up",
    ["latest8"],
    """SELECT v.id AS controller_id, coalesce(latency_threshold, 200.0::DOUBLE) AS latency_threshold,
       coalesce(cloud_sample_rate, 0.2::DOUBLE) AS cloud_sample_rate,
       coalesce(retrain_interval, 500) AS retrain_interval,
       coalesce(edge_anomaly_rate, 0.0::DOUBLE) AS edge_anomaly_rate,
       coalesce(cloud_backlog, 0) AS cloud_backlog, coalesce(avg_rtt, 0.0::DOUBLE) AS avg_rtt,
       l.controller_id IS NOT NULL AS active
       FROM (VALUES ('edge-3'), ('edge-none')) v(id) LEFT JOIN latest8 l ON l.controller_id = v.id""",
)


def _sql(select: str, *needs: str) -> str:
    """``select`` behind all the parts it needs, each computed once."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in _PARTS[name][0]:
                visit(other)
            ordered.append(name)

    for name in needs:
        visit(name)
    blocks = []
    for name in ordered:
        text = _PARTS[name][1].strip()
        kind = "AS" if name.startswith("fold") else "AS MATERIALIZED"
        blocks.append(f"{name} {kind} ({text})")
    return "WITH RECURSIVE " + ",\n".join(blocks) + "\n" + select


# The isolation forest, level by level: 100 trees of 256 readings, 8 levels of splits.
_DEPTH = 8


def _tree_draw(purpose: str) -> str:
    return f"(('0x' || left(md5('42:' || tree || ':' || node || ':{purpose}'), 8))::BIGINT / 4294967296.0::DOUBLE)"


_part(
    "drawn",
    ["tel"],
    """
    SELECT tree, 1::BIGINT AS node, x FROM (
      SELECT tree, x, row_number() OVER (
        PARTITION BY tree ORDER BY (u + tree * (2 * v + 1)) % 4294967296, event_id) AS place
      FROM (SELECT event_id, ('0x' || left(h, 8))::BIGINT AS u, ('0x' || substr(h, 9, 8))::BIGINT AS v,
              [air_temp, process_temp, rotational_speed, torque, tool_wear::DOUBLE] AS x
            FROM (SELECT *, md5(event_id || ':forest-42') AS h FROM tel)), range(100) AS t(tree))
    WHERE place <= 256""",
)
for _level in range(_DEPTH + 1):
    _rows = "drawn" if _level == 0 else f"rows{_level}"
    if _level:
        _part(
            _rows,
            [f"split{_level - 1}"],
            f"""
            SELECT r.tree, 2 * r.node + CASE WHEN x[feature + 1] > split THEN 1 ELSE 0 END AS node, x
            FROM {'drawn' if _level == 1 else f'rows{_level - 1}'} r
            JOIN split{_level - 1} s ON s.tree = r.tree AND s.node = r.node WHERE feature >= 0""",
        )
    _bounds = ", ".join(f"{{f}}(x[{i}])" for i in range(1, 6))
    _part(
        f"split{_level}",
        [_rows],
        f"""
        SELECT tree, node, n, feature, {_level} AS depth, CASE WHEN feature < 0 THEN 0.0::DOUBLE
            ELSE lo[feature + 1] + {_tree_draw('split')} * (hi[feature + 1] - lo[feature + 1]) END AS split
        FROM (SELECT *, CASE WHEN {_level} >= {_DEPTH} OR n <= 1 OR len(usable) = 0 THEN -1
                ELSE usable[1 + CAST(floor({_tree_draw('feature')} * len(usable)) AS BIGINT)] END AS feature
              FROM (SELECT *, list_filter([0, 1, 2, 3, 4], lambda i: hi[i + 1] > lo[i + 1]) AS usable
                    FROM (SELECT tree, node, count(*) AS n, [{_bounds.format(f='min')}] AS lo,
                            [{_bounds.format(f='max')}] AS hi FROM {_rows} GROUP BY tree, node)))""",
    )
_part(
    "forest",
    [f"split{i}" for i in range(_DEPTH + 1)],
    " UNION ALL ".join(f"SELECT tree, node, n, feature, split, depth FROM split{i}" for i in range(_DEPTH + 1)),
)
_part(
    "fold_walk0",
    ["forest"],
    """
    SELECT event_id, machine_id, tree, 1::BIGINT AS node,
      [air_temp, process_temp, rotational_speed, torque, tool_wear::DOUBLE] AS x
    FROM tel, range(100) AS t(tree)""",
)
for _level in range(_DEPTH):
    _part(
        f"fold_walk{_level + 1}",
        [f"fold_walk{_level}"],
        f"""
        SELECT event_id, machine_id, w.tree, x, CASE WHEN feature < 0 THEN w.node
          ELSE 2 * w.node + CASE WHEN x[feature + 1] > split THEN 1 ELSE 0 END END AS node
        FROM fold_walk{_level} w JOIN forest f ON f.tree = w.tree AND f.node = w.node""",
    )


def _normal(n: str) -> str:
    return f"""CASE WHEN {n} <= 1 THEN 0.0::DOUBLE WHEN {n} = 2 THEN 1.0::DOUBLE ELSE
      2.0 * (ln({n} - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2.0 * ({n} - 1.0::DOUBLE) / {n} END"""


_part(
    "isolation",
    [f"fold_walk{_DEPTH}"],
    f"""
    SELECT event_id, machine_id,
      round(pow(2.0::DOUBLE, -avg(depth + {_normal('n')}) / ({_normal('256')})), 9) AS score
    FROM fold_walk{_DEPTH} w JOIN forest f ON f.tree = w.tree AND f.node = w.node GROUP BY event_id, machine_id""",
)


_READING = """machine_id, machine_type, round(air_temp, 6) AS air_temp,
round(process_temp, 6) AS process_temp, round(rotational_speed, 6) AS rotational_speed,
round(torque, 6) AS torque, tool_wear, machine_failure, event_us,
array_to_string(connected_to, ',') AS connected_to"""

_GAPS = """* REPLACE (CASE WHEN machine_type <> 'signup' THEN torque END AS torque,
CASE WHEN machine_type <> 'view' THEN tool_wear END AS tool_wear)"""

_ALERT = """'edge_anomaly' AS alert_type, machine_id AS product_id, latency_ms, event_us, tool_wear,
round(torque, 6) AS torque"""

_ALERTS = """machine_id, alert_us, latency_ms, round(air_temp, 6) AS air_temp,
round(process_temp, 6) AS process_temp, round(rotational_speed, 6) AS rotational_speed,
round(torque, 6) AS torque, tool_wear, prediction_score"""

_SEVEN = """machine_id, alert_us, round(air_temp, 6) AS air_temp,
round(process_temp, 6) AS process_temp, round(rotational_speed, 6) AS rotational_speed, tool_wear,
round(torque, 6) AS torque"""

_STATES = """machine_id, last_update_us, status, round(air_temp, 6) AS air_temp,
round(torque, 6) AS torque"""

_RANKS = "machine_id, round(pagerank, 6) AS pagerank"

_RISK = """community_id, round(risk_score, 6) AS risk_score, member_count, critical_count,
round(avg_pagerank, 6) AS avg_pagerank"""

_TOP = "(SELECT * FROM alerts ORDER BY alert_us DESC, machine_id LIMIT {n})"

_CARD = """SELECT controller_id, CAST(round(latency_threshold) AS INTEGER) AS latency_threshold_ms,
CAST(round(cloud_sample_rate * 100) AS INTEGER) AS cloud_sample_pct, retrain_interval,
round(edge_anomaly_rate * 100, 1) AS anomaly_pct, cloud_backlog,
CAST(round(avg_rtt) AS INTEGER) AS avg_rtt_ms,
CASE WHEN active THEN 'ACTIVE' ELSE 'WAITING' END AS status
FROM looked_up WHERE controller_id = 'edge-3'"""

_SETTLED = """edge_id, window_no, action, round(thr, 6) AS latency_threshold,
round(smp, 6) AS cloud_sample_rate, itv AS retrain_interval, round(rate, 6) AS edge_anomaly_rate,
round(rtt, 6) AS avg_rtt"""


def oracle_sql() -> dict[str, str]:
    out = {}
    out["src_kafka_json"] = _sql(f"SELECT {_READING} FROM tel", "tel")
    out["src_multi_topic"] = _sql(
        """SELECT 'edge-alerts' AS topic, machine_id, latency_ms FROM routed0
           WHERE NOT to_cloud AND prediction_score = -1
           UNION ALL SELECT 'cloud-data', machine_id, latency_ms FROM routed0 WHERE to_cloud""",
        "routed0",
    )
    out["src_feedback"] = _sql(
        """SELECT 'retrain_complete' AS type, CAST(k AS INTEGER) AS records_trained,
           round(1.0::DOUBLE / k, 6) AS training_loss
           FROM (SELECT row_number() OVER (ORDER BY event_us, event_id) AS k
                 FROM routed0 WHERE to_cloud) WHERE k % 500 = 0""",
        "routed0",
    )
    for name in ("src_archive_json", "src_stable_snapshot", "archive_stream"):
        out[name] = out["src_kafka_json"]
    out["src_csv"] = _sql(
        """SELECT machine_id, machine_type, round(air_temp, 6) AS air_temp,
           round(process_temp, 6) AS process_temp, round(rotational_speed, 6) AS rotational_speed,
           round(torque, 6) AS torque, tool_wear, machine_failure FROM tel""",
        "tel",
    )
    out["src_serving_table"] = _sql(
        "SELECT machine_id AS pr_machine_id, round(pagerank, 6) AS pr_score FROM ranks", "ranks"
    )

    for name in ("sink_alerts_append", "project_alerts", "stream_scored"):
        out[name] = _sql(f"SELECT {_ALERTS} FROM alerts", "alerts")
    for name in ("sink_states_upsert", "states_snapshot", "latest_state"):
        out[name] = _sql(f"SELECT {_STATES} FROM states", "states")
    for name in ("sink_pagerank", "pagerank", "pagerank_board"):
        out[name] = _sql(f"SELECT {_RANKS} FROM ranks", "ranks")
    for name in ("sink_communities", "label_propagation"):
        out[name] = _sql("SELECT community_id, machine_id FROM comm", "comm")
    for name in ("sink_risk", "community_risk"):
        out[name] = _sql(f"SELECT {_RISK} FROM risk", "risk")
    out["sink_controller_state"] = _sql("SELECT * FROM latest8", "latest8")
    out["sink_archive_batches"] = "SELECT count(*) AS rows, true AS within_limit FROM events"
    out["sink_cloud_history"] = _sql(
        f"""SELECT event_us, round(air_temp, 6) AS air_temp, round(process_temp, 6) AS process_temp,
            round(rotational_speed, 6) AS rotational_speed, round(torque, 6) AS torque,
            CAST(tool_wear AS DOUBLE) AS tool_wear, 'cloud_offload' AS routing, latency_ms
            FROM (SELECT {_GAPS} FROM routed0 WHERE to_cloud)""",
        "routed0",
    )
    edge = f"SELECT {_ALERT} FROM {{t}} WHERE NOT to_cloud AND prediction_score = -1"
    out["sink_kafka_json"] = out["nest_alert"] = _sql(edge.format(t="routed0"), "routed0")
    split = f"{_draw('event_id', 'split-42')} < 0.8::DOUBLE"
    out["sink_model"] = (
        f"SELECT count(*) AS rows, 0::BIGINT AS differ FROM events WHERE NOT ({split})"
    )
    out["iforest_fit"] = out["iforest_refreshed"] = _sql(
        """SELECT CAST(tree AS INTEGER) AS tree_id, CAST(node AS INTEGER) AS node_id,
           CAST(feature AS INTEGER) AS feature, round(split, 6) AS split,
           CAST(CASE WHEN feature < 0 THEN -1 ELSE 2 * node END AS INTEGER) AS left_id,
           CAST(CASE WHEN feature < 0 THEN -1 ELSE 2 * node + 1 END AS INTEGER) AS right_id,
           CAST(depth AS INTEGER) AS depth, CAST(n AS INTEGER) AS size FROM forest""",
        "forest",
    )
    out["iforest_score"] = _sql(
        """SELECT event_id, machine_id, score AS anomaly_score,
           CASE WHEN score > (SELECT min(score) FROM (
             SELECT score, row_number() OVER (ORDER BY score) AS r, count(*) OVER () AS n
             FROM isolation) WHERE r >= ceil(n * 0.95::DOUBLE)) THEN -1 ELSE 1 END AS prediction
           FROM isolation""",
        "isolation",
    )
    out["show_preview"] = _sql(
        f"SELECT {_RANKS} FROM ranks ORDER BY machine_id LIMIT 5", "ranks"
    )

    out["parse_telemetry"] = _sql(f"SELECT event_id, {_READING} FROM tel", "tel")
    out["quarantine_malformed"] = """SELECT event_id,
        CASE WHEN event_type = 'signup' THEN 'malformed' ELSE 'usable' END AS kind FROM events"""
    out["project_states"] = _sql(f"SELECT {_STATES} FROM states_all", "states_all")
    out["filter_anomalies"] = _sql(
        """SELECT event_id, machine_id, tool_wear, round(rotational_speed, 6) AS rotational_speed
           FROM scored WHERE prediction_score = -1""",
        "scored",
    )
    out["topology_enrich"] = _sql(
        """SELECT t.event_id, t.machine_id, t.event_us,
           coalesce(array_to_string(p.c, ','), '') AS connected_to FROM tel t LEFT JOIN
           (SELECT machine_id, any_value(CASE WHEN substr(machine_id, 2)::BIGINT % 5 <> 0 THEN connected_to END) AS c
            FROM tel GROUP BY machine_id) p USING (machine_id)""",
        "tel",
    )
    out["drop_self_loops"] = _sql(
        "SELECT event_id, machine_id, array_to_string(connected_to, ',') AS connected_to FROM tel",
        "tel",
    )
    features = """round(air_temp, 6) AS air_temp, round(process_temp, 6) AS process_temp,
        round(rotational_speed, 6) AS rotational_speed, round(torque, 6) AS torque, tool_wear"""
    complete = "machine_type NOT IN ('signup', 'view')"
    out["drop_missing"] = _sql(f"SELECT event_id, {features} FROM tel WHERE {complete}", "tel")
    out["default_missing"] = """SELECT event_id, true AS has_time,
        CASE WHEN event_type = 'click' THEN 'UNKNOWN' ELSE 'M' || user_id END AS machine_id
        FROM events"""
    out["tag_offload"] = _sql(
        """SELECT event_id, machine_id, 'cloud_offload' AS routing, latency_ms
           FROM routed0 WHERE to_cloud""",
        "routed0",
    )
    out["min_rows_gate"] = _sql(
        """SELECT 'training' AS gate, count(*) >= 100 AS enough FROM tel
           UNION ALL SELECT 'history', count(*) >= 50 FROM routed0 WHERE to_cloud
           UNION ALL SELECT 'edges', count(*) >= 1 FROM edges
           UNION ALL SELECT 'batch', count(*) >= 1 FROM tel WHERE tool_wear > 1000""",
        "tel",
        "routed0",
        "edges",
    )
    out["sample_limit"] = _sql(
        "SELECT event_id, machine_id, event_us FROM tel ORDER BY event_us, event_id LIMIT 100",
        "tel",
    )

    out["join_pagerank"] = _sql(
        """SELECT event_id, machine_id, round(pagerank, 6) AS pr_score
           FROM tel LEFT JOIN ranks USING (machine_id)""",
        "tel",
        "ranks",
    )
    out["join_community"] = _sql(
        "SELECT event_id, machine_id, community_id FROM tel LEFT JOIN comm USING (machine_id)",
        "tel",
        "comm",
    )
    out["join_risk"] = _sql(
        """SELECT event_id, machine_id, community_id, round(risk_score, 6) AS risk_score
           FROM tel LEFT JOIN comm USING (machine_id) LEFT JOIN risk USING (community_id)""",
        "tel",
        "comm",
        "risk",
    )
    out["graph_context"] = _sql(
        """SELECT machine_id, round(pr_score, 6) AS pr_score, community_id,
           round(risk_score, 6) AS risk_score FROM ctx""",
        "ctx",
    )
    out["join_community_rank"] = _sql(
        "SELECT machine_id, community_id, round(pagerank, 6) AS pagerank FROM members", "members"
    )

    out["graph_nodes"] = _sql("SELECT id FROM nodes", "nodes")
    out["graph_edges"] = _sql("SELECT src, dst FROM all_edges", "all_edges")
    out["graph_build"] = _sql(
        """SELECT src, dst FROM all_edges WHERE src IN (SELECT machine_id FROM tel)
             AND dst IN (SELECT machine_id FROM tel)""",
        "all_edges",
    )
    out["community_agg"] = _sql(
        """SELECT community_id, member_count, round(avg_pagerank, 6) AS avg_pagerank,
           critical_count FROM agg""",
        "agg",
    )
    out["median_rank"] = _sql("SELECT round(median_rank, 6) AS median_rank FROM median", "median")
    out["risk_norm_max"] = _sql("SELECT round(norm_max, 6) AS norm_max FROM norm", "norm")
    out["batch_adjust_stats"] = _sql(
        """SELECT count(*) AS records, round(avg(graph_adjustment), 6) AS avg_adjustment,
           round(max(graph_adjustment), 6) AS max_adjustment,
           count(*) FILTER (WHERE graph_adjustment > 0) AS enriched_count FROM adj""",
        "adj",
    )

    def scaled(c: str) -> str:
        return f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}"

    out["feature_minmax"] = _sql(
        f"""SELECT event_id, {scaled('air_temp')}, 0.0::DOUBLE AS process_temp,
            {scaled('rotational_speed')}, {scaled('torque')}, {scaled('tool_wear')} FROM tel""",
        "tel",
    )
    out["edge_run_stats"] = _sql(
        """SELECT count(*) AS processed,
           count(*) FILTER (WHERE NOT to_cloud AND prediction_score = -1) AS anomalies,
           round(count(*) FILTER (WHERE to_cloud) / count(*) * 100, 6) AS cloud_pct FROM route8""",
        "route8",
    )

    out["graph_adjustment"] = _sql(
        """SELECT event_id, machine_id, round(k, 6) AS risk_score,
           round(coalesce(k * 0.4::DOUBLE + pr_score * 0.3::DOUBLE, 0.0), 6) AS graph_adjustment
           FROM (SELECT *, CASE WHEN risk_score < 0.9 THEN risk_score END AS k FROM adj)""",
        "adj",
    )
    out["graph_scored"] = _sql(
        """SELECT event_id, machine_id, round(graph_adjustment, 6) AS graph_adjustment,
           prediction_score FROM scored""",
        "scored",
    )
    out["base_scored"] = _sql(
        f"""SELECT event_id, CAST(NULL AS VARCHAR) AS community_id,
            CAST(NULL AS DOUBLE) AS risk_score, CAST(NULL AS DOUBLE) AS pr_score,
            {_SCORE.format(a='0.0')} AS prediction_score FROM (SELECT {_GAPS} FROM tel)""",
        "tel",
    )

    out["rf_features"] = _sql(
        f"""SELECT event_id, round(air_temp, 6) AS f0, round(process_temp, 6) AS f1,
            round(rotational_speed, 6) AS f2, round(torque, 6) AS f3,
            CAST(tool_wear AS DOUBLE) AS f4 FROM tel WHERE {complete}""",
        "tel",
    )
    out["rf_split"] = (
        f"SELECT event_id, CASE WHEN {split} THEN 'train' ELSE 'test' END AS part FROM events"
    )

    out["rank_metrics"] = _sql(
        """SELECT round((p * f1 + n * f0) / (p + n), 6) AS weighted_f1, round((tp + tn) / (p + n), 6) AS accuracy,
           round(tp / (tp + fp), 6) AS "precision", round(tp / p, 6) AS recall, round(f1, 6) AS f1,
           round((ranks - p * (p + 1) / 2) / (p * n), 6) AS area_under_roc
           FROM (SELECT *, 2 * tp / (2 * tp + fp + fn) AS f1, 2 * tn / (2 * tn + fp + fn) AS f0,
                   tp + fn AS p, tn + fp AS n
                 FROM (SELECT CAST(count(*) FILTER (failed AND worn) AS DOUBLE) AS tp,
                         CAST(count(*) FILTER (failed AND NOT worn) AS DOUBLE) AS fn,
                         CAST(count(*) FILTER (NOT failed AND worn) AS DOUBLE) AS fp,
                         CAST(count(*) FILTER (NOT failed AND NOT worn) AS DOUBLE) AS tn,
                         sum(place) FILTER (failed) AS ranks
                       FROM (SELECT machine_failure = 1 AS failed, tool_wear > 200 AS worn,
                               rank() OVER (ORDER BY tool_wear)
                               + (count(*) OVER (PARTITION BY tool_wear) - 1) / CAST(2 AS DOUBLE) AS place
                             FROM tel)))""",
        "tel",
    )

    # Speed and torque of the test data are one value on two scales. Four components hold all
    # there is, and what they leave out is the scaled difference of the two.
    def unit(c: str) -> str:
        return f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"

    out["recon_error"] = _sql(
        f"""SELECT event_id, round(power(({unit('rotational_speed')}) - ({unit('torque')}), 2) / 10, 6)
            AS recon_error FROM tel WHERE {complete}""",
        "tel",
    )

    out["simulated_rtt"] = _sql("SELECT event_id, latency_ms AS rtt_ms FROM tel", "tel")
    out["route_readings"] = _sql(
        "SELECT event_id, edge_id, window_no, seq, to_cloud FROM route8", "route8"
    )
    out["edge_alerts"] = _sql(edge.format(t="route8"), "route8")
    out["controller_windows"] = _sql(
        """SELECT edge_id, window_no, messages, round(mean_rtt, 6) AS mean_rtt,
           len(outliers) AS outliers FROM win8""",
        "win8",
    )
    out["controller_fold"] = _sql(f"SELECT {_SETTLED} FROM state1", "state1")
    out["controller_fold_many"] = _sql(f"SELECT {_SETTLED} FROM state8", "state8")
    out["controller_latest"] = _sql("SELECT * FROM latest8", "latest8")
    out["retrain_trigger"] = _sql(
        """SELECT records // 500 AS retrain_no, records, event_us, event_id
           FROM (SELECT *, row_number() OVER (ORDER BY event_us, event_id) AS records
                 FROM route8 WHERE to_cloud) WHERE records % 500 = 0""",
        "route8",
    )
    five = ("air_temp", "process_temp", "rotational_speed", "torque", "tool_wear")

    def covariance(a: str, b: str) -> str:
        return f"covar_pop({a}, {b}) / (max({a}) - min({a})) / (max({b}) - min({b}))"

    out["retrain_feedback"] = _sql(
        f"""SELECT 'retrain_complete' AS type, CAST(count(*) AS INTEGER) AS records_trained,
            true AS has_loss, round(({' + '.join(covariance(c, c) for c in five)}) / 5, 6) AS bare_loss
            FROM route8 WHERE to_cloud""",
        "route8",
    )
    out["retrain_moments"] = _sql(
        " UNION ALL ".join(
            f"""SELECT count(*) AS records, '{a}' AS feature, '{b}' AS other,
            round({covariance(a, b)}, 6) + 0.0 AS covariance FROM route8 WHERE to_cloud"""
            for a in five
            for b in five
        ),
        "route8",
    )
    out["cloud_backlog"] = _sql(
        "SELECT edge_id, window_no, cloud_messages, cloud_backlog FROM backlog8", "backlog8"
    )
    # The stream counts all records sent so far, the last open window included.
    out["controller_stream"] = _sql(
        """SELECT l.* REPLACE (CAST(b.sent % 500 AS INTEGER) AS cloud_backlog) FROM latest8 l
           JOIN (SELECT edge_id, count(*) FILTER (WHERE to_cloud) AS sent
                 FROM route8 GROUP BY edge_id) b ON b.edge_id = l.controller_id""",
        "latest8",
        "route8",
    )

    per_window = """SELECT edge_id, window_no, count(*) FILTER (WHERE to_cloud) AS cloud_messages,
        max(event_us) AS until FROM route8 GROUP BY edge_id, window_no"""
    out["backlog_notices"] = _sql(
        f"""SELECT w.edge_id, w.window_no, w.cloud_messages, CAST(w.sent - (
              SELECT count(*) FROM route8 r WHERE r.to_cloud AND r.edge_id = w.edge_id AND r.event_us < w.notice
            ) AS INTEGER) AS cloud_backlog
            FROM (
              SELECT x.*, sum(cloud_messages) OVER (PARTITION BY edge_id ORDER BY window_no) AS sent,
                (SELECT max(n.event_us) FROM (
                  SELECT event_us, row_number() OVER (ORDER BY event_us, event_id) AS records FROM route8 WHERE to_cloud
                ) n WHERE n.records % 500 = 0 AND n.event_us <= x.until) AS notice
              FROM ({per_window}) x) w""",
        "route8",
    )
    # The notice is on its way when the first half has been sent, if that were 500 records or more.
    out["feedback_loop"] = _sql(
        f"""SELECT w.edge_id, w.window_no, w.cloud_messages,
              CAST(w.sent - CASE WHEN w.until >= 1705276800000000 AND t.total >= 500 THEN coalesce(h.half, 0) ELSE 0 END
                AS INTEGER) AS cloud_backlog
            FROM (SELECT x.*, sum(cloud_messages) OVER (PARTITION BY edge_id ORDER BY window_no) AS sent
                  FROM ({per_window}) x) w
            LEFT JOIN (SELECT edge_id, count(*) AS half FROM route8
                       WHERE to_cloud AND event_us < 1705276800000000 GROUP BY edge_id) h ON h.edge_id = w.edge_id,
            (SELECT count(*) AS total FROM route8 WHERE to_cloud AND event_us < 1705276800000000) t""",
        "route8",
    )
    out["edge_stream"] = _sql(edge.format(t="route8"), "route8")
    out["cloud_stream"] = _sql(
        """SELECT count(*) AS records, CAST(sum(tool_wear) AS BIGINT) AS wear, count(*) AS trained,
           true AS model_agrees FROM route8 WHERE to_cloud""",
        "route8",
    )
    out["messages_once"] = _sql(
        """SELECT CASE WHEN to_cloud THEN 'history' ELSE 'alerts' END AS kept, count(*) AS records,
           CAST(sum(tool_wear) AS BIGINT) AS wear FROM route8
           WHERE to_cloud OR prediction_score = -1 GROUP BY to_cloud""",
        "route8",
    )
    out["alert_feed"] = _sql(
        f"SELECT {_SEVEN}, -1.0::DOUBLE AS prediction_score, true AS server_time FROM {_TOP.format(n=15)}",
        "alerts",
    )
    newest_first = "row_number() OVER (ORDER BY alert_us DESC, machine_id) - 1 AS position"
    oldest_first = "row_number() OVER (ORDER BY alert_us, machine_id) - 1 AS position"
    out["latest_alerts"] = _sql(
        f"SELECT {_SEVEN}, {newest_first} FROM {_TOP.format(n=15)}", "alerts"
    )
    out["alert_ticker"] = _sql(
        f"""SELECT machine_id, alert_us, round(rotational_speed, 0) AS rotational_speed,
            round(air_temp, 1) AS air_temp, round(torque, 1) AS torque, tool_wear,
            tool_wear > 200 AS wear_warning, {newest_first} FROM {_TOP.format(n=5)}""",
        "alerts",
    )
    out["sensor_series"] = _sql(
        f"""SELECT machine_id, alert_us, round(rotational_speed, 6) AS rotational_speed,
            tool_wear > 200 AS wear_warning, {oldest_first} FROM {_TOP.format(n=15)}""",
        "alerts",
    )
    out["fleet_summary"] = _sql(
        """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'CRITICAL') AS critical,
           count(*) FILTER (WHERE status <> 'CRITICAL') AS healthy,
           round(count(*) FILTER (WHERE status = 'CRITICAL') / count(*) * 100, 1) AS critical_pct,
           round(avg(air_temp), 6) AS avg_temp, min(air_temp) AS min_temp, max(air_temp) AS max_temp,
           round(avg(torque), 6) AS avg_torque, round(min(torque), 6) AS min_torque,
           round(max(torque), 6) AS max_torque FROM states""",
        "states",
    )
    out["machines_by_status"] = _sql(
        f"""SELECT {_STATES}, CASE WHEN status = 'CRITICAL' THEN 'critical' ELSE 'healthy' END AS list
            FROM states""",
        "states",
    )
    out["pagerank_top10"] = _sql(
        """SELECT place, machine_id, round(pagerank, 6) AS pagerank, place <= 3 AS top_three FROM (
           SELECT *, CAST(row_number() OVER (ORDER BY round(pagerank, 9) DESC, machine_id)
             AS INTEGER) AS place FROM ranks) WHERE place <= 10""",
        "ranks",
    )
    pages = """SELECT community_id, (no - 1) // 1000 AS page,
        string_agg(machine_id, ',' ORDER BY machine_id) AS machines FROM (
        SELECT *, row_number() OVER (PARTITION BY community_id ORDER BY machine_id) AS no
        FROM comm) GROUP BY 1, 2"""
    out["community_members"] = _sql(pages, "comm")
    out["community_top5"] = _sql(
        f"""SELECT p.*, s.member_count FROM ({pages}) p JOIN (
            SELECT community_id, count(*) AS member_count FROM comm GROUP BY 1
            ORDER BY 2 DESC, length(community_id), community_id LIMIT 5) s USING (community_id)""",
        "comm",
    )
    out["controller_lookup"] = _sql("SELECT * FROM looked_up", "looked_up")
    out["controller_card"] = _sql(_CARD, "looked_up")
    out["latency_bands"] = _sql(
        """SELECT event_id, delay_ms, CASE WHEN machine_failure = 1 THEN 'critical'
           WHEN delay_ms < 200 THEN 'optimal' WHEN delay_ms < 500 THEN 'moderate'
           ELSE 'critical' END AS band
           FROM (SELECT *, CAST(latency_ms + tool_wear AS BIGINT) AS delay_ms FROM tel)""",
        "tel",
    )

    out["context_refresh"] = _sql(
        """SELECT 'before' AS kind, count(*) AS readings,
           count(*) FILTER (WHERE prediction_score = -1) AS critical FROM base
           UNION ALL SELECT kind, count(*), count(*) FILTER (WHERE prediction_score = -1)
           FROM scored, (VALUES ('after'), ('too soon')) AS v(kind) GROUP BY kind
           UNION ALL SELECT 'reloaded', count(*), count(*) FILTER (WHERE verdict = -1) FROM (
             SELECT *, """ + _SCORE.format(a="k") + """ AS verdict FROM (SELECT *, CASE
               WHEN risk_score IS NULL THEN 0.0 ELSE coalesce(pr_score * 0.3::DOUBLE, 0.0) END AS k
               FROM adj))""",
        "base",
        "scored",
    )
    for name in ("pagerank", "label_propagation", "graph_scored", "route_readings"):
        out[f"{name}_large"] = out[name]
    return out
