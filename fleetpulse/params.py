"""Tunable parameters. The defaults are the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ScoringParams:
    """Graph-aware anomaly thresholds."""

    risk_weight: float = 0.4
    rank_weight: float = 0.3
    base_tool_wear: float = 200.0
    base_rpm: float = 1300.0
    rpm_span: float = 200.0
    # Ranks sum to the number of machines, so the adjustment can exceed 1. Off by default.
    clamp_adjustment: bool = False


@dataclass(frozen=True)
class GraphParams:
    reset: float = 0.15
    pagerank_iters: int = 10
    label_iters: int = 5
    # 0 asks for the exact median, anything above for an approximate one.
    median_rel_err: float = 0.0
    checkpoint_every: int = 5


@dataclass(frozen=True)
class ControllerParams:
    """Closed-loop routing controller."""

    controller_id: str = "edge_controller_v1"
    window_size: int = 200
    rate_alpha: float = 0.3
    rtt_beta: float = 0.2
    start_threshold: float = 200.0
    start_sample_rate: float = 0.2
    start_interval: int = 500
    start_rate: float = 0.0
    start_rtt: float = 250.0
    high_rate: float = 0.15
    low_rate: float = 0.02
    threshold_step: float = 20.0
    threshold_fine: float = 5.0
    rtt_trend: float = 5.0
    sample_step: float = 0.05
    interval_down: int = 50
    interval_up: int = 100
    threshold_min: float = 100.0
    threshold_max: float = 400.0
    sample_min: float = 0.1
    sample_max: float = 0.9
    interval_min: int = 200
    interval_max: int = 2000
    retrain_every: int = 500
    retrain_min_rows: int = 50


@dataclass(frozen=True)
class LatencyParams:
    rtt_min: int = 50
    rtt_max: int = 500
    optimal_below: int = 200
    moderate_below: int = 500


@dataclass(frozen=True)
class ForestParams:
    """Random forest on labelled telemetry."""

    trees: int = 50
    depth: int = 5
    train_share: float = 0.8
    seed: int = 42
    min_rows: int = 100


@dataclass(frozen=True)
class IsolationParams:
    trees: int = 100
    sample_size: int = 256
    contamination: float = 0.05
    seed: int = 42


@dataclass(frozen=True)
class ScaleLimits:
    """Bounds that decide between two exact ways of doing the same work."""

    # A join side is broadcast only when its measured size is below this.
    broadcast_bytes: int = 64 * 1024 * 1024
    # A join or graph key with more rows than this is treated as hot.
    hot_rows: int = 1_000_000
    # Graph edges are bucketed from this number on, and a bucket holds about as many.
    bucket_rows: int = 2_000_000
    # A bucket is a task of every step and reports to the driver, so from this number on buckets grow.
    max_buckets: int = 1024
    # Rows of a partition that is held in memory to train a forest.
    task_rows: int = 200_000
    # Longest array built for a member list.
    page_rows: int = 1000
    # Rows per block of a two-level running total.
    block_rows: int = 4096
