"""Default constants of the pipeline, in metres, seconds and degrees."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Graph:
    look: float = 10.0
    target: float = 55.0
    straight: float = 25.0
    u_turn: float = 170.0
    left_right: float = 120.0
    predecessor: float = 75.0
    same_way: float = 60.0
    other_way: float = 45.0
    parallel: float = 60.0
    junction_length: float = 18.0
    depth: int = 10
    lane_rounds: int = 10
    signal_tolerance: float = 1.0
    signal_offset: float = 3.5
    signal_start: float = 15.0


@dataclass(frozen=True)
class Matching:
    sampling_ms: int = 1000
    jitter: float = 0.1
    radius: float = 50.0
    heading: float = 90.0
    partial_length: float = 50.0
    partial_share: float = 0.6
    vehicles: int = 5
    signal_proximity: float = 5.0
    min_points: int = 50
    lane_width: float = 3.2
    bins: int = 40
    samples: int = 15_000


@dataclass(frozen=True)
class Traversal:
    gap: float = 15.0
    edge_min: float = 10.0
    edge_max: float = 35.0
    edge_share: float = 0.5
    step: float = 10.0
    stopped: float = 0.1
    min_time: float = 2.0
    offset: float = 0.001
    outlier_share: float = 0.80
    outlier_stop: float = 25.0
    parked: float = 120.0
    low_volume: int = 10


@dataclass(frozen=True)
class Unify:
    removal: float = 0.2
    missing: int = 3
    consensus: float = 0.8


@dataclass(frozen=True)
class States:
    tau: float = 30.0
    first_dt: float = 300.0
    interval: float = 10.0


@dataclass(frozen=True)
class Features:
    cav_share: float = 0.15
    radius: float = 55.0
    heading: float = 65.0
    dt: float = 1.1
    ds: float = 50.0
    dd: float = 1.6
    car: float = 5.0
    other: float = 12.5
    gap: float = 2.0
    fallback: float = 10.0
