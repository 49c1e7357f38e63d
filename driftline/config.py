"""Parameters of the flow pipeline."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    # validity
    max_trip_hours: int = 24
    min_lat: float = 40.4
    max_lat: float = 41.0
    min_lng: float = -74.3
    max_lng: float = -73.6
    # network
    cluster_m: float = 2.0
    snap_cap_m: float = 30.0
    min_edge_m: float = 0.1
    excluded_road_types: tuple[int, ...] = (2, 4, 9, 14)
    min_component: int = 50_000
    # routing: 0 means all pairs
    n_od_pairs: int = 0
    #: pairs to a batch of routing, 0 for one batch; trips in the compact export, 0 for all
    route_batch: int = 0
    max_trips: int = 0
    #: which table of flows is exported, and whether animation tables are left out
    flow_table: str = "sum"
    skip_timelapse: bool = False
    max_broadcast_edges: int = 5_000_000
    # animation
    start_date: str = "2023-06-01"
    clock_s: int = 180
    min_dur: float = 0.1
    simplify_deg: float = 0.000045
    buckets: int = 256
    # playback
    speed_mps: float = 3.5
    metres_per_degree: float = 111_320.0
    min_playback_s: float = 30.0
    ease: float = 0.15
    #: prefix of a station id -> code that replaces all but its final digits; fixed values
    station_codes: tuple[tuple[str, str], ...] = (("^SYS", "9000"), ("^JC", "8000"), ("^HB", "7000"), ("^Lab - NYC", "6000"))
    keywords: tuple[str, ...] = field(default=("BRIDGE", "BRG"))

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        """Variables of the environment (below) override the defaults."""
        env = os.environ if env is None else env
        given = {"n_od_pairs": ("N_OD_PAIRS", int), "snap_cap_m": ("SNAP_CAP_M", float), "start_date": ("START_DATE", str), "clock_s": ("CLOCK_S", int)}
        given |= {"route_batch": ("ROUTE_BATCH_SIZE", int), "max_trips": ("MAX_TRIPS", int), "flow_table": ("FLOW_TABLE", str)}
        given |= {"skip_timelapse": ("SKIP_TIMELAPSE", lambda v: v.strip().lower() not in ("", "0", "false", "no"))}
        return cls(**{name: kind(env[key]) for name, (key, kind) in given.items() if env.get(key)})
