"""Detection thresholds, overridable per call."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Fixed default values of the detectors.
    ring_min_size: int = 5
    ring_density: float = 0.6
    star_min_degree: int = 10
    star_ratio: float = 0.8
    min_edges: int = 3
    spike_pct: float = 0.2
    body_pct: float = 10.0


DEFAULTS = Params()
