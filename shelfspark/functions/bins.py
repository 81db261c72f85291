"""Edges of the probability bins around a cut-off.

At most twelve values per call, so they are plain floats on the driver and become literals in the plan.
"""

from __future__ import annotations

import numpy as np

_STEP = 0.1


def _walk(threshold: float, step: float) -> list[float]:
    """Threshold, threshold + step, ... as running sums (the running sum decides how an edge rounds)."""
    if not 0 <= threshold <= 1:
        raise ValueError(f"threshold must lie in [0, 1], got {threshold}")
    return [float(v) for v in np.cumsum([threshold] + [step] * 12)]


def upper_edges(threshold: float) -> list[float]:
    """Edges from the threshold up to 1.0."""
    _, *above = _walk(threshold, _STEP)
    return [float(threshold)] + [round(v, 1) for v in above if v <= 1]


def lower_edges(threshold: float) -> list[float]:
    """Edges from 0.0 up to the threshold."""
    walk = _walk(threshold, -_STEP)
    below = [abs(round(v, 1)) for above, v in zip(walk, walk[1:]) if round(above, 1) > 0]
    return sorted(below + [float(threshold)])


def upper_bins(threshold: float, close_last: bool = False) -> list[tuple[float, float, bool]]:
    """``(start, end, closed)``; one bin per start, the later one wins where two edges coincide.

    The last bin is open at 1.0 unless ``close_last`` is set, so a probability of exactly 1.0 is in no bin.
    """
    edges = upper_edges(threshold)
    by_start = dict(zip(edges, edges[1:]))
    last = max(by_start, default=None)
    return [(s, e, close_last and s == last) for s, e in by_start.items()]


def lower_bins(threshold: float) -> list[tuple[float, float, bool]]:
    """``(start, start + 0.1, False)`` for every edge below the threshold."""
    return [(s, round(s + _STEP, 1), False) for s in lower_edges(threshold)[:-1]]
