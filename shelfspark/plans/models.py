"""The tree models of the queries, as node tables made by a rule: complete trees over the stock quantities, with leaves
that are exact in binary, so sums do not depend on their order."""

from __future__ import annotations

from collections.abc import Iterator

from shelfspark.names import CURDAY_QTY, IP_QTY
from shelfspark.operators.scorers import TreeTableScorer

TREES, DEPTH = 8, 3
#: ``shelf_count`` is unknown on every fifth day.
FEATURES = (IP_QTY, CURDAY_QTY, "shelf_count")
#: Base, leaf width and whether a sigmoid follows, by step.
SHAPES = {
    "step_1": (-0.25, 0.125, True),
    "step_2": (0.0, 0.125, True),
    "step_3": (0.75, 0.03125, False),
    "step_4": (20.0, 0.5, False),
}


def tree_nodes(step: str) -> Iterator[dict]:
    """The node table of one step's model, in order of trees."""
    s = int(step[-1])
    _, width, _ = SHAPES[step]
    inner = 2**DEPTH - 1
    for tree in range(TREES):
        for node in range(2 * inner + 1):
            mix = 31 * s + 17 * tree + 7 * node
            row = dict.fromkeys(("feature", "threshold", "left", "right", "leaf", "default_left"))
            if node < inner:
                row |= {
                    "feature": FEATURES[mix % len(FEATURES)], "threshold": mix % 37 - 0.5, "left": 2 * node + 1,
                    "right": 2 * node + 2, "default_left": mix % 3 > 0,
                }
            else:
                row["leaf"] = (mix % 29 - 14) * width
            yield {"tree": tree, "node": node, **row}


def tree_models() -> dict[str, TreeTableScorer]:
    return {step: TreeTableScorer(tree_nodes(step), base, sigmoid) for step, (base, _, sigmoid) in SHAPES.items()}
