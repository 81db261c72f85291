"""Tree ensembles compiled to conditional expressions, so that scoring runs inside the JVM.

A tree is a nested ``CASE``. It is cut into pieces of at most ``PIECE_NODES`` splits: a piece begins with the path that
leads to it and is zero on other rows, so exactly one piece of a tree gives its leaf and a tree's score is the sum of its
pieces. No expression nests deeper than a piece, however deep the tree. The pieces are the elements of an array that a
fold adds up: Spark generates no code for a fold, so a model of any size meets neither the size limit of a method nor
the time to compile one, and a fold under a condition that does not hold costs nothing. The pieces of a small model
(``COMPILED_SPLITS``) are added up in a step before the fold, which Spark does compile.

The model passes the driver tree by tree; what is kept is its text. It reads each feature from a column prepared once for
a row, as a double that is never NaN.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE_COLUMNS = ("tree", "node", "feature", "threshold", "left", "right", "leaf", "default_left")
PIECE_NODES = 31
#: Up to so many splits a model's code stays within the size of a method that the JVM compiles to machine code.
COMPILED_SPLITS = 64
SUM = "_trees_added"

Node = Mapping[str, object]


def _missing(value: object) -> bool:
    return value is None or (isinstance(value, float) and math.isnan(value))


def number(value: object) -> str:
    """A double literal."""
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"


def prepared(feature: str) -> str:
    """The column the pieces read a feature from: a double, or NULL where it is missing or NaN."""
    return f"_tree_{feature}"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _goes_left(node: Node) -> tuple[str, bool]:
    """A condition, and whether it being true means left. NULL does not make it true, so a missing value takes the
    other way, which is the default one."""
    name, at = quoted(prepared(str(node["feature"]))), number(node["threshold"])
    default_left = _missing(node.get("default_left")) or bool(node.get("default_left"))
    return (f"{name} >= {at}", False) if default_left else (f"{name} < {at}", True)


def tree_pieces(nodes: Sequence[Node], most: int = PIECE_NODES) -> list[str]:
    """The pieces of one tree as SQL text. Node 0 is its root; leaves have ``leaf``, splits all the rest."""
    by_number = {int(n["node"]): n for n in nodes}
    out, waiting = [], [(0, [])]
    while waiting:
        root, path = waiting.pop()
        inside, queue = set(), [root]
        while queue and len(inside) < most:  # the splits nearest to the root
            at = queue.pop(0)
            if _missing(by_number[at].get("leaf")):
                inside.add(at)
                queue += [int(by_number[at]["left"]), int(by_number[at]["right"])]

        def text(at: int, way: list[str]) -> str:
            node = by_number[at]
            if not _missing(node.get("leaf")):
                return number(node["leaf"])
            if at not in inside:
                waiting.append((at, way))
                return "0D"
            condition, left = _goes_left(node)
            then, other = (node["left"], node["right"]) if left else (node["right"], node["left"])
            no = f"coalesce(NOT ({condition}), true)"
            return (
                f"CASE WHEN {condition} THEN {text(int(then), [*way, f'({condition})'])} "
                f"ELSE {text(int(other), [*way, no])} END"
            )

        body = text(root, path)
        out.append(f"CASE WHEN {' AND '.join(path)} THEN {body} ELSE 0D END" if path else body)
    return out


def trees_of(nodes: Iterable[Node]) -> Iterator[list[Node]]:
    """Nodes sorted by tree, one tree at a time."""
    held: list[Node] = []
    for node in nodes:
        if held and node["tree"] != held[0]["tree"]:
            yield held
            held = []
        held.append(node)
    if held:
        yield held


def sorted_nodes(table: DataFrame) -> Iterator[Node]:
    """The rows of a node table in order of trees, fetched partition by partition."""
    return (row.asDict() for row in table.select(*NODE_COLUMNS).orderBy("tree", "node").toLocalIterator())


def splits_of(nodes: Sequence[Node]) -> int:
    return sum(_missing(n.get("leaf")) for n in nodes)


def features_of(nodes: Sequence[Node]) -> set[str]:
    return {str(n["feature"]) for n in nodes if _missing(n.get("leaf"))}


def added(pieces: Sequence[str], base: float) -> Column:
    """Base and pieces added up in the order of a fold, as an expression that Spark generates code for."""
    return F.expr(" + ".join([number(base), *pieces]))


def ensemble(pieces: Sequence[str], base: float, sigmoid: bool) -> Column:
    """Base and pieces added up, as a column."""
    total = F.expr(f"aggregate(array({', '.join(pieces)}), {number(base)}, (s, x) -> s + x)") if pieces else F.lit(base)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total)) if sigmoid else total
