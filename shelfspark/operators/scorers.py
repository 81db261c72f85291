"""Model scoring: linear models and tree ensembles as expressions, fitted Spark ML models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import nan_to_null
from shelfspark.names import BINARY_PRED, HL_ORIG_PRED, HS_PRED, LS_RATIO
from shelfspark.operators import trees
from shelfspark.operators.cascade import cast_object_features, is_higher_stock, is_lower_stock, is_rest
from shelfspark.sources.scratch import delete_path, scratch_path


class Scorer:
    """A list of feature columns and a way to turn them into one score column.

    Where ``active`` is given, rows on which it is not true get NULL and cost nothing.
    """

    features: list[str]

    def add(self, df: DataFrame, out: str, active: Column | None = None) -> DataFrame:
        """``df`` with the score as ``out``."""
        raise NotImplementedError


@dataclass
class LinearScorer(Scorer):
    """Weighted sum, optionally through a sigmoid. A plain expression: no Python worker."""

    weights: Mapping[str, float]
    intercept: float = 0.0
    sigmoid: bool = False

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def add(self, df: DataFrame, out: str, active: Column | None = None) -> DataFrame:
        terms = [F.lit(float(w)) * F.col(c).cast("double") for c, w in self.weights.items()]
        total = reduce(lambda a, b: a + b, terms, F.lit(float(self.intercept)))
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-total)) if self.sigmoid else total
        return df.withColumn(out, score if active is None else F.when(active, score))


class TreeTableScorer(Scorer):
    """A boosted tree ensemble held as a node table, compiled to expressions.

    Node columns: ``tree, node, feature, threshold, left, right, leaf, default_left``; node 0 is the root of
    its tree and ``leaf`` is set on leaves only. ``value < threshold`` goes left, a missing value goes where
    ``default_left`` says. The score is base + sum of leaves, through a sigmoid for a classifier.
    """

    def __init__(self, nodes: pd.DataFrame | Iterable[Mapping], base: float = 0.0, sigmoid: bool = False):
        if isinstance(nodes, pd.DataFrame):
            nodes = nodes.sort_values(["tree", "node"]).to_dict("records")
        self.base, self.sigmoid = float(base), sigmoid
        self.pieces: list[str] = []
        self.splits = 0
        features: set[str] = set()
        for tree in trees.trees_of(nodes):
            self.pieces += trees.tree_pieces(tree)
            self.splits += trees.splits_of(tree)
            features |= trees.features_of(tree)
        self.features = sorted(features)

    @classmethod
    def from_table(cls, nodes: DataFrame, base: float = 0.0, sigmoid: bool = False) -> TreeTableScorer:
        """Compile a stored node table, tree by tree."""
        return cls(trees.sorted_nodes(nodes), base, sigmoid)

    def add(self, df: DataFrame, out: str, active: Column | None = None) -> DataFrame:
        """The score is generated, as the one element of an array: a filter on a plain column would be pushed below it
        as text, with the whole ensemble, and whatever its features are derived from, once for each mention. So is the
        sum of a small model, which the fold then takes as its one piece: the fold itself would interpret its pieces."""
        def generated(rows: DataFrame, value: Column, name: str) -> DataFrame:
            return rows.select("*", F.explode(F.array(value if active is None else F.when(active, value))).alias(name))

        ready = [nan_to_null(F.col(trees.quoted(c)).cast("double")).alias(trees.prepared(c)) for c in self.features]
        made, pieces, base = df.select("*", *ready), self.pieces, self.base
        if 0 < self.splits <= trees.COMPILED_SPLITS:
            made, pieces, base = generated(made, trees.added(pieces, base), trees.SUM), [trees.SUM], 0.0
        made = generated(made, trees.ensemble(pieces, base, self.sigmoid), "_score")
        return made.withColumn(out, F.col("_score")).drop("_score", trees.SUM, *map(trees.prepared, self.features))


def score_model(df: DataFrame, scorer: Scorer, out: str, active: Column | None = None) -> DataFrame:
    """Add one score column; string-typed features are cast to integers first."""
    return scorer.add(cast_object_features(df, scorer.features), out, active)


def score_independent(df: DataFrame, models: Mapping[str, Scorer]) -> DataFrame:
    """Every model on every row. ``models`` maps step_1 .. step_4 to scorers."""
    typed = cast_object_features(df, sorted({f for m in models.values() for f in m.features}))
    outs = {"step_1": BINARY_PRED, "step_2": HL_ORIG_PRED, "step_3": LS_RATIO, "step_4": HS_PRED}
    for step, model in models.items():
        typed = model.add(typed, outs[step])
    return typed


def score_cascade(df: DataFrame, models: Mapping[str, Scorer], t1: float = 0.4, t2: float = 0.4) -> DataFrame:
    """Each model only on the rows routed to it: a model's expression is one side of a condition on the scores before
    it, and Spark evaluates no side that is not taken."""
    typed = cast_object_features(df, sorted({f for m in models.values() for f in m.features}))
    scored = models["step_1"].add(typed, BINARY_PRED)
    scored = models["step_2"].add(scored, HL_ORIG_PRED, is_rest(t1))
    scored = models["step_3"].add(scored, LS_RATIO, is_lower_stock(t1, t2))
    return models["step_4"].add(scored, HS_PRED, is_higher_stock(t1, t2))


def _assembled(df: DataFrame, features: list[str], vector: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=features, outputCol=vector, handleInvalid="keep")
    return assembler.transform(cast_object_features(df, features))


def fit_ml_model(train: DataFrame, estimator, features: list[str], weight: str | None = None):
    """A ``pyspark.ml`` model fitted on the rows that have a label and all features.

    An estimator reads its rows several times, so they are stored first, as these columns alone. Equal rows are stored once
    with their number where ``weight`` names a column for it. That is for estimators that read it as their weights and to
    which a weight is the same as so many copies, as in a sum of losses; not where rows are drawn or counted.
    """
    label = estimator.getLabelCol()
    known = train.select(*features, F.col(label).cast("double").alias(label)).dropna()
    if weight is not None:
        known = known.groupBy(*known.columns).agg(F.count(F.lit(1)).cast("double").alias(weight))
    path = scratch_path(train.sparkSession, "ml-train")
    known.write.parquet(path)
    model = estimator.fit(_assembled(train.sparkSession.read.parquet(path), features, estimator.getFeaturesCol()))
    delete_path(train.sparkSession, path)
    return model


def score_ml_model(df: DataFrame, model, features: list[str], out: str) -> DataFrame:
    """Score with a fitted ``pyspark.ml`` model: class-1 probability of a classifier, else the prediction."""
    from pyspark.ml.functions import vector_to_array

    # The model's own column parameters are those its features and outputs travel under.
    scored = model.transform(_assembled(df, features, model.getFeaturesCol()))
    if model.hasParam("probabilityCol"):
        score = vector_to_array(F.col(model.getProbabilityCol()))[1]
    else:
        score = F.col(model.getPredictionCol())
    return scored.withColumn(out, score).select(*df.columns, out)

