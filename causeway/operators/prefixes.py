"""Fitted ensembles evaluated inside tasks at several sizes and depths at once.

A forest of many trees holds the smaller ones as its first trees, a boosted
model of many rounds those of fewer, and a deep tree the shallower ones as its
top. So one fitted ensemble answers for a whole set of grid points. The trees
are read from the stored form of the model, whose size the fit has bounded, and
are walked by tasks that hold a batch of rows each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import sparse
from ..session import scratch_path


# More levels than Spark's trees can have.
DEEPEST = 64
# Rows that are dense at a time.
ROWS = 2_000


@dataclass(frozen=True)
class Tree:
    """Nodes in the order of their ids; ``left`` is negative at a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # class shares of a classification tree, predictions of a regression tree

    def walk(self, x: np.ndarray, depths: list[int]) -> list[np.ndarray]:
        """The values of the rows of ``x`` where the tree ends, for each of the rising ``depths`` it may have."""
        at = np.zeros(len(x), np.int64)
        rows, out, depth = np.arange(len(x)), [], 0
        for limit in depths:
            while depth < limit:
                inner = self.left[at] >= 0
                if not inner.any():
                    break
                low = x[rows, np.maximum(self.feature[at], 0)] <= self.threshold[at]
                at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)
                depth += 1
            out.append(self.value[at])
        return out


def stored_trees(spark: SparkSession, model, shares: bool) -> list[Tree]:
    """The trees of a fitted ensemble in order. ``shares``: class shares instead of predictions."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    n = F.col("nodeData")
    nodes = (spark.read.parquet(f"{path}/data")
             .select("treeID", n["id"].alias("id"), n["prediction"].alias("prediction"), n["impurityStats"].alias("stats"),
                     n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"),
                     F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"))
             .toPandas().sort_values(["treeID", "id"]))
    out = []
    for _, t in nodes.groupby("treeID", sort=True):
        if shares:
            stats = np.array(t["stats"].tolist(), np.float64)
            total = stats.sum(axis=1, keepdims=True)
            value = np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)
        else:
            value = t["prediction"].to_numpy(np.float64)
        out.append(Tree(t["feature"].to_numpy(np.int64), t["threshold"].fillna(0.0).to_numpy(np.float64),
                        t["left"].to_numpy(np.int64), t["right"].to_numpy(np.int64), value))
    return out


def _counted(counts: dict, point: int, truth: np.ndarray, best: np.ndarray, n_classes: int) -> None:
    got = np.bincount(truth * n_classes + best, minlength=n_classes * n_classes)
    counts[point] = counts.get(point, 0) + got


def _confusions(df: DataFrame, run, width: int, n_classes: int, label: str) -> DataFrame:
    """Sums of the counts that ``run(features, truth, counts)`` adds up in each task: rows (point, truth, prediction, n)."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict = {}
        for pdf in batches:
            for a in range(0, len(pdf), ROWS):
                part = pdf.iloc[a:a + ROWS]
                run(dense(part["indices"], part["values"], width), part["truth"].to_numpy(np.int64), counts)
        rows = [(p, *divmod(i, n_classes), int(c)) for p, got in counts.items() for i, c in enumerate(got) if c]
        yield pd.DataFrame(rows, columns=["point", "truth", "prediction", "n"])

    rows = df.select(*sparse("features"), F.col(label).cast("int").alias("truth"))
    return (rows.mapInPandas(task, "point int, truth int, prediction int, n long")
            .groupBy("point", "truth", "prediction").agg(F.sum("n").alias("n")))


def forest_confusions(df: DataFrame, model, sizes: list[int], depths: list[int], n_classes: int, label: str = "label_index") -> DataFrame:
    """Rows (point, truth, prediction, n) for the forests of the first ``sizes`` trees and rising ``depths``; point = size x depths + depth, by position.

    A forest adds the class shares of its trees and predicts the first of the largest sums.
    """
    trees = stored_trees(df.sparkSession, model, shares=True)

    def run(x: np.ndarray, truth: np.ndarray, counts: dict) -> None:
        votes = np.zeros((len(depths), len(x), n_classes))
        for k, tree in enumerate(trees, 1):
            for d, value in enumerate(tree.walk(x, depths)):
                votes[d] += value
            for s in [i for i, size in enumerate(sizes) if size == k]:
                for d in range(len(depths)):
                    _counted(counts, s * len(depths) + d, truth, votes[d].argmax(axis=1), n_classes)

    return _confusions(df, run, model.numFeatures, n_classes, label)


def boosted_confusions(df: DataFrame, models: list, rounds: list[int], n_classes: int, label: str = "label_index") -> DataFrame:
    """As ``forest_confusions`` for one boosted model of each class, cut after each of ``rounds``; point = position of the rounds."""
    classes = [(m.treeWeights, stored_trees(df.sparkSession, m, shares=False)) for m in models]

    def run(x: np.ndarray, truth: np.ndarray, counts: dict) -> None:
        shares = np.zeros((len(rounds), len(x), n_classes))
        for c, (weights, trees) in enumerate(classes):
            margin = np.zeros(len(x))
            for k, (w, tree) in enumerate(zip(weights, trees), 1):
                margin += w * tree.walk(x, [DEEPEST])[0]
                for s in [i for i, size in enumerate(rounds) if size == k]:
                    shares[s, :, c] = 1 / (1 + np.exp(-2 * margin))
        for s in range(len(rounds)):
            _counted(counts, s, truth, shares[s].argmax(axis=1), n_classes)

    return _confusions(df, run, models[0].numFeatures, n_classes, label)


def scores_of(counts: np.ndarray) -> dict[str, float]:
    """Accuracy and the means of precision, recall and F1 from a matrix (truth, prediction); classes in neither are left out."""
    right, support, found = counts.diagonal().astype(float), counts.sum(axis=1), counts.sum(axis=0)
    there = (support + found) > 0
    right, support, found = right[there], support[there], found[there]

    def ratio(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b != 0)
    precision, recall = ratio(right, found), ratio(right, support)
    f1 = ratio(2 * precision * recall, precision + recall)
    total = support.sum()
    out = {"accuracy": float(right.sum() / total) if total else 0.0}
    for name, values in (("precision", precision), ("recall", recall), ("f1", f1)):
        out[f"macro_{name}"] = float(values.mean()) if len(values) else 0.0
        out[f"weighted_{name}"] = float((values * support).sum() / total) if total else 0.0
    return out


def dense(indices, values, width: int) -> np.ndarray:
    """Rows of sparse vectors."""
    out = np.zeros((len(indices), width))
    for i, (at, v) in enumerate(zip(indices, values)):
        out[i, at] = v
    return out
