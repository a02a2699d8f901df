"""Shapley attributions of boosted trees, exact along the trees' own paths, for every row.

A leaf pays its value to rows that meet all conditions on its path. With a feature unknown, the path is
followed in the share of training rows that took it, so a leaf is a game of the few features on its path: each
either holds (1) or not (0) in a row, or weighs in with its share. Shapley values of that game depend on
which features hold only, at most 2 to the depth cases; they are tabled once for each leaf, and a row
looks up its case in every leaf. Tables are broadcast: their size is bounded by trees and depth, not by rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from ..sources.staging import drop_path, fresh_path

# Executors need not have this package: what runs there travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Node:
    """``feature`` is -1 in a leaf; rows with a value of at most ``threshold`` go left."""

    feature: int
    threshold: float
    left: int
    right: int
    value: float
    cover: float


@dataclass(frozen=True)
class Leaf:
    """Features on the path with the range (low, high] each must lie in and the share of rows that do."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: float


def tree_nodes(spark: SparkSession, booster) -> list[dict[int, Node]]:
    """The nodes of every tree, by number, from the saved model."""
    path = fresh_path(spark, "model")
    booster.write().save(path)
    trees: list[dict[int, Node]] = [{} for _ in booster.treeWeights]
    for tree, n in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").toLocalIterator():
        split = n["split"]
        if split["numCategories"] != -1:
            raise ValueError("only splits of numbers are explained")
        inner = n["leftChild"] >= 0
        trees[tree][n["id"]] = Node(
            split["featureIndex"] if inner else -1,
            split["leftCategoriesOrThreshold"][0] if inner else 0.0,
            n["leftChild"],
            n["rightChild"],
            n["prediction"],
            n["impurityStats"][0],
        )
    drop_path(spark, path)
    return trees


def leaves(nodes: dict[int, Node], weight: float = 1.0) -> list[Leaf]:
    out: list[Leaf] = []
    open_nodes = [(0, {})]  # a node and, by feature, (low, high, share) on the way to it
    while open_nodes:
        number, path = open_nodes.pop()
        n = nodes[number]
        if n.feature < 0:
            names = sorted(path)
            low, high, share = (np.array([path[f][k] for f in names]) for k in range(3))
            out.append(Leaf(np.array(names, np.int64), low, high, share, n.value * weight))
            continue
        before = path.get(n.feature, (-math.inf, math.inf, 1.0))
        for child, low, high in (
            (n.left, before[0], min(before[1], n.threshold)),
            (n.right, max(before[0], n.threshold), before[1]),
        ):
            share = before[2] * nodes[child].cover / n.cover
            open_nodes.append((child, {**path, n.feature: (low, high, share)}))
    return out


def cases(leaf: Leaf) -> np.ndarray:
    """Shapley values of the path's features for every case; bit k of a case: feature k holds."""
    d = len(leaf.share)
    held = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
    weights = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
    out = np.zeros((1 << d, d))
    for i in range(d):
        # Coefficient k: all ways in which k of the other features are known.
        sums = np.zeros((1 << d, d))
        sums[:, 0] = 1
        for j in range(d):
            if j != i:
                known = np.zeros_like(sums)
                known[:, 1:] = sums[:, :-1] * held[:, j : j + 1]
                sums = sums * leaf.share[j] + known
        out[:, i] = leaf.value * (held[:, i] - leaf.share[i]) * (sums @ weights)
    return out


@dataclass
class Explainer:
    """``base`` is what the model says of a row of which nothing is known."""

    base: float
    leaves: list[tuple[Leaf, np.ndarray]]

    def explain(self, x: np.ndarray) -> np.ndarray:
        """A value for each row and feature; with ``base`` they add up to the row's margin."""
        out = np.zeros(x.shape)
        for leaf, table in self.leaves:
            picked = x[:, leaf.features]
            holds = (picked > leaf.low) & (picked <= leaf.high)
            case = holds @ (1 << np.arange(len(leaf.features)))
            out[:, leaf.features] += table[case]
        return out


def explainer(spark: SparkSession, booster) -> Explainer:
    found = [
        leaf
        for nodes, weight in zip(tree_nodes(spark, booster), booster.treeWeights, strict=True)
        for leaf in leaves(nodes, weight)
    ]
    base = sum(leaf.value * float(np.prod(leaf.share)) for leaf in found)
    return Explainer(base, [(leaf, cases(leaf)) for leaf in found if len(leaf.features)])


def attributions(model: PipelineModel, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, margin, base, shap): for every row an array with the attribution of each feature.

    The margin is the score before it is turned into a probability; ``base`` and ``shap`` add up to it.
    """
    spark = df.sparkSession
    assembler, booster = model.stages
    sent = spark.sparkContext.broadcast(explainer(spark, booster))
    scored = booster.transform(assembler.transform(df)).select(
        *keys, vector_to_array("rawPrediction")[1].alias("margin"), vector_to_array("features").alias("__x")
    )
    names = [*keys, "margin"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("__x")
            features = len(x[0])
            values = held.explain(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, features))
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * features)
            shap = pa.ListArray.from_arrays(ends, pa.array(values.ravel()))
            base = pa.array(np.full(b.num_rows, held.base))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), base, shap], [*names, "base", "shap"])

    schema = StructType([scored.schema[c] for c in names]).add("base", DoubleType()).add("shap", ArrayType(DoubleType()))
    return scored.mapInArrow(run, schema)


def importance(explained: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, importance): the mean size of each feature's attributions over all rows."""
    means = explained.agg(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.avg(F.abs(F.col("shap")[j])).alias("importance"))
                  for j, c in enumerate(columns)]).alias("all")
    )
    return means.select(F.inline("all"))
