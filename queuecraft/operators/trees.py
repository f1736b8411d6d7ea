"""Contributions of a boosted tree model, row by row, additive in log-odds.

The fitted ensemble is read back from its saved form. For every leaf the Shapley values of all
patterns 'which path conditions does the row meet' are worked out once; a batch of rows is then
a table lookup per leaf. Vectorised over Arrow batches; the model is the only thing that travels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARGIN_TO_LOG_ODDS = 2.0  # the probability is a logistic of twice the ensemble's margin


def saved_nodes(spark: SparkSession, path: str) -> tuple[pd.DataFrame, list[float]]:
    """Tree nodes and tree weights of a saved ensemble."""
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.rawCount").cast("double").alias("cover"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("cut"), F.col("nodeData.split.numCategories").alias("kinds"))
    rows = nodes.toPandas()      # a model: its size is set by its own number and depth of trees, not by the data
    if (rows["kinds"] >= 0).any():
        raise ValueError("categorical splits: one-hot the input first")
    # the saved table has positional columns: tree number, metadata, weight
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weight").orderBy("treeID").collect()
    return rows, [w["weight"] for w in weights]


def _leaf_table(value: float, shares: list[float]) -> np.ndarray:
    """Shapley values of one leaf for every pattern of met conditions: [pattern, feature on the path]."""
    m = len(shares)
    weight = [math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)]
    table = np.zeros((2 ** m, m))
    for pattern in range(2 ** m):
        met = [(pattern >> i) & 1 for i in range(m)]
        for j in range(m):
            sizes = np.array([1.0])      # coefficient s: sum over subsets of s other features
            for i in range(m):
                if i != j:
                    sizes = np.convolve(sizes, [shares[i], met[i]])
            table[pattern, j] = value * (met[j] - shares[j]) * float(np.dot(sizes, weight))
    return table


def _background_table(value: float, share: np.ndarray) -> np.ndarray:
    """The same against a background: ``share`` is the weight of background rows by the pattern of conditions they meet.

    A leaf is reached by a mix of row and background row if each condition is met by the one the feature is taken from. Of
    m conditions that only the row meets and n that only the background row meets, a feature of the first kind gets
    (m-1)! n! / (m+n)! of the value, one of the second kind loses m! (n-1)! / (m+n)!.
    """
    m = len(share).bit_length() - 1
    table = np.zeros((len(share), m))
    for pattern in range(len(share)):
        for other in np.flatnonzero(share):
            other = int(other)
            if pattern | other != len(share) - 1 or pattern == other:
                continue
            mine, theirs = pattern & ~other, other & ~pattern
            a, b = mine.bit_count(), theirs.bit_count()
            for j in range(m):
                if mine >> j & 1:
                    table[pattern, j] += share[other] * value * math.factorial(a - 1) * math.factorial(b) / math.factorial(a + b)
                elif theirs >> j & 1:
                    table[pattern, j] -= share[other] * value * math.factorial(a) * math.factorial(b - 1) / math.factorial(a + b)
    return table


def patterns_of(rows: np.ndarray, features: list[int], tests: list, known: dict | None = None) -> np.ndarray:
    """Which of a leaf's conditions each row meets, a bit per feature. Leaves share conditions: ``known`` keeps what was
    already compared for these rows."""
    known = {} if known is None else known

    def meets(f: int, cut: float, low: bool) -> np.ndarray:
        if (f, cut, low) not in known:
            known[f, cut, low] = (rows[:, f] <= cut) if low else (rows[:, f] > cut)
        return known[f, cut, low]

    pattern = np.zeros(len(rows), dtype=np.int64)
    for i, (f, conditions) in enumerate(zip(features, tests)):
        met = meets(f, *conditions[0])
        for condition in conditions[1:]:
            met = met & meets(f, *condition)
        pattern |= met.astype(np.int64) << i
    return pattern


def leaf_tables(nodes: pd.DataFrame, weights: list[float], background: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[list, float]:
    """Per leaf its conditions per feature and its table; and the ensemble's expected margin.

    Without ``background`` (rows, weights) what is expected of an unknown feature follows the trees' own row counts.
    """
    leaves, base = [], 0.0
    for tree, part in nodes.groupby("treeID"):
        by_id = {r.id: r for r in part.itertuples()}
        stack = [(by_id[0], [])]
        while stack:
            node, path = stack.pop()
            if node.left < 0:
                value = node.value * weights[tree]
                features = sorted({f for f, _, _, _ in path})
                tests = [[(c, low) for f, c, low, _ in path if f == g] for g in features]
                if background is None:
                    base += value * node.cover / by_id[0].cover
                    table = _leaf_table(value, [math.prod(s for f, _, _, s in path if f == g) for g in features])
                else:
                    share = np.bincount(patterns_of(background[0], features, tests), background[1], 2 ** len(features)) / background[1].sum()
                    base += value * share[-1]
                    table = _background_table(value, share)
                if features:
                    leaves.append((features, tests, table))
                continue
            cut = float(node.cut[0])
            for child, low in ((by_id[node.left], True), (by_id[node.right], False)):
                stack.append((child, [*path, (int(node.feature), cut, low, child.cover / node.cover)]))
    return leaves, base


def contributions_of(rows: np.ndarray, leaves: list) -> np.ndarray:
    by_feature = np.asfortranarray(rows)        # leaves read and add whole columns
    out, known = np.zeros_like(by_feature, dtype=np.float64), {}
    for features, tests, table in leaves:
        pattern = patterns_of(by_feature, features, tests, known)
        for i, f in enumerate(features):
            out[:, f] += table[:, i][pattern]
    return out


BACKGROUND = 100        # rows that stand for all others in contributions against a background


def background_of(df: DataFrame, key: str, features: str = "features", weight: str | None = None, size: int = BACKGROUND) -> tuple[np.ndarray, np.ndarray]:
    """A bounded sample of rows by a hash of the key, with their weights."""
    one = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(vector_to_array(features).alias("x"), one.alias("w"), F.xxhash64(key).alias("_h"), key).orderBy("_h", key).limit(size).collect()
    return np.array([r["x"] for r in rows]), np.array([r["w"] for r in rows])


def log_odds() -> Column:
    """What the model itself says of a row it has scored."""
    return MARGIN_TO_LOG_ODDS * vector_to_array("rawPrediction")[1]


def total() -> Column:
    """Base and contributions of a row together."""
    return F.col("base") + F.aggregate("phis", F.lit(0.0), lambda a, x: a + x)


def additivity(contributions: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Contributions with the model's own log-odds and how far base and contributions together miss them."""
    own = scored.select(key, log_odds().alias("log_odds"))
    # summed before the join: who asks for the gap alone has two numbers a row shuffled, not all contributions
    summed = contributions.withColumn("_total", total())
    # one row each: the planner may guess from the compressed files that one side is small enough for every task
    return summed.hint("merge").join(own, key).withColumn("gap", F.abs(F.col("_total") - F.col("log_odds"))).drop("_total")


def tree_contributions(df: DataFrame, path: str, key: str, features: str = "features",
                       background: tuple[np.ndarray, np.ndarray] | None = None, keep: Sequence[str] = (),
                       strongest: int = 0) -> DataFrame:
    """(key, base, values, phis, keep) of a boosted ensemble saved at ``path``; base + sum(phis) is the log-odds.

    With ``background`` an unknown feature is taken from the background rows instead of from the trees' row counts. With
    ``strongest`` the places of so many largest contributions by absolute size are added (``strongest``, ties by place).
    """
    spark = df.sparkSession
    leaves, base = leaf_tables(*saved_nodes(spark, path), background)
    model = spark.sparkContext.broadcast(leaves)
    start = base * MARGIN_TO_LOG_ODDS

    names = [key, "base", "values", "phis", *keep, *(["strongest"] if strongest else [])]

    def listed(cells: np.ndarray) -> pa.ListArray:
        ends = pa.array(np.arange(len(cells) + 1, dtype=np.int32) * cells.shape[1], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(cells.ravel()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, values = batch.num_rows, batch.column(1)
            # all vectors have one length: cells and results stay flat, no row becomes an object of its own
            rows = values.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))
            phis = np.ascontiguousarray(contributions_of(rows, model.value) * MARGIN_TO_LOG_ODDS)
            columns = [batch.column(0), pa.array(np.full(n, start)), values, listed(phis), *batch.columns[2:]]
            if strongest:
                columns.append(listed(np.argsort(-np.abs(phis), axis=1, kind="stable")[:, :strongest].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = lambda c: f"`{c}` {df.schema[c].dataType.simpleString()}"
    return df.select(key, vector_to_array(features).alias("values"), *keep).mapInArrow(
        score, ", ".join([kind(key), "base double, values array<double>, phis array<double>", *map(kind, keep), *(["strongest array<int>"] if strongest else [])]))
