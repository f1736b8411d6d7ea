"""Training, cross-validation, calibration and scoring with Spark ML."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.operators import metrics, ordering, prep, resample
from queuecraft.session import release, scrapped, staged, written

SEED = 42
BLOCK_ROWS = 1 << 24      # permuted rows that are scored and ordered at once
PART_CELLS = 1 << 24       # numbers in a partition of a fit's rows: 128 MB, so that a small table's passes are few tasks


class AveragePrecision(Evaluator):
    """Average precision with grouped ties, for the ML tuning classes."""

    def __init__(self, label: str = "label"):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(positive_probability(dataset).alias("score"), F.col(self.label).cast("int").alias("label"))
        return metrics.average_precision(scored, "score", "label").first()[0] or 0.0

    def isLargerBetter(self) -> bool:
        return True


def positive_probability(df: DataFrame, column: str = "probability"):
    """Probability of class 1; a margin model offers its margin instead."""
    source = column if column in df.columns else "rawPrediction"
    return vector_to_array(F.col(source))[1]


def logistic(weight: str | None = "weight", **params) -> LogisticRegression:
    given = {"maxIter": 50, "regParam": 0.0, **params}
    return LogisticRegression(**given, **({"weightCol": weight} if weight else {}))


def boosted(weight: str | None = "weight", holdout: str | None = None, **params) -> GBTClassifier:
    """Boosted trees; with ``holdout`` (a boolean column) fitting stops when it no longer improves there."""
    given = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": SEED, **params}
    extra = {**({"weightCol": weight} if weight else {}), **({"validationIndicatorCol": holdout} if holdout else {})}
    return GBTClassifier(**given, **extra)


def forest(weight: str | None = "weight", **params) -> RandomForestClassifier:
    given = {"numTrees": 20, "maxDepth": 5, "seed": SEED, **params}
    return RandomForestClassifier(**given, **({"weightCol": weight} if weight else {}))


def margin_machine(weight: str | None = "weight", **params) -> LinearSVC:
    given = {"maxIter": 20, "regParam": 0.01, **params}
    return LinearSVC(**given, **({"weightCol": weight} if weight else {}))


def score_with(model: Model, df: DataFrame, keep: Sequence[str], out: str = "score") -> DataFrame:
    made = model.transform(df)
    return made.select(*keep, positive_probability(made).alias(out))


def out_of_fold(df: DataFrame, key: str, label: str, fold: str, folds: int, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
                parallelism: int = 4) -> DataFrame:
    """Every row scored by the model that did not see it.

    ``fit`` takes the training rows and gives back a scorer that adds ``score``; preprocessing belongs
    inside it, so nothing leaks across folds. The loop is over models, never over rows.
    """
    def one(i: int) -> DataFrame:
        scored = fit(df.filter(F.col(fold) != i))(df.filter(F.col(fold) == i))
        return scored.select(key, label, fold, *[c for c in ("model",) if c in scored.columns], "score")

    with ThreadPool(min(folds, parallelism)) as pool:     # the fits' jobs share the cluster
        parts = pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds))
    return reduce(DataFrame.unionByName, parts)


def fitter(families: Mapping[str, Callable[[], Estimator]], numeric: Sequence[str], categorical: Sequence[str], key: str,
           label: str, keep: Sequence[str] = ()) -> Callable[[DataFrame], Callable[[DataFrame], DataFrame]]:
    """Fit-and-score pair for several model families: preprocessing and class weight are fitted once on the
    training rows and shared by the families. The scorer gives one row per input row and ``model``."""
    def fit(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
        ready = prep.Preprocessor.fit(train, numeric, categorical)
        vectors = ready.transform(train, [key, label], vector="features").withColumn("label", F.col(label).cast("double"))
        weighted = staged(prep.add_class_weight(vectors, "label"))
        models = {name: make().fit(weighted) for name, make in families.items()}

        def scorer(df: DataFrame) -> DataFrame:
            rows = staged(ready.transform(df, [key, label, *keep], vector="features"))
            parts = [score_with(m, rows, [key, label, *keep]).withColumn("model", F.lit(name)) for name, m in models.items()]
            return reduce(DataFrame.unionByName, parts)
        return scorer
    return fit


@dataclass(frozen=True)
class FoldVectors:
    """Rows encoded for all folds and written once. ``features_i`` holds what the preprocessor of the rows outside fold i
    makes of a row; a fit reads the one column it needs."""

    rows: DataFrame
    keep: tuple[str, ...]
    fold: str
    ready: tuple[prep.Preprocessor, ...]
    weights: tuple[float, ...]
    parts: int

    def of(self, i: int, columns: tuple[Sequence[str], Sequence[str]] | None = None) -> tuple[DataFrame, DataFrame]:
        """Training and held-out rows of fold i; ``columns`` (numeric, categorical) leaves the others' features out."""
        weight = F.when(F.col("label") == 1, F.lit(self.weights[i])).otherwise(1.0)
        rows = self.rows.coalesce(self.parts) if self.parts < self.cores else self.rows
        made = rows.select(*self.keep, F.col(f"features_{i}").alias("features"), weight.alias("weight"))
        kept = self.ready[i].places(*columns) if columns else []
        if columns and kept != list(range(len(self.ready[i].feature_names))):
            made = sliced(made, kept)
        return made.filter(F.col(self.fold) != i), made.filter(F.col(self.fold) == i)

    @property
    def cores(self) -> int:
        return self.rows.sparkSession.sparkContext.defaultParallelism

    @property
    def at_once(self) -> int:
        """How many fits run side by side: as many as keep the cores busy. Each holds a copy of its rows in memory, so
        where the partitions of one fit fill the cluster, the next one waits."""
        return max(1, min(8, 2 * self.cores // self.parts))


def sliced(vectors: DataFrame, kept: Sequence[int]) -> DataFrame:
    """The vectors with some of their features alone."""
    pick = VectorSlicer(inputCol="features", outputCol="_picked", indices=list(kept))
    return pick.transform(vectors).drop("features").withColumnRenamed("_picked", "features")


def fold_vectors(df: DataFrame, key: str, label: str, fold: str, folds: int, numeric: Sequence[str], categorical: Sequence[str],
                 keep: Sequence[str] = (), inner: int = 0) -> FoldVectors:
    """Preprocessors and class weights of all folds from one pass each, vectors of all folds from one more. ``inner``
    deals the rows into inner folds as well (``_inner``)."""
    ready = prep.fit_folds(df, fold, folds, numeric, categorical)
    by_fold = df.groupBy(fold).agg(F.sum((F.col(label) == 0).cast("long")).alias("no"), F.sum((F.col(label) == 1).cast("long")).alias("yes")).collect()
    weights = []
    for i in range(folds):
        no, yes = (sum(r[c] or 0 for r in by_fold if r[fold] != i) for c in ("no", "yes"))
        weights.append(float(no / yes) if no and yes else 1.0)
    own = [key, label, fold, *keep]
    made = prep.transform_folds(df, ready, own).withColumn("label", F.col(label).cast("double"))
    if inner:
        made = made.withColumn("_inner", F.floor(resample.uniform(key, F.lit("inner")) * inner).cast("int"))
    names = dict.fromkeys([*own, "label", *(["_inner"] if inner else [])])
    cells = sum(r["no"] + r["yes"] for r in by_fold) * max(len(r.feature_names) for r in ready)
    return FoldVectors(written(made), tuple(names), fold, tuple(ready), tuple(weights), max(1, -(-cells // PART_CELLS)))


def side_by_side(spark: SparkSession, do: Callable, todo: Sequence, at_once: int) -> list:
    """``do`` of each item, so many at once; their jobs share the cluster."""
    with ThreadPool(max(1, min(len(todo), at_once))) as pool:
        return pool.map(inheritable_thread_target(spark)(do), todo, chunksize=1)


def folds_scored(df: DataFrame, key: str, label: str, fold: str, folds: int, families: Mapping[str, Callable[[], Estimator]],
                 numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str] = (), parallelism: int | None = None,
                 arms: Mapping[str, tuple[Sequence[str], Sequence[str]]] | None = None, vectors: FoldVectors | None = None) -> DataFrame:
    """Every row scored by each family's model that did not see it: (key, label, fold, keep, model, score).

    The preprocessors of all folds are fitted in one pass; the vectors of all folds are written once, for training and for
    scoring, or given as ``vectors``. With ``arms``, (numeric, categorical) by name, each family is fitted on each arm's
    columns and a model bears the arm's name (several families: both names). The loop is over models, never over rows.
    """
    vectors = vectors or fold_vectors(df, key, label, fold, folds, numeric, categorical, keep)
    named = lambda name, arm: name if arm is None else arm if len(families) == 1 else f"{name}_{arm}"
    todo = [(i, name, arm) for i in range(folds) for name in families for arm in (arms or [None])]

    def one(item: tuple) -> DataFrame:
        i, name, arm = item
        train, held = vectors.of(i, arms[arm] if arms else None)
        return score_with(families[name]().fit(train), held, [key, label, fold, *keep]).withColumn("model", F.lit(named(name, arm)))

    return reduce(DataFrame.unionByName, side_by_side(df.sparkSession, one, todo, parallelism or vectors.at_once))


def fold_scores(scored: DataFrame, label: str, by: Sequence[str]) -> DataFrame:
    """Areas of every fold (and model, arm, ...) in one job."""
    return metrics.areas(scored, "score", label, by=list(by))


def random_trials(estimator: Estimator, ranges: Mapping[str, tuple], n: int, seed: int = SEED) -> list[dict]:
    """Seeded random search points: (low, high) of ints, or of floats on a log scale."""
    draw = random.Random(seed)
    points = []
    for _ in range(n):
        point = {}
        for name, (low, high) in ranges.items():
            whole = isinstance(low, int) and isinstance(high, int)
            point[name] = draw.randint(low, high) if whole else low * (high / low) ** draw.random()
        points.append(point)
    return points


def halve(train: DataFrame, estimator: Estimator, trials: Sequence[Mapping], fold: str, folds: int, budgets: Sequence[int],
          budget: str = "maxIter", keep: float = 1 / 3, label: str = "label", parallelism: int = 4) -> DataFrame:
    """Search by successive halving: every trial gets a small budget, the best share of each rung a larger one.

    One row per rung and trial it tested: parameters, budget, mean and deviation of average precision over the folds,
    whether it went on, and which trial of the last rung is best. Ties go to the earlier trial.
    """
    parts = [(train.filter(F.col(fold) != i), train.filter(F.col(fold) == i)) for i in range(folds)]
    alive, rows = list(range(len(trials))), []

    def measured(i: int, tried: Sequence[int], size: int) -> dict[int, float]:
        """Average precision of each trial on fold ``i``: the fits run side by side, their scores are measured together."""
        learned, held = parts[i][0].persist(), parts[i][1]
        try:
            one = lambda j: with_params(estimator, {**trials[j], budget: size}).fit(learned)
            with ThreadPool(min(len(tried), parallelism)) as pool:
                models = pool.map(inheritable_thread_target(train.sparkSession)(one), tried)
        finally:
            learned.unpersist()
        scored = [score_with(m, held, [label]).select(F.lit(j).alias("trial"), "score", F.col(label).cast("int").alias("label"))
                  for j, m in zip(tried, models)]
        # trees give few distinct scores: counted and written once, all curves run over the counts
        counts = written(reduce(DataFrame.unionByName, scored).groupBy("trial", "score", "label").agg(F.count("*").alias("n")))
        found = metrics.average_precision(counts, "score", "label", by=["trial"], weight="n").collect()
        return {r["trial"]: r["average_precision"] or 0.0 for r in found}

    for rung, size in enumerate(budgets):
        found = [measured(i, alive, size) for i in range(folds)]
        each = [[one.get(j, 0.0) for one in found] for j in alive]
        means, spreads = [float(np.mean(x)) for x in each], [float(np.std(x)) for x in each]
        order = sorted(range(len(alive)), key=lambda j: (-means[j], alive[j]))
        last = rung + 1 == len(budgets)
        ahead = {alive[j] for j in order[:1 if last else max(1, math.ceil(keep * len(alive)))]}
        rows += [(rung, i, json.dumps({**trials[i], budget: size}, sort_keys=True), size, means[j], spreads[j],
                  i in ahead, last and i in ahead) for j, i in enumerate(alive)]
        alive = [i for i in alive if i in ahead]
    return train.sparkSession.createDataFrame(
        rows, "rung int, trial int, params string, budget int, mean double, std double, went_on boolean, is_best boolean")


def best_params(trials: DataFrame) -> dict:
    """The parameters of a trial table's best row."""
    return json.loads(trials.filter("is_best").first()["params"])


def with_params(estimator: Estimator, params: Mapping) -> Estimator:
    """A copy of the estimator with the given parameters."""
    return estimator.copy({getattr(estimator, k): v for k, v in params.items()})


def importances(model: Model, vectors: DataFrame, features: str = "features") -> list[float]:
    """How much each input moves a model: a tree model's own importances, else the weight times the input's deviation."""
    if hasattr(model, "featureImportances"):
        return [float(x) for x in model.featureImportances.toArray()]
    spread = vectors.select(Summarizer.std(vectors[features]).alias("s")).first()["s"].toArray()
    return [abs(float(w) * float(s)) for w, s in zip(model.coefficients.toArray(), spread)]


def pruned_folds_scored(df: DataFrame, key: str, label: str, fold: str, folds: int, make: Callable[[], Estimator],
                        numeric: Sequence[str], categorical: Sequence[str], inner: int = 2, floor: float = 0.0,
                        name: str = "pruned", parallelism: int | None = None, vectors: FoldVectors | None = None) -> DataFrame:
    """As ``folds_scored`` for one family that first drops the columns it does not use.

    Inside every outer fold the training rows are dealt into inner folds; importances of the inner fits choose the columns
    (more than ``floor`` of the summed importance on average), and the model is fitted again on all training rows with
    those alone. The held-out rows take no part in the choice. Also gives the number of columns kept. ``vectors``, if
    given, are those of the same columns with as many inner folds.
    """
    vectors = vectors or fold_vectors(df, key, label, fold, folds, numeric, categorical, inner=inner)

    def weighed(item: tuple[int, int]) -> list[float]:
        i, j = item
        part = vectors.of(i)[0].filter(F.col("_inner") != j)
        return importances(make().fit(part), part)

    todo = [(i, j) for i in range(folds) for j in range(inner)]
    found = dict(zip(todo, side_by_side(df.sparkSession, weighed, todo, parallelism or vectors.at_once)))

    def one(i: int) -> DataFrame:
        total = [0.0] * len(vectors.ready[i].feature_names)
        for j in range(inner):
            own = found[i, j]
            total = [t + x / (sum(own) or 1.0) / inner for t, x in zip(total, own)]
        kept = [j for j, x in enumerate(total) if x > floor] or list(range(len(total)))
        train, held = (sliced(rows, kept) for rows in vectors.of(i))
        scored = score_with(make().fit(train), held, [key, label, fold])
        return scored.withColumn("model", F.lit(name)).withColumn("n_features", F.lit(len(kept)))

    return reduce(DataFrame.unionByName, side_by_side(df.sparkSession, one, range(folds), parallelism or vectors.at_once))


def stack_input(base_scores: Sequence[DataFrame], key: str, label: str) -> DataFrame:
    """The base models' scores of each row side by side, as the meta-model reads them."""
    joined = base_scores[0].select(key, label, F.col("score").alias("s0"))
    for i, other in enumerate(base_scores[1:], 1):
        joined = joined.join(other.select(key, F.col("score").alias(f"s{i}")), key)
    names = [f"s{i}" for i in range(len(base_scores))]
    return VectorAssembler(inputCols=names, outputCol="features").transform(joined).withColumn("label", F.col(label).cast("double"))


def stack(base_scores: Sequence[DataFrame], key: str, label: str) -> tuple[Model, DataFrame]:
    """Logistic model, classes balanced, over out-of-fold scores of the base models, and its input."""
    ready = stack_input(base_scores, key, label)
    return logistic().fit(prep.add_class_weight(ready, "label")), ready


def calibrate_isotonic(fit_on: DataFrame, score: str, label: str) -> Callable[[DataFrame], DataFrame]:
    """Monotone map from score to frequency. ``fit_on`` must be a split the model was not trained on."""
    source = fit_on.select(F.col(score).alias("features"), F.col(label).cast("double").alias("label"))
    model = IsotonicRegression().fit(source)

    def apply(df: DataFrame) -> DataFrame:
        made = model.transform(df.withColumn("features", F.col(score)))
        return made.withColumn("calibrated", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))).drop("features", "prediction")
    return apply


def calibrate_sigmoid(fit_on: DataFrame, score: str, label: str) -> Callable[[DataFrame], DataFrame]:
    """One-feature logistic fit on the score."""
    to_vector = VectorAssembler(inputCols=[score], outputCol="features")
    model = logistic(weight=None).fit(to_vector.transform(fit_on).withColumn("label", F.col(label).cast("double")))

    def apply(df: DataFrame) -> DataFrame:
        made = model.transform(to_vector.transform(df))
        return made.withColumn("calibrated", positive_probability(made)).drop("features", "rawPrediction", "probability", "prediction")
    return apply


def permutation_importance(df: DataFrame, key: str, label: str, features: Sequence[str], scorer: Callable[[DataFrame], DataFrame],
                           repeats: int = 10, seed: int = SEED) -> DataFrame:
    """Mean and deviation of the drop in average precision when one column is shuffled.

    One permutation a repeat serves all features: the row at place i in key order meets the row at place i in hash order
    once, and each feature's frame takes that one value from it. Frames are scored and measured in blocks of at most
    BLOCK_ROWS rows (one frame at least): what a block has shuffled and written is gone before the next one begins.
    """
    spark, rest = df.sparkSession, [c for c in df.columns if c not in features]
    found = ordering.with_rank(df.select(key), key, key, descending=False, rank="_r", total="_n").drop("_n")
    places = written(found.select(F.col(key).alias("_key_of"), "_r"))
    size = max(1, places.count())
    at_once, wide = max(1, BLOCK_ROWS // (size * len(features))), max(1, BLOCK_ROWS // size)
    drops = []
    for first in range(1, repeats + 1, at_once):
        again = F.explode(F.sequence(F.lit(first), F.lit(min(first + at_once - 1, repeats))))
        drawn = (df.select(key, F.struct(*features).alias("_other")).withColumn("repeat", again)
                 .withColumn("_u", resample.uniform(F.col(key), F.lit(seed), F.col("repeat"))))
        others = ordering.with_rank(drawn, "_u", key, by=["repeat"], descending=False, rank="_r", total="_n",
                                    buckets=resample.even_buckets(df)).select("repeat", "_r", "_other")
        # the planner takes the size of these sides from the compressed files, without the repeats: a hint keeps all of them
        # from going through the driver
        met = (places.withColumnRenamed("_key_of", key).withColumn("repeat", again).hint("merge")
               .join(others, ["repeat", "_r"]).drop("_r"))
        met = written(df.hint("merge").join(met, key))
        release(spark)
        for at in range(0, len(features), wide):
            frames = F.array(*[
                F.struct(F.lit(f).alias("feature"), *[(F.col("_other")[c] if c == f else F.col(c)).alias(c) for c in features])
                for f in features[at:at + wide]])
            rows = met.select(*rest, "repeat", F.inline(frames))
            drops += metrics.areas(scorer(rows), "score", label, by=["feature", "repeat"]).select("feature", "average_precision").collect()
            release(spark)
        scrapped(spark, met)
    scrapped(spark, places)
    after = spark.createDataFrame([tuple(r) for r in drops], "feature string, average_precision double")
    before = metrics.average_precision(scorer(df), "score", label).first()["average_precision"]
    drop = F.lit(before) - F.col("average_precision")
    return after.groupBy("feature").agg(F.avg(drop).alias("mean_drop"), F.stddev_pop(drop).alias("std_drop"))


def tree_importance(model: Model, names: Sequence[str]) -> list[tuple[str, float]]:
    """A tree model's own importances, the strongest first."""
    values = model.featureImportances.toArray()
    return sorted(zip(names, map(float, values)), key=lambda r: (-r[1], r[0]))
