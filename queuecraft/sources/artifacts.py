"""Fitted scorer on disk: model, preprocessing and bundle; a missing part is named, never guessed."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.functions import features as claim_features
from queuecraft.operators import explain, learn, prep, triage


class MissingArtifact(FileNotFoundError):
    pass


@dataclass
class Bundle:
    """What a scorer needs beside the model: conventions, feature names, thresholds, metrics."""

    top_threshold: float
    mid_threshold: float
    age_imputation: bool = False
    selected_features: list[str] | None = None
    metrics: dict = field(default_factory=dict)
    feature_means: list[float] | None = None        # of the consumed features, where explanations start from


@dataclass
class Artifacts:
    model: Model
    preprocessor: prep.Preprocessor
    bundle: Bundle

    @property
    def consumed_features(self) -> list[str]:
        """Names in the order the model consumes them; explanations must use this list."""
        return self.bundle.selected_features or self.preprocessor.feature_names


def save(art: Artifacts, spark: SparkSession, folder: str) -> None:
    art.model.write().overwrite().save(f"{folder}/model")
    rows = [("preprocessor", art.preprocessor.to_json()), ("bundle", json.dumps(art.bundle.__dict__))]
    spark.createDataFrame(rows, "part string, body string").coalesce(1).write.mode("overwrite").json(f"{folder}/parts")


def load(spark: SparkSession, folder: str) -> Artifacts:
    try:
        parts = {r["part"]: r["body"] for r in spark.read.schema("part string, body string").json(f"{folder}/parts").collect()}
    except AnalysisException as e:
        raise MissingArtifact(f"{folder}/parts") from e
    for name in ("preprocessor", "bundle"):
        if name not in parts:
            raise MissingArtifact(f"{folder}/parts ({name})")
    try:
        meta = spark.read.text(f"{folder}/model/metadata").first()
    except AnalysisException as e:
        raise MissingArtifact(f"{folder}/model") from e
    from pyspark.ml import classification

    kind = json.loads(meta["value"])["class"].rsplit(".", 1)[-1]
    model = getattr(classification, kind).load(f"{folder}/model")
    return Artifacts(model, prep.Preprocessor.from_json(parts["preprocessor"]), Bundle(**json.loads(parts["bundle"])))


def score_claims(claims: DataFrame, art: Artifacts, key: str, keep: list[str] | None = None) -> DataFrame:
    """Raw claims to (key, score, bucket): impute if the bundle says so, engineer, align, transform, score, cut.

    The one path for batch and stream, so the two cannot drift apart. Narrow from end to end.
    """
    return _scored(claims, art, [key, *(keep or [])]).drop("features")


def _scored(claims: DataFrame, art: Artifacts, kept: list[str]) -> DataFrame:
    rows = claim_features.impute_age(claims) if art.bundle.age_imputation else claims
    wide = claim_features.engineer(rows)
    have = set(wide.columns)
    pre = art.preprocessor
    wide = wide.withColumns({
        **{c: F.lit(prep.UNKNOWN) for c in pre.categorical if c not in have},
        **{c: F.lit(0.0) for c in pre.numeric if c not in have}})
    ready = pre.transform(wide, kept, features=art.bundle.selected_features, vector="features")
    scored = learn.score_with(art.model, ready, [*kept, "features"])
    return triage.threshold_cut(scored, "score", art.bundle.top_threshold, art.bundle.mid_threshold)


def explain_claims(claims: DataFrame, art: Artifacts, key: str, keep: list[str] | None = None) -> DataFrame:
    """As ``score_claims`` with the contributions of the features a linear scorer consumed: array of (feature, value, phi).

    A contribution is the weight times what sets the encoded value apart from the feature's mean in training; the value
    shown is the one before scaling. Narrow from end to end.
    """
    weights = getattr(art.model, "coefficients", None)
    if weights is None:
        raise ValueError("contributions of this kind need a linear scorer; see trees.tree_contributions")
    if art.bundle.feature_means is None:
        raise MissingArtifact("feature means")
    names = art.consumed_features
    moments = [art.preprocessor.moments.get(n, [0.0, 1.0]) for n in names]
    numbers = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    x = vector_to_array("features")
    phis = F.zip_with(F.zip_with(x, numbers(art.bundle.feature_means), lambda v, m: v - m), numbers(weights.toArray()), lambda g, w: g * w)
    shown = F.zip_with(F.zip_with(x, numbers(s for _, s in moments), lambda v, s: v * s), numbers(m for m, _ in moments), lambda v, m: v + m)
    scored = _scored(claims, art, [key, *(keep or [])])
    return scored.withColumn("contributions", explain.named_contributions(shown, phis, names)).drop("features")


