"""Text vectors from term weights, for retrieval without an outside model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

DIMENSIONS = 256


def fit_tfidf(docs: DataFrame, text: str = "text", dimensions: int = DIMENSIONS) -> PipelineModel:
    """Hashed term counts weighted by rarity and scaled to unit length; fitted on the passages."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions),
        IDF(inputCol="_counts", outputCol="_weights"),
        Normalizer(inputCol="_weights", outputCol="_unit")]).fit(docs)


def embed(model: PipelineModel, docs: DataFrame, out: str = "vector") -> DataFrame:
    made = model.transform(docs)
    return made.withColumn(out, vector_to_array("_unit")).drop("_words", "_counts", "_weights", "_unit")
