"""From a table of claims to a table of briefs: query text, nearest passages, brief, citation check."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuecraft.operators import briefs, embed, similarity
from queuecraft.session import staged, written


def nearest_passages(queries: DataFrame, passages: DataFrame, model: PipelineModel, k: int = similarity.TOP_K) -> DataFrame:
    """The k nearest passages of every query text: (query_text, passages as array of struct(rank, source, text, distance)).

    Equal texts are searched once. ``queries`` has ``query_text``; ``passages`` has ``passage_id``, ``source``, ``text``.
    """
    texts = queries.select("query_text").distinct().withColumn("query_id", F.xxhash64("query_text"))
    texts = staged(texts)
    left = embed.embed(model, texts.select("query_id", F.col("query_text").alias("text"))).select("query_id", "vector")
    right = embed.embed(model, passages).select("passage_id", "vector")
    near = written(similarity.knn(left, right, k))
    named = near.join(passages.select("passage_id", "source", "text"), "passage_id")
    packed = named.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "source", "text", "distance"))).alias("passages"))
    return texts.join(packed, "query_id").select("query_text", "passages")


def write_briefs(claims: DataFrame, passages: DataFrame, model: PipelineModel, fields: Mapping[str, Column], score: Column,
                 bucket: Column, reasons: Column, k: int = similarity.TOP_K) -> DataFrame:
    """Claims with ``query_text``, ``passages``, ``brief`` and the check of its citations; one job for all claims."""
    asked = claims.withColumn("query_text", briefs.retrieval_query(fields, reasons))
    found = nearest_passages(asked, passages, model, k)
    rows = asked.join(found, "query_text", "left").withColumn(
        "passages", F.coalesce("passages", F.array().cast(found.schema["passages"].dataType)))
    made = rows.withColumn("brief", briefs.template_brief(fields, score, bucket, reasons, F.col("passages")))
    return made.withColumn("check", briefs.citation_check(F.col("brief"), F.size("passages")))
