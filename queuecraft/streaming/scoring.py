"""Claims scored as they arrive by a fitted scorer that can be replaced between micro-batches.

Scorers are published in a folder as numbered versions, each whole before its number is announced. A micro-batch takes
the newest version announced when it first runs and notes its choice, so a batch that is repeated after a failure is
scored by the same scorer again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.session import scratch_path
from queuecraft.sources import artifacts
from queuecraft.streaming.events import run_each_batch

NOTE = "version int"


def _newest(spark: SparkSession, folder: str) -> int | None:
    """The largest number noted in a folder of notes; None where there is no note."""
    try:
        return spark.read.schema(NOTE).json(folder).agg(F.max("version")).first()[0]
    except AnalysisException:
        return None


def _note(spark: SparkSession, folder: str, version: int, mode: str) -> None:
    spark.createDataFrame([(version,)], NOTE).coalesce(1).write.mode(mode).json(folder)


def publish(art: artifacts.Artifacts, spark: SparkSession, folder: str) -> int:
    """Save a scorer as the next version, then announce it. One publisher at a time."""
    version = (_newest(spark, f"{folder}/announced") or 0) + 1
    artifacts.save(art, spark, f"{folder}/version={version}")
    _note(spark, f"{folder}/announced", version, "append")
    return version


def newest(spark: SparkSession, folder: str) -> int:
    version = _newest(spark, f"{folder}/announced")
    if version is None:
        raise artifacts.MissingArtifact(f"{folder}/announced")
    return version


def score_stream(claims: DataFrame, folder: str, key: str, keep: Sequence[str] = (), out: str | None = None,
                 marks: str | None = None) -> DataFrame:
    """Score what has arrived on a stream of raw claims: (key, keep, score, bucket, version).

    Every micro-batch goes through ``artifacts.score_claims``, the path of stored tables, so a row's score does not depend
    on the way it came. ``out`` and ``marks`` (rows and progress of an earlier run) let a later run go on where it ended.
    """
    spark = claims.sparkSession
    out = out or scratch_path(spark, "scored")
    held: dict[int, artifacts.Artifacts] = {}

    def handle(batch: DataFrame, number: int) -> None:
        mine = batch.sparkSession
        chosen = f"{out}-choices/batch={number}"
        version = _newest(mine, chosen)
        if version is None:
            version = newest(mine, folder)
            _note(mine, chosen, version, "overwrite")
        if version not in held:
            held.clear()
            held[version] = artifacts.load(mine, f"{folder}/version={version}")
        scored = artifacts.score_claims(batch, held[version], key, list(keep)).select(key, *keep, "score", "bucket")
        scored.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_each_batch(claims, "scored", handle, marks=marks)
    return spark.read.parquet(out).drop("batch")
