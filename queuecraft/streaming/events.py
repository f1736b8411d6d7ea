"""Streams of events: scoring by persisted thresholds, window statistics, drift per closed window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from queuecraft.functions import stats
from queuecraft.operators import triage
from queuecraft.session import scratch_path


def read_stream(spark: SparkSession, folder: str, pattern: str, schema: StructType, time: str) -> DataFrame:
    """File stream; the time column is cast so that it can carry a watermark."""
    files = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return files.withColumn(time, F.col(time).cast("timestamp"))


def run_to_end(stream: DataFrame, purpose: str, *, mode: str = "append") -> DataFrame:
    """Process what has arrived, write it with exactly-once files, give the written table back."""
    spark = stream.sparkSession
    out, marks = scratch_path(spark, purpose), scratch_path(spark, f"{purpose}-marks")
    query = (stream.writeStream.outputMode(mode).format("parquet").option("path", out)
             .option("checkpointLocation", marks).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_each_batch(stream: DataFrame, purpose: str, handle: Callable[[DataFrame, int], None], *, mode: str = "append",
                   marks: str | None = None) -> None:
    marks = marks or scratch_path(stream.sparkSession, f"{purpose}-marks")
    query = (stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", marks)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def linear_score(weights: dict[str, float], intercept: float) -> Column:
    """Logistic score with fixed weights."""
    total = F.lit(float(intercept))
    for c, w in weights.items():
        total = total + F.lit(float(w)) * F.col(c)
    return 1.0 / (1.0 + F.exp(-total))


def score_events(events: DataFrame, weights: dict[str, float], intercept: float, top: float, middle: float) -> DataFrame:
    """Stateless scoring; the same frame function serves batch and stream."""
    return triage.threshold_cut(events.withColumn("score", linear_score(weights, intercept)), "score", top, middle)


def once_only(events: DataFrame, key: Sequence[str], time: str, lateness: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark; later ones are dropped as late."""
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(key))


def window_statistics(events: DataFrame, time: str, width: str, value: str, flag: Column, lateness: str | None = None,
                      percentiles: bool = False) -> DataFrame:
    """Per tumbling event-time window: count, flag rate, moments; sketched quantiles if asked."""
    rows = events.withWatermark(time, lateness) if lateness else events
    q = F.percentile_approx(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(0.95)), F.lit(10000))
    sums = rows.groupBy(F.window(time, width)).agg(
        F.count("*").alias("n_rows"), F.avg(flag.cast("double")).alias("flag_rate"), F.avg(value).alias("mean_value"),
        F.stddev_pop(value).alias("std_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        *([q.alias("quantiles")] if percentiles else []))
    return sums.select(F.col("window.start").alias("window_start"), *[c for c in sums.columns if c != "window"])


def window_counts(events: DataFrame, time: str, width: str, value: str, grid: Sequence[float], lateness: str) -> DataFrame:
    """Per closed window the number of values at or below each grid edge: bounded state per window."""
    rows = events.withWatermark(time, lateness).filter(F.col(value).isNotNull())
    sums = rows.groupBy(F.window(time, width)).agg(
        F.count("*").alias("n_rows"), F.array(*[F.count(F.when(F.col(value) <= F.lit(float(g)), 1)) for g in grid]).alias("below"))
    return sums.select(F.col("window.start").alias("window_start"), "n_rows", "below")


def grid_of(reference: DataFrame, value: str, cells: int = 100) -> tuple[list[float], list[float], int]:
    """Edges that cut the reference into even shares, the exact share below each, and its row count."""
    edges = sorted(set(reference.approxQuantile(value, [i / cells for i in range(1, cells)], 0.1 / cells)))
    known = reference.filter(F.col(value).isNotNull())
    row = known.agg(F.count("*").alias("n"), *[F.avg((F.col(value) <= F.lit(g)).cast("double")).alias(f"s{i}")
                                               for i, g in enumerate(edges)]).first()
    return edges, [row[f"s{i}"] for i in range(len(edges))], row["n"]


def window_drift(counts: DataFrame, shares: Sequence[float], n_reference: int, alpha: float = 0.05) -> DataFrame:
    """Distance of every closed window to the static reference, measured on the reference's grid."""
    ref = F.array(*[F.lit(float(s)) for s in shares])
    gaps = F.zip_with(F.col("below"), ref, lambda b, s: F.abs(b.cast("double") / F.col("n_rows") - s))
    d = counts.withColumn("distance", F.array_max(gaps))
    p = stats.ks_p_value(F.col("distance"), F.lit(n_reference), F.col("n_rows"))
    return d.select("window_start", "n_rows", "distance", p.alias("p_value"), (p < alpha).alias("drift"))
