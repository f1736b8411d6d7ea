"""Drift of features between a reference and time batches, and per-batch score statistics.

All batches and features are tested in one job. For every (feature, value) the reference and all
batches are counted side by side, so the reference is read and shuffled once, not once per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuecraft.functions import stats
from queuecraft.operators import ordering, triage

# Batches, significance, rows a side needs to be tested.
N_BATCHES = 6
ALPHA = 0.05
MIN_VALUES = 10


def chronological_batches(df: DataFrame, order_by: str, tie: str, n_batches: int = N_BATCHES) -> DataFrame:
    return triage.batches_in_order(df, order_by, tie, n_batches)


def month_index(year, month_number):
    """One number that orders (year, month); an unknown month sorts first in its year."""
    return year * 100 + F.coalesce(month_number, F.lit(0))


def batch_statistics(df: DataFrame, batch: str, score: str, tie: str, label: str) -> DataFrame:
    """Per batch: counts, rate, score moments and quantiles, and the rank-cut queues inside the batch.

    One ordered pass: every row's place in its batch, from which the queues and the quantiles' rows follow, so that all
    measures of all batches are one aggregation. Batches without an id or without any known score are left out.
    """
    rows = df.select(batch, score, tie, label).filter(F.col(batch).isNotNull())
    known = ~ordering.missing(rows, score)
    run = ordering.running_sums(rows, score, {"n": F.lit(1), "known": known.cast("long")}, tie=tie, by=[batch])
    rank, n, present = F.col("cum_n"), F.col("tot_n"), F.col("tot_known")
    tops, mids = triage.share_count(triage.TOP_SHARE)(n), triage.share_count(triage.TOP_SHARE + triage.MIDDLE_SHARE)(n)
    in_top, in_mid = rank <= tops, (rank > tops) & (rank <= mids)
    at = lambda place: F.max(F.when(known & (present - rank == place), F.col(score).cast("double")))

    def mark(p: float):
        spot = (present - 1).cast("double") * F.lit(p)
        low, high = at(F.floor(spot)), at(F.least(F.floor(spot) + 1, present - 1))
        return low + (high - low) * F.max(spot - F.floor(spot))

    return run.filter(present > 0).groupBy(batch).agg(
        F.count("*").alias("n_rows"), F.avg(label).alias("positive_rate"), F.avg(score).alias("avg_score"),
        F.stddev_pop(score).alias("std_score"), F.count(F.when(in_top, 1)).alias("top_count"),
        F.count(F.when(in_mid, 1)).alias("middle_count"),
        F.coalesce(F.avg(F.when(in_top, F.col(label))), F.lit(0.0)).alias("top_positive_rate"),
        *[mark(p).alias(name) for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95))])


def order_edges(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Every feature's value boundaries, from one sketch over ``df``."""
    parts = ordering.default_parts(df)
    numeric = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    sketches = numeric.approxQuantile(list(features), [i / parts for i in range(1, parts)], 0.25 / parts)
    edges = [[-ordering.INFINITY, *sorted(set(q)), ordering.INFINITY] for q in sketches]
    return [e if len(e) > 2 else [-ordering.INFINITY, 0.0, ordering.INFINITY] for e in edges]


def unfolded(df: DataFrame, keep: Sequence[str], features: Sequence[str], edges: Sequence[Sequence[float]]) -> DataFrame:
    """(keep, feature, key, order bucket), one row per row and feature; null for a value that is not a number.

    Buckets are marked before the columns are unfolded, so the input is read once for all features.
    """
    numeric = df.select(*keep, *[F.nanvl(F.col(f).cast("double"), F.lit(None)).alias(f"_v_{f}") for f in features])
    marks = [f"_b_{f}" for f in features]
    marked = Bucketizer(inputCols=[f"_v_{f}" for f in features], outputCols=marks, splitsArray=[list(e) for e in edges],
                        handleInvalid="keep").transform(numeric)
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_v_{f}").alias(ordering.KEY), F.col(m).cast("long").alias(ordering.BUCKET))
                      for f, m in zip(features, marks)])
    return marked.select(*keep, F.inline(cells))


def _value_counts(df: DataFrame, features: Sequence[str], batch: str, numbers: Sequence[int]) -> DataFrame:
    """Counts of every (feature, value), one column per batch (0 is the reference), with order buckets."""
    long = unfolded(df, [batch], features, order_edges(df, features)).filter(F.col(ordering.KEY).isNotNull())
    count = lambda b: F.count(F.when(F.col(batch) == b, 1)).alias(f"n{b}")
    return long.groupBy("feature", ordering.BUCKET, ordering.KEY).agg(*map(count, numbers))


def ks_statistics(df: DataFrame, features: Sequence[str], batch: str, n_batches: int = N_BATCHES) -> DataFrame:
    """Kolmogorov-Smirnov distance of every batch (1..n) to the reference (0), per feature.

    Sides with too few values yield no row.
    """
    numbers = list(range(n_batches + 1))
    counts = _value_counts(df, features, batch, numbers)
    run = ordering.running_over_buckets(counts, {f"n{b}": F.col(f"n{b}") for b in numbers}, ["feature"])
    share = lambda b: F.try_divide(F.col(f"cum_n{b}").cast("double"), F.col(f"tot_n{b}"))
    wide = run.groupBy("feature").agg(
        F.max("tot_n0").alias("n_reference"),
        *[F.max(F.abs(share(b) - share(0))).alias(f"_d{b}") for b in numbers[1:]],
        *[F.max(f"tot_n{b}").alias(f"_n{b}") for b in numbers[1:]])
    rows = F.array(*[F.struct(F.lit(b).alias(batch), F.col(f"_n{b}").alias("n_batch"), F.col(f"_d{b}").alias("distance"))
                     for b in numbers[1:]])
    return wide.select("feature", "n_reference", F.inline(rows)).filter(
        (F.col("n_reference") > MIN_VALUES) & (F.col("n_batch") > MIN_VALUES))


def ks_tests(df: DataFrame, features: Sequence[str], batch: str, n_batches: int = N_BATCHES) -> DataFrame:
    found = ks_statistics(df, features, batch, n_batches)
    return found.withColumn("p_value", stats.ks_p_value(F.col("distance"), F.col("n_reference"), F.col("n_batch")))


def adjust_p_values(tests: DataFrame, by: str, name: str, p: str = "p_value", out: str = "p_adjusted") -> DataFrame:
    """Benjamini-Hochberg inside each group: p*m/rank, then the least of all later ones. One row a test."""
    up = Window.partitionBy(by).orderBy(F.col(p), F.col(name))
    scaled = tests.withColumn("_s", F.col(p) * F.count("*").over(Window.partitionBy(by)) / F.row_number().over(up))
    later = up.rowsBetween(0, Window.unboundedFollowing)
    return scaled.withColumn(out, F.least(F.lit(1.0), F.min("_s").over(later))).drop("_s")


def drift_report(adjusted: DataFrame, batch: str, alpha: float = ALPHA) -> DataFrame:
    """Per batch: does any feature drift after the adjustment, which ones, and how many before it."""
    drifted, raw = F.col("p_adjusted") < alpha, F.col("p_value") < alpha
    names = lambda c: F.array_join(F.sort_array(F.collect_list(c)), ",")
    return adjusted.groupBy(batch).agg(
        (F.count(F.when(drifted, 1)) > 0).alias("dataset_drift"),
        (F.count(F.when(drifted, 1)) / F.greatest(F.lit(1), F.count("*"))).alias("drift_share"),
        F.count(F.when(drifted, 1)).alias("n_drifted"), F.count(F.when(raw, 1)).alias("n_drifted_unadjusted"),
        F.count("*").alias("n_tested"), names(F.when(drifted, F.col("feature"))).alias("drifted_features"),
        names(F.col("feature")).alias("tested_features"))


def drift_summary(report: DataFrame) -> DataFrame:
    return report.agg(F.max("dataset_drift").alias("any_drift"), F.sum(F.col("dataset_drift").cast("long")).alias("n_drifted_batches"),
                      F.count("*").alias("n_batches"), F.avg("drift_share").alias("mean_drift_share"))


def monitor(current: DataFrame, reference: DataFrame | None, features: Sequence[str], order_by: str, tie: str, score: str,
            label: str, exclude: Sequence[str] = (), n_batches: int = N_BATCHES) -> DataFrame:
    """Batches, their statistics and their drift against the reference, one row per batch.

    The order column, ids, label and ``exclude`` are not tested. Without a reference the first
    batch is the reference.
    """
    tested = [f for f in features if f not in {order_by, tie, label, *exclude}]
    batched = chronological_batches(current, order_by, tie, n_batches)
    base = batched.filter(F.col("batch_id") == 1) if reference is None else reference
    rows = batched.select("batch_id", *tested).unionByName(
        base.select(F.lit(0).alias("batch_id"), *tested))
    report = drift_report(adjust_p_values(ks_tests(rows, tested, "batch_id", n_batches), "batch_id", "feature"), "batch_id")
    stats_rows = batch_statistics(batched, "batch_id", score, tie, label)
    return stats_rows.join(report, "batch_id", "left")
