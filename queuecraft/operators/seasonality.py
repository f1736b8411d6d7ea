"""Ranking quality by calendar month (or any group), all groups in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuecraft.operators import metrics, ordering, triage
from queuecraft.session import written

# Fewest positives for a ranking metric, smallest group reported.
MIN_POSITIVES = 5
MIN_REPORTED = 10


def group_quality(df: DataFrame, by: str, score: str, tie: str, label: str) -> DataFrame:
    """Per group: counts, areas, precision in the top 5 %, rate in the percentile-cut top queue.

    Ranking metrics are null where there are too few positives; very small groups and groups
    without a positive are left out.
    """
    rows = df.filter(F.col(by).isNotNull()).select(by, score, tie, label)
    known = ~ordering.missing(rows, score)
    # one ordered pass gives every row its place; what all measures need of a (group, score) is then written once
    run = ordering.running_sums(rows, score, {"n": F.lit(1), "p": F.coalesce(F.col(label), F.lit(0)), "known": known.cast("long")}, tie=tie, by=[by])
    k = triage.at_least_one(triage.TOP_SHARE)(F.col("tot_n"))
    table = written(run.withColumns({"_s": F.when(known, F.col(score).cast("double")), "_k": k}).groupBy(
        by, "_s", "tot_n", "tot_p", "tot_known", "_k").agg(
        F.count("*").alias("n"), F.coalesce(F.sum(label), F.lit(0)).alias("p"), F.count(label).alias("labels"), F.max("cum_n").alias("cum_n"),
        F.max("cum_p").alias("cum_p"), F.sum(F.when(F.col("cum_n") <= F.col("_k"), F.col(label)).otherwise(0)).alias("hits"),
        F.sum(score).alias("total"), F.count(score).alias("scores")))
    spot = (F.col("tot_known") - 1).cast("double") * F.lit(1 - triage.TOP_SHARE)
    low = F.floor(spot)
    above = F.col("tot_known") - F.col("cum_n")         # known values below this one
    at = lambda place: F.max(F.when(F.col("_s").isNotNull() & (place >= above) & (place < above + F.col("n")), F.col("_s")))
    low_value, high_value = at(low), at(F.least(low + 1, F.col("tot_known") - 1))
    sums = table.groupBy(by).agg(
        F.max("tot_n").alias("n_rows"), F.max("tot_p").alias("positives"), F.sum(metrics.average_precision_step()).alias("average_precision"),
        F.sum(metrics.roc_area()).alias("roc_auc"), (F.sum("total") / F.sum("scores")).alias("avg_score"),
        (F.sum("p") / F.sum("labels")).alias("positive_rate"), (F.sum("hits") / F.max("_k")).alias("_precision"),
        (low_value + (high_value - low_value) * F.max(spot - low)).alias("_q"))
    top = table.join(sums.select(by, "_q"), by).filter(F.col("_s") >= F.col("_q")).groupBy(by).agg(
        (F.sum("p") / F.sum("labels")).alias("_top"))
    joined = sums.join(top, by, "left").withColumn("top_positive_rate", F.coalesce("_top", F.lit(0.0))).filter(
        (F.col("n_rows") >= MIN_REPORTED) & (F.col("positives") > 0))
    enough = F.col("positives") >= MIN_POSITIVES
    return joined.select(
        by, "n_rows", "positives", enough.alias("sufficient"), "positive_rate",
        F.when(enough, F.col("average_precision")).alias("average_precision"),
        F.when(enough, F.col("roc_auc")).alias("roc_auc"),
        F.when(enough, F.col("_precision")).alias("precision_top"), "avg_score", "top_positive_rate")


def summary(quality: DataFrame, by: str) -> DataFrame:
    """One row: how many groups, mean and sample deviation, best and worst group among the scored ones."""
    ap = "average_precision"
    return quality.agg(
        F.count("*").alias("n_groups"), F.count(ap).alias("n_scored"),
        F.avg(ap).alias("mean_average_precision"), F.stddev_samp(ap).alias("std_average_precision"),
        F.max_by(by, ap).alias("best_group"), F.max(ap).alias("best_average_precision"),
        F.min_by(by, F.when(F.col(ap).isNotNull(), F.col(ap))).alias("worst_group"), F.min(ap).alias("worst_average_precision"),
        F.avg("positive_rate").alias("mean_positive_rate"), F.stddev_samp("positive_rate").alias("std_positive_rate"))
