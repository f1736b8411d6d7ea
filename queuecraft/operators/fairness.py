"""Flag rates, error rates and disparate impact by group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuecraft.functions import bands

# Impact threshold, smallest group, verdict words, digits the ratio is computed on.
CONCERN_BELOW = 0.80
MIN_GROUP = 30
CONCERN, FINE, UNDEFINED = "Concern", "OK", "n/a (never flagged)"
DIGITS = 4


def unfold_attributes(df: DataFrame, attributes: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """One row per (attribute, group): all attributes are then grouped in one pass."""
    pairs = F.array(*[F.struct(F.lit(name).alias("attribute"), c.cast("string").alias("group"))
                      for name, c in attributes.items()])
    return df.select(*keep, F.inline(pairs))


def group_metrics(df: DataFrame, by: Sequence[str], score: str, label: str, flagged: str) -> DataFrame:
    """Counts and rates per group, rates rounded to four digits; unknown groups are left out."""
    known = df.filter(F.col(by[-1]).isNotNull())
    hit = lambda f, l: F.sum(((F.col(flagged) == f) & (F.col(label) == l)).cast("long"))
    sums = known.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("n_positive"),
        F.sum(F.col(flagged).cast("long")).alias("n_flagged"),
        hit(1, 0).alias("_fp"), hit(1, 1).alias("_tp"), F.avg(score).alias("_score"))
    r = lambda c: F.bround(c, DIGITS)
    return sums.select(
        *by, "n", "n_positive", "n_flagged",
        r(F.col("n_positive") / F.col("n")).alias("positive_rate"),
        r(F.col("n_flagged") / F.col("n")).alias("flag_rate"),
        r(F.col("_fp") / F.greatest(F.lit(1), F.col("n") - F.col("n_positive"))).alias("false_positive_rate"),
        r(F.col("_tp") / F.greatest(F.lit(1), F.col("n_flagged"))).alias("precision"),
        r(F.col("_score")).alias("avg_score"))


def disparate_impact(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Least non-zero flag rate over the group's own, with a verdict; undefined for a never-flagged group.

    Input is one row per group, so the window below is over the report, not the data.
    """
    least = F.min(F.when(F.col("flag_rate") > 0, F.col("flag_rate"))).over(Window.partitionBy(*by))
    ratio = F.when(F.col("flag_rate") > 0, F.bround(least / F.col("flag_rate"), DIGITS))
    return groups.withColumn("disparate_impact", ratio).withColumn(
        "verdict", F.when(F.col("disparate_impact").isNull(), UNDEFINED)
        .when(F.col("disparate_impact") < CONCERN_BELOW, CONCERN).otherwise(FINE))


def disparate_impact_of_large(groups: DataFrame, by: Sequence[str] = (), min_rows: int = MIN_GROUP,
                              unknown: str = bands.AGE_UNKNOWN) -> DataFrame:
    """The same over groups that are large enough and known; the others are listed without a ratio."""
    keep = (F.col("n") >= min_rows) & (F.col("group") != unknown)
    marked = groups.withColumn("included", keep)
    scored = disparate_impact(marked, [*by, "included"])
    return scored.withColumns({
        "disparate_impact": F.when(F.col("included"), F.col("disparate_impact")),
        "verdict": F.when(F.col("included"), F.col("verdict")).otherwise("excluded")})


def never_flagged(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Names of included groups no row of which was flagged, and of excluded groups, per attribute."""
    names = lambda cond: F.array_join(F.sort_array(F.collect_list(F.when(cond, F.col("group")))), ", ")
    return groups.groupBy(*by).agg(names(F.col("included") & (F.col("flag_rate") <= 0)).alias("never_flagged"),
                                   names(~F.col("included")).alias("excluded"))


def report(df: DataFrame, attributes: Mapping[str, Column], score: str, label: str, flagged: str) -> DataFrame:
    """All attributes in one grouped job, with the ratio inside each attribute."""
    long = unfold_attributes(df, attributes, [score, label, flagged])
    groups = group_metrics(long, ["attribute", "group"], score, label, flagged)
    return disparate_impact(groups, ["attribute"]).withColumn(
        "any_concern", F.max((F.col("verdict") == CONCERN).cast("int")).over(Window.partitionBy("attribute")) == 1)
