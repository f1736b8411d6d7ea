"""Contributions of features to a row's score, its main drivers and their wording."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuecraft.functions import labels
from queuecraft.operators import ordering, triage
from queuecraft.session import staged

N_DRIVERS = 5
N_WATERFALL = 10


def linear_contributions(df: DataFrame, weights: Mapping[str, float], means: Mapping[str, float],
                         out: str = "contributions") -> DataFrame:
    """Array of (feature, value, phi) with phi = weight x (value - mean); narrow."""
    cell = lambda c, w: F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                                 (F.lit(float(w)) * (F.col(c) - F.lit(float(means[c])))).alias("phi"))
    return df.withColumn(out, F.array(*[cell(c, w) for c, w in weights.items()]))


def named_contributions(values: Column, phis: Column, names: Sequence[str]) -> Column:
    """Zip positional arrays with the names of the features the model consumed, in its order."""
    keys = F.array(*[F.lit(n) for n in names])
    return F.arrays_zip(keys.alias("feature"), values.alias("value"), phis.alias("phi"))


def top_drivers(contributions: Column, k: int = N_DRIVERS, places: Column | None = None) -> Column:
    """The k largest by absolute size inside the row: an array sort, no shuffle. The place makes every element unlike all
    others, so the natural order of the structs decides; no comparison is evaluated as an expression. ``places``, if
    given, are those of the largest in this order (at least k, from 0): then nothing is sorted."""
    if places is not None:
        return F.transform(F.slice(places, 1, k), lambda i: F.get(contributions, i))
    keyed = F.transform(contributions, lambda d, i: F.struct(
        (-F.abs(d["phi"])).alias("order"), i.alias("at"), d.alias("driver")))
    return F.transform(F.slice(F.sort_array(keyed), 1, k), lambda d: d["driver"])


def global_importance(df: DataFrame, contributions: str = "contributions") -> DataFrame:
    """Mean absolute contribution per feature."""
    long = df.select(F.inline(contributions))
    return long.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_contribution"))


def used_features(importance: DataFrame) -> list[str]:
    """Names of features with any contribution, the strongest first (one row per feature)."""
    rows = importance.filter(F.col("mean_abs_contribution") > 0).orderBy(F.col("mean_abs_contribution").desc(), "feature")
    return [r["feature"] for r in rows.collect()]


def explain_top(df: DataFrame, key: str, score: str, label: str, share: float = triage.TOP_SHARE, k: int = N_DRIVERS,
                contributions: str = "contributions") -> DataFrame:
    """Long rows (rank, id, score, label, driver) of the top share of the table.

    The cut row is looked up first, so only the top rows are written, ranked and unfolded.
    """
    cut = triage.cut_points(df, score, key, {"k": triage.at_least_one(share)}).get("k")
    top = staged(df.filter(triage.within(df, cut, score, key)).select(key, score, label, contributions))
    ranked = ordering.with_rank(top, score, key).drop("n_rows")
    driven = ranked.withColumn("_d", top_drivers(F.col(contributions), k))
    rows = driven.select("rank", key, score, label, F.posexplode("_d").alias("place", "_one"))
    return rows.select(
        "rank", key, score, label, (F.col("place") + 1).alias("place"), F.col("_one.feature").alias("feature"),
        F.col("_one.phi").alias("contribution"), F.col("_one.value").alias("feature_value"),
        F.when(F.col("_one.phi") > 0, "increases").otherwise("decreases").alias("direction"))


def reason_codes(rows: DataFrame, categorical: Sequence[str] = (), out: str = "reason_code") -> DataFrame:
    """Wording of long driver rows (feature, contribution, feature_value)."""
    text = labels.feature_text(F.col("feature"), F.col("feature_value"), categorical)
    return rows.withColumn(out, labels.reason_code(F.col("feature"), F.col("contribution"), text))


def reasons_array(contributions: Column, categorical: Sequence[str] = (), k: int = N_DRIVERS) -> Column:
    """Reason texts of a row's top drivers, as an array."""
    return F.transform(top_drivers(contributions, k), lambda d: labels.reason_code(
        d["feature"], d["phi"], labels.feature_text(d["feature"], d["value"], categorical)))


def waterfall(contributions: Column, k: int = N_WATERFALL) -> Column:
    return top_drivers(contributions, k)
