"""Event-time windows kept as counts per value and closed as a whole: exact moments, quantiles, queues and drift.

The state of an open window is one counter per (feature, value), so it is spread over all tasks by value, merges on the
map side, and no task ever holds a window. When the watermark passes a window's end all its counters come out in one
micro-batch, and what is asked of the window follows from them exactly, by the same operators that serve stored tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuecraft.functions import stats
from queuecraft.operators import drift, ordering
from queuecraft.operators.ordering import BUCKET, KEY
from queuecraft.session import scratch_path, written
from queuecraft.streaming.events import run_each_batch

QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def value_counts(events: DataFrame, time: str, width: str, features: Sequence[str], edges: Sequence[Sequence[float]],
                 flag: Column | None = None, lateness: str | None = None) -> DataFrame:
    """Per tumbling window, feature and value: rows, flagged rows, and the value's order bucket between ``edges``.

    A value that is null or not a number is counted under the null value. Serves streams (``lateness`` sets the
    watermark) and stored tables.
    """
    rows = events.withWatermark(time, lateness) if lateness else events
    flagged = rows.withColumn("_flag", F.lit(0) if flag is None else F.coalesce(flag.cast("int"), F.lit(0)))
    long = drift.unfolded(flagged, [time, "_flag"], features, edges)
    sums = long.groupBy(F.window(time, width), "feature", BUCKET, KEY).agg(F.count("*").alias("n"), F.sum("_flag").alias("flagged"))
    return sums.select(F.col("window.start").alias("window_start"), "feature", BUCKET, KEY, "n", "flagged")


def close_windows(counts: DataFrame, purpose: str, close: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream of ``value_counts`` to the end of what has arrived; ``close`` sees the counters of whole windows.

    Each micro-batch has a folder of its own, so one that is repeated after a failure overwrites its own rows.
    """
    out = scratch_path(counts.sparkSession, purpose)

    def handle(batch: DataFrame, number: int) -> None:
        close(written(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    run_each_batch(counts, purpose, handle)
    return counts.sparkSession.read.parquet(out).drop("batch")


def _running(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Known values with the running and whole count of their group."""
    known = counts.filter(F.col(KEY).isNotNull()).withColumn("value", F.col(KEY))
    return ordering.running_over_buckets(known, {"n": F.col("n")}, by)


def profile(counts: DataFrame, feature: str, queues: Mapping[str, float] | None = None,
            levels: Mapping[str, float] | None = None) -> DataFrame:
    """Per window: rows, flag rate, moments and quantiles of a feature, and the rows of each queue.

    ``queues`` names cut values; a row belongs to the queue with the highest cut that it reaches. Unknown values count as
    rows, take no part in the moments and reach no cut. Quantiles interpolate between values.
    """
    levels = QUANTILES if levels is None else levels
    own = counts.filter(F.col("feature") == feature)
    n, x = F.col("n"), F.col(KEY)
    known = F.when(x.isNotNull(), n)
    cuts = sorted((queues or {}).items(), key=lambda q: -q[1])
    inside = [(x >= low) if i == 0 else (x >= low) & (x < cuts[i - 1][1]) for i, (_, low) in enumerate(cuts)]
    sums = own.groupBy("window_start").agg(
        F.sum(n).alias("n_rows"), (F.sum("flagged") / F.sum(n)).alias("flag_rate"), (F.sum(n * x) / F.sum(known)).alias("mean_value"),
        F.min(x).alias("min_value"), F.max(x).alias("max_value"),
        *[F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).alias(name) for (name, _), cond in zip(cuts, inside)])
    gap = x - F.col("mean_value")
    spread = (own.join(sums.select("window_start", "mean_value"), "window_start").groupBy("window_start")
              .agg(F.sqrt(F.sum(n * gap * gap) / F.sum(known)).alias("std_value")))

    def at(place: Column) -> Column:        # the value at a place from 0
        return F.max(F.when((F.col("cum_n") - n <= place) & (F.col("cum_n") > place), F.col("value")))

    def blend(p: float) -> Column:
        spot = (F.col("tot_n") - 1) * F.lit(float(p))
        low = F.floor(spot)
        low_value, high_value = at(low), at(F.least(low + 1, F.col("tot_n") - 1))
        return low_value + (high_value - low_value) * F.max(spot - low)

    marks = _running(own, ["window_start"]).groupBy("window_start").agg(*[blend(p).alias(name) for name, p in levels.items()])
    return sums.join(spread, "window_start").join(marks, "window_start", "left")


def reference_counts(reference: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]]) -> DataFrame:
    """The static side of window drift: rows per (feature, value), counted once."""
    long = drift.unfolded(reference, [], features, edges).filter(F.col(KEY).isNotNull())
    return written(long.groupBy("feature", BUCKET, KEY).agg(F.count("*").alias("n_reference")))


def window_tests(counts: DataFrame, reference: DataFrame, alpha: float = drift.ALPHA) -> DataFrame:
    """Per closed window and feature: exact Kolmogorov-Smirnov distance to the reference, p-value, the p-value adjusted
    over the window's features, and whether it drifts. Sides with too few values yield no row.

    Between two values of a window its share stands still while the reference's grows, so the largest gap lies at one of
    the window's own values or just before it. The reference's running share is thus needed at the windows' values only,
    and is summed once for all windows.
    """
    counts = counts.filter(F.col(KEY).isNotNull())
    points = (reference.select("feature", BUCKET, KEY, "n_reference")
              .unionByName(counts.select("feature", BUCKET, KEY, F.lit(0).cast("long").alias("n_reference")))
              .groupBy("feature", BUCKET, KEY).agg(F.sum("n_reference").alias("n_reference")).withColumn("value", F.col(KEY)))
    base = ordering.running_over_buckets(points, {"reference": F.col("n_reference")}, ["feature"])
    both = _running(counts, ["window_start", "feature"]).join(base, ["feature", "value"])
    share, base_share = F.col("cum_n") / F.col("tot_n"), F.col("cum_reference") / F.col("tot_reference")
    before, base_before = (F.col("cum_n") - F.col("n")) / F.col("tot_n"), (F.col("cum_reference") - F.col("n_reference")) / F.col("tot_reference")
    found = (both.groupBy("window_start", "feature").agg(
        F.max("tot_reference").alias("n_reference"), F.max("tot_n").alias("n_window"),
        F.max(F.greatest(F.abs(share - base_share), F.abs(before - base_before))).alias("distance"))
        .filter((F.col("n_reference") > drift.MIN_VALUES) & (F.col("n_window") > drift.MIN_VALUES)))
    tests = found.withColumn("p_value", stats.ks_p_value(F.col("distance"), F.col("n_reference"), F.col("n_window")))
    return drift.adjust_p_values(tests, "window_start", "feature").withColumn("drift", F.col("p_adjusted") < alpha)
