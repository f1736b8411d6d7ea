"""Seeded splits, folds, bootstrap weights and permutations, all from a hash of the row's id.

A row's draw depends on its id and the seed alone, so results do not change with the partitioning
and survive a lost executor.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuecraft.operators import metrics, ordering, triage
from queuecraft.session import written

SPAN = float(2 ** 32)
# distribution function of Poisson(1) at 0, 1, 2, ... up to where the rest is below 1e-10
POISSON_ONE = list(itertools.accumulate(math.exp(-1) / math.factorial(i) for i in range(13)))


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the md5 of the parts."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws("|", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / SPAN


def even_buckets(df: DataFrame, parts: int | None = None) -> ordering.Buckets:
    """Boundaries for a column that is uniform by construction: no sketch needed."""
    n = parts or ordering.default_parts(df)
    return ordering.Buckets(tuple(i / n for i in range(1, n)))


def hash_split(df: DataFrame, key: str, seed: int, shares: Sequence[tuple[str, float]], out: str = "split") -> DataFrame:
    """Approximate split by hash thresholds: narrow, no shuffle. The last name takes the rest."""
    u, edge, name = uniform(key, F.lit(seed)), 0.0, F.when(F.lit(False), "")
    for part, share in shares[:-1]:
        edge += share
        name = name.when(u < edge, part)
    return df.withColumn(out, name.otherwise(shares[-1][0]))


def stratified_split(df: DataFrame, key: str, label: str, seed: int = 42, test_size: float = 0.2,
                     validation_share: float = 0.5, out: str = "split") -> DataFrame:
    """Exact split inside each class in two stages: hold out a share, then halve it (80/10/10 by default)."""
    drawn = df.withColumn("_u", uniform(key, F.lit(seed)))
    placed = ordering.with_rank(drawn, "_u", key, by=[label], descending=False, rank="_r", total="_n", buckets=even_buckets(df))
    held = F.round(F.col("_n") * F.lit(test_size)).cast("long")
    test = F.round(held * F.lit(validation_share)).cast("long")
    name = F.when(F.col("_r") <= test, "test").when(F.col("_r") <= held, "val").otherwise("train")
    return placed.withColumn(out, name).drop("_u", "_r", "_n")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, repeats: int = 1,
                     exact: bool = True, out: str = "fold") -> DataFrame:
    """A fold number per row and repeat. Exact folds deal the rows of each class round; the other form
    takes the hash modulo k and needs no shuffle."""
    rows = df if repeats == 1 else df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    again = F.lit(0) if repeats == 1 else F.col("repeat")
    drawn = rows.withColumn("_u", uniform(F.col(key), F.lit(seed), again))
    if not exact:
        return drawn.withColumn(out, F.floor(F.col("_u") * k).cast("int")).drop("_u")
    groups = [label] if repeats == 1 else [label, "repeat"]
    placed = ordering.with_rank(drawn, "_u", key, by=groups, descending=False, rank="_r", total="_n", buckets=even_buckets(df))
    return placed.withColumn(out, ((F.col("_r") - 1) % k).cast("int")).drop("_u", "_r", "_n")


def poisson_weight(u: Column) -> Column:
    """How often a row is drawn in one resample of the Poisson bootstrap."""
    w = F.when(F.lit(False), 0)
    for count, upper in enumerate(POISSON_ONE):
        w = w.when(u < upper, count)
    return w.otherwise(len(POISSON_ONE))


def poisson_weights(keys: Sequence[str | None], replicates: Sequence[int]) -> np.ndarray:
    """``poisson_weight(uniform(key, replicate))`` as a matrix (key, replicate): the same draws, drawn in a task."""
    tails = [str(r).encode() for r in replicates]
    raw = bytearray()
    for key in keys:
        head = b"" if key is None else key.encode() + b"|"
        for tail in tails:
            raw += hashlib.md5(head + tail).digest()[:4]
    drawn = np.frombuffer(raw, dtype=">u4").reshape(len(keys), len(tails)).astype(np.uint32)
    edges = np.array([math.ceil(x * SPAN) for x in POISSON_ONE], dtype=np.float64)
    return np.searchsorted(edges, drawn, side="right").astype(np.int64)


AREA = 256              # replicates whose weights a task holds at once
ROWS = 4_096            # and rows
METRICS = ("average_precision", "roc_auc", "precision_at_k")


def _chunks(ids: Sequence, replicates: int):
    """(rows, replicates, weights) piece by piece, the rows in order inside each stretch of replicates."""
    for start in range(1, replicates + 1, AREA):
        own = range(start, min(start + AREA, replicates + 1))
        for at in range(0, len(ids), ROWS):
            yield slice(at, at + ROWS), slice(start - 1, start - 1 + len(own)), poisson_weights(ids[at:at + ROWS], own)


def _ties(score: pd.Series) -> np.ndarray:
    """Whether a row's score differs from the one before it; missing scores are equal."""
    gone = score.isna().to_numpy()
    x = score.to_numpy()
    new = np.ones(len(x), dtype=bool)
    new[1:] = (gone[1:] != gone[:-1]) | (~gone[1:] & ~gone[:-1] & (x[1:] != x[:-1]))
    return new


def bootstrap_scores(df: DataFrame, key: str, score: str, label: str, replicates: int, share: float = triage.TOP_SHARE) -> DataFrame:
    """Average precision, ROC area and precision in the top ``share`` of every resample, one row a resample.

    Each row draws Poisson(1) weights instead of a joint multinomial draw (the usual bootstrap for data that no single
    task holds); a weight depends on key and replicate alone. Rows are cut into buckets in the order of the score, and a
    task turns its bucket into a matrix of weights (row, replicate). The first pass gives each bucket's totals per
    replicate, and those of the scores at its two ends, which may go on in the next bucket; they are summed in order. The
    second pass draws the matrix again and adds up areas and hits behind those sums. The shuffle carries the rows once a
    pass and a few numbers per (bucket, replicate), never a row per resample. Resamples without a positive are left out;
    a missing label counts as no positive.
    """
    wide = ordering.default_parts(df)
    spread = lambda frame: frame.repartition(2 * wide, "bucket")       # by number: few rows, but much work on each
    cut = ordering.bucketed(df.select(F.col(key), F.col(score).alias("score"), F.coalesce(F.col(label), F.lit(0)).cast("long").alias("label")),
                            "score", key, parts=4 * wide).withColumn("_id", F.col(key).cast("string"))
    order = ordering.in_order(cut, "score", key)
    rows = written(cut.withColumn("_at", F.row_number().over(Window.partitionBy(ordering.BUCKET).orderBy(*order)))
                   .select(F.col(ordering.BUCKET).alias("bucket"), "_id", "score", "label", "_at"))
    kind = rows.schema["score"].dataType.simpleString()

    def totals(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_at")
        new, label_of, ids = _ties(frame["score"]), frame["label"].to_numpy(), frame["_id"].tolist()
        group = np.cumsum(new) - 1
        ends = {"": np.ones(len(ids), dtype=bool), "first_": group == 0, "last_": group == group[-1]}
        sums = {f"{name}{c}": np.zeros(replicates, np.int64) for name in ends for c in "np"}
        for some, own, weight in _chunks(ids, replicates):
            for name, inside in ends.items():
                held = weight * inside[some, None]
                sums[f"{name}n"][own] += held.sum(0)
                sums[f"{name}p"][own] += (held * label_of[some, None]).sum(0)
        value = frame["score"].astype(object).where(frame["score"].notna(), None)
        return pd.DataFrame({"bucket": [int(frame["bucket"].iloc[0])], "first": [value.iloc[0]], "last": [value.iloc[-1]], "groups": [int(group[-1]) + 1],
                             **{name: [x.tolist()] for name, x in sums.items()}})

    counted = [f"{name}{c}" for name in ("", "first_", "last_") for c in "np"]
    found = written(spread(rows).groupBy("bucket").applyInPandas(
        totals, f"bucket long, first {kind}, last {kind}, groups int, " + ", ".join(f"{c} array<bigint>" for c in counted)))
    long = found.select("bucket", "first", "last", "groups", F.posexplode(F.arrays_zip(*counted)).alias("_r", "_x")).select(
        "bucket", "first", "last", "groups", (F.col("_r") + 1).alias("replicate"), *[F.col(f"_x.{c}").alias(c) for c in counted])
    whole = Window.partitionBy("replicate")
    before = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = written(long.withColumns({
        **{f"off_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in "np"}, **{f"tot_{c}": F.sum(c).over(whole) for c in "np"}}))

    # scores at the ends of buckets: their rows may lie in several, so they are put together here
    ends = F.array(F.struct(F.col("first").alias("score"), F.col("first_n").alias("n"), F.col("first_p").alias("p"),
                            (F.col("off_n") + F.col("first_n")).alias("cum_n"), (F.col("off_p") + F.col("first_p")).alias("cum_p"), F.lit(True).alias("real")),
                   F.struct(F.col("last").alias("score"), F.col("last_n").alias("n"), F.col("last_p").alias("p"),
                            (F.col("off_n") + F.col("n")).alias("cum_n"), (F.col("off_p") + F.col("p")).alias("cum_p"), (F.col("groups") > 1).alias("real")))
    edge = (sums.select("replicate", "tot_n", "tot_p", F.inline(ends)).filter("real").groupBy("replicate", "score", "tot_n", "tot_p")
            .agg(*[F.sum(c).alias(c) for c in "np"], *[F.max(f"cum_{c}").alias(f"cum_{c}") for c in "np"]))
    step = metrics.average_precision_step()
    at_ends = edge.groupBy("replicate").agg(F.sum(step).alias("average_precision"), F.sum(metrics.roc_area()).alias("roc_auc"), F.lit(0.0).alias("hits"))

    offsets = [f"{name}_{c}" for name in ("off", "tot") for c in "np"]
    shifts = sums.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("replicate", *offsets))).alias("_all")).select(
        "bucket", *[F.col(f"_all.{c}").alias(c) for c in offsets])

    def areas(frame: pd.DataFrame, shift: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_at")
        new, label_of, ids = _ties(frame["score"]), frame["label"].to_numpy(), frame["_id"].tolist()
        group = np.cumsum(new) - 1
        inner = (group != 0) & (group != group[-1])
        off_n, off_p, tot_n, tot_p = (np.asarray(shift[c].iloc[0], dtype=np.int64) for c in offsets)
        k = np.maximum(np.floor(share * tot_n).astype(np.int64), 1)
        out = {m: np.zeros(replicates) for m in ("average_precision", "roc_auc", "hits")}
        cum_n, cum_p = off_n.copy(), off_p.copy()
        open_n, open_p = np.zeros(replicates, np.int64), np.zeros(replicates, np.int64)     # of the score that a chunk's end cuts
        with np.errstate(divide="ignore", invalid="ignore"):
            for some, own, weight in _chunks(ids, replicates):
                hit = weight * label_of[some, None]
                run_n, run_p = cum_n[own] + np.cumsum(weight, 0), cum_p[own] + np.cumsum(hit, 0)
                inside = np.clip(k[own] - (run_n - weight), 0, weight)
                out["hits"][own] += (inside * label_of[some, None]).sum(0)
                here = group[some]
                stops = np.flatnonzero(np.append(here[1:] != here[:-1], True))
                n = np.diff(run_n[stops], axis=0, prepend=cum_n[own][None])
                p = np.diff(run_p[stops], axis=0, prepend=cum_p[own][None])
                n[0] += open_n[own]
                p[0] += open_p[own]
                goes_on = some.stop < len(group) and group[some.stop] == here[-1]
                open_n[own], open_p[own] = (n[-1], p[-1]) if goes_on else (0, 0)
                use = inner[some][stops]
                use[-1] &= not goes_on
                n, p, c_n, c_p = n[use], p[use], run_n[stops][use], run_p[stops][use]
                out["average_precision"][own] += np.where(c_n > 0, p / tot_p[own] * (c_p / np.maximum(c_n, 1)), 0).sum(0)
                out["roc_auc"][own] += ((n - p) * (c_p - p + p / 2) / (tot_p[own] * (tot_n[own] - tot_p[own])).astype(float)).sum(0)
                cum_n[own], cum_p[own] = run_n[-1], run_p[-1]
        return pd.DataFrame({"replicate": np.arange(1, replicates + 1), **{m: np.nan_to_num(x) for m, x in out.items()}})

    inside = spread(rows).groupBy("bucket").cogroup(spread(shifts).groupBy("bucket")).applyInPandas(
        areas, "replicate int, average_precision double, roc_auc double, hits double")
    size = sums.groupBy("replicate").agg(F.max("tot_n").alias("_n"), F.max("tot_p").alias("_p"))
    return (inside.unionByName(at_ends).groupBy("replicate").agg(*[F.sum(m).alias(m) for m in ("average_precision", "roc_auc", "hits")])
            .join(size, "replicate").filter("_p > 0").select(
                "replicate", "average_precision", F.when(F.col("_n") > F.col("_p"), F.col("roc_auc")).alias("roc_auc"),
                (F.col("hits") / F.greatest(F.floor(F.lit(share) * F.col("_n")), F.lit(1))).alias("precision_at_k")))


def bootstrap_intervals(df: DataFrame, key: str, score: str, label: str, replicates: int = 2000, alpha: float = 0.05,
                        share: float = triage.TOP_SHARE, names: Sequence[str] = METRICS) -> DataFrame:
    """Point value and percentile interval per metric. The last step works on one number per resample and metric."""
    scores = bootstrap_scores(df, key, score, label, replicates, share)
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])
    ends = scores.select(F.inline(cells)).filter(F.col("value").isNotNull()).groupBy("metric").agg(
        F.count("*").alias("replicates"), F.percentile("value", F.lit(alpha / 2)).alias("low"), F.percentile("value", F.lit(1 - alpha / 2)).alias("high"))
    both = metrics.areas(df, score, label).select("average_precision", "roc_auc", F.lit(1).alias("_one"))
    top = metrics.at_k(df, score, key, label, share).select(F.col("precision").alias("precision_at_k"), F.lit(1).alias("_one"))
    points = both.join(top, "_one").select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("point")) for m in names])))
    return points.join(ends, "metric")


def bootstrap_interval(df: DataFrame, key: str, score: str, label: str, replicates: int = 2000, alpha: float = 0.05,
                       metric: str = "average_precision") -> DataFrame:
    """Point value and percentile interval of one metric."""
    return bootstrap_intervals(df, key, score, label, replicates, alpha, names=[metric]).drop("metric")


def permute_column(df: DataFrame, key: str, column: str, repeats: int = 1, seed: int = 42) -> DataFrame:
    """Every row with the value of another row, per repeat: row i in key order takes the value at hash rank i."""
    rows = df.select(key, column).withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    targets = ordering.with_rank(rows.select(key, "repeat"), key, key, by=["repeat"], descending=False, rank="_r",
                                 total="_n").drop("_n")
    drawn = rows.withColumn("_u", uniform(F.col(key), F.lit(seed), F.col("repeat")))
    sources = ordering.with_rank(drawn, "_u", key, by=["repeat"], descending=False, rank="_r", total="_n", buckets=even_buckets(df))
    sources = sources.select("repeat", "_r", F.col(column).alias(f"{column}_permuted"))
    return targets.join(sources, ["repeat", "_r"]).drop("_r")
