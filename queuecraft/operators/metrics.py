"""Ranking metrics from a table of distinct scores.

Rows are first counted per distinct score (a combine on the map side takes care of hot scores);
all curves are running sums over that table. ``by`` gives one result per group in the same job, and
``weight`` counts a row several times (bootstrap).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuecraft.operators import ordering, triage


def score_table(df: DataFrame, score: str, label: str, *, by: Sequence[str] = (), weight: str | None = None,
                parts: int | None = None, buckets: ordering.Buckets | None = None) -> DataFrame:
    """Per distinct score, from high to low: own and running counts of rows and positives."""
    one = F.col(weight) if weight else F.lit(1)
    df = df.withColumn(score, ordering.known(df, score))       # unknown scores are one last threshold
    counted = df.groupBy(*by, score).agg(F.sum(one).alias("n"), F.sum(one * F.col(label)).alias("p"))
    if weight:
        counted = counted.filter(F.col("n") > 0)
    if by and buckets is None:
        # boundaries of the pooled scores: no (group, bucket) cell can exceed one bucket
        buckets = ordering.plan_buckets(df.select((-F.col(score).cast("double")).alias("_s")), "_s", parts=parts)
    return ordering.running_sums(counted, score, {"n": F.col("n"), "p": F.col("p")}, by=by, buckets=buckets, parts=parts)


def _ratio(a, b) -> Column:
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))


def average_precision_step() -> Column:
    """A distinct score's share of the average precision: recall step x precision."""
    return _ratio("p", "tot_p") * _ratio("cum_p", "cum_n")


def average_precision_of(table: DataFrame, by: Sequence[str] = (), out: str = "average_precision") -> DataFrame:
    """Sum over distinct thresholds of (recall step x precision); null where there is no positive."""
    return table.groupBy(*by).agg(F.sum(average_precision_step()).alias(out))


def roc_area(n="n", p="p") -> Column:
    """A score's share of the area: its negatives sit below all positives above, ties count half."""
    negatives = (F.col(n) - F.col(p)).cast("double")
    above = (F.col("cum_p") - F.col(p)).cast("double") + F.col(p).cast("double") / 2
    pairs = F.col("tot_p").cast("double") * (F.col("tot_n") - F.col("tot_p")).cast("double")
    return F.try_divide(negatives * above, pairs)


def roc_auc_of(table: DataFrame, by: Sequence[str] = (), out: str = "roc_auc") -> DataFrame:
    return table.groupBy(*by).agg(F.sum(roc_area()).alias(out))


def average_precision(df: DataFrame, score: str, label: str, **options) -> DataFrame:
    return average_precision_of(score_table(df, score, label, **options), options.get("by", ()))


def roc_auc(df: DataFrame, score: str, label: str, **options) -> DataFrame:
    return roc_auc_of(score_table(df, score, label, **options), options.get("by", ()))


def areas(df: DataFrame, score: str, label: str, **options) -> DataFrame:
    """Both areas with the counts, one pass."""
    by = options.get("by", ())
    return score_table(df, score, label, **options).groupBy(*by).agg(
        F.max("tot_n").alias("n_rows"), F.max("tot_p").alias("positives"),
        F.sum(average_precision_step()).alias("average_precision"), F.sum(roc_area()).alias("roc_auc"))


def precision_recall_sweep(df: DataFrame, score: str, tie: str, label: str,
                           percents: Sequence[float] = (1, 2, 5, 10, 20)) -> DataFrame:
    """Precision and recall in the top k rows for several shares, one pass after the cuts are known."""
    cuts = triage.cut_points(df, score, tie, {str(p): triage.at_least_one(p / 100.0) for p in percents})
    hits = [F.coalesce(F.sum(F.when(triage.within(df, cuts.get(str(p)), score, tie), F.col(label))), F.lit(0))
            for p in percents]
    k_of = lambda p: cuts[str(p)].rank if str(p) in cuts else 0
    one = df.agg(F.sum(label).alias("positives"), F.array(*[
        F.struct(F.lit(float(p)).alias("pct"), F.lit(k_of(p)).cast("long").alias("k"), h.cast("long").alias("hits"))
        for p, h in zip(percents, hits)]).alias("_rows"))
    rows = one.select("positives", F.inline("_rows"))
    return rows.select("pct", "k", _ratio("hits", "k").alias("precision"),
                       (F.col("hits") / F.greatest(F.col("positives"), F.lit(1))).alias("recall"))


def at_k(df: DataFrame, score: str, tie: str, label: str, share: float) -> DataFrame:
    """Precision and recall in the top ``share`` of the rows."""
    return precision_recall_sweep(df, score, tie, label, [share * 100.0]).select("k", "precision", "recall")


def every_k(df: DataFrame, score: str, tie: str, label: str) -> DataFrame:
    """Precision and recall after every row of the queue."""
    run = ordering.running_sums(df.select(score, tie, label), score, {"n": F.lit(1), "p": F.col(label)}, tie=tie)
    return run.select(tie, F.col("cum_n").alias("k"), _ratio("cum_p", "cum_n").alias("precision"),
                      (F.col("cum_p") / F.greatest(F.col("tot_p"), F.lit(1))).alias("recall"))


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """One point per distinct threshold, closed by (recall 0, precision 1)."""
    table = score_table(df, score, label)
    points = table.select(F.col(score).cast("double").alias("threshold"), _ratio("cum_p", "cum_n").alias("precision"),
                          _ratio("cum_p", "tot_p").alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def smooth_curve(points: DataFrame, order_by: str, columns: Sequence[str], window: int) -> DataFrame:
    """Centred moving mean over every point, with partial windows at both ends.

    Each point is sent to the positions whose window it falls in, so means are sums per position: no ordered frame
    over the whole curve, and ``window`` rows a point. Points come out numbered from 0.
    """
    placed = ordering.running_sums(points, order_by, {"at": F.lit(1)}, descending=False)
    back, ahead = window // 2, window - window // 2 - 1
    spread = placed.select(F.explode(F.sequence(F.col("cum_at") - 1 - ahead, F.col("cum_at") - 1 + back)).alias("point"),
                           "tot_at", *columns)
    inside = spread.filter((F.col("point") >= 0) & (F.col("point") < F.col("tot_at")))
    return inside.groupBy("point").agg(*[F.avg(c).alias(f"{c}_smooth") for c in columns])


def calibration_curve(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score against share of positives in equal-width bins of [0, 1], upper edge inside."""
    place = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil(F.col(score) * bins))).cast("int")
    return df.groupBy(place.alias("bin")).agg(
        F.count("*").alias("n_rows"), F.avg(score).alias("mean_score"), F.avg(label).alias("positive_share"))


def evaluate(df: DataFrame, score: str, tie: str, label: str, share: float = triage.TOP_SHARE) -> DataFrame:
    """One row: both areas, precision and recall in the top share, score at its percentile; nulls for an empty table."""
    cut = triage.cut_points(df, score, tie, {"k": triage.at_least_one(share)}).get("k")
    found = ordering.quantiles(df.select(score), score, {"q": 1 - share}).first()
    k = F.lit(cut.rank if cut else None).cast("long")
    inside = F.sum(F.when(triage.within(df, cut, score, tie), F.col(label)))
    top = df.agg(inside.alias("_hits"), F.sum(label).alias("_all")).select(
        (F.coalesce("_hits", F.lit(0)) / k).alias("precision_top"),
        F.when(k.isNotNull(), F.coalesce("_hits", F.lit(0)) / F.greatest(F.col("_all"), F.lit(1))).alias("recall_top"),
        F.lit(found["q"] if found else None).cast("double").alias("operating_threshold"), F.lit(1).alias("_one"))
    both = areas(df, score, label).select("average_precision", "roc_auc", F.lit(1).alias("_one"))
    return both.join(top, "_one").drop("_one")   # one row each


def confusion(df: DataFrame, predicted: Column, label: str) -> DataFrame:
    """Counts of the four outcomes with precision and recall, guarded against empty sides."""
    count = lambda cond: F.count(F.when(cond, 1))
    yes, pos = predicted, F.col(label) == 1
    cells = df.agg(count(~yes & ~pos).alias("tn"), count(yes & ~pos).alias("fp"),
                   count(~yes & pos).alias("fn"), count(yes & pos).alias("tp"))
    return cells.withColumns({
        "precision": F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fp")),
        "recall": F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fn"))})


def classification_report(df: DataFrame, predicted: Column, label: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means."""
    c = confusion(df, predicted, label).drop("precision", "recall")

    def side(hit: str, wrong: str, missed: str) -> list[Column]:
        p = F.coalesce(F.try_divide(F.col(hit).cast("double"), F.col(hit) + F.col(wrong)), F.lit(0.0))
        r = F.coalesce(F.try_divide(F.col(hit).cast("double"), F.col(hit) + F.col(missed)), F.lit(0.0))
        return [p, r, F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), F.col(hit) + F.col(missed)]

    neg, pos = side("tn", "fn", "fp"), side("tp", "fp", "fn")
    whole = neg[3] + pos[3]
    accuracy = F.coalesce(F.try_divide((F.col("tp") + F.col("tn")).cast("double"), whole), F.lit(0.0))
    mean = [(a + b) / 2 for a, b in zip(neg[:3], pos[:3])]
    weighted = [F.coalesce(F.try_divide(a * neg[3] + b * pos[3], whole), F.lit(0.0)) for a, b in zip(neg[:3], pos[:3])]
    line = lambda name, v, n: F.struct(F.lit(name).alias("class"), v[0].alias("precision"), v[1].alias("recall"),
                                       v[2].alias("f1"), n.cast("long").alias("support"))
    return c.select(F.inline(F.array(
        line("0", neg, neg[3]), line("1", pos, pos[3]), line("accuracy", [accuracy] * 3, whole),
        line("macro avg", mean, whole), line("weighted avg", weighted, whole))))


def fold_summary(df: DataFrame, fold: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation, extremes and the list of fold values (one row a fold)."""
    return df.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.transform(F.array_sort(F.collect_list(F.struct(fold, value))), lambda s: s[value]).alias("folds"))


def paired_fold_difference(df: DataFrame, fold: str, model: str, value: str, baseline: str) -> DataFrame:
    """Mean difference to the baseline on the same folds, and folds won. One row per (model, fold) in."""
    base = df.filter(F.col(model) == baseline).select(fold, F.col(value).alias("_base"))
    gap = df.filter(F.col(model) != baseline).join(base, fold).withColumn("_d", F.col(value) - F.col("_base"))
    return gap.groupBy(model).agg(F.avg("_d").alias("mean_difference"),
                                  F.sum((F.col("_d") > 0).cast("int")).alias("folds_won"))


def model_comparison(rows: DataFrame, by: str = "average_precision") -> DataFrame:
    """Metric rows, best first, the best one marked."""
    order = Window.orderBy(F.col(by).desc(), F.col("model"))   # one row per model
    return rows.withColumn("is_best", F.row_number().over(order) == 1).orderBy(F.col(by).desc(), "model")


def compare_versions(old: DataFrame, new: DataFrame, key: str = "metric") -> DataFrame:
    """Metric by metric: both values, the change, and whether the intervals overlap."""
    a = old.select(key, *[F.col(c).alias(f"old_{c}") for c in ("value", "low", "high")])
    b = new.select(key, *[F.col(c).alias(f"new_{c}") for c in ("value", "low", "high")])
    apart = (F.col("new_high") < F.col("old_low")) | (F.col("new_low") > F.col("old_high"))
    return a.join(b, key, "full").withColumns({
        "delta": F.col("new_value") - F.col("old_value"), "overlap": ~apart})
