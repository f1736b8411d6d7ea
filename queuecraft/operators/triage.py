"""Queues from scores: rank cuts, percentile cuts, persisted thresholds, summaries, cost-benefit.

A score that is null or not a number is unknown: it ranks behind every known one, by its id, counts as a row of the
table, and reaches no threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuecraft.operators import ordering
from queuecraft.session import written

# Queue names, queue shares, cost assumptions.
TOP = "SIU"
MIDDLE = "Manual Review"
REST = "Approve"
TOP_SHARE = 0.05
MIDDLE_SHARE = 0.15
LOSS_PER_POSITIVE = 15000
TOP_COST = 500
MIDDLE_COST = 100


def share_count(share: float):
    """How many rows a share of n is: truncated, in double arithmetic."""
    return lambda n: F.floor(F.lit(float(share)) * n.cast("double"))


def at_least_one(share: float):
    return lambda n: F.greatest(F.lit(1).cast("long"), share_count(share)(n))


@dataclass(frozen=True)
class CutPoint:
    """The last row inside a cut, in the order of ``ordering.in_order``; its score is None where it is unknown."""

    score: float | None
    tie: object
    rank: int
    n_rows: int


def cut_points(df: DataFrame, score: str, tie: str, ranks, descending: bool = True) -> dict[str, CutPoint]:
    """Find the rows at a few global positions; only those few rows reach the driver."""
    rows = ordering.rows_at_ranks(df.select(score, tie), score, tie, ranks, descending=descending)
    rows = rows.withColumn("_known", ordering.known(df, score))
    return {r["cut"]: CutPoint(r["_known"], r[tie], r["rank"], r["n_rows"]) for r in rows.collect()}


def not_after(df: DataFrame, score: str, tie: str, cut_score: Column, cut_tie: Column, cut_known: Column,
              descending: bool = True) -> Column:
    """Row-local test for 'stands at or before the cut row', whose score may be unknown."""
    value, known = F.col(score), ~ordering.missing(df, score)
    ahead = value > cut_score if descending else value < cut_score
    inside = F.when(cut_known, known & (ahead | ((value == cut_score) & (F.col(tie) <= cut_tie)))).otherwise(
        known | (F.col(tie) <= cut_tie))
    return F.coalesce(inside, F.lit(False))


def within(df: DataFrame, cut: CutPoint | None, score: str, tie: str, descending: bool = True) -> Column:
    """Row-local test for 'stands at or before the cut'. A cut nobody reached holds no row."""
    if cut is None:
        return F.lit(False)
    at = F.lit(cut.score).cast(df.schema[score].dataType)
    return not_after(df, score, tie, at, F.lit(cut.tie), F.lit(cut.score is not None), descending)


def reaches(score: str, threshold) -> Column:
    """Whether a score is known and at or above the threshold."""
    return F.coalesce((F.col(score) >= F.lit(threshold)) & ~F.isnan(F.col(score).cast("double")), F.lit(False))


def bucket_of(in_top: Column, in_middle: Column) -> Column:
    return F.when(in_top, TOP).when(in_middle, MIDDLE).otherwise(REST)


def rank_cut(df: DataFrame, score: str, tie: str, top: float = TOP_SHARE, middle: float = MIDDLE_SHARE,
             out: str = "bucket") -> DataFrame:
    """Rank cut: the first int(top*n) rows, the next up to int((top+middle)*n), the rest.

    The cut rows are found first; the assignment itself is then a narrow expression, so the
    table is neither sorted nor shuffled.
    """
    cuts = cut_points(df, score, tie, {"top": share_count(top), "mid": share_count(top + middle)})
    return df.withColumn(out, bucket_of(within(df, cuts.get("top"), score, tie), within(df, cuts.get("mid"), score, tie)))


def rank_cut_by(df: DataFrame, score: str, tie: str, by: Sequence[str], top: float = TOP_SHARE,
                middle: float = MIDDLE_SHARE, out: str = "bucket", buckets: ordering.Buckets | None = None) -> DataFrame:
    """Rank cut inside every group; the groups' cut rows are joined back (two numbers a group)."""
    cuts = ordering.rows_at_ranks(df.select(*by, score, tie), score, tie,
                                  {"top": share_count(top), "mid": share_count(top + middle)}, by=by, buckets=buckets)
    pick = lambda name, c: F.max_by(F.col(c), F.col("cut") == name)
    has = lambda name: F.max(F.col("cut") == name)
    cuts = cuts.withColumn("_s", ordering.known(cuts, score))
    wide = cuts.withColumn("_by", F.struct(*by)).groupBy("_by").agg(*[
        F.when(has(name), F.struct(pick(name, "_s").alias("s"), pick(name, tie).alias("t"))).alias(f"_{name}")
        for name in ("top", "mid")])

    def inside(name: str) -> Column:
        hit = not_after(df, score, tie, F.col(f"{name}.s"), F.col(f"{name}.t"), F.col(f"{name}.s").isNotNull())
        return F.col(name).isNotNull() & hit

    joined = df.withColumn("_by", F.struct(*by)).join(written(wide), "_by", "left")
    return joined.withColumn(out, bucket_of(inside("_top"), inside("_mid"))).drop("_by", "_top", "_mid")


def percentile_cut(df: DataFrame, score: str, top: float = TOP_SHARE, middle: float = MIDDLE_SHARE,
                   out: str = "bucket") -> DataFrame:
    """Percentile cut: score at or above the interpolated percentile, so ties all go up together."""
    found = ordering.quantiles(df.select(score), score, {"top": 1 - top, "mid": 1 - top - middle}).first()
    if found is None or found["top"] is None:
        return df.withColumn(out, F.lit(REST))
    return df.withColumn(out, bucket_of(reaches(score, found["top"]), reaches(score, found["mid"])))


def thresholds(df: DataFrame, score: str, tie: str, top: float = TOP_SHARE, middle: float = MIDDLE_SHARE) -> DataFrame:
    """One row: the score of the last row inside each cut (of the first row where a cut is empty)."""
    rows = ordering.rows_at_ranks(df.select(score, tie), score, tie,
                                  {"top": at_least_one(top), "mid": at_least_one(top + middle)})
    pick = lambda name: F.max(F.when(F.col("cut") == name, F.col(score)))
    return rows.agg(pick("top").alias("top_threshold"), pick("mid").alias("mid_threshold"))


def threshold_cut(df: DataFrame, score: str, top: float, middle: float, out: str = "bucket") -> DataFrame:
    """Assign by persisted thresholds; row-local, so it also serves a stream."""
    return df.withColumn(out, bucket_of(reaches(score, float(top)), reaches(score, float(middle))))


def queue_filter(df: DataFrame, score: str, queues: Sequence[str], low: float, high: float) -> DataFrame:
    return df.filter(F.col("bucket").isin(list(queues)) & F.col(score).between(low, high))


def bucket_rates(df: DataFrame, label: str, bucket: str = "bucket") -> DataFrame:
    return df.groupBy(bucket).agg(F.avg(label).alias("positive_rate"))


def bucket_summary(df: DataFrame, label: str, bucket: str = "bucket") -> DataFrame:
    """Rows, positives, rate and enrichment over the base rate, per queue (empty queues too).

    All queues are counted in one aggregation to one row, so the base rate needs no second pass.
    """
    def line(name: str) -> Column:
        here = F.col(bucket) == name
        return F.struct(F.lit(name).alias(bucket), F.count(F.when(here, 1)).alias("n_rows"),
                        F.coalesce(F.sum(F.when(here, F.col(label))), F.lit(0)).cast("long").alias("positives"))

    packed = df.agg(F.avg(label).alias("base_rate"), F.array(*map(line, (TOP, MIDDLE, REST))).alias("_lines"))
    rate = F.coalesce(F.try_divide(F.col("positives").cast("double"), F.col("n_rows")), F.lit(0.0))
    return packed.select("base_rate", F.inline("_lines")).select(
        bucket, "n_rows", "positives", rate.alias("positive_rate"),
        F.when(F.col("base_rate") > 0, rate / F.col("base_rate")).otherwise(0.0).alias("enrichment"))


def cost_benefit(df: DataFrame, label: str, bucket: str = "bucket", loss: float = LOSS_PER_POSITIVE,
                 top_cost: float = TOP_COST, middle_cost: float = MIDDLE_COST) -> DataFrame:
    """One row: positives caught in the two upper queues and what finding them cost and saved."""
    upper = F.col(bucket).isin(TOP, MIDDLE)
    price = F.when(F.col(bucket) == TOP, F.lit(top_cost)).when(F.col(bucket) == MIDDLE, F.lit(middle_cost)).otherwise(0)
    sums = df.agg(F.coalesce(F.sum(F.when(upper, F.col(label))), F.lit(0)).alias("caught"),
                  F.coalesce(F.sum(price), F.lit(0)).alias("costs"))
    savings = F.col("caught") * F.lit(loss)
    return sums.select("caught", savings.alias("savings"), "costs", (savings - F.col("costs")).alias("net_benefit"),
                       (savings / F.greatest(F.col("costs"), F.lit(1))).alias("benefit_cost_ratio"))


def queue_rank(df: DataFrame, score: str, out: str = "queue_rank") -> DataFrame:
    """Position in the queue; tied rows share their mean position, cut to a whole number."""
    return mean_ranks(df, score).withColumn(out, F.floor(F.col("mean_rank")).cast("long")).drop("mean_rank")


def mean_ranks(df: DataFrame, score: str, by: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Add ``mean_rank`` (ties share the mean of their positions) and ``n_rows``.

    Positions are worked out once per distinct score and joined back. A score that a large share of
    the rows holds makes one long join key, which adaptive execution splits over several tasks.
    """
    keyed = df.withColumn("_value", ordering.known(df, score)).withColumn("_at", F.struct(*by, "_value"))
    counted = keyed.groupBy(*by, "_value").agg(F.count("*").alias("_ties"))
    placed = ordering.running_sums(counted, "_value", {"ties": F.col("_ties")}, by=by, descending=descending)
    table = placed.select(F.struct(*by, "_value").alias("_at"), F.col("tot_ties").alias("n_rows"),
                          (F.col("cum_ties") - (F.col("_ties") - 1) / 2).alias("mean_rank"))
    return keyed.join(table, "_at").drop("_at", "_value")


def review_queue(df: DataFrame, score: str, tie: str) -> DataFrame:
    """Whole table in review order: a range-partitioned sort."""
    return df.orderBy(*ordering.in_order(df, score, tie))


def top_rows(df: DataFrame, score: str, tie: str, k: int) -> DataFrame:
    """The k best rows of a report, with their place. For shares of a table use ``rank_cut``."""
    return df.orderBy(*ordering.in_order(df, score, tie)).limit(k)


def row_at_rank(df: DataFrame, score: str, tie: str, rank: int) -> DataFrame:
    return ordering.rows_at_ranks(df, score, tie, {"row": lambda n: F.lit(rank)}).drop("cut", "n_rows")


def unpivot_attributes(df: DataFrame, key: str, fields: Sequence[str], missing: str = "—") -> DataFrame:
    """One row per (key, field) with the value as text; narrow."""
    text = df.select(key, *[F.coalesce(F.col(f).cast("string"), F.lit(missing)).alias(f) for f in fields])
    return text.unpivot(key, list(fields), "field", "value")


def batches_in_order(df: DataFrame, order_by: str, tie: str, n_batches: int, out: str = "batch_id") -> DataFrame:
    """Equal batches in ascending order, the last one takes the remainder.

    Only the n_batches-1 boundary rows are looked up; numbering a row is then an expression.
    """
    size = lambda n: F.floor(n / F.lit(n_batches))
    ranks = {str(i): (lambda n, i=i: size(n) * i) for i in range(1, n_batches)}
    cuts = cut_points(df, order_by, tie, ranks, descending=False)
    if not cuts:   # fewer rows than batches: all of them are the remainder
        return df.withColumn(out, F.lit(n_batches))
    number = F.when(F.lit(False), 0)
    for i in sorted(map(int, cuts)):
        number = number.when(within(df, cuts[str(i)], order_by, tie, descending=False), i)
    return df.withColumn(out, number.otherwise(n_batches).cast("int"))
