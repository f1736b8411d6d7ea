"""Global order without a single-partition sort.

Ranks, running sums, the row at a rank and exact quantiles over a whole table (or over each
group of it). Rows are cut into buckets by value boundaries, so every bucket is sorted by its own
task and only the small table of bucket totals is summed in order. A boundary value shared by many
rows (a hot tie) is cut again by the tiebreak column, so no bucket grows with one value's share.

A bucket number is a pure function of the row, so a recomputed partition always agrees with
the rest of the job.

A missing value (null, or not a number) comes last in either direction; missing rows fill buckets of their own behind
all others, in the order of their ties. Buckets are chosen by a number that grows with the value (numbers and times as
doubles, strings by the first bytes behind their common start); inside a bucket the real columns decide, so long integers, decimals and
strings rank exactly. A null group is a group like any other.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuecraft.session import written

KEY = "_key"
TIE = "_tie"
BUCKET = "_bucket"
GROUP = "_group"
INFINITY = float("inf")


@dataclass(frozen=True)
class Buckets:
    """Boundaries on the key and, for hot keys, on the tiebreak."""

    splits: tuple[float, ...]
    hot: tuple[float, ...] = ()
    tie_splits: tuple[float, ...] = ()

    def mirrored(self) -> "Buckets":
        """The same boundaries for the opposite direction of the key."""
        flip = lambda values: tuple(sorted(-v for v in values))
        return Buckets(flip(self.splits), flip(self.hot), self.tie_splits)


def default_parts(df: DataFrame) -> int:
    """As many buckets as the session shuffles into, so a bucket is about one task's share."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _levels(parts: int) -> list[float]:
    return [i / parts for i in range(1, parts)]


def missing(df: DataFrame, column: str) -> Column:
    """Whether the value is null or not a number."""
    gone = F.col(column).isNull()
    return gone | F.isnan(column) if df.schema[column].dataType.typeName() in ("double", "float") else gone


def known(df: DataFrame, column: str) -> Column:
    """The value, null where it is not a number."""
    return F.when(~missing(df, column), F.col(column))


def in_order(df: DataFrame, order_by: str, tie: str, descending: bool = True) -> list[Column]:
    """The order of rows that all operators here follow."""
    value = known(df, order_by)
    return [missing(df, order_by), value.desc() if descending else value, F.col(tie).asc_nulls_last()]


TEXT = ("string", "varchar", "char", "binary")


def common_starts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """How many first bytes all values of each text column share: as many as its least and its largest value do."""
    texts = [c for c in dict.fromkeys(columns) if df.schema[c].dataType.typeName() in TEXT]
    if not texts:
        return {}
    row = df.agg(*[f(F.col(c).cast("binary")).alias(f"{n}{i}") for i, c in enumerate(texts) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    ends = [(bytes(row[f"lo{i}"] or b""), bytes(row[f"hi{i}"] or b"")) for i in range(len(texts))]
    return {c: len(os.path.commonprefix(pair)) for c, pair in zip(texts, ends)}


def code(df: DataFrame, column: str, skip: int = 0) -> Column:
    """A double that never falls as the value grows. Of texts it reads six bytes, behind ``skip`` bytes that all share."""
    kind = df.schema[column].dataType.typeName()
    if kind in TEXT:
        head = F.hex(F.substring(F.col(column).cast("binary"), skip + 1, 6))
        return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")
    if kind in ("date", "timestamp_ntz"):
        return F.col(column).cast("timestamp").cast("double")
    return F.col(column).cast("double")


def plan_buckets(df: DataFrame, key: str, tie: str | None = None, parts: int | None = None, exact: bool = True) -> Buckets:
    """Pick boundaries from the data: one distributed quantile sketch, a second one if ties are hot or rows are missing.

    ``exact`` says that equal keys are equal values; else a hot key must not be cut by the tie.
    """
    parts = parts or default_parts(df)
    found = df.approxQuantile(key, _levels(parts), 0.25 / parts)
    repeats = Counter(found)
    splits = tuple(sorted(repeats))
    if not tie:
        return Buckets(splits)
    whole = 2.0 ** 53           # beyond it whole numbers share doubles
    hot = tuple(sorted(v for v, times in repeats.items() if times > 1 and exact and abs(v) < whole))
    rows, present = df.agg(F.count("*"), F.count(F.when(~F.isnan(key), F.col(key)))).first()
    gone = -(-(rows - present) * parts // max(rows, 1))
    if not hot and not gone:
        return Buckets(splits)
    # One list of tie boundaries serves all hot keys and the missing rows: it cuts them into as many shares as
    # they filled buckets, so no (key, share) cell exceeds one bucket's size.
    shares = sum(repeats[v] for v in hot) + gone + 1
    stuck = F.col(key).isin(list(hot)) | F.col(key).isNull() if hot else F.col(key).isNull()
    tie_found = df.filter(stuck).approxQuantile(tie, _levels(shares), 0.25 / shares)
    return Buckets(splits, hot, tuple(sorted(set(tie_found))))


def plan_scores(df: DataFrame, score: str, tie: str, parts: int | None = None) -> Buckets:
    """Boundaries for ascending order; several operators on the same scores can share them."""
    return _plan(_keyed(df.select(score, tie), score, tie, descending=False), score, True, parts)


def _plan(keyed: DataFrame, order_by: str, tied: bool, parts: int | None) -> Buckets:
    exact = keyed.schema[order_by].dataType.typeName() not in (*TEXT, "decimal")
    return plan_buckets(keyed, KEY, TIE if tied else None, parts, exact)


def _cut(df: DataFrame, source: str, target: str, splits: Sequence[float]) -> DataFrame:
    """The number of the stretch between splits; missing values get one more than all others."""
    inner = [s for s in splits if s not in (INFINITY, -INFINITY)]
    if not inner:
        return df.withColumn(target, F.col(source).isNull().cast("long"))
    marker = Bucketizer(inputCol=source, outputCol=target, splits=[-INFINITY, *inner, INFINITY], handleInvalid="keep")
    return marker.transform(df).withColumn(target, F.coalesce(F.col(target).cast("long"), F.lit(len(inner) + 1)))


def assign_buckets(df: DataFrame, buckets: Buckets, key: str = KEY, tie: str | None = None) -> DataFrame:
    """Add the bucket number; it grows with (key, tie)."""
    out = _cut(df, key, BUCKET, buckets.splits)
    if not buckets.tie_splits or tie is None:
        return out
    # A hot key is itself a boundary, so it opens its bucket: its shares come first, the rest after. Missing rows have
    # a bucket of their own, all of it cut into shares.
    out = _cut(out, tie, "_share", buckets.tie_splits)
    width = len(buckets.tie_splits) + 3
    stuck = F.col(key).isNull()
    if buckets.hot:
        stuck = stuck | F.col(key).isin(list(buckets.hot))
    share = F.when(F.coalesce(stuck, F.lit(True)), F.col("_share")).otherwise(F.lit(width - 1))
    return out.withColumn(BUCKET, F.col(BUCKET) * width + share).drop("_share")


def bucketed(df: DataFrame, order_by: str, tie: str, descending: bool = True, parts: int | None = None) -> DataFrame:
    """``df`` with the number of the order bucket each row falls into; it grows along the order."""
    keyed = _keyed(df, order_by, tie, descending)
    return assign_buckets(keyed, _plan(keyed, order_by, True, parts), KEY, TIE).drop(KEY, TIE)


def _keyed(df: DataFrame, order_by: str, tie: str | None, descending: bool) -> DataFrame:
    skip = common_starts(df, [order_by, tie] if tie else [order_by])
    key = code(df, order_by, skip.get(order_by, 0))
    out = df.withColumn(KEY, F.when(~missing(df, order_by), -key if descending else key))
    return out.withColumn(TIE, code(df, tie, skip.get(tie, 0))) if tie else out


def grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The grouping columns as one value that is never null, so that null groups meet in joins as well."""
    return (df.withColumn(GROUP, F.struct(*by)), [GROUP]) if by else (df, [])


def _totals(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Per bucket: what came before it (``off_``), its own sum (``own_``) and the group total (``tot_``)."""
    sums = df.groupBy(*by, BUCKET).agg(*[F.sum(c).alias(f"own_{m}") for m, c in measures.items()])
    # One row per bucket and group: with no group this window holds a few hundred rows at any scale.
    group = Window.partitionBy(*by)
    before = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *by, BUCKET,
        *[F.col(f"own_{m}") for m in measures],
        *[F.coalesce(F.sum(f"own_{m}").over(before), F.lit(0)).alias(f"off_{m}") for m in measures],
        *[F.sum(f"own_{m}").over(group).alias(f"tot_{m}") for m in measures],
    )


def running_over_buckets(cut: DataFrame, measures: Mapping[str, Column], by: Sequence[str] = (),
                         order: Sequence[Column] | None = None) -> DataFrame:
    """Running sums of rows that already carry the order key and the bucket number."""
    cut, group = grouped(cut, by)
    cells = Window.partitionBy(*group, BUCKET).orderBy(*(order or [F.col(KEY)]))
    upto = cells.rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({f"_in_{m}": F.sum(c).over(upto) for m, c in measures.items()})
    totals = _totals(cut, group, measures).drop(*[f"own_{m}" for m in measures])
    # the window left the rows partitioned by bucket, so they meet the totals where they are; the hint keeps the planner,
    # which may take the rows for the smaller side, from sending them to every task
    out = local.hint("merge").join(totals, [*group, BUCKET]).withColumns(
        {f"cum_{m}": F.col(f"off_{m}") + F.col(f"_in_{m}") for m in measures})
    return out.drop(GROUP, KEY, BUCKET, TIE, *[f"_in_{m}" for m in measures], *[f"off_{m}" for m in measures])


def running_sums(
    df: DataFrame,
    order_by: str,
    measures: Mapping[str, Column],
    *,
    tie: str | None = None,
    by: Sequence[str] = (),
    descending: bool = True,
    buckets: Buckets | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add ``cum_<m>`` (sum up to and including the row) and ``tot_<m>`` for each measure.

    Without ``tie`` the order column must be distinct within each group (at most one missing value).
    """
    keyed = _keyed(df, order_by, tie, descending)
    plan = buckets or _plan(keyed, order_by, tie is not None, parts)
    order = in_order(df, order_by, tie or order_by, descending)
    return running_over_buckets(assign_buckets(keyed, plan, KEY, TIE if tie else None), measures, by,
                                order if tie else order[:2])


def with_rank(
    df: DataFrame,
    order_by: str,
    tie: str,
    *,
    by: Sequence[str] = (),
    descending: bool = True,
    rank: str = "rank",
    total: str = "n_rows",
    buckets: Buckets | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add the 1-based position in (order_by, tie) order and the group's row count."""
    out = running_sums(df, order_by, {"pos": F.lit(1)}, tie=tie, by=by, descending=descending,
                       buckets=buckets, parts=parts)
    return out.withColumnsRenamed({"cum_pos": rank, "tot_pos": total})


def rows_at_ranks(
    df: DataFrame,
    order_by: str,
    tie: str,
    ranks: Mapping[str, Callable[[Column], Column]],
    *,
    by: Sequence[str] = (),
    descending: bool = True,
    buckets: Buckets | None = None,
    parts: int | None = None,
) -> DataFrame:
    """The rows that stand at given positions; each position is a function of the group's row count.

    Only the buckets that hold a wanted position are sorted, all others are counted and left.
    Adds ``cut`` (the name), ``rank`` and ``n_rows``. A position outside 1..n yields no row.
    """
    keyed, group = grouped(_keyed(df, order_by, tie, descending), by)
    plan = buckets or _plan(keyed, order_by, True, parts)
    cut = assign_buckets(keyed, plan, KEY, TIE)
    totals = _totals(cut, group, {"pos": F.lit(1)})
    asked = F.array(*[
        F.struct(F.lit(name).alias("cut"), at(F.col("tot_pos")).cast("long").alias("rank"))
        for name, at in ranks.items()])
    inside = totals.withColumn("_asked", F.filter(
        asked, lambda a: (a["rank"] > F.col("off_pos")) & (a["rank"] <= F.col("off_pos") + F.col("own_pos"))))
    # written first: the planner then sees how few buckets are wanted
    inside = written(inside.filter(F.size("_asked") > 0).select(*group, BUCKET, "off_pos", "tot_pos", "_asked"))
    order = Window.partitionBy(*group, BUCKET).orderBy(*in_order(df, order_by, tie, descending))
    placed = cut.join(inside, [*group, BUCKET]).withColumn("_at", F.col("off_pos") + F.row_number().over(order))
    hit = placed.withColumn("_hit", F.explode("_asked")).filter(F.col("_hit.rank") == F.col("_at"))
    return (hit.withColumns({"cut": F.col("_hit.cut"), "rank": F.col("_at"), "n_rows": F.col("tot_pos")})
            .drop(GROUP, KEY, TIE, BUCKET, "off_pos", "tot_pos", "_asked", "_at", "_hit"))


def quantiles(
    df: DataFrame,
    value: str,
    levels: Mapping[str, float],
    *,
    by: Sequence[str] = (),
    buckets: Buckets | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Exact quantiles by linear interpolation, one column per level and one row per group.

    Nulls are left out. Unlike the built-in exact percentile no group is held in one buffer: buckets are
    counted first, and only those that hold a wanted position go on, as counts per distinct value.
    """
    values = df.filter(~missing(df, value)).select(*by, value)
    keyed, group = grouped(_keyed(values, value, None, descending=False), by)
    cut = assign_buckets(keyed, buckets or plan_buckets(keyed, KEY, None, parts))
    spot = lambda n, p: (n - 1).cast("double") * F.lit(float(p))
    asked = F.flatten(F.array(*[
        F.array(*[F.struct(F.lit(f"{name}|{end}").alias("cut"),
                           F.least(F.floor(spot(F.col("tot_pos"), p)) + step, F.col("tot_pos")).alias("rank"))
                  for end, step in (("lo", 1), ("hi", 2))])
        for name, p in levels.items()]))
    start, end = F.col("off_pos"), F.col("off_pos") + F.col("own_pos")
    wanted = written(_totals(cut, group, {"pos": F.lit(1)})
                     .withColumn("_asked", F.filter(asked, lambda a: (a["rank"] > start) & (a["rank"] <= end)))
                     .filter(F.size("_asked") > 0).select(*group, BUCKET, "off_pos", "tot_pos", "_asked"))
    near = cut.join(wanted.select(*group, BUCKET), [*group, BUCKET], "left_semi")
    counted = near.groupBy(*group, BUCKET, KEY).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*group, BUCKET).orderBy(KEY).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_upto", F.sum("_n").over(order)).join(wanted, [*group, BUCKET])
    here = F.col("off_pos") + F.col("_upto")
    hits = F.filter("_asked", lambda a: (a["rank"] > here - F.col("_n")) & (a["rank"] <= here))
    picked = placed.select(*group, KEY, F.col("tot_pos").alias("n_rows"), F.explode(hits).alias("_hit"))
    at = lambda name: F.max(F.when(F.col("_hit.cut") == name, F.col(KEY)))
    found = picked.groupBy(*group).agg(
        F.max("n_rows").alias("n_rows"),
        *[at(f"{name}|{end}").alias(f"_{name}_{end}") for name in levels for end in ("lo", "hi")])

    def blend(name: str, p: float) -> Column:
        at_p = spot(F.col("n_rows"), p)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return low + (high - low) * (at_p - F.floor(at_p))

    return found.select(*[F.col(GROUP)[b].alias(b) for b in by], "n_rows",
                        *[blend(name, p).alias(name) for name, p in levels.items()])
