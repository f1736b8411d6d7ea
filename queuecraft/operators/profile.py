"""Profiling: counts per level, missing values, duplicates, histograms, side-by-side summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share per level, nulls as a level. The total is summed over the counted levels."""
    counts = df.groupBy(column).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("share", F.col("n_rows") / total)


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing count and percent per column, in one aggregation. NaN counts as missing."""
    kinds = dict(df.dtypes)
    gone = lambda c: (F.col(c).isNull() | F.isnan(c)) if kinds[c] in ("float", "double") else F.col(c).isNull()
    line = lambda c: F.struct(F.lit(c).alias("column_name"), F.count(F.when(gone(c), 1)).alias("n_missing"))
    one = df.agg(F.count("*").alias("_n"), F.array(*map(line, df.columns)).alias("_c"))
    return one.select("_n", F.inline("_c")).select(
        "column_name", "n_missing",
        F.round(100 * F.coalesce(F.try_divide(F.col("n_missing").cast("double"), F.col("_n")), F.lit(0.0)), 2).alias("pct_missing"))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each set of equal rows. All texts of a row are compared through one 256-bit digest,
    so the shuffle carries 32 bytes for them and counts, not texts nor a digest for each column."""
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)
    texts = [c for c in names if kinds[c] == "string"]
    keys = [F.col(c) for c in names if kinds[c] != "string"]
    if texts:       # each text behind its length in bytes, so that no two rows run together; null has a mark of its own
        told = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in texts]
        keys.append(F.unhex(F.sha2(F.concat(*told), 256)).alias("_texts"))
    groups = df.select(*keys).groupBy(*[c for c in names if kinds[c] != "string"], *["_texts"] * bool(texts)).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def high_cardinality(df: DataFrame, columns: Sequence[str], share: float = 0.9, exact: bool = False) -> DataFrame:
    """Columns with nearly as many distinct values (null is one) as rows.

    The sketch is the default at size; ``exact`` counts (column, value) pairs in one grouping, which spreads
    over the cluster by value instead of expanding every row once per distinct aggregate.
    """
    if not exact:
        line = lambda c: F.struct(F.lit(c).alias("column_name"), (
            F.approx_count_distinct(c, 0.01) + F.max(F.col(c).isNull().cast("long"))).alias("n_distinct"))
        one = df.agg(F.count("*").alias("n_rows"), F.array(*map(line, columns)).alias("_c"))
        out = one.select("n_rows", F.inline("_c"))
    else:
        text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        long = text.unpivot([], list(columns), "column_name", "value")
        pairs = long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
        out = pairs.groupBy("column_name").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct"))
    return out.select("column_name", "n_distinct", "n_rows", (F.col("n_distinct") > share * F.col("n_rows")).alias("id_like"))


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Type, exact distinct count (nulls left out) and null count per column."""
    kinds = dict(df.dtypes)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    pairs = text.unpivot([], list(columns), "column_name", "value").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    out = pairs.groupBy("column_name").agg(
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    types = F.create_map(*[F.lit(x) for c in columns for x in (c, kinds[c])])
    return out.withColumn("type", types[F.col("column_name")])


def type_histogram(df: DataFrame) -> dict[str, int]:
    """Number of columns per type, from metadata."""
    out: dict[str, int] = {}
    for _, kind in df.dtypes:
        out[kind] = out.get(kind, 0) + 1
    return out


def dataset_summary(frames: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Records, positives, negatives, rate and imbalance per data set, as long rows."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("records"), F.sum(label).alias("positives")).select(
            F.lit(name).alias("dataset"), F.col("records").cast("double").alias("records"),
            F.col("positives").cast("double").alias("positives"),
            (F.col("records") - F.col("positives")).cast("double").alias("negatives"),
            F.try_divide(F.col("positives").cast("double"), F.col("records")).alias("rate"),
            F.try_divide((F.col("records") - F.col("positives")).cast("double"), F.col("positives")).alias("imbalance"))
    parts = [one(name, df) for name, df in frames.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.unpivot("dataset", ["records", "positives", "negatives", "rate", "imbalance"], "statistic", "value")


def side_by_side(summary: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """The long summary with one column per data set."""
    return summary.groupBy("statistic").pivot("dataset", list(datasets)).agg(F.first("value"))


def class_balance(df: DataFrame, label: str, name: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    return value_share(counts).select(F.lit(name).alias("dataset"), F.col(label).alias("label"), "n_rows", "share")


def value_share(counts: DataFrame) -> DataFrame:
    return counts.withColumn("share", F.col("n_rows") / counts.agg(F.sum("n_rows")).scalar())


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = (), positive_only: bool = False) -> DataFrame:
    """Equal-width bins over the whole column's range, upper edge in the last bin; counts per group."""
    rows = df.filter(F.col(value) > 0) if positive_only else df.filter(F.col(value).isNotNull())
    edges = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    low, high = (edges.select(c).scalar() for c in ("lo", "hi"))
    width = (high - low) / F.lit(bins)
    place = F.when(high > low, F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return rows.groupBy(*by, (place + 1).cast("int").alias("bin")).agg(F.count("*").alias("n_rows"))


def rate_by_band(df: DataFrame, value: str, label: str, edges: Sequence[float]) -> DataFrame:
    """Mean label and count per band (over, up to]; only bands that occur."""
    v = F.col(value)
    band = F.when(F.lit(False), "")
    for over, upto in zip(edges, edges[1:]):
        band = band.when((v > over) & (v <= upto), f"({over:g}, {upto:g}]")
    return (df.withColumn("band", band).filter(F.col("band").isNotNull()).groupBy("band")
            .agg(F.count("*").alias("n_rows"), F.avg(label).alias("rate")))
