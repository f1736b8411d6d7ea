"""Helpers of the training-data operators: tables in the shared folder, gapless numbering, components of links."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuecraft.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def release(spark: SparkSession) -> None:
    """Let the JVM hand back shuffle files of finished jobs now instead of at its next full collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm")
    df.write.option("compression", "zstd").parquet(path)
    schema = df.schema
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def numbered(df: DataFrame, group: str, order: list[Column], name: str, per_cell: int = 20_000) -> DataFrame:
    """Number the rows of each ``group`` (a column without nulls) 0, 1, 2, ... without gathering a group in one task.

    Rows are dealt into hashed cells of about ``per_cell`` rows; only the table of cell counts is summed in order, and
    only rows of one cell are sorted together. ``df`` is read twice: pass a written table. The number follows from
    the row's ``order`` values; rows equal in all of them share out their numbers in any way.
    """
    most = df.groupBy(group).count().agg(F.max("count")).first()[0] or 1
    cell = F.pmod(F.xxhash64(*order), F.lit(-(-most // per_cell))).cast("int")
    rows = df.withColumn("_cell", cell)
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(group, "_cell").agg(F.count("*").alias("_n"))
              .select(group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(group, "_cell").orderBy(*order)
    return (rows.withColumn("_at", F.row_number().over(inside) - 1)
            .join(starts, [group, "_cell"])
            .withColumn(name, (F.col("_start") + F.col("_at")).cast("long"))
            .drop("_cell", "_at", "_start"))


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable from every id in ``links`` (a long, b long), as (id, component).

    Alternates large-star and small-star steps (each a grouping by one end, whose minimum is combined before the
    shuffle) until the stars stand still; every second step the links are written, so rounds stay short and a lost
    executor repeats one round. A hub's neighbours are joined to its minimum, never listed in one row.
    Links with a null end are left out; an empty table gives an empty result.
    """
    edges = written(links.where("a is not null and b is not null and a <> b")
                    .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    state = None
    while True:
        # large star: every larger neighbour of x hangs on the smallest of x and its neighbours
        both = edges.select(F.col("hi").alias("x"), F.col("lo").alias("y")).union(
            edges.select(F.col("lo").alias("x"), F.col("hi").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = (both.where("y > x").join(low, "x").select(F.col("y").alias("hi"), F.col("m").alias("lo"))
                 .where("hi <> lo").distinct())
        # small star: smaller neighbours of x, and x itself, hang on the smallest of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(least.select("hi", F.col("m").alias("lo"))).where("hi <> lo").distinct())
        edges = written(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(
                edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
        state = now


def whole_groups(batches, keys: list[str]):
    """Arrow batches sorted by ``keys`` as pandas frames that each hold whole groups: a batch's last group waits for the
    next batch. Memory is one batch and one group."""
    import pandas as pd
    import pyarrow as pa

    held = None
    for batch in batches:
        frame = pa.Table.from_batches([batch]).to_pandas() if held is None else pd.concat(
            [held, pa.Table.from_batches([batch]).to_pandas()], ignore_index=True)
        if frame.empty:
            continue
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = len(frame) - int(last[::-1].argmin()) if not last.all() else 0
        held = frame.iloc[cut:]
        if cut:
            yield frame.iloc[:cut].reset_index(drop=True)
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def starts_of(*columns):
    """Positions at which any of the sorted columns changes, with the end: group i is [out[i], out[i + 1])."""
    import numpy as np

    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def with_text(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(row: struct of a document's columns, text) as documents again, with the new text and its length in n_chars."""
    own = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text"), F.lit(0)).cast("long")}
    return rows.select(*[own.get(c, F.col("row").getField(c)).alias(c) for c in columns])
