"""Shards of near equal size: minimax cuts through ordered atomic groups of equal texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.llm.common import documents, numbered, written
from queuecraft.llm.registry import query

SHARDS = 40
FIRST_DIGITS = 4        # first look: totals of 16 ** 4 cells of groups
CELLS_AT_ONCE = 1 << 17  # cells fetched in one refinement; sets the digits of the next look, never the result


def _greedy(ends: np.ndarray, capacity: int, shards: int) -> np.ndarray:
    """Greedy fill: position behind the last cell of each shard, at most ``shards`` of them."""
    cuts, at, base = [], 0, 0
    for _ in range(shards):
        at = int(np.searchsorted(ends, base + capacity, side="right"))
        cuts.append(at)
        base = int(ends[at - 1]) if at else 0
        if at == len(ends):
            break
    return np.array(cuts, dtype=np.int64)


def _fluid(ends: np.ndarray, single: np.ndarray, capacity: int, shards: int) -> np.ndarray:
    """Weights reached when cells of several groups may be cut anywhere: no real filling reaches further."""
    reach, base = [], 0
    for _ in range(shards):
        goal = base + capacity
        at = int(np.searchsorted(ends, goal, side="right"))
        if at == len(ends):
            reach.append(int(ends[-1]))
            break
        base = (int(ends[at - 1]) if at else 0) if single[at] else goal
        reach.append(base)
    return np.array(reach, dtype=np.int64)


def _smallest(low: int, high: int, fits) -> int:
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def minimax_cuts(groups: DataFrame, shards: int) -> list[str]:
    """Keys at which shards 1, 2, ... begin, for ``groups`` (key: hex string, size: long) in order of their keys.

    The largest shard is as small as any contiguous partition allows. Totals of cells (groups whose keys begin alike)
    bound the answer from both sides; only cells that a cut could fall into are looked into again, with longer keys,
    until the cells around every possible cut are single groups. The driver never holds more than cell totals.
    """
    def totals(frame: DataFrame, digits: int) -> list:
        return (frame.groupBy(F.substring("key", 1, digits).alias("cell"))
                .agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.max("size").alias("largest")).collect())

    found = totals(groups, FIRST_DIGITS)
    cells = sorted((r.cell, r.size, r.n) for r in found)
    if not cells:
        return []
    largest = max(r.largest for r in found)
    while True:
        names = [c[0] for c in cells]
        sizes = np.array([c[1] for c in cells], dtype=np.int64)
        ends, single = np.cumsum(sizes), np.array([c[2] == 1 for c in cells])
        total = int(ends[-1])
        low = _smallest(max(-(-total // shards), largest), total,
                        lambda c: _fluid(ends, single, c, shards)[-1] >= total)
        high = _smallest(low, total, lambda c: c >= sizes.max() and _greedy(ends, c, shards)[-1] == len(ends))
        first, last = _greedy(ends, max(low, 1), shards), _fluid(ends, single, high, shards)
        open_cells = set()
        for k in range(min(len(first), len(last))):
            to = int(np.searchsorted(ends, last[k], side="right"))
            open_cells.update(i for i in range(int(first[k]), min(to, len(cells) - 1) + 1) if not single[i])
        if not open_cells:
            cuts = _greedy(ends, high, shards)
            return [names[i] for i in cuts if i < len(cells)]
        spark = groups.sparkSession
        digits = max(len(names[i]) for i in open_cells)
        more = 1
        while len(open_cells) * 16 ** (more + 1) <= CELLS_AT_ONCE and more < 8:
            more += 1
        wanted = {}
        for i in open_cells:
            wanted.setdefault(len(names[i]), []).append((names[i],))
        inner = []
        for length, own in wanted.items():
            wide = groups.withColumn("_in", F.substring("key", 1, length))
            part = wide.join(spark.createDataFrame(own, "_in string"), "_in", "left_semi")
            inner += totals(part, digits + more)
        cells = sorted([c for i, c in enumerate(cells) if i not in open_cells] + [(r.cell, r.size, r.n) for r in inner])


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs``; equal texts stay in one shard.

    Groups of equal texts are atomic and ordered by the SHA-256 of their text, so the shard of a row follows from the
    row and a few cut keys: rows are never joined to their group. A group above the fair share of what is left gets a
    shard of its own, and the cuts go through the rest; else one such group would leave other shards empty.
    Null and empty texts are one group (size 16 each). Repeated rows are rows like any others. An empty table gives
    an empty result; with fewer groups than shards the last shards stay empty. Other columns are not looked at.
    """
    text = F.coalesce("text", F.lit(""))
    rows = written(docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                               F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.sha2(text, 256).alias("key")))
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("size")))
    total, alone = groups.agg(F.sum("size")).first()[0] or 0, []
    while len(alone) < shards - 1:
        share = (total - sum(r.size for r in alone)) / (shards - len(alone))
        big = (groups.where(F.col("size") > share).where(~F.col("key").isin([r.key for r in alone]))
               .orderBy(F.desc("size"), "key").limit(shards - 1 - len(alone)).collect())
        if not big:
            break
        alone += big
    own = [r.key for r in alone]
    cuts = minimax_cuts(groups.where(~F.col("key").isin(own)), shards - len(own))
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("key") >= cut).cast("int")
    for i, key in enumerate(own):
        shard = F.when(F.col("key") == key, shards - 1 - i).otherwise(shard)
    placed = rows.withColumn("shard", shard.cast("int"))
    return numbered(placed, "shard", [F.col("key"), F.col("doc_id")], "slot").drop("key")


@query("op1_minimax_shards")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return assign_shards(documents(spark, sf)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
