"""Exact nearest passages for a table of queries, without forming all pairs.

Passages lie in cells; the triangle inequality tells which cells a query need not visit. Each task compares a cell's
passages with the queries that visit it as one matrix product and passes on only the k nearest per query; the k nearest
overall are picked from those.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuecraft.session import written

TOP_K = 5
QUERY_BLOCK = 2048
PASSAGE_BLOCK = 20000
CENTRES = 1024

NEAR_SCHEMA = "query_id long, passage_id long, distance double"


def nearest_in_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest passages of this block per query, by squared Euclidean distance, then id."""
    rows = []
    step = max(1, (1 << 22) // max(1, vectors.shape[1]))        # exact differences held at once
    for start in range(0, len(query_ids), 256):
        part = queries[start:start + 256]
        gap = (part ** 2).sum(1)[:, None] + (vectors ** 2).sum(1)[None, :] - 2.0 * part @ vectors.T
        # the product form finds the candidates (with slack for its rounding), exact differences order them
        last = min(gap.shape[1], k) - 1
        limit = np.partition(gap, last, axis=1)[:, last]
        row, close = np.nonzero(gap <= (limit + 1e-9 * (1.0 + np.abs(limit)))[:, None])     # every tie of the k-th is kept
        exact = np.concatenate([np.zeros(0), *[((vectors[close[i:i + step]] - part[row[i:i + step]]) ** 2).sum(1)
                                               for i in range(0, len(row), step)]])
        order = np.lexsort((ids[close], exact, row))
        place = np.arange(len(row)) - np.searchsorted(row, row)         # ``row`` ascends, so it is its own sorted form
        order = order[place < k]
        rows.append(pd.DataFrame({"query_id": query_ids[start + row[order]], "passage_id": ids[close[order]], "distance": exact[order]}))
    return pd.concat(rows, ignore_index=True) if rows else pd.DataFrame({"query_id": [], "passage_id": [], "distance": []})


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def top_k(near: DataFrame, k: int) -> DataFrame:
    """k of a few candidates per query; the candidates are already k per block."""
    order = Window.partitionBy("query_id").orderBy("distance", "passage_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def knn(queries: DataFrame, passages: DataFrame, k: int = TOP_K) -> DataFrame:
    """(query_id, passage_id, distance, rank) of the k nearest. Both sides have an id and a ``vector``;
    named ``query_id`` and ``passage_id``. The distance is the squared Euclidean one.

    Passages lie in cells around centres drawn from them, written once with each cell's radius. A query first meets the
    cells of its nearest centres, as many as hold k passages; its k-th distance found there bounds what any other cell must
    offer. A cell whose centre is farther than its radius and that bound together cannot, and is not visited. So a query
    travels to the cells that may hold an answer, and a passage only as often as more than QUERY_BLOCK queries visit its
    cell; no product of both sides arises. Where vectors lie so that no cell can be ruled out, all are visited: the result
    is exact in any case.
    """
    n = passages.count()
    if not n:
        return top_k(queries.select("query_id").limit(0).select("query_id", F.lit(0).cast("long").alias("passage_id"), F.lit(0.0).alias("distance")), k)
    wanted = min(CENTRES, max(1, -(-n // PASSAGE_BLOCK)))         # a query is never sent more often than there are blocks
    drawn = passages.orderBy(F.xxhash64("passage_id"), "passage_id").limit(wanted).select("vector").collect()
    centres = _stack(pd.Series([r["vector"] for r in drawn]))           # at most CENTRES rows

    def celled(frames):
        for frame in frames:
            if len(frame):
                gap = _gaps(_stack(frame["vector"]), centres)
                cell = gap.argmin(1)
                yield frame.assign(cell=cell, reach=gap[np.arange(len(frame)), cell])

    held = written(passages.select("passage_id", "vector").mapInPandas(celled, f"{_columns(passages, 'passage_id')}, cell int, reach double"))
    cells = {r["cell"]: r for r in held.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("radius")).collect()}
    size = np.array([cells[c]["n"] if c in cells else 0 for c in range(len(centres))])
    radius = np.array([cells[c]["radius"] if c in cells else 0.0 for c in range(len(centres))])
    parts = F.element_at(F.array(*[F.lit(int(-(-x // PASSAGE_BLOCK) or 1)) for x in size]), F.col("cell") + 1)
    held = held.withColumn("part", F.pmod(F.xxhash64("passage_id"), parts).cast("int"))

    def first_cells(gap: np.ndarray) -> np.ndarray:
        """Which cells a query meets first: the nearest ones, up to k passages."""
        order = np.argsort(gap, axis=1, kind="stable")
        before = np.cumsum(size[order], axis=1) - size[order]
        out = np.zeros(gap.shape, dtype=bool)
        np.put_along_axis(out, order, before < k, axis=1)
        return out & (size > 0)

    def sent(frame: pd.DataFrame, to: np.ndarray) -> pd.DataFrame:
        row, cell = np.nonzero(to)
        return frame.iloc[row][["query_id", "vector"]].assign(cell=cell.astype(np.int32))

    def to_first(frames):
        for frame in frames:
            if len(frame):
                yield sent(frame, first_cells(_gaps(_stack(frame["vector"]), centres)))

    def to_others(frames):
        for frame in frames:
            if len(frame):
                gap = _gaps(_stack(frame["vector"]), centres)
                bound = np.sqrt(frame["bound"].to_numpy(dtype=np.float64))[:, None]
                slack = 1e-9 * (1 + gap + radius)           # rounding may only let a cell in
                yield sent(frame, (gap - radius - slack <= bound) & ~first_cells(gap) & (size > 0))

    target = f"{_columns(queries, 'query_id')}, cell int"

    def visit(rows: DataFrame) -> DataFrame:
        rows = written(rows)
        visits = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        blocks = F.element_at(F.array(*[F.lit(int(-(-visits.get(c, 0) // QUERY_BLOCK))) for c in range(len(centres))]), F.col("cell") + 1)
        left = (rows.withColumn("block", F.pmod(F.xxhash64("query_id"), blocks).cast("int"))
                .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))))
        right = held.withColumn("_blocks", blocks).filter("_blocks > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        met = left.groupBy("cell", "part", "block").cogroup(right.select("passage_id", "vector", "cell", "part", "block").groupBy("cell", "part", "block"))
        return written(met.applyInPandas(meet, NEAR_SCHEMA))

    def meet(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"query_id": [], "passage_id": [], "distance": []})
        return nearest_in_block(q["query_id"].to_numpy(), _stack(q["vector"]), p["passage_id"].to_numpy(), _stack(p["vector"]), k)

    asked = queries.select("query_id", "vector")
    near = visit(asked.mapInPandas(to_first, target))
    if np.count_nonzero(size) == 1:         # every query has met the only cell there is
        return top_k(near, k)
    bounds = top_k(near, k).groupBy("query_id").agg(F.max("distance").alias("_far"), F.count("*").alias("_n"))
    bounded = asked.join(bounds, "query_id").withColumn("bound", F.when(F.col("_n") >= k, F.col("_far")).otherwise(float("inf")))
    more = visit(bounded.select("query_id", "vector", "bound").mapInPandas(to_others, target))
    return top_k(near.unionByName(more), k)


def _columns(df: DataFrame, key: str) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in (key, "vector"))


def _gaps(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows and centres, from exact differences a few rows at a time."""
    step = max(1, (1 << 22) // max(1, centres.size))
    return np.concatenate([np.sqrt(((rows[i:i + step, None] - centres[None]) ** 2).sum(2)) for i in range(0, len(rows), step)])
