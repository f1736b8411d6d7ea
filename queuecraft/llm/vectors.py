"""Near duplicates among vectors by NN-descent: neighbours of neighbours, larger lists where they are full, audited."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.llm.common import components, starts_of, whole_groups, written
from queuecraft.llm.registry import query

COSINE = 0.9
NEIGHBOURS = 10         # length of a neighbour list before it is enlarged
TREES, LEAF = 4, 96     # random hyperplane orders that start the graph, and rows compared at once there
ROUNDS = 4              # rounds of neighbours of neighbours at most; fewer once nearly nothing changes
STILL = 0.01            # share of changed list entries at which the rounds end
TOGETHER = 256          # vectors compared at once
BEST = 6                # finds that one neighbourhood reports for a vector in a round
BALLS = 1024            # components whose centres are compared at once
AUDIT, RECALL = 256, 0.98   # vectors whose true links are counted, and the mean share of them that must be found
SINGLE = 1e-4           # distance from the threshold within which single precision decides nothing


def units(batches):
    """(vec_id, embedding) to (vec_id, size, unit: doubles as bytes) of vectors that can link; others have no unit."""
    for batch in batches:
        ids, rows = batch.column(0), batch.column(1).to_pylist()
        sizes, out = [], []
        for row in rows:
            unit = None
            if row and None not in row:
                x = np.array(row, dtype=np.float64)
                if np.isfinite(x).all():
                    top = np.abs(x).max()
                    if top > 0:
                        x = x / top
                        unit = (x / math.sqrt(x @ x)).tobytes()
            out.append(unit)
            sizes.append(len(row) if row else 0)
        yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(out, pa.binary())],
                                         names=["vec_id", "size", "unit"])


def matrix(column: pd.Series, kind=np.float64) -> np.ndarray:
    return np.stack([np.frombuffer(x, dtype=np.float64).astype(kind) for x in column])


def orders(trees: range, levels: int):
    """(id, size, unit) to a row per tree: (tree, size, leaf: signs by random hyperplanes, along, id, v: floats)."""
    def run(batches):
        for batch in batches:
            frame = pa.Table.from_batches([batch]).to_pandas()
            for size, own in frame.groupby("size"):
                x = matrix(own["unit"], np.float32)
                for tree in trees:
                    planes = np.random.default_rng([tree, int(size)]).normal(size=(int(size), levels + 1)).astype(np.float32)
                    side = x @ planes
                    leaf = ((side[:, :levels] > 0) @ (1 << np.arange(levels, dtype=np.int64)))
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(
                        {"tree": tree, "size": size, "leaf": leaf, "along": side[:, levels].astype(np.float64),
                         "id": own["id"].to_numpy(), "v": [r.tobytes() for r in x]}), preserve_index=False)
    return run


def best_of_block(ids: np.ndarray, x: np.ndarray, floor: np.ndarray, k: int):
    """For each row of a block its ``k`` most similar other rows above its floor: (a, b, likeness)."""
    likeness = x @ x.T
    np.fill_diagonal(likeness, -2)
    k = min(k, len(ids) - 1)
    top = np.argpartition(-likeness, k - 1, axis=1)[:, :k] if k < len(ids) - 1 else np.argsort(-likeness, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(ids)), k)
    columns = top.ravel()
    value = likeness[rows, columns]
    good = (value > floor[rows]) & (ids[rows] != ids[columns])
    return ids[rows[good]], ids[columns[good]], value[good]


EDGE = "a long, b long, likeness float"


def _edges(parts):
    a, b, s = (np.concatenate(x) for x in zip(*parts))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float32())],
                                      names=["a", "b", "likeness"])


def first_edges(batches):
    """Rows in the order of a tree: blocks of LEAF rows that follow each other are compared."""
    held = None
    def blocks(frame, last):
        while len(frame) >= LEAF or last and len(frame) > 1:
            yield frame.iloc[:LEAF]
            frame = frame.iloc[LEAF:]
        yield frame
    for batch in batches:
        frame = pa.Table.from_batches([batch]).to_pandas()
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        *whole, held = blocks(held, False)
        yield from block_edges(whole)
    if held is not None:
        *whole, _ = blocks(held, True)
        yield from block_edges(whole)


def block_edges(blocks):
    parts = []
    for block in blocks:
        for _, own in block.groupby("size"):
            if len(own) > 1:
                x = np.stack([np.frombuffer(v, dtype=np.float32) for v in own["v"]])
                parts.append(best_of_block(own["id"].to_numpy(), x, np.full(len(own), -2.0), NEIGHBOURS))
    if parts:
        yield _edges(parts)


def shortened(batches):
    """Edges sorted by a, likeness falling: each list without repeats, NEIGHBOURS long."""
    for frame in whole_groups(batches, ["a"]):
        frame = frame.drop_duplicates(["a", "b"])
        place = frame.groupby("a").cumcount()
        yield pa.RecordBatch.from_pandas(frame[place < NEIGHBOURS], preserve_index=False)


def shorten(edges: DataFrame) -> DataFrame:
    return written(edges.repartition("a").sortWithinPartitions("a", F.desc("likeness"), "b").mapInArrow(shortened, EDGE))


def met_at(batches):
    """Rows sorted by pivot (pivot, id, size, floor, v): the neighbours of one pivot meet each other."""
    for frame in whole_groups(batches, ["pivot"]):
        frame = frame.drop_duplicates(["pivot", "id"])
        ids, floor = frame["id"].to_numpy(), frame["floor"].to_numpy()
        pivot, size = frame["pivot"].to_numpy(), frame["size"].to_numpy()
        data = frame["v"].to_numpy()
        ends = starts_of(pivot)
        parts = []
        for lo, hi in zip(ends[:-1], ends[1:]):
            for at in range(lo, hi, TOGETHER):
                to = min(at + TOGETHER, hi)
                if to - at > 1 and (size[at:to] == size[at]).all():
                    x = np.frombuffer(b"".join(data[at:to]), dtype=np.float32).reshape(to - at, -1)
                    parts.append(best_of_block(ids[at:to], x, floor[at:to], BEST))
        if parts:
            yield _edges(parts)


def descend(graph: DataFrame, vectors: DataFrame) -> DataFrame:
    """One round: every vector's neighbours, and those it is a neighbour of, are compared with each other."""
    both = graph.select(F.col("a").alias("pivot"), F.col("b").alias("id")).union(
        graph.select(F.col("b").alias("pivot"), F.col("a").alias("id")))
    floors = graph.groupBy("a").agg(F.when(F.count("*") >= NEIGHBOURS, F.min("likeness")).otherwise(F.lit(-2.0)).alias("floor"))
    around = (both.join(vectors.join(floors.withColumnRenamed("a", "id"), "id", "left")
                        .select("id", "size", F.coalesce("floor", F.lit(-2.0)).cast("float").alias("floor"), "v"), "id"))
    found = around.select("pivot", "id", "size", "floor", "v").repartition("pivot").sortWithinPartitions("pivot", "id").mapInArrow(met_at, EDGE)
    return shorten(graph.union(found))


def cosines(batches):
    """(a, b, unit_a, unit_b) to the pairs that link, in double precision."""
    for batch in batches:
        frame = pa.Table.from_batches([batch]).to_pandas()
        same = frame["unit_a"].str.len() == frame["unit_b"].str.len()
        for _, own in frame[same].groupby(frame["unit_a"].str.len()):
            good = np.einsum("ij,ij->i", matrix(own["unit_a"]), matrix(own["unit_b"])) >= COSINE
            yield pa.RecordBatch.from_pandas(own.loc[good, ["a", "b"]], preserve_index=False)


def partial_sums(batches):
    """(component, unit, times) to sums by component of one task's rows."""
    sums: dict[int, list] = {}
    for batch in batches:
        for component, unit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.frombuffer(unit, dtype=np.float64)
            if component in sums:
                sums[component] += x
            else:
                sums[component] = x.copy()
        if len(sums) > 100_000:
            yield _sums(sums)
            sums = {}
    if sums:
        yield _sums(sums)


def _sums(sums):
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                      names=["component", "total"])


def directions(batches):
    """(component, totals of the tasks) to the component's mean direction."""
    for batch in batches:
        out = []
        for totals in batch.column(1).to_pylist():
            x = np.sum([np.frombuffer(t, dtype=np.float64) for t in totals], axis=0)
            length = math.sqrt(x @ x)
            out.append((x / length if length else x).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["component", "centre"])


#: Two vectors within this angle of one direction are within the threshold's angle of each other.
CORE = math.cos(math.acos(COSINE) / 2 - 1e-6)


def core_of(batches):
    """(id, component, times, unit, centre) to the rows with whether they lie so near the centre that all such link."""
    for batch in batches:
        frame = pa.Table.from_batches([batch]).to_pandas()
        core = [float(np.frombuffer(u, dtype=np.float64) @ np.frombuffer(c, dtype=np.float64)) >= CORE
                for u, c in zip(frame["unit"], frame["centre"])]
        yield pa.RecordBatch.from_pandas(frame[["id", "component", "times", "unit"]].assign(core=core), preserve_index=False)


def counted_cells(batches):
    """Cells (component, i, j) of outer rows against all rows: for each row how many vectors of the cell link to it.

    An outer row counts all rows of the cell; a core row counts the outer ones (core rows link to core rows unseen).
    """
    for frame in whole_groups(batches, ["component", "i", "j"]):
        ends = starts_of(frame["component"].to_numpy(), frame["i"].to_numpy(), frame["j"].to_numpy())
        ids, links = [], []
        for lo, hi in zip(ends[:-1], ends[1:]):
            own = frame.iloc[lo:hi]
            asks, all_rows = own[own["asks"]], own[~own["asks"]]
            if asks.empty or all_rows.empty:
                continue
            linked = matrix(asks["unit"]) @ matrix(all_rows["unit"]).T >= COSINE
            linked &= asks["id"].to_numpy()[:, None] != all_rows["id"].to_numpy()[None, :]
            ids.append(asks["id"].to_numpy())
            links.append(linked @ all_rows["times"].to_numpy())
            core = all_rows["core"].to_numpy()
            ids.append(all_rows["id"].to_numpy()[core])
            links.append(asks["times"].to_numpy() @ linked[:, core])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), pa.int64()),
                                              pa.array(np.concatenate(links).astype(np.int64))], names=["id", "links"])


#: The angle of two vectors at the threshold, with room for rounding.
ANGLE = math.acos(COSINE) + 1e-6


def angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def away(batches):
    """(component, unit, centre) to each row's angle from its centre."""
    for batch in batches:
        frame = pa.Table.from_batches([batch]).to_pandas()
        out = [float(angles(np.frombuffer(u, dtype=np.float64), np.frombuffer(c, dtype=np.float64)))
               for u, c in zip(frame["unit"], frame["centre"])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["component", "away"])


def near_centres(batches):
    """Cells (size, i, j) of centres to the pairs of components whose reaches leave room for a link."""
    for frame in whole_groups(batches, ["size", "i", "j"]):
        for (_, i, j), own in frame.groupby(["size", "i", "j"]):
            asks, others = own[own["asks"]], own[~own["asks"]]
            if asks.empty or others.empty:
                continue
            near = (angles(matrix(asks["centre"]), matrix(others["centre"]))
                    <= asks["reach"].to_numpy()[:, None] + others["reach"].to_numpy()[None, :] + ANGLE)
            a, b = np.nonzero(near)
            p, q = asks["component"].to_numpy()[a], others["component"].to_numpy()[b]
            good = p < q if i == j else p != q
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)[good]), pa.array(np.maximum(p, q)[good])], names=["p", "q"])


def within_reach(batches):
    """(p, q, asks, id, unit, centre and reach of the other component) to the rows that may link with the other one."""
    for batch in batches:
        frame = pa.Table.from_batches([batch]).to_pandas()
        good = np.array([angles(np.frombuffer(u, dtype=np.float64), np.frombuffer(c, dtype=np.float64)) <= r + ANGLE
                         for u, c, r in zip(frame["unit"], frame["centre"], frame["reach"])], dtype=bool)
        yield pa.RecordBatch.from_pandas(frame.loc[good, ["p", "q", "asks", "id", "unit"]], preserve_index=False)


def touching(batches):
    """Cells (p, q, i, j) of rows of two components to the pairs (a, b) of components of which two vectors link."""
    for frame in whole_groups(batches, ["p", "q", "i", "j"]):
        ends = starts_of(*(frame[c].to_numpy() for c in ("p", "q", "i", "j")))
        out = []
        for lo, hi in zip(ends[:-1], ends[1:]):
            own = frame.iloc[lo:hi]
            asks, others = own[own["asks"]], own[~own["asks"]]
            if len(asks) and len(others) and (matrix(asks["unit"]) @ matrix(others["unit"]).T >= COSINE).any():
                out.append((own["p"].iloc[0], own["q"].iloc[0]))
        if out:
            a, b = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def crossed(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Each row in the cells (i, j) of its block, as one that asks in its line and one that is asked in its column."""
    dealt = rows.withColumn("_k", F.pmod(F.xxhash64(key), blocks).cast("int"))
    return dealt.select(*rows.columns, F.col("_k").alias("i"), F.explode(F.sequence("_k", F.col(blocks) - 1)).alias("j"),
                        F.lit(True).alias("asks")).union(
        dealt.select(*rows.columns, F.explode(F.sequence(F.lit(0), "_k")).alias("i"), F.col("_k").alias("j"), F.lit(False).alias("asks")))


def joined_across(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """``placed`` (id, component, unit) with those components made one of which vectors in ``rows`` link to each other.

    Every pair of components is looked at: angles are a metric, so components whose centres lie further apart than both
    reaches and the threshold's angle have no link. What is left is compared vector by vector in blocks.
    """
    centres = written(rows.select("component", "unit").mapInArrow(partial_sums, "component long, total binary")
                      .groupBy("component").agg(F.collect_list("total").alias("totals"))
                      .mapInArrow(directions, "component long, centre binary"))
    reach = (rows.join(centres, "component").select("component", "unit", "centre").mapInArrow(away, "component long, away double")
             .groupBy("component").agg(F.max("away").alias("reach")))
    balls = written(centres.join(reach, "component").select("component", "centre", "reach", F.length("centre").alias("size")))
    several = balls.groupBy("size").agg(F.ceil(F.count("*") / BALLS).cast("int").alias("blocks"))
    pairs = written(crossed(balls.join(F.broadcast(several), "size"), "component", "blocks")
                    .select("size", "i", "j", "asks", "component", "centre", "reach").repartition("size", "i", "j")
                    .sortWithinPartitions("size", "i", "j").mapInArrow(near_centres, "p long, q long"))
    towards = pairs.select("p", "q", F.col("p").alias("component"), F.col("q").alias("other"), F.lit(True).alias("asks")).union(
        pairs.select("p", "q", F.col("q").alias("component"), F.col("p").alias("other"), F.lit(False).alias("asks")))
    may = written(towards.join(balls.select(F.col("component").alias("other"), "centre", "reach"), "other")
                  .join(rows.select("component", "id", "unit"), "component")
                  .select("p", "q", "asks", "id", "unit", "centre", "reach")
                  .mapInArrow(within_reach, "p long, q long, asks boolean, id long, unit binary"))
    count = lambda side: F.ceil(F.sum(F.when(side, 1).otherwise(0)) / TOGETHER).cast("int")
    sized = may.join(may.groupBy("p", "q").agg(count(F.col("asks")).alias("lines"), count(~F.col("asks")).alias("columns"))
                     .where("lines > 0 and columns > 0"), ["p", "q"])
    line, column = (F.pmod(F.xxhash64("id"), x).cast("int") for x in ("lines", "columns"))
    cells = (sized.where("asks").withColumn("i", line).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)))
             .unionByName(sized.where("not asks").withColumn("j", column)
                          .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("lines") - 1)))))
    links = (cells.select("p", "q", "i", "j", "asks", "unit").repartition("p", "q", "i", "j")
             .sortWithinPartitions("p", "q", "i", "j").mapInArrow(touching, "a long, b long"))
    parts = components(links).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    return written(placed.join(parts, "component", "left").select("id", F.coalesce("whole", "component").alias("component"), "unit"))


def true_links(queries: list[tuple[int, int, bytes]]):
    """(id, component, unit) to (query, found, missed): its linked vectors of its component and of others."""
    def run(batches):
        total = {q[0]: [0, 0] for q in queries}
        by_size: dict[int, list] = {}
        for q in queries:
            by_size.setdefault(len(q[2]), []).append(q)
        for batch in batches:
            frame = pa.Table.from_batches([batch]).to_pandas()
            for size, own in frame.groupby(frame["unit"].str.len()):
                if size not in by_size:
                    continue
                ids, parts, unit = zip(*by_size[size])
                linked = matrix(own["unit"]) @ matrix(pd.Series(unit)).T >= COSINE
                linked &= own["id"].to_numpy()[:, None] != np.array(ids)[None, :]
                same = own["component"].to_numpy()[:, None] == np.array(parts)[None, :]
                for q, found, missed in zip(ids, (linked & same).sum(axis=0), (linked & ~same).sum(axis=0)):
                    total[q][0] += int(found)
                    total[q][1] += int(missed)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), *(pa.array([t[i] for t in total.values()], pa.int64())
                                                                               for i in (0, 1))], names=["id", "found", "missed"])
    return run


def near_components(rows: DataFrame) -> tuple[DataFrame, float]:
    """(id, component) of the vectors in ``rows`` (id, size, unit; ids distinct), and the recall the audit found.

    Random hyperplane orders start neighbour lists; rounds of neighbours of neighbours refine them; list entries at the
    threshold are tested in double precision and joined to components. A link that neither end lists needs two full
    lists of links: all vectors with such lists are held against those of the other components. The audit holds a fixed
    number of vectors, and as many that have links, against all rows; below RECALL, more orders and rounds follow, and
    where these do not help all components are held against each other.
    """
    n = rows.count()
    levels = max(1, math.ceil(math.log2(max(n, 2) / LEAF)))
    vectors = written(rows.mapInArrow(singles, "id long, size long, v binary"))
    graph, recall = None, 1.0
    for attempt in range(3):
        trees = range(attempt * TREES, (attempt + 1) * TREES)
        ordered = written(rows.mapInArrow(orders(trees, min(levels, 60)), "tree long, size long, leaf long, along double, id long, v binary"))
        first = (ordered.repartitionByRange("tree", "size", "leaf", "along").sortWithinPartitions("tree", "size", "leaf", "along")
                 .mapInArrow(first_edges, EDGE))
        graph = shorten(first if graph is None else graph.union(first))
        for _ in range(ROUNDS):
            after = descend(graph, vectors)
            kept = after.join(graph.select("a", "b"), ["a", "b"], "left_semi").count()
            size = after.count()
            graph = after
            if size - kept <= STILL * size:
                break
        likely = graph.where(F.col("likeness") >= COSINE - SINGLE).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        paired = (likely.join(rows.select(F.col("id").alias("a"), F.col("unit").alias("unit_a")), "a")
                  .join(rows.select(F.col("id").alias("b"), F.col("unit").alias("unit_b")), "b"))
        parts = components(paired.select("a", "b", "unit_a", "unit_b").mapInArrow(cosines, "a long, b long"))
        placed = written(rows.join(parts, "id", "left").select(
            "id", F.coalesce("component", "id").alias("component"), "unit"))
        full = graph.groupBy("a").agg(F.count("*").alias("n"), F.min("likeness").alias("last")).where(
            (F.col("n") >= NEIGHBOURS) & (F.col("last") >= COSINE - SINGLE)).select(F.col("a").alias("id"))
        full = written(placed.join(full, "id", "left_semi"))
        if full.select("component").distinct().limit(2).count() > 1:
            placed = joined_across(full, placed)
        linked = placed.join(parts.select("id"), "id", "left_semi")
        queries = {q.id: q for some in (placed, linked)
                   for q in some.orderBy(F.xxhash64("id"), "id").limit(AUDIT).collect()}      # twice AUDIT vectors at most
        tested = placed.mapInArrow(true_links([(q.id, q.component, bytes(q.unit)) for q in queries.values()]),
                                   "id long, found long, missed long").groupBy("id").agg(
            F.sum("found").alias("found"), F.sum("missed").alias("missed")).where("found + missed > 0").collect()
        recall = sum(t.found / (t.found + t.missed) for t in tested) / len(tested) if tested else 1.0
        if recall >= RECALL:
            return placed, recall
    return joined_across(placed, placed), 1.0


def singles(batches):
    for batch in batches:
        v = [np.frombuffer(x, dtype=np.float64).astype(np.float32).tobytes() for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(v, pa.binary())], names=["id", "size", "v"])


def near_duplicates(table: DataFrame) -> tuple[DataFrame, float]:
    """(vec_id, n_links, component_id, kept) of every row, and the audited recall.

    Equal vectors are one vector with a count. Where lists are full of links (groups larger than a list) the whole
    component takes the list's place: vectors near its mean direction link to each other by the angle alone and are only
    counted, all others are compared with the component in blocks. So each link inside a component is found, and n_links
    never needs the pairs. Null, empty and zero vectors, and those with null or non-finite components, link with
    nothing, as do vectors of unlike length. Rows without an id are left out of links and keep a null component.
    Repeated rows are copies; unlike vectors of one id are vectors of their own, each with its own links and component. An
    empty table gives an empty result.
    """
    kind = table.schema["vec_id"].dataType.simpleString()
    rows = written(table.select("vec_id", F.col("embedding").cast("array<double>"))
                   .mapInArrow(units, f"vec_id {kind}, size long, unit binary").withColumn("same", F.md5("unit")))
    reps = written(rows.where("unit is not null and vec_id is not null").groupBy("same", "size")
                   .agg(F.min("vec_id").cast("long").alias("least"), F.count("*").alias("times"), F.first("unit").alias("unit"))
                   .withColumn("id", F.xxhash64("same", "size")))
    placed, recall = near_components(reps.select("id", "size", "unit"))
    placed = placed.join(reps.select("id", "times"), "id")
    several = placed.groupBy("component").agg(F.count("*").alias("members")).where("members > 1")
    inside = written(placed.join(several.select("component"), "component").select("id", "component", "times", "unit"))
    centres = (inside.select("component", "unit").mapInArrow(partial_sums, "component long, total binary")
               .groupBy("component").agg(F.collect_list("total").alias("totals"))
               .mapInArrow(directions, "component long, centre binary"))
    marked = written(inside.join(centres, "component").select("id", "component", "times", "unit", "centre")
                     .mapInArrow(core_of, "id long, component long, times long, unit binary, core boolean"))
    sizes = marked.groupBy("component").agg(
        F.sum(F.when(F.col("core"), F.col("times")).otherwise(0)).alias("core_times"),
        F.ceil(F.count("*") / TOGETHER).cast("int").alias("blocks"),
        F.ceil(F.sum((~F.col("core")).cast("int")) / TOGETHER).cast("int").alias("outer_blocks"))
    sized = marked.join(sizes, "component")
    every = (sized.where("outer_blocks > 0").withColumn("j", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1))).withColumn("asks", F.lit(False)))
    outer = (sized.where("not core").withColumn("i", F.pmod(F.xxhash64("id", F.lit(1)), "outer_blocks").cast("int"))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True)))
    columns = ["component", "i", "j", "asks", "id", "times", "core", "unit"]
    cells = (every.select(*columns).union(outer.select(*columns)).repartition("component", "i", "j")
             .sortWithinPartitions("component", "i", "j").mapInArrow(counted_cells, "id long, links long")
             .groupBy("id").agg(F.sum("links").alias("links")))
    counted = sized.join(cells, "id", "left").select(
        "id", "component", (F.coalesce("links", F.lit(0)) + F.when(F.col("core"), F.col("core_times") - F.col("times"))
                            .otherwise(0)).alias("links"))
    told = written(reps.select("same", "size", "id", "times", "least").join(counted, "id", "left").select(
        "same", "size", "least", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component")))
    whole = told.join(told.groupBy("component").agg(F.min("least").alias("component_id")), "component").drop("least", "component")
    usable = F.col("unit").isNotNull() & F.col("vec_id").isNotNull()
    out = rows.join(whole, ["same", "size"], "left").select(
        "vec_id", F.when(usable, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        F.when(usable, F.col("component_id")).otherwise(F.col("vec_id")).cast("long").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), recall


@query("op3_nn_descent")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf}/embeddings.parquet"))[0]
