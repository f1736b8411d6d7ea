"""Hard negatives by Four-Russians scoring: exact integer inner products from tables of subset sums.

A candidate's integers are cut into bit planes, eight dimensions to a byte. An anchor has, for every eight dimensions,
the sums of all 256 subsets of its components. A plane's product is then one lookup a byte, and shifted by the plane's
place and added up the lookups are the whole product, without a multiplication and without rounding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuecraft.llm.common import written
from queuecraft.llm.registry import query

SCALE = 256             # a component x becomes floor(SCALE * x)
ANCHOR_STEP = 50        # anchors are the rows whose vec_id it divides
SHIFT_STEP, LABELS = 7, 10      # rows whose vec_id SHIFT_STEP divides take the next of LABELS labels
POSITIVES, NEGATIVES = 5, 3
ANCHORS, CANDIDATES = 512, 4096     # rows of a block of either side
TABLE = 1 << 22         # entries of the subset-sum tables held at once
PER_TASK = 64           # pairs of blocks a task has at most

WHO = "vec_id long, label int, tag long"
POSITIVE = "anchor_id long, label int, tag long, positive_id long, positive_tag long, positive_score long"
NEGATIVE = POSITIVE + ", negative_id long, negative_label int, negative_tag long, negative_score long"


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v: longs, dim, tag) of the rows that take part, equal rows once."""
    x = F.transform(F.col("embedding").cast("array<double>"), lambda e: F.floor(F.lit(float(SCALE)) * e))
    bad = F.exists(F.col("embedding").cast("array<double>"), lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    label = F.when(F.col("vec_id") % SHIFT_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return (vectors.where("vec_id is not null and label is not null and embedding is not null").where(~bad)
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), x.alias("v")).distinct()
            .withColumn("dim", F.size("v")).withColumn("tag", F.xxhash64("v")))


def bit_planes(planes: int):
    """Arrow function: (vec_id, label, tag, dim, v) to (vec_id, label, tag, dim, codes): for every plane of the two's
    complement a byte per eight dimensions, the first dimension in the lowest bit."""
    def run(batches):
        for batch in batches:
            lists = batch.column(4)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(lists.offsets.to_numpy())
            codes, at = [], 0
            for n in ends.tolist():
                own = flat[at:at + n]
                at += n
                bits = (own[None, :] >> np.arange(planes)[:, None]) & 1
                codes.append(np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(codes, pa.binary())],
                                             names=["vec_id", "label", "tag", "dim", "codes"])
    return run


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Rows of components to tables [eight dimensions, subset, anchor]."""
    n, dim = anchors.shape
    groups = -(-dim // 8)
    parts = np.zeros((groups * 8, n), np.int64)
    parts[:dim] = anchors.T
    parts = parts.reshape(groups, 8, n)
    out = np.zeros((groups, 256, n), np.int64)
    for j in range(8):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + parts[:, j, None, :]
    return out


def scores(anchors: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Inner products [anchor, candidate] of component rows and codes [candidate, plane, eight dimensions]."""
    n, planes, groups = codes.shape
    out = np.zeros((len(anchors), n), np.int64)
    width = max(TABLE // (256 * max(groups, 1)), 1)
    for a in range(0, len(anchors), width):
        table = subset_sums(anchors[a:a + width])
        held = table.shape[2]
        for c in range(0, n, 512):
            own = codes[c:c + 512]
            total, look = np.zeros((len(own), held), np.int64), np.empty((len(own), held), np.int64)
            for plane in range(planes):
                some = np.zeros((len(own), held), np.int64)
                for group in range(groups):
                    np.take(table[group], own[:, plane, group], axis=0, out=look, mode="clip")
                    some += look
                some <<= plane
                total += -some if plane == planes - 1 else some         # the last plane holds the sign
            out[a:a + width, c:c + 512] = total.T
    return out


def block_pairs(batches, planes: int):
    """Joined rows (dim, anchors, candidates) one by one, as arrays; candidates stand in the order of ties."""
    for batch in batches:
        for row in range(batch.num_rows):
            dim = batch.column(0)[row].as_py()
            anchors, cands = batch.column(1)[row].values, batch.column(2)[row].values
            who = [np.asarray(cands.field(f)) for f in ("vec_id", "label", "tag")]
            codes = np.frombuffer(b"".join(cands.field("codes").to_pylist()), np.uint8).reshape(len(cands), planes, -(-dim // 8))
            order = np.lexsort((who[2], who[1], who[0]))
            v = anchors.field("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(anchors), dim)
            yield anchors, v, [w[order] for w in who], codes[order]


def table_of(parts: list, schema: str):
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int32() if c.split()[1] == "int" else pa.int64() for c in schema.split(", ")]
    columns = [np.concatenate(x) for x in zip(*parts)] if parts else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def best_positives(planes: int):
    """Arrow function: a block's POSITIVES best other rows of each anchor's label."""
    def run(batches):
        for anchors, v, (ids, labels, tags), codes in block_pairs(batches, planes):
            a_id, a_label, a_tag = (np.asarray(anchors.field(f)) for f in ("vec_id", "label", "tag"))
            parts = []
            for label in np.unique(a_label):
                mine, theirs = np.flatnonzero(a_label == label), np.flatnonzero(labels == label)
                for x, s in zip(mine, scores(v[mine], codes[theirs])):
                    other = np.flatnonzero((ids[theirs] != a_id[x]) | (tags[theirs] != a_tag[x]))
                    first = other[np.argsort(-s[other], kind="stable")[:POSITIVES]]
                    k = len(first)
                    parts.append([np.full(k, a_id[x]), np.full(k, label), np.full(k, a_tag[x]),
                                  ids[theirs[first]], tags[theirs[first]], s[first]])
            yield table_of(parts, POSITIVE)
    return run


def best_negatives(planes: int):
    """Arrow function: of a block's rows of other labels, for each anchor and positive the NEGATIVES best whose score is
    at least half and at most 95 hundredths of the positive's."""
    def run(batches):
        for anchors, v, (ids, labels, tags), codes in block_pairs(batches, planes):
            a_id, a_label, a_tag = (np.asarray(anchors.field(f)) for f in ("vec_id", "label", "tag"))
            found = anchors.field("positives").to_pylist()
            parts = []
            for x, s in enumerate(scores(v, codes)):
                # a score below 0 leaves no room between its half and its 95 hundredths
                room = [(p, -(-p["score"] // 2), p["score"] * 95 // 100) for p in found[x] if p["score"] >= 0]
                if not room:
                    continue
                other = np.flatnonzero((labels != a_label[x]) & (s >= min(r[1] for r in room)) & (s <= max(r[2] for r in room)))
                other = other[np.argsort(-s[other], kind="stable")]
                falling = -s[other]
                for p, low, high in room:
                    at = np.searchsorted(falling, -high)
                    first = other[at:min(at + NEGATIVES, np.searchsorted(falling, -low, side="right"))]
                    k = len(first)
                    parts.append([np.full(k, w) for w in (a_id[x], a_label[x], a_tag[x], p["vec_id"], p["tag"], p["score"])]
                                 + [ids[first], labels[first], tags[first], s[first]])
            yield table_of(parts, NEGATIVE)
    return run


def blocks(rows: DataFrame, size: int, *columns: str) -> DataFrame:
    """(dim, cell, own): rows dealt by hash into cells of about ``size``, one row a cell."""
    cells = max(-(-rows.count() // size), 1)
    return (rows.withColumn("cell", F.pmod(F.xxhash64("vec_id", "label", "tag"), F.lit(cells)).cast("int"))
            .groupBy("dim", "cell").agg(F.collect_list(F.struct("vec_id", "label", "tag", *columns)).alias("own")))


def met(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """(dim, anchors, candidates): every block of anchors with every block of candidates of its dimension.

    Each block travels once for each block of the other side: the anchors are the stated queries against all rows.
    """
    a = anchors.select("dim", F.col("cell").alias("a"), F.col("own").alias("anchors"))
    c = candidates.select("dim", F.col("cell").alias("c"), F.col("own").alias("candidates"))
    sides = a.select("dim", "a").join(c.select("dim", "c"), "dim")
    pairs = sides.count()
    wide = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(pairs, wide), -(-pairs // PER_TASK), 1)
    return (sides.join(a, ["dim", "a"]).repartition(tasks, "dim", "a", "c")
            .join(sides.join(c, ["dim", "c"]).repartition(tasks, "dim", "a", "c"), ["dim", "a", "c"]).select("dim", "anchors", "candidates"))


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, embedding, label).

    Two passes of the anchors' blocks against the candidates' blocks: the first finds each anchor's positives, the
    second the negatives whose scores lie in the stretch that each positive sets. A block reports at most
    POSITIVES or NEGATIVES rows an anchor and positive, and ranks are cut before the rows are shuffled.

    Rows with a null id, label or vector, or any null or non-finite component, take no part. Rows equal in id, label and
    integers are one row; unlike rows of one id are rows of their own, ordered by label and digest. Vectors of unlike
    lengths do not meet. Anchors without a positive, and positives without a negative, give no row. Scores are exact while
    they fit 64 bits. An empty table gives an empty result; other columns are not looked at.
    """
    rows = written(integers(vectors))
    ends = rows.agg(F.max(F.array_max("v")), F.min(F.array_min("v"))).first()
    planes = 1 + max((ends[0] or 0).bit_length() if (ends[0] or 0) >= 0 else 0, (~(ends[1] or 0)).bit_length() if (ends[1] or 0) < 0 else 0)
    packed = rows.select("vec_id", "label", "tag", "dim", "v").mapInArrow(bit_planes(planes), WHO + ", dim int, codes binary")
    candidates = written(blocks(written(packed), CANDIDATES, "codes"))
    anchors = written(rows.where(F.col("vec_id") % ANCHOR_STEP == 0))

    best = Window.partitionBy("anchor_id", "label", "tag").orderBy(F.desc("positive_score"), "positive_id", "positive_tag")
    positives = (met(written(blocks(anchors, ANCHORS, "v")), candidates).mapInArrow(best_positives(planes), POSITIVE)
                 .withColumn("place", F.row_number().over(best)).where(F.col("place") <= POSITIVES))
    lists = positives.groupBy(F.col("anchor_id").alias("vec_id"), "label", "tag").agg(F.collect_list(F.struct(
        F.col("positive_id").alias("vec_id"), F.col("positive_tag").alias("tag"), F.col("positive_score").alias("score"))).alias("positives"))
    asked = written(anchors.join(lists, ["vec_id", "label", "tag"]))

    best = (Window.partitionBy("anchor_id", "label", "tag", "positive_id", "positive_tag")
            .orderBy(F.desc("negative_score"), "negative_id", "negative_label", "negative_tag"))
    return (met(written(blocks(asked, ANCHORS, "v", "positives")), candidates).mapInArrow(best_negatives(planes), NEGATIVE)
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= NEGATIVES)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % {SHIFT_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % {ANCHOR_STEP} = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
negatives AS (
  SELECT p.*, m.other_id AS negative_id, m.score AS negative_score FROM positives p JOIN met m USING (anchor_id)
  WHERE NOT m.same AND 50 * positive_score <= 100 * m.score AND 100 * m.score <= 95 * positive_score)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS rank,
  negative_id, positive_score, negative_score
FROM negatives QUALIFY rank <= {NEGATIVES}
"""


@query("op11_four_russians_negatives", SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf}/embeddings.parquet"))
