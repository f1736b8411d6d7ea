"""Manifest of a dataset as a forest of hash trees, with proofs built by pointer jumping.

Every row is a leaf, every source a tree of runs of three, the roots of all sources the leaves of one more tree. Nodes
hold the siblings met on the way towards an ancestor; joins of the nodes with themselves double the distance of that
ancestor until every leaf reaches its root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuecraft.llm.common import documents, written
from queuecraft.llm.registry import query

FAN = 3                 # nodes of a run
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NEAR = 6                # an ancestor is copied for each FAN ** NEAR of the nodes that point to it: no join key has more
TREE_SHARE = 100_000    # leaves that share one copy of their tree's own path to the root


def field(column: str | Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def hashed(*texts: Column) -> Column:
    """SHA-256 of the texts laid end to end, as 32 bytes; digests go in as lowercase hex text."""
    return F.unhex(F.sha2(F.concat(*texts), 256))


def as_text(digests: Column) -> Column:
    """Bytes of any number of digests as lowercase hex; nothing for null."""
    return F.coalesce(F.lower(F.hex(digests)), F.lit(""))


def leaf_of(columns=COLUMNS, **changed: Column) -> Column:
    return hashed(*[field(changed.get(c, c)) for c in columns])


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with pos, their place in their group from 0, and size, the group's rows. No group meets in one task.

    Rows are dealt by ranges of (group, order) and written in that order with a rising row number; a group's part of a
    range then needs only the count of the parts before it.
    """
    dealt = written(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                    .withColumn("_row", F.monotonically_increasing_id())
                    .withColumn("_part", F.shiftright("_row", 33)))
    parts = dealt.groupBy(group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                          F.sum("_n").over(Window.partitionBy(group)).alias("size"))
    return (dealt.join(starts, [group, "_part"]).withColumn("pos", F.col("_row") + F.col("_shift"))
            .drop("_row", "_part", "_shift"))


def runs_by_level(leaves: DataFrame) -> list[DataFrame]:
    """Runs of every level from the leaves' up: (tree, up, size, d0, d1, d2), where up is the place of the run's node one
    level higher and size the nodes of the level the run lies in. Only trees that still hold several nodes go on.

    leaves: (tree, pos, size, digest).
    """
    levels, nodes = [], leaves
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        runs = written(nodes.where("size > 1").withColumn("up", F.expr(f"pos div {FAN}")).groupBy("tree", "up", "size").agg(
            *[F.max(F.when(F.col("pos") % FAN == i, F.col("digest"))).alias(f"d{i}") for i in range(FAN)]))
        levels.append(runs)
        nodes = runs.select("tree", F.col("up").alias("pos"), F.expr(f"(size + {FAN - 1}) div {FAN}").alias("size"),
                            hashed(*[as_text(F.col(f"d{i}")) for i in range(FAN)]).alias("digest"))
        largest = -(-largest // FAN)
    return levels


def roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree."""
    tops = [leaves.where("size = 1").select("tree", "digest")] + [
        runs.where(f"size <= {FAN}").select("tree", hashed(*[as_text(F.col(f"d{i}")) for i in range(FAN)]).alias("digest"))
        for runs in levels]
    out = tops[0]
    for top in tops[1:]:
        out = out.union(top)
    return written(out)


def step(at: Column) -> Column:
    """The siblings of the node at place ``at`` of its run: the digests before it and those behind it."""
    none = F.lit(b"")
    d = [F.coalesce(F.col(f"d{i}"), none) for i in range(FAN)]
    before = F.when(at == 0, none).when(at == 1, d[0]).otherwise(F.concat(d[0], d[1]))
    behind = F.when(at == 0, F.concat(d[1], d[2])).when(at == 1, d[2]).otherwise(none)
    return F.array(F.struct(before.alias("before"), behind.alias("behind")))


def with_paths(leaves: DataFrame, levels: list[DataFrame], carried: list[str]) -> DataFrame:
    """(tree, pos, *carried, path) of every leaf: the siblings level by level up to its tree's root.

    Leaves and inner nodes first hold their own run's siblings, one level's worth. A round joins each node with the
    ancestor it has reached, whose own path is as long, and so doubles the distance. Only nodes at multiples of the
    distance are still needed. A node that has its root as ancestor waits.
    """
    height = len(levels)
    keep = ["tree", "pos", *carried]
    if not height:
        return leaves.select(*keep, F.expr("cast(array() as array<struct<before: binary, behind: binary>>)").alias("path"))
    lone = leaves.where("size = 1").select(*keep, F.expr("cast(array() as array<struct<before: binary, behind: binary>>)").alias("path"))
    first = (leaves.where("size > 1").withColumn("up", F.expr(f"pos div {FAN}"))
             .join(levels[0].drop("size"), ["tree", "up"]).select(*keep, step(F.col("pos") % FAN).alias("path")))
    inner = [runs.select("tree", F.posexplode(F.array(*[F.col(f"d{i}") for i in range(FAN)])).alias("at", "own"),
                         "up", *[f"d{i}" for i in range(FAN)]).where("own is not null")
             .select("tree", F.lit(level).alias("level"), (F.col("up") * FAN + F.col("at")).alias("pos"), step(F.col("at")).alias("path"))
             for level, runs in enumerate(levels) if level]
    distance, state = 1, written(first)
    nodes = None
    for part in inner:
        nodes = part if nodes is None else nodes.union(part)
    while distance < height:
        near = FAN ** min(distance, NEAR)
        copies = FAN ** (distance - min(distance, NEAR))
        ancestors = nodes.where(F.col("level") % distance == 0).select(
            "tree", "level", F.explode(F.sequence(F.col("pos") * copies, F.col("pos") * copies + copies - 1)).alias("_near"),
            F.col("path").alias("rest"))
        longer = F.when(F.col("rest").isNull(), F.col("path")).otherwise(F.concat("path", "rest"))
        here = state.withColumn("_near", F.expr(f"pos div {near}"))
        nearest = ancestors.where(F.col("level") == distance).drop("level")
        state = written(here.join(nearest, ["tree", "_near"], "left").select(*keep, longer.alias("path")))
        distance *= 2
        if distance < height:
            kept = nodes.where(F.col("level") % distance == 0).withColumn("_near", F.expr(f"pos div {near}"))
            above = ancestors.withColumn("level", F.col("level") - distance // 2)
            nodes = written(kept.join(above, ["tree", "level", "_near"], "left").select("tree", "level", "pos", longer.alias("path")))
    return state.unionByName(lone)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to with the siblings of ``path``, as lowercase hex."""
    return F.aggregate(path, as_text(leaf), lambda own, s: F.sha2(F.concat(as_text(s["before"]), own, as_text(s["behind"])), 256))


def manifest(docs: DataFrame, tampered: Column | None = None, columns=COLUMNS, key: str = "doc_id", group: str = "source") -> DataFrame:
    """(key, group, leaf, tampered, subroot, root, path) of every row of ``docs``.

    leaf covers ``columns``; tampered is the leaf recomputed with the text that the column ``tampered`` gives (null
    where it is null); path holds the siblings (before, behind as bytes) up to the root of everything. Repeated rows are
    leaves of their own beside each other, rows of one key follow each other by digest; rows without a key come first in
    their tree, rows without a source have a tree of their own, the first. An empty table gives an empty result; other
    columns are not looked at.
    """
    changed = F.lit(None).cast("binary") if tampered is None else F.when(tampered.isNotNull(), leaf_of(columns, text=tampered))
    # a tree's name sorts as its source does, null first
    rows = docs.select(F.col(key).cast("long").alias("key"), F.when(F.col(group).isNull(), F.lit("")).otherwise(
        F.concat(F.lit("="), F.col(group).cast("string"))).alias("tree"), leaf_of(columns).alias("digest"), changed.alias("tampered"))
    leaves = written(placed(rows, "tree", ["key", "digest"]))
    levels = runs_by_level(leaves)
    trees = roots(leaves, levels).withColumnRenamed("digest", "subroot")

    top = written(placed(trees.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest")), "tree", ["name"]))
    top_levels = runs_by_level(top)
    root = roots(top, top_levels).first()
    paths = with_paths(top, top_levels, ["name", "digest"])
    sizes = leaves.groupBy("tree").agg(F.max("size").alias("size"))
    shared = (paths.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("top")).join(sizes, "tree")
              .withColumn("share", F.explode(F.sequence(F.lit(0), F.expr(f"(size - 1) div {TREE_SHARE}")))).drop("size"))
    own = with_paths(leaves, levels, ["key", "digest", "tampered"]).withColumn("share", F.expr(f"pos div {TREE_SHARE}"))
    return own.join(shared, ["tree", "share"]).select(
        F.col("key").alias(key), F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1)).alias(group), as_text(F.col("digest")).alias("leaf"),
        F.col("tampered"), as_text(F.col("subroot")).alias("subroot"), F.lit(None if root is None else root["digest"].hex()).alias("root"),
        F.concat("path", "top").alias("path"))


def verified(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of a manifest with proof_sha256, and with the root that the tampered leaf (else the leaf) leads to."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(as_text(s["before"]), as_text(s["behind"]))), "")
    leads = folded(F.coalesce("tampered", F.unhex("leaf")), F.col("path"))
    return rows.select(key, "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), leads.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


# The lowest bit of a CRC, and the whole tree, said again in another engine's SQL.
SQL = r"""
WITH RECURSIVE crc AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN NULL ELSE xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      [CAST(ascii(ch) AS BIGINT) FOR ch IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(i AS BIGINT) FOR i IN range(8)]),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) END AS crc FROM documents),
given AS (
  SELECT doc_id, source, crc % 2 = 0 AS hit,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    text, replace(text, chr(10), '') AS cut FROM crc),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) END AS bad FROM given),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1
  GROUP BY tree, level, pos // 3, n),
subroots AS (SELECT tree, level AS height, d AS subroot FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS pos, subroot AS d, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
forest AS (
  SELECT tree, level, pos, d, n FROM nodes WHERE n > 1
  UNION ALL SELECT NULL, level, pos, d, n FROM top WHERE n > 1),
steps AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS behind
  FROM forest a JOIN forest b ON a.tree IS NOT DISTINCT FROM b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  GROUP BY a.tree, a.level, a.pos),
tree_at AS (SELECT tree, height, subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM subroots),
climb AS (
  SELECT p.doc_id, p.tree, p.leaf, p.pos AS at, 0 AS level, p.pos, coalesce(p.bad, p.leaf) AS own, '' AS proof FROM placed p
  UNION ALL
  SELECT c.doc_id, c.tree, c.leaf, c.at, c.level + 1,
    CASE WHEN c.level + 1 = t.height THEN t.place ELSE c.pos // 3 END, sha256(s.before || c.own || s.behind), c.proof || s.before || s.behind
  FROM climb c JOIN tree_at t ON c.tree = t.tree
  JOIN steps s ON s.level = c.level AND s.pos = c.pos AND s.tree = c.tree WHERE c.level < t.height),
rise AS (
  SELECT c.doc_id, c.leaf, t.subroot, 0 AS level, t.place AS pos, c.own, c.proof
  FROM climb c JOIN tree_at t ON c.tree = t.tree AND c.level = t.height
  UNION ALL
  SELECT r.doc_id, r.leaf, r.subroot, r.level + 1, r.pos // 3, sha256(s.before || r.own || s.behind), r.proof || s.before || s.behind
  FROM rise r JOIN steps s ON s.tree IS NULL AND s.level = r.level AND s.pos = r.pos)
SELECT doc_id, leaf, subroot, x.d AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = x.d AS verified
FROM rise JOIN (SELECT level, d FROM top WHERE n = 1) x ON rise.level = x.level
"""


@query("op13_pointer_jumping_proofs", SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", ""))
    return verified(manifest(documents(spark, sf), cut))
