"""The dataset manifest against a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from queuecraft.llm import merkle

from .conftest import SCHEMA, invented


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_leaf(r, text):
    values = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(level, paths):
    """Root of the digests in ``level``; paths[i] collects (before, behind) of the i-th one's ancestors."""
    members = [[i] for i in range(len(level))]
    while len(level) > 1:
        for at in range(0, len(level), 3):
            run = level[at:at + 3]
            for k, under in enumerate(members[at:at + 3]):
                for i in under:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
        members = [sum(members[at:at + 3], []) for at in range(0, len(level), 3)]
        level = [h(*level[at:at + 3]) for at in range(0, len(level), 3)]
    return level[0]


def plain_manifest(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text), r))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subroots, inner = [], {}
    for name in names:
        trees[name].sort(key=lambda x: x[:3])
        inner[name] = [[] for _ in trees[name]]
        subroots.append(climb([x[2] for x in trees[name]], inner[name]))
    above = [[] for _ in names]
    root = climb(subroots, above)
    out = []
    for name, subroot, top in zip(names, subroots, above):
        for (_, _, leaf, r), own in zip(trees[name], inner[name]):
            path = own + top
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            value = plain_leaf(r, r.text and r.text.replace("\n", "")) if hit else leaf
            for before, behind in path:
                value = h(before, value, behind)
            out.append((r.doc_id, leaf, subroot, root, h(*[a + b for a, b in path]), value, value == root))
    return sorted(out, key=str)


def got(df):
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", ""))
    return sorted([tuple(r) for r in merkle.verified(merkle.manifest(df, cut)).collect()], key=str)


@pytest.mark.parametrize("near", [6, 1])
def test_manifest_of_trees_of_many_sizes(spark, monkeypatch, near):
    monkeypatch.setattr(merkle, "NEAR", near)           # 1: ancestors are copied from the second round on
    monkeypatch.setattr(merkle, "TREE_SHARE", 4)
    rows, at = [], 0
    for source, n in [(None, 5), ("", 1), ("a", 2), ("b", 3), ("é", 4), ("z", 27), ("hot", 100)]:
        for _ in range(n):
            rows.append((at, f"line {at}\nmore" if at % 3 else None, "en", source, at, None, "x", 1, "k", None, "c"))
            at += 1
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df) == plain_manifest(df.collect())


def test_manifest_of_odd_documents(spark, odd, empty):
    small = odd.where("n_chars is null or n_chars < 20000")
    assert got(small) == plain_manifest(small.collect())
    assert got(empty) == []


def test_a_lone_row_is_the_root(spark):
    df = spark.createDataFrame([(3, "a\nb", None, None, 1, None, "x", 1, "k", None, "c")], SCHEMA)
    (row,) = got(df)
    assert row[1] == row[2] == row[3] and row[4] == h("") and got(df) == plain_manifest(df.collect())


def test_a_changed_column_is_found(spark):
    rows = [(i, invented(i, 8), "en", f"s{i % 3}", i, None, "x", 1, "k", None, "c") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    text = F.when(F.col("doc_id") == 7, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    bad = [r.doc_id for r in merkle.verified(merkle.manifest(df, text)).where("not verified").collect()]
    assert bad == [7]
