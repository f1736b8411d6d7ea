"""Operators that compare documents or vectors, against all pairs on small tables."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from queuecraft.llm import common, jaccard, packing, repeats, secrets, toxicity, vectors

from .conftest import SCHEMA, invented, rows_of
from .test_texts import plain_secrets


def groups_of(nodes, links):
    parent = {n: n for n in nodes}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (80, 2))] + [(i, i + 1) for i in range(200, 240)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame([*links, (None, 3), (4, 4)], "a long, b long")).collect()}
    nodes = {n for l in links for n in l if l[0] != l[1]}
    assert got == groups_of(sorted(nodes), [l for l in links if l[0] != l[1]])


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def all_pairs(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), g) for i, g in groups_of(ids, links).items()}


def test_similar_components_of_odd_documents(odd, empty):
    named = odd.where("doc_id is not null")
    want = all_pairs([(r.doc_id, r.text) for r in named.collect()])
    rows = jaccard.similar_components(odd).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == want
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert jaccard.similar_components(empty).count() == 0


def test_long_lists_in_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "SAMPLE", 2)       # hardly any shingle is known to be frequent: lists get long
    rng = np.random.default_rng(4)
    shared = invented(1, 25)
    texts = []
    for group in range(6):
        base = invented(100 + group, 30)
        for _ in range(8):
            words = (shared + " " + base).split()
            for at in rng.integers(0, len(words), rng.integers(0, 4)):
                words[at] = f"w{rng.integers(1000)}"
            texts.append(" ".join(words))
    want = all_pairs(list(enumerate(texts)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard.similar_components(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    assert got == want


def test_one_of_each_keeps_columns(odd):
    kept = jaccard.one_of_each(odd)
    ids = [r.doc_id for r in kept.collect()]
    want = {g for _, g in all_pairs([(r.doc_id, r.text) for r in odd.where("doc_id is not null").collect()]).values()}
    assert kept.columns == odd.columns and sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 3


@pytest.mark.parametrize("block", [1000, 6])
def test_a_group_of_near_copies_of_which_only_some_link(spark, monkeypatch, block):
    """Copies of one text with other words changed: two of them link only if few words are changed in both."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = np.random.default_rng(17)
    base = invented(5, 120, 5000).split()
    texts = []
    for i in range(90):
        words = list(base)
        for at in rng.choice(len(words), int(rng.integers(0, 5)), replace=False):
            words[at] = f"w{rng.integers(10**6)}"
        texts.append(" ".join(words))
    want = all_pairs(list(enumerate(texts)))
    assert 5 < len({g for _, g in want.values()}) < 80
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard.similar_components(spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)).collect()}
    assert got == want


def test_unlike_texts_of_one_id_lose_no_link(spark):
    one, two, three = (invented(70 + i, 60) for i in range(3))
    near = lambda text: " ".join(["changed", *text.split()[1:]])
    rows = [(1, one), (1, two), (3, near(two)), (2, near(one)), (4, three), (4, three), (4, near(three)), (None, one), (9, ""), (9, None), (9, None), (9, "")]
    df = spark.createDataFrame(rows_of([t for _, t in rows], [i for i, _ in rows]), SCHEMA).repartition(3)
    got = sorted((r.doc_id, r.component_id) for r in jaccard.similar_components(df).where("doc_id is not null").collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (4, 4), (9, 9), (9, 9), (9, 9), (9, 9)]
    kept = collections.Counter((r.doc_id, r.text) for r in jaccard.one_of_each(df).collect())
    last = [k for k in kept if k[0] == 4]
    assert len(last) == 1 and last[0][1] in (three, near(three))
    assert kept == collections.Counter([(1, one), (1, two), last[0], (None, one), (9, ""), (9, None)])


def links_by_trying(sets, part):
    return [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]


@pytest.mark.parametrize("seed", range(20))
def test_links_among_sets_join_what_all_links_join(seed):
    rng = np.random.default_rng(seed)
    base = rng.choice(10**6, int(rng.integers(5, 80)), replace=False)
    sets = [np.unique(np.append(base[rng.random(len(base)) > rng.choice([0, 0.05, 0.12, 0.2])], rng.choice(10**6, rng.integers(0, 8)))).astype(np.uint64)
            for _ in range(int(rng.integers(2, 40)))]
    part = rng.integers(0, len(sets), len(sets)) if seed % 2 else np.arange(len(sets))
    joined = lambda links: groups_of([*range(len(sets)), *(-1 - p for p in set(part.tolist()))],
                                     [*links, *((i, -1 - int(p)) for i, p in enumerate(part))])
    every, got = links_by_trying(sets, part), jaccard.links_among(sets, part)
    assert joined(every) == joined(got) and {tuple(sorted(x)) for x in got} <= {tuple(sorted(x)) for x in every} and len(got) < len(sets)


@pytest.mark.parametrize("seed", range(20))
def test_skipped_list_rows_have_no_partner(seed):
    rng = np.random.default_rng(seed)
    m = int(rng.integers(1, 60))
    token, n = np.sort(rng.integers(0, 9, m)), rng.integers(5, 60, m)
    order = np.lexsort((n, token))
    token, n = token[order], n[order]
    left = n - (rng.random(m) * (n + (-80 * n // 100) + 1)).astype(int)        # what a set holds from the shingle on
    want = [any(i != j and token[i] == token[j] and 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j])
                and min(left[i], left[j]) >= jaccard.least_overlap(n[i], n[j]) for j in range(m)) for i in range(m)]
    assert jaccard.partnered(token, n, 180 * left // 80 - n).tolist() == want


def plain_removal(docs, length=100):
    """Bytes of every document that a string covers which also starts earlier."""
    seen, out = set(), {}
    for doc_id, data in docs:
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            string = data[at:at + length]
            if string in seen:
                gone[at:at + length] = b"\1" * length
            seen.add(string)
        out[doc_id] = gone
    return out


def check_removal(df):
    docs = sorted((r.doc_id, (r.text or "").encode()) for r in df.where("doc_id is not null").dropDuplicates(["doc_id"]).collect())
    gone, text = plain_removal(docs), dict(docs)
    rows = repeats.without_repeats(df).collect()
    for r in (r for r in rows if r.doc_id is not None):
        assert r.n_bytes == len(text[r.doc_id])
        assert bytes(r.kept) == bytes(b for b, g in zip(text[r.doc_id], gone[r.doc_id]) if not g), r.doc_id
        assert len(r.spans) == sum(1 for i, g in enumerate(gone[r.doc_id]) if g and not (i and gone[r.doc_id][i - 1]))
    return rows


def test_removal_of_odd_documents(odd, empty):
    small = odd.where("n_chars is null or n_chars < 20000")
    assert len(check_removal(small)) == small.count()
    assert repeats.without_repeats(empty).count() == 0


def test_unlike_texts_without_an_id_or_under_one_id(spark):
    passage, other, third = invented(61, 60), invented(62, 200), invented(63, 200)
    texts = [(1, passage), (None, passage + " " + invented(64, 100)), (None, other), (2, third), (2, invented(65, 20) + passage)]
    got = repeats.without_repeats(spark.createDataFrame(rows_of([t for _, t in texts], [i for i, _ in texts]), SCHEMA)).collect()
    kept = {(r.doc_id, r.n_bytes): bytes(r.kept) for r in got}
    want = plain_removal(list(enumerate(t.encode() for i, t in sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)))))
    for at, (i, t) in enumerate(sorted(texts, key=lambda x: (x[0] is None, x[0] or 0))):
        data = t.encode()
        assert kept[i, len(data)] == bytes(b for b, g in zip(data, want[at]) if not g)
    assert len(got) == 5 and kept[None, len(other.encode())] == other.encode()


@pytest.mark.parametrize("together", [20_000, 3])
def test_removal_where_contexts_differ(spark, monkeypatch, together):
    """Passages of all lengths around the threshold, between unlike neighbours, by suffix arrays and string by string."""
    monkeypatch.setattr(repeats, "TOGETHER", together)
    rng = np.random.default_rng(6)
    passage = invented(3, 80)
    texts = []
    for i in range(60):
        a = int(rng.integers(0, len(passage) - 150))
        b = a + int(rng.integers(90, 150))
        texts.append(invented(400 + i, int(rng.integers(1, 12))) + passage[a:b] + invented(700 + i, int(rng.integers(1, 12))))
    texts += ["ab" * 150, "ab" * 120 + "c", "\x00" * 230, "é" * 99 + "x" * 60, "é" * 99 + "y" * 60]
    check_removal(spark.createDataFrame(rows_of(texts), SCHEMA).repartition(4))


def test_long_texts_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 700)
    rng = np.random.default_rng(8)
    part = invented(11, 200)
    texts = [invented(12, 300) + part + invented(13, 50), part * 2, invented(14, 100) + part[300:900], part[:400] + "z" + part[400:]]
    check_removal(spark.createDataFrame(rows_of(texts), SCHEMA))


def test_removed_text_stays_valid(odd):
    out = repeats.without_repeated_text(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.where("text is not null and length(text) <> n_chars").count() == 0


@pytest.fixture(scope="module")
def vector_table(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 16))
    tight = rng.normal(size=16) + 0.05 * rng.normal(size=(60, 16))
    loose = 3 * rng.normal(size=16) + 0.9 * rng.normal(size=(40, 16))
    rows = [*x.tolist(), *tight.tolist(), *loose.tolist(), x[0].tolist(), x[0].tolist(), (x[1] * 5).tolist()]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [math.nan] + [1.0] * 15, [math.inf] * 16, [1.0, 2.0], [1.0, 2.0]]
    ids = [*range(len(rows) + len(odd)), None]
    return spark.createDataFrame([(i, v, 1, "x") for i, v in zip(ids, [*rows, *odd, rows[5]])],
                                 "vec_id long, embedding array<double>, label int, id string").repartition(3)


def test_vector_links_against_all_pairs(spark, vector_table):
    rows = [(r.vec_id, r.embedding) for r in vector_table.where("vec_id is not null").collect()]
    usable = {i: np.array(v) / np.linalg.norm(v) for i, v in rows
              if v and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0}
    links = [(a, b) for a in usable for b in usable if a < b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.9]
    count = collections.Counter(x for l in links for x in l)
    group = groups_of(sorted(i for i, _ in rows), links)
    out, recall = vectors.near_duplicates(vector_table)
    got = {r.vec_id: r for r in out.collect()}
    assert len(got) == len(rows) + 1 and recall >= vectors.RECALL
    near = sum(got[i].component_id == group[i] and got[i].n_links == count[i] for i, _ in rows)
    assert near >= 0.97 * len(rows)
    assert all(got[i].n_links <= count[i] for i, _ in rows)                   # none below the threshold
    assert all(got[i].kept == (got[i].component_id == i) for i, _ in rows)
    assert vectors.near_duplicates(vector_table.limit(0))[0].count() == 0


def vectors_against_all_pairs(spark, x):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= vectors.COSINE
    np.fill_diagonal(linked, False)
    group = groups_of(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked)) if a < b])
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(table)[0].collect()}
    assert got == {i: (int(linked[i].sum()), group[i]) for i in range(len(x))}
    return unit


def test_dense_groups_whose_lists_are_full_still_link(spark):
    rng = np.random.default_rng(12)
    centres = np.zeros((3, 64))
    centres[:, 0] = 1
    centres[1, 1], centres[2, 2] = math.tan(math.radians(15)), 50
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    noise = rng.normal(size=(3, 40, 64))
    noise *= math.tan(math.radians(10)) / np.linalg.norm(noise, axis=2)[:, :, None]
    unit = vectors_against_all_pairs(spark, (centres[:, None] + noise).reshape(120, 64))
    across = unit[:40] @ unit[40:80].T
    inside = np.sort(unit[:40] @ unit[:40].T, axis=1)[:, -1 - vectors.NEIGHBOURS]
    assert (across >= vectors.COSINE).any() and across.max() < inside.min()      # no list holds a link to the other group


def test_block_comparison_where_the_audit_fails(spark, monkeypatch):
    monkeypatch.setattr(vectors, "RECALL", 1.1)
    monkeypatch.setattr(vectors, "ROUNDS", 1)
    monkeypatch.setattr(vectors, "BALLS", 40)
    rng = np.random.default_rng(13)
    vectors_against_all_pairs(spark, np.concatenate([rng.normal(size=8) + 0.25 * rng.normal(size=(20, 8)) for _ in range(8)]))


def test_unlike_vectors_of_one_id(spark):
    rng = np.random.default_rng(3)
    x, y, z = rng.normal(size=(3, 16))
    rows = [(1, x), (1, y), (2, x + 0.01), (3, y + 0.01), (7, z), (7, z), (None, x), (9, None)]
    table = spark.createDataFrame([(i, None if v is None else v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.near_duplicates(table)[0].where("vec_id is not null").collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (7, 1, 7, True), (7, 1, 7, True), (9, 0, 9, True)]


def test_core_vectors_always_link():
    rng = np.random.default_rng(10)
    centre = np.array([1.0] + [0.0] * 7)
    x = centre + rng.normal(size=(4000, 8)) * 0.15
    x /= np.linalg.norm(x, axis=1)[:, None]
    core = x[x @ centre >= vectors.CORE]
    assert len(core) > 100 and (core @ core.T).min() >= vectors.COSINE


def test_pipeline_against_its_definition(spark, tmp_path):
    """Every stage over the small tables, held against plain versions on the rows its predecessor kept."""
    sf = "/root/testdata/sf0.001"
    docs = common.documents(spark, sf)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "suffix_dedup", "secrets", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.written(stage(spark, before, sf))
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    before, after = kept["toxicity"]
    scores = {r.doc_id: r.score for r in toxicity.score(before, labels).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, s in scores.items() if s < 0.7}
    before, after = kept["ngram_jaccard"]
    want = {g for _, g in all_pairs([(r.doc_id, r.text) for r in before.collect()]).values()}
    assert {r.doc_id for r in after.collect()} == want
    before, after = kept["suffix_dedup"]
    plain = sorted((r.doc_id, (r.text or "").encode()) for r in before.collect())
    gone = plain_removal(plain)
    left = {r.doc_id: r.text for r in after.collect()}
    for doc_id, data in plain:
        chars = data.decode()
        at, out = 0, []
        for ch in chars:
            n = len(ch.encode())
            out.append("" if all(gone[doc_id][at:at + n]) else ch)
            at += n
        assert left[doc_id] == "".join(out)
    before, after = kept["secrets"]
    assert not any(plain_secrets(r.text or "") for r in after.collect()) and after.count() == before.count()
    before, after = kept["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
