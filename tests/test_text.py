import numpy as np
import pytest
from pyspark.sql import functions as F

from queuecraft.operators import briefs, chunking, similarity, triage


def chunks(spark, text, **options):
    df = spark.createDataFrame([("d", text)], "source string, text string")
    return [r["text"] for r in chunking.chunk(df, "text", "source", **options).orderBy("chunk_id").collect()]


def packed(text, size=500):
    """The packing rule in plain Python."""
    out = []
    for i, section in enumerate(text.split("\n## ")):
        section = section if i == 0 else "## " + section
        if len(section) <= size:
            out.append(section.strip())
            continue
        held = ""
        for para in section.split("\n\n"):
            if len(held) + len(para) + 2 > size:
                out += [held.strip()] if held.strip() else []
                held = ""
            held += para + "\n\n"
        out += [held.strip()] if held.strip() else []
    return out


@pytest.mark.parametrize("text", [
    "# One\n\n" + "a" * 300 + "\n## Two\n" + "b" * 300,
    "\n\n".join(f"{i} " + "word " * 40 for i in range(10)),
    "x" * 1200 + "\n\nshort\n\n" + "y" * 499,
    "", "   ", "\n## \n## end", " ".join(["é ü"] * 400) + "\n\n" + "  tail  ",
    "\n\n\n\n" + "p" * 600 + "\n\n\n\n",
])
def test_chunks(spark, text):
    assert chunks(spark, text) == packed(text)


def test_chunk_ids_restart(spark):
    df = spark.createDataFrame([("a", "one\n## two"), ("b", "three")], "source string, text string")
    got = {(r["source"], r["chunk_id"]): r["text"] for r in chunking.chunk(df, "text", "source").collect()}
    assert got == {("a", 0): "one", ("a", 1): "## two", ("b", 0): "three"}


CITES = [
    ("see [Source 1] and [Source 2: a.md]", 3, [1, 2], [], True), ("[Source 4] is not there", 3, [], [4], False),
    ("[Source 0]", 3, [], [0], False), ("nothing cited", 3, [], [], True), ("[Source 2] again [Source 2]", 2, [2], [], True),
    ("[SOURCE 1] [source   9]", 1, [1], [9], False), ("", 3, [], [], True), (None, 0, [], [], True), ("[Source 12] [Source 1]", 1, [1], [12], False)]


def test_citations(spark):
    df = spark.createDataFrame([(i, t, n) for i, (t, n, _, _, _) in enumerate(CITES)], "i int, t string, n int")
    rows = df.select("i", "t", briefs.citation_check(F.col("t"), F.col("n")).alias("c"))
    rows = rows.select("*", briefs.annotate_invalid(F.col("t"), F.col("c.invalid")).alias("marked"), briefs.citation_caption(F.col("c")).alias("caption")).orderBy("i").collect()
    for r, (text, n, valid, invalid, ok) in zip(rows, CITES):
        assert ([int(x) for x in r["c"]["valid"]], [int(x) for x in r["c"]["invalid"]], r["c"]["ok"]) == (valid, invalid, ok), text
        assert len(r["c"]["cited"]) == len(valid) + len(invalid)
    assert rows[1]["marked"] == "[UNVERIFIED Source 4] is not there" and rows[0]["marked"] == CITES[0][0] and rows[7]["marked"] is None
    assert rows[8]["marked"] == "[UNVERIFIED Source 12] [Source 1]"
    assert rows[1]["caption"] == "⚠️ 1 unverified citation(s): [4] — not among the 3 retrieved"
    assert rows[0]["caption"] == "✅ 2/2 citations verified against 3 retrieved passages" and rows[3]["caption"].startswith("no citations")


def test_reason_cleaning(spark):
    got = spark.range(1).select(briefs.clean_reason(F.lit("[STRONG] High risk: no witness [NoWitness] (SHAP: +1.7181)")).alias("r")).first()["r"]
    assert got == "High risk: no witness [NoWitness]"


def test_query_text(spark):
    fields = {"BasePolicy": F.lit("Liability"), "Fault": F.lit(None).cast("string"), "Deductible": F.lit(400)}
    reasons = F.array(*[F.lit(f"r{i}") for i in range(7)])
    none = F.array().cast("array<string>")
    empty = {k: F.lit(None).cast("string") for k in fields}
    r = spark.range(1).select(briefs.retrieval_query(fields, reasons).alias("a"), briefs.retrieval_query(empty, none).alias("b"),
                              briefs.retrieval_query({}, reasons).alias("c")).first()
    assert r["a"] == "Auto insurance claim analysis. Base policy: Liability. Deductible: $400. Risk factors identified: - r0 - r1 - r2 - r3 - r4"
    assert r["b"] == "" and r["c"].startswith("Risk factors identified: - r0")


@pytest.mark.parametrize("bucket,words", [(triage.TOP, "SIU Escalation"), (triage.MIDDLE, "Manual Review"), (triage.REST, "Standard Approval")])
def test_brief(spark, bucket, words):
    reasons = F.array(F.lit("[STRONG] High risk: a"), F.lit("[MILD] Low risk: b"))
    passages = F.array(*[F.struct(F.lit(f"{i}.md").alias("source"), F.lit("t" * (200 + i)).alias("text")) for i in range(5)])
    text = spark.range(1).select(briefs.template_brief({"Fault": F.lit("Third Party")}, F.lit(0.31), F.lit(bucket), reasons, passages).alias("t")).first()["t"]
    assert f"**{words}**" in text and "**Risk Score:** 0.3100 (ELEVATED)" in text and "  - **Fault:** Third Party" in text
    assert "[Source 3: 2.md]" in text and "[Source 4" not in text
    assert f"[Source 1: 0.md] {'t' * 200}\n" in text and f"[Source 2: 1.md] {'t' * 200}..." in text


def test_nearest_is_exact_on_both_paths(spark):
    rng = np.random.default_rng(7)
    p, q = rng.normal(size=(300, 8)), rng.normal(size=(40, 8))
    p[50:60] = p[50]                                     # equal passages: ids decide
    q[0] = p[50]
    as_rows = lambda m, base: [(base + i, [float(x) for x in v]) for i, v in enumerate(m)]
    passages = spark.createDataFrame(as_rows(p, 1000), "passage_id long, vector array<double>").repartition(5)
    queries = spark.createDataFrame(as_rows(q, 0), "query_id long, vector array<double>")
    d = ((q[:, None, :] - p[None, :, :]) ** 2).sum(-1)
    want = {(i, r + 1): 1000 + j for i in range(40) for r, j in enumerate(sorted(range(300), key=lambda j: (round(d[i, j], 12), j))[:5])}
    for found in (similarity.knn(queries, passages), similarity.knn(queries, passages, 5)):
        assert {(r["query_id"], r["rank"]): r["passage_id"] for r in found.collect()} == want


def test_blocks_cut_both_sides(spark, monkeypatch):
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 7)
    monkeypatch.setattr(similarity, "PASSAGE_BLOCK", 11)
    rows = [(i, [float(i * i % 97), float(i % 13)]) for i in range(60)]
    q = spark.createDataFrame(rows, "query_id long, vector array<double>")
    p = spark.createDataFrame(rows, "passage_id long, vector array<double>")
    got = {(r["query_id"], r["rank"]): r["passage_id"] for r in similarity.knn(q, p, 3).collect()}
    for i, a in rows:
        best = sorted(rows, key=lambda r: ((r[1][0] - a[0]) ** 2 + (r[1][1] - a[1]) ** 2, r[0]))[:3]
        assert [got[(i, k)] for k in (1, 2, 3)] == [b[0] for b in best]


@pytest.mark.parametrize("block", [20, 100_000])
def test_cells_out_of_reach_are_not_visited_and_nothing_is_lost(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "PASSAGE_BLOCK", block)
    seen = spark.sparkContext.accumulator(0)
    plain = similarity.nearest_in_block
    def counted(query_ids, queries, ids, vectors, k):
        seen.add(len(query_ids) * len(ids))
        return plain(query_ids, queries, ids, vectors, k)
    monkeypatch.setattr(similarity, "nearest_in_block", counted)
    rng = np.random.default_rng(11)
    middles = rng.normal(size=(12, 6)) * 50
    p = np.concatenate([m + rng.normal(size=(40, 6)) for m in middles])
    q = np.concatenate([p[::16] + 0.1, rng.normal(size=(10, 6)) * 80])
    as_rows = lambda m: [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    passages = spark.createDataFrame(as_rows(p), "passage_id long, vector array<double>").repartition(4)
    queries = spark.createDataFrame(as_rows(q), "query_id long, vector array<double>")
    d = ((q[:, None, :] - p[None, :, :]) ** 2).sum(-1)
    want = {(i, r + 1): int(j) for i in range(len(q)) for r, j in enumerate(np.lexsort((np.arange(len(p)), d[i]))[:5])}
    assert {(r["query_id"], r["rank"]): r["passage_id"] for r in similarity.knn(queries, passages, 5).collect()} == want
    assert 0 < seen.value <= (0.5 if block == 20 else 1) * len(q) * len(p)
    assert similarity.knn(queries, passages.limit(3), 5).count() == 3 * len(q)
    assert similarity.knn(queries, passages.limit(0), 5).count() == 0 == similarity.knn(queries.limit(0), passages, 5).count()
