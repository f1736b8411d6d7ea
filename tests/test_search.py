"""Search by halving, pruned columns, and explanations that feed the briefs."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from queuecraft.operators import briefs, explain, learn, metrics, prep, resample, retrieval, similarity
from queuecraft.plans import model_queries as M
from queuecraft.plans import text_queries as T
from queuecraft.plans import views as V
from queuecraft.session import scratch_path, staged
from queuecraft.sources import artifacts


@pytest.fixture(scope="module")
def folded(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(300):
        x, noise = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, x, noise, 3.0, rnd.choice(["a", "b"]), int(x + rnd.gauss(0, 0.7) > 0.8)))
    df = spark.createDataFrame(rows, "id long, x double, noise double, same double, c string, label int")
    return staged(resample.stratified_folds(df, "id", "label", 2))


def test_halving_keeps_the_best_and_grows_the_budget(spark, folded):
    ready = prep.Preprocessor.fit(folded, ["x", "noise"], [])
    vectors = staged(ready.transform(folded, ["id", "fold", "label"], vector="features").withColumn("label", F.col("label").cast("double")))
    estimator = learn.boosted(weight=None, subsamplingRate=1.0)
    trials = learn.random_trials(estimator, {"maxDepth": (1, 3), "stepSize": (0.05, 0.3)}, 4)
    table = learn.halve(vectors, estimator, trials, "fold", 2, (1, 3))
    rows = sorted(table.collect(), key=lambda r: (r.rung, r.trial))
    first, second = ([r for r in rows if r.rung == i] for i in (0, 1))
    assert [r.trial for r in first] == [0, 1, 2, 3] and len(second) == 2
    best_of_first = sorted(first, key=lambda r: (-r.mean, r.trial))[:2]
    assert {r.trial for r in first if r.went_on} == {r.trial for r in best_of_first} == {r.trial for r in second}
    assert [r.is_best for r in second].count(True) == 1 and not any(r.is_best for r in first)
    best = learn.best_params(table)
    assert best["maxIter"] == 3 and best == json.loads(json.dumps(best))
    # parameters that were written and read back fit the same model
    scores = [sorted((r.id, r.score) for r in learn.score_with(learn.with_params(estimator, p).fit(vectors), vectors, ["id"]).collect())
              for p in (best, json.loads(json.dumps(best)))]
    assert scores[0] == scores[1]
    assert learn.with_params(estimator, best).getMaxIter() == 3 and estimator.getMaxIter() == 20


def test_pruned_columns_are_chosen_inside_the_fold(spark, folded):
    scored = staged(learn.pruned_folds_scored(folded, "id", "label", "fold", 2, lambda: learn.logistic(regParam=0.01), ["x", "noise", "same"], ["c"], floor=0.15))
    rows = scored.collect()
    assert sorted(r.id for r in rows) == list(range(300)) and {r.model for r in rows} == {"pruned"}
    assert all(1 <= r.n_features < 5 for r in rows)             # the constant column moves nothing and goes
    assert metrics.average_precision(scored, "score", "label").first()[0] > 0.6
    # labels of the held-out rows change nothing in how their own fold is scored
    swapped = folded.withColumn("label", F.when(F.col("fold") == 0, 1 - F.col("label")).otherwise(F.col("label")))
    again = learn.pruned_folds_scored(swapped, "id", "label", "fold", 2, lambda: learn.logistic(regParam=0.01), ["x", "noise", "same"], ["c"], floor=0.15)
    own = lambda df: {r.id: (r.score, r.n_features) for r in df.filter("fold = 0").collect()}
    assert own(scored).keys() == own(again).keys()
    assert max(abs(own(scored)[i][0] - own(again)[i][0]) for i in own(scored)) < 1e-9


def test_importances_of_trees_and_weights(folded):
    ready = prep.Preprocessor.fit(folded, ["x", "noise", "same"], [])
    vectors = ready.transform(folded, ["id", "label"], vector="features").withColumn("label", F.col("label").cast("double"))
    for make in (lambda: learn.logistic(weight=None), lambda: learn.boosted(weight=None, maxIter=3)):
        x, noise, same = learn.importances(make().fit(vectors), vectors)
        assert x > noise and same == 0


def test_briefs_say_what_the_scorer_says(spark, sf):
    art = M.fitted_artifacts(spark, sf)
    folder = scratch_path(spark, "test-explained")
    artifacts.save(art, spark, folder)
    back = artifacts.load(spark, folder)
    assert back.bundle.feature_means == pytest.approx(art.bundle.feature_means)
    claims = V.claims(spark, sf)
    explained = artifacts.explain_claims(claims, back, M.KEY, T.SHOWN)
    rows = explained.collect()
    assert len(rows) == claims.count()
    scores = {r[M.KEY]: (r.score, r.bucket) for r in artifacts.score_claims(claims, art, M.KEY).collect()}
    assert all(scores[r[M.KEY]] == (pytest.approx(r.score, abs=1e-12), r.bucket) for r in rows)
    # contributions add up to the log-odds from the mean row's on
    import math
    margins = [math.log(r.score / (1 - r.score)) - sum(c.phi for c in r.contributions) for r in rows if 1e-9 < r.score < 1 - 1e-9]
    assert max(margins) - min(margins) < 1e-6
    ages = {r[M.KEY]: r.Age for r in claims.select(M.KEY, "Age").collect()}
    for r in rows[:50]:
        shown = {c.feature: c.value for c in r.contributions}
        assert ages[r[M.KEY]] == 0 or shown["Age"] == pytest.approx(ages[r[M.KEY]])

    few = explained.filter(F.col(M.KEY) % 97 == 1).withColumn("reasons", explain.reasons_array(F.col("contributions"), art.preprocessor.categorical, 3))
    few = staged(few.drop("contributions"))
    passages = spark.createDataFrame([(1, "a.md", "police reports must be filed"), (2, "b.md", "witness statements matter")], "passage_id long, source string, text string")
    from queuecraft.operators import embed
    made = retrieval.write_briefs(few, passages, embed.fit_tfidf(passages), T._fields(T.SHOWN), F.col("score"), F.col("bucket"), F.col("reasons")).collect()
    assert len(made) == few.count() > 3
    for r in made:
        assert f"**Risk Score:** {r.score:.4f}" in r.brief and len(r.reasons) == 3
        for reason in spark.createDataFrame([(x,) for x in r.reasons], "x string").select(briefs.clean_reason(F.col("x")).alias("x")).collect():
            assert reason.x in r.query_text


def test_wide_columns_are_encoded_without_their_levels_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(prep, "PARTS", 50)          # few levels are common
    n = 3000
    df = spark.range(n).select("id", F.concat(F.lit("policy-"), F.col("id").cast("string")).alias("wide"),
                               F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("narrow"))
    levels = prep.fit_wide_levels(df, ["wide", "narrow"], scratch_path(spark, "levels"))
    names = sorted(f"policy-{i}" for i in range(n))
    narrow = sorted({"hot", "Unknown", *(f"c{i}" for i in range(5))})
    assert levels.sizes == (n, len(narrow)) and levels.width == n + 7
    table = {(r.name, r.level): r.place for r in spark.read.parquet(levels.path).collect()}
    assert all(table["wide", x] == i for i, x in enumerate(names)) and all(table["narrow", x] == i for i, x in enumerate(narrow))
    more = df.union(spark.createDataFrame([(n, "never seen", "hot"), (n + 1, "policy-5", None)], "id long, wide string, narrow string"))
    got = {r.id: (r.features.size, sorted(r.features.indices.tolist())) for r in prep.encode_wide(more, "id", levels).collect()}
    want = {r.id: (levels.width, sorted(([table["wide", r.wide]] if ("wide", r.wide) in table else []) + [n + table["narrow", r.narrow or "Unknown"]]))
            for r in more.collect()}
    assert got == want
    # on columns of few levels both encoders say the same
    small = prep.fit_levels(df, ["narrow"])
    hot = {r.id: [r[c] for c in prep.one_hot_names(small)] for r in prep.one_hot(df, small).collect()}
    few = prep.encode_wide(df, "id", prep.fit_wide_levels(df, ["narrow"], scratch_path(spark, "levels")))
    assert all(r.features.toArray().astype(int).tolist() == hot[r.id] for r in few.collect())
    assert prep.encode_wide(df.limit(0), "id", levels).count() == 0


def test_scores_of_all_trials_are_measured_together(spark, folded, monkeypatch):
    ready = prep.Preprocessor.fit(folded, ["x", "noise"], [])
    vectors = staged(ready.transform(folded, ["id", "fold", "label"], vector="features").withColumn("label", F.col("label").cast("double")))
    estimator = learn.boosted(weight=None, subsamplingRate=1.0)
    calls, own = [], metrics.average_precision
    monkeypatch.setattr(metrics, "average_precision", lambda *a, **k: calls.append(1) or own(*a, **k))
    rows = learn.halve(vectors, estimator, [{"maxDepth": 1}, {"maxDepth": 3}], "fold", 2, (2,)).collect()
    assert len(calls) == 2              # one a fold, not one a fit
    for r, depth in zip(sorted(rows, key=lambda r: r.trial), (1, 3)):
        areas = []
        for i in range(2):
            model = learn.with_params(estimator, {"maxDepth": depth, "maxIter": 2}).fit(vectors.filter(F.col("fold") != i))
            areas.append(own(learn.score_with(model, vectors.filter(F.col("fold") == i), ["label"]), "score", "label").first()[0])
        assert abs(r.mean - sum(areas) / 2) < 1e-9 and abs(r["std"] - abs(areas[0] - areas[1]) / 2) < 1e-9


def test_queries_of_a_block_are_answered_together(monkeypatch):
    """The k nearest of 600 queries, ties by id, come from one frame per 256 queries, not from one per query."""
    rng, made = np.random.default_rng(3), []
    asked, held = rng.integers(0, 3, (600, 4)).astype(float), rng.integers(0, 3, (90, 4)).astype(float)
    ids, concat = rng.permutation(90), pd.concat
    monkeypatch.setattr(similarity.pd, "concat", lambda rows, **o: made.extend(rows) or concat(rows, **o))
    got = similarity.nearest_in_block(np.arange(600) + 7, asked, ids, held, 5)
    gaps = ((asked[:, None] - held[None]) ** 2).sum(2)
    want = [(i + 7, int(ids[j]), gaps[i, j]) for i in range(600) for j in sorted(range(90), key=lambda j: (gaps[i, j], ids[j]))[:5]]
    assert list(got.itertuples(index=False, name=None)) == want
    assert len(made) == 3


def test_a_single_cell_is_visited_once(spark, monkeypatch):
    rng, writes = np.random.default_rng(4), []
    vectors = rng.normal(size=(40, 3))
    frame = lambda name: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} long, vector array<double>")
    written = similarity.written
    monkeypatch.setattr(similarity, "written", lambda df: writes.append(1) or written(df))
    got = {(r["query_id"], r["rank"]): r["passage_id"] for r in similarity.knn(frame("query_id"), frame("passage_id"), 3).collect()}
    gaps = ((vectors[:, None] - vectors[None]) ** 2).sum(2)
    assert got == {(i, n + 1): int(j) for i in range(40) for n, j in enumerate(np.argsort(gaps[i], kind="stable")[:3])}
    assert len(writes) == 3         # the cells, the visits and what they found
