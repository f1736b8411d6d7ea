import itertools
import math
import os
import random
import threading
import time

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from queuecraft.functions import features
from queuecraft.operators import explain, learn, prep, resample, trees, triage
from queuecraft.plans import model_queries, views
from queuecraft.session import scratch_path, written
from queuecraft.sources import artifacts


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    out = []
    for i in range(400):
        x, c = rnd.gauss(0, 1), rnd.choice(["red", "green", None])
        out.append((i, None if i % 9 == 0 else x, float(i % 5), c, int(x + (c == "red") + rnd.gauss(0, 0.5) > 1)))
    return spark.createDataFrame(out, "id long, x double, y double, c string, label int").repartition(3, "id").sortWithinPartitions("id")


def test_split_is_exact_disjoint_and_stable(spark, rows):
    got = {r["id"]: (r["split"], r["label"]) for r in resample.stratified_split(rows, "id", "label").collect()}
    again = {r["id"]: (r["split"], r["label"]) for r in resample.stratified_split(rows.repartition(7), "id", "label").collect()}
    assert got == again and len(got) == 400
    for label in (0, 1):
        n = sum(v[1] == label for v in got.values())
        assert abs(sum(v == ("train", label) for v in got.values()) - 0.8 * n) <= 1


def test_folds_are_balanced(rows):
    got = resample.stratified_folds(rows, "id", "label", 5, repeats=2).groupBy("repeat", "label", "fold").count().collect()
    for repeat, label in itertools.product((0, 1), (0, 1)):
        sizes = [r["count"] for r in got if (r["repeat"], r["label"]) == (repeat, label)]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_permutation_keeps_the_values(rows):
    got = resample.permute_column(rows, "id", "y", repeats=2).collect()
    for repeat in (1, 2):
        values = {r["id"]: r["y_permuted"] for r in got if r["repeat"] == repeat}
        assert sorted(values.values()) == sorted(float(i % 5) for i in range(400)) and any(values[i] != float(i % 5) for i in values)


def test_bootstrap_brackets_the_point(rows):
    scored = rows.select("id", F.coalesce("x", F.lit(0.0)).alias("score"), "label")
    r = resample.bootstrap_interval(scored, "id", "score", "label", 60).first()
    assert r["low"] < r["point"] < r["high"] and r["replicates"] == 60


def test_preprocessors_of_all_folds_in_one_pass(rows):
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int")).withColumn("c", F.when(F.col("id") == 1, "rare").otherwise(F.col("c")))
    for i, got in enumerate(prep.fit_folds(folded, "fold", 3, ["x", "y"], ["c"])):
        want = prep.Preprocessor.fit(folded.filter(F.col("fold") != i), ["x", "y"], ["c"])
        assert got.medians == pytest.approx(want.medians) and got.levels == want.levels
        for c in ("x", "y"):
            assert got.moments[c] == pytest.approx(want.moments[c])


def test_every_row_is_scored_by_a_model_that_did_not_see_it(rows):
    folded = resample.stratified_folds(rows, "id", "label", 3)
    scored = learn.folds_scored(folded, "id", "label", "fold", 3, {"logistic": learn.logistic}, ["x", "y"], ["c"])
    got = scored.collect()
    assert sorted(r["id"] for r in got) == list(range(400)) and all(0 <= r["score"] <= 1 for r in got)
    ready = prep.Preprocessor.fit(folded.filter("fold <> 1"), ["x", "y"], ["c"])
    vectors = ready.transform(folded, ["id", "fold", "label"], vector="features").withColumn("label", F.col("label").cast("double"))
    model = learn.logistic().fit(prep.add_class_weight(vectors.filter("fold <> 1"), "label"))
    want = {r["id"]: r["score"] for r in learn.score_with(model, vectors.filter("fold = 1"), ["id"]).collect()}
    assert {r["id"]: r["score"] for r in got if r["fold"] == 1} == pytest.approx(want, abs=1e-6)


def test_vectors_of_all_folds_are_made_together(rows):
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int")).withColumn("c", F.when(F.col("id") == 1, "rare").otherwise(F.col("c")))
    folded = folded.withColumn("y", F.when(F.col("id") % 5 == 2, float("nan")).otherwise(F.col("y")))
    ready = prep.fit_folds(folded, "fold", 3, ["x", "y"], ["c"])
    together = {r["id"]: r for r in prep.transform_folds(folded, ready, ["id"], "v").collect()}
    assert "c_rare" not in ready[1].feature_names and "c_rare" in ready[0].feature_names
    for i, one in enumerate(ready):
        alone = {r["id"]: r["v"] for r in one.transform(folded, ["id"], vector="v").collect()}
        assert len(alone) == 400 and all(together[k][f"v_{i}"] == v for k, v in alone.items())
        some = one.transform(folded, ["id"], features=["y", *[n for n in one.feature_names if n[:2] == "c_"]], vector="v")
        assert all(r["v"].toArray().tolist() == alone[r["id"]].toArray()[one.places(["y"], ["c"])].tolist() for r in some.collect())


def test_arms_share_vectors_that_are_written_once(rows, monkeypatch):
    folded = written(resample.stratified_folds(rows, "id", "label", 2))
    make, arms = lambda: learn.logistic(regParam=0.01), {"numbers": (["y", "x"], []), "one": (["x"], ["c"]), "all": (["x", "y"], ["c"])}
    made = []
    monkeypatch.setattr(learn, "written", lambda df: made.append(df.columns) or written(df))
    vectors = learn.fold_vectors(folded, "id", "label", "fold", 2, *arms["all"], inner=2)
    scored = learn.folds_scored(folded, "id", "label", "fold", 2, {"l": make}, *arms["all"], arms=arms, vectors=vectors)
    pruned = learn.pruned_folds_scored(folded, "id", "label", "fold", 2, make, *arms["all"], floor=0.01, vectors=vectors)
    got = {(r["model"], r["id"]): r["score"] for r in scored.unionByName(pruned.drop("n_features")).collect()}
    assert len(made) == 1 and len(got) == 1600
    for name, columns in arms.items():
        alone = learn.folds_scored(folded, "id", "label", "fold", 2, {name: make}, *columns).collect()
        assert {r["id"]: r["score"] for r in alone} == pytest.approx({k: s for (m, k), s in got.items() if m == name}, abs=1e-6)
    assert len(made) == 4


def test_fits_of_a_large_table_wait_for_each_other(rows, monkeypatch):
    """A fit whose partitions fill the cluster runs alone: several would only hold more copies of the rows in memory."""
    folded, running, seen, lock = written(resample.stratified_folds(rows, "id", "label", 2)), [], [], threading.Lock()

    class Slow:
        def fit(self, train):
            with lock:
                running.append(1)
                seen.append(len(running))
            time.sleep(0.5)
            with lock:
                running.pop()

    monkeypatch.setattr(learn, "score_with", lambda model, df, keep: df.select(*keep, F.lit(0.5).alias("score")))
    for cells in (learn.PART_CELLS, 1):
        monkeypatch.setattr(learn, "PART_CELLS", cells)
        seen.clear()
        assert learn.folds_scored(folded, "id", "label", "fold", 2, {"a": Slow, "b": Slow}, ["x"], []).count() == 800
        assert len(seen) == 4 and (max(seen) == 1) == (cells == 1)


def test_preprocessor_learns_from_train_only(spark, rows):
    train, other = rows.filter("id < 200"), rows.filter("id >= 200")
    ready = prep.Preprocessor.fit(train, ["x", "y"], ["c"])
    xs = [r["x"] for r in train.collect() if r["x"] is not None]
    assert ready.medians["x"] == pytest.approx(float(np.median(xs))) and ready.levels == {"c": ["Unknown", "green", "red"]}
    made = ready.transform(other.withColumn("c", F.when(F.col("id") == 300, "blue").otherwise(F.col("c"))), ["id"])
    blue = made.filter("id = 300").first()
    assert (blue["c_red"], blue["c_green"], blue["c_Unknown"]) == (0, 0, 0) and made.columns == ["id", *ready.feature_names]
    filled = [r["x"] if r["x"] is not None else ready.medians["x"] for r in train.collect()]
    assert ready.moments["x"] == pytest.approx([float(np.mean(filled)), float(np.std(filled))])
    assert prep.Preprocessor.from_json(ready.to_json()) == ready
    assert made.filter(F.greatest(*[F.col(c).isNull().cast("int") for c in made.columns]) == 1).count() == 0


def test_constant_column_is_left_unscaled(rows):
    moments = prep.fit_moments(rows.withColumn("k", F.lit(3.0)), ["k"])
    assert moments["k"] == (3.0, 1.0)


@pytest.fixture(scope="module")
def boosted(spark, rows):
    ready = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows.na.fill(0.0)).withColumn("label", F.col("label").cast("double"))
    model = learn.boosted(weight=None, maxIter=4, maxDepth=3, subsamplingRate=1.0).fit(ready)
    path = scratch_path(spark, "test-ensemble")
    model.write().overwrite().save(path)
    return model, ready, path


def test_tree_contributions_add_up(boosted):
    model, ready, path = boosted
    phis = {r["id"]: r["base"] + sum(r["phis"]) for r in trees.tree_contributions(ready, path, "id").collect()}
    for r in model.transform(ready).select("id", vector_to_array("probability")[1].alias("p")).collect():
        assert 1 / (1 + math.exp(-phis[r["id"]])) == pytest.approx(r["p"], abs=1e-9)


def test_tree_contributions_are_shapley_values(boosted):
    """Against the definition: conditional expectations of every feature subset, walked down each tree."""
    model, ready, path = boosted
    nodes, weights = trees.saved_nodes(ready.sparkSession, path)
    by_tree = {t: {r.id: r for r in part.itertuples()} for t, part in nodes.groupby("treeID")}

    def expected(tree, node, x, known):
        if node.left < 0:
            return node.value
        left, right = tree[node.left], tree[node.right]
        if node.feature in known:
            return expected(tree, left if x[node.feature] <= node.cut[0] else right, x, known)
        return (expected(tree, left, x, known) * left.cover + expected(tree, right, x, known) * right.cover) / node.cover

    value = lambda x, known: 2 * sum(weights[t] * expected(tree, tree[0], x, known) for t, tree in by_tree.items())
    for r in trees.tree_contributions(ready, path, "id").filter("id < 12").collect():
        x = r["values"]
        want = [0.5 * (value(x, {f}) - value(x, set())) + 0.5 * (value(x, {0, 1}) - value(x, {1 - f})) for f in (0, 1)]
        assert r["phis"] == pytest.approx(want, abs=1e-9)


def test_contributions_against_a_background_are_shapley_values(boosted):
    """Against the definition: each feature subset from the row, the others from every background row in turn."""
    model, ready, path = boosted
    some = trees.background_of(ready.filter("id % 7 = 0"), "id", size=15)
    some = (some[0], np.arange(1.0, 16.0))
    nodes, weights = trees.saved_nodes(ready.sparkSession, path)
    by_tree = {t: {r.id: r for r in part.itertuples()} for t, part in nodes.groupby("treeID")}

    def reached(tree, x):
        node = tree[0]
        while node.left >= 0:
            node = tree[node.left if x[node.feature] <= node.cut[0] else node.right]
        return node.value

    margin = lambda x: 2 * sum(weights[t] * reached(tree, x) for t, tree in by_tree.items())
    mixed = lambda x, known: np.average([margin([x[f] if f in known else z[f] for f in (0, 1)]) for z in some[0]], weights=some[1])
    got = trees.tree_contributions(ready, path, "id", background=some)
    for r in got.filter("id < 12").collect():
        x = r["values"]
        want = [0.5 * (mixed(x, {f}) - mixed(x, set())) + 0.5 * (mixed(x, {0, 1}) - mixed(x, {1 - f})) for f in (0, 1)]
        assert r["phis"] == pytest.approx(want, abs=1e-9) and r["base"] == pytest.approx(mixed(x, set()))
    assert trees.additivity(got, model.transform(ready), "id").agg(F.max("gap")).first()[0] < 1e-9


def test_artifacts_round_trip_and_missing_parts(spark, rows):
    ready = prep.Preprocessor.fit(rows, ["x", "y"], ["c"])
    vectors = ready.transform(rows, ["id", "label"], features=["y", "x"], vector="features").withColumn("label", F.col("label").cast("double"))
    model = learn.logistic(weight=None, maxIter=5).fit(vectors)
    folder = scratch_path(spark, "test-artifacts")
    with pytest.raises(artifacts.MissingArtifact, match="parts"):
        artifacts.load(spark, folder)
    art = artifacts.Artifacts(model, ready, artifacts.Bundle(0.8, 0.4, selected_features=["y", "x"], metrics={"auc": 0.5}))
    artifacts.save(art, spark, folder)
    back = artifacts.load(spark, folder)
    assert back.preprocessor == ready and back.bundle == art.bundle and back.consumed_features == ["y", "x"]
    a = {r["id"]: r["score"] for r in learn.score_with(model, vectors, ["id"]).collect()}
    b = {r["id"]: r["score"] for r in learn.score_with(back.model, back.preprocessor.transform(rows, ["id"], features=["y", "x"], vector="features"), ["id"]).collect()}
    assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-6


def test_calibrated_scores_are_monotone(rows):
    scored = rows.select("id", (1 / (1 + F.exp(-F.coalesce("x", F.lit(0.0))))).alias("score"), "label")
    for how in (learn.calibrate_isotonic, learn.calibrate_sigmoid):
        got = [r["calibrated"] for r in how(scored.filter("id < 250"), "score", "label")(scored.filter("id >= 250")).orderBy("score").collect()]
        assert all(a <= b + 1e-12 for a, b in zip(got, got[1:])) and 0 <= got[0] and got[-1] <= 1


def test_out_of_fold_covers_every_row_once(rows):
    folded = resample.stratified_folds(rows, "id", "label", 2)
    fit = learn.fitter({"l": lambda: learn.logistic(maxIter=5)}, ["x", "y"], ["c"], "id", "label", keep=["fold"])
    got = learn.out_of_fold(folded, "id", "label", "fold", 2, fit).collect()
    assert sorted(r["id"] for r in got) == list(range(400))


def test_drivers_keep_the_strongest(spark):
    df = spark.createDataFrame([(1, 0.1, -3.0, 2.0)], "id long, a double, b double, c double")
    df = explain.linear_contributions(df, {"a": 1.0, "b": 1.0, "c": 1.0}, {"a": 0.0, "b": 0.0, "c": 0.0})
    got = df.select(explain.top_drivers(F.col("contributions"), 2).alias("d")).first()["d"]
    assert [d["feature"] for d in got] == ["b", "c"]
    assert explain.used_features(explain.global_importance(df)) == ["b", "c", "a"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_permuted_rows_do_not_go_through_the_driver(rows):
    filled = written(rows.fillna({"x": 0.0}).drop("c"))       # files this small invite a broadcast
    got = learn.permutation_importance(filled, "id", "label", ["x", "y"], lambda df: df.withColumn("score", F.col("x") + F.col("y")), repeats=2)
    assert "BroadcastExchange" not in plan_of(got)
    drops = {r["feature"]: r["mean_drop"] for r in got.collect()}
    assert drops["x"] > 0.1


def test_additivity_does_not_send_rows_through_the_driver(spark):
    contributions = spark.createDataFrame([(i, 0.5, [1.0, 2.0], [0.25, float(i)]) for i in range(20)], "id long, base double, values array<double>, phis array<double>")
    margins = spark.createDataFrame([(i, 0.5 * (0.75 + i)) for i in range(20)], "id long, m double")
    scored = VectorAssembler(inputCols=["m", "m"], outputCol="rawPrediction").transform(margins)
    got = trees.additivity(written(contributions), written(scored), "id")
    assert "BroadcastExchange" not in plan_of(got)
    assert got.count() == 20 and got.filter(F.col("gap") > 1e-12).count() == 0


def test_claims_are_dealt_before_they_are_widened(spark, sf):
    wide = features.engineer(features.impute_age(views.claims(spark, sf)))
    want = resample.stratified_split(wide, model_queries.KEY, model_queries.LABEL)
    got = model_queries._claims(spark, sf)
    below = plan_of(got)
    assert "MonthClaimed" not in below[below.index("Window"):]
    got = got.select(want.columns)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_leaves_share_comparisons():
    """A condition that several leaves hold is compared once for a batch; patterns and sums stay the same."""
    rng = np.random.default_rng(2)
    rows, known = rng.normal(size=(50, 3)), {}
    tests = [[(0.1, True), (0.4, True)], [(0.0, False)]]
    first = trees.patterns_of(rows, [0, 2], tests, known)
    again = trees.patterns_of(rows, [0, 2], tests, known)
    want = ((rows[:, 0] <= 0.1) & (rows[:, 0] <= 0.4)) + 2 * (rows[:, 2] > 0)
    assert (first == want).all() and (again == want).all() and len(known) == 3
    table = rng.normal(size=(4, 2))
    phis = trees.contributions_of(rows, [([0, 2], tests, table)] * 2)
    assert (phis == np.stack([table[want, 0], np.zeros(50), table[want, 1]], axis=1) * 2).all()


def test_top_drivers_sort_without_a_comparing_expression(spark):
    cells = [("a", -1.0), ("b", 3.0), ("c", None), ("d", -3.0), ("e", float("nan")), ("f", 0.5)]
    df = spark.createDataFrame([(cells,), (None,)], "c array<struct<feature string, phi double>>")
    out = df.select(explain.top_drivers(F.col("c"), 4).alias("t"))
    assert "array_sort" not in out._jdf.queryExecution().analyzed().toString()
    got = [[d["feature"] for d in r["t"]] if r["t"] else None for r in out.collect()]
    old = F.transform(F.slice(F.array_sort(F.transform("c", lambda d, i: F.struct((-F.abs(d["phi"])).alias("o"), i.alias("at"), d.alias("d")))), 1, 4), lambda d: d["d"]["feature"])
    assert got == [r["o"] for r in df.select(old.alias("o")).collect()]


def test_medians_are_exact_whether_or_not_their_middle_values_are_equal(spark):
    """Columns whose middle values are equal are settled by counts; the others, and those the sketch misses, still are."""
    rnd = random.Random(8)
    cells = [(float(rnd.randint(0, 3)), rnd.random(), None if i % 3 else rnd.gauss(0, 1), None, float("nan") if i % 5 == 0 else float(i % 2), i)
             for i in range(1000)]
    df = spark.createDataFrame(cells, "a double, b double, c double, d double, e double, f long")
    got = prep.exact_medians(df, df.columns)
    for j, name in enumerate(df.columns):
        known = [float(r[j]) for r in cells if r[j] is not None and r[j] == r[j]]
        assert got.get(name) == (pytest.approx(float(np.median(known))) if known else None)


def test_moments_read_columns_in_small_groups(rows, monkeypatch):
    monkeypatch.setattr(prep, "CHUNK", 2)
    got = prep.fit_moments(rows.withColumn("z", F.col("id") * 0.5), ["x", "y", "z"])
    xs = [r["x"] for r in rows.collect() if r["x"] is not None]
    assert got["x"] == pytest.approx((float(np.mean(xs)), float(np.std(xs)))) and got["z"][0] == pytest.approx(99.75)
    assert prep.fit_moments(rows, []) == {}


def test_contributions_query_gives_contributions_and_gap(spark, sf):
    """All that the query names comes out: each claim's contributions, its five strongest and the additivity gap."""
    got = model_queries.tree_contributions(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/orders.parquet").count()
    for r in got[:200]:
        phis = [c["phi"] for c in r["contributions"]]
        log_odds = r["base"] + sum(phis)
        assert r["gap"] < 1e-9 and r["probability"] == pytest.approx(1 / (1 + math.exp(-log_odds)))
        order = sorted(range(len(phis)), key=lambda i: (-abs(phis[i]), i))[:5]
        assert r["drivers"] == ",".join(r["contributions"][i]["feature"] for i in order)


def test_additivity_sums_contributions_before_the_join(spark):
    contributions = spark.createDataFrame([(i, 0.5, [1.0], [float(i)]) for i in range(5)], "id long, base double, values array<double>, phis array<double>")
    scored = VectorAssembler(inputCols=["m", "m"], outputCol="rawPrediction").transform(spark.createDataFrame([(i, 0.5 * (0.5 + i)) for i in range(5)], "id long, m double"))
    got = trees.additivity(written(contributions), written(scored), "id").agg(F.max("gap"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "phis" not in plan[:plan.index("Join")] and got.first()[0] < 1e-12


def test_permuted_rows_are_measured_in_blocks(spark, rows, monkeypatch):
    """Few rows at once, whatever the number of repeats and features; the result is that of one block, and no files stay."""
    filled = written(rows.fillna({"x": 0.0}).drop("c"))
    measure = lambda: {r["feature"]: (r["mean_drop"], r["std_drop"]) for r in learn.permutation_importance(
        filled, "id", "label", ["x", "y"], lambda df: df.withColumn("score", F.col("x") + F.col("y")), repeats=3).collect()}
    whole, sizes, areas = measure(), [], learn.metrics.areas
    monkeypatch.setattr(learn, "BLOCK_ROWS", 400)
    monkeypatch.setattr(learn.metrics, "areas", lambda df, *a, **b: sizes.append(df.count()) or areas(df, *a, **b))
    gone, scrap = [], learn.scrapped
    monkeypatch.setattr(learn, "scrapped", lambda spark, df: (gone.extend(df.inputFiles()), scrap(spark, df)))
    got = measure()
    assert sizes == [400] * 6 and got.keys() == whole.keys()
    assert all(got[f] == pytest.approx(whole[f]) for f in whole)
    assert gone and not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in gone)
