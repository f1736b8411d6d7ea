import random

import pytest
from helpers import average_precision, ks_distance, ordered, plan_of, quantile, roc_auc
from pyspark.sql import functions as F

from queuecraft.operators import drift, metrics, ordering, seasonality, triage


def make(n, kind, seed=1):
    rnd = random.Random(seed)
    score = {"distinct": lambda i: rnd.random(), "few": lambda i: float(rnd.randint(0, 5)),
             "hot": lambda i: 0.5 if i % 3 == 0 else rnd.random(), "same": lambda i: 0.25}[kind]
    return [(i, score(i), int(rnd.random() < 0.2)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, score double, label int")


@pytest.mark.parametrize("kind", ["distinct", "few", "hot", "same"])
@pytest.mark.parametrize("parts", [8, 40])
def test_rank_is_the_sorted_position(spark, kind, parts):
    rows = make(600, kind)
    got = ordering.with_rank(frame(spark, rows), "score", "id", parts=parts).select("id", "rank", "n_rows").collect()
    assert {r["id"]: r["rank"] for r in got} == {r[0]: i + 1 for i, r in enumerate(ordered(rows))}
    assert {r["n_rows"] for r in got} == {600}


def test_rank_does_not_depend_on_partitioning(spark):
    rows = make(500, "hot")
    want = {r[0]: i + 1 for i, r in enumerate(ordered(rows))}
    for n in (1, 17):
        random.Random(n).shuffle(rows)
        got = ordering.with_rank(frame(spark, rows).repartition(n), "score", "id").collect()
        assert {r["id"]: r["rank"] for r in got} == want


def test_rank_within_groups_and_missing_scores_last(spark):
    rows = [(i, None if i % 7 == 0 else (float("nan") if i % 11 == 0 else float(i % 13)), i % 3) for i in range(200)]
    got = ordering.with_rank(frame(spark, rows), "score", "id", by=["label"]).collect()
    bad = lambda s: s is None or s != s
    for g in range(3):
        mine = [r for r in rows if r[2] == g]
        want = sorted(mine, key=lambda r: (bad(r[1]), 0 if bad(r[1]) else -r[1], r[0]))
        assert {r["id"]: r["rank"] for r in got if r["label"] == g} == {r[0]: i + 1 for i, r in enumerate(want)}


def test_hot_value_is_cut_into_shares(spark):
    df = frame(spark, make(4000, "hot")).withColumn("k", -F.col("score"))
    plan = ordering.plan_buckets(df, "k", "id", 40)
    cut = ordering.assign_buckets(df, plan, "k", "id")
    sizes = [r["count"] for r in cut.groupBy(ordering.BUCKET).count().collect()]
    assert plan.hot == (-0.5,)
    assert max(sizes) < 4000 / 40 * 2.5          # a third of the rows share one score


def test_no_single_partition_over_the_rows(spark):
    df = frame(spark, make(300, "hot"))
    plan = plan_of(triage.rank_cut(df, "score", "id"))
    assert "Exchange" not in plan and "Window" not in plan       # assignment is row-local
    plan = plan_of(triage.percentile_cut(df, "score"))
    assert "Exchange" not in plan
    for name in ("BatchEvalPython", "ArrowEvalPython"):
        assert name not in plan_of(metrics.areas(df, "score", "label"))


@pytest.mark.parametrize("kind", ["distinct", "few", "hot", "same"])
def test_quantiles(spark, kind):
    rows = make(101, kind)
    levels = {f"q{i}": p for i, p in enumerate([0.0, 0.25, 0.5, 0.8, 0.95, 1.0])}
    got = ordering.quantiles(frame(spark, rows), "score", levels).first()
    for name, p in levels.items():
        assert got[name] == pytest.approx(quantile([r[1] for r in rows], p), abs=1e-12)


def test_quantiles_by_group_with_nulls(spark):
    rows = [(i, None if i % 5 == 0 else float(i * 37 % 101), i % 4) for i in range(300)]
    got = {r["label"]: r for r in ordering.quantiles(frame(spark, rows), "score", {"a": 0.25, "b": 0.9}, by=["label"]).collect()}
    for g in range(4):
        values = [r[1] for r in rows if r[2] == g and r[1] is not None]
        assert got[g]["n_rows"] == len(values)
        assert got[g]["a"] == pytest.approx(quantile(values, 0.25)) and got[g]["b"] == pytest.approx(quantile(values, 0.9))


@pytest.mark.parametrize("kind", ["distinct", "few", "hot", "same"])
def test_rank_cut_sizes_and_members(spark, kind):
    rows = make(333, kind)
    got = {r["id"]: r["bucket"] for r in triage.rank_cut(frame(spark, rows), "score", "id").collect()}
    for i, r in enumerate(ordered(rows)):
        want = triage.TOP if i < int(0.05 * 333) else triage.MIDDLE if i < int((0.05 + 0.15) * 333) else triage.REST
        assert got[r[0]] == want


def test_rank_cut_of_a_tiny_table_has_no_top_rows(spark):
    got = triage.rank_cut(frame(spark, make(6, "distinct")), "score", "id").groupBy("bucket").count().collect()
    assert {r["bucket"]: r["count"] for r in got} == {triage.MIDDLE: 1, triage.REST: 5}


def test_rank_cut_by_group(spark):
    rows = make(400, "few")
    df = frame(spark, rows).withColumn("g", F.col("id") % 3)
    got = {r["id"]: r["bucket"] for r in triage.rank_cut_by(df, "score", "id", ["g"]).collect()}
    for g in range(3):
        mine = ordered([r for r in rows if r[0] % 3 == g])
        n = len(mine)
        for i, r in enumerate(mine):
            want = triage.TOP if i < int(0.05 * n) else triage.MIDDLE if i < int((0.05 + 0.15) * n) else triage.REST
            assert got[r[0]] == want


def test_thresholds_and_threshold_cut(spark):
    rows = make(200, "distinct")
    cut = triage.thresholds(frame(spark, rows), "score", "id").first()
    best = ordered(rows)
    assert cut["top_threshold"] == best[9][1] and cut["mid_threshold"] == best[39][1]
    n = triage.threshold_cut(frame(spark, rows), "score", cut["top_threshold"], cut["mid_threshold"]).filter("bucket = 'SIU'").count()
    assert n == 10


def test_percentile_cut_takes_all_ties(spark):
    rows = [(i, 1.0 if i < 30 else 0.0, 0) for i in range(100)]
    got = triage.percentile_cut(frame(spark, rows), "score").groupBy("bucket").count().collect()
    assert {r["bucket"]: r["count"] for r in got} == {triage.TOP: 30, triage.REST: 70}


def test_summary_and_cost_identity(spark):
    rows = make(500, "distinct")
    cut = triage.rank_cut(frame(spark, rows), "score", "id")
    lines = {r["bucket"]: r for r in triage.bucket_summary(cut, "label").collect()}
    base = sum(r[2] for r in rows) / 500
    top = ordered(rows)[:25]
    assert lines[triage.TOP]["n_rows"] == 25 and lines[triage.TOP]["positives"] == sum(r[2] for r in top)
    assert lines[triage.TOP]["enrichment"] == pytest.approx(lines[triage.TOP]["positive_rate"] / base)
    roi = triage.cost_benefit(cut, "label").first()
    assert roi["net_benefit"] == roi["savings"] - roi["costs"] == roi["caught"] * 15000 - 25 * 500 - 75 * 100


def test_summary_without_positives(spark):
    rows = [(i, float(i), 0) for i in range(40)]
    lines = triage.bucket_summary(triage.rank_cut(frame(spark, rows), "score", "id"), "label").collect()
    assert {r["enrichment"] for r in lines} == {0.0} and sum(r["n_rows"] for r in lines) == 40


def test_queue_rank_shares_tied_positions(spark):
    rows = [(1, 5.0, 0), (2, 3.0, 0), (3, 3.0, 0), (4, 3.0, 0), (5, 3.0, 0), (6, 1.0, 0)]
    got = {r["id"]: r["queue_rank"] for r in triage.queue_rank(frame(spark, rows), "score").collect()}
    assert got == {1: 1, 2: 3, 3: 3, 4: 3, 5: 3, 6: 6}      # mean of 2..5 is 3.5, cut to 3


def test_batches_cover_all_rows_in_order(spark):
    rows = [(i, float((i * 7) % 50), 0) for i in range(200)]
    got = triage.batches_in_order(frame(spark, rows), "score", "id", 6).collect()
    placed = sorted(rows, key=lambda r: (r[1], r[0]))
    want = {r[0]: min(i // 33, 5) + 1 for i, r in enumerate(placed)}
    assert {r["id"]: r["batch_id"] for r in got} == want


def test_fewer_rows_than_batches(spark):
    got = triage.batches_in_order(frame(spark, make(4, "distinct")), "score", "id", 6).collect()
    assert {r["batch_id"] for r in got} == {6}


@pytest.mark.parametrize("kind", ["distinct", "few", "hot", "same"])
def test_areas(spark, kind):
    rows = make(300, kind, seed=3)
    got = metrics.areas(frame(spark, rows), "score", "label").first()
    assert got["average_precision"] == pytest.approx(average_precision(rows))
    assert got["roc_auc"] == pytest.approx(roc_auc(rows))


def test_perfect_and_inverted_ranking(spark):
    rows = [(i, float(i), int(i >= 15)) for i in range(20)]
    assert metrics.areas(frame(spark, rows), "score", "label").first()["average_precision"] == 1.0
    flipped = frame(spark, rows).withColumn("score", -F.col("score"))
    assert metrics.areas(flipped, "score", "label").first()["roc_auc"] == 0.0


def test_roc_agrees_with_the_ml_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = make(300, "few", seed=9)
    df = frame(spark, rows)
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0).evaluate(df.withColumn("y", F.col("label").cast("double")))
    assert metrics.roc_auc(df, "score", "label").first()["roc_auc"] == pytest.approx(theirs)


def test_sweep_and_at_k(spark):
    rows = make(250, "few")
    best = ordered(rows)
    for r in metrics.precision_recall_sweep(frame(spark, rows), "score", "id", "label").collect():
        k = max(1, int(r["pct"] / 100.0 * 250))
        hits = sum(x[2] for x in best[:k])
        assert (r["k"], r["precision"], r["recall"]) == (k, pytest.approx(hits / k), pytest.approx(hits / sum(x[2] for x in rows)))


def test_recall_without_positives_is_zero(spark):
    rows = [(i, float(i), 0) for i in range(30)]
    assert metrics.at_k(frame(spark, rows), "score", "id", "label", 0.1).first()["recall"] == 0.0


def test_every_k(spark):
    rows = make(120, "few")
    best, total = ordered(rows), sum(r[2] for r in rows)
    got = {r["id"]: r for r in metrics.every_k(frame(spark, rows), "score", "id", "label").collect()}
    hits = 0
    for i, r in enumerate(best):
        hits += r[2]
        assert got[r[0]]["k"] == i + 1 and got[r[0]]["precision"] == pytest.approx(hits / (i + 1))
        assert got[r[0]]["recall"] == pytest.approx(hits / total)


def test_calibration_edges(spark):
    rows = [(1, 0.0, 0), (2, 0.1, 1), (3, 0.100001, 0), (4, 1.0, 1)]
    got = {r["bin"]: r["n_rows"] for r in metrics.calibration_curve(frame(spark, rows), "score", "label").collect()}
    assert got == {1: 2, 2: 1, 10: 1}


def test_smoothing_window_is_centred(spark):
    points = spark.createDataFrame([(float(i), float(i)) for i in range(12)], "x double, v double")
    got = {r["point"]: r["v_smooth"] for r in metrics.smooth_curve(points, "x", ["v"], 4).collect()}
    assert got[0] == pytest.approx((0 + 1) / 2) and got[5] == pytest.approx((3 + 4 + 5 + 6) / 4) and got[11] == pytest.approx((9 + 10 + 11) / 3)


def test_ks_finds_a_shift_and_spares_the_rest(spark):
    rnd = random.Random(5)
    side = lambda b, n, shift: [(b, rnd.gauss(0, 1), rnd.gauss(shift, 1), rnd.gauss(0, 1)) for _ in range(n)]
    rows = side(0, 300, 0) + side(1, 200, 3) + side(2, 200, 0)
    df = spark.createDataFrame(rows, "batch_id int, a double, b double, c double")
    tests = drift.ks_tests(df, ["a", "b", "c"], "batch_id", 2)
    for r in tests.collect():
        at = "abc".index(r["feature"]) + 1
        want = ks_distance([x[at] for x in rows if x[0] == 0], [x[at] for x in rows if x[0] == r["batch_id"]])
        assert r["distance"] == pytest.approx(want)
    report = {r["batch_id"]: r for r in drift.drift_report(drift.adjust_p_values(tests, "batch_id", "feature"), "batch_id").collect()}
    assert report[1]["dataset_drift"] and "b" in report[1]["drifted_features"]
    assert not report[2]["dataset_drift"]
    for r in report.values():
        assert r["n_drifted"] <= r["n_drifted_unadjusted"] and r["n_tested"] == 3


def test_ks_needs_enough_values(spark):
    rows = [(0, float(i)) for i in range(50)] + [(1, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "batch_id int, a double")
    assert drift.ks_statistics(df, ["a"], "batch_id", 1).count() == 0


def test_benjamini_hochberg(spark):
    rows = [(1, n, p) for n, p in zip("abcd", [0.01, 0.04, 0.03, 0.5])]
    got = {r["f"]: r["p_adjusted"] for r in drift.adjust_p_values(spark.createDataFrame(rows, "b int, f string, p_value double"), "b", "f").collect()}
    assert got["a"] == pytest.approx(0.04) and got["b"] == pytest.approx(0.04 * 4 / 3) and got["c"] == pytest.approx(0.04 * 4 / 3) and got["d"] == 0.5


def test_month_index_orders_across_years(spark):
    rows = [(y, m, y * 12 + i) for y in (1994, 1995, 1996) for i, m in enumerate(["Jan", "Feb", "Dec"])]
    from queuecraft.functions import bands

    df = spark.createDataFrame(rows, "y int, m string, want int").withColumn("at", drift.month_index(F.col("y"), bands.month_number("m")))
    assert [r["want"] for r in df.orderBy("at").collect()] == sorted(r[2] for r in rows)


def test_monitor_excludes_and_falls_back_to_the_first_batch(spark):
    rnd = random.Random(2)
    rows = [(i, float(i), rnd.random(), rnd.gauss(0 if i < 200 else 4, 1), int(rnd.random() < 0.3)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, at double, score double, x double, label int")
    got = drift.monitor(df, None, ["at", "score", "x", "label"], "at", "id", "score", "label", n_batches=4).collect()
    by = {r["batch_id"]: r for r in got}
    assert sum(r["n_rows"] for r in got) == 400 and by[1]["tested_features"] == "score,x"
    assert not by[1]["dataset_drift"] and by[4]["dataset_drift"]


@pytest.mark.parametrize("n,positives,enough", [(136, 3, False), (135, 13, True)])
def test_few_positives_are_withheld(spark, n, positives, enough):
    rnd = random.Random(n)
    rows = [(i, rnd.random(), int(i < positives)) for i in range(n)]
    got = seasonality.group_quality(frame(spark, rows).withColumn("g", F.lit(1)), "g", "score", "id", "label").first()
    assert got["sufficient"] is enough and (got["average_precision"] is not None) is enough and got["positives"] == positives
    if enough:
        assert got["average_precision"] == pytest.approx(average_precision(rows)) and got["roc_auc"] == pytest.approx(roc_auc(rows))


def test_season_summary_ignores_withheld_groups(spark):
    rows = [(1, 0.1, 0.4), (2, 0.2, None), (3, 0.3, 0.6)]
    df = spark.createDataFrame(rows, "g int, positive_rate double, average_precision double")
    got = seasonality.summary(df, "g").first()
    assert (got["n_groups"], got["n_scored"], got["best_group"], got["worst_group"]) == (3, 2, 3, 1)


@pytest.mark.parametrize("start", ["claim-", "C", ""])
def test_text_keys_with_a_common_start_spread_over_all_buckets(spark, start):
    ids = spark.range(100_000).select(F.concat(F.lit(start), F.lpad(F.col("id").cast("string"), 9, "0")).alias("key"), F.lit(1.0).alias("score"))
    for keyed in (ordering.bucketed(ids, "key", "key"), ordering.bucketed(ids, "score", "key")):
        sizes = [r["count"] for r in keyed.groupBy(ordering.BUCKET).count().collect()]
        assert len(sizes) >= ordering.default_parts(ids) - 1 and max(sizes) <= 3 * 100_000 / len(sizes)
    ranked = {r["key"]: r["rank"] for r in ordering.with_rank(ids, "score", "key").filter("rank % 9973 = 0").collect()}
    assert ranked and all(int(key[len(start):]) == rank - 1 for key, rank in ranked.items())


def test_text_keys_of_no_or_one_value(spark):
    df = spark.createDataFrame([("same", 1), ("same", 2), (None, 3), ("same", 4)], "key string, id int")
    got = sorted(r["rank"] for r in ordering.with_rank(df, "key", "id").collect())
    assert got == [1, 2, 3, 4] and ordering.with_rank(df.limit(0), "key", "id").count() == 0
    assert ordering.common_starts(df, ["key", "id"]) == {"key": 4}
