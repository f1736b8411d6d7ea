"""Order, cuts and splits where scores, labels and keys are missing or are not doubles, against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from queuecraft.operators import metrics, ordering, resample, triage


def gone(s):
    return s is None or s != s


def ordered(rows):
    return sorted(rows, key=lambda r: (gone(r[1]), 0 if gone(r[1]) else -r[1], r[0]))


def make(n, share, seed=3):
    rnd = random.Random(seed)
    lost = lambda: None if rnd.random() < 0.5 else float("nan")
    return [(i, lost() if rnd.random() < share else round(rnd.random(), 3), None if i % 6 == 0 else i % 2) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, score double, label int")


@pytest.mark.parametrize("parts", [8, 40, 200])
@pytest.mark.parametrize("share", [0.01, 0.1, 0.5, 1.0])
def test_missing_scores_rank_last(spark, parts, share):
    rows = make(800, share)
    got = ordering.with_rank(frame(spark, rows), "score", "id", parts=parts).collect()
    assert {r.id: r.rank for r in got} == {r[0]: i + 1 for i, r in enumerate(ordered(rows))}


@pytest.mark.parametrize("share", [0.1, 0.5])
def test_missing_rows_fill_several_buckets(spark, share):
    df = ordering._keyed(frame(spark, make(4000, share)), "score", "id", True)
    plan = ordering.plan_buckets(df, ordering.KEY, ordering.TIE, 40)
    cut = ordering.assign_buckets(df, plan, ordering.KEY, ordering.TIE)
    assert max(r["count"] for r in cut.groupBy(ordering.BUCKET).count().collect()) < 4000 / 40 * 3


@pytest.mark.parametrize("share", [0.1, 0.5])
def test_cuts_with_missing_scores(spark, share):
    rows = make(500, share)
    df = frame(spark, rows)
    place = {r[0]: i for i, r in enumerate(ordered(rows))}
    for top, middle in ((0.05, 0.15), (0.5, 0.3)):
        got = {r.id: r.bucket for r in triage.rank_cut(df, "score", "id", top, middle).collect()}
        assert got == {i: triage.TOP if p < int(top * 500) else triage.MIDDLE if p < int((top + middle) * 500) else triage.REST
                       for i, p in place.items()}
    by = {r.id: r.bucket for r in triage.rank_cut_by(df, "score", "id", ["label"]).collect()}
    for label in (None, 0, 1):
        mine = ordered([r for r in rows if r[2] == label])
        n = len(mine)
        assert [by[r[0]] for r in mine] == [triage.TOP if i < int(0.05 * n) else triage.MIDDLE if i < int((0.05 + 0.15) * n)
                                            else triage.REST for i in range(n)]
    lost = {r[0] for r in rows if gone(r[1])}
    for cut in (triage.percentile_cut(df, "score"), triage.threshold_cut(df, "score", 0.9, 0.5)):
        assert all(r.bucket == triage.REST for r in cut.collect() if r.id in lost)
    assert [r.id for r in triage.top_rows(df, "score", "id", 20).collect()] == [r[0] for r in ordered(rows)[:20]]


def test_queue_rank_keeps_every_row(spark):
    rows = make(400, 0.25)
    got = {r.id: r.queue_rank for r in triage.queue_rank(frame(spark, rows), "score").collect()}
    values = [r[1] for r in ordered(rows)]
    same = lambda a, b: gone(a) and gone(b) or a == b
    for i, s, _ in rows:
        at = [k + 1 for k, v in enumerate(values) if same(v, s)]
        assert got[i] == int(sum(at) / len(at))


def test_splits_and_folds_keep_rows_without_a_label(spark):
    df = frame(spark, make(300, 0.1))
    assert resample.stratified_split(df, "id", "label").count() == 300
    assert resample.stratified_folds(df, "id", "label", 5, repeats=2).count() == 600


@pytest.mark.parametrize("column", ["text", "big", "amount", "day"])
def test_keys_that_are_not_doubles(spark, column):
    df = spark.range(400).select(
        "id", F.concat(F.lit("policy "), F.lpad((F.col("id") * 37 % 401).cast("string"), 4, "0")).alias("text"),
        (F.lit(2 ** 60) + F.col("id") * 37 % 401).alias("big"),
        (F.lit("12345678901234567890.01").cast("decimal(30,2)") + F.col("id") * 37 % 401).alias("amount"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 37 % 401).cast("int")).alias("day"))
    got = ordering.with_rank(df, column, "text", parts=16).collect()
    want = {r["id"]: i + 1 for i, r in enumerate(sorted(got, key=lambda r: r[column], reverse=True))}
    assert {r["id"]: r["rank"] for r in got} == want
    cut = triage.rank_cut(df, column, "text")
    assert {r.id for r in cut.where("bucket = 'SIU'").collect()} == {i for i, p in want.items() if p <= 20}


def test_batches_over_missing_keys(spark):
    rows = make(240, 0.5)
    got = {r.id: r.batch_id for r in triage.batches_in_order(frame(spark, rows), "score", "id", 6).collect()}
    up = sorted(rows, key=lambda r: (gone(r[1]), 0 if gone(r[1]) else r[1], r[0]))
    assert got == {r[0]: i // 40 + 1 for i, r in enumerate(up)}


def test_metrics_over_missing_scores_and_no_rows(spark):
    rows = [(i, s, int(i % 3 == 0)) for i, s, _ in make(200, 0.2)]
    filled = [(i, -1.0 if gone(s) else s, y) for i, s, y in rows]
    a, b = (metrics.areas(frame(spark, x), "score", "label").first() for x in (rows, filled))
    assert tuple(a) == pytest.approx(tuple(b))
    none = metrics.evaluate(frame(spark, []), "score", "id", "label").collect()
    assert len(none) == 1 and none[0].precision_top is None
