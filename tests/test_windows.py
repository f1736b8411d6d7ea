"""Stream windows against stored rows and plain versions; the bootstrap against one resample at a time."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helpers import average_precision, ks_distance, quantile, roc_auc
from queuecraft.operators import drift, resample
from queuecraft.streaming import events as E
from queuecraft.streaming import windows as W

START = dt.datetime(2024, 1, 1)


def _rows(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        hour = i * 6 // n
        a = None if rng.random() < 0.05 else float("nan") if rng.random() < 0.05 else round(rng.gauss(hour % 3, 1), 1)
        yield (i, START + dt.timedelta(hours=hour, seconds=i % 3000), a, float(rng.choice([1, 1, 1, 2, 5])), 7.0, i % 4 == 0)


def _stream(spark, folder, rows):
    schema = "id long, ts timestamp, a double, b double, c double, bad boolean"
    for part in range(3):       # later files arrive later
        spark.createDataFrame(rows[part * len(rows) // 3:(part + 1) * len(rows) // 3], schema).coalesce(1).write.mode("append").parquet(folder)
    return E.read_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema, "ts"), spark.read.parquet(folder)


def _known(values):
    return [v for v in values if v is not None and v == v]


def test_windows_closed_on_a_stream_equal_plain_ones(spark, tmp_path):
    rows = list(_rows(900, 4))
    stream, stored = _stream(spark, str(tmp_path / "in"), rows)
    names = ["a", "b", "c"]
    edges = drift.order_edges(stored, names)
    reference = [r for r in rows if r[0] % 2]
    base = W.reference_counts(stored.filter("id % 2 = 1"), names, edges)
    counts = W.value_counts(stream, "ts", "1 hour", names, edges, F.col("bad"), "10 minutes")
    got = {(r.window_start.hour, r.feature): r for r in W.close_windows(counts, "drift", lambda c: W.window_tests(c, base)).collect()}
    closed = sorted({h for h, _ in got})
    assert closed == [0, 1, 2, 3, 4]                # the last hour is still open
    by_hour = lambda h: [r for r in rows if r[1].hour == h]
    p_values = {}
    for h in closed:
        for at, name in enumerate(names, 2):
            ref, own = _known(r[at] for r in reference), _known(r[at] for r in by_hour(h))
            r = got[h, name]
            assert (r.n_reference, r.n_window) == (len(ref), len(own)) and r.distance == pytest.approx(ks_distance(own, ref), abs=1e-12)
            p_values.setdefault(h, []).append(r.p_value)
        for r in (got[h, n] for n in names):
            later = [p * 3 / (i + 1) for i, p in enumerate(sorted(p_values[h])) if p >= r.p_value]
            assert r.p_adjusted == pytest.approx(min(1, *later)) and r.drift == (r.p_adjusted < 0.05)
    assert any(r.drift for r in got.values()) and not any(got[h, "c"].drift for h in closed)

    # the same rows stored: every window, the open one too
    stored_tests = W.window_tests(W.value_counts(stored, "ts", "1 hour", names, edges), base).collect()
    assert len(stored_tests) == 18
    for r in stored_tests:
        if r.window_start.hour in closed:
            assert r.distance == pytest.approx(got[r.window_start.hour, r.feature].distance, abs=1e-12)

    profiles = W.close_windows(counts, "profile", lambda c: W.profile(c, "a", {"high": 2.0, "mid": 0.5})).collect()
    assert len(profiles) == 5
    for r in profiles:
        own = by_hour(r.window_start.hour)
        x = _known(v[2] for v in own)
        mean = sum(x) / len(x)
        assert r.n_rows == len(own) and r.flag_rate == pytest.approx(sum(v[5] for v in own) / len(own))
        assert (r.mean_value, r.min_value, r.max_value) == (pytest.approx(mean), min(x), max(x))
        assert r.std_value == pytest.approx((sum((v - mean) ** 2 for v in x) / len(x)) ** 0.5)
        assert (r.high, r.mid) == (sum(v >= 2 for v in x), sum(0.5 <= v < 2 for v in x))
        assert [r.p25, r.p50, r.p75, r.p95] == pytest.approx([quantile(x, p) for p in W.QUANTILES.values()])


def test_windows_of_nothing(spark, tmp_path):
    stream, stored = _stream(spark, str(tmp_path / "in"), list(_rows(30, 1)))
    edges = drift.order_edges(stored.limit(0), ["a"])
    counts = W.value_counts(stored.withColumn("a", F.lit(None).cast("double")), "ts", "1 hour", ["a"], edges)
    base = W.reference_counts(stored, ["a"], edges)
    assert W.window_tests(counts, base).count() == 0
    assert all(r.mean_value is None and r.p50 is None and r.n_rows == 5 for r in W.profile(counts, "a").collect())
    assert W.profile(counts.limit(0), "a").count() == 0


def plain_weight(key, replicate):
    text = "|".join(str(x) for x in (key, replicate) if x is not None)
    u = int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2 ** 32
    return sum(u >= x for x in resample.POISSON_ONE)


@pytest.mark.parametrize("rows_at_once", [4096, 7])
def test_resamples_one_at_a_time(spark, monkeypatch, rows_at_once):
    monkeypatch.setattr(resample, "ROWS", rows_at_once)
    monkeypatch.setattr(resample, "AREA", 3)
    rng = random.Random(8)
    # a third of all rows share one score, few have a unique one
    rows = [(i, rng.choice([0.5, round(rng.random(), 1), rng.random()]), int(rng.random() < 0.3)) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, s double, y int").repartition(3)
    got = {r.replicate: r for r in resample.bootstrap_scores(df, "id", "s", "y", 8, 0.1).collect()}
    assert sorted(got) == list(range(1, 9))
    for b, r in got.items():
        drawn = [(i, s, y) for i, s, y in sorted(rows, key=lambda x: (-x[1], x[0])) for _ in range(plain_weight(i, b))]
        k = max(1, int(0.1 * len(drawn)))
        assert r.average_precision == pytest.approx(average_precision(drawn))
        assert r.roc_auc == pytest.approx(roc_auc(drawn))
        assert r.precision_at_k == pytest.approx(sum(y for *_, y in drawn[:k]) / k)


def test_resamples_of_odd_rows(spark):
    rows = [(None, 0.4, 1), (1, None, 1), (2, None, 0), (3, float("nan"), 1), (4, 0.4, None), (5, 0.2, 0)]
    df = spark.createDataFrame(rows, "id long, s double, y int")
    for r in resample.bootstrap_scores(df, "id", "s", "y", 5).collect():
        assert 0 <= r.average_precision <= 1 and (r.roc_auc is None or 0 <= r.roc_auc <= 1)
    assert resample.bootstrap_scores(df.limit(0), "id", "s", "y", 5).count() == 0
    assert resample.bootstrap_scores(df.withColumn("y", F.lit(0)), "id", "s", "y", 5).count() == 0
