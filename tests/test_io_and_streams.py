import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from queuecraft.operators import triage
from queuecraft.session import scratch_path
from queuecraft.sources import sinks, tables
from queuecraft.streaming import events as E


def test_csv_round_trip_and_documents(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, "c")], "i int, s string")
    out = scratch_path(spark, "csv")
    sinks.write_csv(df, out)
    assert sorted(map(tuple, tables.read_csv(spark, out, "i int, s string").collect())) == [(1, "a,b"), (2, "c")]
    sinks.write_json(df, out + "-json")
    assert tables.read_json(spark, out + "-json", "i int, s string").count() == 2
    folder = scratch_path(spark, "docs")
    spark.createDataFrame([("# One\n\ntext",)], "value string").coalesce(1).write.text(folder)
    docs = tables.read_documents(spark, folder, "*.txt").collect()
    assert len(docs) == 1 and docs[0]["text"].startswith("# One\n\ntext") and docs[0]["source"].endswith(".txt")


def test_report_is_one_nested_row(spark):
    cut = triage.rank_cut(spark.range(100).select("id", F.col("id").cast("double").alias("score"), (F.col("id") > 90).cast("int").alias("label")), "score", "id")
    out = scratch_path(spark, "report")
    sinks.write_json(sinks.triage_report(triage.bucket_summary(cut, "label"), triage.thresholds(cut, "score", "id"), triage.cost_benefit(cut, "label")), out)
    r = spark.read.json(out).first()
    assert r["buckets"]["SIU"]["n_rows"] == 5 and r["roi"]["caught"] == 9 and r["thresholds"]["top_threshold"] == 95.0


@pytest.fixture()
def folder(spark):
    return scratch_path(spark, "stream-in")


def _put(spark, folder, rows):
    spark.createDataFrame(rows, "id long, ts timestamp, v double").coalesce(1).write.mode("append").parquet(folder)


def test_repeats_within_the_watermark_count_once(spark, folder):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    _put(spark, folder, [(1, at(0), 1.0), (1, at(1), 1.0), (2, at(2), 2.0)])
    _put(spark, folder, [(2, at(3), 2.0), (3, at(4), 3.0)])
    stream = E.read_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema, "ts")
    assert sorted(r["id"] for r in E.run_to_end(E.once_only(stream, ["id"], "ts", "1 hour"), "dedup").collect()) == [1, 2, 3]


def test_only_closed_windows_are_written(spark, folder):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=10 * i), float(i)) for i in range(30)]
    _put(spark, folder, rows)
    stream = E.read_stream(spark, folder, "*.parquet", spark.read.parquet(folder).schema, "ts")
    stats = E.window_statistics(stream, "ts", "1 hour", "v", F.col("v") > 3, "30 minutes", percentiles=True)
    got = {r["window_start"].hour: r for r in E.run_to_end(stats, "windows").collect()}
    assert sorted(got) == [0, 1, 2, 3] and got[0]["n_rows"] == 6 and got[0]["mean_value"] == 2.5 and got[0]["quantiles"][1] in (2.0, 3.0)


def test_window_drift_on_a_grid(spark):
    ref = spark.range(1000).select((F.col("id") / 1000).alias("v"))
    edges, shares, n = E.grid_of(ref, "v", 20)
    rows = [(1, [int(200 * s) for s in shares], 200), (2, [0 for _ in shares], 200)]
    df = spark.createDataFrame(rows, "window_start int, below array<long>, n_rows long")
    got = {r["window_start"]: r["drift"] for r in E.window_drift(df, shares, n).collect()}
    assert got == {1: False, 2: True}


def test_contract(spark, sf):
    df = entry.entry(spark)
    assert df.columns == ["bucket", "n_rows", "positives", "positive_rate", "enrichment"] and df.count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 120


@pytest.mark.parametrize("name", ["provider_matrix", "triage_roi", "missing_summary", "fairness_groups", "score_linear", "verify_citations", "histogram"])
def test_queries_match_their_twins(spark, sf, name):
    import duckdb
    from tools.compare_with_sql import TABLES, sorted_rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = entry.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows([tuple(r) for r in df.collect()], df.columns) == sorted_rows(cur.fetchall(), names)
