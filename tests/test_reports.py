import pytest
from pyspark.sql import functions as F

from queuecraft.functions import bands
from queuecraft.operators import fairness, profile, provider


def flagged(spark, groups):
    rows = [(g, int(i < hit), int(i % 4 == 0), 0.5 * int(i < hit)) for g, n, hit in groups for i in range(n)]
    return spark.createDataFrame(rows, "group string, flagged int, label int, score double")


def impact(spark, groups):
    df = fairness.group_metrics(flagged(spark, groups), ["group"], "score", "label", "flagged")
    return {r["group"]: r for r in fairness.disparate_impact(df).collect()}


def test_impact_ratio_and_verdict(spark):
    got = impact(spark, [("a", 100, 30), ("b", 100, 15), ("c", 50, 0)])
    assert got["b"]["disparate_impact"] == 1.0 and got["b"]["verdict"] == fairness.FINE
    assert got["a"]["disparate_impact"] == 0.5 and got["a"]["verdict"] == fairness.CONCERN
    assert got["c"]["disparate_impact"] is None and got["c"]["verdict"] == fairness.UNDEFINED


def test_nobody_flagged(spark):
    assert {r["verdict"] for r in impact(spark, [("a", 20, 0), ("b", 20, 0)]).values()} == {fairness.UNDEFINED}


def test_small_and_unknown_groups_are_set_aside(spark):
    df = fairness.group_metrics(flagged(spark, [("a", 100, 30), ("b", 100, 15), ("tiny", 10, 1), (bands.AGE_UNKNOWN, 90, 2), ("none", 40, 0)]),
                                ["group"], "score", "label", "flagged")
    rows = fairness.disparate_impact_of_large(df)
    got = {r["group"]: r for r in rows.collect()}
    assert got["b"]["disparate_impact"] == 1.0 and got["tiny"]["verdict"] == "excluded" == got[bands.AGE_UNKNOWN]["verdict"]
    names = fairness.never_flagged(rows).first()
    assert names["never_flagged"] == "none" and names["excluded"] == f"{bands.AGE_UNKNOWN}, tiny"


def test_provider_matrix_fills_missing_sides(spark):
    claims = "provider long, claim long, patient long, physician long, amount double, deductible double"
    ip = spark.createDataFrame([(1, 10, 100, 7, 50.0, 1.0), (1, 11, 101, 7, 70.0, None), (None, 12, 100, 7, 1.0, 1.0)], claims)
    op = spark.createDataFrame([(1, 20, 100, 7, 10.0, 0.0), (2, 21, None, 8, 30.0, 0.0)], claims)
    people = spark.createDataFrame([(100, 5, 1, 10.0, 20.0, "2009-01-01"), (101, 6, 0, 30.0, 40.0, None)],
                                   "patient long, state int, c int, annual_inpatient double, annual_outpatient double, died string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "provider long, label int")
    got = {r["provider"]: r for r in provider.provider_matrix(labels, ip, op, people, ["c"]).collect()}
    one = got[1]
    assert (one["claims_ip"], one["claims_op"], one["total_claims"], one["patients"]) == (2, 1, 3, 3)
    assert one["avg_deductible_ip"] == 1.0 and one["share_deceased"] == 0.5 and one["states"] == 2 and one["avg_c"] == 0.5
    assert one["amount_per_claim"] == pytest.approx(130 / 3) and one["inpatient_ratio"] == pytest.approx(2 / 3)
    assert (got[2]["claims_ip"], got[2]["patients_op"], got[2]["inpatient_ratio"]) == (0, 0, 0.0)
    assert (got[3]["total_claims"], got[3]["amount_per_claim"]) == (0, 0.0)


def test_missing_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, None, float("nan")), (1, "a", 1.0)], "i int, s string, x double")
    got = {r["column_name"]: (r["n_missing"], r["pct_missing"]) for r in profile.missing_summary(df).collect()}
    assert got == {"i": (0, 0.0), "s": (1, 25.0), "x": (1, 25.0)}
    assert profile.duplicate_rows(df).first()["duplicate_rows"] == 2
    assert profile.type_histogram(df) == {"int": 1, "string": 1, "double": 1}


def test_histogram_upper_edge_and_constant_column(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (10.0,)], "x double")
    assert {r["bin"]: r["n_rows"] for r in profile.histogram(df, "x", 10).collect()} == {1: 1, 2: 1, 6: 1, 10: 1}
    assert {r["bin"]: r["n_rows"] for r in profile.histogram(df.select(F.lit(3.0).alias("x")), "x", 10).collect()} == {1: 4}


def test_sketched_cardinality(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("few"))
    got = {r["column_name"]: r["id_like"] for r in profile.high_cardinality(df, ["id", "few"]).collect()}
    assert got == {"id": True, "few": False}


def test_duplicates_by_one_digest_of_all_texts(spark):
    rows = [(1, "a", "bc"), (1, "ab", "c"), (1, None, "-"), (1, "-", None), (1, "", None), (1, None, ""), (1, None, ""), (2, None, "")]
    got = profile.duplicate_rows(spark.createDataFrame(rows, "i int, s string, t string"))
    assert got.first()["duplicate_rows"] == 1
    assert got._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1
    assert profile.duplicate_rows(spark.createDataFrame([(1,), (1,)], "i int")).first()["duplicate_rows"] == 1
