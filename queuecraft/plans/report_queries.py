"""Provider matrix, fairness, drift and seasonality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuecraft.functions import bands
from queuecraft.operators import drift, fairness, prep, provider, seasonality, triage
from queuecraft.plans import views as V
from queuecraft.plans.registry import query, r, rounded
from queuecraft.session import written

# --- providers ----------------------------------------------------------------------------------

_WP = "WITH " + V.PROVIDERS


def _matrix(spark, sf, conditions=None):
    """Lines and orders are joined once; both sides and the link to patients read what was written."""
    lines = written(V.claim_lines(spark, sf))
    return provider.provider_matrix(V.provider_labels(spark, sf), V.inpatient_of(lines), V.outpatient_of(lines),
                                    V.patients(spark, sf), conditions or V.CONDITIONS)


_MATRIX_COLUMNS = ["claims_ip", "avg_amount_ip", "total_amount_ip", "max_amount_ip", "avg_deductible_ip", "patients_ip", "physicians_ip",
                   "claims_op", "avg_amount_op", "total_amount_op", "max_amount_op", "patients_op", "avg_condition_a", "avg_condition_b",
                   "states", "avg_annual_inpatient", "avg_annual_outpatient", "share_deceased", "total_claims", "total_amount",
                   "patients", "amount_per_claim", "inpatient_ratio"]
_WHOLE = {"claims_ip", "patients_ip", "physicians_ip", "claims_op", "patients_op", "states", "total_claims", "patients"}


@query("provider_matrix", _WP + " SELECT provider, label, " + ", ".join(
    c if c in _WHOLE else f"round({c}, 3) AS {c}" for c in _MATRIX_COLUMNS) + " FROM provider")
def provider_matrix(spark, sf):
    return rounded(_matrix(spark, sf).select("provider", "label", *_MATRIX_COLUMNS), 3)


@query("provider_comparison", _WP + """
SELECT provider, claims_ip AS inpatient_claims, round(total_amount_ip, 2) AS inpatient_amount, patients_ip AS inpatient_patients, claims_op AS outpatient_claims,
       round(total_amount_op, 2) AS outpatient_amount, patients_op AS outpatient_patients, round(avg_condition_a, 6) AS share_first_condition, states FROM provider""")
def provider_comparison(spark, sf):
    """The smaller matrix for comparing providers: the first condition only, fewer columns under other names."""
    made = _matrix(spark, sf, V.CONDITIONS[:1])
    names = {"claims_ip": "inpatient_claims", "total_amount_ip": "inpatient_amount", "patients_ip": "inpatient_patients", "claims_op": "outpatient_claims",
             "total_amount_op": "outpatient_amount", "patients_op": "outpatient_patients", "avg_condition_a": "share_first_condition"}
    out = made.select("provider", *[F.col(c).alias(n) for c, n in names.items()], "states")
    return rounded(out, 2, only={"share_first_condition": 6})


@query("provider_inpatient", _WP + """
SELECT provider, claims_ip, round(avg_amount_ip, 3) AS avg_amount_ip, round(total_amount_ip, 2) AS total_amount_ip, max_amount_ip,
       round(avg_deductible_ip, 6) AS avg_deductible_ip, patients_ip, physicians_ip FROM ip""")
def provider_inpatient(spark, sf):
    out = provider.claim_aggregate(V.inpatient(spark, sf), "ip", deductible="deductible", physician="physician")
    return rounded(out, 3, only={"total_amount_ip": 2, "avg_deductible_ip": 6})


@query("provider_outpatient", _WP + """
SELECT provider, claims_op, round(avg_amount_op, 3) AS avg_amount_op, round(total_amount_op, 2) AS total_amount_op, max_amount_op, patients_op FROM op""")
def provider_outpatient(spark, sf):
    return rounded(provider.claim_aggregate(V.outpatient(spark, sf), "op"), 3, only={"total_amount_op": 2})


@query("provider_bene", _WP + """
SELECT provider, round(avg_condition_a, 6) AS avg_condition_a, round(avg_condition_b, 6) AS avg_condition_b, states,
       round(avg_annual_inpatient, 3) AS avg_annual_inpatient, round(avg_annual_outpatient, 3) AS avg_annual_outpatient,
       round(share_deceased, 6) AS share_deceased FROM people""")
def provider_bene(spark, sf):
    out = provider.patient_aggregate(V.inpatient(spark, sf), V.patients(spark, sf), V.CONDITIONS)
    return rounded(out, 6, only={"avg_annual_inpatient": 3, "avg_annual_outpatient": 3})


@query("provider_triage", _WP + """, q AS (SELECT quantile_cont(amount_per_claim, 0.95) AS a, quantile_cont(amount_per_claim, 0.8) AS b FROM provider), c AS (
  SELECT label, CASE WHEN amount_per_claim >= a THEN 'SIU' WHEN amount_per_claim >= b THEN 'Manual Review' ELSE 'Approve' END AS bucket FROM provider, q)
SELECT bucket, count(*) AS n_rows, sum(label) AS positives, round(avg(label), 6) AS positive_rate,
       round(CASE WHEN (SELECT avg(label) FROM c) > 0 THEN avg(label) / (SELECT avg(label) FROM c) ELSE 0 END, 6) AS enrichment FROM c GROUP BY bucket""")
def provider_triage(spark, sf):
    cut = triage.percentile_cut(_matrix(spark, sf), "amount_per_claim")
    return rounded(triage.bucket_summary(cut, "label"))


@query("class_weight", "WITH " + V.SCORED + """
SELECT sum((label = 0)::INT)::BIGINT AS negatives, sum(label)::BIGINT AS positives, round(sum((label = 0)::INT) / sum(label), 6) AS positive_weight FROM scored""")
def class_weight(spark, sf):
    return rounded(prep.class_weight(V.scored(spark, sf), "label"))


# --- fairness -------------------------------------------------------------------------------------

def _flagged(spark, sf):
    """Percentile-cut queues of the orders beside the attributes of their customers."""
    cut = triage.percentile_cut(V.scored(spark, sf), "score")
    c = V.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), (F.col("c_acctbal") / 100).alias("age"),
        F.when(F.col("c_nationkey") > 2, F.col("c_nationkey").cast("string")).alias("nation"))
    flagged = F.col("bucket").isin(triage.TOP, triage.MIDDLE).cast("int")
    return cut.join(c, cut["cust"] == c["c_custkey"]).select("id", "score", "label", flagged.alias("flagged"), "segment", "age", "nation")


_FLAGGED = V.SCORED + """, q AS (SELECT quantile_cont(score, 0.8) AS q80 FROM scored), flagged AS (
  SELECT id, score, label, (score >= q80)::INT AS flagged, c_mktsegment AS segment,
         CASE WHEN c_acctbal / 100 > 0 AND c_acctbal / 100 <= 25 THEN '16-25' WHEN c_acctbal / 100 > 25 AND c_acctbal / 100 <= 35 THEN '26-35'
              WHEN c_acctbal / 100 > 35 AND c_acctbal / 100 <= 50 THEN '36-50' WHEN c_acctbal / 100 > 50 AND c_acctbal / 100 <= 65 THEN '51-65'
              WHEN c_acctbal / 100 > 65 AND c_acctbal / 100 <= 120 THEN '65+' ELSE 'Unknown (age not recorded)' END AS age_group,
         CASE WHEN c_nationkey > 2 THEN c_nationkey::VARCHAR END AS nation
  FROM scored JOIN customer ON cust = c_custkey, q)"""


def _group_sql(source: str, keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS n, sum(label)::BIGINT AS n_positive, sum(flagged)::BIGINT AS n_flagged,
  round_even(sum(label) / count(*), 4) AS positive_rate, round_even(sum(flagged) / count(*), 4) AS flag_rate,
  round_even(count(*) FILTER (WHERE flagged = 1 AND label = 0) / greatest(1, count(*) FILTER (WHERE label = 0)), 4) AS false_positive_rate,
  round_even(count(*) FILTER (WHERE flagged = 1 AND label = 1) / greatest(1, sum(flagged)), 4) AS precision,
  round_even(avg(score), 4) AS avg_score FROM {source} GROUP BY ALL"""


_IMPACT = """CASE WHEN flag_rate > 0 THEN round_even(min(flag_rate) FILTER (WHERE flag_rate > 0) OVER ({w}) / flag_rate, 4) END AS disparate_impact"""
_VERDICT = "CASE WHEN disparate_impact IS NULL THEN 'n/a (never flagged)' WHEN disparate_impact < 0.8 THEN 'Concern' ELSE 'OK' END AS verdict"


@query("fairness_groups", "WITH " + _FLAGGED + ", s AS (SELECT *, segment AS \"group\" FROM flagged) " + _group_sql("s", '"group"'))
def fairness_groups(spark, sf):
    rows = _flagged(spark, sf).withColumn("group", F.col("segment"))
    return fairness.group_metrics(rows, ["group"], "score", "label", "flagged")


_BY_NATION = "WITH " + _FLAGGED + ", s AS (SELECT *, nation AS \"group\" FROM flagged WHERE nation IS NOT NULL), g AS (" + _group_sql("s", '"group"') + ")"


@query("disparate_impact", _BY_NATION + f""", d AS (SELECT *, {_IMPACT.format(w='')} FROM g)
SELECT "group", n, flag_rate, disparate_impact, {_VERDICT} FROM d""")
def disparate_impact(spark, sf):
    rows = _flagged(spark, sf).withColumn("group", F.col("nation"))
    groups = fairness.group_metrics(rows, ["group"], "score", "label", "flagged")
    return fairness.disparate_impact(groups).select("group", "n", "flag_rate", "disparate_impact", "verdict")


MIN_N = 600      # splits the nations of the test data into kept and excluded ones


@query("disparate_impact_min_n", "WITH " + _FLAGGED + ", s AS (SELECT *, coalesce(nation, 'Unknown (age not recorded)') AS \"group\" FROM flagged), g AS ("
       + _group_sql("s", '"group"') + f"""), k AS (SELECT *, n >= {MIN_N} AND "group" <> 'Unknown (age not recorded)' AS included FROM g),
d AS (SELECT *, CASE WHEN included AND flag_rate > 0 THEN round_even(min(flag_rate) FILTER (WHERE included AND flag_rate > 0) OVER () / flag_rate, 4) END AS disparate_impact FROM k)
SELECT "group", n, included, disparate_impact, CASE WHEN NOT included THEN 'excluded' WHEN disparate_impact IS NULL THEN 'n/a (never flagged)'
       WHEN disparate_impact < 0.8 THEN 'Concern' ELSE 'OK' END AS verdict FROM d""")
def disparate_impact_min_n(spark, sf):
    rows = _flagged(spark, sf).withColumn("group", F.coalesce("nation", F.lit(bands.AGE_UNKNOWN)))
    groups = fairness.group_metrics(rows, ["group"], "score", "label", "flagged")
    return fairness.disparate_impact_of_large(groups, min_rows=MIN_N).select("group", "n", "included", "disparate_impact", "verdict")


@query("fairness_report", "WITH " + _FLAGGED + """, s AS (
  SELECT 'Segment' AS attribute, segment AS "group", score, label, flagged FROM flagged
  UNION ALL SELECT 'Age Group', age_group, score, label, flagged FROM flagged
  UNION ALL SELECT 'Nation', nation, score, label, flagged FROM flagged WHERE nation IS NOT NULL), g AS (""" + _group_sql("s", 'attribute, "group"') + f"""),
d AS (SELECT *, {_IMPACT.format(w='PARTITION BY attribute')} FROM g), v AS (SELECT *, {_VERDICT} FROM d)
SELECT *, max((verdict = 'Concern')::INT) OVER (PARTITION BY attribute) = 1 AS any_concern FROM v""")
def fairness_report(spark, sf):
    attributes = {"Segment": F.col("segment"), "Age Group": bands.age_group(F.col("age")), "Nation": F.col("nation")}
    return fairness.report(_flagged(spark, sf), attributes, "score", "label", "flagged")


# --- drift ----------------------------------------------------------------------------------------------

_WM = "WITH " + V.MONITORED


def _batched(spark, sf):
    _, current = V.halves(spark, sf)
    return drift.chronological_batches(current, "at_us", "id")


def _sides(spark, sf):
    reference, current = V.halves(spark, sf)
    batched = drift.chronological_batches(current, "at_us", "id")
    return batched.select("batch_id", *V.FEATURES).unionByName(reference.select(F.lit(0).alias("batch_id"), *V.FEATURES))


@query("chrono_batches", _WM + " SELECT id, batch_id FROM batched")
def chrono_batches(spark, sf):
    return _batched(spark, sf).select("id", "batch_id")


@query("chrono_batches_by_month", "WITH " + V.CLAIMS + """, m AS (
  SELECT PolicyNumber, Year * 100 + coalesce(""" + V._case_int("Month", bands.MONTHS) + """, 0) AS moment FROM claims)
SELECT PolicyNumber, least((row_number() OVER (ORDER BY moment, PolicyNumber) - 1) // (count(*) OVER () // 6), 5)::INT + 1 AS batch_id FROM m""")
def chrono_batches_by_month(spark, sf):
    c = V.claims(spark, sf).select("PolicyNumber", drift.month_index(F.col("Year"), bands.month_number("Month")).alias("at"))
    return drift.chronological_batches(c, "at", "PolicyNumber").select("PolicyNumber", "batch_id")


_BATCH_STATS = """, rk AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY score DESC, id) AS rank, count(*) OVER (PARTITION BY batch_id) AS n FROM batched), bk AS (
  SELECT *, CASE WHEN rank <= floor(0.05::DOUBLE * n) THEN 'SIU' WHEN rank <= floor((0.05::DOUBLE + 0.15::DOUBLE) * n) THEN 'Manual Review' ELSE 'Approve' END AS bucket FROM rk), bs AS (
  SELECT batch_id, count(*) AS n_rows, round(avg(label), 6) AS positive_rate, round(avg(score), 6) AS avg_score, round(stddev_pop(score), 6) AS std_score,
         count(*) FILTER (WHERE bucket = 'SIU') AS top_count, count(*) FILTER (WHERE bucket = 'Manual Review') AS middle_count,
         round(coalesce(avg(label) FILTER (WHERE bucket = 'SIU'), 0), 6) AS top_positive_rate, round(quantile_cont(score, 0.25), 6) AS p25,
         round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.75), 6) AS p75, round(quantile_cont(score, 0.95), 6) AS p95
  FROM bk GROUP BY batch_id)"""


@query("batch_statistics", _WM + _BATCH_STATS + " SELECT * FROM bs")
def batch_statistics(spark, sf):
    return rounded(drift.batch_statistics(_batched(spark, sf), "batch_id", "score", "id", "label"))


@query("ks_statistic", "WITH " + V.KS + " SELECT feature, n_reference, batch_id, n_batch, round(distance, 9) AS distance FROM tests")
def ks_statistic(spark, sf):
    return rounded(drift.ks_statistics(_sides(spark, sf), V.FEATURES, "batch_id"), 9)


@query("ks_pvalue", "WITH " + V.KS + " SELECT feature, batch_id, round(distance, 6) AS distance, round(p_value, 6) AS p_value FROM tests")
def ks_pvalue(spark, sf):
    return rounded(drift.ks_tests(_sides(spark, sf), V.FEATURES, "batch_id").select("feature", "batch_id", "distance", "p_value"))


@query("bh_adjust", "WITH " + V.KS + " SELECT feature, batch_id, round(p_value, 6) AS p_value, round(p_adjusted, 6) AS p_adjusted FROM adjusted")
def bh_adjust(spark, sf):
    tests = drift.ks_tests(_sides(spark, sf), V.FEATURES, "batch_id")
    return rounded(drift.adjust_p_values(tests, "batch_id", "feature").select("feature", "batch_id", "p_value", "p_adjusted"))


_DRIFT = V.KS + """, dr AS (
  SELECT batch_id, count(*) FILTER (WHERE p_adjusted < 0.05) > 0 AS dataset_drift,
         round(count(*) FILTER (WHERE p_adjusted < 0.05) / greatest(1, count(*)), 6) AS drift_share, count(*) FILTER (WHERE p_adjusted < 0.05) AS n_drifted,
         count(*) FILTER (WHERE p_value < 0.05) AS n_drifted_unadjusted, count(*) AS n_tested,
         coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE p_adjusted < 0.05), '') AS drifted_features,
         string_agg(feature, ',' ORDER BY feature) AS tested_features FROM adjusted GROUP BY batch_id)"""


def _drift_report(spark, sf):
    tests = drift.ks_tests(_sides(spark, sf), V.FEATURES, "batch_id")
    return drift.drift_report(drift.adjust_p_values(tests, "batch_id", "feature"), "batch_id")


@query("drift_report", "WITH " + _DRIFT + " SELECT * FROM dr")
def drift_report(spark, sf):
    return rounded(_drift_report(spark, sf))


@query("drift_summary", "WITH " + _DRIFT + """
SELECT max(dataset_drift) AS any_drift, sum(dataset_drift::INT)::BIGINT AS n_drifted_batches, count(*) AS n_batches, round(avg(drift_share), 6) AS mean_drift_share FROM dr""")
def drift_summary(spark, sf):
    return rounded(drift.drift_summary(_drift_report(spark, sf)))


@query("drift_monitor", "WITH " + _DRIFT + _BATCH_STATS + " SELECT * FROM bs JOIN dr USING (batch_id)")
def drift_monitor(spark, sf):
    reference, current = V.halves(spark, sf)
    return rounded(drift.monitor(current, reference, [*V.FEATURES, "user_id"], "at_us", "id", "score", "label", exclude=["user_id"]))


# --- seasonality ----------------------------------------------------------------------------------------------

def _season_sql(source: str, key: str) -> str:
    return f"""st AS (
  SELECT {key} AS k, n, p, sum(n) OVER w AS cum_n, sum(p) OVER w AS cum_p, sum(n) OVER (PARTITION BY {key}) AS tot_n, sum(p) OVER (PARTITION BY {key}) AS tot_p
  FROM (SELECT {key}, score, count(*) AS n, sum(label) AS p FROM {source} GROUP BY ALL)
  WINDOW w AS (PARTITION BY {key} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), ar AS (
  SELECT k, max(tot_n)::BIGINT AS n_rows, max(tot_p)::BIGINT AS positives, sum((p / nullif(tot_p, 0)) * (cum_p / cum_n)) AS ap,
         sum((n - p) * (cum_p - p + p / 2)) / nullif(max(tot_p) * (max(tot_n) - max(tot_p)), 0) AS auc FROM st GROUP BY k), q AS (
  SELECT {key} AS k, quantile_cont(score, 0.95) AS q95 FROM {source} GROUP BY ALL), rk AS (
  SELECT s.{key} AS k, score, label, q95, row_number() OVER (PARTITION BY s.{key} ORDER BY score DESC, id) AS rank, count(*) OVER (PARTITION BY s.{key}) AS n
  FROM {source} s JOIN q ON s.{key} = q.k), gs AS (
  SELECT k, avg(score) AS avg_score, avg(label) AS positive_rate, avg(label) FILTER (WHERE rank <= greatest(1, floor(0.05::DOUBLE * n))) AS prec,
         avg(label) FILTER (WHERE score >= q95) AS top_rate FROM rk GROUP BY k), season AS (
  SELECT k AS {key}, n_rows, positives, positives >= 5 AS sufficient, round(positive_rate, 6) AS positive_rate,
         CASE WHEN positives >= 5 THEN round(ap, 6) END AS average_precision, CASE WHEN positives >= 5 THEN round(auc, 6) END AS roc_auc,
         CASE WHEN positives >= 5 THEN round(prec, 6) END AS precision_top, round(avg_score, 4) AS avg_score, round(coalesce(top_rate, 0), 6) AS top_positive_rate,
         CASE WHEN positives >= 5 THEN ap END AS raw_ap, positive_rate AS raw_rate
  FROM ar JOIN gs USING (k) WHERE n_rows >= 10 AND positives > 0)"""


@query("seasonality", "WITH " + V.SCORED + ", " + _season_sql("scored", "month_num") + " SELECT * EXCLUDE (raw_ap, raw_rate) FROM season")
def season(spark, sf):
    return rounded(seasonality.group_quality(V.scored(spark, sf), "month_num", "score", "id", "label"), only={"avg_score": 4})


@query("seasonality_guarded", "WITH " + V.IMBALANCED + ", " + _season_sql("imbalanced", "source") + " SELECT * EXCLUDE (raw_ap, raw_rate) FROM season")
def season_guarded(spark, sf):
    """Groups with few positives: the ranking metrics are withheld, very small groups left out."""
    return rounded(seasonality.group_quality(V.imbalanced(spark, sf), "source", "score", "id", "label"), only={"avg_score": 4})


@query("seasonality_summary", "WITH " + V.SCORED + ", " + _season_sql("scored", "month_num") + """
SELECT count(*) AS n_groups, count(raw_ap) AS n_scored, round(avg(raw_ap), 6) AS mean_average_precision, round(stddev_samp(raw_ap), 6) AS std_average_precision,
       arg_max(month_num, raw_ap) AS best_group, round(max(raw_ap), 6) AS best_average_precision, arg_min(month_num, raw_ap) AS worst_group,
       round(min(raw_ap), 6) AS worst_average_precision, round(avg(raw_rate), 6) AS mean_positive_rate, round(stddev_samp(raw_rate), 6) AS std_positive_rate
FROM season""")
def season_summary(spark, sf):
    quality = seasonality.group_quality(V.scored(spark, sf), "month_num", "score", "id", "label")
    return rounded(seasonality.summary(quality, "month_num"))
