"""Queues, ranks, ranking metrics, splits and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuecraft.operators import metrics, ordering, resample, triage
from queuecraft.plans import views as V
from queuecraft.plans.registry import query, r, rounded

_WITH_RANKED = "WITH " + V.RANKED
_WITH_TABLE = "WITH " + V.IMBALANCED + ", " + V.SCORE_TABLE


# --- queues ----------------------------------------------------------------------------------

@query("triage_rank_cut", _WITH_RANKED + " SELECT id, score, bucket FROM cut")
def triage_rank_cut(spark, sf):
    return triage.rank_cut(V.scored(spark, sf), "score", "id").select("id", "score", "bucket")


_PCT = V.SCORED + """, q AS (SELECT quantile_cont(score, 0.95) AS q95, quantile_cont(score, 0.8) AS q80 FROM scored), pcut AS (
  SELECT s.*, CASE WHEN score >= q95 THEN 'SIU' WHEN score >= q80 THEN 'Manual Review' ELSE 'Approve' END AS bucket FROM scored s, q)"""


@query("triage_percentile_cut", "WITH " + _PCT + " SELECT id, score, bucket FROM pcut")
def triage_percentile_cut(spark, sf):
    return triage.percentile_cut(V.scored(spark, sf), "score").select("id", "score", "bucket")


_THRESHOLDS = V.RANKED + """, th AS (
  SELECT max(score) FILTER (WHERE rank = greatest(1, floor(0.05::DOUBLE * n))) AS top_threshold,
         max(score) FILTER (WHERE rank = greatest(1, floor((0.05::DOUBLE + 0.15::DOUBLE) * n))) AS mid_threshold FROM ranked)"""


@query("triage_thresholds", "WITH " + _THRESHOLDS + " SELECT * FROM th")
def triage_thresholds(spark, sf):
    return triage.thresholds(V.scored(spark, sf), "score", "id")


@query("triage_threshold_cut", "WITH " + _THRESHOLDS + """
SELECT id, score, CASE WHEN score >= top_threshold THEN 'SIU' WHEN score >= mid_threshold THEN 'Manual Review' ELSE 'Approve' END AS bucket
FROM scored, th""")
def triage_threshold_cut(spark, sf):
    s = V.scored(spark, sf)
    cuts = triage.thresholds(s, "score", "id").first()
    return triage.threshold_cut(s, "score", cuts["top_threshold"], cuts["mid_threshold"]).select("id", "score", "bucket")


@query("rate_by_bucket", _WITH_RANKED + " SELECT bucket, round(avg(label), 6) AS positive_rate FROM cut GROUP BY bucket")
def rate_by_bucket(spark, sf):
    return rounded(triage.bucket_rates(triage.rank_cut(V.scored(spark, sf), "score", "id"), "label"))


@query("triage_summary", _WITH_RANKED + """
SELECT bucket, count(*) AS n_rows, sum(label) AS positives, round(avg(label), 6) AS positive_rate,
       round(avg(label) / (SELECT avg(label) FROM scored), 6) AS enrichment FROM cut GROUP BY bucket""")
def triage_summary(spark, sf):
    return rounded(triage.bucket_summary(triage.rank_cut(V.scored(spark, sf), "score", "id"), "label"))


@query("triage_roi", _WITH_RANKED + """, s AS (
  SELECT sum(label) FILTER (WHERE bucket <> 'Approve') AS caught,
         count(*) FILTER (WHERE bucket = 'SIU') * 500 + count(*) FILTER (WHERE bucket = 'Manual Review') * 100 AS costs FROM cut)
SELECT caught, caught * 15000 AS savings, costs, caught * 15000 - costs AS net_benefit,
       round(caught * 15000 / greatest(costs, 1), 6) AS benefit_cost_ratio FROM s""")
def triage_roi(spark, sf):
    return rounded(triage.cost_benefit(triage.rank_cut(V.scored(spark, sf), "score", "id"), "label"))


@query("queue_rank", "WITH " + V.SCORED + """
SELECT id, score, floor(rank() OVER (ORDER BY score DESC) + (count(*) OVER (PARTITION BY score) - 1) / 2)::BIGINT AS queue_rank FROM scored""")
def queue_rank(spark, sf):
    return triage.queue_rank(V.scored(spark, sf), "score").select("id", "score", "queue_rank")


@query("queue_rank_ties", "WITH " + V.IMBALANCED + """
SELECT id, score, floor(rank() OVER (ORDER BY score DESC) + (count(*) OVER (PARTITION BY score) - 1) / 2)::BIGINT AS queue_rank FROM imbalanced""")
def queue_rank_ties(spark, sf):
    return triage.queue_rank(V.imbalanced(spark, sf), "score").select("id", "score", "queue_rank")


@query("global_rank", _WITH_RANKED + " SELECT id, score, rank FROM ranked")
def global_rank(spark, sf):
    return ordering.with_rank(V.scored(spark, sf).select("id", "score"), "score", "id").select("id", "score", "rank")


@query("review_queue", "WITH " + V.SCORED + " SELECT id, score, label FROM scored ORDER BY score DESC, id")
def review_queue(spark, sf):
    return triage.review_queue(V.scored(spark, sf).select("id", "score", "label"), "score", "id")


@query("topk_scored", "WITH " + V.SCORED + " SELECT id, score, label FROM scored ORDER BY score DESC, id LIMIT 100")
def topk_scored(spark, sf):
    return triage.top_rows(V.scored(spark, sf).select("id", "score", "label"), "score", "id", 100)


@query("claim_at_rank", _WITH_RANKED + " SELECT id, score, label, rank FROM ranked WHERE rank = 77")
def claim_at_rank(spark, sf):
    return triage.row_at_rank(V.scored(spark, sf), "score", "id", 77).select("id", "score", "label", "rank")


@query("unpivot_attributes", _WITH_RANKED + """
SELECT id, u.field AS field, u.value AS value FROM ranked, unnest([
  {'field': 'label', 'value': label::VARCHAR}, {'field': 'month_num', 'value': month_num::VARCHAR}, {'field': 'year', 'value': year::VARCHAR},
  {'field': 'priority', 'value': priority}, {'field': 'late', 'value': CASE WHEN month_num > 6 THEN 'yes' ELSE '—' END}]) t(u)""")
def unpivot_attributes(spark, sf):
    s = V.scored(spark, sf).withColumn("late", F.when(F.col("month_num") > 6, "yes"))
    return triage.unpivot_attributes(s, "id", ["label", "month_num", "year", "priority", "late"])


@query("queue_with_attributes", _WITH_RANKED + """
SELECT id, bucket, c_name, c_mktsegment, round(c_acctbal, 2) AS c_acctbal FROM cut JOIN customer ON cust = c_custkey""")
def queue_with_attributes(spark, sf):
    cut = triage.rank_cut(V.scored(spark, sf).select("id", "score", "cust"), "score", "id")
    c = V.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", r(F.col("c_acctbal"), 2).alias("c_acctbal"))
    return cut.join(c, cut["cust"] == c["c_custkey"]).select("id", "bucket", "c_name", "c_mktsegment", "c_acctbal")


@query("order_batches", "WITH " + V.SCORED + """
SELECT id, least((row_number() OVER (ORDER BY id) - 1) // (count(*) OVER () // 12), 11)::INT + 1 AS batch_id FROM scored""")
def order_batches(spark, sf):
    return triage.batches_in_order(V.scored(spark, sf).select("id"), "id", "id", 12)


# --- metrics --------------------------------------------------------------------------------

@query("average_precision", _WITH_TABLE + """
SELECT round(sum((p / tot_p) * (cum_p / cum_n)), 9) AS average_precision FROM score_table""")
def average_precision(spark, sf):
    return rounded(metrics.average_precision(V.imbalanced(spark, sf), "score", "label"), 9)


@query("roc_auc", _WITH_TABLE + """
SELECT round(sum((n - p) * (cum_p - p + p / 2)) / (max(tot_p) * (max(tot_n) - max(tot_p))), 9) AS roc_auc FROM score_table""")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(V.imbalanced(spark, sf), "score", "label"), 9)


@query("areas_by_group", "WITH " + V.IMBALANCED + """, t AS (
  SELECT lang, score, n, p, sum(n) OVER w AS cum_n, sum(p) OVER w AS cum_p, sum(n) OVER (PARTITION BY lang) AS tot_n, sum(p) OVER (PARTITION BY lang) AS tot_p
  FROM (SELECT lang, score, count(*) AS n, sum(label) AS p FROM imbalanced GROUP BY ALL)
  WINDOW w AS (PARTITION BY lang ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT lang, max(tot_n) AS n_rows, max(tot_p) AS positives, round(sum((p / nullif(tot_p, 0)) * (cum_p / cum_n)), 9) AS average_precision,
       round(sum((n - p) * (cum_p - p + p / 2)) / nullif(max(tot_p) * (max(tot_n) - max(tot_p)), 0), 9) AS roc_auc FROM t GROUP BY lang""")
def areas_by_group(spark, sf):
    return rounded(metrics.areas(V.imbalanced(spark, sf), "score", "label", by=["lang"]), 9)


@query("precision_at_k", _WITH_RANKED + """
SELECT floor(0.05::DOUBLE * max(n))::BIGINT AS k, round(avg(label) FILTER (WHERE rank <= floor(0.05::DOUBLE * n)), 9) AS precision FROM ranked""")
def precision_at_k(spark, sf):
    return rounded(metrics.at_k(V.scored(spark, sf), "score", "id", "label", 0.05).select("k", "precision"), 9)


@query("recall_at_k", _WITH_RANKED + """
SELECT floor(0.2::DOUBLE * max(n))::BIGINT AS k,
       round(sum(label) FILTER (WHERE rank <= floor(0.2::DOUBLE * n)) / greatest(1, sum(label)), 9) AS recall FROM ranked""")
def recall_at_k(spark, sf):
    return rounded(metrics.at_k(V.scored(spark, sf), "score", "id", "label", 0.2).select("k", "recall"), 9)


@query("precision_recall_sweep", _WITH_RANKED + " " + " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS pct, greatest(1, floor({p} / 100.0::DOUBLE * max(n)))::BIGINT AS k, "
    f"round(avg(label) FILTER (WHERE rank <= greatest(1, floor({p} / 100.0::DOUBLE * n))), 9) AS precision, "
    f"round(sum(label) FILTER (WHERE rank <= greatest(1, floor({p} / 100.0::DOUBLE * n))) / greatest(1, sum(label)), 9) AS recall FROM ranked"
    for p in (1, 2, 5, 10, 20)))
def precision_recall_sweep(spark, sf):
    return rounded(metrics.precision_recall_sweep(V.scored(spark, sf), "score", "id", "label"), 9)


@query("pr_at_every_k", _WITH_RANKED + """
SELECT id, rank AS k, round(sum(label) OVER w / rank, 9) AS precision,
       round(sum(label) OVER w / greatest(1, sum(label) OVER ()), 9) AS recall
FROM ranked WINDOW w AS (ORDER BY rank ROWS UNBOUNDED PRECEDING)""")
def pr_at_every_k(spark, sf):
    return rounded(metrics.every_k(V.scored(spark, sf), "score", "id", "label"), 9)


@query("pr_curve", _WITH_TABLE + """
SELECT score AS threshold, round(cum_p / cum_n, 9) AS precision, round(cum_p / tot_p, 9) AS recall FROM score_table
UNION ALL SELECT NULL, 1.0, 0.0""")
def pr_curve(spark, sf):
    return rounded(metrics.pr_curve(V.imbalanced(spark, sf), "score", "label"), 9)


@query("smooth_pr_curve", _WITH_TABLE + """, curve AS (
  SELECT score, cum_p / cum_n AS precision, cum_p / tot_p AS recall FROM score_table UNION ALL SELECT NULL, 1.0, 0.0), placed AS (
  SELECT *, row_number() OVER (ORDER BY score NULLS LAST) - 1 AS point FROM curve)
SELECT point, round(avg(precision) OVER w, 6) AS precision_smooth, round(avg(recall) OVER w, 6) AS recall_smooth
FROM placed WINDOW w AS (ORDER BY point ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING)""")
def smooth_pr_curve(spark, sf):
    points = metrics.pr_curve(V.imbalanced(spark, sf), "score", "label")
    return rounded(metrics.smooth_curve(points, "threshold", ["precision", "recall"], 20))


@query("calibration_curve", "WITH " + V.SCORED + """, p AS (SELECT label, score / (SELECT max(score) FROM scored) AS s FROM scored)
SELECT greatest(1, least(10, ceil(s * 10)))::INT AS bin, count(*) AS n_rows, round(avg(s), 6) AS mean_score, round(avg(label), 6) AS positive_share
FROM p GROUP BY 1""")
def calibration_curve(spark, sf):
    s = V.scored(spark, sf)
    top = s.agg(F.max("score")).scalar()
    return rounded(metrics.calibration_curve(s.withColumn("score", F.col("score") / top), "score", "label"))


@query("evaluate_scores", "WITH " + V.IMBALANCED + ", " + V.SCORE_TABLE + """, rk AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank, count(*) OVER () AS n FROM imbalanced)
SELECT (SELECT round(sum((p / tot_p) * (cum_p / cum_n)), 9) FROM score_table) AS average_precision,
       (SELECT round(sum((n - p) * (cum_p - p + p / 2)) / (max(tot_p) * (max(tot_n) - max(tot_p))), 9) FROM score_table) AS roc_auc,
       round(avg(label) FILTER (WHERE rank <= greatest(1, floor(0.05::DOUBLE * n))), 9) AS precision_top,
       round(sum(label) FILTER (WHERE rank <= greatest(1, floor(0.05::DOUBLE * n))) / greatest(1, sum(label)), 9) AS recall_top,
       round(quantile_cont(score, 0.95), 6) AS operating_threshold FROM rk""")
def evaluate_scores(spark, sf):
    return rounded(metrics.evaluate(V.imbalanced(spark, sf), "score", "id", "label"), 9, only={"operating_threshold": 6})


_CONFUSION = "WITH " + _PCT + """, c AS (
  SELECT count(*) FILTER (WHERE bucket <> 'SIU' AND label = 0) AS tn, count(*) FILTER (WHERE bucket = 'SIU' AND label = 0) AS fp,
         count(*) FILTER (WHERE bucket <> 'SIU' AND label = 1) AS fn, count(*) FILTER (WHERE bucket = 'SIU' AND label = 1) AS tp FROM pcut)"""


@query("confusion_matrix", _CONFUSION + """
SELECT tn, fp, fn, tp, round(tp / greatest(1, tp + fp), 9) AS precision, round(tp / greatest(1, tp + fn), 9) AS recall FROM c""")
def confusion_matrix(spark, sf):
    cut = triage.percentile_cut(V.scored(spark, sf), "score")
    return rounded(metrics.confusion(cut, F.col("bucket") == triage.TOP, "label"), 9)


@query("confusion_at_rank", _WITH_RANKED + """, c AS (
  SELECT count(*) FILTER (WHERE bucket = 'Approve' AND label = 0) AS tn, count(*) FILTER (WHERE bucket <> 'Approve' AND label = 0) AS fp,
         count(*) FILTER (WHERE bucket = 'Approve' AND label = 1) AS fn, count(*) FILTER (WHERE bucket <> 'Approve' AND label = 1) AS tp FROM cut)
SELECT tn, fp, fn, tp, round(tp / greatest(1, tp + fp), 9) AS precision, round(tp / greatest(1, tp + fn), 9) AS recall FROM c""")
def confusion_at_rank(spark, sf):
    cut = triage.rank_cut(V.scored(spark, sf), "score", "id")
    return rounded(metrics.confusion(cut, F.col("bucket") != triage.REST, "label"), 9)


@query("classification_report", _CONFUSION + """, s AS (SELECT *, tn + fp AS n0, tp + fn AS n1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0,
  tp / (tp + fp) AS p1, tp / (tp + fn) AS r1 FROM c), f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1, n0 + n1 AS n FROM s)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, n0 AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), n1 FROM f
UNION ALL SELECT 'accuracy', round((tp + tn) / n, 6), round((tp + tn) / n, 6), round((tp + tn) / n, 6), n FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM f
UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / n, 6), round((r0 * n0 + r1 * n1) / n, 6), round((f0 * n0 + f1 * n1) / n, 6), n FROM f""")
def classification_report(spark, sf):
    cut = triage.percentile_cut(V.scored(spark, sf), "score")
    return rounded(metrics.classification_report(cut, F.col("bucket") == triage.TOP, "label"))


# --- models side by side: three score columns of the same rows, five folds -----------------------

def _model_rows(spark, sf):
    s = V.scored(spark, sf)
    cells = F.array(F.struct(F.lit("price").alias("model"), F.col("score").alias("s")),
                    F.struct(F.lit("customer").alias("model"), F.col("cust").cast("double").alias("s")),
                    F.struct(F.lit("month").alias("model"), (-F.col("month_num")).cast("double").alias("s")))
    return s.select("id", "label", (F.col("id") % 5).cast("int").alias("fold"), F.inline(cells)).withColumnRenamed("s", "score")


_MODELS = V.SCORED + """, model_rows AS (
  SELECT id, label, (id % 5)::INT AS fold, 'price' AS model, score AS s FROM scored
  UNION ALL SELECT id, label, (id % 5)::INT, 'customer', cust::DOUBLE FROM scored
  UNION ALL SELECT id, label, (id % 5)::INT, 'month', -month_num::DOUBLE FROM scored), mt AS (
  SELECT model, fold, n, p, sum(n) OVER w AS cum_n, sum(p) OVER w AS cum_p, sum(p) OVER (PARTITION BY model, fold) AS tot_p
  FROM (SELECT model, fold, s, count(*) AS n, sum(label) AS p FROM model_rows GROUP BY ALL)
  WINDOW w AS (PARTITION BY model, fold ORDER BY s DESC ROWS UNBOUNDED PRECEDING)), fold_ap AS (
  SELECT model, fold, sum((p / tot_p) * (cum_p / cum_n)) AS ap FROM mt GROUP BY ALL)"""


def _fold_ap(spark, sf):
    return metrics.average_precision(_model_rows(spark, sf), "score", "label", by=["model", "fold"])


@query("fold_summary", "WITH " + _MODELS + """
SELECT model, round(avg(ap), 6) AS mean, round(stddev_pop(ap), 6) AS std, round(min(ap), 6) AS min, round(max(ap), 6) AS max,
       string_agg(fold::VARCHAR || '=' || printf('%.4f', ap), ',' ORDER BY fold) AS folds FROM fold_ap GROUP BY model""")
def fold_summary(spark, sf):
    out = metrics.fold_summary(_fold_ap(spark, sf), "fold", "average_precision", ["model"])
    shown = F.array_join(F.transform("folds", lambda x, i: F.concat(i.cast("string"), F.lit("="), F.format_string("%.4f", x))), ",")
    return rounded(out.withColumn("folds", shown))


@query("paired_fold_diff", "WITH " + _MODELS + """
SELECT a.model, round(avg(a.ap - b.ap), 6) AS mean_difference, sum((a.ap > b.ap)::INT)::BIGINT AS folds_won
FROM fold_ap a JOIN fold_ap b ON a.fold = b.fold AND b.model = 'price' WHERE a.model <> 'price' GROUP BY a.model""")
def paired_fold_diff(spark, sf):
    return rounded(metrics.paired_fold_difference(_fold_ap(spark, sf), "fold", "model", "average_precision", "price"))


@query("model_comparison", "WITH " + _MODELS + """, m AS (SELECT model, avg(ap) AS average_precision FROM fold_ap GROUP BY model)
SELECT model, round(average_precision, 6) AS average_precision, average_precision = (SELECT max(average_precision) FROM m) AS is_best
FROM m ORDER BY 2 DESC, model""")
def model_comparison(spark, sf):
    rows = _fold_ap(spark, sf).groupBy("model").agg(F.avg("average_precision").alias("average_precision"))
    return rounded(metrics.model_comparison(rows))


@query("rank_normalise", "WITH " + _MODELS + """
SELECT id, model, round((rank() OVER (PARTITION BY model, fold ORDER BY s) + (count(*) OVER (PARTITION BY model, fold, s) - 1) / 2)
       / count(*) OVER (PARTITION BY model, fold), 9) AS norm FROM model_rows""")
def rank_normalise(spark, sf):
    rows = triage.mean_ranks(_model_rows(spark, sf), "score", ["model", "fold"], descending=False)
    return rounded(rows.select("id", "model", (F.col("mean_rank") / F.col("n_rows")).alias("norm")), 9)


_BLEND = "WITH " + _MODELS + """, normed AS (
  SELECT id, fold, label, (rank() OVER (PARTITION BY model, fold ORDER BY s) + (count(*) OVER (PARTITION BY model, fold, s) - 1) / 2)
       / count(*) OVER (PARTITION BY model, fold) AS norm FROM model_rows)"""


@query("rank_blend", _BLEND + " SELECT id, fold, round(avg(norm), 9) AS blend FROM normed GROUP BY id, fold")
def rank_blend(spark, sf):
    rows = triage.mean_ranks(_model_rows(spark, sf), "score", ["model", "fold"], descending=False)
    out = rows.groupBy("id", "fold").agg(F.avg(F.col("mean_rank") / F.col("n_rows")).alias("blend"))
    return rounded(out, 9)


@query("compare_versions", """WITH m AS (
  SELECT concat(c_mktsegment, CASE WHEN c_nationkey % 5 = 0 THEN ' x' ELSE '' END) AS metric, year(o_orderdate) < 1998 AS old, c_nationkey, o_totalprice AS v
  FROM orders JOIN customer ON o_custkey = c_custkey), g AS (
  SELECT metric, old, avg(v) AS value, avg(v) - 1.96 * stddev_samp(v) / sqrt(count(*)) AS low, avg(v) + 1.96 * stddev_samp(v) / sqrt(count(*)) AS high
  FROM m WHERE (old AND metric NOT LIKE 'A% x') OR (NOT old AND metric NOT LIKE 'B% x') GROUP BY metric, old)
SELECT metric, round(a.value, 4) AS old_value, round(a.low, 4) AS old_low, round(a.high, 4) AS old_high,
       round(b.value, 4) AS new_value, round(b.low, 4) AS new_low, round(b.high, 4) AS new_high,
       round(b.value - a.value, 4) AS delta, NOT (b.high < a.low OR b.low > a.high) AS overlap
FROM (SELECT * FROM g WHERE old) a FULL JOIN (SELECT * FROM g WHERE NOT old) b USING (metric)""")
def compare_versions(spark, sf):
    o = V.table(spark, sf, "orders").select("o_custkey", "o_totalprice", (F.year("o_orderdate") < 1998).alias("old"))
    c = V.table(spark, sf, "customer").select("c_custkey", F.concat(
        "c_mktsegment", F.when(F.col("c_nationkey") % 5 == 0, " x").otherwise("")).alias("metric"))
    rows = o.join(c, o["o_custkey"] == c["c_custkey"])
    half = 1.96 * F.stddev_samp("o_totalprice") / F.sqrt(F.count("*"))
    mean = F.avg("o_totalprice")
    side = lambda old, hide: rows.filter((F.col("old") == old) & ~F.col("metric").like(hide)).groupBy("metric").agg(
        mean.alias("value"), (mean - half).alias("low"), (mean + half).alias("high"))
    return rounded(metrics.compare_versions(side(True, "A% x"), side(False, "B% x")), 4)


# --- splits, folds, resampling, permutation ---------------------------------------------------------

def _u(*parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@query("stratified_split", "WITH " + V.SCORED + f""", d AS (
  SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {_u('id', '42')}, id) AS r, count(*) OVER (PARTITION BY label) AS n FROM scored), h AS (
  SELECT *, round(n * 0.2::DOUBLE) AS held, round(round(n * 0.2::DOUBLE) * 0.5) AS tested FROM d)
SELECT id, label, CASE WHEN r <= tested THEN 'test' WHEN r <= held THEN 'val' ELSE 'train' END AS split FROM h""")
def stratified_split(spark, sf):
    return resample.stratified_split(V.scored(spark, sf), "id", "label").select("id", "label", "split")


@query("hash_split", "WITH " + V.SCORED + f"""
SELECT id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM (SELECT id, {_u('id', '42')} AS u FROM scored)""")
def hash_split(spark, sf):
    return resample.hash_split(V.scored(spark, sf).select("id"), "id", 42, [("train", 0.8), ("val", 0.1), ("test", 0.1)])


@query("stratified_folds", "WITH " + V.SCORED + f"""
SELECT id, rep AS repeat, ((row_number() OVER (PARTITION BY label, rep ORDER BY {_u('id', '42', 'rep')}, id) - 1) % 5)::INT AS fold
FROM scored, range(2) t(rep)""")
def stratified_folds(spark, sf):
    return resample.stratified_folds(V.scored(spark, sf), "id", "label", 5, repeats=2).select("id", "repeat", "fold")


REPLICATES = 2000


@query("bootstrap_ci", "WITH " + V.IMBALANCED + f""", draws AS (
  SELECT rep, score, label, {_u('id', 'rep')} AS u FROM imbalanced, range(1, {REPLICATES + 1}) t(rep)), w AS (
  SELECT rep, score, sum(w) AS n, sum(w * label) AS p FROM (SELECT *, CASE """ + " ".join(
    f"WHEN u < {x!r}::DOUBLE THEN {i}" for i, x in enumerate(resample.POISSON_ONE)) + f""" ELSE {len(resample.POISSON_ONE)} END AS w FROM draws)
  WHERE w > 0 GROUP BY rep, score), c AS (
  SELECT rep, n, p, sum(n) OVER o AS cum_n, sum(p) OVER o AS cum_p, sum(p) OVER (PARTITION BY rep) AS tot_p
  FROM w WINDOW o AS (PARTITION BY rep ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), ap AS (
  SELECT rep, sum((p / tot_p) * (cum_p / cum_n)) AS ap FROM c WHERE tot_p > 0 GROUP BY rep), """ + V.SCORE_TABLE + """
SELECT (SELECT round(sum((p / tot_p) * (cum_p / cum_n)), 6) FROM score_table) AS point, count(*) AS replicates,
       round(quantile_cont(ap, 0.025), 6) AS low, round(quantile_cont(ap, 0.975), 6) AS high FROM ap""")
def bootstrap_ci(spark, sf):
    return rounded(resample.bootstrap_interval(V.imbalanced(spark, sf), "id", "score", "label", REPLICATES))


@query("bootstrap_intervals", "WITH " + V.IMBALANCED + f""", draws AS (
  SELECT rep, id, score, label, {_u('id', 'rep')} AS u FROM imbalanced, range(1, 301) t(rep)), w AS (
  SELECT rep, id, score, label, CASE """ + " ".join(
    f"WHEN u < {x!r}::DOUBLE THEN {i}" for i, x in enumerate(resample.POISSON_ONE)) + f""" ELSE {len(resample.POISSON_ONE)} END AS w FROM draws), g AS (
  SELECT rep, score, sum(w)::DOUBLE AS n, sum(w * label)::DOUBLE AS p FROM w GROUP BY rep, score), c AS (
  SELECT rep, n, p, sum(n) OVER o AS cum_n, sum(p) OVER o AS cum_p, sum(p) OVER (PARTITION BY rep) AS tot_p, sum(n) OVER (PARTITION BY rep) AS tot_n
  FROM g WINDOW o AS (PARTITION BY rep ORDER BY score DESC ROWS UNBOUNDED PRECEDING)), areas AS (
  SELECT rep, sum(CASE WHEN cum_n > 0 THEN (p / tot_p) * (cum_p / cum_n) ELSE 0 END) AS ap,
         sum((n - p) * (cum_p - p / 2)) / (max(tot_p) * (max(tot_n) - max(tot_p))) AS auc FROM c WHERE tot_p > 0 GROUP BY rep), placed AS (
  SELECT rep, label, w, sum(w) OVER (PARTITION BY rep ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS upto,
         greatest(1, floor(0.05::DOUBLE * sum(w) OVER (PARTITION BY rep))) AS k FROM w), tops AS (
  SELECT rep, sum(label * greatest(0, least(w, k - (upto - w))))::DOUBLE / max(k) AS prec FROM placed GROUP BY rep), long AS (
  SELECT 'average_precision' AS metric, ap AS v FROM areas UNION ALL SELECT 'roc_auc', auc FROM areas
  UNION ALL SELECT 'precision_at_k', prec FROM tops JOIN areas USING (rep)), """ + V.SCORE_TABLE + """, ranks AS (
  SELECT label, row_number() OVER (ORDER BY score DESC, id) AS r, greatest(1, floor(0.05::DOUBLE * count(*) OVER ())) AS k FROM imbalanced), points AS (
  SELECT 'average_precision' AS metric, sum((p / tot_p) * (cum_p / cum_n)) AS point FROM score_table
  UNION ALL SELECT 'roc_auc', sum((n - p) * (cum_p - p + p / 2)) / (max(tot_p) * (max(tot_n) - max(tot_p))) FROM score_table
  UNION ALL SELECT 'precision_at_k', sum(label) FILTER (WHERE r <= k) / max(k) FROM ranks)
SELECT metric, round(any_value(point), 6) AS point, count(*) AS replicates, round(quantile_cont(v, 0.025), 6) AS low, round(quantile_cont(v, 0.975), 6) AS high
FROM long JOIN points USING (metric) WHERE v IS NOT NULL GROUP BY metric""")
def bootstrap_intervals(spark, sf):
    """Average precision, ROC area and precision in the top share, from the same 300 resamples."""
    return rounded(resample.bootstrap_intervals(V.imbalanced(spark, sf), "id", "score", "label", 300))


@query("permute_column", "WITH " + V.SCORED + f""", t AS (
  SELECT id, rep, row_number() OVER (PARTITION BY rep ORDER BY id) AS r FROM scored, range(1, 3) x(rep)), s AS (
  SELECT score, rep, row_number() OVER (PARTITION BY rep ORDER BY {_u('id', '42', 'rep')}, id) AS r FROM scored, range(1, 3) x(rep))
SELECT id, rep AS repeat, score AS score_permuted FROM t JOIN s USING (rep, r)""")
def permute_column(spark, sf):
    return resample.permute_column(V.scored(spark, sf), "id", "score", repeats=2).select("id", "repeat", "score_permuted")


# --- missing scores, labels and order keys -----------------------------------------------------
# Every seventh score is null and every eleventh is not a number; every fifth label and every ninth month is null.

def _gaps(spark, sf):
    s = V.scored(spark, sf)
    lost = lambda n: F.col("id") % n == 0
    return s.select(
        "id", F.when(lost(7), F.lit(None)).when(lost(11), F.lit(float("nan"))).otherwise(F.col("score")).alias("score"),
        F.when(~lost(5), F.col("label")).alias("label"), F.when(~lost(9), F.col("month_num")).alias("month_num"),
        F.concat(F.lit("C"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("code"),
        (F.col("id") + F.lit(2 ** 60)).alias("big"))


_GAPS = V.SCORED + """, gaps AS (
  SELECT id, CASE WHEN id % 7 = 0 THEN NULL WHEN id % 11 = 0 THEN 'NaN'::DOUBLE ELSE score END AS score,
         CASE WHEN id % 5 <> 0 THEN label END AS label, CASE WHEN id % 9 <> 0 THEN month_num END AS month_num,
         'C' || lpad(id::VARCHAR, 9, '0') AS code, id + 1152921504606846976 AS big,
         (id % 7 <> 0 AND id % 11 <> 0) AS known, CASE WHEN id % 7 <> 0 AND id % 11 <> 0 THEN score END AS s FROM scored),
gap_ranked AS (
  SELECT *, row_number() OVER (ORDER BY s DESC NULLS LAST, id) AS rank, count(*) OVER () AS n FROM gaps)"""


@query("rank_cut_missing", "WITH " + _GAPS + """
SELECT id, code, CASE WHEN rank <= floor(0.05::DOUBLE * n) THEN 'SIU' WHEN rank <= floor((0.05::DOUBLE + 0.15::DOUBLE) * n)
       THEN 'Manual Review' ELSE 'Approve' END AS bucket FROM gap_ranked""")
def rank_cut_missing(spark, sf):
    return triage.rank_cut(_gaps(spark, sf), "score", "code").select("id", "code", "bucket")


@query("percentile_cut_missing", "WITH " + _GAPS + """, q AS (
  SELECT quantile_cont(s, 0.95) AS q95, quantile_cont(s, 0.8) AS q80 FROM gaps)
SELECT id, CASE WHEN s >= q95 THEN 'SIU' WHEN s >= q80 THEN 'Manual Review' ELSE 'Approve' END AS bucket FROM gaps, q""")
def percentile_cut_missing(spark, sf):
    return triage.percentile_cut(_gaps(spark, sf), "score").select("id", "bucket")


@query("queue_rank_missing", "WITH " + _GAPS + """
SELECT id, floor(rank() OVER (ORDER BY s DESC NULLS LAST) + (count(*) OVER (PARTITION BY s) - 1) / 2)::BIGINT AS queue_rank FROM gaps""")
def queue_rank_missing(spark, sf):
    return triage.queue_rank(_gaps(spark, sf), "score").select("id", "queue_rank")


@query("global_rank_missing", "WITH " + _GAPS + """
SELECT g.id, rank, n AS n_rows, row_number() OVER (PARTITION BY month_num ORDER BY big) AS in_month FROM gap_ranked g""")
def global_rank_missing(spark, sf):
    ranked = ordering.with_rank(_gaps(spark, sf), "score", "id")
    return (ordering.with_rank(ranked, "big", "code", by=["month_num"], descending=False, rank="in_month", total="_in")
            .select("id", "rank", "n_rows", "in_month"))


@query("stratified_split_missing", "WITH " + _GAPS + f""", d AS (
  SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {_u('id', '42')}, id) AS r, count(*) OVER (PARTITION BY label) AS n FROM gaps), h AS (
  SELECT *, round(n * 0.2::DOUBLE) AS held, round(round(n * 0.2::DOUBLE) * 0.5) AS tested FROM d)
SELECT id, label, CASE WHEN r <= tested THEN 'test' WHEN r <= held THEN 'val' ELSE 'train' END AS split FROM h""")
def stratified_split_missing(spark, sf):
    return resample.stratified_split(_gaps(spark, sf), "id", "label").select("id", "label", "split")


@query("order_batches_missing", "WITH " + _GAPS + """
SELECT id, least((row_number() OVER (ORDER BY month_num NULLS LAST, id) - 1) // (count(*) OVER () // 6), 5)::INT + 1 AS batch_id FROM gaps""")
def order_batches_missing(spark, sf):
    return triage.batches_in_order(_gaps(spark, sf), "month_num", "id", 6).select("id", "batch_id")
