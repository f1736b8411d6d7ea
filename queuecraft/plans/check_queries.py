"""Scans, projections, validation and profiling over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuecraft.functions import features as claim_features
from queuecraft.operators import profile, provider, triage, validate
from queuecraft.plans import views as V
from queuecraft.plans.registry import query, r, rounded
from queuecraft.session import scratch_path
from queuecraft.sources import sinks, tables


@query("scan_profile", """
SELECT count(*) AS n_rows, count(o_custkey) AS n_cust, round(sum(o_totalprice), 2) AS total_price, min(o_totalprice) AS min_price,
       max(o_totalprice) AS max_price, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day
FROM orders""")
def scan_profile(spark, sf):
    o = V.table(spark, sf, "orders")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return o.agg(F.count("*").alias("n_rows"), F.count("o_custkey").alias("n_cust"), r(F.sum("o_totalprice"), 2).alias("total_price"),
                 F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
                 day(F.min("o_orderdate")).alias("first_day"), day(F.max("o_orderdate")).alias("last_day"))


@query("csv_set_scan", """
SELECT r_name AS region, count(*) AS customers, count(DISTINCT n_nationkey) AS nations, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def csv_set_scan(spark, sf):
    """Three tables written as CSV and scanned back as one set under declared schemas."""
    folder = scratch_path(spark, "csv-set")
    kept = {"customer": ["c_custkey", "c_nationkey", "c_acctbal"], "nation": ["n_nationkey", "n_regionkey"], "region": ["r_regionkey", "r_name"]}
    schemas = {}
    for name, columns in kept.items():
        frame = V.table(spark, sf, name).select(*columns)
        schemas[name] = frame.schema
        sinks.write_csv(frame, f"{folder}/{name}.csv")
    t = tables.read_csv_set(spark, folder, schemas)
    joined = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy(F.col("r_name").alias("region")).agg(
        F.count("*").alias("customers"), F.count_distinct("n_nationkey").alias("nations"), r(F.sum("c_acctbal"), 2).alias("balance"))


@query("json_report", "WITH " + V.RANKED + """
SELECT bucket, count(*) AS n_rows, sum(label)::BIGINT AS positives, round(avg(label), 6) AS positive_rate FROM cut GROUP BY bucket""")
def json_report(spark, sf):
    """The queue report written as JSON and read back under its schema."""
    path = scratch_path(spark, "report")
    sinks.write_json(triage.bucket_summary(triage.rank_cut(V.scored(spark, sf), "score", "id"), "label"), path)
    back = tables.read_json(spark, path, "bucket string, n_rows long, positives long, positive_rate double")
    return rounded(back)


@query("model_columns", "WITH " + V.CLAIMS + " SELECT * EXCLUDE (" + ", ".join(claim_features.REPLACED_COLUMNS) + ") FROM claims")
def model_columns(spark, sf):
    """Claims without the originals that engineered columns stand in for."""
    return claim_features.drop_replaced(V.claims(spark, sf))


@query("project_features", """
SELECT o_orderkey, o_totalprice, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_day FROM orders""")
def project_features(spark, sf):
    o = V.table(spark, sf, "orders").withColumn("o_day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.drop("o_orderstatus", "o_custkey", "o_orderdate")     # target, identifier, raw date; the key stays


@query("align_columns", """
SELECT o_orderpriority, 'Unknown' AS region_name, o_totalprice, 0 AS late_fee FROM orders""")
def align_columns(spark, sf):
    return validate.align(V.table(spark, sf, "orders"), ["o_orderpriority", "region_name"], ["o_totalprice", "late_fee"])


@query("fill_defaults", "WITH " + V.CLAIMS + """, f AS (
  SELECT PolicyNumber, Make AS m, NumberOfCars AS nc, PolicyType AS pt, AgeOfPolicyHolder AS ah, VehicleCategory, BasePolicy, Age FROM claims)
SELECT PolicyNumber, coalesce(m, 'Honda') AS Make, coalesce(nc, '1 vehicle') AS NumberOfCars,
       coalesce(pt, concat_ws(' - ', VehicleCategory, BasePolicy)) AS PolicyType,
       coalesce(ah, CASE WHEN Age <= 17 THEN '16 to 17' WHEN Age <= 20 THEN '18 to 20' WHEN Age <= 25 THEN '21 to 25' WHEN Age <= 30 THEN '26 to 30'
         WHEN Age <= 35 THEN '31 to 35' WHEN Age <= 40 THEN '36 to 40' WHEN Age <= 50 THEN '41 to 50' WHEN Age <= 65 THEN '51 to 65' ELSE 'over 65' END) AS AgeOfPolicyHolder,
       5 AS RepNumber,
       concat_ws(',', CASE WHEN ah IS NULL THEN 'AgeOfPolicyHolder' END, CASE WHEN m IS NULL THEN 'Make' END,
         CASE WHEN nc IS NULL THEN 'NumberOfCars' END, CASE WHEN pt IS NULL THEN 'PolicyType' END, 'RepNumber') AS defaults_applied
FROM f""")
def fill_defaults(spark, sf):
    given = V.claims(spark, sf).drop("RepNumber")
    filled = validate.fill_defaults(given)
    return filled.select("PolicyNumber", "Make", "NumberOfCars", "PolicyType", "AgeOfPolicyHolder", "RepNumber",
                         F.array_join(F.sort_array(F.map_keys("defaults_applied")), ",").alias("defaults_applied"))


def _domain_sql(table: str, column: str, values: list) -> str:
    shown = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"SELECT '{column}' AS column_name, 'domain' AS check_name, count(*) FILTER (WHERE {column} NOT IN ({shown})) AS violations FROM {table}"


ORDER_DOMAIN = ["F", "O"]
PRIORITY_DOMAIN = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
EVENT_DOMAIN = ["click", "view", "purchase"]


@query("validate_domain", " UNION ALL ".join([
    _domain_sql("orders", "o_orderstatus", ORDER_DOMAIN), _domain_sql("orders", "o_orderpriority", PRIORITY_DOMAIN),
    _domain_sql("events", "event_type", EVENT_DOMAIN)]))
def validate_domain(spark, sf):
    orders = validate.count_violations(V.table(spark, sf, "orders"), [
        validate.domain("o_orderstatus", *ORDER_DOMAIN), validate.domain("o_orderpriority", *PRIORITY_DOMAIN)])
    return orders.unionByName(validate.count_violations(V.table(spark, sf, "events"), [validate.domain("event_type", *EVENT_DOMAIN)]))


@query("validate_claims", "WITH " + V.CLAIMS + " " + " UNION ALL ".join(
    ["SELECT 'PolicyNumber' AS column_name, 'range' AS check_name, count(*) FILTER (WHERE PolicyNumber <= 0) AS violations FROM claims"]
    + [_domain_sql("claims", c, list(v)) for c, v in validate.CLAIM_DOMAINS.items()]
    + [f"SELECT '{c}', 'range', count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) FROM claims" for c, (lo, hi) in validate.CLAIM_RANGES.items()]
    + [f"SELECT '{c}', 'not_null', count(*) FILTER (WHERE {c} IS NULL) FROM claims"
       for c in ["PolicyNumber", *validate.CLAIM_DOMAINS, *validate.CLAIM_RANGES, *validate.CLAIM_UNCHECKED]]))
def validate_claims(spark, sf):
    return validate.count_violations(V.claims(spark, sf), validate.claim_rules())


@query("validate_range", """
SELECT 'l_quantity' AS column_name, 'range' AS check_name, count(*) FILTER (WHERE l_quantity < 2 OR l_quantity > 45) AS violations FROM lineitem
UNION ALL SELECT 'l_discount', 'range', count(*) FILTER (WHERE l_discount > 0.08) FROM lineitem
UNION ALL SELECT 'l_tax', 'range', count(*) FILTER (WHERE l_tax <= 0) FROM lineitem""")
def validate_range(spark, sf):
    return validate.count_violations(V.table(spark, sf, "lineitem"), [
        validate.between("l_quantity", 2, 45), validate.between("l_discount", high=0.08), validate.between("l_tax", low=0, low_open=True)])


@query("validate_not_null", "WITH " + V.CLAIMS + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, 'not_null' AS check_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM claims"
    for c in ("DayOfWeek", "BasePolicy", "PastNumberOfClaims", "VehiclePrice", "Make", "Sex")))
def validate_not_null(spark, sf):
    return validate.count_violations(V.claims(spark, sf), [
        validate.not_null(c) for c in ("DayOfWeek", "BasePolicy", "PastNumberOfClaims", "VehiclePrice", "Make", "Sex")])


@query("validate_dataset", "WITH " + V.SCORED + """
SELECT 'row_count' AS check_name, count(*) > 100 AS passed FROM scored UNION ALL SELECT 'positive_rate', avg(label) < 0.5 FROM scored""")
def validate_dataset(spark, sf):
    return validate.dataset_checks(V.scored(spark, sf), "label")


EVENT_RULES = [validate.domain("event_type", *EVENT_DOMAIN), validate.between("value", 1, 50), validate.not_null("props")]


@query("validation_failures", """
SELECT event_id, 'event_type' AS column_name, 'domain' AS check_name, event_type AS failing_value FROM events
WHERE event_type NOT IN ('click', 'view', 'purchase')
UNION ALL SELECT event_id, 'value', 'range', value::VARCHAR FROM events WHERE value < 1 OR value > 50
UNION ALL SELECT event_id, 'props', 'not_null', props FROM events WHERE props IS NULL""")
def validation_failures(spark, sf):
    return validate.failure_cases(V.table(spark, sf, "events"), "event_id", EVENT_RULES)


REPORT_RULES = [("Age range", validate.between("Age", 16, 100))] + [(f"{c} valid", validate.domain(c, *validate.CLAIM_DOMAINS[c]))
                for c in ("Deductible", "FraudFound_P", "Fault", "BasePolicy", "PoliceReportFiled")]


@query("validation_report", "WITH " + V.CLAIMS + """, checks AS (
  SELECT 'Row count' AS check_name, count(*) > 100 AS passed FROM claims
  UNION ALL SELECT 'No duplicate rows', (SELECT count(*) FROM (SELECT DISTINCT * FROM claims)) = count(*) FROM claims
  UNION ALL SELECT 'No missing values', count(*) = 0 FROM claims WHERE """ + " OR ".join(f"{n} IS NULL" for n, _, _ in V._claim_columns()) + """
  UNION ALL SELECT 'Positive rate', avg(FraudFound_P) < 0.5 FROM claims
  UNION ALL SELECT 'Age range', bool_and(coalesce(Age BETWEEN 16 AND 100, false)) FROM claims""" + "".join(
    f" UNION ALL SELECT '{c} valid', bool_and(coalesce({c} IN (" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in validate.CLAIM_DOMAINS[c]) + "), false)) FROM claims"
    for c in ("Deductible", "FraudFound_P", "Fault", "BasePolicy", "PoliceReportFiled")) + """)
SELECT * FROM checks UNION ALL SELECT 'All checks', bool_and(passed) FROM checks""")
def validation_report(spark, sf):
    c = V.claims(spark, sf)
    return validate.report(c, "FraudFound_P", REPORT_RULES, profile.duplicate_rows(c))


@query("quarantine_split", """
SELECT event_id, concat_ws(',', CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'event_type:domain' END,
         CASE WHEN value < 1 OR value > 50 THEN 'value:range' END, CASE WHEN props IS NULL THEN 'props:not_null' END) AS reasons,
       (event_type IN ('click', 'view', 'purchase') AND value BETWEEN 1 AND 50 AND props IS NOT NULL) AS accepted
FROM events""")
def quarantine_split(spark, sf):
    marked = validate.quarantine(V.table(spark, sf, "events"), EVENT_RULES)
    return marked.select("event_id", F.array_join("reasons", ",").alias("reasons"), "accepted")


@query("strict_records", "WITH " + V.CLAIMS + ", flagged AS (SELECT PolicyNumber, " + " + ".join(
    ["(PolicyNumber <= 0)::INT"]
    + [f"coalesce({c} NOT IN (" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in vals) + "), false)::INT" for c, vals in validate.CLAIM_DOMAINS.items()]
    + [f"coalesce({c} < {lo} OR {c} > {hi}, false)::INT" for c, (lo, hi) in validate.CLAIM_RANGES.items()]
    + [f"({c} IS NULL)::INT" for c in [*validate.CLAIM_DOMAINS, *validate.CLAIM_RANGES]
       if c not in validate.OPTIONAL_FIELDS and c != "FraudFound_P"]) + """ AS n_reasons FROM claims)
SELECT (n_reasons = 0) AS accepted, n_reasons, count(*) AS n_rows FROM flagged GROUP BY ALL""")
def strict_records(spark, sf):
    c = V.claims(spark, sf)
    marked = validate.quarantine(c, validate.record_rules(c.columns))
    return marked.groupBy("accepted", F.size("reasons").alias("n_reasons")).agg(F.count("*").alias("n_rows"))


@query("queue_filter", "WITH " + V.RANKED + """
SELECT id, score, bucket FROM cut WHERE bucket IN ('SIU', 'Manual Review') AND score BETWEEN 400000 AND 490000""")
def queue_filter(spark, sf):
    cut = triage.rank_cut(V.scored(spark, sf), "score", "id")
    return triage.queue_filter(cut, "score", [triage.TOP, triage.MIDDLE], 400000, 490000).select("id", "score", "bucket")


@query("value_counts", """
SELECT o_orderpriority, count(*) AS n_rows, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY o_orderpriority""")
def value_counts(spark, sf):
    return rounded(profile.value_counts(V.table(spark, sf, "orders"), "o_orderpriority"))


@query("missing_summary", "WITH " + V.CLAIMS + " " + " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) - count({n}) AS n_missing, round(100 * (count(*) - count({n}))::DOUBLE / count(*), 2) AS pct_missing FROM claims"
    for n, _, _ in V._claim_columns()))
def missing_summary(spark, sf):
    return profile.missing_summary(V.claims(spark, sf))


@query("duplicate_rows", """
SELECT coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)""")
def duplicate_rows(spark, sf):
    return profile.duplicate_rows(V.table(spark, sf, "documents"), ["text", "lang"])


@query("high_cardinality_cols", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + max(({c} IS NULL)::INT) AS n_distinct, count(*) AS n_rows, "
    f"count(DISTINCT {c}) + max(({c} IS NULL)::INT) > 0.9 * count(*) AS id_like FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")))
def high_cardinality_cols(spark, sf):
    return profile.high_cardinality(V.table(spark, sf, "orders"),
                                    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"], exact=True)


@query("dataset_summary", "WITH " + V.SCORED + ", " + """s AS (
  SELECT 'orders' AS dataset, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS p FROM scored
  UNION ALL SELECT 'suppliers', count(*)::DOUBLE, sum((s_acctbal < 0)::INT)::DOUBLE FROM supplier), w AS (
  SELECT statistic, dataset, value FROM s, unnest([
    {'statistic': 'records', 'value': n}, {'statistic': 'positives', 'value': p}, {'statistic': 'negatives', 'value': n - p},
    {'statistic': 'rate', 'value': p / n}, {'statistic': 'imbalance', 'value': CASE WHEN p > 0 THEN (n - p) / p END}]) t(u),
    LATERAL (SELECT u.statistic AS statistic, u.value AS value))
SELECT statistic, round(max(value) FILTER (WHERE dataset = 'orders'), 6) AS orders,
       round(max(value) FILTER (WHERE dataset = 'suppliers'), 6) AS suppliers FROM w GROUP BY statistic""")
def dataset_summary(spark, sf):
    frames = {"orders": V.scored(spark, sf), "suppliers": V.provider_labels(spark, sf)}
    return rounded(profile.side_by_side(profile.dataset_summary(frames, "label"), list(frames)))


@query("class_balance", "WITH " + V.SCORED + """
SELECT 'orders' AS dataset, label, count(*) AS n_rows, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM scored GROUP BY label
UNION ALL SELECT 'suppliers', (s_acctbal < 0)::INT, count(*), round(count(*) / sum(count(*)) OVER (), 6) FROM supplier GROUP BY 2""")
def class_balance(spark, sf):
    return rounded(profile.class_balance(V.scored(spark, sf), "label", "orders").unionByName(
        profile.class_balance(V.provider_labels(spark, sf), "label", "suppliers")))


@query("histogram", "WITH " + V.SCORED + """, e AS (SELECT min(score) AS lo, max(score) AS hi FROM scored WHERE score > 0)
SELECT label, least(floor((score - lo) / ((hi - lo) / 30)), 29)::INT + 1 AS bin, count(*) AS n_rows
FROM scored, e WHERE score > 0 GROUP BY ALL""")
def histogram(spark, sf):
    return profile.histogram(V.scored(spark, sf), "score", 30, by=["label"], positive_only=True)


# Volume bands of the provider report.
VOLUME_EDGES = [0, 10, 50, 100, 500, 99999]


@query("rate_by_volume", "WITH " + V.PROVIDERS + """, b AS (SELECT label, CASE """ + " ".join(
    f"WHEN total_claims > {a} AND total_claims <= {b} THEN '({a:g}, {b:g}]'" for a, b in zip(VOLUME_EDGES, VOLUME_EDGES[1:])) + """ END AS band FROM provider)
SELECT band, count(*) AS n_rows, round(avg(label), 6) AS rate FROM b WHERE band IS NOT NULL GROUP BY band""")
def rate_by_volume(spark, sf):
    matrix = provider.provider_matrix(V.provider_labels(spark, sf), V.inpatient(spark, sf), V.outpatient(spark, sf),
                                      V.patients(spark, sf), V.CONDITIONS)
    return rounded(profile.rate_by_band(matrix, "total_claims", "label", VOLUME_EDGES))


@query("profile_columns", "WITH " + V.ENGINEERED + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_null, '{t}' AS type FROM engineered"
    for c, t in {"Days_Policy_Accident_Num": "double", "AgeOfVehicle_Num": "double", "VehiclePrice_Num": "double", "WeekGap": "int",
                 "MonthGap": "int", "PriceToDeductible": "double", "RiskFlagCount": "int"}.items()))
def profile_columns(spark, sf):
    wide = claim_features.engineer(V.claims(spark, sf))
    return profile.profile_columns(wide, ["Days_Policy_Accident_Num", "AgeOfVehicle_Num", "VehiclePrice_Num", "WeekGap",
                                          "MonthGap", "PriceToDeductible", "RiskFlagCount"])


@query("split_disjoint", "WITH " + V.SCORED + """
SELECT 0 AS overlapping, 0 AS lost, count(*) AS n_rows FROM scored""")
def split_disjoint(spark, sf):
    """No id in two splits, none lost: counted per id rather than compared pair by pair."""
    from queuecraft.operators import resample

    rows = resample.stratified_split(V.scored(spark, sf), "id", "label")
    per_id = rows.groupBy("id").agg(F.count_distinct("split").alias("splits"))
    everyone = V.scored(spark, sf).select("id").join(per_id, "id", "left")
    return everyone.agg(F.sum((F.col("splits") > 1).cast("int")).cast("int").alias("overlapping"),
                        F.sum(F.col("splits").isNull().cast("int")).cast("int").alias("lost"), F.count("*").alias("n_rows"))
