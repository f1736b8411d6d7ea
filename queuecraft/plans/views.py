"""The given tables seen as scored rows, claims, providers and monitored events.

Every view is a frame here and a common table expression for the SQL twins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.functions import bands
from queuecraft.operators import triage, validate
from queuecraft.sources.tables import read_parquet


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, sf, name)


# --- scored: one row per order -------------------------------------------------------------

def scored(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"), F.month("o_orderdate").alias("month_num"),
        F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("priority"))


SCORED = """scored AS (
  SELECT o_orderkey AS id, o_totalprice AS score, (o_orderstatus = 'F')::INT AS label, month(o_orderdate)::INT AS month_num,
         year(o_orderdate)::INT AS year, o_custkey AS cust, o_orderpriority AS priority
  FROM orders)"""

RANKED = SCORED + """, ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank, count(*) OVER () AS n FROM scored), cut AS (
  SELECT *, CASE WHEN rank <= floor(0.05::DOUBLE * n) THEN 'SIU' WHEN rank <= floor((0.05::DOUBLE + 0.15::DOUBLE) * n) THEN 'Manual Review'
                 ELSE 'Approve' END AS bucket FROM ranked)"""


# --- imbalanced: few positives, many equal scores -------------------------------------------

def imbalanced(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    l = table(spark, sf, "labels").select("doc_id", "toxic", "quality")
    return d.join(l, "doc_id").select(F.col("doc_id").alias("id"), F.col("n_chars").cast("double").alias("score"),
                                      F.col("toxic").alias("label"), "quality", "lang", "source")


IMBALANCED = """imbalanced AS (
  SELECT d.doc_id AS id, d.n_chars::DOUBLE AS score, l.toxic AS label, l.quality, d.lang, d.source
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

SCORE_TABLE = """score_table AS (
  SELECT *, sum(n) OVER w AS cum_n, sum(p) OVER w AS cum_p, sum(n) OVER () AS tot_n, sum(p) OVER () AS tot_p
  FROM (SELECT score, count(*) AS n, sum(label) AS p FROM imbalanced GROUP BY score)
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


# --- claims: text bands derived from an order's keys and dates ------------------------------

def _pick(values: list, number: str) -> tuple[str, str]:
    """The same choice from a list, for Spark and for DuckDB."""
    shown = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    n = len(values)
    return (f"element_at(array({shown}), cast(({number}) % {n} as int) + 1)", f"([{shown}])[(({number}) % {n})::INT + 1]")


def _claim_columns() -> list[tuple[str, str, str]]:
    d = validate.CLAIM_DOMAINS
    both = lambda text: (text, text)
    k, c = "o_orderkey", "o_custkey"
    later_s, later_d = f"date_add(o_orderdate, cast({k} % 40 as int))", f"(o_orderdate + to_days(({k} % 40)::INT))"
    week = lambda day: f"(day({day}) - 1 - (day({day}) - 1) % 7)"   # whole weeks as days
    ints = lambda text: (f"cast({text} as int)", f"({text})::INT")

    def nulled(pair: tuple[str, str], every: int) -> tuple[str, str]:
        return tuple(f"CASE WHEN {k} % {every} = 0 THEN NULL ELSE {p} END" for p in pair)

    cols = {
        "PolicyNumber": both(f"{k} + 1"),
        "FraudFound_P": ints("CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"),
        "Age": ints(f"CASE WHEN {c} % 50 = 0 THEN 0 ELSE 16 + {c} % 65 END"),
        "Deductible": nulled(ints(_pick([300, 400, 500, 700], f"{k} + {c}")[0]), 101),
        "WeekOfMonth": ints(f"{week('o_orderdate')} / 7 + 1"),
        "WeekOfMonthClaimed": (f"cast({week(later_s)} / 7 + 1 as int)", f"({week(later_d)} / 7 + 1)::INT"),
        "RepNumber": ints(f"1 + {c} % 16"),
        "DriverRating": ints(f"1 + ({k} * 3 + {c}) % 5"),
        "Year": ints("year(o_orderdate)"),
        "Month": ("date_format(o_orderdate, 'MMM')", "strftime(o_orderdate, '%b')"),
        "MonthClaimed": (f"date_format({later_s}, 'MMM')", f"strftime({later_d}, '%b')"),
        "DayOfWeek": nulled(("date_format(o_orderdate, 'EEEE')", "strftime(o_orderdate, '%A')"), 89),
        "DayOfWeekClaimed": (f"date_format({later_s}, 'EEEE')", f"strftime({later_d}, '%A')"),
        "Sex": _pick(d["Sex"], c),
        "MaritalStatus": _pick(d["MaritalStatus"], f"{c} * 3 + 1"),
        "Fault": _pick(d["Fault"], f"{k} * 5 + {c} * 3"),
        "VehicleCategory": _pick(d["VehicleCategory"], f"{k} * 7 + {c}"),
        "BasePolicy": nulled(_pick(d["BasePolicy"], f"{k} + {c} * 5"), 79),
        "PoliceReportFiled": nulled(_pick(d["PoliceReportFiled"], f"{k} + {c} * 7"), 73),
        "WitnessPresent": _pick(d["WitnessPresent"], f"{k} * 3 + {c} * 11 + {k} % 5"),
        "AgentType": _pick(d["AgentType"], f"{k} * 11 + {c} % 3"),
        "AccidentArea": _pick(d["AccidentArea"], f"{c} % 7"),
        "PastNumberOfClaims": nulled(_pick(d["PastNumberOfClaims"], f"{k} * 3 + {c}"), 97),
        "AgeOfVehicle": _pick([*d["AgeOfVehicle"], "not stated"], f"{k} + {c} * 2"),
        "AgeOfPolicyHolder": nulled(_pick(d["AgeOfPolicyHolder"], c), 67),
        "NumberOfSuppliments": _pick(d["NumberOfSuppliments"], f"{k} * 7 + {c} * 3"),
        "AddressChange_Claim": _pick(d["AddressChange_Claim"], f"{k} + {c} * 9"),
        "NumberOfCars": nulled(_pick(d["NumberOfCars"], f"{k} * 2 + {c}"), 5),
        "Days_Policy_Accident": _pick(d["Days_Policy_Accident"], f"{k} * 13 + {c}"),
        "Days_Policy_Claim": _pick(d["Days_Policy_Claim"], f"{k} + {c} * 13"),
        "VehiclePrice": nulled(_pick(d["VehiclePrice"], f"{k} * 5 + {c} * 7"), 83),
        "Make": nulled(both("o_orderpriority"), 3),
        "PolicyType": nulled(both("concat(o_orderstatus, ' - ', o_orderpriority)"), 2),
    }
    cols["Deductible"] = nulled(_pick([300, 400, 500, 700], f"{k} + {c}"), 101)
    return [(name, s, duck) for name, (s, duck) in cols.items()]


def claims_of(orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return orders.selectExpr(*[f"{s} AS {name}" for name, s, _ in _claim_columns()], *keep)


def with_claim_columns(orders: DataFrame, names: Sequence[str]) -> DataFrame:
    """Orders with a few of the claims' columns beside their own."""
    return orders.selectExpr("*", *[f"{s} AS {name}" for name, s, _ in _claim_columns() if name in names])


def claims(spark: SparkSession, sf: str) -> DataFrame:
    return claims_of(table(spark, sf, "orders"))


CLAIMS = "claims AS (SELECT " + ",\n  ".join(f"{d} AS {name}" for name, _, d in _claim_columns()) + "\n  FROM orders)"


def _case(column: str, numbers: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{b}' THEN {float(v)}::DOUBLE" for b, v in numbers.items()) + " END"


def _case_int(column: str, numbers: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{b}' THEN {v}" for b, v in numbers.items()) + " END"


_F = lambda cond: f"coalesce({cond}, false)::INT"
ENGINEERED = CLAIMS + ", level1 AS (SELECT *,\n  " + ",\n  ".join(
    [f"{_case(c, m)} AS {c}_Num" for c, m in bands.BAND_COLUMNS.items()]
    + [f"{_case_int(c, bands.MONTHS)} AS {c}_Num" for c in ("Month", "MonthClaimed")]
    + [f"{_case_int(c, bands.WEEKDAYS)} AS {c}_Num" for c in ("DayOfWeek", "DayOfWeekClaimed")]
    + [f"{_F(cond)} AS {name}" for name, cond in {
        "WeekendAccident": "DayOfWeek IN ('Saturday', 'Sunday')",
        "WeekendClaim": "DayOfWeekClaimed IN ('Saturday', 'Sunday')",
        "NoPoliceReport": "PoliceReportFiled = 'No'",
        "NoWitness": "WitnessPresent = 'No'",
        "NoReportNoWitness": "PoliceReportFiled = 'No' AND WitnessPresent = 'No'",
        "PolicyHolderFault": "Fault = 'Policy Holder'",
        "ExternalAgent": "AgentType = 'External'",
        "HighDeductible": "Deductible >= 400",
        "YoungDriver": "Age <= 25",
        "HasPastClaims": "PastNumberOfClaims IS DISTINCT FROM 'none'",
        "RecentAddressChange": "AddressChange_Claim IN ('under 6 months', '1 year')",
    }.items()]) + "\n  FROM claims), level2 AS (SELECT *,\n  " + ",\n  ".join([
        "abs(WeekOfMonthClaimed - WeekOfMonth) AS WeekGap",
        "CASE WHEN Month_Num IS NOT NULL AND MonthClaimed_Num IS NOT NULL THEN least(abs(Month_Num - MonthClaimed_Num), 12 - abs(Month_Num - MonthClaimed_Num)) END AS MonthGap",
        _F("DayOfWeek = DayOfWeekClaimed") + " AS SameDayOfWeek",
        "(Age * Deductible)::DOUBLE AS Age_x_Deductible",
        "PolicyHolderFault * NoPoliceReport AS Fault_NoPolice",
        "VehiclePrice_Num / (Deductible + 1) AS PriceToDeductible",
        "Age * PastNumberOfClaims_Num AS Age_x_PastClaims",
        "NumberOfCars_Num * NumberOfSuppliments_Num AS Cars_x_Suppliments",
        "Days_Policy_Accident_Num * Days_Policy_Claim_Num AS PolicyAge_x_ClaimDelay",
        _F("BasePolicy = 'Liability' AND PoliceReportFiled = 'No'") + " AS Liability_NoPolice",
        _F("BasePolicy = 'Liability' AND VehiclePrice_Num >= 60000") + " AS HighValue_Liability",
        _F("VehicleCategory = 'Sport' AND YoungDriver = 1") + " AS Sport_YoungDriver",
        _F("Days_Policy_Accident = 'none'") + " AS VeryEarlyClaimFlag",
        _F("Days_Policy_Accident IN ('none', '1 to 7')") + " AS EarlyClaimFlag",
        _F("NumberOfSuppliments_Num >= 4") + " AS HighSupplements",
        "ExternalAgent * NoPoliceReport AS ExternalAgent_NoPolice",
    ]) + """
  FROM level1), engineered AS (SELECT *,
  NoPoliceReport + NoWitness + PolicyHolderFault + ExternalAgent + HighDeductible + YoungDriver + HasPastClaims
  + RecentAddressChange + Liability_NoPolice + HighValue_Liability + Sport_YoungDriver + VeryEarlyClaimFlag
  + HighSupplements + ExternalAgent_NoPolice AS RiskFlagCount
  FROM level2)"""


# --- providers: suppliers, with returned and other line items as the two claim tables -------

def claim_lines(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_returnflag")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return l.join(o, l.l_orderkey == o.o_orderkey).select(
        F.col("l_suppkey").alias("provider"), F.col("l_orderkey").alias("claim"), F.col("o_custkey").alias("patient"),
        F.col("l_partkey").alias("physician"), F.col("l_extendedprice").alias("amount"),
        F.col("l_discount").alias("deductible"), F.col("l_returnflag").alias("flag"))


def inpatient_of(lines: DataFrame) -> DataFrame:
    return lines.filter((F.col("flag") == "R") & (F.col("provider") % 10 != 0)).drop("flag")


def outpatient_of(lines: DataFrame) -> DataFrame:
    return lines.filter((F.col("flag") != "R") & (F.col("provider") % 10 != 1)).drop("flag")


def inpatient(spark: SparkSession, sf: str) -> DataFrame:
    return inpatient_of(claim_lines(spark, sf))


def outpatient(spark: SparkSession, sf: str) -> DataFrame:
    return outpatient_of(claim_lines(spark, sf))


def patients(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("patient"), F.col("c_nationkey").alias("state"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("condition_a"),
        (F.col("c_mktsegment") == "MACHINERY").cast("int").alias("condition_b"),
        F.col("c_acctbal").alias("annual_inpatient"), (F.col("c_acctbal") * 0.5).alias("annual_outpatient"),
        F.when(F.col("c_acctbal") < 0, F.lit("2001-01-01")).alias("died"))


def provider_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("provider"),
        F.when(F.col("s_acctbal") < 0, "Yes").otherwise("No").alias("potential")
    ).withColumn("label", (F.col("potential") == "Yes").cast("int")).drop("potential")


CONDITIONS = ["condition_a", "condition_b"]

PROVIDERS = """lines AS (
  SELECT l_suppkey AS provider, l_orderkey AS claim, o_custkey AS patient, l_partkey AS physician, l_extendedprice AS amount,
         l_discount AS deductible, l_returnflag AS flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey), inpatient AS (
  SELECT * FROM lines WHERE flag = 'R' AND provider % 10 <> 0), outpatient AS (
  SELECT * FROM lines WHERE flag <> 'R' AND provider % 10 <> 1), patients AS (
  SELECT c_custkey AS patient, c_nationkey AS state, (c_mktsegment = 'BUILDING')::INT AS condition_a,
         (c_mktsegment = 'MACHINERY')::INT AS condition_b, c_acctbal AS annual_inpatient, c_acctbal * 0.5 AS annual_outpatient,
         CASE WHEN c_acctbal < 0 THEN '2001-01-01' END AS died FROM customer), provider_labels AS (
  SELECT s_suppkey AS provider, (s_acctbal < 0)::INT AS label FROM supplier), ip AS (
  SELECT provider, count(claim) AS claims_ip, avg(amount) AS avg_amount_ip, sum(amount) AS total_amount_ip,
         max(amount) AS max_amount_ip, avg(deductible) AS avg_deductible_ip, count(DISTINCT patient) AS patients_ip,
         count(DISTINCT physician) AS physicians_ip FROM inpatient GROUP BY provider), op AS (
  SELECT provider, count(claim) AS claims_op, avg(amount) AS avg_amount_op, sum(amount) AS total_amount_op,
         max(amount) AS max_amount_op, count(DISTINCT patient) AS patients_op FROM outpatient GROUP BY provider), people AS (
  SELECT provider, avg(condition_a) AS avg_condition_a, avg(condition_b) AS avg_condition_b, count(DISTINCT state) AS states,
         avg(annual_inpatient) AS avg_annual_inpatient, avg(annual_outpatient) AS avg_annual_outpatient,
         avg((died IS NOT NULL)::INT) AS share_deceased
  FROM (SELECT DISTINCT provider, patient FROM inpatient) x LEFT JOIN patients USING (patient) GROUP BY provider), joined AS (
  SELECT provider, label, """ + ", ".join(
    [f"coalesce({c}, 0) AS {c}" for c in (
        "claims_ip", "avg_amount_ip", "total_amount_ip", "max_amount_ip", "avg_deductible_ip", "patients_ip", "physicians_ip",
        "claims_op", "avg_amount_op", "total_amount_op", "max_amount_op", "patients_op", "avg_condition_a", "avg_condition_b",
        "states", "avg_annual_inpatient", "avg_annual_outpatient", "share_deceased")]) + """
  FROM provider_labels LEFT JOIN ip USING (provider) LEFT JOIN op USING (provider) LEFT JOIN people USING (provider)), provider AS (
  SELECT *, claims_ip + claims_op AS total_claims, total_amount_ip + total_amount_op AS total_amount,
         patients_ip + patients_op AS patients,
         CASE WHEN claims_ip + claims_op > 0 THEN (total_amount_ip + total_amount_op) / (claims_ip + claims_op) ELSE 0 END AS amount_per_claim,
         CASE WHEN claims_ip + claims_op > 0 THEN claims_ip / (claims_ip + claims_op) ELSE 0 END AS inpatient_ratio
  FROM joined)"""


# --- monitored events ------------------------------------------------------------------------

FEATURES = ["value", "k", "hour"]
HALVES = 2


def monitored(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    at = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").alias("id"), F.unix_micros(at).alias("at_us"), F.col("value").alias("score"), "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"), F.hour(at).cast("double").alias("hour"),
        "user_id", (F.col("event_type") == "error").cast("int").alias("label"))


def halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """First half by time is the reference, the rest is monitored."""
    split = triage.batches_in_order(monitored(spark, sf), "at_us", "id", HALVES, out="half")
    return split.filter(F.col("half") == 1).drop("half"), split.filter(F.col("half") == 2).drop("half")


MONITORED = """monitored AS (
  SELECT event_id AS id, epoch_us(ts) AS at_us, value AS score, value, json_extract_string(props, '$.k')::DOUBLE AS k,
         hour(ts)::DOUBLE AS hour, user_id, (event_type = 'error')::INT AS label FROM events), timed AS (
  SELECT *, row_number() OVER (ORDER BY at_us, id) AS pos, count(*) OVER () AS n_all FROM monitored), reference AS (
  SELECT * FROM timed WHERE pos <= n_all // 2), current_rows AS (
  SELECT *, row_number() OVER (ORDER BY at_us, id) AS cpos, count(*) OVER () AS n_cur FROM timed WHERE pos > n_all // 2), batched AS (
  SELECT *, least((cpos - 1) // (n_cur // 6), 5)::INT + 1 AS batch_id FROM current_rows)"""

KS = MONITORED + """, long AS (
  SELECT f.feature, f.val AS v, b FROM (
    SELECT 0 AS b, [{'feature': 'value', 'val': value}, {'feature': 'k', 'val': k}, {'feature': 'hour', 'val': hour}] AS fs FROM reference
    UNION ALL
    SELECT batch_id, [{'feature': 'value', 'val': value}, {'feature': 'k', 'val': k}, {'feature': 'hour', 'val': hour}] FROM batched
  ), unnest(fs) AS t(f) WHERE f.val IS NOT NULL), wide AS (
  SELECT feature, v, """ + ", ".join(f"count(*) FILTER (WHERE b = {b}) AS n{b}" for b in range(7)) + """
  FROM long GROUP BY feature, v), running AS (
  SELECT feature, """ + ", ".join(
    f"sum(n{b}) OVER w AS c{b}, sum(n{b}) OVER g AS t{b}" for b in range(7)) + """
  FROM wide WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY feature)), ks AS (
  """ + "\n  UNION ALL ".join(
    f"SELECT feature, {b} AS batch_id, max(t0)::BIGINT AS n_reference, max(t{b})::BIGINT AS n_batch, "
    f"max(abs(c{b}::DOUBLE / t{b} - c0::DOUBLE / t0)) AS distance FROM running GROUP BY feature" for b in range(1, 7)) + """), tests AS (
  SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
         lambda i: (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * i * i * lam * lam))))) END AS p_value
  FROM (SELECT *, sqrt(n_reference::DOUBLE * n_batch / (n_reference + n_batch)) * distance AS lam
        FROM ks WHERE n_reference > 10 AND n_batch > 10)), scaled AS (
  SELECT *, p_value * count(*) OVER (PARTITION BY batch_id) / row_number() OVER (PARTITION BY batch_id ORDER BY p_value, feature) AS s
  FROM tests), adjusted AS (
  SELECT *, least(1.0, min(s) OVER (PARTITION BY batch_id ORDER BY p_value, feature ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p_adjusted
  FROM scaled)"""


# --- linear scorer over numeric order columns ---------------------------------------------------

# weights chosen once; the means come from the data
LINEAR_WEIGHTS = {"price": 1e-5, "cust": -0.002, "month": 0.15, "weekday": -0.1, "late": 0.4, "urgent": 0.25}


def linear_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_custkey").cast("double").alias("cust"),
        F.month("o_orderdate").cast("double").alias("month"), F.weekday("o_orderdate").cast("double").alias("weekday"),
        (F.year("o_orderdate") >= 1998).cast("double").alias("late"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"))


LINEAR = """linear_rows AS (
  SELECT o_orderkey AS id, o_totalprice AS price, o_custkey::DOUBLE AS cust, month(o_orderdate)::DOUBLE AS month,
         (isodow(o_orderdate) - 1)::DOUBLE AS weekday, (year(o_orderdate) >= 1998)::INT::DOUBLE AS late,
         (o_orderpriority = '1-URGENT')::INT::DOUBLE AS urgent, (o_orderstatus = 'F')::INT AS label FROM orders), means AS (
  SELECT """ + ", ".join(f"avg({c}) AS m_{c}" for c in LINEAR_WEIGHTS) + """ FROM linear_rows), phis AS (
  SELECT l.*, """ + ", ".join(f"{w!r}::DOUBLE * ({c} - m_{c}) AS phi_{c}" for c, w in LINEAR_WEIGHTS.items()) + """
  FROM linear_rows l, means), contributions AS (
  """ + "\n  UNION ALL ".join(
    f"SELECT id, label, {i} AS place, '{c}' AS feature, {c} AS value, phi_{c} AS phi FROM phis" for i, c in enumerate(LINEAR_WEIGHTS)) + ")"
