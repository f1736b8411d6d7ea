"""Row-local features, bands and wording."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuecraft.functions import bands, features, labels
from queuecraft.plans import views as V
from queuecraft.plans.registry import query, rounded


def _twin(columns: list[str]) -> str:
    frac = {"PriceToDeductible"}
    shown = ", ".join(f"round({c}, 6) AS {c}" if c in frac else c for c in columns)
    return f"WITH {V.ENGINEERED} SELECT PolicyNumber, {shown} FROM engineered"


def _pack(name: str, columns: list[str]) -> None:
    @query(name, _twin(columns))
    def run(spark, sf):
        return rounded(features.engineer(V.claims(spark, sf)).select("PolicyNumber", *columns))


_pack("feat_ordinal", features.ORDINAL)
_pack("feat_calendar", features.CALENDAR)
_pack("feat_timing", features.TIMING)
_pack("feat_flags", features.FLAGS)
_pack("feat_interactions", features.INTERACTIONS)
_pack("feat_guideline", features.GUIDELINE)
_pack("feat_risk_count", ["RiskFlagCount"])
_pack("engineer_features", features.ENGINEERED)


@query("impute_sentinel", "WITH " + V.CLAIMS + f"""
SELECT PolicyNumber, CASE WHEN Age = 0 THEN coalesce({V._case('AgeOfPolicyHolder', bands.HOLDER_AGE)}, 16.5::DOUBLE) ELSE Age::DOUBLE END AS Age FROM claims""")
def impute_sentinel(spark, sf):
    return features.impute_age(V.claims(spark, sf)).select("PolicyNumber", "Age")


@query("derive_band", "WITH " + V.CLAIMS + """
SELECT PolicyNumber, CASE WHEN Age <= 17 THEN '16 to 17' WHEN Age <= 20 THEN '18 to 20' WHEN Age <= 25 THEN '21 to 25' WHEN Age <= 30 THEN '26 to 30'
  WHEN Age <= 35 THEN '31 to 35' WHEN Age <= 40 THEN '36 to 40' WHEN Age <= 50 THEN '41 to 50' WHEN Age <= 65 THEN '51 to 65' ELSE 'over 65' END AS band
FROM claims""")
def derive_band(spark, sf):
    return V.claims(spark, sf).select("PolicyNumber", bands.holder_band(F.col("Age")).alias("band"))


@query("bin_with_unknown", """
SELECT band, count(*) AS n_rows FROM (
  SELECT CASE WHEN a > 0 AND a <= 25 THEN '16-25' WHEN a > 25 AND a <= 35 THEN '26-35' WHEN a > 35 AND a <= 50 THEN '36-50'
              WHEN a > 50 AND a <= 65 THEN '51-65' WHEN a > 65 AND a <= 120 THEN '65+' ELSE 'Unknown (age not recorded)' END AS band
  FROM (SELECT CASE WHEN c_nationkey = 7 THEN NULL ELSE c_acctbal / 50 END AS a FROM customer)) GROUP BY band""")
def bin_with_unknown(spark, sf):
    age = F.when(F.col("c_nationkey") != 7, F.col("c_acctbal") / 50)
    return V.table(spark, sf, "customer").groupBy(bands.age_group(age).alias("band")).agg(F.count("*").alias("n_rows"))


@query("prettify_names", """
SELECT name, trim(lower(regexp_replace(replace(replace(name, '_x_', ' x '), '_', ' '), '([a-z0-9])([A-Z])', '\\1 \\2', 'g'))) AS label
FROM (SELECT DISTINCT concat(replace(p_type, ' ', ''), '_x_', p_brand, '_', replace(p_name, ' ', 'Of')) AS name FROM part)""")
def prettify_names(spark, sf):
    name = F.concat(F.replace("p_type", F.lit(" "), F.lit("")), F.lit("_x_"), F.col("p_brand"), F.lit("_"),
                    F.replace("p_name", F.lit(" "), F.lit("Of")))
    return V.table(spark, sf, "part").select(name.alias("name")).distinct().withColumn("label", labels.prettify(F.col("name")))


HOT_COLUMNS = ["VehicleCategory", "BasePolicy", "MaritalStatus", "Fault", "AddressChange_Claim", "AddressChange"]


def _hot_rows(spark, sf):
    """One-hot names of the claims' own levels with a 0/1 value, and plain feature names."""
    c = V.claims(spark, sf)
    cells = [F.struct(F.concat(F.lit(f"{n}_"), F.col(n)).alias("feature"), F.lit(v).alias("value"))
             for n, v in (("VehicleCategory", 1.0), ("BasePolicy", 0.0), ("MaritalStatus", None), ("AddressChange_Claim", 1.0))]
    cells += [F.struct(F.lit(n).alias("feature"), F.col("Age").cast("double").alias("value")) for n in ("Age_x_Deductible", "NewFlagCount_x")]
    return c.select("PolicyNumber", F.inline(F.array(*cells))).filter(F.col("feature").isNotNull())


_HOT = V.CLAIMS + """, hot AS (
  SELECT feature, value, col, level FROM (
    SELECT concat('VehicleCategory_', VehicleCategory) AS feature, 1.0::DOUBLE AS value, 'vehicle category' AS col, VehicleCategory AS level FROM claims
    UNION ALL SELECT concat('BasePolicy_', BasePolicy), 0.0, 'base policy', BasePolicy FROM claims WHERE BasePolicy IS NOT NULL
    UNION ALL SELECT concat('MaritalStatus_', MaritalStatus), NULL, 'marital status', MaritalStatus FROM claims
    UNION ALL SELECT concat('AddressChange_Claim_', AddressChange_Claim), 1.0, 'address change claim', AddressChange_Claim FROM claims
    UNION ALL SELECT 'Age_x_Deductible', Age, 'age combined with deductible', NULL FROM claims
    UNION ALL SELECT 'NewFlagCount_x', Age, 'new flag count x', NULL FROM claims))
SELECT text, count(*) AS n_rows FROM (
  SELECT CASE WHEN level IS NULL THEN col WHEN value IS NULL THEN concat(col, ' = ''', level, '''')
              WHEN value > 0.5 THEN concat(col, ' is ', level) ELSE concat(col, ' is not ', level) END AS text FROM hot) GROUP BY text"""


@query("humanize_labels", "WITH " + _HOT)
def humanize_labels(spark, sf):
    rows = _hot_rows(spark, sf)
    return rows.groupBy(labels.feature_text(F.col("feature"), F.col("value"), HOT_COLUMNS).alias("text")).agg(F.count("*").alias("n_rows"))


@query("humanize_labels_join", "WITH " + _HOT)
def humanize_labels_join(spark, sf):
    """The same with the column dictionary as a table: longest-prefix search as an equi-join."""
    rows = _hot_rows(spark, sf)
    known = spark.createDataFrame([(c,) for c in HOT_COLUMNS], "column_name string")
    return labels.with_feature_text(rows, "feature", "value", known).groupBy("text").agg(F.count("*").alias("n_rows"))


@query("risk_level", "WITH " + V.SCORED + """
SELECT CASE WHEN s >= 0.5 THEN 'HIGH' WHEN s >= 0.3 THEN 'ELEVATED' WHEN s >= 0.1 THEN 'MODERATE' ELSE 'LOW' END AS level, count(*) AS n_rows
FROM (SELECT score / 1000000 AS s FROM scored) GROUP BY level""")
def risk_level(spark, sf):
    return V.scored(spark, sf).groupBy(labels.risk_level(F.col("score") / 1000000).alias("level")).agg(F.count("*").alias("n_rows"))


@query("format_report", """
SELECT o_orderpriority, concat(printf('%.1f', round(100 * avg((o_orderstatus = 'F')::INT), 1)), '%') AS rate_text,
       concat(printf('%.1f', round(avg(o_totalprice) / 100000, 1)), '×') AS times_text,
       concat('$', format('{:,}', round(sum(o_totalprice))::BIGINT)) AS money_text
FROM orders GROUP BY o_orderpriority""")
def format_report(spark, sf):
    o = V.table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("a"), F.avg("o_totalprice").alias("b"), F.sum("o_totalprice").alias("c"))
    return o.select("o_orderpriority", labels.percent_text(F.col("a")).alias("rate_text"),
                    labels.times_text(F.col("b") / 100000).alias("times_text"), labels.money_text(F.col("c")).alias("money_text"))
