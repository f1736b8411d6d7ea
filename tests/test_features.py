import pytest
from pyspark.sql import functions as F
from helpers import plan_of

from queuecraft.functions import bands, features, labels
from queuecraft.operators import validate
from queuecraft.plans import views
from queuecraft.session import staged

RISKY = {
    "PolicyNumber": 1, "FraudFound_P": 1, "Age": 23, "Deductible": 400, "WeekOfMonth": 1, "WeekOfMonthClaimed": 4, "RepNumber": 3,
    "DriverRating": 1, "Year": 1994, "Month": "Dec", "MonthClaimed": "Jan", "DayOfWeek": "Saturday", "DayOfWeekClaimed": "Monday",
    "Sex": "Male", "MaritalStatus": "Single", "Fault": "Policy Holder", "VehicleCategory": "Sport", "BasePolicy": "Liability",
    "PoliceReportFiled": "No", "WitnessPresent": "No", "AgentType": "External", "AccidentArea": "Urban", "PastNumberOfClaims": "2 to 4",
    "AgeOfVehicle": "3 years", "AgeOfPolicyHolder": "21 to 25", "NumberOfSuppliments": "3 to 5", "AddressChange_Claim": "under 6 months",
    "NumberOfCars": "3 to 4", "Days_Policy_Accident": "none", "Days_Policy_Claim": "8 to 15", "VehiclePrice": "more than 69000",
    "Make": "Honda", "PolicyType": "Sport - Liability"}
CALM = {**RISKY, "PolicyNumber": 2, "Age": 50, "Deductible": 300, "DayOfWeek": "Monday", "Fault": "Third Party", "VehicleCategory": "Sedan",
        "BasePolicy": "Collision", "PoliceReportFiled": "Yes", "WitnessPresent": "Yes", "AgentType": "Internal", "PastNumberOfClaims": "none",
        "NumberOfSuppliments": "none", "AddressChange_Claim": "no change", "Days_Policy_Accident": "more than 30", "VehiclePrice": "20000 to 29000"}
UNKNOWN = {k: (None if isinstance(v, str) or k in ("Age", "Deductible") else v) for k, v in RISKY.items()} | {"PolicyNumber": 3}


@pytest.fixture(scope="module")
def made(spark, sf):
    schema = views.claims(spark, sf).schema
    for f in schema.fields:
        f.nullable = True
    df = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in (RISKY, CALM, UNKNOWN)], schema)
    return {r["PolicyNumber"]: r for r in features.engineer(df).collect()}


def test_all_columns_in_order(made):
    names = list(made[1].asDict())
    assert names[-len(features.ENGINEERED):] == features.ENGINEERED and len(features.ENGINEERED) == 41
    assert names[:len(RISKY)] == list(made[1].asDict())[:33]


def test_risky_row(made):
    r = made[1]
    assert (r["Days_Policy_Accident_Num"], r["Days_Policy_Claim_Num"], r["PastNumberOfClaims_Num"]) == (0.0, 12.0, 3.0)
    assert (r["VehiclePrice_Num"], r["NumberOfCars_Num"], r["AddressChange_Claim_Num"]) == (80000.0, 3.5, 0.25)
    assert (r["Month_Num"], r["MonthClaimed_Num"], r["MonthGap"], r["WeekGap"]) == (12, 1, 1, 3)
    assert (r["DayOfWeek_Num"], r["DayOfWeekClaimed_Num"], r["SameDayOfWeek"], r["WeekendAccident"], r["WeekendClaim"]) == (5, 0, 0, 1, 0)
    assert r["Age_x_Deductible"] == 9200.0 and r["PriceToDeductible"] == pytest.approx(80000 / 401)
    for name in features.COUNTED_FLAGS:
        assert r[name] == 1, name
    assert r["RiskFlagCount"] == 14 and r["EarlyClaimFlag"] == 1 and r["Fault_NoPolice"] == 1


def test_calm_row_raises_no_flag(made):
    r = made[2]
    for name in [*features.GUIDELINE, *features.COUNTED_FLAGS, "NoReportNoWitness"]:
        assert r[name] == 0, name
    assert r["RiskFlagCount"] == 0


def test_unknown_values(made):
    r = made[3]
    for name in features.ORDINAL + features.CALENDAR + ["MonthGap", "Age_x_Deductible", "PriceToDeductible"]:
        assert r[name] is None, name
    for name in features.FLAGS + features.GUIDELINE + ["SameDayOfWeek"]:
        assert r[name] == (1 if name == "HasPastClaims" else 0), name       # an unknown history counts as one


def test_engineering_is_narrow(spark, sf):
    plan = plan_of(features.engineer(views.claims(spark, sf)))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("age,band", [(16, "16 to 17"), (17, "16 to 17"), (18, "18 to 20"), (20, "18 to 20"), (21, "21 to 25"), (25, "21 to 25"),
                                      (26, "26 to 30"), (30, "26 to 30"), (31, "31 to 35"), (35, "31 to 35"), (36, "36 to 40"), (40, "36 to 40"),
                                      (41, "41 to 50"), (50, "41 to 50"), (51, "51 to 65"), (65, "51 to 65"), (66, "over 65"), (90, "over 65")])
def test_holder_band_edges(spark, age, band):
    assert spark.range(1).select(bands.holder_band(F.lit(age)).alias("b")).first()["b"] == band


def test_age_groups(spark):
    ages = [0, 16, 25, 26, 35, 36, 50, 51, 65, 66, 90, 121, None]
    want = [bands.AGE_UNKNOWN, "16-25", "16-25", "26-35", "26-35", "36-50", "36-50", "51-65", "51-65", "65+", "65+", bands.AGE_UNKNOWN, bands.AGE_UNKNOWN]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, a int")
    assert [r["g"] for r in df.select("i", bands.age_group(F.col("a")).alias("g")).orderBy("i").collect()] == want


def test_age_imputation(spark):
    df = spark.createDataFrame([(0, "16 to 17"), (0, "over 65"), (0, None), (44, "16 to 17"), (0, "odd")], "Age int, AgeOfPolicyHolder string")
    out = features.impute_age(df)
    assert [r["Age"] for r in out.collect()] == [16.5, 70.0, 16.5, 44.0, 16.5] and dict(out.dtypes)["Age"] == "double"
    assert [r["Age"] for r in features.impute_age(df.select("Age")).collect()] == [16.5, 16.5, 16.5, 44.0, 16.5]


def text_of(spark, name, value, cats=()):
    v = None if value is None else F.lit(float(value))
    return spark.range(1).select(labels.feature_text(F.lit(name), v, list(cats)).alias("t")).first()["t"]


def test_feature_wording(spark):
    cats = ["AddressChange_Claim", "AddressChange", "BasePolicy"]
    assert text_of(spark, "AddressChange_Claim_2 to 3 years", 1, cats) == "address change claim is 2 to 3 years"
    assert text_of(spark, "BasePolicy_Liability", 0, cats) == "base policy is not Liability"
    assert text_of(spark, "BasePolicy_Liability", None, cats) == "base policy = 'Liability'"
    assert text_of(spark, "Age_x_Deductible", 5, cats) == "age combined with deductible"
    assert text_of(spark, "someNewThing_x_Other", 5, cats) == "some new thing x other"


@pytest.mark.parametrize("value,word", [(0.51, "[STRONG] High risk"), (-0.5, "[MODERATE] Low risk"), (0.2, "[MILD] High risk"), (-0.21, "[MODERATE] Low risk"), (0.0, "[MILD] Low risk")])
def test_reason_words(spark, value, word):
    got = spark.range(1).select(labels.reason_code(F.lit("Age"), F.lit(value), F.lit("policyholder age")).alias("t")).first()["t"]
    assert got == f"{word}: policyholder age [Age] (SHAP: {value:+.4f})"


def test_defaults_are_filled_and_disclosed(spark, sf):
    df = views.claims(spark, sf).drop("Make", "Year", "AgeOfPolicyHolder", "PolicyType")
    r = validate.fill_defaults(df).filter("Age = 70").first()
    assert (r["Make"], r["Year"], r["AgeOfPolicyHolder"]) == ("Honda", 1996, "over 65")
    assert r["PolicyType"] == f"{r['VehicleCategory']} - {r['BasePolicy']}" or r["BasePolicy"] is None
    assert {"Make", "Year", "AgeOfPolicyHolder", "PolicyType"} <= set(r["defaults_applied"])


def test_schema_check(spark, sf):
    df = views.claims(spark, sf)
    assert validate.check_schema(df.withColumn("extra", F.lit(1)), df.schema) == []
    broken = df.drop("Sex").withColumn("Age", F.col("Age").cast("double"))
    assert sorted(validate.check_schema(broken, df.schema)) == ["Age is double, declared int", "missing column Sex"]
    assert validate.unknown_fields([*df.columns, "Deductable"]) == ["Deductable"]


def test_quarantine_splits_all_rows(spark, sf):
    df = staged(views.claims(spark, sf))        # stored columns, as a real table has them
    good, bad = validate.split_good_bad(df, validate.claim_rules())
    assert good.count() + bad.count() == df.count() and good.columns == df.columns
    assert bad.filter(F.array_contains("reasons", "Age:range")).filter("Age >= 16").count() == 0


def test_column_roles(spark, sf):
    cats, nums = validate.column_roles(views.claims(spark, sf))
    assert "Sex" in cats and "Age" in nums and not set(cats) & set(nums)


def test_rows_of_a_frequent_name_stay_where_they_are(spark):
    df = spark.createDataFrame([("BasePolicy_Liability", 1.0)] * 50 + [("BasePolicy_x_y", None), ("Age", 3.0), (None, 1.0)], "feature string, value double")
    known = spark.createDataFrame([("BasePolicy",), ("BasePolicy_x",)], "column_name string")
    got = labels.with_feature_text(df, "feature", "value", known)
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    texts = [r["text"] for r in got.collect()]
    assert texts.count("base policy is Liability") == 50 and "base policy x = 'y'" in texts and len(texts) == 53
