"""Readable names for features, and the reason text built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuecraft.session import written


# Readable feature names.
FEATURE_LABELS = {
    "Days_Policy_Accident_Num": "days from policy start to accident",
    "Days_Policy_Claim_Num": "days from policy start to claim",
    "PastNumberOfClaims_Num": "number of past claims",
    "AgeOfVehicle_Num": "vehicle age",
    "AgeOfPolicyHolder_Num": "policyholder age band",
    "NumberOfSuppliments_Num": "number of supplements claimed",
    "NumberOfCars_Num": "number of vehicles on the policy",
    "AddressChange_Claim_Num": "time since the last address change",
    "VehiclePrice_Num": "vehicle price",
    "Month_Num": "month of accident",
    "MonthClaimed_Num": "month claim was filed",
    "DayOfWeek_Num": "day of week of accident",
    "DayOfWeekClaimed_Num": "day of week claim was filed",
    "WeekGap": "weeks between accident and claim",
    "MonthGap": "months between accident and claim",
    "SameDayOfWeek": "accident and claim fell on the same weekday",
    "WeekendAccident": "accident happened at the weekend",
    "WeekendClaim": "claim filed at the weekend",
    "NoPoliceReport": "no police report filed",
    "NoWitness": "no witness present",
    "NoReportNoWitness": "neither a police report nor a witness",
    "PolicyHolderFault": "policyholder was at fault",
    "ExternalAgent": "claim handled by an external agent",
    "HighDeductible": "high deductible",
    "YoungDriver": "driver aged 25 or under",
    "HasPastClaims": "has prior claims",
    "RecentAddressChange": "address changed within the past year",
    "Age_x_Deductible": "age combined with deductible",
    "Fault_NoPolice": "at fault with no police report",
    "PriceToDeductible": "vehicle price relative to deductible",
    "Age_x_PastClaims": "age combined with prior claim count",
    "Cars_x_Suppliments": "vehicle count combined with supplements",
    "PolicyAge_x_ClaimDelay": "policy age combined with claim delay",
    "Liability_NoPolice": "liability-only cover with no police report",
    "HighValue_Liability": "high-value vehicle on liability-only cover",
    "Sport_YoungDriver": "sports vehicle with a driver aged 25 or under",
    "VeryEarlyClaimFlag": "accident within days of the policy starting",
    "EarlyClaimFlag": "accident within the first week of cover",
    "HighSupplements": "three or more supplements claimed",
    "ExternalAgent_NoPolice": "external agent with no police report",
    "RiskFlagCount": "total number of risk flags raised",
    "Age": "policyholder age",
    "Deductible": "deductible amount",
    "DriverRating": "driver rating",
    "RepNumber": "claims representative",
    "Year": "policy year",
    "WeekOfMonth": "week of month of accident",
    "WeekOfMonthClaimed": "week of month claim was filed",
    "BasePolicy": "base policy",
    "PolicyType": "policy type",
    "VehicleCategory": "vehicle category",
    "Make": "vehicle make",
    "AccidentArea": "accident area",
    "Sex": "sex",
    "MaritalStatus": "marital status",
}


def prettify(name: Column) -> Column:
    """Readable fallback: underscores and camel case to words."""
    spaced = F.replace(F.replace(name, F.lit("_x_"), F.lit(" x ")), F.lit("_"), F.lit(" "))
    return F.trim(F.lower(F.regexp_replace(spaced, "(?<=[a-z0-9])(?=[A-Z])", " ")))


def plain_label(name: Column) -> Column:
    pairs = [F.lit(x) for pair in FEATURE_LABELS.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[name], prettify(name))


def feature_text(name: Column, value: Column | None, categorical: Sequence[str]) -> Column:
    """Readable feature; a one-hot column is worded by whether this row has the level.

    The list of categorical columns is schema, so the longest-prefix search is a chain of tests
    tried longest first, and needs no join.
    """
    text = F.when(F.lit(False), "")
    for column in sorted(categorical, key=len, reverse=True):
        level = F.substring(name, F.lit(len(column) + 2), F.length(name))
        label = plain_label(F.lit(column))
        neutral = F.concat(label, F.lit(" = '"), level, F.lit("'"))
        if value is None:
            worded = neutral
        else:
            worded = (F.when(value.isNull(), neutral).when(value > 0.5, F.concat(label, F.lit(" is "), level))
                      .otherwise(F.concat(label, F.lit(" is not "), level)))
        text = text.when(F.startswith(name, F.lit(column + "_")), worded)
    return text.otherwise(plain_label(name))


def with_feature_text(df: DataFrame, name: str, value: str, categorical: DataFrame, out: str = "text") -> DataFrame:
    """The same for a categorical list that is itself a table (column ``column_name``).

    Every way to cut the name before an underscore is a candidate prefix, so the prefix search is an
    equi-join on the candidate, and the longest match is kept. Candidates per name are bounded by its length.
    """
    pieces = F.split(F.col(name), "_")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.array_join(F.slice(pieces, 1, i), "_"))
    names = df.select(name).distinct().withColumn("_prefix", F.explode(prefixes))
    names = names.filter(F.length("_prefix") < F.length(name))
    known = categorical.select(F.col("column_name").alias("_prefix")).distinct()
    longest = names.join(known, "_prefix").groupBy(name).agg(F.max_by("_prefix", F.length("_prefix")).alias("_prefix"))
    # written first: the planner sees how few names there are and gives them to every task, so that the rows of a frequent
    # name stay where they are
    joined = df.join(written(longest), name, "left")
    level = F.substring(F.col(name), F.length("_prefix") + 2, F.length(name))
    label = plain_label(F.col("_prefix"))
    hot = (F.when(F.col(value).isNull(), F.concat(label, F.lit(" = '"), level, F.lit("'")))
           .when(F.col(value) > 0.5, F.concat(label, F.lit(" is "), level))
           .otherwise(F.concat(label, F.lit(" is not "), level)))
    return joined.withColumn(out, F.when(F.col("_prefix").isNotNull(), hot).otherwise(plain_label(F.col(name)))).drop("_prefix")


def direction(contribution: Column) -> Column:
    return F.when(contribution > 0, "High risk").otherwise("Low risk")


def intensity(contribution: Column) -> Column:
    size = F.abs(contribution)
    return F.when(size > 0.5, "STRONG").when(size > 0.2, "MODERATE").otherwise("MILD")


def signed(contribution: Column) -> Column:
    return F.format_string("%+.4f", contribution)


def reason_code(name: Column, contribution: Column, text: Column) -> Column:
    return F.concat(F.lit("["), intensity(contribution), F.lit("] "), direction(contribution), F.lit(": "), text,
                    F.lit(" ["), name, F.lit("] (SHAP: "), signed(contribution), F.lit(")"))


def risk_level(score: Column) -> Column:
    return F.when(score >= 0.5, "HIGH").when(score >= 0.3, "ELEVATED").when(score >= 0.1, "MODERATE").otherwise("LOW")


def percent_text(share: Column) -> Column:
    return F.concat(F.format_string("%.1f", share * 100), F.lit("%"))


def times_text(ratio: Column) -> Column:
    return F.concat(F.format_string("%.1f", ratio), F.lit("×"))


def money_text(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def guarded_ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)
