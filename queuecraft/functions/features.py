"""Row-local features of a claims table: narrow expressions in three dependency levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuecraft.functions import bands

# Thresholds of the flags.
HIGH_DEDUCTIBLE = 400
YOUNG_AGE = 25
HIGH_PRICE = 60000
MANY_SUPPLEMENTS = 4

# Feature groups in output order.
ORDINAL = [f"{c}_Num" for c in bands.BAND_COLUMNS]
CALENDAR = ["Month_Num", "MonthClaimed_Num", "DayOfWeek_Num", "DayOfWeekClaimed_Num"]
TIMING = ["WeekGap", "MonthGap", "SameDayOfWeek"]
FLAGS = ["WeekendAccident", "WeekendClaim", "NoPoliceReport", "NoWitness", "NoReportNoWitness", "PolicyHolderFault",
         "ExternalAgent", "HighDeductible", "YoungDriver", "HasPastClaims", "RecentAddressChange"]
INTERACTIONS = ["Age_x_Deductible", "Fault_NoPolice", "PriceToDeductible", "Age_x_PastClaims", "Cars_x_Suppliments",
                "PolicyAge_x_ClaimDelay"]
GUIDELINE = ["Liability_NoPolice", "HighValue_Liability", "Sport_YoungDriver", "VeryEarlyClaimFlag", "EarlyClaimFlag",
             "HighSupplements", "ExternalAgent_NoPolice"]
ENGINEERED = [*ORDINAL, *CALENDAR, *TIMING, *FLAGS, *INTERACTIONS, *GUIDELINE, "RiskFlagCount"]
COUNTED_FLAGS = ["NoPoliceReport", "NoWitness", "PolicyHolderFault", "ExternalAgent", "HighDeductible", "YoungDriver",
                 "HasPastClaims", "RecentAddressChange", "Liability_NoPolice", "HighValue_Liability",
                 "Sport_YoungDriver", "VeryEarlyClaimFlag", "HighSupplements", "ExternalAgent_NoPolice"]
REPLACED_COLUMNS = ["Days_Policy_Accident", "Days_Policy_Claim", "PastNumberOfClaims", "AgeOfVehicle",
                    "AgeOfPolicyHolder", "NumberOfSuppliments", "NumberOfCars", "AddressChange_Claim", "VehiclePrice",
                    "Month", "MonthClaimed", "DayOfWeek", "DayOfWeekClaimed", "PoliceReportFiled", "WitnessPresent",
                    "AgentType", "Fault"]


def flag(condition: Column) -> Column:
    """0/1; an unknown condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def circular_gap(a: Column, b: Column, period: int = 12) -> Column:
    """Distance on a circle; null unless both are known."""
    gap = F.abs(a - b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(gap, period - gap))


def _c(name: str) -> Column:
    return F.col(name)


def ordinal_columns() -> dict[str, Column]:
    return {f"{c}_Num": bands.band_number(c, numbers) for c, numbers in bands.BAND_COLUMNS.items()}


def calendar_columns() -> dict[str, Column]:
    return {"Month_Num": bands.month_number("Month"), "MonthClaimed_Num": bands.month_number("MonthClaimed"),
            "DayOfWeek_Num": bands.weekday_number("DayOfWeek"),
            "DayOfWeekClaimed_Num": bands.weekday_number("DayOfWeekClaimed")}


def basic_flag_columns() -> dict[str, Column]:
    weekend = ["Saturday", "Sunday"]
    return {
        "WeekendAccident": flag(_c("DayOfWeek").isin(weekend)),
        "WeekendClaim": flag(_c("DayOfWeekClaimed").isin(weekend)),
        "NoPoliceReport": flag(_c("PoliceReportFiled") == "No"),
        "NoWitness": flag(_c("WitnessPresent") == "No"),
        "NoReportNoWitness": flag((_c("PoliceReportFiled") == "No") & (_c("WitnessPresent") == "No")),
        "PolicyHolderFault": flag(_c("Fault") == "Policy Holder"),
        "ExternalAgent": flag(_c("AgentType") == "External"),
        "HighDeductible": flag(_c("Deductible") >= HIGH_DEDUCTIBLE),
        "YoungDriver": flag(_c("Age") <= YOUNG_AGE),
        # an unknown history counts as a history
        "HasPastClaims": (~_c("PastNumberOfClaims").eqNullSafe("none")).cast("int"),
        "RecentAddressChange": flag(_c("AddressChange_Claim").isin("under 6 months", "1 year")),
    }


def timing_columns() -> dict[str, Column]:
    """Needs the calendar columns."""
    return {"WeekGap": F.abs(_c("WeekOfMonthClaimed") - _c("WeekOfMonth")),
            "MonthGap": circular_gap(_c("Month_Num"), _c("MonthClaimed_Num")),
            "SameDayOfWeek": flag(_c("DayOfWeek") == _c("DayOfWeekClaimed"))}


def interaction_columns() -> dict[str, Column]:
    """Needs the ordinal and flag columns; nulls pass through."""
    return {
        "Age_x_Deductible": (_c("Age") * _c("Deductible")).cast("double"),
        "Fault_NoPolice": _c("PolicyHolderFault") * _c("NoPoliceReport"),
        "PriceToDeductible": _c("VehiclePrice_Num") / (_c("Deductible") + 1),
        "Age_x_PastClaims": _c("Age") * _c("PastNumberOfClaims_Num"),
        "Cars_x_Suppliments": _c("NumberOfCars_Num") * _c("NumberOfSuppliments_Num"),
        "PolicyAge_x_ClaimDelay": _c("Days_Policy_Accident_Num") * _c("Days_Policy_Claim_Num"),
    }


def guideline_columns() -> dict[str, Column]:
    """Needs the ordinal and flag columns."""
    liability = _c("BasePolicy") == "Liability"
    return {
        "Liability_NoPolice": flag(liability & (_c("PoliceReportFiled") == "No")),
        "HighValue_Liability": flag(liability & (_c("VehiclePrice_Num") >= HIGH_PRICE)),
        "Sport_YoungDriver": flag((_c("VehicleCategory") == "Sport") & (_c("YoungDriver") == 1)),
        "VeryEarlyClaimFlag": flag(_c("Days_Policy_Accident") == "none"),
        "EarlyClaimFlag": flag(_c("Days_Policy_Accident").isin("none", "1 to 7")),
        "HighSupplements": flag(_c("NumberOfSuppliments_Num") >= MANY_SUPPLEMENTS),
        "ExternalAgent_NoPolice": _c("ExternalAgent") * _c("NoPoliceReport"),
    }


def risk_flag_count() -> Column:
    total = _c(COUNTED_FLAGS[0])
    for name in COUNTED_FLAGS[1:]:
        total = total + _c(name)
    return total


def engineer(claims: DataFrame) -> DataFrame:
    """All features next to the original columns, in feature order. No shuffle, no Python worker."""
    wide = (claims.withColumns({**ordinal_columns(), **calendar_columns(), **basic_flag_columns()})
            .withColumns({**timing_columns(), **interaction_columns(), **guideline_columns()})
            .withColumn("RiskFlagCount", risk_flag_count()))
    return wide.select(*claims.columns, *ENGINEERED)


def impute_age(claims: DataFrame) -> DataFrame:
    """Replace the age sentinel; the column widens to double."""
    if "Age" not in claims.columns:
        return claims
    band = _c("AgeOfPolicyHolder") if "AgeOfPolicyHolder" in claims.columns else None
    return claims.withColumn("Age", bands.age_or_band_midpoint(_c("Age"), band))


def drop_replaced(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in REPLACED_COLUMNS if c in df.columns])
