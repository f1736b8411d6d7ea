"""Text bands of the claims table, their numbers, and numeric ranges cut into bands."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number of each band, in domain order.
DAYS = {"none": 0, "1 to 7": 4, "8 to 15": 12, "15 to 30": 22, "more than 30": 45}
PAST_CLAIMS = {"none": 0, "1": 1, "2 to 4": 3, "more than 4": 6}
VEHICLE_AGE = {"new": 0, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5, "6 years": 6, "7 years": 7,
               "more than 7": 10}
HOLDER_AGE = {"16 to 17": 16.5, "18 to 20": 19, "21 to 25": 23, "26 to 30": 28, "31 to 35": 33, "36 to 40": 38,
              "41 to 50": 45.5, "51 to 65": 58, "over 65": 70}
SUPPLEMENTS = {"none": 0, "1 to 2": 1.5, "3 to 5": 4, "more than 5": 7}
CARS = {"1 vehicle": 1, "2 vehicles": 2, "3 to 4": 3.5, "5 to 8": 6.5, "more than 8": 10}
ADDRESS_CHANGE = {"no change": 0, "under 6 months": 0.25, "1 year": 1, "2 to 3 years": 2.5, "4 to 8 years": 6}
VEHICLE_PRICE = {"less than 20000": 15000, "20000 to 29000": 25000, "30000 to 39000": 35000, "40000 to 59000": 50000,
                 "60000 to 69000": 65000, "more than 69000": 80000}
MONTHS = {"Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "May": 5, "Jun": 6, "Jul": 7, "Aug": 8, "Sep": 9, "Oct": 10,
          "Nov": 11, "Dec": 12}
WEEKDAYS = {"Monday": 0, "Tuesday": 1, "Wednesday": 2, "Thursday": 3, "Friday": 4, "Saturday": 5, "Sunday": 6}

# Which band each column uses, in feature order.
BAND_COLUMNS = {
    "Days_Policy_Accident": DAYS, "Days_Policy_Claim": DAYS, "PastNumberOfClaims": PAST_CLAIMS,
    "AgeOfVehicle": VEHICLE_AGE, "AgeOfPolicyHolder": HOLDER_AGE, "NumberOfSuppliments": SUPPLEMENTS,
    "NumberOfCars": CARS, "AddressChange_Claim": ADDRESS_CHANGE, "VehiclePrice": VEHICLE_PRICE,
}
# Upper ages of the holder bands; reporting groups as (over, up to, name).
HOLDER_AGE_UPPER = [17, 20, 25, 30, 35, 40, 50, 65]
AGE_GROUPS = [(0, 25, "16-25"), (25, 35, "26-35"), (35, 50, "36-50"), (50, 65, "51-65"), (65, 120, "65+")]
AGE_UNKNOWN = "Unknown (age not recorded)"
YOUNGEST_AGE = 16.5


def band_number(column: Column | str, numbers: Mapping[str, float]) -> Column:
    """Number of a band; null for a null or unknown band."""
    pairs = [F.lit(x) for band, number in numbers.items() for x in (band, float(number))]
    return F.create_map(*pairs)[F.col(column) if isinstance(column, str) else column]


def month_number(column) -> Column:
    return band_number(column, MONTHS).cast("int")


def weekday_number(column) -> Column:
    return band_number(column, WEEKDAYS).cast("int")


def holder_band(age: Column) -> Column:
    """Age to its band, upper ages inside."""
    names = list(HOLDER_AGE)
    band = F.when(age.isNull(), F.lit(None))
    for upper, name in zip(HOLDER_AGE_UPPER, names):
        band = band.when(age <= upper, name)
    return band.otherwise(names[-1])


def age_group(age: Column) -> Column:
    """Age to its reporting group; null and out-of-range ages are named unknown."""
    group = F.when(age.isNull(), AGE_UNKNOWN)
    for over, upto, name in AGE_GROUPS:
        group = group.when((age > over) & (age <= upto), name)
    return group.otherwise(AGE_UNKNOWN)


def age_or_band_midpoint(age: Column, band: Column | None) -> Column:
    """Age with the 0 sentinel replaced by its band's midpoint, else by the youngest age."""
    midpoint = band_number(band, HOLDER_AGE) if band is not None else F.lit(None).cast("double")
    return F.when(age == 0, F.coalesce(midpoint, F.lit(YOUNGEST_AGE))).otherwise(age.cast("double"))
