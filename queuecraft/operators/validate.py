"""Rule checks over a table: counted in one aggregation, listed row by row, or split off."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from queuecraft.functions import bands


@dataclass(frozen=True)
class Rule:
    """A named check on one column. ``kind`` is domain, range or not_null."""

    column: str
    kind: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    low_open: bool = False

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"

    def violated(self) -> Column:
        """True on a violation. A null breaks only the not_null rule."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "domain":
            return F.coalesce(~c.isin(list(self.values)), F.lit(False))
        bad = F.lit(False)
        if self.low is not None:
            bad = bad | ((c <= self.low) if self.low_open else (c < self.low))
        if self.high is not None:
            bad = bad | (c > self.high)
        return F.coalesce(bad, F.lit(False))


def domain(column: str, *values) -> Rule:
    return Rule(column, "domain", tuple(values))


def between(column: str, low=None, high=None, low_open: bool = False) -> Rule:
    return Rule(column, "range", (), low, high, low_open)


def not_null(column: str) -> Rule:
    return Rule(column, "not_null")


# Closed domains and bounds of the claims table.
CLAIM_DOMAINS = {
    "FraudFound_P": [0, 1],
    "Deductible": [300, 400, 500, 700],
    "Month": list(bands.MONTHS),
    "DayOfWeek": list(bands.WEEKDAYS),
    "DayOfWeekClaimed": list(bands.WEEKDAYS),
    "MonthClaimed": list(bands.MONTHS),
    "Sex": ["Male", "Female"],
    "MaritalStatus": ["Single", "Married", "Widow", "Divorced"],
    "Fault": ["Policy Holder", "Third Party"],
    "VehicleCategory": ["Sedan", "Sport", "Utility"],
    "BasePolicy": ["Liability", "Collision", "All Perils"],
    "PoliceReportFiled": ["Yes", "No"],
    "WitnessPresent": ["Yes", "No"],
    "AgentType": ["External", "Internal"],
    "AccidentArea": ["Urban", "Rural"],
    **{c: list(numbers) for c, numbers in bands.BAND_COLUMNS.items()},
}
CLAIM_RANGES = {"Age": (16, 100), "WeekOfMonth": (1, 5), "WeekOfMonthClaimed": (1, 5), "DriverRating": (1, 4)}
CLAIM_UNCHECKED = ["RepNumber", "Year"]
OPTIONAL_FIELDS = ["Make", "RepNumber", "DriverRating", "WeekOfMonth", "WeekOfMonthClaimed", "NumberOfCars", "Year",
                   "PolicyType", "AgeOfPolicyHolder"]
MIN_ROWS = 100
MAX_POSITIVE_RATE = 0.5


def claim_rules() -> list[Rule]:
    rules = [between("PolicyNumber", low=0, low_open=True)]
    rules += [domain(c, *values) for c, values in CLAIM_DOMAINS.items()]
    rules += [between(c, low, high) for c, (low, high) in CLAIM_RANGES.items()]
    declared = ["PolicyNumber", *CLAIM_DOMAINS, *CLAIM_RANGES, *CLAIM_UNCHECKED]
    return rules + [not_null(c) for c in declared]


def check_schema(df: DataFrame, declared: StructType) -> list[str]:
    """Missing columns and wrong types, from metadata alone. Extra columns are allowed."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"missing column {f.name}" for f in declared.fields if f.name not in have]
    return problems + [f"{f.name} is {have[f.name].simpleString()}, declared {f.dataType.simpleString()}"
                       for f in declared.fields if f.name in have and have[f.name] != f.dataType]


def count_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its violation count: one aggregation for all rules."""
    line = lambda r: F.struct(F.lit(r.column).alias("column_name"), F.lit(r.kind).alias("check_name"),
                              F.count(F.when(r.violated(), 1)).alias("violations"))
    return df.agg(F.array(*map(line, rules)).alias("_r")).select(F.inline("_r"))


def any_violation(rules: Sequence[Rule]) -> Column:
    """One flat condition, so a filter on it can run beside the scan."""
    return reduce(lambda a, b: a | b, [r.violated() for r in rules])


def reasons(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules of a row, empty when it is good."""
    listed = F.concat_ws(",", *[F.when(r.violated(), F.lit(r.name)) for r in rules])
    return F.array_remove(F.split(listed, ","), "")


def failure_cases(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """Every violation as (key, column, check, value): all failures, not the first. Good rows go no further."""
    case = lambda r: F.when(r.violated(), F.struct(
        F.lit(r.column).alias("column_name"), F.lit(r.kind).alias("check_name"),
        F.col(r.column).cast("string").alias("failing_value")))
    bad = df.filter(any_violation(rules))
    return bad.select(key, F.inline(F.array(*map(case, rules)))).filter(F.col("check_name").isNotNull())


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Each row with ``accepted`` and the ``reasons`` against it."""
    return df.withColumns({"reasons": reasons(rules), "accepted": ~any_violation(rules)})


def split_good_bad(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """The rows that keep all rules, and the others with their reasons."""
    bad = any_violation(rules)
    return df.filter(~bad), df.filter(bad).withColumn("reasons", reasons(rules))


def record_rules(columns: Sequence[str]) -> list[Rule]:
    """Strict rules of a single record: required fields present, closed categories, bounds."""
    present = set(columns)
    rules = [r for r in claim_rules() if r.column in present and r.kind != "not_null"]
    required = [c for c in [*CLAIM_DOMAINS, *CLAIM_RANGES]
                if c in present and c not in OPTIONAL_FIELDS and c != "FraudFound_P"]
    return rules + [not_null(c) for c in required]


def unknown_fields(columns: Sequence[str]) -> list[str]:
    """Field names a strict record may not carry."""
    known = {"PolicyNumber", *CLAIM_DOMAINS, *CLAIM_RANGES, *CLAIM_UNCHECKED, *OPTIONAL_FIELDS}
    return [c for c in columns if c not in known]


def dataset_checks(df: DataFrame, label: str, min_rows: int = MIN_ROWS, max_rate: float = MAX_POSITIVE_RATE) -> DataFrame:
    both = df.agg(F.count("*").alias("_n"), F.avg(label).alias("_r"))
    line = lambda name, ok: F.struct(F.lit(name).alias("check_name"), F.coalesce(ok, F.lit(False)).alias("passed"))
    return both.select(F.inline(F.array(line("row_count", F.col("_n") > min_rows),
                                        line("positive_rate", F.col("_r") < max_rate))))


def report(df: DataFrame, label: str, rules: Sequence[tuple[str, Rule]], duplicate_rows: DataFrame,
           min_rows: int = MIN_ROWS, max_rate: float = MAX_POSITIVE_RATE) -> DataFrame:
    """Named pass/fail lines plus the overall flag; never raises.

    Of a failing rule nulls count as failures too. ``duplicate_rows`` is the one-row frame of
    ``profile.duplicate_rows``.
    """
    missing = F.lit(0)
    for c in df.columns:
        missing = missing + F.col(c).isNull().cast("long")
    fails = lambda r: F.count(F.when(r.violated() | F.col(r.column).isNull(), 1))
    sums = df.agg(F.count("*").alias("_n"), F.avg(label).alias("_rate"), F.coalesce(F.sum(missing), F.lit(0)).alias("_missing"),
                  *[fails(r).alias(f"_f{i}") for i, (_, r) in enumerate(rules)], F.lit(1).alias("_one"))
    one = sums.join(duplicate_rows.select("duplicate_rows", F.lit(1).alias("_one")), "_one")   # one row each
    checks = [("Row count", F.col("_n") > min_rows), ("No duplicate rows", F.col("duplicate_rows") == 0),
              ("No missing values", F.col("_missing") == 0), ("Positive rate", F.col("_rate") < max_rate)]
    checks += [(name, F.col(f"_f{i}") == 0) for i, (name, _) in enumerate(rules)]
    passed = [F.coalesce(ok, F.lit(False)) for _, ok in checks]
    all_ok = passed[0]
    for ok in passed[1:]:
        all_ok = all_ok & ok
    lines = [F.struct(F.lit(name).alias("check_name"), ok.alias("passed")) for (name, _), ok in zip(checks, passed)]
    lines.append(F.struct(F.lit("All checks").alias("check_name"), all_ok.alias("passed")))
    return one.select(F.inline(F.array(*lines)))


def align(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Exactly the wanted columns: missing categorical ones as "Unknown", missing numeric ones as 0."""
    have = set(df.columns)
    cats = [F.col(c) if c in have else F.lit("Unknown").alias(c) for c in categorical]
    nums = [F.col(c) if c in have else F.lit(0).alias(c) for c in numeric]
    return df.select(*cats, *nums)


# Defaults of optional fields.
FIELD_DEFAULTS = {"Make": "Honda", "RepNumber": 5, "DriverRating": 3, "WeekOfMonth": 2, "WeekOfMonthClaimed": 2,
                  "NumberOfCars": "1 vehicle", "Year": 1996}


def fill_defaults(df: DataFrame) -> DataFrame:
    """Fill the optional fields and disclose which ones were filled in ``defaults_applied``."""
    have = set(df.columns)
    kinds = {"Make": "string", "NumberOfCars": "string", "PolicyType": "string", "AgeOfPolicyHolder": "string"}
    given = df.withColumns({c: F.lit(None).cast(kinds.get(c, "int")) for c in OPTIONAL_FIELDS if c not in have})
    fill = {c: F.lit(v) for c, v in FIELD_DEFAULTS.items()}
    fill["PolicyType"] = F.concat_ws(" - ", "VehicleCategory", "BasePolicy")
    fill["AgeOfPolicyHolder"] = bands.holder_band(F.col("Age"))
    used = F.create_map(*[x for c, v in fill.items()
                          for x in (F.lit(c), F.when(F.col(c).isNull(), v.cast("string")))])
    return given.withColumn("defaults_applied", F.map_filter(used, lambda _, v: v.isNotNull())).withColumns(
        {c: F.coalesce(F.col(c), v) for c, v in fill.items()})


def column_roles(df: DataFrame) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names by declared type."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    kinds = dict(df.dtypes)
    return ([c for c, t in kinds.items() if t == "string"],
            [c for c, t in kinds.items() if t in numeric or t.startswith("decimal")])
