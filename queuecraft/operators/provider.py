"""Provider matrix: claim aggregates per provider, joined to labels and derived ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuecraft.functions.labels import guarded_ratio


def _known(df: DataFrame, *keys: str) -> DataFrame:
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def claim_aggregate(claims: DataFrame, side: str, key: str = "provider", amount: str = "amount", patient: str = "patient",
                    claim: str = "claim", deductible: str | None = None, physician: str | None = None) -> DataFrame:
    """Counts, amounts and distinct parties per provider; columns end in ``_<side>``.

    Distinct parties are counted over (provider, party) pairs, so a provider with a large share of the
    claims is spread by party and combined on the map side.
    """
    rows = _known(claims, key)
    out = rows.groupBy(key).agg(
        F.count(claim).alias(f"claims_{side}"), F.avg(amount).alias(f"avg_amount_{side}"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias(f"total_amount_{side}"), F.max(amount).alias(f"max_amount_{side}"),
        *([F.avg(deductible).alias(f"avg_deductible_{side}")] if deductible else []),
        F.count_distinct(patient).alias(f"patients_{side}"),
        *([F.count_distinct(physician).alias(f"physicians_{side}")] if physician else []))
    return out


def patient_aggregate(claims: DataFrame, patients: DataFrame, conditions: Sequence[str], key: str = "provider",
                      patient: str = "patient") -> DataFrame:
    """Means over a provider's distinct patients, from the claims table that links them."""
    pairs = _known(claims, key, patient).select(key, patient).distinct()
    linked = pairs.join(patients, patient, "left")
    return linked.groupBy(key).agg(
        *[F.avg(c).alias(f"avg_{c}") for c in conditions], F.count_distinct("state").alias("states"),
        F.avg("annual_inpatient").alias("avg_annual_inpatient"), F.avg("annual_outpatient").alias("avg_annual_outpatient"),
        F.avg(F.col("died").isNotNull().cast("double")).alias("share_deceased"))


def derive_totals(matrix: DataFrame) -> DataFrame:
    """Totals and guarded ratios over both sides. A patient seen on both sides counts twice."""
    totals = matrix.withColumns({
        "total_claims": F.col("claims_ip") + F.col("claims_op"),
        "total_amount": F.col("total_amount_ip") + F.col("total_amount_op"),
        "patients": F.col("patients_ip") + F.col("patients_op")})
    return totals.withColumns({
        "amount_per_claim": guarded_ratio(F.col("total_amount"), F.col("total_claims")),
        "inpatient_ratio": guarded_ratio(F.col("claims_ip"), F.col("total_claims"))})


def provider_matrix(labels: DataFrame, inpatient: DataFrame, outpatient: DataFrame, patients: DataFrame,
                    conditions: Sequence[str], link: DataFrame | None = None, key: str = "provider") -> DataFrame:
    """Labels joined left to the three aggregates, nulls as 0, derived columns at the end.

    The three aggregates leave their shuffle partitioned by the key, so the joins need no further one.
    ``link`` is the claims table that ties patients to providers: the inpatient one unless given.
    """
    ip = claim_aggregate(inpatient, "ip", key, deductible="deductible", physician="physician")
    op = claim_aggregate(outpatient, "op", key)
    people = patient_aggregate(inpatient if link is None else link, patients, conditions, key)
    joined = labels.join(ip, key, "left").join(op, key, "left").join(people, key, "left")
    return derive_totals(joined.na.fill(0))
