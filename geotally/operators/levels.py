"""Risk, transmission and community levels of metric values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from geotally.functions import scalars as S
from geotally.model import days_back

LOOKBACK = 15
RT_DELAY = 7

# Published codes of the levels.
RISK = {"LOW": 0, "MEDIUM": 1, "HIGH": 2, "CRITICAL": 3, "UNKNOWN": 4, "EXTREME": 5}
TRANSMISSION = {"LOW": 0, "MODERATE": 1, "SUBSTANTIAL": 2, "HIGH": 3, "UNKNOWN": 4}
COMMUNITY = {"LOW": 0, "MEDIUM": 1, "HIGH": 2}

# Upper limits of the risk levels per metric, lowest level first.
RISK_LIMITS = {
    "caseDensity": [1, 10, 25, 75],
    "testPositivityRatio": [0.03, 0.1, 0.2],
    "infectionRate": [0.9, 1.1, 1.4],
    "icuCapacityRatio": [0.7, 0.8, 0.85],
}
# Limits of the transmission levels; weekly case limits are per seven days.
TRANSMISSION_LIMITS = {"caseDensity": [10 / 7.0, 50 / 7.0, 100 / 7.0], "testPositivityRatio": [0.05, 0.08, 0.10]}


def risk_level(value: Column, limits: list[float]) -> Column:
    v = S.finite(value)
    names = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
    out = F.when(v.isNull(), RISK["UNKNOWN"])
    for name, limit in zip(names, limits):
        out = out.when(v <= limit, RISK[name])
    return out.otherwise(RISK["CRITICAL"] if len(limits) == 3 else RISK["EXTREME"])


def contact_tracing_level(value: Column) -> Column:
    """Reversed: more tracers mean less risk."""
    return (
        F.when(value > 0.9, RISK["LOW"]).when(value > 0.1, RISK["MEDIUM"]).when(value >= 0, RISK["HIGH"])
        .otherwise(RISK["UNKNOWN"])
    )


def overall_risk(case: Column, positivity: Column, infection: Column) -> Column:
    """Low or unknown case density decides alone, else the most severe of the three."""
    out = F.when(case.isin(RISK["LOW"], RISK["UNKNOWN"]), case)
    for name in ("EXTREME", "CRITICAL", "HIGH", "MEDIUM", "UNKNOWN"):
        code = RISK[name]
        out = out.when((case == code) | (positivity == code) | (infection == code), code)
    return out.otherwise(RISK["LOW"])


def transmission(value: Column, limits: list[float]) -> Column:
    v = S.finite(value)
    out = F.when(v.isNull(), TRANSMISSION["UNKNOWN"])
    for name, limit in zip(("LOW", "MODERATE", "SUBSTANTIAL"), limits):
        out = out.when(v < limit, TRANSMISSION[name])
    return out.otherwise(TRANSMISSION["HIGH"])


def overall_transmission(case: Column, positivity: Column) -> Column:
    """The higher of the two; unknown only if both are."""
    unknown = TRANSMISSION["UNKNOWN"]
    known = lambda c: F.when(c != unknown, c)
    return F.coalesce(F.greatest(known(case), known(positivity)), F.lit(unknown))


def transmission_level(case_density: Column, positivity: Column) -> Column:
    return overall_transmission(
        transmission(case_density, TRANSMISSION_LIMITS["caseDensity"]),
        transmission(positivity, TRANSMISSION_LIMITS["testPositivityRatio"]),
    )


def community_level(weekly_cases: Column, beds: Column, admissions: Column) -> Column:
    """NULL without any hospital metric; a missing metric counts as zero otherwise."""
    cases, b, a = S.finite(weekly_cases), S.finite(beds), S.finite(admissions)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    calm = (zero(a) < 10) & (zero(b) < 0.1)
    strained = (zero(a) >= 20) | (zero(b) >= 0.15)
    few = F.when(calm, COMMUNITY["LOW"]).when(strained, COMMUNITY["HIGH"]).otherwise(COMMUNITY["MEDIUM"])
    many = F.when(calm, COMMUNITY["MEDIUM"]).otherwise(COMMUNITY["HIGH"])
    return F.when(b.isNotNull() | a.isNotNull(), F.when(zero(cases) < 200, few).otherwise(many))


def risk_columns(df: DataFrame) -> DataFrame:
    """All risk levels of a frame with metric columns."""
    level = {m: risk_level(F.col(m), RISK_LIMITS[m]) for m in RISK_LIMITS if m in df.columns}
    out = df.withColumns({f"{m}_risk": c for m, c in level.items()})
    if "contactTracerCapacityRatio" in df.columns:
        out = out.withColumn("contactTracerCapacityRatio_risk", contact_tracing_level(F.col("contactTracerCapacityRatio")))
    return out.withColumn(
        "overall", overall_risk(F.col("caseDensity_risk"), F.col("testPositivityRatio_risk"), F.col("infectionRate_risk"))
    )


def carry(metrics: DataFrame, columns: list[str], days: int = LOOKBACK - 1) -> DataFrame:
    """Each column becomes its last real value of the past days."""
    w = days_back(days, by=["location_id"])
    return metrics.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def risk_timeseries(metrics: DataFrame) -> DataFrame:
    w = days_back(RT_DELAY, -RT_DELAY, by=["location_id"])
    late = metrics.withColumn("infectionRate", F.first("infectionRate").over(w))
    x = risk_columns(carry(late, ["caseDensity", "testPositivityRatio", "infectionRate"]).select(
        "location_id", "date", "caseDensity", "testPositivityRatio", "infectionRate"))
    return x.select("location_id", "date", "overall", F.col("caseDensity_risk").alias("caseDensity"))


def transmission_timeseries(metrics: DataFrame) -> DataFrame:
    x = carry(metrics, ["caseDensity", "testPositivityRatio"])
    return x.select(
        "location_id", "date",
        transmission_level(F.col("caseDensity"), F.col("testPositivityRatio")).alias("cdcTransmissionLevel"),
    )


def community_timeseries(metrics: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """Own level per day beside the external one (location_id, date, value)."""
    names = ["weeklyNewCasesPer100k", "bedsWithCovidPatientsRatio", "weeklyCovidAdmissionsPer100k"]
    own = carry(metrics, names).select(
        "location_id", "date", community_level(*[F.col(n) for n in names]).alias("ownCommunityLevel")
    )
    if external is None:
        return own.withColumn("cdcCommunityLevel", F.lit(None).cast("int"))
    e = external.select("location_id", "date", F.col("value").cast("int").alias("cdcCommunityLevel"))
    return own.join(e, ["location_id", "date"], "full")


def community_latest(levels: DataFrame) -> DataFrame:
    """Own level of the last day, external level of the last day that has one."""
    known = F.col("cdcCommunityLevel").isNotNull()
    return levels.groupBy("location_id").agg(
        F.max_by("ownCommunityLevel", "date").alias("ownCommunityLevel"),
        F.max_by(F.when(known, F.col("cdcCommunityLevel")), F.when(known, F.col("date"))).alias("cdcCommunityLevel"),
    )
