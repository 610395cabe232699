"""String, number and bucket column functions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

REF_DATE = datetime.date(2020, 1, 1)

# Decimal places published per metric.
METRIC_DECIMALS = {
    "caseDensity": 1, "weeklyNewCasesPer100k": 1, "testPositivityRatio": 3, "contactTracerCapacityRatio": 2,
    "infectionRate": 2, "infectionRateCI90": 2, "icuCapacityRatio": 2, "bedsWithCovidPatientsRatio": 3,
    "weeklyCovidAdmissionsPer100k": 1, "vaccinationsInitiatedRatio": 3, "vaccinationsCompletedRatio": 3,
    "vaccinationsAdditionalDoseRatio": 3, "vaccinationsFall2022BivalentBoosterRatio": 3,
}


def bucket_name(fields: dict[str, Column]) -> Column:
    """'all', or '<names>:<values>' of the demographic fields that are not 'all'.

    ``concat_ws`` leaves out NULLs, which keeps this a plain generated expression.
    """
    names = F.concat_ws(";", *[F.when(c != "all", F.lit(n)) for n, c in fields.items()])
    values = F.concat_ws(";", *[F.when(c != "all", c) for c in fields.values()])
    return F.when(names == "", "all").otherwise(F.concat(names, F.lit(":"), values))


def bucket_distribution(bucket: Column) -> Column:
    return F.element_at(F.split(bucket, ":"), 1)


def bucket_member(bucket: Column) -> Column:
    """Name inside the distribution; 'all' for the bucket without one."""
    return F.coalesce(F.try_element_at(F.split(bucket, ":", 2), F.lit(2)), F.lit("all"))


def strip_whitespace(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    return df.select(
        *[
            F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def days_since_ref(date: Column, ref: datetime.date = REF_DATE) -> Column:
    return F.datediff(date, F.lit(ref))


def clip_nonneg(c: Column) -> Column:
    return F.when(c < 0, 0.0).otherwise(c)


def cap(c: Column, top: float) -> Column:
    return F.when(c > top, float(top)).otherwise(c)


def finite(c: Column) -> Column:
    """NaN and infinities become NULL."""
    c = c.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL instead of an infinity."""
    return F.try_divide(a, b)


def round_metrics(df: DataFrame, decimals: dict[str, int] = METRIC_DECIMALS) -> DataFrame:
    """Half-even rounding of the metric columns that are present."""
    return df.withColumns({m: F.bround(F.col(m), n) for m, n in decimals.items() if m in df.columns})


def split_county_state(text: Column) -> tuple[Column, Column]:
    """'Name, State' split at the last comma-separated part."""
    parts = F.split(text, ",")
    return F.trim(F.element_at(parts, 1)), F.trim(F.element_at(parts, -1))
