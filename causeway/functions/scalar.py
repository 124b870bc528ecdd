"""Time, severity and record expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_PACKS, RulePacks

# Business hours, both ends included; Saturday is weekday 5.
BUSINESS_HOURS = (9, 17)
WEEKEND_FROM = 5

TIME_FEATURES = ["hour_of_day", "day_of_week", "is_weekend", "is_business_hours"]


# Tried in this order after ISO 8601.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss,SSS", "yyyy/MM/dd HH:mm[:ss]", "MMM d, yyyy HH:mm[:ss]", "MM/dd/yyyy HH:mm[:ss]")


def parse_time(col: Column, formats: tuple[str, ...] = TIME_FORMATS) -> Column:
    """Timestamp, or null when the text is none of the ``formats`` or has no date."""
    dated = F.when(col.rlike(r"^\s*\d{4}-\d"), F.try_to_timestamp(col))
    return F.coalesce(dated, *[F.try_to_timestamp(col, F.lit(fmt)) for fmt in formats])


def time_features(col: Column) -> dict[str, Column]:
    """Hour, weekday (Monday = 0), weekend and business-hour flags; zeros for an unknown time."""
    parsed = parse_time(col)
    hour = F.coalesce(F.hour(parsed), F.lit(0))
    day = F.coalesce(F.weekday(parsed), F.lit(0))
    return {
        "hour_of_day": hour,
        "day_of_week": day,
        "is_weekend": (day >= WEEKEND_FROM).cast("int"),
        "is_business_hours": hour.between(*BUSINESS_HOURS).cast("int"),
    }


def encode_severity(col: Column, packs: RulePacks = DEFAULT_PACKS) -> Column:
    """Ordinal code of a known severity, 0 for anything else."""
    branches = F.when(F.lit(False), F.lit(None).cast("int"))
    for name, code in packs.severity_codes.items():
        branches = branches.when(col == name, F.lit(code))
    return branches.otherwise(F.lit(0))


def echo_inputs(message: Column, service: Column, severity: Column, timestamp: Column) -> Column:
    """The four inputs of a prediction as one struct, nulls as ''."""
    named = {"log_message": message, "service": service, "severity": severity, "timestamp": timestamp}
    return F.struct(*[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in named.items()])
