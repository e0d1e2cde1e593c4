"""Status rules. `as_of` is the day the status is asked for."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_column(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def contract_status(effective: Column, termination: Column, as_of: Column) -> Column:
    """EXPIRED wins over FUTURE, FUTURE over UNKNOWN (no start date)."""
    return (
        F.when(termination < as_of, "EXPIRED")
        .when(effective > as_of, "FUTURE")
        .when(effective.isNull(), "UNKNOWN")
        .otherwise("ACTIVE")
    )


def rate_status(effective: Column, termination: Column, as_of: Column) -> Column:
    return (
        F.when(termination < as_of, "EXPIRED").when(effective > as_of, "FUTURE").otherwise("ACTIVE")
    )


def open_ended_status(latest_end: Column, as_of: Column) -> Column:
    """Payers: no end date counts as active."""
    return F.when(latest_end.isNull() | (latest_end >= as_of), "ACTIVE").otherwise("INACTIVE")


def dated_status(latest_end: Column, as_of: Column) -> Column:
    """Providers: no end date counts as inactive."""
    return F.when(latest_end >= as_of, "ACTIVE").otherwise("INACTIVE")


def normalized_rate(rate_type: Column, amount: Column) -> Column:
    """Percentages above 1 become fractions."""
    scaled = amount.cast("decimal(16,6)")
    return F.when(
        (F.upper(rate_type) == "PERCENTAGE") & (amount > 1), (amount / 100).cast("decimal(16,6)")
    ).otherwise(scaled)
