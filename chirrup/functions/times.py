"""Time expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# Milliseconds in a unit.
UNITS = {"hour": 3_600_000, "day": 86_400_000}


def time_bucket(epoch_millis: Column, unit: str) -> Column:
    """Start of the hour or day (UTC) an epoch-millisecond value falls in, whatever the session's time zone."""
    return F.timestamp_millis(epoch_millis - F.pmod(epoch_millis, F.lit(UNITS[unit])))
