"""Hour and weekday expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netvigil.schema import TIMESTAMP_FORMAT

# Six-hour surge windows and weekday names (1 is Sunday).
SURGE_WINDOWS = [(6, "00-05"), (12, "06-11"), (18, "12-17")]
LAST_SURGE_WINDOW = "18-23"
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def surge_window(hour: Column) -> Column:
    """Six-hour bucket of an hour; flows without an hour count in the last bucket."""
    bucket = F.lit(LAST_SURGE_WINDOW)
    for end, name in reversed(SURGE_WINDOWS):
        bucket = F.when(hour < end, F.lit(name)).otherwise(bucket)
    return bucket


def day_name(day_of_week: Column) -> Column:
    names = F.create_map(*[F.lit(part) for pair in enumerate(DAY_NAMES, start=1) for part in pair])
    return names[day_of_week]


def as_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, TIMESTAMP_FORMAT)
