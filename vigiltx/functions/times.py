"""Column functions for event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigiltx.config import TIME_FORMATS


def parse_time(text: Column, formats: tuple[str, ...] = TIME_FORMATS) -> Column:
    """The first format that fits; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")
