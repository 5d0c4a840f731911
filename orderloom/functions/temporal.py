"""Calendar functions on zone-free timestamps.

`trunc` works on dates, so none of these goes through the session time zone, as
`date_trunc` would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate(ts: Column | str, unit: str) -> Column:
    """Start of the day, month, quarter or year of `ts`."""
    day = F.col(ts).cast("date") if isinstance(ts, str) else ts.cast("date")
    return (day if unit == "day" else F.trunc(day, unit)).cast("timestamp_ntz")


def months(n: int) -> Column:
    """A calendar interval; `months(3)` is a quarter, `months(12)` a year."""
    return F.make_ym_interval(F.lit(0), F.lit(n))


def micros(later: Column, earlier: Column) -> Column:
    """Whole microseconds between two timestamps."""
    return F.timestamp_diff("MICROSECOND", earlier, later)
