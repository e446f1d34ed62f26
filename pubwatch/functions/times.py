"""Wall-clock times without a zone, and instants. Both ways are in UTC, whatever the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_instant(wall_clock: Column) -> Column:
    """The instant of a zone-less time; watermarks work only on instants."""
    return F.concat(wall_clock.cast("string"), F.lit("Z")).cast("timestamp")


def utc_wall_clock(instant: Column) -> Column:
    """The zone-less time of an instant, to the second."""
    zero = F.lit(0)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(zero, zero, zero, F.unix_seconds(instant))
