"""Time parsing and formatting helpers.

All times are handled as UTC wall clock (the loaders pin the session
zone), and every helper is a Catalyst expression.  Text that is no time
or number becomes NULL, in ANSI mode too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time formats of the original logs.
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"
DATETIME = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_access_time(c) -> Column:
    return F.try_to_timestamp(_c(c), F.lit(ACCESS_LOG_TIME))


def day_unpadded(ts) -> Column:
    """``y/M/d`` without zero padding, e.g. 2024/1/7."""
    return F.date_format(_c(ts), "y/M/d")


def epoch_seconds_text(c) -> Column:
    """Epoch seconds (text or number) -> ``yyyy-MM-dd HH:mm:ss``; other text gives NULL."""
    return F.from_unixtime(_c(c).try_cast("bigint"), DATETIME)


def epoch_ms_day(c) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd``."""
    return F.date_format(F.timestamp_millis(_c(c).try_cast("bigint")), "yyyy-MM-dd")


def floor_ms(c, step_ms: int) -> Column:
    """Floor epoch milliseconds to a multiple of ``step_ms``."""
    return (F.floor(_c(c).cast("bigint") / step_ms) * step_ms).cast("bigint")


def minutes_between_truncated(start_text, end_text) -> Column:
    """Whole minutes from start to end, both cut to the minute first."""
    s = F.date_trunc("minute", F.try_to_timestamp(_c(start_text), F.lit(DATETIME)))
    e = F.date_trunc("minute", F.try_to_timestamp(_c(end_text), F.lit(DATETIME)))
    return F.floor((F.unix_seconds(e) - F.unix_seconds(s)) / 60).cast("bigint")
