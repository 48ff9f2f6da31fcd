"""Time and label text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# fixed values: clock text pattern and the arg-max / arg-min label formats
CLOCK_PATTERN = "HH:mm:ss"
MAX_LABEL = "Max: Time=%s, Value=%s"
MIN_LABEL = "Min: Time=%s, Value=%s"


def epoch_to_timestamp(c) -> Column:
    """Epoch seconds → ``TIMESTAMP`` (session zone applies when rendered)."""
    return F.timestamp_seconds(as_col(c))


def clock_text(epoch_seconds) -> Column:
    """Epoch seconds → ``HH:mm:ss`` UTC clock text (F11), independent of the
    session time zone (plain integer arithmetic, stays in codegen)."""
    t = as_col(epoch_seconds).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.pmod(F.floor(t / 3600), F.lit(24)),
                           F.pmod(F.floor(t / 60), F.lit(60)), F.pmod(t, F.lit(60)))


def ntz_epoch_seconds(c) -> Column:
    """``TIMESTAMP_NTZ`` wall clock read as UTC → epoch seconds (floor), without
    going through the session zone."""
    c = as_col(c)
    return (F.unix_date(F.to_date(c)).cast("bigint") * 86400 + F.hour(c) * 3600
            + F.minute(c) * 60 + F.floor(F.second(c))).cast("bigint")


def now_epoch() -> Column:
    """Current epoch seconds (F12), fixed once per query by Catalyst."""
    return F.unix_timestamp(F.current_timestamp())


def max_label(time_col, value_col) -> Column:
    """``Max: Time=…, Value=…``."""
    return F.format_string(MAX_LABEL, as_col(time_col), as_col(value_col))


def min_label(time_col, value_col) -> Column:
    """``Min: Time=…, Value=…``."""
    return F.format_string(MIN_LABEL, as_col(time_col), as_col(value_col))
