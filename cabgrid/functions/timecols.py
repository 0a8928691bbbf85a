"""Time helpers on TIMESTAMP_NTZ columns that never consult the session zone."""

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_to_second(ts) -> Column:
    """Drop the sub-second part of a TIMESTAMP_NTZ, keeping the NTZ type
    (``date_trunc`` would go through the session zone)."""
    c = _col(ts)
    return F.make_timestamp_ntz(
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.second(c)
    )


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (negative when end is earlier)."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def wrapped_minutes(seconds) -> Column:
    """Minutes field of a time difference taken modulo one day:
    ``(seconds mod 86400) // 60 mod 60``. A negative difference wraps
    around the day, as a day-normalised duration does."""
    return F.pmod(F.floor(F.pmod(_col(seconds), F.lit(86400)) / F.lit(60)), F.lit(60)).cast("int")
