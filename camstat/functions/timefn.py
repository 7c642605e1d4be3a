"""Time expressions (F14-F19).  Capture times are local wall-clock text
``yyyy:MM:dd HH:mm:ss`` without an offset; the session zone is pinned to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from camstat.functions.ids import ColLike, _c

EXIF_FORMAT = "yyyy:MM:dd HH:mm:ss"
CAPTURE_ZONE = "Canada/Eastern"


def parse_capture_time(c: ColLike, to_utc: bool = False, zone: str = CAPTURE_ZONE) -> Column:
    """EXIF text -> timestamp (local wall clock); ``to_utc`` shifts from ``zone``."""
    ts = F.try_to_timestamp(_c(c), F.lit(EXIF_FORMAT))
    return F.to_utc_timestamp(ts, zone) if to_utc else ts


def month_label(c: ColLike) -> Column:
    return F.date_format(_c(c), "MMM")


def ymd_key(c: ColLike) -> Column:
    """``2022_Aug_19`` (day not zero-padded)."""
    t = _c(c)
    return F.concat_ws("_", F.year(t), F.date_format(t, "MMM"), F.dayofmonth(t))


def with_date_keys(df, ts: str = "date_time"):
    """add year, month (``MMM``), day and the ``ymd`` key."""
    t = F.col(ts)
    return df.withColumns({
        "year": F.year(t),
        "month": F.date_format(t, "MMM"),
        "day": F.dayofmonth(t),
        "ymd": ymd_key(t),
    })


def month_year_label(c: ColLike) -> Column:
    """F16: ``Aug 2022``."""
    return F.date_format(_c(c), "MMM yyyy")


def deployment_group(deployed: ColLike, retrieved: ColLike) -> Column:
    """F16: ``<Mon yyyy> - <Mon yyyy>``; only the start label when not retrieved."""
    return F.concat_ws(" - ", month_year_label(deployed), month_year_label(retrieved))


def days_between(end: ColLike, start: ColLike) -> Column:
    """whole calendar days end - start."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def micros_between(start: ColLike, end: ColLike) -> Column:
    """Elapsed microseconds.  On TIMESTAMP_NTZ values this is wall-clock
    arithmetic, independent of the session time zone (no DST shifts)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def epoch_micros(c: ColLike) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of a wall-clock (NTZ) or zoned time."""
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c) if isinstance(c, str) else c)


def fractional_days(end: ColLike, start: ColLike) -> Column:
    """exact elapsed days as a double."""
    return micros_between(start, end) / F.lit(86400e6)


def seconds_of_day(c: ColLike) -> Column:
    """time of day in seconds."""
    t = _c(c)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def dst_shift(c: ColLike, windows: list[tuple[str, str]], hours: int = 1) -> Column:
    """add ``hours`` to timestamps that fall inside any [start, end) window."""
    t = _c(c)
    cond = F.lit(False)
    for a, b in windows:
        cond = cond | ((t >= F.lit(a).cast("timestamp_ntz")) & (t < F.lit(b).cast("timestamp_ntz")))
    return F.when(cond, t + F.make_interval(hours=F.lit(hours))).otherwise(t)
