"""Epoch-millisecond date helpers that do not depend on the session zone.

Epoch milliseconds are turned into wall-clock time with NTZ arithmetic plus an
explicit ``convert_timezone``, so the driver's ``spark.sql.session.timeZone``
never changes a result. ``tz`` defaults to UTC+8 (Asia/Shanghai) so that the
ms -> text helpers agree with the text -> ms helpers, which use a fixed +8.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rivulet.constants import DAY_MS, DEFAULT_TZ, FIXED_OFFSET_HOURS

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _local(ts_ms: Column, tz: str) -> Column:
    base = F.timestamp_add("MILLISECOND", ts_ms, F.expr(_EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), base)


def ts_to_day(ts_ms: Column, tz: str = DEFAULT_TZ) -> Column:
    """ms -> DATE in ``tz`` (fixed width: cheap to compare, group and aggregate)."""
    return F.to_date(_local(ts_ms, tz))


def day_text(day: Column) -> Column:
    """DATE -> 'yyyy-MM-dd'."""
    return F.date_format(day, "yyyy-MM-dd")


def ts_to_date(ts_ms: Column, tz: str = DEFAULT_TZ) -> Column:
    """ms -> 'yyyy-MM-dd' in ``tz``."""
    return F.date_format(_local(ts_ms, tz), "yyyy-MM-dd")


def ts_to_datetime(ts_ms: Column, tz: str = DEFAULT_TZ) -> Column:
    """ms -> 'yyyy-MM-dd HH:mm:ss' in ``tz``."""
    return F.date_format(_local(ts_ms, tz), "yyyy-MM-dd HH:mm:ss")


def ts_to_partition_day(ts_ms: Column, tz: str = DEFAULT_TZ) -> Column:
    """ms -> 'yyyyMMdd' in ``tz`` (a partition column value)."""
    return F.date_format(_local(ts_ms, tz), "yyyyMMdd")


def previous_day(ts_ms: Column, tz: str = DEFAULT_TZ) -> Column:
    """Date of ``ts - 24h`` (24 hours, not a calendar day)."""
    return ts_to_date(ts_ms - F.lit(DAY_MS), tz)


def datetime_to_ts(text: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' read at a fixed UTC+8 -> epoch ms."""
    ntz = F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    return (F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ntz)
            - F.lit(FIXED_OFFSET_HOURS * 3_600_000))


def date_to_ts(text: Column) -> Column:
    """'yyyy-MM-dd' at 00:00:00 UTC+8 -> epoch ms."""
    return datetime_to_ts(F.concat(text, F.lit(" 00:00:00")))


def ms_of(ts_ntz: Column) -> Column:
    """TIMESTAMP_NTZ -> epoch ms (truncating sub-millisecond digits)."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ts_ntz)
