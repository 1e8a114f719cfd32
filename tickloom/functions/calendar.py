"""Exchange-local calendar expressions.

Bars carry ``ts`` on the exchange's own clock: a zone-less timestamp for intraday
bars, a date for daily and longer ones. The published series carry ``timestamp``,
epoch milliseconds, so the zone enters only here. No result depends on the
session time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from tickloom.plans.methods import INTERVALS, check_zone

PERIODS = (*INTERVALS, "day", "week", "month")


def check_period(period: str) -> str:
    if period not in PERIODS:
        raise ValueError(f"period {period!r} is not supported")
    return period


def minutes_of(period: str) -> int:
    return int(period.removesuffix("min"))


def bucket_start(ts: Column, period: str) -> Column:
    """First instant (intraday) or first date (day, ISO week, month) of the bucket of ``ts``."""
    check_period(period)
    if period in INTERVALS:
        return F.window(ts.cast("timestamp_ntz"), f"{minutes_of(period)} minutes").start
    day = ts.cast("date")
    return day if period == "day" else F.trunc(day, period)


def period_end(ts: Column, period: str) -> Column:
    """Last date of the day, ISO week or month of ``ts``, or the intraday bucket's end."""
    check_period(period)
    if period in INTERVALS:
        return ts.cast("timestamp_ntz") + F.expr(f"INTERVAL {minutes_of(period)} MINUTE")
    day = ts.cast("date")
    if period == "day":
        return day
    return F.last_day(day) if period == "month" else F.date_add(F.trunc(day, "week"), 6)


def local_to_millis(ts: Column, zone: str) -> Column:
    """Epoch milliseconds of a local date or zone-less timestamp in ``zone``."""
    local = ts.cast("timestamp_ntz")
    return F.unix_millis(
        F.make_timestamp(
            F.year(local), F.month(local), F.dayofmonth(local),
            F.hour(local), F.minute(local), F.second(local),
            F.lit(check_zone(zone)),
        )
    )


def local_micros(ts: Column) -> Column:
    """Microseconds of a zone-less timestamp since the local epoch, in any session zone."""
    minutes = F.unix_date(ts.cast("date")) * F.lit(1440).cast("bigint") + (
        F.hour(ts) * 60 + F.minute(ts)
    )
    micros = (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("bigint")
    return minutes * 60000000 + micros


def local_literal(value: date | datetime, kind: str) -> Column:
    """A date or zone-less timestamp literal that no time zone shifts."""
    return F.lit(value.isoformat()).cast(kind)


def instant_to_local(instant: Column, zone: str) -> Column:
    """Zone-less local timestamp in ``zone`` of a timestamp with time zone."""
    return _micros_to_local(F.unix_micros(instant), zone)


def millis_to_local(millis: Column, zone: str) -> Column:
    """Zone-less local timestamp in ``zone`` of epoch milliseconds."""
    return _micros_to_local(millis * 1000, zone)


def _micros_to_local(micros: Column, zone: str) -> Column:
    seconds = (micros / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    utc = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(check_zone(zone)), utc)


def check_local(df: DataFrame, ts: str) -> None:
    """An instant would be read on the session's clock; the caller has to name the zone."""
    kind = df.schema[ts].dataType
    if not isinstance(kind, (DateType, TimestampNTZType)):
        raise ValueError(
            f"{ts} must be a date or a zone-less timestamp, not {kind.simpleString()}; "
            "instant_to_local converts instants"
        )
