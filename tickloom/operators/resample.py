"""Bars from ticks, and longer bars from shorter ones.

``ts`` is on the exchange's own clock: a zone-less timestamp or a date. Bars here are
(keys, ts, open, high, low, close[, adj_close][, volume][, dividend_amount]), ``ts``
being the bucket start for intraday bars, the date for daily bars and the last date
with data for weekly and monthly ones. Buckets without ticks give no bar; the
running week or month is kept.

Each operator is one partial and one final aggregate around a single shuffle on
(bucket, keys): a symbol with a third of all ticks leaves each map task as one
row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.aggregates import ends, money_sum, volume_sum
from tickloom.functions.calendar import (
    bucket_start, check_local, check_period, local_literal, minutes_of, period_end,
)
from tickloom.plans.methods import INTERVALS

INTEGERS = ("tinyint", "smallint", "int", "bigint")
_BUCKET = "_bucket"
_DATE = "_date"


def bar_aggregates(
    *,
    ts: str,
    open: str,
    high: str,
    low: str,
    close: str,
    tie_break: Sequence[str] = (),
    unique: bool = False,
    adj_close: str | None = None,
    volume: str | None = None,
    volume_kind: str = "bigint",
    dividend: str | None = None,
) -> tuple[list[Column], list[Column]]:
    """Aggregates of one bar, and the bar's columns in terms of them."""
    last = [close, adj_close] if adj_close else [close]
    found, (first_value, *last_values) = ends((ts, *tie_break), open, last, unique=unique)
    found += [F.max(high).alias("high"), F.min(low).alias("low")]
    shape = [first_value.alias("open"), F.col("high"), F.col("low"), last_values[0].alias("close")]
    if adj_close:
        shape.append(last_values[1].alias("adj_close"))
    if volume:
        found.append(volume_sum(F.col(volume), volume_kind).alias("volume"))
        shape.append(F.col("volume"))
    if dividend:
        found.append(money_sum(dividend).alias("dividend_amount"))
        shape.append(F.col("dividend_amount"))
    return found, shape


def _bars(df: DataFrame, period: str, keys: Sequence[str], ts: str, **columns) -> DataFrame:
    volume = columns.get("volume")
    kind = df.schema[volume].dataType.simpleString() if volume else "bigint"
    found, shape = bar_aggregates(ts=ts, volume_kind=kind, **columns)
    bucketed = df.withColumn(_BUCKET, bucket_start(F.col(ts), period))
    # The bucket first: where rows are sorted for grouping, most comparisons end there.
    barred = bucketed.groupBy(_BUCKET, *keys).agg(
        F.max(F.col(ts).cast("date")).alias(_DATE), *found
    )
    label = _BUCKET if period in INTERVALS or period == "day" else _DATE
    return barred.select(*keys, F.col(label).alias("ts"), *shape)


def trades_of(ticks: DataFrame, ts: str, price: str) -> DataFrame:
    """Rows without time or price are no trades."""
    check_local(ticks, ts)
    return ticks.filter(F.col(ts).isNotNull() & F.col(price).isNotNull())


def bars_from_ticks(
    ticks: DataFrame,
    period: str,
    *,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    price: str = "price",
    tie_break: Sequence[str] = (),
    unique_ts: bool = False,
    unique_ties: bool = False,
    volume: str | None = None,
    adj_close: str | None = None,
    dividend: str | None = None,
) -> DataFrame:
    """Bars of ``period`` from one row per trade.

    ``tie_break`` orders trades of equal ``ts``; what it leaves equal is settled by price, the lowest
    first, so bars never depend on the order of rows. ``unique_ts`` promises that no series has two trades of one
    ``ts``, ``unique_ties`` that none has two of one ``ts`` and tie-break, a single integer column; both
    aggregate by hashing instead of sorting.
    """
    if unique_ts and (tie_break or unique_ties):
        raise ValueError("unique times need no tie_break")
    if unique_ties and (len(tie_break) != 1 or ticks.schema[tie_break[0]].dataType.simpleString() not in INTEGERS):
        raise ValueError("unique_ties needs one integer tie_break column")
    check_period(period)
    return _bars(
        trades_of(ticks, ts, price), period, keys, ts,
        open=price, high=price, low=price, close=price, tie_break=tie_break, unique=unique_ts or unique_ties,
        adj_close=adj_close, volume=volume, dividend=dividend,
    )


def check_roll_up(source: str, period: str) -> None:
    """Bars of ``source`` must each lie in one bar of ``period``; weeks do not divide months."""
    check_period(source)
    check_period(period)
    if source in INTERVALS and period in INTERVALS:
        divides = minutes_of(period) % minutes_of(source) == 0 and source != period
    elif source in INTERVALS:
        divides = True
    else:
        divides = source == "day" and period in ("week", "month")
    if not divides:
        raise ValueError(f"{source} bars do not make up {period} bars")


def bars_from_bars(
    bars: DataFrame, period: str, *, source: str, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Longer bars from bars of the period ``source``; ``ts`` is unique within a series.

    The adjusted close is the last of the period and the dividend its sum.
    """
    check_roll_up(source, period)
    check_local(bars, "ts")
    optional = {"adj_close": "adj_close", "volume": "volume", "dividend": "dividend_amount"}
    given = {name: column for name, column in optional.items() if column in bars.columns}
    return _bars(
        bars, period, keys, "ts", open="open", high="high", low="low", close="close", unique=True, **given
    )


def with_partial_flag(bars: DataFrame, period: str, as_of: date | datetime) -> DataFrame:
    """Add ``is_partial``: the bar's period ends after ``as_of``."""
    kind = "timestamp_ntz" if period in INTERVALS else "date"
    return bars.withColumn(
        "is_partial", period_end(F.col("ts"), period) > local_literal(as_of, kind)
    )
