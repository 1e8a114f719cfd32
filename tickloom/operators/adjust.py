"""Split and dividend adjustment.

The rule is this library's own, as no formula is published for the series:

    factor(t) = product over event days s after t of
                (1 - dividend(s) / close(s - 1)) / split(s)
    adjusted price = price x factor

with close(s - 1) the close of the previous bar. A dividend without a previous
close, or with a zero one, changes nothing; so does a split of zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType

from tickloom.functions.aggregates import money_sum
from tickloom.sources.shared import written_once

PRICES = ("open", "high", "low", "close")
#: Earlier dates are looked up together; it bounds a span's months, not its dates.
FLOOR = date(1990, 1, 1)


def _check_daily(daily: DataFrame) -> None:
    if not isinstance(daily.schema["ts"].dataType, DateType):
        raise ValueError("daily bars have a date as ts")


def with_factor(daily: DataFrame, *, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Add ``factor`` to daily bars with ``dividend_amount`` and ``split_coefficient``.

    Daily bars have one row per (keys, date), so a series is bounded by the
    calendar (about 250 rows a year) whatever its number of trades; a repeated date stops the query. Both windows
    run over falling dates: one sort, and a product Spark keeps as a running value.
    """
    _check_daily(daily)
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("ts"))
    later = newest_first.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.lead("close").over(newest_first)
    repeated = F.lead("ts").over(newest_first) == F.col("ts")
    refused = F.raise_error(F.concat(F.lit("two daily bars of one series on "), F.col("ts").cast("string")))
    paid = F.coalesce(F.try_divide("dividend_amount", previous), F.lit(0.0))
    split = F.coalesce(F.nullif("split_coefficient", F.lit(0.0)), F.lit(1.0))
    step = F.when(repeated, refused.cast("double")).otherwise((1 - paid) / split)
    return (
        daily.withColumn("_step", step)
        .withColumn("factor", F.coalesce(F.product("_step").over(later), F.lit(1.0)))
        .drop("_step")
    )


def with_adj_close(daily: DataFrame, *, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Daily adjusted bars: raw prices plus ``adj_close``."""
    factored = with_factor(daily, keys=keys)
    return factored.withColumn("adj_close", F.col("close") * F.col("factor")).drop("factor")


def daily_with_events(
    daily: DataFrame, events: DataFrame, *, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Add split and dividend events (keys, ts, dividend_amount, split_coefficient) to bars.

    Several events of one bar are combined. An event on a day without a bar belongs
    to the next bar of its series; one after the last bar has not taken effect yet.
    """
    _check_daily(daily)
    same_day = events.groupBy(*keys, F.col("ts").cast("date").alias("ts")).agg(
        money_sum("dividend_amount").alias("dividend_amount"),
        F.product("split_coefficient").alias("split_coefficient"),
    )
    bar = F.struct(*(name for name in daily.columns if name not in keys))
    both = daily.select(*keys, "ts", bar.alias("_bar")).unionByName(
        same_day, allowMissingColumns=True
    )
    # With falling dates, bars before events of the same date: the last bar seen is the
    # first one on or after the event.
    onward = Window.partitionBy(*keys).orderBy(F.desc("ts"), F.col("_bar").isNull())
    placed = both.withColumn("_bar", F.last("_bar", ignorenulls=True).over(
        onward.rowsBetween(Window.unboundedPreceding, 0)
    ))
    return (
        placed.filter(F.col("_bar").isNotNull())
        .groupBy(*keys, F.col("_bar.ts").alias("_ts"))
        .agg(
            F.first("_bar").alias("_bar"),
            F.coalesce(money_sum("dividend_amount"), F.lit(0.0)).alias("dividend_amount"),
            F.coalesce(F.product("split_coefficient"), F.lit(1.0)).alias("split_coefficient"),
        )
        .select(*keys, "_bar.*", "dividend_amount", "split_coefficient")
    )


def _same(names: Sequence[str], other: str) -> Column:
    """Null-safe equality of columns with those of the other side, which carry a prefix."""
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"{other}{name}"))
    return same


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(name).alias(f"{prefix}{name}") for name in df.columns))


def _month(date_: Column) -> Column:
    """Month of a date; all dates before ``FLOOR`` share one."""
    return F.trunc(F.greatest(date_, F.lit(FLOOR)), "month")


def _with_span(rows: DataFrame, date_: Column, spans: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows beside the span (keys, start, end, ...) of their series that holds their date, start included, end not.

    Both sides meet on (keys, month): a span has a row for each of its months, so a date meets the few spans of its
    month.
    """
    low, high = _month(F.coalesce("start", F.lit(FLOOR))), _month(F.date_sub("end", 1))
    months = F.explode(F.sequence(low, high, F.expr("INTERVAL 1 MONTH")))
    known = _prefixed(spans.withColumn("month", months), "_s_")
    inside = (_month(F.col("_date")) == F.col("_s_month")) & (F.col("_date") < F.col("_s_end")) & (
        F.col("_s_start").isNull() | (F.col("_date") >= F.col("_s_start")))
    return rows.withColumn("_date", date_).join(known, _same(keys, "_s_") & inside, how)


def factor_spans(daily: DataFrame, *, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """(keys, start, end, factor): the dates between two event days and their factor.

    The first span of a series has no start; the time from the last event day on has factor 1 and no row. ``daily`` is the daily
    series with its events; a repeated date stops the query. Daily rows are only aggregated: a window sees one row for each
    event day. The days and the spans are written once, when this is called.
    """
    _check_daily(daily)
    refused = F.raise_error(F.concat(F.lit("two daily bars of one series on "), F.col("ts").cast("string")))
    one = F.first(F.struct("close", "dividend_amount", "split_coefficient"))
    days = daily.groupBy(*keys, "ts").agg(one.alias("_day"), F.count("*").alias("_n"))
    paid = F.when(F.col("_n") > 1, refused.cast("double")).otherwise(F.coalesce("_day.dividend_amount", F.lit(0.0)))
    split = F.coalesce(F.nullif("_day.split_coefficient", F.lit(0.0)), F.lit(1.0))
    days = days.select(*keys, "ts", F.col("_day.close").alias("close"), paid.alias("paid"), split.alias("split"))
    days = written_once(days, "days")
    events = days.filter("paid <> 0 OR split <> 1")
    rising = Window.partitionBy(*keys).orderBy("ts")
    spans = events.select(*keys, F.lag("ts").over(rising).alias("start"), F.col("ts").alias("end"), "paid", "split")
    spans = written_once(spans, "spans")
    # The last close of a span is the one before its end.
    before = _with_span(days, F.col("ts"), spans.select(*keys, "start", "end"), keys, "inner").groupBy(
        *(f"_s_{name}" for name in (*keys, "end"))).agg(F.max_by("close", "ts").alias("before"))
    stepped = spans.join(before, _same([*keys, "end"], "_s_"), "left")
    paid = F.coalesce(F.try_divide("paid", "before"), F.lit(0.0))
    later = Window.partitionBy(*keys).orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    return stepped.withColumn("step", (1 - paid) / F.col("split")).select(
        *keys, "start", "end", F.product("step").over(later).alias("factor"))


def adjust_intraday(
    bars: DataFrame, daily: DataFrame, *, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Intraday bars with prices adjusted by the factor as of their date.

    ``daily`` is the daily series with its events. The events after a date count, whether or not the date has a daily row; past
    the last one prices stay. Keys may be NULL. Bars meet their span of dates by a join on (keys, month).
    """
    spans = factor_spans(daily, keys=keys)
    joined = _with_span(bars, F.col("ts").cast("date"), spans, keys, "left")
    factor = F.coalesce("_s_factor", F.lit(1.0))
    return joined.withColumns({name: F.col(name) * factor for name in PRICES}).select(*bars.columns)
