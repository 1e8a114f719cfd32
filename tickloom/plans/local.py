"""A method's series from local trades: what the remote service would answer, computed by Spark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from tickloom.operators.adjust import adjust_intraday, daily_with_events, with_adj_close
from tickloom.operators.resample import bars_from_bars, bars_from_ticks
from tickloom.operators.select import in_slice, latest_points
from tickloom.plans.methods import RequestSpec, method_of
from tickloom.plans.series import as_series
from tickloom.sources.shared import written_once


def series_from_ticks(
    ticks: DataFrame,
    spec: RequestSpec,
    *,
    as_of: date,
    events: DataFrame | None = None,
    price: str = "price",
    volume: str | None = "volume",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The series that ``spec`` asks for, from one row per trade (the method's keys, ts, price[, volume]).

    ``events`` (keys, ts, dividend_amount, split_coefficient) is needed by the adjusted methods and by
    ``adjusted`` intraday requests. Trades are aggregated once, to the interval or to days; weeks and months of adjusted
    series come from the adjusted days. Adjustment sees the whole series, then the slice
    ending on ``as_of`` or the output size is cut from it. Where two results need the aggregate, it is written
    once to the shared folder, of a size bounded by the calendar.
    """
    method = method_of(spec.method)
    keys = method.keys
    adjusting = "adjusted" in method.layout or (spec.adjusted and "adjusted" in method.options)
    if adjusting and events is None:
        raise ValueError(f"{spec.method} with adjusted prices needs events")
    period = spec.interval if method.intraday else "day" if adjusting else method.period
    bars = bars_from_ticks(
        ticks, period, keys=keys, price=price, tie_break=tie_break,
        volume=None if method.kind == "fx" else volume)
    if adjusting:
        bars = written_once(bars, "bars")
        daily = bars_from_bars(bars, "day", source=period, keys=keys) if method.intraday else bars
        daily = daily_with_events(daily, events, keys=keys)
        if method.intraday:
            bars = adjust_intraday(bars, daily, keys=keys)
        else:
            bars = with_adj_close(daily, keys=keys)
            if method.period != "day":
                bars = bars_from_bars(bars, method.period, source="day", keys=keys)
    if "slice" in method.options:
        bars = in_slice(bars, spec.slice, as_of)
    if "outputsize" in method.options and spec.output_size == "compact":
        bars = latest_points(bars, keys=keys)
    return as_series(bars, spec.method, zone=spec.zone, keys=keys)
