"""Series that are updated while they run: new landed responses, bars of arriving trades.

The published currency series are documented as updated in real time, their latest
week covering the week so far. As streams: a parsed landing folder, and bars whose
running bucket is sent again with every new trade (update output mode).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.calendar import (
    check_period, local_micros, millis_to_local, minutes_of,
)
from tickloom.operators.bad_lines import Parsed, parse_lines, parse_responses
from tickloom.operators.resample import bar_aggregates, trades_of
from tickloom.plans.methods import INTERVALS
from tickloom.sources.landing import bodies_from, lines_from, partition_names


def landing_stream(
    spark: SparkSession, root: str, method: str, *, zone: str, on_bad_line: str = "quarantine", check_header: bool = True
) -> Parsed:
    """Bars and error rows of response files as they land, as the batch read of the same files gives them.

    A file is one row, so header check and voiding are verdicts on a row: no state, no shuffle, nothing to wait for. One file
    has to fit in a task. ``check_header=False`` parses line by line in place of that, so that big files are split; it
    cannot void responses. Blanks at a file's end are no part of its last line.
    """
    if check_header:
        return parse_responses(
            bodies_from(spark.readStream, root, method), method, zone=zone, keys=partition_names(method),
            on_bad_line=on_bad_line)
    if on_bad_line == "void_response":
        raise ValueError("voiding a response needs check_header")
    return parse_lines(
        lines_from(spark.readStream, root, method), method, zone=zone,
        keys=partition_names(method), on_bad_line=on_bad_line, check_header=False,
    )


def _window(ts: str, period: str):
    if period in INTERVALS:
        return F.window(ts, f"{minutes_of(period)} minutes")
    if period == "day":
        return F.window(ts, "1 day")
    # The window origin is a Thursday; ISO weeks start on Mondays.
    return F.window(ts, "7 days", startTime="4 days")


def live_bars(
    ticks: DataFrame,
    period: str,
    *,
    lateness: str,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    price: str = "price",
    tie_break: Sequence[str] = (),
    volume: str | None = None,
) -> DataFrame:
    """Bars of a stream of trades, for intraday periods, days and weeks.

    State is one row per (keys, open bucket); a bucket closes once the watermark,
    ``lateness`` behind the newest trade, has passed it. Months have no fixed length
    and so no window: roll days up with ``bars_from_bars``.
    """
    if check_period(period) == "month":
        raise ValueError("live bars are intraday, daily or weekly")
    found, shape = bar_aggregates(
        ts=ts, open=price, high=price, low=price, close=price, tie_break=tie_break, volume=volume,
        volume_kind=ticks.schema[volume].dataType.simpleString() if volume else "bigint",
    )
    start = millis_to_local(F.unix_millis("window.start"), "UTC")
    label = start if period in INTERVALS else F.col("_date")
    # Watermarks need an instant: the local clock is read as if it were UTC.
    barred = (
        trades_of(ticks, ts, price)
        .withColumn("_at", F.timestamp_micros(local_micros(F.col(ts))))
        .withWatermark("_at", lateness)
        .groupBy(_window("_at", period), *keys)
        .agg(F.max(F.col(ts).cast("date")).alias("_date"), *found)
    )
    return barred.select(*keys, label.alias("ts"), *shape)
