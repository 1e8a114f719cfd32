"""Which of two instants a local time means, where a clock change repeats an hour.

A line holds a local time, and the hour before clocks go back occurs twice. The order of a response's lines tells
the two apart: times run one way within a response, so a step the other way, or a time met again, marks the change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.parse import second_millis

_DAY = 86_400_000


def with_second_hours(
    bars: DataFrame, zone: str, *, response: Sequence[str], position: str, newest_first: bool = True
) -> DataFrame:
    """Bars whose ``timestamp``, first read as the first occurrence, is moved to the second where the order says so.

    ``position`` orders the lines of a response, which ``newest_first`` says is from new to old. Where a response has
    no step within a repeated hour, nothing tells which of the two it is: all its bars there stay at the first. A time sent
    twice in that hour counts as both. Only bars in repeated hours are shuffled, a few hours of a
    response for each window; all others pass by. The frame is read for both, so it is parsed twice.
    """
    second = second_millis(F.col("timestamp"), zone)
    marked = bars.withColumn("_second", second)
    kept = marked.filter(F.col("_second").isNull()).drop("_second")
    local = F.unix_millis(F.from_utc_timestamp(F.timestamp_millis("timestamp"), zone))
    # Offsets in use are hours and halves, so both passes of an hour have one local date but for changes at midnight.
    group = [*response, F.floor((local - F.lit(_DAY // 8)) / F.lit(_DAY))]
    rows = Window.partitionBy(*group)
    ordered = rows.orderBy(position)
    before = F.lag("_local").over(ordered)
    turned = (F.col("_local") >= before) if newest_first else (F.col("_local") <= before)
    steps = F.sum(F.coalesce(turned.cast("int"), F.lit(0))).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    found = marked.filter(F.col("_second").isNotNull()).withColumn("_local", local).withColumn("_steps", steps)
    found = found.withColumn("_turns", F.max("_steps").over(rows))
    later: Column = (F.col("_steps") == 0) if newest_first else (F.col("_steps") > 0)
    moved = F.when((F.col("_turns") > 0) & later, F.col("_second")).otherwise(F.col("timestamp"))
    found = found.withColumn("timestamp", moved).drop("_second", "_local", "_steps", "_turns")
    return kept.unionByName(found)
