"""From local bars to a published series, its CSV lines, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.calendar import local_to_millis, millis_to_local
from tickloom.plans.methods import method_of

# Header names that differ from the column names.
_HEADER_NAMES = {"adj_close": "adjusted_close"}
_TIME_HEADER = {"TIME_SERIES_INTRADAY_EXTENDED": "time"}


def as_series(bars: DataFrame, method: str, *, zone: str, keys: Sequence[str] = ()) -> DataFrame:
    """Bars with a local ``ts`` in the method's exact columns, ``timestamp`` as epoch ms."""
    names = method_of(method).schema.names
    return bars.withColumn("timestamp", local_to_millis(F.col("ts"), zone)).select(*keys, *names)


def as_bars(series: DataFrame, method: str, *, zone: str, keys: Sequence[str] = ()) -> DataFrame:
    """The inverse of ``as_series``: ``ts`` is a zone-less timestamp or a date."""
    spec = method_of(method)
    local = millis_to_local(F.col("timestamp"), zone)
    ts = local if spec.intraday else local.cast("date")
    return series.select(*keys, ts.alias("ts"), *spec.schema.names[1:])


def csv_header(method: str) -> str:
    first, *rest = method_of(method).schema.names
    return ",".join([_TIME_HEADER.get(method, first), *(_HEADER_NAMES.get(n, n) for n in rest)])


def csv_columns(method: str) -> list[Column]:
    """A bar's CSV values under their header names, the time as text."""
    spec = method_of(method)
    # Casts to text keep the local clock; formatting would go through the session zone.
    time = F.col("ts").cast("timestamp_ntz" if spec.intraday else "date").cast("string")
    columns = [time, *(F.col(name) for name in spec.schema.names[1:])]
    return [c.alias(name) for c, name in zip(columns, csv_header(method).split(","))]


def csv_line(method: str) -> Column:
    """A bar's CSV line, as a response would carry it."""
    return F.concat_ws(",", *(column.cast("string") for column in csv_columns(method)))
