"""Parts of a bar series: 30-day slices and the latest points."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.calendar import check_local, local_literal
from tickloom.plans.methods import SLICES, slice_ordinal

# Days in a slice, points in a compact series.
SLICE_DAYS = 30
COMPACT_POINTS = 100


def slice_bounds(name: str, as_of: date) -> tuple[date, date]:
    """First and last date of a slice; slice 1 ends on ``as_of``."""
    ordinal = slice_ordinal(name)
    last = as_of - timedelta(days=SLICE_DAYS * (ordinal - 1))
    return last - timedelta(days=SLICE_DAYS - 1), last


def _between(df: DataFrame, ts: str, first: date, last: date) -> DataFrame:
    """Dates first..last as a plain range on ``ts``, which reaches the scan."""
    check_local(df, ts)
    kind = df.schema[ts].dataType.simpleString()
    start, end = local_literal(first, kind), local_literal(last + timedelta(days=1), kind)
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


def in_slice(df: DataFrame, name: str, as_of: date, *, ts: str = "ts") -> DataFrame:
    """Rows of one slice."""
    return _between(df, ts, *slice_bounds(name, as_of))


def with_slice(df: DataFrame, as_of: date, *, ts: str = "ts") -> DataFrame:
    """Rows of all 24 slices with the slice's name in ``slice``, in one pass."""
    covered = _between(df, ts, slice_bounds(SLICES[-1], as_of)[0], as_of)
    age = F.datediff(local_literal(as_of, "date"), F.col(ts).cast("date"))
    position = F.floor(age / SLICE_DAYS)
    name = F.concat(
        F.lit("year"), F.floor(position / 12) + 1, F.lit("month"), position % 12 + 1
    )
    return covered.withColumn("slice", name)


def latest_points(
    bars: DataFrame, *, keys: Sequence[str] = ("symbol",), ts: str = "ts"
) -> DataFrame:
    """The latest 100 bars of each series, ties broken by the whole row.

    The rank filter is applied before the shuffle as well, so each map task sends at
    most 100 rows per series however many bars one symbol has.
    """
    rest = [name for name in bars.columns if name not in keys and name != ts]
    newest = Window.partitionBy(*keys).orderBy(F.desc(ts), *(F.desc(name) for name in rest))
    return (
        bars.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= COMPACT_POINTS)
        .drop("_rank")
    )
