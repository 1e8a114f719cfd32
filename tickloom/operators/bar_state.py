"""Bars that can be added to: a partial aggregate of a bucket's trades, and its merge.

A state row is (bucket, keys, date, first, last, high, low[, volume][, dividend, odd_dividend]). ``first`` and ``last``
are the ends' places in the order of trades with their prices, so two states know which end is the earlier; volumes and
dividends are unrounded exact sums. ``merge`` is associative and commutative: bars of merged states equal bars of all their
trades, in any order and grouping, and states of short buckets merge into those of longer ones.

A state has one row per (bucket, keys), whatever the number of trades, and merging shuffles only such rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.calendar import bucket_start, check_period
from tickloom.operators.resample import INTEGERS, check_roll_up, trades_of
from tickloom.plans.methods import INTERVALS

_EXACT = "decimal(38,16)"


def _odd(amount: Column) -> Column:
    """An amount that no decimal holds: its sum with others is what it is for doubles."""
    return F.when(F.isnan(amount) | (F.abs(amount) == float("inf")), amount)


def state_of_ticks(
    ticks: DataFrame,
    period: str,
    *,
    keys: Sequence[str] = ("symbol",),
    ts: str = "ts",
    price: str = "price",
    tie_break: Sequence[str] = (),
    volume: str | None = None,
    adj_close: str | None = None,
    dividend: str | None = None,
) -> DataFrame:
    """State of one row per trade; the columns are those of ``bars_from_ticks``."""
    check_period(period)
    order = [F.col(name).alias(f"o{i}") for i, name in enumerate((ts, *tie_break))]
    last = [price, adj_close] if adj_close else [price]
    found = [
        F.max(F.col(ts).cast("date")).alias("date"),
        F.min(F.struct(*order, F.col(price).alias("v0"))).alias("first"),
        F.max(F.struct(*order, *(F.col(name).alias(f"v{i}") for i, name in enumerate(last)))).alias("last"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
    ]
    if volume:
        whole = ticks.schema[volume].dataType.simpleString() in INTEGERS
        found.append(F.sum(F.col(volume).try_cast("bigint" if whole else _EXACT)).alias("volume"))
    if dividend:
        amount = F.col(dividend).cast("double")
        found += [F.sum(amount.try_cast(_EXACT)).alias("dividend"), F.sum(_odd(amount)).alias("odd_dividend")]
    bucketed = trades_of(ticks, ts, price).withColumn("bucket", bucket_start(F.col(ts), period))
    return bucketed.groupBy("bucket", *keys).agg(*found)


def merge(states: DataFrame, *, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """One row per (bucket, keys) of a union of states."""
    how = {"date": F.max, "first": F.min, "last": F.max, "high": F.max, "low": F.min}
    measures = [name for name in states.columns if name not in ("bucket", *keys)]
    return states.groupBy("bucket", *keys).agg(
        *(how.get(name, F.sum)(name).cast(states.schema[name].dataType).alias(name) for name in measures))


def longer(states: DataFrame, period: str, *, source: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """States of ``period`` from states of the period ``source`` that divides it."""
    check_roll_up(source, period)
    return merge(states.withColumn("bucket", bucket_start(F.col("bucket"), period)), keys=keys)


def bars_of_state(state: DataFrame, period: str, *, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Bars of a merged state, as ``bars_from_ticks`` has them."""
    label = "bucket" if period in INTERVALS or check_period(period) == "day" else "date"
    last = state.schema["last"].dataType.names
    shape = [F.col("first.v0").alias("open"), F.col("high"), F.col("low"), F.col("last.v0").alias("close")]
    if "v1" in last:
        shape.append(F.col("last.v1").alias("adj_close"))
    if "volume" in state.columns:
        shape.append(F.round("volume", 0).cast("bigint").alias("volume"))
    if "dividend" in state.columns:
        shape.append(F.coalesce("odd_dividend", F.col("dividend").cast("double")).alias("dividend_amount"))
    return state.select(*keys, F.col(label).alias("ts"), *shape)
