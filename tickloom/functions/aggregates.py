"""Aggregates for bars: first and last price in a total order, exact money sums."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

from tickloom.functions.calendar import local_micros

_FIRST, _LAST = "_first", "_last"


def ends(
    order: Sequence[str], first: str, last: Sequence[str], *, unique: bool = False
) -> tuple[list[Column], list[Column]]:
    """Value of ``first`` in the first row and of ``last`` in the last row by ``order``.

    Returns the aggregates and the columns to select from their result. One minimum and one
    maximum of (order, values) serve all values; equal orders are settled by the value, so the
    result never depends on task order. ``unique`` says that the order columns, a time alone or with
    one integer, have no repeats: then they are ``min_by`` and ``max_by``, which aggregate by hashing.
    """
    if unique and len(order) <= 2:
        key = F.col(order[0]) if len(order) == 1 else _packed(*order)
        found = [F.min_by(first, key).alias(_FIRST)]
        found += [F.max_by(name, key).alias(f"{_LAST}{i}") for i, name in enumerate(last)]
        return found, [F.col(_FIRST), *(F.col(f"{_LAST}{i}") for i in range(len(last)))]
    ordered = [F.col(name).alias(f"o{i}") for i, name in enumerate(order)]
    values = [F.col(name).alias(f"v{i}") for i, name in enumerate(last)]
    found = [
        F.min(F.struct(*ordered, F.col(first).alias("v0"))).alias(_FIRST),
        F.max(F.struct(*ordered, *values)).alias(_LAST),
    ]
    return found, [F.col(f"{_FIRST}.v0"), *(F.col(f"{_LAST}.v{i}") for i in range(len(last)))]


def _packed(ts: str, number: str) -> Column:
    """One decimal in the order of (ts, number); it has a fixed width, so hash aggregation can hold it."""
    micros = local_micros(F.col(ts).cast("timestamp_ntz")).cast("decimal(17,0)")
    return micros * F.lit(Decimal(1 << 64)) + F.col(number).cast("decimal(20,0)")


def money_sum(value: str) -> Column:
    """Sum of amounts in decimals of 16 places, so the result does not depend on task order.

    An infinite amount or a NaN makes the sum what it is for doubles.
    """
    amount = F.col(value).cast("double")
    odd = F.max(F.isnan(amount) | (F.abs(amount) == float("inf")))
    exact = F.sum(amount.try_cast("decimal(38,16)")).cast("double")
    return F.when(odd, F.sum(amount)).otherwise(exact)


def volume_sum(value: Column, kind: str) -> Column:
    """Whole total of volumes. Fractions are summed exactly, and the total is rounded once, half up."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.sum(value.cast("bigint"))
    return F.round(F.sum(value.try_cast("decimal(38,16)")), 0).cast("bigint")
