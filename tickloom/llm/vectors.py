"""Float vectors in Arrow columns, and comparison of groups of vectors in blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(name: str) -> Column:
    """Not null, not empty, and all components finite numbers."""
    finite = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(name).isNotNull() & (F.size(name) > 0) & finite, F.lit(False))


def matrices(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each length of vector in a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    length = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(length)])
    found = []
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        at = start[rows][:, None] + np.arange(d)
        found.append((rows, flat[at]))
    return found


def unit_rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length, scaled to length one."""
    [(_, found)] = matrices(column)
    # Scaled by the largest component first, so squares neither overflow nor vanish.
    found = found / np.abs(found).max(1, keepdims=True)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def parts(n: Column, block_rows: int) -> Column:
    """How many blocks of about ``block_rows`` hold n rows."""
    return F.ceil(n / F.lit(block_rows)).cast("int")


def in_blocks(rows: DataFrame, group: str, chosen: str, block_rows: int) -> DataFrame:
    """Every chosen row of a group beside every row of the group, in blocks of bounded size.

    The chosen rows fall into blocks and all rows into slices of about ``block_rows``; each
    (``_block``, ``_slice``) of a group has one block's chosen rows, ``_asks`` true, and one slice's rows.
    Groups without chosen rows vanish.
    """
    counts = rows.groupBy(group).agg(
        parts(F.count(F.when(F.expr(chosen), 1)), block_rows).alias("_blocks"),
        parts(F.count("*"), block_rows).alias("_slices"))
    return dealt(rows.join(counts.filter("_blocks > 0"), group), chosen)


def dealt(spread: DataFrame, chosen: str) -> DataFrame:
    """``in_blocks`` for rows that carry their group's numbers of blocks and slices."""
    wanted = F.expr(chosen)

    def number(n):
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asking = spread.filter(wanted).withColumn("_block", number("_blocks")).withColumn("_slice", every("_slices"))
    answering = spread.withColumn("_slice", number("_slices")).withColumn("_block", every("_blocks"))
    return asking.withColumn("_asks", F.lit(True)).unionByName(answering.withColumn("_asks", F.lit(False))).drop(
        "_blocks", "_slices")
