"""Landed responses: text files, one response per file.

Layout: ``<root>/<METHOD>/symbol=IBM/*`` for equities and
``<root>/<METHOD>/from_symbol=EUR/to_symbol=USD/*`` for pairs, with a further
``slice=year1month1`` level for sliced methods.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from tickloom.plans.methods import method_of


def partition_names(method: str) -> tuple[str, ...]:
    spec = method_of(method)
    return (*spec.keys, "slice") if "slice" in spec.options else spec.keys


def _text_schema(names) -> str:
    return ", ".join(f"`{name}` string" for name in ("value", *names))


def lines_from(
    reader: DataFrameReader | DataStreamReader, root: str, method: str, *extra: Column
) -> DataFrame:
    names = partition_names(method)
    return (
        reader.schema(_text_schema(names))
        .text(f"{root}/{method}")
        .select(
            *names,
            F.col("_metadata.file_path").alias("response_id"),
            F.col("value").alias("line"),
            *extra,
        )
    )


def landed_lines(spark: SparkSession, root: str, method: str) -> DataFrame:
    """One row per line, with the series keys and the file as ``response_id``.

    Files are split over tasks, so one huge response does not sit in one task.
    Key columns are partition columns: filters on them prune whole directories. ``position`` orders the
    lines of a file: the start of the split, then an id that rises within it.
    """
    position = F.struct(
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    return lines_from(spark.read, root, method, position.alias("position"))


def bodies_from(reader: DataFrameReader | DataStreamReader, root: str, method: str) -> DataFrame:
    """One row per landed response with its whole body, in the form ``parse_responses`` takes; any line end becomes ``\\n``."""
    names = partition_names(method)
    return (
        reader.schema(_text_schema(names))
        .text(f"{root}/{method}", wholetext=True)
        .select(
            *names,
            F.col("_metadata.file_path").alias("response_id"),
            F.lit(200).alias("status"),
            F.lit("OK").alias("reason"),
            F.regexp_replace("value", "\r\n?", "\n").alias("body"),
        )
    )


def landed_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole text, for bodies that are not CSV."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("response_id"),
        F.lit(200).alias("status"),
        F.lit("OK").alias("reason"),
        F.col("value").alias("body"),
    )
