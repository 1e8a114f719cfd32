"""Response bodies that are not CSV: plain text, HTML and JSON."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Statuses whose body is kept. 422 carries a readable body.
KEPT_STATUSES = (200, 422)

_MISFIT = "_misfit"


class Bodies(NamedTuple):
    bodies: DataFrame
    errors: DataFrame  # response_id, reason


def _status_reason():
    return F.when(F.col("status").isNull(), F.coalesce("reason", F.lit("no response"))).when(
        ~F.col("status").isin(*KEPT_STATUSES), F.concat_ws(" ", F.lit("status"), "status", "reason")
    )


def text_bodies(responses: DataFrame, *, keys: tuple[str, ...] = ()) -> Bodies:
    """Whole bodies of (keys, response_id, status, reason, body), one row per response."""
    marked = responses.withColumn("_problem", _status_reason())
    return Bodies(
        marked.filter(F.col("_problem").isNull()).select(*keys, "response_id", "status", "body"),
        marked.filter(F.col("_problem").isNotNull()).select(
            *keys, "response_id", F.col("_problem").alias("reason")
        ),
    )


def json_bodies(
    responses: DataFrame, *, schema: StructType | str | None = None, keys: tuple[str, ...] = ()
) -> Bodies:
    """Bodies parsed as JSON into ``json``: a VARIANT, or ``schema``'s type if given.

    A malformed body becomes an error row, as does one that does not fit ``schema``: another kind of
    value than an object, or a field of another type. Missing fields and a body ``null`` are NULL values.
    """
    if schema is None:
        parsed = responses.withColumn("_value", F.try_parse_json("body"))
        misfit = F.when(F.col("_value").isNull(), F.lit("bad json"))
        json = F.col("_value")
    else:
        typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        wider = StructType([*typed.fields, StructField(_MISFIT, StringType())])
        # Read as one struct per row, so the body is parsed once for the value and the verdict.
        value = F.from_json("body", wider, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MISFIT})
        parsed = responses.withColumn("_rows", F.array(value)).select("*", F.explode("_rows").alias("_value")).drop("_rows")
        empty = F.trim("body") == "null"
        misfit = F.when(
            F.col("body").isNull() | (~empty & (F.col("_value").isNull() | F.col(f"_value.{_MISFIT}").isNotNull())),
            F.lit("bad json"))
        json = F.struct(*(F.col("_value").getField(name).alias(name) for name in typed.names))
    problem = F.coalesce(_status_reason(), misfit)
    marked = parsed.withColumn("_problem", problem)
    return Bodies(
        marked.filter(F.col("_problem").isNull()).select(
            *keys, "response_id", "status", json.alias("json")
        ),
        marked.filter(F.col("_problem").isNotNull()).select(
            *keys, "response_id", F.col("_problem").alias("reason")
        ),
    )
