"""Bars out of JSON responses: an object keyed by time, each entry an object of named values.

The body is parsed once, as a VARIANT; each entry's values go through the same typed columns as CSV
tokens, so a number may be a JSON number or a string, and both formats have one meaning.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import parse
from tickloom.operators.bad_lines import OK, Parsed, check_policy, stop_on
from tickloom.plans.methods import method_of


def _path(name: str) -> str:
    if "'" in name or "\\" in name:
        raise ValueError(f"field name {name!r} holds a quote or backslash")
    return f"$['{name}']"


def _texts(time: Column, entry: Column, names: list[str], fields: Mapping[str, str]) -> list[Column]:
    return [time, *(F.try_variant_get(entry, _path(fields.get(n, n)), "string") for n in names[1:])]


def parse_json_series(
    responses: DataFrame,
    method: str,
    *,
    zone: str,
    series: str,
    fields: Mapping[str, str] | None = None,
    keys: tuple[str, ...] = (),
    on_bad_line: str = "quarantine",
) -> Parsed:
    """Parse (keys, response_id, status, reason, body); ``series`` names the member that holds the bars.

    ``fields`` maps a column to its name in an entry where the two differ; other fields are ignored. A status other than
    200, a body that is no JSON or has no object of that name is one error row for the response. An entry that is no object,
    or lacks or garbles a value, is an error row under the policies of CSV lines, with ``time: entry`` as its line. An empty object
    has no bars and no error; JSON with a repeated name is malformed. Every verdict is local to a response, so nothing is shuffled.
    """
    check_policy(on_bad_line)
    fields, names = fields or {}, method_of(method).schema.names
    identity = [*keys, "response_id"]
    parsed = responses.select(*identity, "status", "reason", F.try_parse_json("body").alias("_value"))
    found = parsed.select(
        *identity, "status", "reason", "_value",
        F.try_variant_get("_value", _path(series), "map<string, variant>").alias("_series"))
    problem = F.coalesce(
        F.when(F.col("status").isNull(), F.coalesce("reason", F.lit("no response"))),
        F.when(F.col("status") != OK, F.concat_ws(" ", F.lit("status"), "status", "reason")),
        F.when(F.col("_value").isNull(), F.lit("bad json")),
        F.when(F.col("_series").isNull(), F.lit(f"no {series}")))
    found = found.select(*identity, problem.alias("problem"), "_series")
    found = found.withColumn("_series", F.when(F.col("problem").isNull(), F.col("_series")))
    if on_bad_line == "void_response":
        def bad(entry):
            values = parse.typed_columns(F.array(*_texts(entry["key"], entry["value"], names, fields)), method, zone)
            return F.greatest(*(v.isNull() for v in values))

        found = found.withColumn("_void", F.coalesce(F.exists(F.map_entries("_series"), bad), F.lit(False)))
    else:
        found = found.withColumn("_void", F.lit(False))
    entries = found.select(*identity, "problem", "_void", F.explode_outer("_series").alias("_time", "_entry"))
    entries = entries.filter(F.col("_time").isNotNull() | F.col("problem").isNotNull())
    passed = [*identity, "problem", "_void"]
    line = F.concat(F.col("_time"), F.lit(": "), F.coalesce(F.to_json("_entry"), F.lit("null")))
    parts = entries.select(
        *passed, line.alias("line"), F.array(*_texts(F.col("_time"), F.col("_entry"), names, fields)).alias("_parts"))
    parts_col = F.col("_parts")
    # The first absent value plays the end of a short line, so that reasons read alike.
    absent = [F.when(parse.token(parts_col, i).isNull(), F.lit(i)) for i in range(len(names))]
    typed = parts.select(
        *passed, "line", F.coalesce(*absent, F.lit(len(names))).alias("tokens"), *parse.typed_columns(parts_col, method, zone))
    read = typed.select(*passed, "line", F.inline(F.array(F.struct("tokens", *names))))
    reason = F.coalesce("problem", parse.reason_column(method))
    read = read.withColumn("_reason", reason)
    errors = read.filter(F.col("_reason").isNotNull()).select(*identity, "line", F.col("_reason").alias("reason"))
    if on_bad_line == "fail":
        bars = read.filter(stop_on(F.col("_reason"), F.col("response_id"), F.col("line")))
    else:
        bars = read.filter(F.col("_reason").isNull() & ~F.col("_void"))
    return Parsed(bars.select(*keys, *names), errors)
