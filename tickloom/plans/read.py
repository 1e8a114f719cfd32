"""Reading series: one symbol, one pair, many of them, or landed files."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.bad_lines import Parsed, parse_lines, parse_responses
from tickloom.plans.methods import RequestSpec, method_of
from tickloom.sources.landing import landed_lines, partition_names
from tickloom.sources.requests import Files, Http, Policy, fetch
from tickloom.sources.responses import ALL, FORMAT, register
from tickloom.sources.shared import written_once


def request_options(spec: RequestSpec) -> dict[str, str]:
    return {
        "method": spec.method,
        "zone": spec.zone,
        "interval": spec.interval,
        "slices": spec.slice,
        "outputsize": spec.output_size,
        "adjusted": str(spec.adjusted).lower(),
        "apikey": spec.api_key,
    }


def read_responses(
    spark: SparkSession,
    spec: RequestSpec,
    series: Sequence[tuple[str, ...]] | None,
    *,
    written: bool = False,
    **options: str,
) -> DataFrame:
    """Raw responses of many series, one request each; None means every landed series (``file`` transport).

    ``written=True`` sends the requests now, once, and keeps the responses in the
    shared folder, so that later branches and retries do not repeat them.
    """
    register(spark)
    name = "symbols" if method_of(spec.method).kind == "equity" else "pairs"
    responses = (
        spark.read.format(FORMAT)
        .options(**request_options(spec))
        .option(name, ALL if series is None else json.dumps(["/".join(one) for one in series]))
        .options(**options)
        .load()
    )
    return written_once(responses, "responses") if written else responses


def _read_many(spark, spec, series, on_bad_line, options) -> Parsed:
    responses = read_responses(spark, spec, series, written=True, **options)
    return parse_responses(
        responses, spec.method, zone=spec.zone, keys=partition_names(spec.method),
        on_bad_line=on_bad_line,
    )


def read_symbols(
    spark: SparkSession,
    spec: RequestSpec,
    symbols: Sequence[str] | None,
    *,
    on_bad_line: str = "quarantine",
    **options: str,
) -> Parsed:
    """Many equity series: bars and errors, both with a ``symbol`` column."""
    method_of(spec.method, "equity")
    series = None if symbols is None else [(s,) for s in symbols]
    return _read_many(spark, spec, series, on_bad_line, options)


def read_pairs(
    spark: SparkSession,
    spec: RequestSpec,
    pairs: Sequence[tuple[str, str]] | None,
    *,
    on_bad_line: str = "quarantine",
    **options: str,
) -> Parsed:
    """Many currency pairs: bars and errors, both with the two key columns."""
    method_of(spec.method, "fx")
    return _read_many(spark, spec, None if pairs is None else list(pairs), on_bad_line, options)


def read_requests(
    requests: DataFrame,
    spec: RequestSpec,
    transport: Http | Files,
    journal: str | None = None,
    *,
    policy: Policy = Policy(),
    on_bad_line: str = "quarantine",
) -> Parsed:
    """Bars and errors of a table of requests, both with the series keys; see ``tickloom.sources.requests``."""
    responses = fetch(requests, spec, transport, journal, policy=policy)
    return parse_responses(
        responses, spec.method, zone=spec.zone, keys=partition_names(spec.method), on_bad_line=on_bad_line)


def _read_one(spark, spec, series, on_bad_line, options) -> DataFrame:
    responses = read_responses(spark, spec, [series], **options)
    return parse_responses(
        responses, spec.method, zone=spec.zone, on_bad_line=on_bad_line
    ).bars


def read_symbol(
    spark: SparkSession, spec: RequestSpec, symbol: str, *,
    on_bad_line: str = "quarantine", **options: str,
) -> DataFrame:
    """One equity series in exactly the method's columns."""
    method_of(spec.method, "equity")
    return _read_one(spark, spec, (symbol,), on_bad_line, options)


def read_forex(
    spark: SparkSession, spec: RequestSpec, from_symbol: str = "EUR", to_symbol: str = "USD", *,
    on_bad_line: str = "quarantine", **options: str,
) -> DataFrame:
    """One currency pair in exactly the method's columns."""
    method_of(spec.method, "fx")
    return _read_one(spark, spec, (from_symbol, to_symbol), on_bad_line, options)


def read_landing(
    spark: SparkSession,
    root: str,
    method: str,
    *,
    zone: str,
    on_bad_line: str = "quarantine",
    check_header: bool = True,
    newest_first: bool | None = None,
) -> Parsed:
    """Landed response files of one method; see ``tickloom.sources.landing`` for the layout."""
    return parse_lines(
        landed_lines(spark, root, method), method, zone=zone, keys=partition_names(method),
        on_bad_line=on_bad_line, check_header=check_header, position="position", newest_first=newest_first,
    )
