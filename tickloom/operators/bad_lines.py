"""CSV lines and responses to typed bars, with bad data kept as an error frame.

Policies for a line that cannot be read: ``quarantine`` keeps the good lines of
its response, ``void_response`` drops every bar of that response, ``fail`` stops
the query. A response whose first column is not a time column is an error
response under every policy.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions import parse
from tickloom.operators.clock import with_second_hours
from tickloom.plans.methods import method_of
from tickloom.sources.shared import discard, in_small_tasks, new_path

POLICIES = ("quarantine", "void_response", "fail")
OK = 200
NO_HEADER = "no header"


class Parsed(NamedTuple):
    bars: DataFrame  # keys and the method's columns
    errors: DataFrame  # keys, response_id, line, reason; line is NULL for a whole response
    written: tuple[str, ...] = ()  # tables in the shared folder that both frames read

    def discard(self) -> None:
        """Delete what was written, once the frames are done with."""
        for path in self.written:
            discard(self.bars.sparkSession, path)


def check_policy(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"bad-line policy {policy!r} is not supported")


def _typed(lines: DataFrame, passed: tuple[str, ...], method: str, zone: str) -> DataFrame:
    """Add the method's columns and ``_bad``, the reason a line cannot be read.

    The parsed line goes through a one-row ``inline``: a filter on parsed columns
    then stays above it and every token is read once, while a filter on the passed
    columns still moves down to the scan.
    """
    parts = F.col("_parts")
    split = lines.select(*passed, "line", parse.tokens(F.col("line")).alias("_parts"))
    typed = split.select(
        *passed, "line", F.size(parts).alias("tokens"),
        *parse.typed_columns(parts, method, zone),
    )
    row = F.struct("tokens", *method_of(method).schema.names)
    return typed.select(*passed, "line", F.inline(F.array(row))).withColumn(
        "_bad", parse.reason_column(method)
    )


def stop_on(problem: Column, response_id: Column, line: Column) -> Column:
    message = F.concat_ws(": ", response_id, problem, line)
    return F.when(problem.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)


def _first_line(position: str | None) -> list[Column]:
    """Per response: whether its first line is a header, and how many headers it has."""
    header = parse.is_header(F.col("line"))
    first = F.min(F.struct(F.col(position), header.alias("header"))) if position else None
    found = F.max(header) if first is None else first.getField("header")
    return [found.alias("has_header"), F.count(F.when(header, 1)).alias("headers")]


def _same_response(verdicts: DataFrame, names: list[str]) -> Column:
    """Null-safe equality with a verdict of every column that identifies a response."""
    same = F.lit(True)
    for i, name in enumerate(names):
        same = same & F.col(name).eqNullSafe(verdicts[f"_v{i}"])
    return same


def parse_lines(
    lines: DataFrame,
    method: str,
    *,
    zone: str,
    keys: tuple[str, ...] = (),
    on_bad_line: str = "quarantine",
    check_header: bool = True,
    position: str | None = None,
    newest_first: bool | None = None,
) -> Parsed:
    """Parse a frame of (keys, response_id, line[, position]), one row per line in any order.

    A response is what shares keys and response_id, NULLs included. Its first line that is not blank
    has to be a header; ``position`` orders its lines, and without it any header counts as the first line. Further
    header lines are bad lines. Blank lines are dropped.

    Checking headers or voiding needs a verdict per response, so a pass over the lines **runs when this is
    called**. For headers alone it looks at the lines' starts and writes a row only for each response that has something wrong.
    Voiding parses every line once into a written table that the verdict, bars and errors read.
    ``Parsed.discard`` deletes what was written. Of more lines than one task should group, what the verdicts need is dealt by
    response and line, so that a task groups a bounded number. Beyond that lines are never shuffled while the verdicts are small;
    a large table falls back to a shuffled anti join that adaptive execution splits on hot responses.
    ``newest_first`` says which way the times of a response run along ``position``; given, intraday times that a clock change
    repeats are told apart (``with_second_hours``), else they are their first occurrence. With
    ``check_header=False`` and no voiding the parse is a single pass, and all header lines are dropped.
    """
    check_policy(on_bad_line)
    names = method_of(method).schema.names
    identity = [*keys, "response_id"]
    if newest_first is not None and position is None:
        raise ValueError("newest_first needs a position")
    told_apart = newest_first is not None and method_of(method).intraday
    spark = lines.sparkSession
    voiding = on_bad_line == "void_response"
    checked = check_header or voiding
    written: list[str] = []

    def once(df: DataFrame, name: str) -> DataFrame:
        written.append(new_path(spark, name))
        df.write.parquet(written[-1])
        return spark.read.schema(df.schema).parquet(written[-1])

    filled = lines.filter(parse.is_filled(F.col("line")))
    passed = (*identity, position) if position else tuple(identity)
    if voiding:
        typed = once(_typed(filled, passed, method, zone), "parsed-lines")
        data = typed.filter(~parse.is_header(F.col("line")))
        source, bad_line = typed, ~parse.is_header(F.col("line")) & F.col("_bad").isNotNull()
    else:
        kept = passed if told_apart else tuple(identity)
        data = _typed(lines.filter(parse.is_data(F.col("line"))), kept, method, zone)
        source, bad_line = filled, F.lit(False)
    good, bad = data.filter(F.col("_bad").isNull()), data.filter(F.col("_bad").isNotNull())
    errors = bad.select(*identity, "line", F.col("_bad").alias("reason"))

    if checked:
        lines_read = typed.count() if voiding else lines.count()
        judged = source.select(*passed, "line", bad_line.alias("_bad_line"))
        judged = in_small_tasks(judged, lines_read, *identity, "line")
        verdicts = judged.groupBy(*identity).agg(*_first_line(position), F.max("_bad_line").alias("has_bad"))
        headless = ~F.col("has_header") if check_header else F.lit(False)
        repeated = F.greatest(F.col("headers") - F.col("has_header").cast("int"), F.lit(0)) if check_header else F.lit(0)
        verdicts = verdicts.select(
            *(F.col(name).alias(f"_v{i}") for i, name in enumerate(identity)),
            headless.alias("headless"), repeated.cast("bigint").alias("repeated"), "has_bad",
        ).filter("headless OR repeated > 0 OR has_bad")
        verdicts = once(verdicts, "verdicts")
        without_header = verdicts.filter("headless")
        if on_bad_line == "fail":
            first = verdicts.head()
            if first is not None:
                raise ValueError(f"{first[f'_v{len(keys)}']}: {NO_HEADER if first['headless'] else 'repeated header'}")
        rejected = verdicts if voiding else without_header
        good = good.join(rejected, _same_response(rejected, identity), "left_anti")
        errors = errors.join(without_header, _same_response(without_header, identity), "left_anti")
        named = [F.col(f"_v{i}").alias(name) for i, name in enumerate(identity)]
        errors = errors.unionByName(without_header.select(
            *named, F.lit(None).cast("string").alias("line"), F.lit(NO_HEADER).alias("reason"),
        ))
        # Few responses repeat their header. Which of equal lines is the first does not matter to the error rows.
        again = verdicts.filter("repeated > 0 AND NOT headless")
        heads = source.filter(parse.is_header(F.col("line"))).join(again, _same_response(again, identity))
        order = Window.partitionBy(*identity).orderBy(position or "line")
        heads = heads.withColumn("_number", F.row_number().over(order)).filter("_number > 1")
        errors = errors.unionByName(heads.select(*identity, "line", F.lit("bad timestamp").alias("reason")))
    if on_bad_line == "fail":
        good = data.filter(stop_on(F.col("_bad"), F.col("response_id"), F.col("line")))
    if told_apart:
        good = with_second_hours(
            good.select(*passed, *names), zone, response=identity, position=position, newest_first=newest_first)
    return Parsed(good.select(*keys, *names), errors, tuple(written))


def response_lines(responses: DataFrame, *, keys: tuple[str, ...] = ()) -> DataFrame:
    """Split whole bodies into an array of data lines, or the response's problem.

    Input is (keys, response_id, status, reason, body). Lines are split on the
    whole body, so none is ever cut in two.
    """
    body = parse.trimmed(F.col("body"))
    lines = responses.select(
        *keys, "response_id", "status", "reason", F.split(body, "\n").alias("_lines")
    )
    first = F.get(F.col("_lines"), F.lit(0))
    has_body = F.coalesce(first != "", F.lit(False))
    problem = F.coalesce(
        F.when(F.col("status").isNull(), F.coalesce("reason", F.lit("no response"))),
        F.when(F.col("status") != OK, F.concat_ws(" ", F.lit("status"), "status", "reason")),
        F.when(has_body & ~parse.is_header(first), F.lit(NO_HEADER)),
    )
    marked = lines.select(*keys, "response_id", "_lines", problem.alias("problem"))
    data = F.slice(F.col("_lines"), F.lit(2), F.greatest(F.size("_lines") - 1, F.lit(0)))
    return marked.select(
        *keys, "response_id", "problem", F.when(F.col("problem").isNull(), data).alias("data")
    )


def parse_responses(
    responses: DataFrame,
    method: str,
    *,
    zone: str,
    keys: tuple[str, ...] = (),
    on_bad_line: str = "quarantine",
    newest_first: bool | None = None,
) -> Parsed:
    """Parse whole responses (keys, response_id, status, reason, body).

    Every verdict is local to a row, so nothing is shuffled under any policy. ``newest_first`` as in ``parse_lines``; given,
    intraday bars in an hour that a clock change repeats are shuffled, and a response's id names it.
    """
    check_policy(on_bad_line)
    names = method_of(method).schema.names
    split = response_lines(responses, keys=keys)
    told_apart = newest_first is not None and method_of(method).intraday
    at = ("_at",) if told_apart else ()
    each, each_outer = (F.posexplode, F.posexplode_outer) if told_apart else (F.explode, F.explode_outer)
    exploded = split.select(*keys, "response_id", "problem", each_outer("data").alias(*at, "line"))
    exploded = exploded.filter(parse.is_filled(F.col("line")) | F.col("problem").isNotNull())
    read = _typed(exploded, (*keys, "response_id", "problem", *at), method, zone)
    reason = F.coalesce("problem", "_bad")
    errors = read.filter(reason.isNotNull()).select(
        *keys, "response_id", "line", reason.alias("reason")
    )
    if on_bad_line == "fail":
        bars = read.filter(stop_on(reason, F.col("response_id"), F.col("line")))
    elif on_bad_line == "void_response":
        clean = ~F.exists(
            "data", lambda line: parse.is_filled(line) & parse.is_bad_line(line, method, zone)
        )
        kept = split.filter(F.col("problem").isNull()).filter(clean)
        whole = kept.select(*keys, "response_id", each("data").alias(*at, "line"))
        bars = _typed(
            whole.filter(parse.is_filled(F.col("line"))), (*keys, "response_id", *at), method, zone
        )
    else:
        bars = read.filter(reason.isNull())
    if told_apart:
        identity = (*keys, "response_id")
        bars = with_second_hours(
            bars.select(*identity, "_at", *names), zone, response=identity, position="_at", newest_first=newest_first)
    return Parsed(bars.select(*keys, *names), errors)
