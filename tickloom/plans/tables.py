"""The operators as queries over the test tables.

``lineitem`` rows serve as trades with volume (symbol = return flag, one price per
row, days as time), ``events`` rows as trades on an intraday clock. Every query
reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.calendar import millis_to_local
from tickloom.operators.adjust import adjust_intraday, daily_with_events, with_adj_close
from tickloom.operators.bad_lines import Parsed, parse_lines, parse_responses
from tickloom.operators.bodies import Bodies, json_bodies, text_bodies
from tickloom.operators.json_series import parse_json_series
from tickloom.operators.resample import bars_from_bars, bars_from_ticks, with_partial_flag
from tickloom.operators.select import in_slice, latest_points, with_slice
from tickloom.plans.local import series_from_ticks
from tickloom.plans.methods import INTERVALS, METHODS, RequestSpec, method_of
from tickloom.plans.read import read_forex, read_landing, read_pairs, read_requests, read_symbols
from tickloom.plans.series import as_bars, as_series, csv_columns, csv_header, csv_line
from tickloom.plans.store import BarStore
from tickloom.sources.requests import Files, fetch, request_table
from tickloom.sources.shared import in_small_tasks, new_path, written_once

ZONE = "UTC"
NEW_YORK = "America/New_York"
SYMBOL = ("symbol",)
PAIR = ("from_symbol", "to_symbol")
LINEITEM_ORDER = ("orderkey", "linenumber", "partkey", "suppkey", "price")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Ticks


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_returnflag").alias("from_symbol"),
        F.col("l_linestatus").alias("to_symbol"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
        price.alias("price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        (price * (1 - F.col("l_discount"))).alias("adj_close"),
        F.col("l_tax").alias("dividend_amount"),
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
    )


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("event_type").alias("from_symbol"),
        F.lit("USD").alias("to_symbol"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        "event_id",
    )


def lineitem_bars(spark, sf_dir, period, keys=SYMBOL, volume="volume", adjusted=False) -> DataFrame:
    columns = {"adj_close": "adj_close", "dividend": "dividend_amount"} if adjusted else {}
    return bars_from_ticks(
        lineitem_ticks(spark, sf_dir), period, keys=keys, tie_break=LINEITEM_ORDER,
        volume=volume, **columns,
    )


def event_bars(spark, sf_dir, period, keys=SYMBOL, volume=None) -> DataFrame:
    return bars_from_ticks(
        event_ticks(spark, sf_dir), period, keys=keys, tie_break=("event_id",), unique_ties=True, volume=volume
    )


def last_date(df: DataFrame) -> date:
    """The newest date of ``ts``, one aggregated row; the epoch's for an empty frame."""
    return df.agg(F.max(F.col("ts").cast("date"))).head()[0] or date(1970, 1, 1)


def event_days(daily: DataFrame, dividend_day: int, dividend: float, split_when: Column) -> DataFrame:
    """Made-up corporate actions on some dates of a daily series."""
    pays = F.dayofmonth("ts") == dividend_day
    return daily.filter(pays | split_when).select(
        "symbol", "ts",
        F.when(pays, F.lit(dividend)).otherwise(0.0).alias("dividend_amount"),
        F.when(split_when, F.lit(2.0)).otherwise(1.0).alias("split_coefficient"),
    )


def lineitem_events(daily: DataFrame) -> DataFrame:
    return event_days(daily, 15, 250.0, (F.month("ts") == 6) & (F.dayofmonth("ts") == 10))


def lineitem_adjusted_daily(spark, sf_dir) -> DataFrame:
    # A row per symbol and day, written once: the events and the bars both come from it.
    daily = written_once(lineitem_bars(spark, sf_dir, "day"), "daily")
    adjusted = with_adj_close(daily_with_events(daily, lineitem_events(daily)))
    return adjusted.withColumn("adj_close", F.round("adj_close", 4))


def intraday_events(daily: DataFrame) -> DataFrame:
    return event_days(daily, 15, 1.5, F.dayofmonth("ts") == 20)


def adjusted_intraday(spark, sf_dir, has_daily_row: Column | None = None) -> DataFrame:
    """Hourly bars adjusted by daily ones made from them; some days may lack their daily row."""
    hourly = written_once(event_bars(spark, sf_dir, "60min"), "hourly")
    daily = bars_from_bars(hourly, "day", source="60min")
    kept = daily if has_daily_row is None else daily.filter(has_daily_row)
    adjusted = adjust_intraday(hourly, daily_with_events(kept, intraday_events(daily)))
    rounded = {name: F.round(name, 4) for name in ("open", "high", "low", "close")}
    return as_series(adjusted.withColumns(rounded), "FX_INTRADAY", zone=ZONE, keys=SYMBOL)


def tied_intraday(spark, sf_dir) -> DataFrame:
    """Times cut to the minute and no tie-break: prices settle the many ties."""
    minute = F.make_timestamp_ntz(
        F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"), F.minute("ts"), F.lit(0))
    return bars_from_ticks(event_ticks(spark, sf_dir).withColumn("ts", minute), "5min")


def served(method: str, **request) -> Query:
    """A method's series from local trades, adjusted by made-up events."""
    spec = RequestSpec(method, zone=ZONE, **request)
    intraday = method_of(method).intraday

    def query(spark, sf_dir):
        ticks = event_ticks(spark, sf_dir) if intraday else lineitem_ticks(spark, sf_dir)
        order = ("event_id",) if intraday else LINEITEM_ORDER
        # Written once: the events and the newest date both come from it.
        daily = written_once(bars_from_ticks(ticks, "day", tie_break=order), "daily")
        events = intraday_events(daily) if intraday else lineitem_events(daily)
        series = series_from_ticks(ticks, spec, as_of=last_date(daily), events=events, tie_break=order)
        rounded = [n for n in series.columns if n in ("open", "high", "low", "close", "adj_close")]
        return series.withColumns({name: F.round(name, 4) for name in rounded})

    return query


# Bars out of states that arrive in batches


def stored_days(spark, sf_dir, adjusted: bool = False) -> BarStore:
    """Daily states of all trades in three batches that share every day, one sent twice, merged once in between."""
    columns = {"adj_close": "adj_close", "dividend": "dividend_amount"} if adjusted else {}
    store = BarStore(
        spark, new_path(spark, "states"), "day", tie_break=LINEITEM_ORDER, volume="volume", **columns)
    ticks = lineitem_ticks(spark, sf_dir)
    store.append(ticks.filter("linenumber > 4"), "late-lines")
    store.append(ticks.filter("linenumber BETWEEN 3 AND 4"), "middle-lines")
    store.compact()
    store.append(ticks.filter("linenumber < 3"), "first-lines")
    store.append(ticks.filter("linenumber > 4"), "late-lines")
    return store


def stored_5min(spark, sf_dir) -> BarStore:
    """Five-minute states of a batch for each third of the values."""
    store = BarStore(spark, new_path(spark, "states"), "5min", tie_break=("event_id",), volume="volume")
    ticks = event_ticks(spark, sf_dir)
    low, high = ticks.agg(F.percentile_approx("price", [0.33, 0.67])).first()[0] or (0.0, 0.0)
    unpriced = F.col("price").isNull()
    store.append(ticks.filter(F.col("price") > high), "high")
    store.append(ticks.filter(unpriced | (F.col("price") <= low)), "low")
    store.append(ticks.filter((F.col("price") > low) & (F.col("price") <= high)), "middle")
    return store


# Bars as CSV, read back


def method_bars(spark, sf_dir, method: str) -> tuple[DataFrame, tuple[str, ...]]:
    """Bars of the method's period and layout, and their key columns."""
    spec = method_of(method)
    volume = None if spec.kind == "fx" else "volume"
    if spec.intraday:
        bars = event_bars(spark, sf_dir, "60min", keys=spec.keys, volume=volume)
        if "slice" in spec.options:
            return with_slice(bars, last_date(event_ticks(spark, sf_dir))), (*spec.keys, "slice")
        return bars, spec.keys
    if spec.layout == "daily_adjusted":
        return lineitem_adjusted_daily(spark, sf_dir), spec.keys
    adjusted = spec.layout == "period_adjusted"
    return lineitem_bars(spark, sf_dir, spec.period, spec.keys, volume, adjusted), spec.keys


def with_header_lines(lines: DataFrame, header: Column, keys: Sequence[str]) -> DataFrame:
    """Add one header line to every response; the lines are written once, as both sides read them."""
    lines = written_once(lines, "lines")
    responses = in_small_tasks(lines, lines.count(), *keys, "response_id", "line")
    heads = responses.select(*keys, "response_id").distinct().withColumn("line", header)
    return lines.unionByName(heads)


def parsed_method(method: str, zone: str = ZONE) -> Query:
    """Bars written as CSV lines with headers and parsed back."""

    def query(spark, sf_dir):
        bars, keys = method_bars(spark, sf_dir, method)
        lines = bars.select(*keys, F.concat_ws("/", *keys).alias("response_id"),
                            csv_line(method).alias("line"))
        lines = with_header_lines(lines, F.lit(csv_header(method)), keys)
        return parse_lines(lines, method, zone=zone, keys=keys).bars

    return query


def monthly_response_lines(spark, sf_dir) -> DataFrame:
    """Daily bars as lines, one response per symbol and month, some lines broken.

    The 31st has an unreadable high, the 29th of February is cut short.
    """
    daily = lineitem_bars(spark, sf_dir, "day")
    line = csv_line("TIME_SERIES_DAILY")
    day = F.col("ts").cast("string")
    broken = (
        F.when(F.dayofmonth("ts") == 31, F.concat_ws(",", day, "open", F.lit("x"), "low", "close", "volume"))
        .when((F.month("ts") == 2) & (F.dayofmonth("ts") == 29), F.concat_ws(",", day, "open", "high"))
        .otherwise(line)
    )
    response = F.concat_ws("-", "symbol", F.date_format("ts", "yyyy-MM"))
    return daily.select("symbol", "ts", response.alias("response_id"), broken.alias("line"))


def parsed_monthly(spark, sf_dir, policy: str) -> Parsed:
    lines = monthly_response_lines(spark, sf_dir).drop("ts")
    lines = with_header_lines(lines, F.lit(csv_header("TIME_SERIES_DAILY")), SYMBOL)
    return parse_lines(
        lines, "TIME_SERIES_DAILY", zone=ZONE, keys=SYMBOL, on_bad_line=policy
    )


def parsed_error_bodies(spark, sf_dir) -> Parsed:
    """February's responses start with a note in place of a header."""
    lines = monthly_response_lines(spark, sf_dir).drop("ts")
    header = F.when(F.col("response_id").endswith("-02"), F.lit('{"Note": "limit"}')).otherwise(
        F.lit(csv_header("TIME_SERIES_DAILY"))
    )
    lines = with_header_lines(lines, header, SYMBOL)
    return parse_lines(lines, "TIME_SERIES_DAILY", zone=ZONE, keys=SYMBOL)


def positioned_lines(spark, sf_dir) -> DataFrame:
    """Daily bars as responses of a symbol and month whose lines have a place; the header is at 0."""
    daily = lineitem_bars(spark, sf_dir, "day")
    lines = daily.select(
        "symbol", F.date_format("ts", "yyyy-MM").alias("response_id"),
        csv_line("TIME_SERIES_DAILY").alias("line"), F.dayofmonth("ts").alias("position"))
    lines = written_once(lines, "lines")
    return lines.unionByName(extra_lines(lines, F.lit(csv_header("TIME_SERIES_DAILY")), 0))


def extra_lines(lines: DataFrame, line: Column, position: int) -> DataFrame:
    """One more line for every response."""
    return lines.select("symbol", "response_id").distinct().select(
        "symbol", "response_id", line.alias("line"), F.lit(position).alias("position"))


def parsed_positions(lines: DataFrame, policy: str = "quarantine") -> Parsed:
    return parse_lines(
        lines, "TIME_SERIES_DAILY", zone=ZONE, keys=SYMBOL, on_bad_line=policy, position="position")


def void_shared_ids(spark, sf_dir) -> DataFrame:
    """Response ids are months, the same for all symbols; only R's 31st cannot be read."""
    broken = (F.col("symbol") == "R") & (F.col("position") == 31)
    line = F.when(broken, F.concat("line", F.lit("x"))).otherwise(F.col("line"))
    return parsed_positions(positioned_lines(spark, sf_dir).withColumn("line", line), "void_response").bars


def header_first_line(spark, sf_dir) -> DataFrame:
    """A note before the header in February: those responses have no header."""
    lines = positioned_lines(spark, sf_dir)
    february = lines.filter(F.col("response_id").endswith("-02"))
    return parsed_positions(lines.unionByName(extra_lines(february, F.lit("note"), -1))).bars


def header_repeated(spark, sf_dir) -> Parsed:
    """Every response ends with its header again."""
    lines = positioned_lines(spark, sf_dir)
    return parsed_positions(lines.unionByName(extra_lines(lines, F.lit(csv_header("TIME_SERIES_DAILY")), 99)))


def parsed_trades(spark, sf_dir, policy: str) -> Parsed:
    """Every trade as a line of its own, one response per supplier and month.

    Lines of 50 pieces have an unreadable volume.
    """
    trades = lineitem_ticks(spark, sf_dir)
    volume = F.when(F.col("volume") == 50, "x").otherwise(F.col("volume").cast("string"))
    day = F.col("ts").cast("date")
    lines = trades.select(
        "symbol",
        F.concat_ws("-", "suppkey", F.substring(day.cast("string"), 1, 7)).alias("response_id"),
        F.concat_ws(",", day, *["price"] * 4, volume).alias("line"),
    )
    lines = lines.withColumn("response_id", F.concat_ws("-", "symbol", "response_id"))
    lines = with_header_lines(lines, F.lit(csv_header("TIME_SERIES_DAILY")), SYMBOL)
    return parse_lines(
        lines, "TIME_SERIES_DAILY", zone=NEW_YORK, keys=SYMBOL, on_bad_line=policy
    )


def monthly_responses(spark, sf_dir) -> DataFrame:
    """Whole responses of at most 31 lines; November answers 422 and December 500."""
    lines = monthly_response_lines(spark, sf_dir)
    month = F.month("ts")
    status = F.when(month == 11, 422).when(month == 12, 500).otherwise(200)
    grouped = lines.groupBy("symbol", "response_id", status.alias("status")).agg(
        F.array_sort(F.collect_list("line")).alias("lines")
    )
    return grouped.select(
        "symbol", "response_id", "status",
        F.when(F.col("status") == 200, "OK").when(F.col("status") == 422, "Unprocessable")
        .otherwise("Server Error").alias("reason"),
        F.concat_ws("\r\n", F.lit(csv_header("TIME_SERIES_DAILY")), "lines").alias("body"),
    )


def parsed_responses(spark, sf_dir, policy: str) -> Parsed:
    return parse_responses(
        monthly_responses(spark, sf_dir), "TIME_SERIES_DAILY", zone=ZONE, keys=SYMBOL,
        on_bad_line=policy,
    )


def json_responses(spark, sf_dir, broken: bool = False) -> DataFrame:
    """A JSON response for each symbol and month, entries keyed by day; prices as strings, the rest as numbers.

    Broken ones have an unreadable high on the 31st and no low on the 29th of February, and November answers 500.
    """
    daily = lineitem_bars(spark, sf_dir, "day")
    high, low = F.col("high").cast("string"), F.col("low").cast("string")
    if broken:
        high = F.when(F.dayofmonth("ts") == 31, "x").otherwise(high)
        low = F.when(~((F.month("ts") == 2) & (F.dayofmonth("ts") == 29)), low)
    entry = F.struct(
        F.col("open").cast("string").alias("1. open"), high.alias("2. high"), low.alias("3. low"),
        F.col("close").alias("4. close"), F.col("volume").alias("5. volume"))
    month = F.date_format("ts", "yyyy-MM")
    day = F.struct(F.col("ts").cast("date").cast("string").alias("key"), entry.alias("value"))
    grouped = daily.groupBy("symbol", month.alias("month")).agg(F.collect_list(day).alias("days"))
    refused = F.lit(broken) & F.col("month").endswith("-11")
    return grouped.select(
        "symbol", F.concat_ws("-", "symbol", "month").alias("response_id"),
        F.when(refused, 500).otherwise(200).alias("status"), F.when(refused, "Server Error").otherwise("OK").alias("reason"),
        F.concat(F.lit('{"Meta Data": {"2. Symbol": "x"}, "Series": '), F.to_json(F.map_from_entries("days")), F.lit("}")).alias("body"))


def parsed_json(spark, sf_dir, policy: str = "quarantine", broken: bool = True) -> Parsed:
    names = [n for n in method_of("TIME_SERIES_DAILY").schema.names if n != "timestamp"]
    return parse_json_series(
        json_responses(spark, sf_dir, broken), "TIME_SERIES_DAILY", zone=ZONE, series="Series", keys=SYMBOL,
        fields={name: f"{i}. {name}" for i, name in enumerate(names, 1)}, on_bad_line=policy)


def error_counts(errors: DataFrame) -> DataFrame:
    return errors.groupBy("symbol", "response_id", "reason").agg(F.count("*").alias("lines"))


def landed(spark, sf_dir, method: str) -> str:
    """Land a method's bars as response files in a fresh shared folder; returns its root.

    Ranges of (keys, time) are dealt to tasks, so the number of files follows the data, not tasks times
    series, and a series with most bars is split.
    """
    bars, keys = method_bars(spark, sf_dir, method)
    root = new_path(spark, "landing")
    (
        bars.repartitionByRange(*keys, "ts")
        .select(*keys, *csv_columns(method))
        .write.partitionBy(*keys)
        .option("header", True)
        .csv(f"{root}/{method}")
    )
    return root


def landing_files(spark, sf_dir) -> DataFrame:
    """Daily bars landed as files and read back by Spark's text source."""
    root = landed(spark, sf_dir, "TIME_SERIES_DAILY")
    return read_landing(spark, root, "TIME_SERIES_DAILY", zone=ZONE).bars


def source_file(spark, sf_dir) -> DataFrame:
    """The same files read by the data source, one task per series."""
    root = landed(spark, sf_dir, "TIME_SERIES_DAILY")
    spec = RequestSpec("TIME_SERIES_DAILY", zone=ZONE)
    return read_symbols(spark, spec, None, transport="file", path=root).bars


def source_file_fx(spark, sf_dir) -> DataFrame:
    root = landed(spark, sf_dir, "FX_DAILY")
    return read_pairs(spark, RequestSpec("FX_DAILY", zone=ZONE), None, transport="file", path=root).bars


def source_file_forex(spark, sf_dir) -> DataFrame:
    """One pair, in exactly the method's columns."""
    root = landed(spark, sf_dir, "FX_DAILY")
    return read_forex(spark, RequestSpec("FX_DAILY", zone=ZONE), "N", "O", transport="file", path=root)


def source_file_slices(spark, sf_dir) -> DataFrame:
    root = landed(spark, sf_dir, "TIME_SERIES_INTRADAY_EXTENDED")
    spec = RequestSpec("TIME_SERIES_INTRADAY_EXTENDED", zone=ZONE, interval="60min")
    return read_symbols(spark, spec, None, transport="file", path=root, slices="all").bars


def symbols_of(ticks: DataFrame) -> DataFrame:
    return ticks.select("symbol").distinct()


def source_file_requests(spark, sf_dir) -> DataFrame:
    """The same files by a table of requests, one for each symbol traded."""
    root = landed(spark, sf_dir, "TIME_SERIES_DAILY")
    spec = RequestSpec("TIME_SERIES_DAILY", zone=ZONE)
    requests = request_table(symbols_of(lineitem_ticks(spark, sf_dir)), spec)
    return read_requests(requests, spec, Files(root)).bars


def source_resumed(spark, sf_dir) -> DataFrame:
    """A journal that already holds some symbols' responses: only the others are read, all are returned."""
    root, journal = landed(spark, sf_dir, "TIME_SERIES_DAILY"), new_path(spark, "journal")
    spec = RequestSpec("TIME_SERIES_DAILY", zone=ZONE)
    requests = request_table(symbols_of(lineitem_ticks(spark, sf_dir)), spec)
    fetch(requests.filter("symbol < 'R'"), spec, Files(root), journal)
    return read_requests(requests, spec, Files(root), journal).bars


def slice_requests(spark, sf_dir) -> Parsed:
    """A request for every symbol and slice, also for slices without data."""
    root = landed(spark, sf_dir, "TIME_SERIES_INTRADAY_EXTENDED")
    spec = RequestSpec("TIME_SERIES_INTRADAY_EXTENDED", zone=ZONE, interval="60min")
    requests = request_table(symbols_of(event_ticks(spark, sf_dir)), spec, slices="all")
    return read_requests(requests, spec, Files(root))


# Bodies


def page_bodies(spark, sf_dir) -> Bodies:
    """Pages as responses: French ones answer 500, ones with a query string 422."""
    status = (
        F.when(F.col("url").contains("/fr/"), 500).when(F.col("url").contains("?"), 422).otherwise(200)
    )
    return text_bodies(
        table(spark, sf_dir, "pages").select(
            F.col("page_id").alias("response_id"),
            status.alias("status"),
            F.lit("").alias("reason"),
            F.col("html").alias("body"),
        )
    )


def event_json(spark, sf_dir, schema=None) -> Bodies:
    """Event properties as JSON responses; those of error events lack their last brace."""
    props = F.col("props")
    body = F.when(F.col("event_type") == "error", F.rtrim(props, F.lit("}"))).otherwise(props)
    return json_bodies(
        table(spark, sf_dir, "events").select(
            F.col("event_id").alias("response_id"),
            F.lit(200).alias("status"),
            F.lit("OK").alias("reason"),
            body.alias("body"),
        ),
        schema=schema,
    )


def misfit_json(spark, sf_dir) -> Bodies:
    """Event properties of which some hold another type than the schema, or no object."""
    body = F.when(F.col("event_id") % 5 == 0, '{"k":"x"}').when(F.col("event_id") % 7 == 0, "[1,2]").otherwise(
        F.col("props"))
    return json_bodies(
        table(spark, sf_dir, "events").select(
            F.col("event_id").alias("response_id"), F.lit(200).alias("status"), F.lit("OK").alias("reason"),
            body.alias("body")),
        schema="k bigint")


# The queries


def _series(bars: Callable, method: str, keys=SYMBOL, extra=()) -> Query:
    def query(spark, sf_dir):
        return as_series(bars(spark, sf_dir), method, zone=ZONE, keys=(*keys, *extra))

    return query


def slice_query(name: str) -> Query:
    def query(spark, sf_dir):
        ticks = lineitem_ticks(spark, sf_dir)
        kept = in_slice(ticks, name, last_date(ticks))
        bars = bars_from_ticks(kept, "day", tie_break=LINEITEM_ORDER, volume="volume")
        return as_series(bars, "TIME_SERIES_DAILY", zone=ZONE, keys=SYMBOL)

    return query


def all_slices(spark, sf_dir) -> DataFrame:
    ticks = lineitem_ticks(spark, sf_dir)
    sliced = with_slice(ticks, last_date(ticks))
    bars = bars_from_ticks(
        sliced, "day", keys=("symbol", "slice"), tie_break=LINEITEM_ORDER, volume="volume"
    )
    return as_series(bars, "TIME_SERIES_DAILY", zone=ZONE, keys=("symbol", "slice"))


def partial_query(period: str, method: str) -> Query:
    def query(spark, sf_dir):
        as_of = last_date(lineitem_ticks(spark, sf_dir))
        bars = with_partial_flag(lineitem_bars(spark, sf_dir, period), period, as_of)
        return as_series(bars, method, zone=ZONE, keys=("symbol", "is_partial"))

    return query


def parsed_new_york_dst(spark, sf_dir) -> DataFrame:
    """Hourly bars spread over a year, so both clock changes lie in it, as New York lines parsed back."""
    spread = F.expr("ts + make_dt_interval(int(event_id % 12) * 30)")
    ticks = event_ticks(spark, sf_dir).withColumn("ts", spread)
    bars = bars_from_ticks(ticks, "60min", tie_break=("event_id",), volume="volume")
    # Local hours that a clock change skips or repeats have no single instant.
    bars = bars.filter(~((F.hour("ts").isin(1, 2)) & F.month("ts").isin(3, 11)))
    lines = bars.select("symbol", F.col("symbol").alias("response_id"), csv_line("TIME_SERIES_INTRADAY").alias("line"))
    return parse_lines(
        with_header_lines(lines, F.lit(csv_header("TIME_SERIES_INTRADAY")), SYMBOL), "TIME_SERIES_INTRADAY",
        zone=NEW_YORK, keys=SYMBOL).bars


def parsed_repeated_hours(spark, sf_dir) -> DataFrame:
    """Hourly bars of five days around a clock change, as New York lines from new to old, parsed back to their instants."""
    moved = F.expr("ts + make_dt_interval(305 - day(ts) + day(ts) % 5)")
    ticks = event_ticks(spark, sf_dir).withColumn("ts", moved)
    bars = bars_from_ticks(ticks, "60min", tie_break=("event_id",), volume="volume")
    instant = F.timestamp_millis(F.unix_millis(F.to_timestamp_ltz(F.concat(F.col("ts").cast("string"), F.lit("+00:00")))))
    local = F.timestamp_millis(F.unix_millis(F.from_utc_timestamp(instant, NEW_YORK)))
    bars = bars.withColumn("position", -F.unix_millis(instant)).withColumn("ts", millis_to_local(F.unix_millis(local), "UTC"))
    lines = bars.select(
        "symbol", F.col("symbol").alias("response_id"), csv_line("TIME_SERIES_INTRADAY").alias("line"), "position")
    heads = lines.select("symbol", "response_id").distinct().select(
        "*", F.lit(csv_header("TIME_SERIES_INTRADAY")).alias("line"), F.lit(-(2**62)).alias("position"))
    return parse_lines(
        lines.unionByName(heads), "TIME_SERIES_INTRADAY", zone=NEW_YORK, keys=SYMBOL, position="position",
        newest_first=True).bars


def zone_round_trip(spark, sf_dir) -> DataFrame:
    """A New York series turned back into exchange-local bars."""
    bars = event_bars(spark, sf_dir, "30min", volume="volume")
    series = as_series(bars, "TIME_SERIES_INTRADAY", zone=NEW_YORK, keys=SYMBOL)
    local = as_bars(series, "TIME_SERIES_INTRADAY", zone=NEW_YORK, keys=SYMBOL)
    return local.withColumn("ts", F.col("ts").cast("string"))


def build_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for interval in INTERVALS:
        found[f"intraday_{interval}"] = _series(
            lambda s, d, p=interval: event_bars(s, d, p), "FX_INTRADAY"
        )
    found["intraday_equity_5min"] = _series(
        lambda s, d: event_bars(s, d, "5min", volume="volume"), "TIME_SERIES_INTRADAY"
    )
    for name, period in (("daily", "day"), ("weekly", "week"), ("monthly", "month")):
        title = name.upper()
        found[name] = _series(
            lambda s, d, p=period: lineitem_bars(s, d, p), f"TIME_SERIES_{title}"
        )
        found[f"fx_{name}"] = _series(
            lambda s, d, p=period: lineitem_bars(s, d, p, PAIR, None), f"FX_{title}", PAIR
        )
    found["fx_intraday"] = _series(
        lambda s, d: event_bars(s, d, "15min", PAIR), "FX_INTRADAY", PAIR
    )
    for name, period in (("weekly", "week"), ("monthly", "month")):
        found[f"{name}_adj"] = _series(
            lambda s, d, p=period: lineitem_bars(s, d, p, adjusted=True),
            f"TIME_SERIES_{name.upper()}_ADJUSTED",
        )
        found[f"{name}_from_daily"] = _series(
            lambda s, d, p=period: bars_from_bars(lineitem_bars(s, d, "day"), p, source="day"),
            f"TIME_SERIES_{name.upper()}",
        )
        found[f"partial_{name}"] = partial_query(period, f"TIME_SERIES_{name.upper()}")
    found["hourly_from_5min"] = _series(
        lambda s, d: bars_from_bars(event_bars(s, d, "5min"), "60min", source="5min"), "FX_INTRADAY"
    )
    found["daily_adj"] = _series(lineitem_adjusted_daily, "TIME_SERIES_DAILY_ADJUSTED")
    found["intraday_adj"] = adjusted_intraday
    found["intraday_adj_gaps"] = lambda s, d: adjusted_intraday(s, d, F.dayofmonth("ts") % 3 != 0)
    found["intraday_5min_ties"] = _series(tied_intraday, "FX_INTRADAY")
    found["served_intraday_adj_compact"] = served("TIME_SERIES_INTRADAY", interval="60min", adjusted=True)
    found["served_extended_slice_adj"] = served("TIME_SERIES_INTRADAY_EXTENDED", interval="30min", adjusted=True)
    found["served_weekly_adj"] = served("TIME_SERIES_WEEKLY_ADJUSTED", output_size="full")
    found["served_monthly_adj"] = served("TIME_SERIES_MONTHLY_ADJUSTED", output_size="full")
    for name, period in (("daily", None), ("weekly", "week"), ("monthly", "month")):
        found[f"stored_{name}"] = _series(
            lambda s, d, p=period: stored_days(s, d).bars(p), f"TIME_SERIES_{name.upper()}")
    found["stored_weekly_adj"] = _series(
        lambda s, d: stored_days(s, d, adjusted=True).bars("week"), "TIME_SERIES_WEEKLY_ADJUSTED")
    found["stored_changes"] = _series(
        lambda s, d: stored_days(s, d).changed("first-lines"), "TIME_SERIES_DAILY")
    found["stored_intraday"] = _series(lambda s, d: stored_5min(s, d).bars(), "TIME_SERIES_INTRADAY")
    found["stored_intraday_60min"] = _series(lambda s, d: stored_5min(s, d).bars("60min"), "TIME_SERIES_INTRADAY")
    for name in ("year1month1", "year1month2", "year2month12"):
        found[f"slice_{name}"] = slice_query(name)
    found["slices_all"] = all_slices
    found["compact_daily"] = _series(
        lambda s, d: latest_points(lineitem_bars(s, d, "day")), "TIME_SERIES_DAILY"
    )
    found["compact_intraday"] = _series(
        lambda s, d: latest_points(event_bars(s, d, "5min")), "FX_INTRADAY"
    )
    for method in METHODS:
        found[f"parse_{method.lower()}"] = parsed_method(method)
    found["parse_new_york"] = parsed_method("TIME_SERIES_INTRADAY", NEW_YORK)
    found["parse_new_york_dst"] = parsed_new_york_dst
    found["zone_round_trip"] = zone_round_trip
    found["bad_lines_quarantine"] = lambda s, d: parsed_monthly(s, d, "quarantine").bars
    found["bad_lines_void"] = lambda s, d: parsed_monthly(s, d, "void_response").bars
    found["bad_lines_errors"] = lambda s, d: error_counts(parsed_monthly(s, d, "quarantine").errors)
    found["trades_quarantine"] = lambda s, d: parsed_trades(s, d, "quarantine").bars
    found["trades_void"] = lambda s, d: parsed_trades(s, d, "void_response").bars
    found["trades_errors"] = lambda s, d: error_counts(parsed_trades(s, d, "quarantine").errors)
    found["header_check"] = lambda s, d: parsed_error_bodies(s, d).bars
    found["header_check_errors"] = lambda s, d: error_counts(parsed_error_bodies(s, d).errors)
    found["void_shared_ids"] = void_shared_ids
    found["header_first_line"] = header_first_line
    found["header_repeated"] = lambda s, d: header_repeated(s, d).bars
    found["header_repeated_errors"] = lambda s, d: error_counts(header_repeated(s, d).errors)
    found["responses_quarantine"] = lambda s, d: parsed_responses(s, d, "quarantine").bars
    found["responses_void"] = lambda s, d: parsed_responses(s, d, "void_response").bars
    found["responses_errors"] = lambda s, d: error_counts(parsed_responses(s, d, "quarantine").errors)
    found["text_body"] = lambda s, d: page_bodies(s, d).bodies
    found["text_body_errors"] = lambda s, d: page_bodies(s, d).errors
    found["json_body"] = lambda s, d: event_json(s, d).bodies.select(
        "response_id", F.variant_get("json", "$.k", "bigint").alias("k")
    )
    found["json_body_schema"] = lambda s, d: event_json(s, d, "k bigint").bodies.select(
        "response_id", F.col("json.k").alias("k")
    )
    found["json_body_errors"] = lambda s, d: event_json(s, d).errors
    found["json_bars"] = lambda s, d: parsed_json(s, d, broken=False).bars
    found["json_bars_quarantine"] = lambda s, d: parsed_json(s, d).bars
    found["json_bars_void"] = lambda s, d: parsed_json(s, d, "void_response").bars
    found["json_bars_errors"] = lambda s, d: error_counts(parsed_json(s, d).errors)
    found["parse_repeated_hours"] = parsed_repeated_hours
    found["landing_files"] = landing_files
    found["source_file"] = source_file
    found["source_file_fx"] = source_file_fx
    found["source_file_forex"] = source_file_forex
    found["source_file_slices"] = source_file_slices
    found["source_file_requests"] = source_file_requests
    found["source_resumed"] = source_resumed
    found["source_requests_slices"] = lambda s, d: slice_requests(s, d).bars
    found["source_requests_errors"] = lambda s, d: slice_requests(s, d).errors.select("symbol", "slice", "reason")
    found["json_body_misfit"] = lambda s, d: misfit_json(s, d).bodies.select("response_id", F.col("json.k").alias("k"))
    found["json_body_misfit_errors"] = lambda s, d: misfit_json(s, d).errors
    return found
