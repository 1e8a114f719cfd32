"""DuckDB SQL for each query of ``tickloom.plans.tables``, written independently of it."""

from __future__ import annotations

LINE_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
EVENT_ORDER = "ts, event_id"
LINE_VOLUME = "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume"
EVENT_VOLUME = "CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS volume"
LINE_DAY = "date_trunc('day', l_shipdate)"
AS_OF_LINE = "(SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)"
AS_OF_EVENT = "(SELECT CAST(max(ts) AS DATE) FROM events)"


def ohlc(price: str, order: str) -> str:
    return (
        f"first({price} ORDER BY {order}) AS open, max({price}) AS high, "
        f"min({price}) AS low, last({price} ORDER BY {order}) AS close"
    )


def bars(table: str, keys: dict[str, str], bucket: str, label: str, measures: list[str],
         where: str = "TRUE") -> str:
    named = ", ".join(f"{sql} AS {name}" for name, sql in keys.items())
    groups = ", ".join([*keys.values(), bucket])
    return (
        f"SELECT {named}, epoch_ms({label}) AS \"timestamp\", {', '.join(measures)} "
        f"FROM {table} WHERE {where} GROUP BY {groups}"
    )


SYMBOL_LINE = {"symbol": "l_returnflag"}
PAIR_LINE = {"from_symbol": "l_returnflag", "to_symbol": "l_linestatus"}
SYMBOL_EVENT = {"symbol": "event_type"}
PAIR_EVENT = {"from_symbol": "event_type", "to_symbol": "'USD'"}


def line_bars(period: str, keys=None, volume=True, adjusted=False, where="TRUE", extra=()) -> str:
    bucket = f"date_trunc('{period}', l_shipdate)"
    label = bucket if period == "day" else "max(date_trunc('day', l_shipdate))"
    measures = [ohlc("l_extendedprice", LINE_ORDER)]
    if adjusted:
        measures.append(
            f"last(l_extendedprice * (1 - l_discount) ORDER BY {LINE_ORDER}) AS adj_close")
        measures.append(
            "CAST(sum(CAST(l_tax AS DECIMAL(24,8))) AS DOUBLE) AS dividend_amount")
    if volume:
        measures.append(LINE_VOLUME)
    return bars("lineitem", keys or SYMBOL_LINE, bucket, label, [*measures, *extra], where)


def event_bars(minutes: int, keys=None, volume=False) -> str:
    bucket = f"time_bucket(INTERVAL '{minutes} minutes', ts)"
    measures = [ohlc("value", EVENT_ORDER)] + ([EVENT_VOLUME] if volume else [])
    return bars("events", keys or SYMBOL_EVENT, bucket, bucket, measures)


def adjusted(daily: str, prices: str) -> str:
    """Factors by the adjustment rule over a daily series with events."""
    return f"""
      steps AS (
        SELECT *, (1 - coalesce(dividend_amount / lag(close) OVER
            (PARTITION BY symbol ORDER BY ts), 0)) / split_coefficient AS step
        FROM {daily}),
      factors AS (
        SELECT *, coalesce(product(step) OVER (PARTITION BY symbol ORDER BY ts DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS factor
        FROM steps)
      {prices}"""


DAILY_ADJ = f"""
  WITH daily AS (
    SELECT l_returnflag AS symbol, {LINE_DAY} AS ts, {ohlc("l_extendedprice", LINE_ORDER)},
      {LINE_VOLUME},
      CASE WHEN day({LINE_DAY}) = 15 THEN 250.0::DOUBLE ELSE 0.0::DOUBLE END AS dividend_amount,
      CASE WHEN month({LINE_DAY}) = 6 AND day({LINE_DAY}) = 10
        THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS split_coefficient
    FROM lineitem GROUP BY l_returnflag, {LINE_DAY}),
  {adjusted("daily", '''
    SELECT symbol, epoch_ms(ts) AS "timestamp", open, high, low, close,
      round(close * factor, 4) AS adj_close, volume, dividend_amount, split_coefficient
    FROM factors''')}"""

INTRADAY_ADJ = f"""
  WITH daily AS (
    SELECT event_type AS symbol, date_trunc('day', ts) AS ts, last(value ORDER BY ts, event_id) AS close,
      CASE WHEN day(date_trunc('day', events.ts)) = 15 THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END AS dividend_amount,
      CASE WHEN day(date_trunc('day', events.ts)) = 20 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS split_coefficient
    FROM events GROUP BY event_type, date_trunc('day', events.ts)),
  hourly AS (
    SELECT event_type AS symbol, time_bucket(INTERVAL '60 minutes', ts) AS ts, {ohlc("value", "events.ts, event_id")}
    FROM events GROUP BY event_type, time_bucket(INTERVAL '60 minutes', events.ts)),
  {adjusted("daily", '''
    SELECT h.symbol, epoch_ms(h.ts) AS "timestamp", round(h.open * factor, 4) AS open,
      round(h.high * factor, 4) AS high, round(h.low * factor, 4) AS low,
      round(h.close * factor, 4) AS close
    FROM hourly h JOIN factors f ON f.symbol = h.symbol AND f.ts = date_trunc('day', h.ts)''')}"""


PRICES_OF = "symbol, \"timestamp\", open, high, low, close"


def intraday_adjusted(minutes: int, kept_day: str = "TRUE") -> str:
    """Bars of some minutes by the rule itself: the product over later event days of daily bars that are kept."""
    return f"""
  WITH d AS (
    SELECT event_type AS symbol, date_trunc('day', ts) AS day, last(value ORDER BY ts, event_id) AS close
    FROM events GROUP BY event_type, date_trunc('day', ts)),
  kept AS (SELECT * FROM d WHERE {kept_day}),
  acts AS (
    SELECT symbol, day AS act, CASE WHEN day(day) = 15 THEN 1.5e0 ELSE 0e0 END AS paid,
      CASE WHEN day(day) = 20 THEN 2e0 ELSE 1e0 END AS split
    FROM d WHERE day(day) IN (15, 20)),
  placed AS (
    SELECT a.symbol, min(k.day) AS day, any_value(paid) AS paid, any_value(split) AS split
    FROM acts a JOIN kept k ON k.symbol = a.symbol AND k.day >= a.act GROUP BY a.symbol, a.act),
  steps AS (
    SELECT k.symbol, k.day, (1 - coalesce(p.paid, 0) / coalesce(k.previous, 1e300)) / coalesce(p.split, 1) AS step
    FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY day) AS previous FROM kept) k
    LEFT JOIN (SELECT symbol, day, sum(paid) AS paid, product(split) AS split FROM placed GROUP BY ALL) p
      ON p.symbol = k.symbol AND p.day = k.day),
  b AS ({event_bars(minutes, volume=True)}),
  factors AS (
    SELECT b.symbol, b."timestamp", coalesce(product(s.step), 1) AS factor
    FROM b LEFT JOIN steps s ON s.symbol = b.symbol AND s.day > CAST(make_timestamp_ms(b."timestamp") AS DATE)
    GROUP BY b.symbol, b."timestamp")
  SELECT symbol, "timestamp", round(open * factor, 4) AS open, round(high * factor, 4) AS high,
    round(low * factor, 4) AS low, round(close * factor, 4) AS close, volume
  FROM b JOIN factors USING (symbol, "timestamp")"""


def line_slice(ordinal: int) -> str:
    newest, oldest = 30 * (ordinal - 1), 30 * ordinal
    day = "CAST(l_shipdate AS DATE)"
    return line_bars("day", where=(
        f"{day} > {AS_OF_LINE} - {oldest} AND {day} <= {AS_OF_LINE} - {newest}"))


def slice_name(age: str) -> str:
    position = f"({age}) // 30"
    return (f"'year' || (({position}) // 12 + 1)::VARCHAR || 'month' || "
            f"(({position}) % 12 + 1)::VARCHAR")


LINE_AGE = f"date_diff('day', CAST(l_shipdate AS DATE), {AS_OF_LINE})"
SLICES_ALL = f"""
  WITH t AS (SELECT *, {LINE_AGE} AS age FROM lineitem)
  SELECT l_returnflag AS symbol, {slice_name("age")} AS slice, epoch_ms({LINE_DAY}) AS "timestamp",
    {ohlc("l_extendedprice", LINE_ORDER)}, {LINE_VOLUME}
  FROM t WHERE age BETWEEN 0 AND 719 GROUP BY l_returnflag, age, {LINE_DAY}"""

EVENT_AGE = f"date_diff('day', CAST(make_timestamp_ms(\"timestamp\") AS DATE), {AS_OF_EVENT})"
EXTENDED = f"""
  WITH b AS ({event_bars(60, volume=True)}),
  aged AS (SELECT *, {EVENT_AGE} AS age FROM b)
  SELECT symbol, {slice_name("age")} AS slice, "timestamp", open, high, low, close, volume
  FROM aged WHERE age BETWEEN 0 AND 719"""


def compact(inner: str) -> str:
    return (f"SELECT * FROM ({inner}) QUALIFY row_number() OVER "
            f"(PARTITION BY symbol ORDER BY \"timestamp\" DESC) <= 100")


def partial(period: str) -> str:
    end = {
        "week": f"CAST(date_trunc('week', l_shipdate) AS DATE) + 6",
        "month": "last_day(CAST(l_shipdate AS DATE))",
    }[period]
    return line_bars(period, extra=[f"max({end}) > {AS_OF_LINE} AS is_partial"])


def served_adjusted(period: str) -> str:
    """Weeks or months of the daily adjusted series."""
    bucket = f"date_trunc('{period}', make_timestamp_ms(\"timestamp\"))"
    return f"""
  WITH a AS ({DAILY_ADJ})
  SELECT symbol, max("timestamp") AS "timestamp", first(open ORDER BY "timestamp") AS open, max(high) AS high,
    min(low) AS low, last(close ORDER BY "timestamp") AS close, last(adj_close ORDER BY "timestamp") AS adj_close,
    CAST(sum(volume) AS BIGINT) AS volume, sum(dividend_amount) AS dividend_amount
  FROM a GROUP BY symbol, {bucket}"""


TIES = f"""
  SELECT event_type AS symbol, epoch_ms(time_bucket(INTERVAL '5 minutes', events.ts)) AS "timestamp",
    first(value ORDER BY date_trunc('minute', events.ts), value) AS open, max(value) AS high, min(value) AS low,
    last(value ORDER BY date_trunc('minute', events.ts), value) AS close
  FROM events GROUP BY event_type, time_bucket(INTERVAL '5 minutes', events.ts)"""

# A time zone's own rules, not a constant shift.
NEW_YORK_DST = """
  WITH spread AS (SELECT *, ts + to_days(CAST(event_id % 12 AS INTEGER) * 30) AS moment FROM events),
  b AS (
    SELECT event_type AS symbol, time_bucket(INTERVAL '60 minutes', moment) AS local, first(value ORDER BY moment, event_id) AS open,
      max(value) AS high, min(value) AS low, last(value ORDER BY moment, event_id) AS close,
      CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS volume
    FROM spread GROUP BY event_type, time_bucket(INTERVAL '60 minutes', moment))
  SELECT symbol, epoch_ms(timezone('America/New_York', local)) AS "timestamp", open, high, low, close, volume
  FROM b WHERE NOT (hour(local) IN (1, 2) AND month(local) IN (3, 11))"""

# The second pass of a repeated hour is known by the first, where a symbol has both.
REPEATED_HOURS = """
  WITH spread AS (SELECT *, ts + to_days(CAST(305 - day(ts) + day(ts) % 5 AS INTEGER)) AS moment FROM events),
  b AS (
    SELECT event_type AS symbol, time_bucket(INTERVAL '60 minutes', moment) AS utc, first(value ORDER BY moment, event_id) AS open,
      max(value) AS high, min(value) AS low, last(value ORDER BY moment, event_id) AS close,
      CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS volume
    FROM spread GROUP BY event_type, time_bucket(INTERVAL '60 minutes', moment)),
  l AS (
    SELECT *, timezone('America/New_York', timezone('UTC', utc))
        = timezone('America/New_York', timezone('UTC', utc - INTERVAL 1 HOUR)) AS second,
      lag(utc) OVER (PARTITION BY symbol ORDER BY utc) = utc - INTERVAL 1 HOUR AS both_passes FROM b)
  SELECT symbol, epoch_ms(CASE WHEN second AND NOT coalesce(both_passes, FALSE) THEN utc - INTERVAL 1 HOUR ELSE utc END)
    AS "timestamp", open, high, low, close, volume FROM l"""

DAY = 'make_timestamp_ms("timestamp")'
RESPONSE = f"symbol || '-' || strftime({DAY}, '%Y-%m')"
IS_31 = f"day({DAY}) = 31"
IS_LEAP = f"(month({DAY}) = 2 AND day({DAY}) = 29)"
MARKED = f"""
  WITH daily AS ({line_bars("day")}),
  marked AS (
    SELECT *, {RESPONSE} AS response_id, month({DAY}) AS mon,
      CASE WHEN {IS_31} THEN 'bad high' WHEN {IS_LEAP} THEN 'missing low' END AS problem
    FROM daily)"""
KEPT = 'symbol, "timestamp", open, high, low, close, volume'
LINE_ERRORS = "symbol, response_id, problem AS reason, count(*) AS lines"

TRADES = """
  WITH trades AS (
    SELECT l_returnflag AS symbol,
      l_returnflag || '-' || l_suppkey || '-' || strftime(l_shipdate, '%Y-%m') AS response_id,
      epoch_ms(timezone('America/New_York', date_trunc('day', l_shipdate))) AS "timestamp",
      l_extendedprice AS price, CAST(l_quantity AS BIGINT) AS volume
    FROM lineitem)"""
TRADE_BARS = 'symbol, "timestamp", price AS open, price AS high, price AS low, price AS close, volume'

REFUSED = "CASE mon WHEN 11 THEN 'status 422 Unprocessable' WHEN 12 THEN 'status 500 Server Error' END"
PAGE_STATUS = ("CASE WHEN contains(url, '/fr/') THEN 500 WHEN contains(url, '?') THEN 422 ELSE 200 END")

ZONE_BARS = f"""
  SELECT symbol, strftime(make_timestamp_ms("timestamp"), '%Y-%m-%d %H:%M:%S') AS ts,
    open, high, low, close, volume FROM ({event_bars(30, volume=True)})"""

# January in New York: five hours behind UTC, so a local label lies five hours later in UTC.
NEW_YORK = f"""
  SELECT symbol, "timestamp" + 5 * 3600 * 1000 AS "timestamp", open, high, low, close, volume
  FROM ({event_bars(60, volume=True)})"""


def build_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for minutes in (1, 5, 15, 30, 60):
        sql[f"intraday_{minutes}min"] = event_bars(minutes)
    sql["intraday_equity_5min"] = event_bars(5, volume=True)
    sql["fx_intraday"] = event_bars(15, PAIR_EVENT)
    sql["hourly_from_5min"] = event_bars(60)
    for name, period in (("daily", "day"), ("weekly", "week"), ("monthly", "month")):
        sql[name] = line_bars(period)
        sql[f"fx_{name}"] = line_bars(period, PAIR_LINE, volume=False)
        sql[f"parse_time_series_{name}"] = line_bars(period)
        sql[f"parse_fx_{name}"] = line_bars(period, PAIR_LINE, volume=False)
        if period != "day":
            sql[f"{name}_adj"] = line_bars(period, adjusted=True)
            sql[f"{name}_from_daily"] = line_bars(period)
            sql[f"partial_{name}"] = partial(period)
            sql[f"parse_time_series_{name}_adjusted"] = line_bars(period, adjusted=True)
    for name, period in (("daily", "day"), ("weekly", "week"), ("monthly", "month")):
        sql[f"stored_{name}"] = line_bars(period)
    sql["stored_weekly_adj"] = line_bars("week", adjusted=True)
    sql["stored_changes"] = (
        f"SELECT * FROM ({line_bars('day')}) WHERE (symbol, \"timestamp\") IN "
        f"(SELECT (l_returnflag, epoch_ms({LINE_DAY})) FROM lineitem WHERE l_linenumber < 3)")
    sql["stored_intraday"] = event_bars(5, volume=True)
    sql["stored_intraday_60min"] = event_bars(60, volume=True)
    sql["daily_adj"] = sql["parse_time_series_daily_adjusted"] = DAILY_ADJ
    sql["intraday_adj"] = INTRADAY_ADJ
    sql["slice_year1month1"] = line_slice(1)
    sql["slice_year1month2"] = line_slice(2)
    sql["slice_year2month12"] = line_slice(24)
    sql["slices_all"] = SLICES_ALL
    sql["compact_daily"] = compact(line_bars("day"))
    sql["compact_intraday"] = compact(event_bars(5))
    sql["parse_time_series_intraday"] = event_bars(60, volume=True)
    sql["parse_time_series_intraday_extended"] = EXTENDED
    sql["parse_fx_intraday"] = event_bars(60, PAIR_EVENT)
    sql["parse_new_york"] = NEW_YORK
    sql["zone_round_trip"] = ZONE_BARS
    sql["bad_lines_quarantine"] = f"{MARKED} SELECT {KEPT} FROM marked WHERE problem IS NULL"
    sql["bad_lines_void"] = (
        f"{MARKED} SELECT {KEPT} FROM marked WHERE response_id NOT IN "
        "(SELECT response_id FROM marked WHERE problem IS NOT NULL)")
    sql["bad_lines_errors"] = (
        f"{MARKED} SELECT {LINE_ERRORS} FROM marked WHERE problem IS NOT NULL GROUP BY ALL")
    sql["trades_quarantine"] = f"{TRADES} SELECT {TRADE_BARS} FROM trades WHERE volume <> 50"
    sql["trades_void"] = (
        f"{TRADES} SELECT {TRADE_BARS} FROM trades WHERE response_id NOT IN "
        "(SELECT response_id FROM trades WHERE volume = 50)")
    sql["trades_errors"] = (
        f"{TRADES} SELECT symbol, response_id, 'bad volume' AS reason, count(*) AS lines "
        "FROM trades WHERE volume = 50 GROUP BY ALL")
    sql["header_check"] = (
        f"{MARKED} SELECT {KEPT} FROM marked WHERE problem IS NULL AND mon <> 2")
    sql["header_check_errors"] = (
        f"{MARKED} SELECT {LINE_ERRORS} FROM marked WHERE problem IS NOT NULL AND mon <> 2 "
        "GROUP BY ALL UNION ALL SELECT DISTINCT symbol, response_id, 'no header', 1 "
        "FROM marked WHERE mon = 2")
    sql["responses_quarantine"] = (
        f"{MARKED} SELECT {KEPT} FROM marked WHERE problem IS NULL AND mon NOT IN (11, 12)")
    sql["responses_void"] = sql["bad_lines_void"] + " AND mon NOT IN (11, 12)"
    sql["responses_errors"] = (
        f"{MARKED} SELECT {LINE_ERRORS} FROM marked WHERE problem IS NOT NULL "
        "AND mon NOT IN (11, 12) GROUP BY ALL "
        f"UNION ALL SELECT DISTINCT symbol, response_id, {REFUSED}, 1 FROM marked "
        "WHERE mon IN (11, 12)")
    sql["text_body"] = (
        f"SELECT page_id AS response_id, {PAGE_STATUS} AS status, html AS body FROM pages "
        f"WHERE {PAGE_STATUS} <> 500")
    sql["text_body_errors"] = (
        f"SELECT page_id AS response_id, 'status 500 ' AS reason FROM pages WHERE {PAGE_STATUS} = 500")
    sql["json_body"] = sql["json_body_schema"] = (
        "SELECT event_id AS response_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k "
        "FROM events WHERE event_type <> 'error'")
    sql["json_body_errors"] = (
        "SELECT event_id AS response_id, 'bad json' AS reason FROM events WHERE event_type = 'error'")
    sql["landing_files"] = sql["source_file"] = line_bars("day")
    sql["source_file_fx"] = line_bars("day", PAIR_LINE, volume=False)
    sql["source_file_forex"] = (
        f"SELECT \"timestamp\", open, high, low, close FROM ({sql['source_file_fx']}) "
        "WHERE from_symbol = 'N' AND to_symbol = 'O'")
    sql["source_file_slices"] = sql["source_requests_slices"] = EXTENDED
    sql["source_file_requests"] = sql["source_resumed"] = line_bars("day")
    sql["source_requests_errors"] = (
        "SELECT symbol, 'year' || y || 'month' || m AS slice, 'status 404 Not Found' AS reason "
        "FROM (SELECT DISTINCT event_type AS symbol FROM events), range(1, 3) years(y), range(1, 13) months(m) "
        f"WHERE (symbol, 'year' || y || 'month' || m) NOT IN (SELECT (symbol, slice) FROM ({EXTENDED}))")
    sql["json_body_misfit"] = (
        "SELECT event_id AS response_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events "
        "WHERE event_id % 5 <> 0 AND event_id % 7 <> 0")
    sql["json_body_misfit_errors"] = (
        "SELECT event_id AS response_id, 'bad json' AS reason FROM events WHERE event_id % 5 = 0 OR event_id % 7 = 0")
    sql["intraday_adj_gaps"] = f"SELECT {PRICES_OF} FROM ({intraday_adjusted(60, 'day(day) % 3 <> 0')})"
    sql["intraday_5min_ties"] = TIES
    sql["served_intraday_adj_compact"] = compact(intraday_adjusted(60))
    sql["served_extended_slice_adj"] = f"SELECT * FROM ({intraday_adjusted(30)}) WHERE {EVENT_AGE} BETWEEN 0 AND 29"
    sql["served_weekly_adj"] = served_adjusted("week")
    sql["served_monthly_adj"] = served_adjusted("month")
    sql["parse_new_york_dst"] = NEW_YORK_DST
    clean = f"WITH daily AS ({line_bars('day')})"
    sql["void_shared_ids"] = (
        f"{clean} SELECT {KEPT} FROM daily WHERE symbol <> 'R' OR strftime({DAY}, '%Y-%m') NOT IN "
        f"(SELECT strftime({DAY}, '%Y-%m') FROM daily WHERE symbol = 'R' AND day({DAY}) = 31)")
    sql["json_bars"] = line_bars("day")
    sql["json_bars_quarantine"] = f"{MARKED} SELECT {KEPT} FROM marked WHERE problem IS NULL AND mon <> 11"
    sql["json_bars_void"] = sql["bad_lines_void"] + " AND mon <> 11"
    sql["json_bars_errors"] = (
        f"{MARKED} SELECT {LINE_ERRORS} FROM marked WHERE problem IS NOT NULL AND mon <> 11 GROUP BY ALL "
        "UNION ALL SELECT DISTINCT symbol, response_id, 'status 500 Server Error', 1 FROM marked WHERE mon = 11")
    sql["parse_repeated_hours"] = REPEATED_HOURS
    sql["header_first_line"] = f"{clean} SELECT {KEPT} FROM daily WHERE month({DAY}) <> 2"
    sql["header_repeated"] = line_bars("day")
    sql["header_repeated_errors"] = (
        f"{clean} SELECT DISTINCT symbol, strftime({DAY}, '%Y-%m') AS response_id, 'bad timestamp' AS reason, "
        "CAST(1 AS BIGINT) AS lines FROM daily")
    return sql
