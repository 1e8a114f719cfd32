import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tickloom.functions.calendar import instant_to_local
from tickloom.operators.resample import bars_from_bars, bars_from_ticks, with_partial_flag
from tickloom.plans.methods import INTERVALS
from tickloom.plans.series import as_bars, as_series

PERIODS = (*INTERVALS, "day", "week", "month")
SCHEMA = "symbol string, ts timestamp_ntz, id bigint, price double, volume bigint"
ORDER = ("id",)


@pytest.fixture(scope="module")
def ticks():
    """Trades with many equal times, negative and positive ids, one symbol with a third of all."""
    rng = random.Random(7)
    start = datetime(2023, 12, 28, 22)
    rows = []
    for i in range(3000):
        symbol = "HOT" if i % 3 == 0 else f"S{rng.randrange(5)}"
        ts = start + timedelta(minutes=rng.randrange(60 * 24 * 12) // 3, microseconds=rng.randrange(2))
        rows.append((symbol, ts, (-1) ** i * i * 10**15, float(rng.randrange(1000)), rng.randrange(100)))
    return rows


@pytest.fixture(scope="module")
def frame(spark, ticks):
    return spark.createDataFrame(ticks, SCHEMA).repartition(7).persist()


def bucket(ts, period):
    if period == "day":
        return ts.date()
    if period == "week":
        return ts.date() - timedelta(days=ts.weekday())
    if period == "month":
        return ts.date().replace(day=1)
    minutes = int(period.removesuffix("min"))
    return ts.replace(minute=ts.minute // minutes * minutes, second=0, microsecond=0)


def expected(ticks, period):
    groups = defaultdict(list)
    for row in ticks:
        groups[row[0], bucket(row[1], period)].append(row)
    bars = set()
    for (symbol, start), rows in groups.items():
        rows.sort(key=lambda r: r[1:3])
        label = start if period not in ("week", "month") else max(r[1] for r in rows).date()
        prices = [r[3] for r in rows]
        bars.add((symbol, label, prices[0], max(prices), min(prices), prices[-1], sum(r[4] for r in rows)))
    return bars


def rows(df):
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("period", PERIODS)
def test_against_brute_force(frame, ticks, period):
    bars = bars_from_ticks(frame, period, tie_break=ORDER, volume="volume")
    assert bars.columns == ["symbol", "ts", "open", "high", "low", "close", "volume"]
    assert rows(bars) == expected(ticks, period)


def test_extreme_tie_breaks(spark):
    frame = spark.sql(
        "select 'A' as symbol, timestamp_ntz'0001-01-01 00:00:00' as ts, id, cast(p as double) as price from "
        "values (9223372036854775807L, 1), (-9223372036854775808L, 2), (-1L, 3), (0L, 4) as t(id, p)")
    assert rows(bars_from_ticks(frame, "day", tie_break=ORDER)) == {("A", date(1, 1, 1), 2.0, 4.0, 1.0, 1.0)}


def test_equal_order_is_settled_by_price(spark):
    frame = spark.createDataFrame([("A", datetime(2021, 4, 5), 1, float(p), 1) for p in (3, 1, 2)], SCHEMA)
    assert rows(bars_from_ticks(frame.repartition(3), "day", tie_break=ORDER)) \
        == {("A", date(2021, 4, 5), 1.0, 3.0, 1.0, 3.0)}


def test_unique_times_aggregate_by_hash(frame):
    five = bars_from_ticks(frame, "5min", unique_ts=True, volume="volume")
    for bars in (five, bars_from_bars(five, "week", source="5min")):
        assert "SortAggregate" not in plan_of(bars)


@pytest.mark.parametrize("period", INTERVALS)
def test_session_zone_does_not_matter(frame, ticks, session_zone, period):
    session_zone("Asia/Kathmandu")
    assert rows(bars_from_ticks(frame, period, tie_break=ORDER, volume="volume")) == expected(ticks, period)


@pytest.mark.parametrize("short, long", [("1min", "60min"), ("5min", "day"), ("60min", "week"),
                                         ("day", "week"), ("day", "month"), ("1min", "month")])
def test_longer_bars_from_shorter_ones(frame, ticks, short, long):
    bars = bars_from_ticks(frame, short, tie_break=ORDER, volume="volume")
    assert rows(bars_from_bars(bars, long, source=short)) == expected(ticks, long)


def test_properties(frame):
    bars = bars_from_ticks(frame, "15min", tie_break=ORDER, volume="volume")
    outside = (F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close"))
    assert bars.filter(outside).count() == 0
    total = frame.agg(F.sum("volume")).head()[0]
    for period in ("15min", "week"):
        made = bars_from_ticks(frame, period, tie_break=ORDER, volume="volume")
        assert made.agg(F.sum("volume")).head()[0] == total


def test_adjusted_periods(spark):
    ticks = spark.createDataFrame(
        [("A", datetime(2021, 4, 5), 10.0, 9.0, 0.1), ("A", datetime(2021, 4, 7), 11.0, 9.5, 0.2),
         ("A", datetime(2021, 4, 12), 12.0, 12.0, 0.0)],
        "symbol string, ts timestamp_ntz, price double, adj double, paid double")
    weekly = bars_from_ticks(ticks, "week", adj_close="adj", dividend="paid")
    assert rows(weekly) == {("A", date(2021, 4, 7), 10.0, 11.0, 10.0, 11.0, 9.5, 0.3),
                            ("A", date(2021, 4, 12), 12.0, 12.0, 12.0, 12.0, 12.0, 0.0)}
    daily = bars_from_ticks(ticks, "day", adj_close="adj", dividend="paid")
    assert rows(bars_from_bars(daily, "week", source="day")) == rows(weekly)


def test_rows_without_time_or_price_are_no_trades(spark):
    ticks = spark.createDataFrame([("A", datetime(2021, 4, 5), 1, None, 1), ("A", None, 1, 2.0, 1)], SCHEMA)
    assert bars_from_ticks(ticks, "day", tie_break=ORDER).count() == 0


def test_several_keys(spark):
    ticks = spark.createDataFrame([("EUR", "USD", datetime(2021, 4, 5), 1.1), ("EUR", "GBP", datetime(2021, 4, 5), 0.9)],
                                  "from_symbol string, to_symbol string, ts timestamp_ntz, price double")
    bars = bars_from_ticks(ticks, "month", keys=("from_symbol", "to_symbol"))
    assert bars.columns == ["from_symbol", "to_symbol", "ts", "open", "high", "low", "close"]
    assert bars.count() == 2


def test_instants_need_a_zone(spark, session_zone):
    session_zone("Asia/Tokyo")
    instants = spark.sql("select 'A' as symbol, timestamp'2021-04-01 00:30:00.000001 UTC' as ts, 1.0D as price")
    with pytest.raises(ValueError):
        bars_from_ticks(instants, "day")
    local = instants.withColumn("ts", instant_to_local(F.col("ts"), "America/New_York"))
    assert local.head().ts == datetime(2021, 3, 31, 20, 30, 0, 1)
    assert bars_from_ticks(local, "day").head().ts == date(2021, 3, 31)


def test_unknown_period(frame):
    with pytest.raises(ValueError):
        bars_from_ticks(frame, "2min")


@pytest.mark.parametrize("period, as_of, partial", [
    ("day", date(2021, 4, 7), False), ("week", date(2021, 4, 10), True), ("week", date(2021, 4, 11), False),
    ("month", date(2021, 4, 29), True), ("month", date(2021, 4, 30), False),
    ("60min", datetime(2021, 4, 7, 10, 59), True), ("60min", datetime(2021, 4, 7, 11, 0), False),
])
def test_partial_flag(spark, session_zone, period, as_of, partial):
    session_zone("Asia/Tokyo")
    ticks = spark.createDataFrame([("A", datetime(2021, 4, 7, 10, 30), 1, 1.0, 1)], SCHEMA)
    bars = with_partial_flag(bars_from_ticks(ticks, period, tie_break=ORDER), period, as_of)
    assert bars.head().is_partial is partial


@pytest.mark.parametrize("method, period", [("TIME_SERIES_INTRADAY", "5min"), ("TIME_SERIES_WEEKLY", "week")])
def test_series_round_trip(frame, method, period):
    bars = bars_from_ticks(frame, period, tie_break=ORDER, volume="volume")
    series = as_series(bars, method, zone="Asia/Kolkata", keys=("symbol",))
    assert rows(as_bars(series, method, zone="Asia/Kolkata", keys=("symbol",))) == rows(bars)


def test_one_shuffle_and_partial_aggregates(frame):
    plan = plan_of(bars_from_ticks(frame, "5min", tie_break=ORDER, volume="volume"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan and "partial_sum" in plan


def test_ties_are_settled_by_price_whatever_the_order(spark):
    at = datetime(2021, 4, 5, 9)
    ticks = [("A", at, 1, 2.0, 1), ("A", at, 2, 1.0, 1), ("A", at, 3, 3.0, 1)]
    for given in (ticks, ticks[::-1]):
        bar = bars_from_ticks(spark.createDataFrame(given, SCHEMA), "5min").first()
        assert (bar.open, bar.close) == (1.0, 3.0)
    with pytest.raises(ValueError):
        bars_from_ticks(spark.createDataFrame(ticks, SCHEMA), "5min", unique_ts=True, tie_break=("id",))


def test_fractions_of_volume_are_summed_before_rounding(spark):
    ticks = spark.createDataFrame(
        [("A", datetime(2021, 4, 5), 1.0, v) for v in (0.5, 0.5, 0.1, 0.2)], "symbol string, ts timestamp_ntz, price double, size double")
    assert bars_from_ticks(ticks, "day", volume="size").first().volume == 1
    exact = ticks.withColumn("size", F.col("size").cast("decimal(10,2)"))
    assert bars_from_ticks(exact, "day", volume="size").first().volume == 1


def test_odd_dividends(spark):
    def total(*paid):
        ticks = spark.createDataFrame(
            [("A", datetime(2021, 4, 5), 1.0, p) for p in paid], "symbol string, ts timestamp_ntz, price double, paid double")
        return bars_from_ticks(ticks, "day", dividend="paid").first().dividend_amount

    assert total(1e-9, 2e-9) == 3e-9 and total(None, 0.5) == 0.5
    assert total(1.0, float("nan")) != total(1.0, float("nan")) and total(1.0, float("inf")) == float("inf")


@pytest.mark.parametrize("source, period", [("week", "month"), ("day", "1min"), ("day", "day"), ("30min", "15min"), ("month", "week"),
                                            ("60min", "60min")])
def test_roll_ups_that_do_not_divide(spark, source, period):
    bars = spark.createDataFrame([], "symbol string, ts date, open double, high double, low double, close double")
    with pytest.raises(ValueError):
        bars_from_bars(bars, period, source=source)


def test_unique_ties_aggregate_by_hash_and_change_nothing(spark, frame, ticks):
    numbered = spark.createDataFrame([(t[0], t[1], n - 30, t[3], t[4]) for n, t in enumerate(ticks)], SCHEMA)
    packed = bars_from_ticks(numbered, "15min", tie_break=("id",), unique_ties=True, volume="volume")
    assert "SortAggregate" not in plan_of(packed)
    assert rows(packed) == rows(bars_from_ticks(numbered, "15min", tie_break=("id",), volume="volume"))
    with pytest.raises(ValueError):
        bars_from_ticks(numbered, "15min", tie_break=("price",), unique_ties=True)
