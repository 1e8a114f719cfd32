import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tickloom.operators.select import in_slice, latest_points, slice_bounds, with_slice
from tickloom.plans.methods import SLICES

AS_OF = date(2024, 3, 1)


@pytest.fixture(scope="module")
def days(spark):
    return spark.range(-5, 760).select(
        F.lit("A").alias("symbol"),
        F.date_sub(F.lit("2024-03-01").cast("date"), F.col("id").cast("int")).alias("ts"))


def test_bounds():
    assert slice_bounds("year1month1", AS_OF) == (date(2024, 2, 1), AS_OF)
    assert slice_bounds("year1month2", AS_OF) == (date(2024, 1, 2), date(2024, 1, 31))
    assert slice_bounds("year2month12", AS_OF)[0] == AS_OF - timedelta(days=719)


def test_slices_are_disjoint_and_complete(days):
    sliced = with_slice(days, AS_OF)
    counted = {r.slice: r["count"] for r in sliced.groupBy("slice").count().collect()}
    assert counted == {name: 30 for name in SLICES}
    one = in_slice(days, "year1month3", AS_OF)
    same = sliced.filter("slice = 'year1month3'").drop("slice")
    assert one.exceptAll(same).count() == 0 and one.count() == 30


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_up_to_the_end_of_the_day(spark, session_zone, zone):
    session_zone(zone)
    ts = [datetime(2024, 2, 1), datetime(2024, 1, 31, 23, 59, 59), datetime(2024, 3, 1, 23, 59), datetime(2024, 3, 2)]
    frame = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    assert {r.ts for r in in_slice(frame, "year1month1", AS_OF).collect()} == {ts[0], ts[2]}
    assert {r.ts: r.slice for r in with_slice(frame, AS_OF).collect()} \
        == {ts[0]: "year1month1", ts[1]: "year1month2", ts[2]: "year1month1"}


def test_unknown_slice(days):
    with pytest.raises(ValueError):
        in_slice(days, "year3month1", AS_OF)


def test_slice_reaches_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = plan_of(in_slice(lines, "year1month1", AS_OF, ts="l_shipdate").select("l_quantity"))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_latest_points_against_brute_force(spark):
    rng = random.Random(3)
    rows = [("HOT" if i % 3 else f"S{i % 40}", date(2024, 1, 1) + timedelta(days=rng.randrange(60)), float(rng.randrange(5)))
            for i in range(2000)]
    frame = spark.createDataFrame(rows, "symbol string, ts date, close double").repartition(5)
    expected = []
    for symbol in {r[0] for r in rows}:
        expected += sorted((r for r in rows if r[0] == symbol), key=lambda r: r[1:], reverse=True)[:100]
    assert sorted(tuple(r) for r in latest_points(frame).collect()) == sorted(expected)


def test_latest_points_are_cut_before_the_shuffle(days):
    symbol = F.dayofmonth("ts").cast("string")
    plan = plan_of(latest_points(days.withColumns({"symbol": symbol, "close": F.lit(1.0)})))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
