import pytest
from pyspark.sql import functions as F

from tickloom.functions import parse
from tickloom.functions.calendar import local_micros, local_to_millis, millis_to_local
from tickloom.operators.bad_lines import parse_lines
from tickloom.plans.methods import METHODS

NEW_YORK = "America/New_York"
INTRADAY_ROW = "2021-04-01 18:05:00,133.2800,133.2800,133.2300,133.2300,905"
ROWS = {
    "ohlcv": ("2021-04-01,133.76,133.93,132.27,133.23,4074161",
              (133.76, 133.93, 132.27, 133.23, 4074161)),
    "fx": ("2021-04-01,1.1770,1.1780,1.1765,1.1775", (1.177, 1.178, 1.1765, 1.1775)),
    "daily_adjusted": ("2021-04-01,133.76,133.93,132.27,133.23,133.23,4074161,0.0000,1.0",
                       (133.76, 133.93, 132.27, 133.23, 133.23, 4074161, 0.0, 1.0)),
    "period_adjusted": ("2021-04-01,133.76,133.93,132.27,133.23,133.23,4074161,0.0000",
                        (133.76, 133.93, 132.27, 133.23, 133.23, 4074161, 0.0)),
}


def parsed(spark, lines, method="TIME_SERIES_DAILY", zone="UTC"):
    frame = spark.createDataFrame([("r", line) for line in lines], "response_id string, line string")
    return parse_lines(frame, method, zone=zone, check_header=False)


def bars(spark, *lines, **where):
    return [tuple(r) for r in parsed(spark, lines, **where).bars.collect()]


def reasons(spark, *lines, **where):
    return [r.reason for r in parsed(spark, lines, **where).errors.collect()]


@pytest.mark.parametrize("method", sorted(METHODS))
def test_goldens(spark, method):
    spec = METHODS[method]
    row, values = ROWS[spec.layout]
    utc, new_york = 1617235200000, 1617249600000
    if spec.intraday:
        row = row.replace("2021-04-01", "2021-04-01 18:05:00")
        utc, new_york = (base + (18 * 60 + 5) * 60000 for base in (utc, new_york))
    assert bars(spark, row, method=method) == [(utc, *values)]
    assert bars(spark, row, method=method, zone=NEW_YORK) == [(new_york, *values)]


def test_sample_rows(spark):
    expected = (1617300300000, 133.28, 133.28, 133.23, 133.23, 905)
    assert bars(spark, INTRADAY_ROW, method="TIME_SERIES_INTRADAY") == [expected]
    assert bars(spark, INTRADAY_ROW, method="TIME_SERIES_INTRADAY_EXTENDED") == [expected]
    assert bars(spark, INTRADAY_ROW) == [(1617235200000, *expected[1:])]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Sao_Paulo"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_session_settings_do_not_matter(spark, session_zone, zone, ansi):
    session_zone(zone)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for where in ("UTC", NEW_YORK):
            assert bars(spark, INTRADAY_ROW, method="TIME_SERIES_INTRADAY", zone=where)[0][0] \
                == {"UTC": 1617300300000, NEW_YORK: 1617314700000}[where]
        assert reasons(spark, "2021-04-01,1,2,3,x,5", "2021-04-01,1") == ["bad close", "missing high"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_header_and_blank_lines_are_dropped(spark):
    found = parsed(spark, ["timestamp,open,high,low,close,volume", " time ,open", "", " \t\r", "timestamp",
                           "2021-04-01,1,2,3,4,5"])
    assert found.bars.count() == 1 and found.errors.count() == 0


def test_padding_surplus_and_big_volume(spark):
    assert bars(spark, "\t2021-04-01 , 1 ,+2, 3e0,4\t,3000000000,99\r") \
        == [(1617235200000, 1.0, 2.0, 3.0, 4.0, 3000000000)]


@pytest.mark.parametrize("line, reason", [
    ("2021-13-01,1,2,3,4,5", "bad timestamp"),
    ("2021-02-30,1,2,3,4,5", "bad timestamp"),
    ("2021-4-01,1,2,3,4,5", "bad timestamp"),
    ("21-04-01,1,2,3,4,5", "bad timestamp"),
    ("timestamps,1,2,3,4,5", "bad timestamp"),
    ("2021-04-01,1,x,3,4,5", "bad high"),
    ("2021-04-01,1,,3,4,5", "bad high"),
    ("2021-04-01,1,2,3", "missing close"),
    ("2021-04-01,1,2,3,4", "missing volume"),
    ("2021-04-01,1,2,3,4,", "bad volume"),
    ("2021-04-01,1,2,3,4,5.7", "bad volume"),
    ("2021-04-01,1,2,3,4,99999999999999999999", "bad volume"),
    ("2021-04-01,inf,2,3,4,5", "bad open"),
    ("2021-04-01,1,2,3,nan,5", "bad close"),
    ('{"Note": "limit"}', "bad timestamp"),
])
def test_bad_lines(spark, line, reason):
    assert reasons(spark, line) == [reason]
    assert bars(spark, line) == []


@pytest.mark.parametrize("text", [
    "2021-04-01", "2021-04-01 24:00:00", "2021-04-01 18:60:00", "2021-04-01 18:05:60",
    "2021-04-01T18:05:00", "2021-04-01 18:05", "2021-04-01 18:05:00.5", "2021-04-01 +8:05:00",
])
def test_bad_date_times(spark, text):
    assert reasons(spark, f"{text},1,2,3,4,5", method="TIME_SERIES_INTRADAY") == ["bad timestamp"]


def test_exact_non_finite_words_are_numbers(spark):
    row = bars(spark, "2021-04-01,Infinity,-Infinity,NaN,1e999,5")[0]
    assert row[1] == float("inf") and row[2] == float("-inf")
    assert row[3] != row[3] and row[4] == float("inf")


def test_is_bad_line_agrees_with_reasons(spark):
    lines = [INTRADAY_ROW, "2021-04-01,1,2,3,4,5", "2021-04-01,1,2", "x", "2021-04-01,1,2,3,4,y"]
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    flags = frame.select(parse.is_bad_line(F.col("line"), "TIME_SERIES_DAILY", "UTC")).collect()
    assert [f[0] for f in flags] == [False, False, True, True, True]


@pytest.mark.parametrize("zone", ["UTC", NEW_YORK, "Asia/Kolkata"])
def test_millis_round_trip(spark, session_zone, zone):
    session_zone("America/Sao_Paulo")
    frame = spark.sql(
        "select explode(array('1969-12-31 23:59:59', '2021-03-14 03:30:00', '2021-11-07 00:30:00', "
        "'2024-02-29 12:00:01')) as text").select("text", F.col("text").cast("timestamp_ntz").alias("ts"))
    back = frame.select(
        "text", millis_to_local(local_to_millis(F.col("ts"), zone), zone).cast("string").alias("b"))
    assert all(r.text == r.b for r in back.collect())


def test_local_micros(spark, session_zone):
    session_zone(NEW_YORK)
    row = spark.sql("select timestamp_ntz'2021-03-14 02:30:00.123456' as ts").select(
        local_micros(F.col("ts"))).head()
    assert row[0] == 1615689000123456


def test_repeated_local_time_is_the_first(spark):
    first = 1636263000000  # 2021-11-07 01:30 in New York, still on summer time
    row = bars(spark, "2021-11-07 01:30:00,1,2,3,4,5", method="TIME_SERIES_INTRADAY", zone=NEW_YORK)
    assert row[0][0] == first
    made = spark.sql("select timestamp_ntz'2021-11-07 01:30:00' as ts").select(
        local_to_millis(F.col("ts"), NEW_YORK))
    assert made.head()[0] == first
