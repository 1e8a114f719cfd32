from datetime import date, datetime

import pytest

from conftest import land
from tickloom.operators.resample import bars_from_ticks
from tickloom.plans.read import read_landing
from tickloom.streaming.live import landing_stream, live_bars

DAILY = "TIME_SERIES_DAILY"
HEADER = "timestamp,open,high,low,close,volume\n"
SCHEMA = "symbol string, ts timestamp_ntz, id bigint, price double, volume bigint"


def run(df, mode, name, spark, tmp_path):
    query = (df.writeStream.outputMode(mode).format("memory").queryName(name)
             .option("checkpointLocation", str(tmp_path / name)).start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.table(name)


def test_landing_stream(spark, tmp_path):
    land(tmp_path / "root", DAILY, {"symbol": "A"}, {"1": HEADER + "2021-04-01,1,2,3,4,5\n2021-04-02,x\n"})
    land(tmp_path / "root", DAILY, {"symbol": "B"}, {"1": HEADER + "2021-04-01,1,2,3,4,5\n"})
    root = str(tmp_path / "root")
    live = landing_stream(spark, root, DAILY, zone="UTC")
    batch = read_landing(spark, root, DAILY, zone="UTC")
    bars = run(live.bars, "append", "landed_bars", spark, tmp_path)
    assert sorted(bars.collect()) == sorted(batch.bars.collect())
    errors = run(live.errors, "append", "landed_errors", spark, tmp_path)
    assert [r.reason for r in errors.collect()] == ["bad open"]


FILES = {
    "good": HEADER + "2021-04-01,1,2,3,4,5\n2021-04-02,1,2,3,4,6\n",
    "bad": HEADER + "2021-04-03,1,2,3,4,5\r\n2021-04-04,x\r\n",
    "no_header": "2021-04-05,1,2,3,4,5\n",
    "note": '{"Note": "limit"}\n',
    "again": "\n \n" + HEADER + "2021-04-06,1,2,3,4,5\n" + HEADER + "2021-04-07,1,2,3,4,5",
    "empty": "", "blank": "\n  \n", "header": HEADER,
}


@pytest.mark.parametrize("policy", ["quarantine", "void_response"])
def test_landing_stream_equals_the_batch(spark, tmp_path, policy):
    for symbol in "AB":
        land(tmp_path / "root", DAILY, {"symbol": symbol}, FILES)
    root = str(tmp_path / "root")
    live = landing_stream(spark, root, DAILY, zone="UTC", on_bad_line=policy)
    batch = read_landing(spark, root, DAILY, zone="UTC", on_bad_line=policy)
    bars = run(live.bars, "append", f"checked_bars_{policy}", spark, tmp_path)
    errors = run(live.errors, "append", f"checked_errors_{policy}", spark, tmp_path)
    assert sorted(bars.collect()) == sorted(batch.bars.collect()) and bars.count() > 0
    assert sorted(map(str, errors.collect())) == sorted(map(str, batch.errors.collect()))


def test_landing_stream_goes_on_where_it_stopped(spark, tmp_path):
    root, found = str(tmp_path / "root"), str(tmp_path / "found")
    for name in ("good", "no_header", "again"):
        land(tmp_path / "root", DAILY, {"symbol": name}, {name: FILES[name]})
        live = landing_stream(spark, root, DAILY, zone="UTC", on_bad_line="void_response")
        query = (live.bars.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "at"))
                 .trigger(availableNow=True).start(found))
        query.awaitTermination()
    batch = read_landing(spark, root, DAILY, zone="UTC", on_bad_line="void_response")
    assert sorted(spark.read.parquet(found).collect()) == sorted(batch.bars.collect())


def test_landing_stream_fails_and_refuses(spark, tmp_path):
    land(tmp_path / "root", DAILY, {"symbol": "A"}, {"bad": FILES["bad"]})
    root = str(tmp_path / "root")
    with pytest.raises(Exception, match="bad open"):
        run(landing_stream(spark, root, DAILY, zone="UTC", on_bad_line="fail").bars, "append", "failing", spark, tmp_path)
    with pytest.raises(ValueError):
        landing_stream(spark, root, DAILY, zone="UTC", on_bad_line="void_response", check_header=False)
    lines = landing_stream(spark, root, DAILY, zone="UTC", check_header=False)
    assert run(lines.bars, "append", "unchecked", spark, tmp_path).count() == 1


@pytest.mark.parametrize("period", ["5min", "day", "week"])
def test_live_bars_end_as_batch_bars(spark, tmp_path, period):
    first = [("A", datetime(2021, 4, 5, 9, m), m, float(m % 7), 1) for m in range(0, 50, 3)]
    second = [("A", datetime(2021, 4, d, 10), d, float(d), 1) for d in (5, 7, 11, 12)]
    folder = str(tmp_path / "ticks")
    for rows in (first, second):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    live = live_bars(stream, period, lateness="30 days", tie_break=("id",), volume="volume")
    sent = run(live, "update", f"live_{period}", spark, tmp_path).collect()
    batch = bars_from_ticks(spark.read.parquet(folder), period, tie_break=("id",), volume="volume")
    final = {r for r in batch.collect()}
    assert final <= set(sent)
    # A running bucket was sent before it was complete; the later row has more volume.
    latest = {}
    for row in sorted(sent, key=lambda r: r.volume):
        key = row.ts if period != "week" else row.ts.isocalendar()[:2]
        latest[row.symbol, key] = row
    assert set(latest.values()) == final
    if period == "week":
        assert {r.ts for r in final} == {date(2021, 4, 11), date(2021, 4, 12)}


def test_months_have_no_window(spark):
    with pytest.raises(ValueError):
        live_bars(spark.createDataFrame([], SCHEMA), "month", lateness="1 day")
