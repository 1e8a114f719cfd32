"""Merged states against bars of all trades."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tickloom.operators.bar_state import bars_of_state, longer, merge, state_of_ticks
from tickloom.operators.resample import bars_from_ticks
from tickloom.plans.store import BarStore

SCHEMA = "symbol string, ts timestamp_ntz, id bigint, price double, adj double, size double, paid double"
COLUMNS = {"tie_break": ("id",), "volume": "size", "adj_close": "adj", "dividend": "paid"}


@pytest.fixture(scope="module")
def ticks():
    """Equal times, null symbols, fractions, odd dividends, one symbol with a third of all."""
    rng = random.Random(3)
    start = datetime(2023, 12, 28)
    rows = []
    for i in range(1500):
        symbol = "HOT" if i % 3 == 0 else rng.choice(["A", "B", None])
        ts = start + timedelta(minutes=rng.randrange(60 * 24 * 9) // 7 * 7)
        paid = rng.choice([0.1, 0.2, 1e-9, None]) if i % 97 else rng.choice([float("nan"), float("inf"), float("-inf")])
        rows.append((symbol, ts, i % 11, float(rng.randrange(50)), float(rng.randrange(9)), rng.randrange(100) / 10, paid))
    return rows


@pytest.fixture(scope="module")
def frame(spark, ticks):
    return spark.createDataFrame(ticks, SCHEMA).persist()


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("period", ["5min", "60min", "day", "week", "month"])
def test_merged_in_any_order_and_grouping(frame, period):
    expected = rows_of(bars_from_ticks(frame, period, **COLUMNS))
    parts = [state_of_ticks(frame.filter(F.pmod(F.hash("id", "price"), F.lit(4)) == i), period, **COLUMNS) for i in range(4)]
    a, b, c, d = parts
    left = merge(merge(a.unionByName(b)).unionByName(c).unionByName(d))
    right = merge(merge(d.unionByName(b)).unionByName(merge(c.unionByName(a))))
    for state in (left, right):
        assert rows_of(bars_of_state(state, period)) == expected


@pytest.mark.parametrize("source, period", [("5min", "60min"), ("60min", "day"), ("day", "week"), ("day", "month")])
def test_longer_periods_from_shorter_states(frame, source, period):
    state = longer(state_of_ticks(frame, source, **COLUMNS), period, source=source)
    assert rows_of(bars_of_state(state, period)) == rows_of(bars_from_ticks(frame, period, **COLUMNS))
    with pytest.raises(ValueError):
        longer(state, source, source=period)


def store_of(spark, tmp_path, **columns):
    return BarStore(spark, str(tmp_path / "store"), "day", **(columns or COLUMNS))


def test_batches_count_once_whatever_happens(spark, frame, tmp_path):
    """Repeated, empty and failing batches, merging in between, a merge that was killed."""
    store = store_of(spark, tmp_path)
    first, second = frame.filter("price < 20"), frame.filter("price >= 20")
    assert store.append(first, "b1") and not store.append(first, "b1") and store.append(frame.limit(0), "none")
    with pytest.raises(Exception, match="broken"):
        store.append(second.withColumn("size", F.raise_error(F.lit("broken")).cast("double")), "b2")
    assert store.batches() == {"b1", "none"}
    assert rows_of(store.bars()) == rows_of(bars_from_ticks(first, "day", **COLUMNS))
    store.compact()
    # What a killed merge leaves behind.
    store.state().write.parquet(str(tmp_path / "store" / "_gen" / "state" / "batch=base"))
    assert not store.append(first, "b1") and store.append(second, "b2") and not store.append(second, "b2")
    expected = rows_of(bars_from_ticks(frame, "day", **COLUMNS))
    assert rows_of(store.bars()) == expected
    store.compact()
    assert rows_of(store.bars()) == expected and store.batches() == {"b1", "b2", "none"}
    assert [p.name for p in (tmp_path / "store").glob("gen-*")] == ["gen-2"]
    assert rows_of(store.bars("month")) == rows_of(bars_from_ticks(frame, "month", **COLUMNS))


def test_changed_bars(spark, frame, tmp_path):
    store = store_of(spark, tmp_path)
    store.append(frame.filter("day(ts) < 30"), "old")
    new = frame.filter("day(ts) >= 30 OR id = 3 AND symbol IS NULL")
    store.append(new.filter("day(ts) >= 30"), "new")
    keys = {(r.symbol, r.ts.date()) for r in new.filter("day(ts) >= 30").collect()}
    changed = store.changed("new").collect()
    assert {(r.symbol, r.ts) for r in changed} == keys
    assert set(map(str, changed)) <= set(rows_of(store.bars()))


def test_bars_read_states_only(spark, frame, tmp_path):
    store = store_of(spark, tmp_path)
    store.append(frame, "all")
    bars = store.bars()
    assert all("batch=all" in f for f in bars.inputFiles()) and plan_of(bars).count("Exchange hashpartitioning") == 1
    assert store.state().count() < frame.count() / 10


def test_a_stream_fills_the_store_once(spark, frame, tmp_path):
    folder, store = str(tmp_path / "ticks"), store_of(spark, tmp_path)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        query = store.writer(stream, "s").option("checkpointLocation", str(tmp_path / "state")).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    frame.filter("price < 20").repartition(2).write.parquet(folder)
    run()
    # A micro-batch whose commit was lost is sent again under its number.
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    frame.filter("price >= 20").coalesce(1).write.mode("append").parquet(folder)
    run()
    assert rows_of(store.bars()) == rows_of(bars_from_ticks(frame, "day", **COLUMNS))


def test_wrong_use(spark, frame, tmp_path):
    store = store_of(spark, tmp_path)
    with pytest.raises(ValueError):
        store.bars()
    for name in ("base", "a/b", ""):
        with pytest.raises(ValueError):
            store.append(frame, name)
    store.append(frame, "a")
    with pytest.raises(ValueError):
        store_of(spark, tmp_path, tie_break=("id",)).append(frame, "b")
    with pytest.raises(ValueError):
        store.bars("5min")
