from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from conftest import land
from tickloom.operators.bad_lines import parse_lines, parse_responses
from tickloom.plans.read import read_landing

INTRADAY = "TIME_SERIES_INTRADAY"
HEADER = "timestamp,open,high,low,close,volume"
NEW_YORK = "America/New_York"


def instants(start, minutes, n):
    first = datetime.fromisoformat(start).replace(tzinfo=timezone.utc)
    return [first + timedelta(minutes=minutes * i) for i in range(n)]


def local_lines(times, zone):
    """A line for each instant; the volume is its epoch second, so a bar tells which instant it should have."""
    return [f"{t.astimezone(ZoneInfo(zone)):%Y-%m-%d %H:%M:%S},1,1,1,1,{int(t.timestamp())}" for t in times]


def bodies(spark, given):
    rows = [(k, r, 200, "OK", "\n".join([HEADER, *lines])) for (k, r), lines in given.items()]
    return spark.createDataFrame(rows, "symbol string, response_id string, status int, reason string, body string")


def misplaced(parsed):
    rows = parsed.bars.select("timestamp", "volume").collect()
    return sum(r.timestamp != r.volume * 1000 for r in rows), len(rows)


ZONES = {NEW_YORK: ("2024-11-03T03:00", (5, 30, 60)), "Australia/Lord_Howe": ("2024-04-06T12:00", (5, 30)),
         "Antarctica/Troll": ("2024-10-26T21:00", (5, 30, 60))}


@pytest.mark.parametrize("zone, newest_first", [
    (NEW_YORK, True), (NEW_YORK, False), ("Australia/Lord_Howe", True), ("Antarctica/Troll", False)])
def test_each_instant_is_found(spark, zone, newest_first):
    start, widths = ZONES[zone]
    lines = {m: local_lines(sorted(instants(start, m, 720 // m), reverse=newest_first), zone) for m in widths}
    given = bodies(spark, {(k, str(m)): lines[m] for k in ("A", None) for m in widths})
    parsed = parse_responses(given, INTRADAY, zone=zone, keys=("symbol",), newest_first=newest_first)
    assert misplaced(parsed) == (0, 2 * sum(map(len, lines.values())))


@pytest.mark.parametrize("policy", ["void_response", "fail"])
def test_policies(spark, policy):
    lines = local_lines(instants("2024-11-03T03:00", 30, 12)[::-1], NEW_YORK)
    parsed = parse_responses(
        bodies(spark, {("A", "r"): lines}), INTRADAY, zone=NEW_YORK, keys=("symbol",), on_bad_line=policy, newest_first=True)
    assert misplaced(parsed) == (0, 12)


def test_without_order_the_first_occurrence(spark):
    lines = local_lines(instants("2024-11-03T05:00", 60, 2)[::-1], NEW_YORK)
    parsed = parse_responses(bodies(spark, {("A", "r"): lines}), INTRADAY, zone=NEW_YORK, keys=("symbol",))
    assert misplaced(parsed) == (1, 2)
    # One pass alone shows no step, so it stays at the first too.
    alone = parse_responses(
        bodies(spark, {("A", "r"): lines[:1]}), INTRADAY, zone=NEW_YORK, keys=("symbol",), newest_first=True)
    assert misplaced(alone) == (1, 1)


def test_two_autumns_and_two_responses(spark):
    times = instants("2023-11-05T04:00", 60, 6) + instants("2024-11-03T04:00", 60, 6)
    lines = local_lines(times[::-1], NEW_YORK)
    parsed = parse_responses(
        bodies(spark, {("A", "r"): lines, ("A", "s"): lines}), INTRADAY, zone=NEW_YORK, keys=("symbol",), newest_first=True)
    assert misplaced(parsed) == (0, 24)


def test_landed_files(spark, tmp_path):
    lines = local_lines(instants("2024-11-03T03:00", 15, 24)[::-1], NEW_YORK)
    land(tmp_path, INTRADAY, {"symbol": "A"}, {"1": "\n".join([HEADER, *lines[:8], "x", *lines[8:]])})
    for policy, kept in (("quarantine", 24), ("void_response", 0)):
        parsed = read_landing(
            spark, str(tmp_path), INTRADAY, zone=NEW_YORK, on_bad_line=policy, newest_first=True)
        assert misplaced(parsed) == (0, kept)
        assert parsed.errors.count() == 1


def test_needs_a_position(spark):
    with pytest.raises(ValueError):
        parse_lines(spark.createDataFrame([], "response_id string, line string"), INTRADAY, zone="UTC", newest_first=True)
