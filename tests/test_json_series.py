import json

import pytest

from tickloom.operators.bad_lines import parse_responses
from tickloom.operators.json_series import parse_json_series

DAILY = "TIME_SERIES_DAILY"
SCHEMA = "symbol string, response_id string, status int, reason string, body string"


def entry(**values):
    return {**dict(open="1.5", high=2, low=1.25, close="2e0", volume=7), **values}


def body(**days):
    return json.dumps({"Meta Data": {"x": 1}, "Series (Daily)": {k.replace("_", "-")[1:]: v for k, v in days.items()}})


BODIES = {
    "good": body(d2024_01_02=entry(), d2024_01_03=entry(open="-0.5", extra=[1])),
    "bad": body(d2024_01_02=entry(), d2024_01_03=entry(high="x"), d2024_01_04=entry(volume=None), x2024=entry(),
                d2024_01_05=5, d2024_01_06=None, d2024_01_08={k: v for k, v in entry().items() if k != "close"}),
    "empty": body(),
    "none": None, "cut": '{"Series (Daily)": ', "list": "[1]", "null": "null", "other": '{"Note": "limit"}',
    "number": '{"Series (Daily)": 5}', "twice": '{"Series (Daily)": {}, "Series (Daily)": {}}',
}


def parsed(spark, bodies=None, policy="quarantine", **options):
    rows = [("A", n, 200, "OK", b) for n, b in (BODIES if bodies is None else bodies).items()]
    if bodies is None:
        rows += [(None, "refused", 500, "Server Error", BODIES["good"]), ("A", "silent", None, "no response: late", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    return parse_json_series(
        df, DAILY, zone="UTC", series="Series (Daily)", keys=("symbol",), on_bad_line=policy, **options)


def test_values_and_errors(spark):
    found = parsed(spark)
    days = sorted((r.timestamp // 86_400_000, r.open, r.high, r.low, r.close, r.volume) for r in found.bars.collect())
    assert days == [(19724, 1.5, 2.0, 1.25, 2.0, 7)] * 2 + [(19725, -0.5, 2.0, 1.25, 2.0, 7)]
    errors = sorted((r.response_id, r.reason, (r.line or "").split(":")[0]) for r in found.errors.collect())
    assert errors == sorted([
        ("bad", "bad high", "2024-01-03"), ("bad", "missing volume", "2024-01-04"), ("bad", "bad timestamp", "2024"),
        ("bad", "missing open", "2024-01-05"), ("bad", "missing open", "2024-01-06"), ("bad", "missing close", "2024-01-08"),
        ("none", "bad json", ""), ("cut", "bad json", ""), ("twice", "bad json", ""),
        *((n, "no Series (Daily)", "") for n in ("list", "null", "other", "number")),
        ("refused", "status 500 Server Error", ""), ("silent", "no response: late", "")])


def test_void_and_fail(spark):
    assert parsed(spark, policy="void_response").bars.count() == 2
    assert parsed(spark, policy="void_response").errors.count() == parsed(spark).errors.count()
    good = {"good": BODIES["good"], "empty": BODIES["empty"]}
    assert parsed(spark, good, "fail").bars.count() == 2
    with pytest.raises(Exception, match="bad high"):
        parsed(spark, {"one": body(d2024_01_03=entry(high="x"))}, "fail").bars.collect()
    with pytest.raises(ValueError):
        parsed(spark, policy="other")


def test_no_responses_and_named_fields(spark):
    none = parse_json_series(
        spark.createDataFrame([], SCHEMA), DAILY, zone="UTC", series="Series (Daily)", keys=("symbol",))
    assert none.bars.columns == ["symbol", "timestamp", "open", "high", "low", "close", "volume"] and none.bars.count() == 0
    assert none.errors.count() == 0
    named = {"a": body(d2024_01_02={"1. open": 9, **entry()})}
    assert parsed(spark, named, fields={"open": "1. open"}).bars.head().open == 9.0
    with pytest.raises(ValueError):
        parsed(spark, named, fields={"open": "it's"})


def test_equals_csv(spark):
    """The same bars as CSV and as JSON, padded and odd numbers included."""
    values = [" 1.5 ", "Infinity", "inf", "NaN", "1e400", "", "-1"]
    days = [f"2024-01-{i:02d}" for i in range(1, len(values) + 1)]
    lines = "\n".join(["timestamp,open,high,low,close,volume", *(f"{d},{v},1,1,1,3" for d, v in zip(days, values))])
    csv = spark.createDataFrame([("A", "r", 200, "OK", lines)], SCHEMA)
    bodies = {"r": json.dumps({"Series (Daily)": {
        d: dict(open=v, high="1", low="1", close="1", volume="3") for d, v in zip(days, values)}})}
    expected, found = parse_responses(csv, DAILY, zone="UTC", keys=("symbol",)), parsed(spark, bodies)
    assert sorted(map(str, found.bars.collect())) == sorted(map(str, expected.bars.collect()))
    assert sorted(r.reason for r in found.errors.collect()) == sorted(r.reason for r in expected.errors.collect())
