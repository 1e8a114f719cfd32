"""Requests as a table: retries, the journal, resumed runs."""

import io
import shutil
import sys
import time
from collections import Counter
from pathlib import Path
from urllib.error import HTTPError, URLError
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.cloudpickle import register_pickle_by_value

from conftest import land, plan_of
from tickloom.plans.methods import RequestSpec
from tickloom.plans.read import read_landing, read_requests
from tickloom.sources.requests import Files, Http, Policy, fetch, journal_rows, request_table

register_pickle_by_value(sys.modules[__name__])

DAILY, EXTENDED = "TIME_SERIES_DAILY", "TIME_SERIES_INTRADAY_EXTENDED"
SPEC = RequestSpec(DAILY, "UTC", api_key="secret")
BODY = "timestamp,open,high,low,close,volume\n2021-04-01,1,2,0.5,1.5,{}\n"
EACH = Policy(pause=0.001, requests_per_task=1)


class Answer(io.BytesIO):
    status, reason = 200, "OK"


class Service:
    """Answers after ``failures`` refusals; logs each call in a folder, as tasks run in processes of their own."""

    def __init__(self, log, failures=0, breaks=(), refuses=()):
        self.log, self.failures, self.breaks, self.refuses = str(log), failures, breaks, refuses

    def __call__(self, request, timeout):
        symbol = parse_qs(urlsplit(request.full_url).query)["symbol"][0]
        calls = Path(self.log, symbol)
        with calls.open("a") as file:
            file.write("x")
        before = len(calls.read_text()) - 1
        if symbol in self.breaks:
            raise RuntimeError("the task dies")
        if symbol in self.refuses:
            raise HTTPError(request.full_url, 404, "Not Found", {}, io.BytesIO(b""))
        if before < self.failures:
            if before % 2:
                raise URLError("no route")
            raise HTTPError(request.full_url, 503, "Busy", {}, io.BytesIO(b"later"))
        return Answer(BODY.format(len(symbol)).encode())


@pytest.fixture
def log(tmp_path):
    (tmp_path / "log").mkdir()
    return tmp_path / "log"


def calls(log):
    return {p.name: len(p.read_text()) for p in log.iterdir()}


def symbols(spark, *names):
    return request_table(spark.createDataFrame([(n,) for n in names], "symbol string"), SPEC)


def volumes(parsed):
    return {r.symbol: r.volume for r in parsed.bars.collect()}


NAMES = [f"S{'x' * i}" for i in range(12)]


def test_refused_requests_are_sent_again_until_answered(spark, log, tmp_path):
    journal = str(tmp_path / "journal")
    found = read_requests(symbols(spark, *NAMES), SPEC, Http("http://host/q", opener=Service(log, 2)), journal, policy=EACH)
    assert volumes(found) == {n: len(n) for n in NAMES} and found.errors.count() == 0
    assert calls(log) == dict.fromkeys(NAMES, 3)
    rows = journal_rows(spark, DAILY, journal).collect()
    assert [r.attempts for r in rows] == [3] * 12 and all(r.answered for r in rows)
    assert not any("secret" in str(r) for r in rows)


def test_a_killed_run_goes_on(spark, log, tmp_path):
    """What tasks had answered before the run died is not asked again; the result is that of a plain run."""
    journal, requests = str(tmp_path / "journal"), symbols(spark, *NAMES)
    with pytest.raises(Exception, match="the task dies"):
        fetch(requests, SPEC, Http("http://host/q", opener=Service(log, breaks=NAMES[5:6])), journal, policy=EACH)
    kept = {r.symbol for r in journal_rows(spark, DAILY, journal).collect()}
    assert kept and NAMES[5] not in kept
    before = calls(log)
    found = read_requests(requests, SPEC, Http("http://host/q", opener=Service(log)), journal, policy=EACH)
    assert volumes(found) == {n: len(n) for n in NAMES} and found.errors.count() == 0
    after = calls(log)
    assert all(after[n] == before[n] for n in kept) and all(after[n] == before.get(n, 0) + 1 for n in set(NAMES) - kept)
    # Once all are answered, nothing is sent.
    read_requests(requests, SPEC, Http("http://host/q", opener=Service(log, breaks=NAMES)), journal)
    assert calls(log) == after


def test_requests_without_an_answer_are_error_rows_and_asked_again(spark, log, tmp_path):
    journal, requests = str(tmp_path / "journal"), symbols(spark, "AA", "B")
    policy = Policy(attempts=2, pause=0.001)
    first = read_requests(requests, SPEC, Http("http://h/q", opener=Service(log, 3)), journal, policy=policy)
    assert {(r.symbol, r.reason) for r in first.errors.collect()} == {
        (n, "no response: no route") for n in ("AA", "B")}
    again = read_requests(requests, SPEC, Http("http://h/q", opener=Service(log, 3)), journal, policy=policy)
    assert volumes(again) == {"AA": 2, "B": 1} and again.errors.count() == 0
    assert calls(log) == {"AA": 4, "B": 4}


def test_refusals_that_are_final_are_answers(spark, log, tmp_path):
    journal = str(tmp_path / "journal")
    service = Http("http://h/q", opener=Service(log, refuses=("GONE",)))
    for _ in range(2):
        found = read_requests(symbols(spark, "GONE", "A"), SPEC, service, journal, policy=EACH)
        assert [(r.symbol, r.reason) for r in found.errors.collect()] == [("GONE", "status 404 Not Found")]
    assert calls(log) == {"GONE": 1, "A": 1}


def test_odd_tables(spark, log):
    """Missing keys, repeated requests, no requests."""
    service = Http("http://h/q", opener=Service(log))
    found = read_requests(symbols(spark, None, "", "A", "A"), SPEC, service)
    assert volumes(found) == {"A": 1} and calls(log) == {"A": 1}
    assert [r.reason for r in found.errors.collect()] == ["no request: a key is missing"] * 2
    nothing = read_requests(symbols(spark, "A").limit(0), SPEC, service)
    assert nothing.bars.count() == 0 and nothing.errors.count() == 0


def test_a_file_written_twice_counts_once(spark, log, tmp_path):
    journal, requests = tmp_path / "journal", symbols(spark, *NAMES)
    service = Http("http://h/q", opener=Service(log))
    fetch(requests, SPEC, service, str(journal), policy=EACH)
    for part in list(journal.glob("part-*")):
        shutil.copy(part, journal / f"again-{part.name}")
    assert Counter(r.symbol for r in fetch(requests, SPEC, service, str(journal)).collect()) == dict.fromkeys(NAMES, 1)


def test_a_journal_serves_several_tables(spark, log, tmp_path):
    journal = str(tmp_path / "journal")
    service = Http("http://h/q", opener=Service(log))
    fetch(symbols(spark, "A", "B"), SPEC, service, journal)
    found = fetch(symbols(spark, "B", "C"), SPEC, service, journal).collect()
    assert {r.symbol for r in found} == {"B", "C"} and calls(log) == {"A": 1, "B": 1, "C": 1}
    # Another request shape of the same series is another request.
    full = RequestSpec(DAILY, "UTC", output_size="full")
    assert fetch(symbols(spark, "B"), full, service, journal).count() == 1 and calls(log)["B"] == 2


def test_rate_of_a_task(spark, log):
    start = time.monotonic()
    policy = Policy(rate=10)
    fetch(symbols(spark, *NAMES), SPEC, Http("http://h/q", opener=Service(log)), policy=policy)
    assert time.monotonic() - start >= 1.1


def test_very_many_requests_never_pass_the_driver(spark):
    series = spark.range(1_000_000).selectExpr("concat('S', id) AS symbol")
    requests = request_table(series, RequestSpec(EXTENDED, "UTC", interval="1min"), slices="all")
    plan = plan_of(requests)
    assert "Range" in plan and "LocalTableScan" not in plan and "Exchange" not in plan
    assert requests.count() == 24_000_000


def test_landed_files(spark, tmp_path):
    land(tmp_path, DAILY, {"symbol": "IBM"}, {"1.csv": BODY.format(1), "2.csv": BODY.format(2).replace("2021", "2020")})
    land(tmp_path, DAILY, {"symbol": "A%2FB"}, {"1.csv": BODY.format(3)})
    found = read_requests(symbols(spark, "IBM", "A/B", "GONE"), SPEC, Files(str(tmp_path)))
    landed = read_landing(spark, str(tmp_path), DAILY, zone="UTC").bars
    assert sorted(found.bars.collect()) == sorted(landed.collect())
    assert [(r.symbol, r.reason) for r in found.errors.collect()] == [("GONE", "status 404 Not Found")]


def test_wrong_settings(spark):
    for wrong in ({"attempts": 0}, {"requests_per_task": 0}, {"rate": 0}, {"pause": -1}):
        with pytest.raises(ValueError):
            Policy(**wrong)
    with pytest.raises(ValueError):
        Http("")
    frame = spark.createDataFrame([("A",)], "symbol string")
    for series, spec, slices in (
        (frame.toDF("s"), SPEC, None), (frame, SPEC, "all"), (frame, RequestSpec("FX_DAILY", "UTC"), None),
        (frame, RequestSpec(EXTENDED, "UTC", interval="1min"), ("year9month1",)),
    ):
        with pytest.raises(ValueError):
            request_table(series, spec, slices=slices)
