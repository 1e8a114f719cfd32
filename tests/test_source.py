import io
from http.client import IncompleteRead
from urllib.error import HTTPError, URLError
from urllib.parse import parse_qsl, urlsplit

import pytest

from conftest import land
from tickloom.plans.methods import RequestSpec
from tickloom.plans.read import (
    read_forex, read_landing, read_pairs, read_responses, read_symbol, read_symbols,
)
from tickloom.sources import responses as source
from tickloom.sources.shared import shared_folder

DAILY = "TIME_SERIES_DAILY"
EXTENDED = "TIME_SERIES_INTRADAY_EXTENDED"
BODY = "timestamp,open,high,low,close,volume\n2021-04-01,1,2,0.5,1.5,10\n2021-04-02,1,2,0.5,1.5,11\n"
FX_BODY = "timestamp,open,high,low,close\n2021-04-01,1,2,0.5,1.5\n"
SPEC = RequestSpec(DAILY, "UTC", api_key="secret")


@pytest.fixture
def root(tmp_path):
    land(tmp_path, DAILY, {"symbol": "IBM"}, {"1.csv": BODY, "2.csv": BODY.replace("2021", "2020")})
    land(tmp_path, DAILY, {"symbol": "A%2FB"}, {"1.csv": BODY})
    land(tmp_path, DAILY, {"symbol": "NOTE"}, {"1.csv": '{"Note": "limit"}', "_SUCCESS": "x"})
    land(tmp_path, "FX_DAILY", {"from_symbol": "EUR", "to_symbol": "USD"}, {"1.csv": FX_BODY})
    land(tmp_path, "FX_DAILY", {"from_symbol": "EUR", "to_symbol": "GBP"}, {"1.csv": FX_BODY})
    for name in ("year1month1", "year2month12"):
        body = BODY.replace("timestamp", "time").replace("-01,", "-01 18:05:00,").replace("-02,", "-02 09:30:00,")
        land(tmp_path, EXTENDED, {"symbol": "IBM", "slice": name}, {"1.csv": body})
    return str(tmp_path)


def reader(**options):
    return source.BarResponseReader({"method": DAILY, "symbols": "IBM,AAPL", "transport": "http",
                                     "baseurl": "http://host/query", **options})


def test_many_symbols(spark, root):
    found = read_symbols(spark, SPEC, ["IBM", "A/B", "NOTE", "GONE"], transport="file", path=root)
    counted = {r.symbol: r["count"] for r in found.bars.groupBy("symbol").count().collect()}
    assert counted == {"IBM": 4, "A/B": 2}
    assert {r.symbol: r.reason for r in found.errors.collect()} \
        == {"NOTE": "no header", "GONE": "status 404 Not Found"}


def test_single_series_has_the_method_columns(spark, root):
    bars = read_symbol(spark, SPEC, "IBM", transport="file", path=root)
    assert bars.columns == ["timestamp", "open", "high", "low", "close", "volume"]
    assert bars.count() == 4
    fx = read_forex(spark, RequestSpec("FX_DAILY", "UTC"), transport="file", path=root)
    assert [tuple(r) for r in fx.collect()] == [(1617235200000, 1.0, 2.0, 0.5, 1.5)]


def test_pairs(spark, root):
    found = read_pairs(spark, RequestSpec("FX_DAILY", "UTC"), [("EUR", "USD"), ("EUR", "GBP")],
                       transport="file", path=root)
    assert {(r.from_symbol, r.to_symbol) for r in found.bars.collect()} == {("EUR", "USD"), ("EUR", "GBP")}


def test_wrong_kind_of_method(spark, root):
    with pytest.raises(ValueError):
        read_symbol(spark, RequestSpec("FX_DAILY", "UTC"), "IBM", transport="file", path=root)
    with pytest.raises(ValueError):
        read_forex(spark, SPEC, transport="file", path=root)


def test_slices(spark, root):
    spec = RequestSpec(EXTENDED, "UTC", interval="1min")
    found = read_symbols(spark, spec, ["IBM"], transport="file", path=root, slices="all")
    assert {r.slice for r in found.bars.select("slice").distinct().collect()} == {"year1month1", "year2month12"}
    assert found.errors.count() == 22
    assert read_landing(spark, root, EXTENDED, zone="UTC").bars.exceptAll(found.bars).count() == 0


def test_file_source_equals_text_source(spark, root):
    found = read_symbols(spark, SPEC, ["IBM", "A/B"], transport="file", path=root).bars
    landed = read_landing(spark, root, DAILY, zone="UTC").bars
    assert found.exceptAll(landed).count() == 0 and landed.exceptAll(found).count() == 0


def test_file_locations(spark, root):
    for path in (f"file:{root}", f"file://{root}"):
        assert read_symbol(spark, SPEC, "IBM", transport="file", path=path).count() == 4
    with pytest.raises(ValueError):
        reader(transport="file", path="s3a://bucket/root")


def test_files_are_dealt_to_tasks_and_batched(spark, root):
    series = [("IBM",), ("A/B",)]
    one = read_responses(spark, SPEC, series, transport="file", path=root, filesSplit="2")
    assert one.rdd.getNumPartitions() == 4 and one.count() == 3
    two = read_responses(spark, SPEC, series, transport="file", path=root, filesSplit="1", requestsPerTask="2")
    assert two.rdd.getNumPartitions() == 1 and two.count() == 3


def test_every_landed_series(spark, root):
    found = read_symbols(spark, SPEC, None, transport="file", path=root)
    assert {r.symbol for r in found.bars.collect()} == {"IBM", "A/B"}
    assert [r.symbol for r in found.errors.collect()] == ["NOTE"]
    pairs = read_pairs(spark, RequestSpec("FX_DAILY", "UTC"), None, transport="file", path=root)
    assert {(r.from_symbol, r.to_symbol) for r in pairs.bars.collect()} == {("EUR", "USD"), ("EUR", "GBP")}


def test_symbols_may_hold_commas(spark, tmp_path):
    land(tmp_path, DAILY, {"symbol": "A,B"}, {"1.csv": BODY})
    found = read_symbols(spark, SPEC, ["A,B"], transport="file", path=str(tmp_path))
    assert {r.symbol for r in found.bars.collect()} == {"A,B"} and found.errors.count() == 0


def test_no_slice_is_refused():
    with pytest.raises(ValueError):
        reader(method=EXTENDED, interval="1min", slices="")


def test_files_that_cannot_be_read_are_error_rows(tmp_path):
    assert source.file_get(str(tmp_path)) == (None, "no response: Is a directory", None)

    class Broken(io.BytesIO):
        def read(self, *args):
            raise IncompleteRead(b"")

    def opener(request, timeout):
        raise HTTPError("http://host", 500, "Server Error", {}, Broken())

    status, reason, body = source.http_get("http://host", {}, opener)
    assert (status, body) == (None, None) and reason.startswith("no response")


def test_landed_files_follow_the_data_not_the_tasks(spark):
    """A range of keys and time is one task's, whatever the number of tasks before it."""
    import os

    from tickloom.plans.tables import landed

    root = landed(spark, "/root/testdata/sf0.001", DAILY)
    files = [f for _, _, names in os.walk(root.removeprefix("file:")) for f in names if f.startswith("part")]
    assert len(files) <= 3 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_key_filters_drop_requests(spark, root):
    every = read_responses(spark, SPEC, [("IBM",), ("A/B",), ("NOTE",)], transport="file", path=root)
    split = reader().files_split
    assert every.filter("symbol = 'NOTE'").rdd.getNumPartitions() == split
    assert every.filter("symbol in ('NOTE', 'A/B')").rdd.getNumPartitions() == 2 * split
    assert [r.symbol for r in every.filter("symbol = 'NOTE' and status = 200").collect()] == ["NOTE"]
    assert every.filter("symbol = 'NONE'").count() == 0


def test_written_responses_are_fetched_once(spark, root):
    kept = read_responses(spark, SPEC, [("IBM",)], written=True, transport="file", path=root)
    assert kept.inputFiles() and all(shared_folder(spark) in file for file in kept.inputFiles())
    assert kept.count() == 2


@pytest.mark.parametrize("options", [
    {"symbols": ""}, {"symbols": "", "pairs": "EUR/USD"}, {"pairs": "EUR/USD"}, {"transport": "ftp"},
    {"baseurl": ""}, {"method": "NOPE"}, {"adjusted": "maybe"}, {"outputsize": "tiny"},
    {"method": "FX_DAILY", "symbols": "", "pairs": "EUR"}, {"requestsPerTask": "0"},
    {"method": EXTENDED, "interval": "1min", "slices": "year3month1"},
    {"method": "FX_INTRADAY", "symbols": "", "pairs": "EUR/USD"},
])
def test_bad_options(options):
    with pytest.raises(ValueError):
        reader(**options)


def test_all_slices_make_one_request_each():
    plan = reader(method=EXTENDED, interval="1min", slices="all").partitions()
    assert len(plan) == 48
    assert len({p.value[0] for p in plan}) == 48


class Answer(io.BytesIO):
    def __init__(self, status, reason, body):
        super().__init__(body)
        self.status, self.reason = status, reason


def test_http_get_answers():
    seen = []

    def opener(request, timeout):
        seen.append((request.full_url, dict(request.header_items()), timeout))
        return Answer(200, "OK", "aé".encode())

    assert source.http_get("http://host/x", {"Token": "t"}, opener) == (200, "OK", "aé")
    assert seen == [("http://host/x", {"Token": "t"}, 30)]


@pytest.mark.parametrize("code", [422, 500])
def test_http_get_keeps_refused_statuses(code):
    def opener(request, timeout):
        raise HTTPError(request.full_url, code, "refused", {}, io.BytesIO(b"body"))

    assert source.http_get("http://host/x", {}, opener) == (code, "refused", "body")


@pytest.mark.parametrize("failure", [URLError("no route"), TimeoutError("timed out"),
                                     IncompleteRead(b"half")])
def test_http_get_without_response(failure):
    def opener(request, timeout):
        raise failure

    status, reason, body = source.http_get("http://host/x", {}, opener)
    assert status is None and body is None and reason.startswith("no response")


def test_http_reader_sends_the_request(monkeypatch):
    sent = []
    monkeypatch.setattr(source, "http_get", lambda url, headers: sent.append((url, headers)) or (200, "OK", BODY))
    read = reader(**{"method": EXTENDED, "interval": "5min", "slices": "year1month2", "adjusted": "true",
                     "apikey": "secret", "header.Token": "t", "symbols": "IBM"})
    batches = [b for p in read.partitions() for b in read.read(p)]
    query = dict(parse_qsl(urlsplit(sent[0][0]).query))
    assert query == {"function": EXTENDED, "symbol": "IBM", "interval": "5min", "slice": "year1month2",
                     "adjusted": "true", "apikey": "secret"}
    assert sent[0][1] == {"Token": "t"}
    row = batches[0].to_pylist()[0]
    assert row["status"] == 200 and row["body"] == BODY
    assert "secret" not in row["response_id"]
