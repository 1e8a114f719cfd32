import dataclasses
from urllib.parse import parse_qsl, urlsplit

import pytest

from tickloom.plans.methods import (
    INTERVALS, METHODS, SLICES, RequestSpec, method_of, schema_of, slice_ordinal,
)

BASE = [("timestamp", "bigint"), ("open", "double"), ("high", "double"), ("low", "double"),
        ("close", "double")]


def columns(method):
    return [(f.name, f.dataType.simpleString()) for f in schema_of(method)]


def query(spec, *series):
    return dict(parse_qsl(urlsplit(spec.endpoint("http://host/query", series)).query,
                          keep_blank_values=True))


def test_twelve_methods_of_two_kinds():
    assert len(METHODS) == 12
    assert sum(m.kind == "fx" for m in METHODS.values()) == 4


@pytest.mark.parametrize("method", ["FX_INTRADAY", "FX_DAILY", "FX_WEEKLY", "FX_MONTHLY"])
def test_fx_schema(method):
    assert columns(method) == BASE


@pytest.mark.parametrize("period", ["INTRADAY", "INTRADAY_EXTENDED", "DAILY", "WEEKLY", "MONTHLY"])
def test_ohlcv_schema(period):
    assert columns(f"TIME_SERIES_{period}") == BASE + [("volume", "bigint")]


def test_adjusted_schemas():
    period = BASE + [("adj_close", "double"), ("volume", "bigint"), ("dividend_amount", "double")]
    assert columns("TIME_SERIES_WEEKLY_ADJUSTED") == period
    assert columns("TIME_SERIES_MONTHLY_ADJUSTED") == period
    assert columns("TIME_SERIES_DAILY_ADJUSTED") == period + [("split_coefficient", "double")]


@pytest.mark.parametrize("method", ["TIME_SERIES_INTRADAY", "TIME_SERIES_INTRADAY_EXTENDED",
                                    "FX_INTRADAY"])
def test_interval_is_checked_for_every_intraday_method(method):
    for interval in INTERVALS:
        RequestSpec(method, "UTC", interval=interval)
    for interval in ("2min", ""):
        with pytest.raises(ValueError):
            RequestSpec(method, "UTC", interval=interval)


def test_slices():
    assert len(SLICES) == 24
    assert [slice_ordinal(s) for s in ("year1month1", "year1month12", "year2month1", "year2month12")] \
        == [1, 12, 13, 24]
    spec = RequestSpec("TIME_SERIES_INTRADAY_EXTENDED", "UTC", interval="1min")
    assert spec.slice == "year1month1"
    with pytest.raises(ValueError):
        dataclasses.replace(spec, slice="year3month1")


@pytest.mark.parametrize("change", [{"output_size": "tiny"}, {"adjusted": "true"},
                                    {"zone": "Mars/Base"}, {"method": "DAILY"}])
def test_bad_settings(change):
    with pytest.raises(ValueError):
        RequestSpec(**{"method": "TIME_SERIES_DAILY", "zone": "UTC", **change})


def test_kind_of_series():
    for name, kind in (("FX_DAILY", "equity"), ("TIME_SERIES_DAILY", "fx"), ("X", None)):
        with pytest.raises(ValueError):
            method_of(name, kind)


def test_request_parameters_per_method():
    for name, method in METHODS.items():
        spec = RequestSpec(name, "UTC", interval="5min", api_key="k")
        sent = list(spec.parameters(("A",) if method.kind == "equity" else ("A", "B")))
        assert sent == ["function", *method.keys, *method.options, "apikey"]
    assert METHODS["FX_WEEKLY"].options == ("datatype",)
    assert "outputsize" not in METHODS["TIME_SERIES_INTRADAY_EXTENDED"].options


def test_adjusted_does_not_leak():
    query(RequestSpec("TIME_SERIES_DAILY_ADJUSTED", "UTC", adjusted=True), "IBM")
    sent = query(RequestSpec("TIME_SERIES_INTRADAY", "UTC", interval="1min"), "IBM")
    assert sent["adjusted"] == "false"
    assert sent["outputsize"] == "compact" and sent["datatype"] == "csv"


def test_values_are_encoded_and_key_is_hidden():
    spec = RequestSpec("TIME_SERIES_DAILY", "UTC", api_key="a&b=c")
    assert query(spec, "BRK B&x=1")["symbol"] == "BRK B&x=1"
    assert query(spec, "IBM")["apikey"] == "a&b=c"
    assert "a&b" not in repr(spec)


def test_spec_is_immutable():
    spec = RequestSpec("TIME_SERIES_DAILY", "UTC")
    with pytest.raises(dataclasses.FrozenInstanceError):
        spec.adjusted = True
    with pytest.raises(ValueError):
        spec.endpoint("http://host", ("EUR", "USD"))
