"""Series methods: what each one asks for, its checks and its column layout.

A method names a bar series (period, raw or adjusted, equity or currency pair).
``METHODS`` is the single catalogue behind the data source, the line parser and
the bar operators; ``RequestSpec`` is one validated, immutable request shape.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import urlencode
from zoneinfo import ZoneInfo

from pyspark.sql.types import DoubleType, LongType, StructField, StructType

# Names the remote service accepts.
INTERVALS = ("1min", "5min", "15min", "30min", "60min")
SLICES = tuple(f"year{year}month{month}" for year in (1, 2) for month in range(1, 13))
OUTPUT_SIZES = ("compact", "full")
DATATYPE = "csv"

# The four column layouts, in the order of the CSV tokens.
_PRICES = ("open", "high", "low", "close")
LAYOUTS = {
    "fx": _PRICES,
    "ohlcv": (*_PRICES, "volume"),
    "daily_adjusted": (*_PRICES, "adj_close", "volume", "dividend_amount", "split_coefficient"),
    "period_adjusted": (*_PRICES, "adj_close", "volume", "dividend_amount"),
}
_LONG_COLUMNS = {"timestamp", "volume"}


@dataclass(frozen=True)
class Method:
    name: str
    kind: str  # "equity" (one symbol) or "fx" (a currency pair)
    period: str  # "intraday", "day", "week" or "month"
    layout: str
    options: tuple[str, ...]  # request parameters besides function, series and key

    @property
    def intraday(self) -> bool:
        return self.period == "intraday"

    @property
    def keys(self) -> tuple[str, ...]:
        return ("symbol",) if self.kind == "equity" else ("from_symbol", "to_symbol")

    @property
    def schema(self) -> StructType:
        names = ("timestamp", *LAYOUTS[self.layout])
        return StructType(
            [StructField(n, LongType() if n in _LONG_COLUMNS else DoubleType()) for n in names]
        )


# The twelve methods and the parameters each request carries.
METHODS: dict[str, Method] = {
    m.name: m
    for m in (
        Method("TIME_SERIES_INTRADAY", "equity", "intraday", "ohlcv",
               ("interval", "outputsize", "adjusted", "datatype")),
        Method("TIME_SERIES_INTRADAY_EXTENDED", "equity", "intraday", "ohlcv",
               ("interval", "slice", "adjusted")),
        Method("TIME_SERIES_DAILY", "equity", "day", "ohlcv", ("outputsize", "datatype")),
        Method("TIME_SERIES_DAILY_ADJUSTED", "equity", "day", "daily_adjusted",
               ("outputsize", "datatype")),
        Method("TIME_SERIES_WEEKLY", "equity", "week", "ohlcv", ("outputsize", "datatype")),
        Method("TIME_SERIES_WEEKLY_ADJUSTED", "equity", "week", "period_adjusted",
               ("outputsize", "datatype")),
        Method("TIME_SERIES_MONTHLY", "equity", "month", "ohlcv", ("outputsize", "datatype")),
        Method("TIME_SERIES_MONTHLY_ADJUSTED", "equity", "month", "period_adjusted",
               ("outputsize", "datatype")),
        Method("FX_INTRADAY", "fx", "intraday", "fx", ("interval", "outputsize", "datatype")),
        Method("FX_DAILY", "fx", "day", "fx", ("outputsize", "datatype")),
        Method("FX_WEEKLY", "fx", "week", "fx", ("datatype",)),
        Method("FX_MONTHLY", "fx", "month", "fx", ("datatype",)),
    )
}


def method_of(name: str, kind: str | None = None) -> Method:
    """The catalogue entry; ``ValueError`` if unknown or of the other kind."""
    method = METHODS.get(name)
    if method is None or (kind is not None and method.kind != kind):
        wanted = "" if kind is None else f" for {kind} series"
        raise ValueError(f"method {name!r} is not supported{wanted}")
    return method


def schema_of(name: str) -> StructType:
    return method_of(name).schema


def slice_ordinal(name: str) -> int:
    """1 for the most recent 30 days, 24 for the oldest."""
    if name not in SLICES:
        raise ValueError(f"slice {name!r} is not supported")
    return SLICES.index(name) + 1


def check_zone(zone: str) -> str:
    try:
        ZoneInfo(zone)
    except (KeyError, ValueError, OSError) as err:
        raise ValueError(f"time zone {zone!r} is not known") from err
    return zone


@dataclass(frozen=True)
class RequestSpec:
    """One request shape, valid for any number of series.

    ``zone`` is the exchange time zone that date and date-time tokens are read in.
    """

    method: str
    zone: str
    interval: str = ""
    slice: str = "year1month1"
    output_size: str = "compact"
    adjusted: bool = False
    api_key: str = field(default="", repr=False)

    def __post_init__(self):
        carried = method_of(self.method).options
        check_zone(self.zone)
        if "interval" in carried and self.interval not in INTERVALS:
            raise ValueError(f"interval {self.interval!r} is not supported")
        if "slice" in carried:
            slice_ordinal(self.slice)
        if self.output_size not in OUTPUT_SIZES:
            raise ValueError(f"output size {self.output_size!r} is not supported")
        if not isinstance(self.adjusted, bool):
            raise ValueError("adjusted must be True or False")

    def parameters(self, series: tuple[str, ...]) -> dict[str, str]:
        """Request parameters for one series, key included, in request order."""
        method = method_of(self.method)
        if len(series) != len(method.keys) or not all(series):
            raise ValueError(f"{self.method} needs {' and '.join(method.keys)}")
        values = {
            "interval": self.interval,
            "slice": self.slice,
            "outputsize": self.output_size,
            "adjusted": str(self.adjusted).lower(),
            "datatype": DATATYPE,
        }
        return {
            "function": self.method,
            **dict(zip(method.keys, series)),
            **{name: values[name] for name in method.options},
            "apikey": self.api_key,
        }

    def endpoint(self, base_url: str, series: tuple[str, ...]) -> str:
        return base_url.rstrip("?") + "?" + urlencode(self.parameters(series))
