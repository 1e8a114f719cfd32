"""``bar_responses``: a Python data source with one task per (series, slice) request.

The source only moves bytes: each row is one response with its status and whole
body. Splitting and typing happen in the JVM (``tickloom.operators.bad_lines``).

Options: ``method``; ``symbols`` ("IBM,AAPL") or ``pairs`` ("EUR/USD,EUR/GBP"), as a JSON list
where a name holds a comma, or "all" for every series landed under ``path``;
``interval``, ``slices`` (comma list or "all"), ``outputsize``, ``adjusted``,
``zone``, ``apikey``; ``transport`` ("http" with ``baseurl`` and any number of
``header.<name>``, or "file" with ``path``); ``requestsPerTask`` (1); ``filesSplit`` (4): a landed
series' files are listed by its tasks and dealt to so many of them.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import replace
from http.client import HTTPException
from urllib.error import HTTPError, URLError
from urllib.parse import unquote
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition,
)
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

import tickloom
from tickloom.plans.methods import SLICES, RequestSpec, method_of
from tickloom.sources.landing import partition_names

FORMAT = "bar_responses"
ALL = "all"
TIMEOUT_SECONDS = 30
_PATH_SPECIALS = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(0x20)}


def http_get(url: str, headers: dict[str, str], opener: Callable = urlopen) -> tuple:
    """(status, reason, body) of a GET; a refused status is data, not an exception.

    A request that never got a response has a NULL status.
    """
    try:
        try:
            with opener(Request(url, headers=headers), timeout=TIMEOUT_SECONDS) as response:
                return response.status, response.reason, response.read().decode("utf-8", "replace")
        except HTTPError as refused:
            with refused:
                return refused.code, str(refused.reason), refused.read().decode("utf-8", "replace")
    except (URLError, OSError, HTTPException) as failed:
        return None, f"no response: {getattr(failed, 'reason', failed)}", None


def file_get(location: str) -> tuple:
    try:
        with open(location, "rb") as file:
            return 200, "OK", file.read().decode("utf-8", "replace")
    except FileNotFoundError:
        return 404, "Not Found", None
    except OSError as failed:
        return None, f"no response: {failed.strerror or failed}", None


def local_path(location: str) -> str:
    """A plain path of a path or ``file:`` URI."""
    scheme = location.split(":/", 1)[0] if ":/" in location else "file"
    if scheme != "file":
        raise ValueError(f"the file transport cannot open {scheme!r} locations; use read_landing")
    return "/" + location.removeprefix("file:").lstrip("/") if ":/" in location else location


def _escaped(value: str) -> str:
    """A partition value as Spark writes it in directory names."""
    return "".join(f"%{ord(c):02X}" if c in _PATH_SPECIALS else c for c in value)


def landed_files(root: str, method: str, series: tuple[str, ...], slice_name: str | None) -> list[tuple[str, str]]:
    """(name, path) of a landed series' files; its folder if that cannot be listed, to be read as an error row."""
    values = dict(zip(method_of(method).keys, series), slice=slice_name)
    folder = os.path.join(
        root, method, *(f"{name}={_escaped(values[name])}" for name in partition_names(method)))
    try:
        return sorted((e.name, e.path) for e in os.scandir(folder) if e.is_file() and e.name[0] not in "._")
    except OSError:
        return [(os.path.basename(folder), folder)]


def _items(text: str | None) -> list[str]:
    if (text or "").lstrip().startswith("["):
        return [str(item) for item in json.loads(text)]
    return [item.strip() for item in (text or "").split(",") if item.strip()]


class BarResponseReader(DataSourceReader):
    def __init__(self, options: dict):
        self.method = method_of(options.get("method", ""))
        self.requests_per_task = int(options.get("requestsPerTask", 1))
        if self.requests_per_task < 1:
            raise ValueError("requestsPerTask must be at least 1")
        self.files_split = int(options.get("filesSplit", 4))
        if self.files_split < 1:
            raise ValueError("filesSplit must be at least 1")
        adjusted = options.get("adjusted", "false").lower()
        if adjusted not in ("true", "false"):
            raise ValueError("adjusted must be true or false")
        self.spec = RequestSpec(
            method=self.method.name,
            zone=options.get("zone", "UTC"),
            interval=options.get("interval", ""),
            output_size=options.get("outputsize", "compact"),
            adjusted=adjusted == "true",
            api_key=options.get("apikey", ""),
        )
        self.transport = options.get("transport", "http")
        needed = {"http": "baseurl", "file": "path"}.get(self.transport)
        if needed is None:
            raise ValueError(f"transport {self.transport!r} is not supported")
        if not options.get(needed):
            raise ValueError(f"transport {self.transport!r} needs the option {needed!r}")
        base = options.get(needed)
        self.base = local_path(base) if self.transport == "file" else base
        self.series = self._series(options)
        self.slices = self._slices(options)
        self.headers = {
            name.split(".", 1)[1]: options.get(name)
            for name in options if name.lower().startswith("header.")
        }

    def _series(self, options) -> list[tuple[str, ...]]:
        equity = self.method.kind == "equity"
        text = options.get("symbols" if equity else "pairs")
        given = _items(text)
        if options.get("pairs" if equity else "symbols"):
            raise ValueError(f"method {self.method.name!r} does not read that kind of series")
        if text == ALL and self.transport == "file":
            return self._landed(os.path.join(self.base, self.method.name), self.method.keys)
        series = [(item,) if equity else tuple(item.split("/")) for item in given]
        if not series or any(len(s) != len(self.method.keys) or not all(s) for s in series):
            raise ValueError("give symbols like 'IBM,AAPL' or pairs like 'EUR/USD,EUR/GBP'")
        return list(dict.fromkeys(series))

    def _landed(self, folder: str, keys: tuple[str, ...]) -> list[tuple[str, ...]]:
        """Key values of the folders of landed series."""
        if not keys:
            return [()]
        if not os.path.isdir(folder):
            return []
        start = f"{keys[0]}="
        names = sorted(name for name in os.listdir(folder) if name.startswith(start))
        return [
            (unquote(name.removeprefix(start)), *rest)
            for name in names for rest in self._landed(os.path.join(folder, name), keys[1:])
        ]

    def _slices(self, options) -> list[str | None]:
        if "slice" not in self.method.options:
            return [None]
        text = options.get("slices", self.spec.slice)
        names = list(SLICES) if text == "all" else list(dict.fromkeys(_items(text)))
        if not names:
            raise ValueError("slices must name a slice, or be 'all'")
        for name in names:
            replace(self.spec, slice=name)  # raises on an unknown slice
        return names

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and IN on a series key or the slice drop requests before they are sent."""
        for pushed in filters:
            column = pushed.attribute[0] if isinstance(pushed, (EqualTo, In)) else None
            wanted = pushed.value if isinstance(pushed, In) else (getattr(pushed, "value", None),)
            if column in self.method.keys:
                position = self.method.keys.index(column)
                self.series = [s for s in self.series if s[position] in wanted]
            elif column == "slice" and self.slices != [None]:
                self.slices = [s for s in self.slices if s in wanted]
            else:
                yield pushed

    def _locations(self, series, slice_name, part) -> list[str]:
        """Files of a request that fall to a part of it, listed by the part's task."""
        if self.transport == "http":
            return [""]
        files = landed_files(self.base, self.method.name, series, slice_name)
        return [path for _, path in files][part::self.files_split]

    def partitions(self) -> list[InputPartition]:
        """Plain tuples (series, slice, part), as there may be very many requests."""
        parts = range(self.files_split if self.transport == "file" else 1)
        requests = [
            (series, slice_name, part)
            for series in self.series for slice_name in self.slices for part in parts
        ]
        size = self.requests_per_task
        batches = [requests[i:i + size] for i in range(0, len(requests), size)]
        return [InputPartition(batch) for batch in batches or [[]]]

    def _fetch(self, series, slice_name, location) -> tuple:
        if self.transport == "file":
            return file_get(location)
        spec = replace(self.spec, slice=slice_name) if slice_name else self.spec
        return http_get(spec.endpoint(self.base, series), self.headers)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        names = response_schema(self.method.name).names
        types = [pa.int32() if name == "status" else pa.string() for name in names]
        requests = (
            (series, slice_name, location)
            for series, slice_name, part in partition.value
            for location in self._locations(series, slice_name, part)
        )
        for series, slice_name, location in requests:
            status, reason, body = self._fetch(series, slice_name, location)
            named = [self.method.name, *series, slice_name, os.path.basename(location)]
            response_id = "/".join(part for part in named if part)
            row = (*series, slice_name, response_id, status, reason, body)
            # One batch per response: bodies are large, and only one is held at a time.
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], type_) for value, type_ in zip(row, types)], names=names
            )


def response_schema(method: str) -> StructType:
    keys = [StructField(name, StringType()) for name in (*method_of(method).keys, "slice")]
    return StructType([
        *keys,
        StructField("response_id", StringType()),
        StructField("status", IntegerType()),
        StructField("reason", StringType()),
        StructField("body", StringType()),
    ])


class BarResponseSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return response_schema(self.options.get("method", ""))

    def reader(self, schema: StructType) -> DataSourceReader:
        return BarResponseReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the source known to the session.

    The package is pickled by value, so executors need no copy of it.
    """
    register_pickle_by_value(tickloom)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BarResponseSource)
