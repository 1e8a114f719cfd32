"""Requests as a table: one row per (series, slice), fetched by tasks into a journal.

``request_table`` makes the rows from a frame of series, so very many requests never pass the driver. ``fetch``
deals them to tasks by their hash and appends what comes back to a journal, a Parquet folder keyed by the request's hash.
A task's responses are in the journal as soon as the task ends, whether or not the job does. A later ``fetch`` with
the same journal asks only for what has no answer there, by an anti join, so a run that was killed goes on where it
stopped, and a lost executor costs the requests of its running tasks.

A request without an answer (no connection, or a status that asks to come again) is sent again after a pause that
doubles each time; its last failure is kept as a row, and asked again by the next run. A task sends at most ``rate`` requests a second to
a host; a host sees that many times the tasks that run at once.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from urllib.parse import urlsplit
from urllib.request import urlopen

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, functions as F

import tickloom
from tickloom.plans.methods import SLICES, RequestSpec, method_of, slice_ordinal
from tickloom.sources.responses import file_get, http_get, landed_files, local_path, response_schema
from tickloom.sources.shared import exists, new_path, written_once

#: Statuses that ask to come again. A request that got no response has a NULL status.
COME_AGAIN = (None, 408, 425, 429, 500, 502, 503, 504)
#: More tasks than this get more requests each.
MOST_TASKS = 100_000
_OWN = "request_id string, part int, attempts int, answered boolean, "

#: (name, status, reason, body)
Answer = tuple[str, int | None, str | None, str | None]


@dataclass(frozen=True)
class Http:
    """GET requests; ``opener`` stands in for ``urlopen`` in tests."""

    baseurl: str
    headers: dict[str, str] = field(default_factory=dict, repr=False)
    opener: Callable = urlopen

    def __post_init__(self):
        if not self.baseurl:
            raise ValueError("the http transport needs a base URL")

    @property
    def location(self) -> str:
        return self.baseurl

    def answers(self, spec: RequestSpec, series: tuple[str, ...]) -> Iterator[Answer]:
        yield "", *http_get(spec.endpoint(self.baseurl, series), self.headers, self.opener)


@dataclass(frozen=True)
class Files:
    """Landed files of a mounted folder, an answer for each file of a series."""

    path: str

    @property
    def location(self) -> str:
        return local_path(self.path)

    def answers(self, spec: RequestSpec, series: tuple[str, ...]) -> Iterator[Answer]:
        for name, file in landed_files(self.location, spec.method, series, spec.slice):
            yield name, *file_get(file)


@dataclass(frozen=True)
class Policy:
    """How often a request is sent, the first pause in seconds, and how requests are dealt."""

    attempts: int = 4
    pause: float = 1.0
    rate: float | None = None
    requests_per_task: int = 1000

    def __post_init__(self):
        if self.attempts < 1 or self.requests_per_task < 1 or self.pause < 0 or (self.rate is not None and self.rate <= 0):
            raise ValueError("attempts and requests_per_task start at 1, pauses at 0, and a rate is positive")


def request_table(series: DataFrame, spec: RequestSpec, *, slices: tuple[str, ...] | str | None = None) -> DataFrame:
    """(keys, slice): a request for each series and slice; ``slices`` is "all", some names, or the spec's own."""
    method = method_of(spec.method)
    missing = [name for name in method.keys if name not in series.columns]
    if missing:
        raise ValueError(f"{spec.method} needs the columns {', '.join(method.keys)}")
    if "slice" not in method.options:
        if slices is not None:
            raise ValueError(f"{spec.method} has no slices")
        return series.select(*method.keys, F.lit(None).cast("string").alias("slice"))
    names = SLICES if slices == "all" else (spec.slice,) if slices is None else tuple(slices)
    for name in names:
        slice_ordinal(name)
    return series.select(*method.keys, F.explode(F.array(*map(F.lit, names))).alias("slice"))


def with_request_id(requests: DataFrame, spec: RequestSpec, location: str) -> DataFrame:
    """Adds the hash of all that a request says, the key aside."""
    keys = method_of(spec.method).keys
    said = {"location": location, "method": spec.method, "interval": spec.interval, "output_size": spec.output_size,
            "adjusted": str(spec.adjusted)}
    columns = [*(F.lit(v).alias(f"_{n}") for n, v in said.items()), *keys, "slice"]
    return requests.select(*keys, "slice").withColumn("request_id", F.sha2(F.to_json(F.struct(*columns)), 256))


def _ask(transport, spec: RequestSpec, series: tuple, request_id: str, policy: Policy, wait: Callable) -> Iterator[tuple]:
    """(part, attempts, answered, answer), answers one by one."""
    if not all(series):
        yield 0, 0, True, ("", None, "no request: a key is missing", None)
        return
    for attempt in range(1, policy.attempts + 1):
        wait()
        answers = transport.answers(spec, series)
        first = next(answers)
        if first[1] not in COME_AGAIN or attempt == policy.attempts:
            break
        # A request's pauses differ from another's, so that those refused together do not come back together.
        share = zlib.crc32(f"{request_id}{attempt}".encode()) / 2**32
        time.sleep(policy.pause * 2 ** (attempt - 1) * (0.5 + share))
    yield 0, attempt, first[1] not in COME_AGAIN, first
    for part, answer in enumerate(answers, 1):
        yield part, attempt, answer[1] not in COME_AGAIN, answer


def _pace(rate: float | None) -> Callable:
    """Waits until the next request may go."""
    next_at = 0.0

    def wait():
        nonlocal next_at
        if rate is None:
            return
        now = time.monotonic()
        if now < next_at:
            time.sleep(next_at - now)
        next_at = max(now, next_at) + 1 / rate

    return wait


def _fetcher(transport, spec: RequestSpec, policy: Policy):
    keys = method_of(spec.method).keys

    def fetch_rows(batches):
        wait = _pace(policy.rate)
        for batch in batches:
            for row in batch.to_pylist():
                series = tuple(row[k] for k in keys)
                own = replace(spec, slice=row["slice"]) if row["slice"] else spec
                asked = _ask(transport, own, series, row["request_id"], policy, wait)
                for part, attempts, answered, (name, status, reason, body) in asked:
                    response_id = "/".join(p for p in (spec.method, *series, row["slice"], name) if p)
                    values = (row["request_id"], part, attempts, answered, *series, row["slice"], response_id,
                              status, reason, body)
                    # One batch per response: bodies are large, and only one is held at a time.
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t) for v, t in zip(values, types)], names=names)

    names = ["request_id", "part", "attempts", "answered", *response_schema(spec.method).names]
    kinds = {"part": pa.int32(), "attempts": pa.int32(), "answered": pa.bool_(), "status": pa.int32()}
    types = [kinds.get(name, pa.string()) for name in names]
    return fetch_rows


def _journal_schema(method: str) -> str:
    return _OWN + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in response_schema(method))


def journal_rows(spark: SparkSession, method: str, journal: str) -> DataFrame:
    """All rows of a journal, with the file each is in."""
    rows = spark.read.schema(_journal_schema(method)).parquet(journal)
    return rows.withColumn("file", F.col("_metadata.file_path"))


def _last_word(rows: DataFrame) -> DataFrame:
    """One file's rows of each request: an answered one's if there is one.

    A request is in several files if it failed in an earlier run, or if a task's output was written twice. Such requests are
    few, and only their ids and files are gathered.
    """
    files = rows.groupBy("request_id", "file").agg(F.min("answered").alias("answered"))
    best = files.groupBy("request_id").agg(
        F.count("*").alias("files"), F.max(F.struct("answered", "file")).alias("best"))
    several = written_once(best.filter("files > 1").select("request_id", F.col("best.file").alias("best")), "several")
    joined = rows.join(several, "request_id", "left")
    return joined.filter(F.col("best").isNull() | (F.col("best") == F.col("file"))).drop("best", "file")


def fetch(
    requests: DataFrame, spec: RequestSpec, transport: Http | Files, journal: str | None = None, *,
    policy: Policy = Policy()
) -> DataFrame:
    """Responses (keys, slice, response_id, status, reason, body) of a request table; **runs when called**.

    ``journal`` is a folder that every executor reaches, a new one in the shared folder if none is given. Repeated
    requests are sent once. Requests with a missing key are error rows and never sent. An empty table gives no rows.
    """
    spark = requests.sparkSession
    register_pickle_by_value(tickloom)
    journal = journal or new_path(spark, "journal")
    wanted = written_once(
        with_request_id(requests, spec, transport.location).dropDuplicates(["request_id"]), "requests")
    todo = wanted
    if exists(spark, journal):
        done = journal_rows(spark, spec.method, journal).groupBy("request_id").agg(F.min("answered").alias("all"))
        todo = written_once(wanted.join(done.filter("all"), "request_id", "left_anti"), "todo")
    n = todo.count()
    if n:
        tasks = min(-(-n // policy.requests_per_task), MOST_TASKS)
        columns = ["request_id", *method_of(spec.method).keys, "slice"]
        # Version 2 moves a task's file to its place when the task ends.
        todo.select(*columns).repartition(tasks, "request_id").mapInArrow(
            _fetcher(transport, spec, policy), _journal_schema(spec.method)
        ).write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(journal)
    elif not exists(spark, journal):
        spark.createDataFrame([], _journal_schema(spec.method)).write.parquet(journal)
    rows = journal_rows(spark, spec.method, journal).join(wanted.select("request_id"), "request_id", "left_semi")
    return _last_word(rows).select(*response_schema(spec.method).names)
