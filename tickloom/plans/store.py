"""A store of bar states: new trades update bars without reading old ones.

``append`` aggregates a batch of trades and adds its state under the batch's name; ``bars`` merges the states, so its work
follows the number of buckets, not of trades. ``compact`` merges them into one state of a new generation.

Layout: ``<path>/gen-<n>/state/batch=<name>`` and ``<path>/gen-<n>/covered``, the names that the generation's base state holds.
A folder appears under its name only when it is complete, by a rename, and a name that the store has is not added
again. So a batch counts once, whether its job was repeated, killed half way or retried by a stream, and a killed ``compact``
changes nothing. One writer at a time; a frame made before a ``compact`` has to be read before it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.functions.calendar import check_period
from tickloom.operators.bar_state import bars_of_state, longer, merge, state_of_ticks
from tickloom.sources.shared import children, discard, moved

_BASE = "base"


class BarStore:
    """``columns`` are those of ``bars_from_ticks``: ts, price, tie_break, volume, adj_close, dividend."""

    def __init__(self, spark: SparkSession, path: str, period: str, *, keys: Sequence[str] = ("symbol",), **columns):
        self.spark, self.path, self.period = spark, path.rstrip("/"), check_period(period)
        self.keys, self.columns = tuple(keys), columns

    def _generation(self) -> int:
        found = [int(n.removeprefix("gen-")) for n in children(self.spark, self.path) if n.startswith("gen-")]
        return max(found, default=0)

    def _folder(self, generation: int) -> str:
        return f"{self.path}/gen-{generation}"

    def batches(self) -> set[str]:
        """Names of the batches that the store holds."""
        folder = self._folder(self._generation())
        own = {n.removeprefix("batch=") for n in children(self.spark, f"{folder}/state")}
        if _BASE in own:
            covered = self.spark.read.schema("batch string").parquet(f"{folder}/covered")
            own |= {row.batch for row in covered.collect()}
        return own - {_BASE}

    def append(self, ticks: DataFrame, batch: str) -> bool:
        """Add a batch of trades; False if the store has one of that name, which then stays as it is."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch) or batch == _BASE:
            raise ValueError(f"batch name {batch!r} is not supported")
        if batch in self.batches():
            return False
        state = state_of_ticks(ticks, self.period, keys=self.keys, **self.columns)
        folder = f"{self._folder(self._generation())}/state"
        if (names := children(self.spark, folder)):
            held = self.spark.read.parquet(f"{folder}/{names[0]}").schema
            if [(f.name, f.dataType) for f in held] != [(f.name, f.dataType) for f in state.schema]:
                raise ValueError("the store holds states of other columns")
        temporary = f"{self.path}/_{batch}"
        state.write.mode("overwrite").parquet(temporary)
        return moved(self.spark, temporary, f"{folder}/batch={batch}")

    def _parts(self, batch: str | None = None) -> DataFrame:
        folder = f"{self._folder(self._generation())}/state"
        names = [f"batch={batch}"] if batch else children(self.spark, folder)
        if not names:
            raise ValueError(f"{self.path} holds no batches")
        return self.spark.read.parquet(*(f"{folder}/{name}" for name in names))

    def state(self) -> DataFrame:
        return merge(self._parts(), keys=self.keys)

    def bars(self, period: str | None = None) -> DataFrame:
        """Bars of the store's period, or of a longer one that it divides."""
        if period in (None, self.period):
            return bars_of_state(self.state(), self.period, keys=self.keys)
        return bars_of_state(longer(self._parts(), period, source=self.period, keys=self.keys), period, keys=self.keys)

    def changed(self, batch: str) -> DataFrame:
        """The bars that a batch since the last ``compact`` made or changed, as they are now."""
        touched = self._parts(batch).select(F.col("bucket").alias("_b"), *(F.col(k).alias(f"_{k}") for k in self.keys))
        same = F.col("bucket") == F.col("_b")
        for key in self.keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
        parts = self._parts().join(touched, same, "left_semi")
        return bars_of_state(merge(parts, keys=self.keys), self.period, keys=self.keys)

    def compact(self) -> None:
        """Merge all states into one, in ranges of buckets, and start a new generation."""
        generation, names = self._generation(), self.batches()
        temporary = f"{self.path}/_gen"
        self.state().repartitionByRange("bucket", *self.keys).write.mode("overwrite").parquet(
            f"{temporary}/state/batch={_BASE}")
        self.spark.createDataFrame([(n,) for n in sorted(names)], "batch string").write.mode("overwrite").parquet(
            f"{temporary}/covered")
        moved(self.spark, temporary, self._folder(generation + 1))
        for n in range(generation + 1):
            discard(self.spark, self._folder(n))

    def writer(self, ticks: DataFrame, name: str) -> DataStreamWriter:
        """A stream's trades into the store, each micro-batch once, also after a restart; set its checkpoint and start it."""
        return ticks.writeStream.foreachBatch(lambda rows, number: self.append(rows, f"{name}-{number}"))
