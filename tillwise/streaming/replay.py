"""Recorded events delivered slice by slice, as they arrive in a live feed: out of order, late, some too late."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .events import read_event_files
from .sinks import Sink, run_available

MINUTE = 60_000_000


class Replay:
    """Slices of recorded events. A stream is stopped after every slice and goes on from its own checkpoint.

    The rows are written once, by slice. Delivering a slice moves its files into the folder that the stream watches, so
    every slice is one micro-batch and its files, of bounded size, are read in parallel.
    """

    def __init__(self, events: DataFrame, slices: int = 4, late: bool = False, twice: bool = False, closing: bool = False):
        """late: one event in 97 comes two slices late and one in 89 four; else all come up to six minutes late.
        twice: of one event in three a copy comes one slice later, of one in eleven four slices later.
        closing: a last slice holds one row without an id, far enough ahead that every window closes."""
        self.spark, self.slices = events.sparkSession, slices
        at = F.unix_micros(F.col("ts").cast("timestamp"))
        span = events.agg(F.min(at), F.max(at)).first()
        self.low, self.high = (span[0] or 0), (span[1] or 0)
        self.width = (self.high - self.low + 1) // slices + 1

        def number(lateness: Column) -> Column:
            slot = F.floor((at + lateness - F.lit(self.low)) / F.lit(self.width)).cast("int")
            return F.least(slot, F.lit(slices - 1))

        minutes = F.col("event_id") % 7 * F.lit(MINUTE)
        lateness = F.when(F.lit(late) & (F.col("event_id") % 97 == 0), F.lit(2 * self.width)).when(
            F.lit(late) & (F.col("event_id") % 89 == 0), F.lit(4 * self.width)
        ).otherwise(minutes)
        placed = events.withColumn("_slice", number(lateness))
        if twice:
            again = F.when(F.col("event_id") % 11 == 0, 4).when(F.col("event_id") % 3 == 0, 1)
            copies = placed.where(again.isNotNull()).withColumn("_slice", F.least(F.col("_slice") + again, F.lit(slices - 1)))
            placed = placed.unionByName(copies)
        if closing:
            end = F.timestamp_micros(F.lit(self.high + slices * self.width)).cast(events.schema["ts"].dataType)
            row = self.spark.range(1).select(
                *(end.alias(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields),
                F.lit(slices).alias("_slice"),
            )
            placed, self.slices = placed.unionByName(row), slices + 1
        self.schema = events.schema
        self.path = scratch_path(self.spark, "replay")
        placed.hint("rebalance", "_slice").write.partitionBy("_slice").parquet(f"{self.path}/waiting")

    @property
    def delay(self) -> str:
        """A watermark delay of two and a half slices."""
        return f"{self.width * 5 // 2 // 1000} milliseconds"

    def _deliver(self, number: int) -> bool:
        paths = self.spark._jvm.org.apache.hadoop.fs
        source = paths.Path(f"{self.path}/waiting/_slice={number}")
        store = source.getFileSystem(self.spark._jsc.hadoopConfiguration())
        store.mkdirs(paths.Path(f"{self.path}/feed"))
        return store.exists(source) and store.rename(source, paths.Path(f"{self.path}/feed/{number:05d}"))

    def run(
        self, build: Callable[[DataFrame], DataFrame], label: str, mode: str = "append", handler: Sink | None = None
    ) -> DataFrame | None:
        """Deliver all slices to the stream that build makes of the feed; without a handler, the rows it put out.

        Each replay runs once. The stream is started anew for every slice, with the same checkpoint.
        """
        base, out, stream = scratch_path(self.spark, label), None, None
        for number in range(self.slices):
            if self._deliver(number) or number == self.slices - 1:
                feed = read_event_files(self.spark, f"{self.path}/feed/*", self.schema, max_files=None)
                stream = build(feed)
                out = run_available(stream, label, mode, handler, base)
        return None if out is None else self.spark.read.schema(stream.schema).parquet(out)
