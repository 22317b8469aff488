"""Running streams to completion and delivering micro-batches to several sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import scratch_path

log = logging.getLogger(__name__)
Sink = Callable[[DataFrame, int], None]


def fan_out(sinks: Mapping[str, Sink], failures: str | None = None) -> Sink:
    """One foreachBatch handler for several sinks; a failing sink does not stop the others.

    The micro-batch is persisted so that it is computed once for all sinks. What a sink failed on is kept
    below `failures`, by sink and epoch, for `redeliver`; without that folder only the log tells of it.
    """

    def deliver(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for name, sink in sinks.items():
                try:
                    sink(batch, epoch)
                except Exception:  # noqa: BLE001 - other sinks must still be served
                    log.exception("sink %s failed in epoch %s", name, epoch)
                    if failures is not None:
                        parquet_sink(f"{failures}/{name}")(batch, epoch)
        finally:
            batch.unpersist()

    return deliver


def failed_epochs(spark: SparkSession, failures: str, name: str) -> list[int]:
    """Epochs that a sink still has to get."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{failures}/{name}")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    return sorted(int(f.getPath().getName().split("=")[1]) for f in store.listStatus(folder))


def redeliver(spark: SparkSession, failures: str, name: str, sink: Sink) -> list[int]:
    """Give a sink the epochs it failed on; each is forgotten once it is delivered. Returns them."""
    done = failed_epochs(spark, failures, name)
    for epoch in done:
        path = f"{failures}/{name}/epoch={epoch}"
        sink(spark.read.parquet(path), epoch)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return done


def parquet_sink(path: str) -> Sink:
    """Epoch-stamped folders, so a repeated epoch overwrites itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def run_available(
    stream: DataFrame, label: str, mode: str = "append", handler: Sink | None = None,
    base: str | None = None,
) -> str | None:
    """Process everything that is there, then stop. Returns the output folder.

    Without a handler the rows go to a parquet folder below `base`. A later call with the same base goes on
    where this one stopped; without one each call starts anew below the shared folder.
    """
    spark = stream.sparkSession
    base = base or scratch_path(spark, label)
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
    )
    if handler is None:
        query = writer.format("parquet").option("path", f"{base}/rows").start()
    else:
        query = writer.foreachBatch(handler).start()
    query.awaitTermination()
    return f"{base}/rows" if handler is None else None


def read_output(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
