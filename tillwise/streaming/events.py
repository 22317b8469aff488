"""Transaction events: parsing, file and Kafka sources, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import EVENT, MONEY


def parse_events(raw: DataFrame, value: str | Column = "value") -> DataFrame:
    """JSON text -> typed events; `ts` is the event time of the ISO string."""
    text = F.col(value) if isinstance(value, str) else value
    return (
        raw.select(F.from_json(text.cast("string"), EVENT).alias("_e"))
        .select("_e.*")
        .withColumns(
            {
                "ts": F.try_to_timestamp("timestamp"),
                "revenue": F.col("revenue").cast(MONEY),
            }
        )
    )


def to_json_events(events: DataFrame) -> DataFrame:
    """Typed rows -> (key, value) JSON messages."""
    return events.select(
        F.col("customer_id").cast("string").alias("key"),
        F.to_json(F.struct(*events.columns)).alias("value"),
    )


def read_event_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
    max_files: int | None = 100, max_bytes: str | None = None,
) -> DataFrame:
    """Replay of recorded events; `max_files`, or else `max_bytes`, bounds the size of a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def kafka_options(servers: str, topic: str, group: str | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
    }
    if group is not None:
        options["kafka.group.id"] = group
    return options


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = "ecommerce-orders",
    group: str | None = None,
    max_offsets: int = 5_000_000,
) -> DataFrame:
    """Events of a topic from now on; needs the Kafka package on the cluster."""
    reader = spark.readStream.format("kafka").option("maxOffsetsPerTrigger", max_offsets)
    return parse_events(reader.options(**kafka_options(servers, topic, group)).load())


def write_kafka(events: DataFrame, servers: str, checkpoint: str, topic: str = "ecommerce-orders"):
    """Writer of events as JSON messages; call `.start()` on the result."""
    return (
        to_json_events(events)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def deduplicated(events: DataFrame, delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """First arrival of each event id, also across micro-batches and restarts. Events behind the watermark are left out, and
    their ids are forgotten a delay later, so that a copy either meets its id or is late itself. Without a time no event counts."""
    return events.where(F.col(ts).isNotNull()).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["event_id"])
