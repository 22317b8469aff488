"""Relational databases through JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

DRIVERS = {"postgresql": "org.postgresql.Driver", "sqlite": "org.sqlite.JDBC"}


def jdbc_options(uri: str) -> dict[str, str]:
    """JDBC url, driver and credentials from `postgresql://user:pw@host:port/db` or
    `sqlite:///path`."""
    parts = urlsplit(uri)
    kind = parts.scheme.split("+")[0]
    if kind == "sqlite":
        return {"url": f"jdbc:sqlite:{parts.path[1:]}", "driver": DRIVERS["sqlite"]}
    if kind not in DRIVERS:
        raise ValueError(f"unsupported database {kind!r}")
    place = parts.hostname + (f":{parts.port}" if parts.port else "")
    options = {"url": f"jdbc:{kind}://{place}{parts.path}", "driver": DRIVERS[kind]}
    if parts.username:
        options["user"] = parts.username
    if parts.password:
        options["password"] = parts.password
    return options


def read_table(
    spark: SparkSession,
    uri: str,
    table: str,
    split: tuple[str, int | str, int | str, int] | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """One table. split=(column, lowest, highest, parts) reads it in parallel ranges;
    without it a single task reads everything, which suits small tables only."""
    reader = spark.read.format("jdbc").options(**jdbc_options(uri)).option("dbtable", table)
    reader = reader.option("fetchsize", fetch_rows)
    if split is not None:
        column, low, high, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=parts
        )
    return reader.load()


def write_table(
    df: DataFrame, uri: str, table: str, connections: int = 16, batch_rows: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> None:
    """Replace a table; `connections` bounds the number of open database sessions."""
    # coalesce would squeeze the work before the write as well
    (
        df.repartition(connections)
        .write.format("jdbc")
        .options(**jdbc_options(uri), **(extra or {}))
        .option("dbtable", table)
        .option("batchsize", batch_rows)
        .mode("overwrite")
        .save()
    )
