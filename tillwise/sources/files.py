"""CSV and parquet sources and sinks of the named datasets."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import DATASETS

log = logging.getLogger(__name__)

# How the files of the named datasets end.
FILE_PATTERNS = {
    "orders": "*orders_dataset.csv",
    "customers": "*customers_dataset.csv",
    "order_items": "*order_items_dataset.csv",
    "payments": "*order_payments_dataset.csv",
    "reviews": "*order_reviews_dataset.csv",
    "products": "*products_dataset.csv",
    "sellers": "*sellers_dataset.csv",
    "geolocation": "*geolocation_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
    "daily_revenue": "daily_revenue_summary.csv",
}
# Free-text comments may hold line breaks inside quotes. Such a file is one task; large
# review tables belong in parquet.
MULTI_LINE = {"reviews"}
CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    keep_corrupt: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. Columns are matched by name, so files may omit some or reorder.

    The header decides which declared columns are read; unknown columns stay text.
    """
    header = spark.read.option("header", True).csv(path).columns
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    if schema is None:
        return reader.csv(path)
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    ddl = [f"`{name}` {declared.get(name, 'string')}" for name in header]
    if keep_corrupt:
        ddl.append(f"{CORRUPT} string")
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(", ".join(ddl)).csv(path)


def load_all(
    spark: SparkSession, folder: str, patterns: Mapping[str, str] = FILE_PATTERNS
) -> dict[str, DataFrame]:
    """All named datasets found in a folder; missing or unreadable ones are logged and skipped."""
    found: dict[str, DataFrame] = {}
    for name, pattern in patterns.items():
        try:
            df = read_csv(
                spark, f"{folder}/{pattern}", DATASETS.get(name), multi_line=name in MULTI_LINE
            )
            if df.isEmpty():
                raise ValueError(f"{name} is empty")
            found[name] = df
        except (AnalysisException, ValueError) as error:
            log.warning("skipped %s: %s", name, str(error).splitlines()[0])
    return found


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), only_partitions: bool = False
) -> None:
    """Parquet, optionally partitioned (rows of a partition value are gathered first, and
    adaptive rebalancing splits large ones). With only_partitions the partitions that df has rows of are
    replaced, and the others stay."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    mode = "dynamic" if only_partitions else "static"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Table bucketed and sorted by a join key: later joins on it need no shuffle. Each bucket is one file."""
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
