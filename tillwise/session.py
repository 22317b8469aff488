"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SCALE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even where a later aggregation then needs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # keyed state lives on disk, beyond the memory of an executor
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_scratch: str | None = None
#: Folders of the tables that materialize wrote, as long as somebody holds the table.
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job here relies on (UTC days, AQE, skew joins)."""
    for key, value in SCALE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tillwise") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named in spark.checkpoint.dir.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tillwise-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/tillwise/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage with data that outlives lost executors, and gives every reader
    of the result the same rows (needed after a sort that assigns positions).
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialize wrote, once everything that reads them is written itself."""
    for table in tables:
        spark, path = table.sparkSession, _written.pop(table, None)
        if path is not None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def packed(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """A written table in partitions of about so many rows: an iterative fit over few rows then pays for few tasks a job."""
    return df.coalesce(max(1, -(-df.count() // rows)))
