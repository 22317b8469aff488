"""The newest state of every key of a stream in update mode, as a bucketed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.manifests import Manifests


class MergedTable:
    """Keyed rows in a fixed number of buckets. An epoch rewrites only the buckets that hold its keys.

    Each epoch writes new files of those buckets and then commits a manifest that names the folder of every bucket, so a
    reader opens one folder a bucket at most, however many epochs there were, and a failed epoch leaves nothing
    behind that is read. An epoch that comes again changes nothing. A table belongs to one stream. Files that the last
    `keep` manifests do not name are removed, so that readers of a recent state finish.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 16, keep: int = 2) -> None:
        self.spark, self.path, self.keys, self.buckets, self.keep = spark, path, list(keys), buckets, keep
        self.manifests = Manifests(spark, f"{path}/manifests")

    def merge(self, batch: DataFrame, epoch: int) -> None:
        """A handler for foreachBatch: of each key the row of this epoch replaces the one before."""
        newest = self.manifests.newest()
        if newest is not None and newest[0] >= epoch:
            return
        state = newest[1] if newest is not None else {"buckets": {}, "schema": None}
        placed = batch.withColumn("_bucket", F.pmod(F.hash(*self.keys), F.lit(self.buckets))).persist()
        try:
            # one number a bucket at most
            touched = sorted(r["_bucket"] for r in placed.select("_bucket").distinct().collect())
            if touched:
                old = [state["buckets"][str(b)] for b in touched if str(b) in state["buckets"]]
                rows = placed
                if old:
                    before = self.spark.read.schema(batch.schema).parquet(*old)
                    left = before.join(placed.select(*self.keys), self.keys, "left_anti")
                    rows = placed.unionByName(left.withColumn("_bucket", F.pmod(F.hash(*self.keys), F.lit(self.buckets))))
                target = f"{self.path}/epoch-{epoch:09d}"
                rows.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(target)
                folders = {**state["buckets"], **{str(b): f"{target}/_bucket={b}" for b in touched}}
            else:
                folders = state["buckets"]
            self.manifests.commit(epoch, {"buckets": folders, "schema": batch.schema.jsonValue()})
        finally:
            placed.unpersist()
        self._expire()

    def _expire(self) -> None:
        numbers = self.manifests.numbers()
        for number in numbers[: -self.keep]:
            named = {f for n in numbers if n > number for f in self.manifests.read(n)["buckets"].values()}
            for folder in self.manifests.read(number)["buckets"].values():
                if folder not in named:
                    self.manifests.remove(folder)
            self.manifests.forget(number)

    def folders(self) -> list[str]:
        """What a reader opens now: one folder a bucket at most."""
        newest = self.manifests.newest()
        return sorted(newest[1]["buckets"].values()) if newest is not None else []

    def read(self, schema=None) -> DataFrame:
        """The newest row of every key; schema is needed only where no epoch came."""
        from pyspark.sql.types import StructType

        newest = self.manifests.newest()
        if newest is not None:
            schema = StructType.fromJson(newest[1]["schema"])
        elif schema is None:
            raise ValueError("no epoch was merged, and no schema given")
        folders = self.folders()
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
