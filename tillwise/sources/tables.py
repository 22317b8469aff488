"""Named tables: load with clean headers, replace, select, parameterised SQL, listing."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import DATASETS, DERIVED
from ..session import scratch_path
from .files import MULTI_LINE, read_csv
from .manifests import Manifests

#: Seconds after which rows that no version names count as left by a replace that failed.
ABANDONED = 86_400


def clean_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


class Tables:
    """Tables of a Spark catalog; their files live below `root` (the shared folder).

    Each replace writes a new version. A version stays for `retention` seconds after the next one took its place, so that
    whoever reads it finishes; the next replace after that removes it, also in another session on the same root.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, retention: float = 86_400) -> None:
        self.spark = spark
        self.root = (root or scratch_path(spark, "tables")).rstrip("/")
        self.retention = retention

    def _versions(self, name: str) -> Manifests:
        return Manifests(self.spark, f"{self.root}/{name}/versions")

    def replace(self, name: str, df: DataFrame) -> None:
        """Overwrite a table. The rows go to a new folder first, then a manifest with the next number names that folder, and
        the view of the table's name is switched in one step: there is always a table, also for a query on itself."""
        path = f"{self.root}/{name}/rows/{uuid.uuid4().hex}"
        df.write.parquet(path)
        versions = self._versions(name)
        number = max(versions.numbers(), default=0) + 1
        while not versions.commit(number, {"path": path}):  # somebody else replaced it meanwhile
            number += 1
        self._switch(name, path)
        self._expire(name)

    def _switch(self, name: str, path: str) -> None:
        self.spark.catalog.dropTempView(name)  # a view of that name would hide the table
        if self.spark.catalog.tableExists(name) and self.spark.catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE `{name}`")
        self.spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM parquet.`{path}`")

    def _expire(self, name: str) -> None:
        """Remove versions that were replaced longer ago than the retention, and rows of a replace that failed before."""
        versions = self._versions(name)
        numbers = versions.numbers()
        for number, following in zip(numbers, numbers[1:], strict=False):
            if versions.age(following) >= self.retention:
                versions.remove(versions.read(number)["path"])
                versions.forget(number)
        named = {versions.read(n)["path"].rsplit("/", 1)[-1] for n in versions.numbers()}
        for folder, age in versions.folders(f"{self.root}/{name}/rows"):
            if folder.rsplit("/", 1)[-1] not in named and age >= max(self.retention, ABANDONED):
                versions.remove(folder)

    def version(self, name: str) -> int:
        """The number of the newest version; 0 without one."""
        return max(self._versions(name).numbers(), default=0)

    def open(self) -> list[str]:
        """Give every table below the root its name, in a session that did not write them."""
        top = Manifests(self.spark, self.root)
        found = [folder.rsplit("/", 1)[-1] for folder, _ in top.folders(self.root)]
        named = [(name, self._versions(name).newest()) for name in found]
        for name, newest in named:
            if newest is not None:
                self._switch(name, newest[1]["path"])
        return sorted(name for name, newest in named if newest is not None)

    def attach(self, name: str, path: str) -> None:
        """Name parquet files that something else wrote, and owns."""
        self.spark.catalog.dropTempView(name)
        self.spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM parquet.`{path}`")

    def load_csv(self, name: str, path: str, schema: StructType | None = None) -> None:
        """One CSV file as a table with cleaned column names, typed as declared for the name or by schema."""
        schema = schema or DATASETS.get(name) or DERIVED.get(name)
        self.replace(name, with_clean_names(read_csv(self.spark, path, schema, multi_line=name in MULTI_LINE)))

    def load_all(self, frames: Mapping[str, DataFrame]) -> None:
        for name, df in frames.items():
            self.replace(name, with_clean_names(df))

    def query(self, sql: str, params: Sequence[Any] | Mapping[str, Any] | None = None) -> DataFrame:
        """Any SQL with bound parameters (`?` or `:name`); errors are raised."""
        if params is None:
            return self.spark.sql(sql)
        return self.spark.sql(sql, args=dict(params) if isinstance(params, Mapping) else list(params))

    def get(
        self,
        name: str,
        columns: str = "*",
        where: str | None = None,
        order_by: str | None = None,
        limit: int | None = None,
    ) -> DataFrame:
        """Columns, filter, order and limit on one table; the texts are SQL, read by Spark's parser."""
        sql = f"SELECT {columns} FROM `{name}`"
        sql += f" WHERE {where}" if where else ""
        sql += f" ORDER BY {order_by}" if order_by else ""
        return self.spark.sql(sql + (f" LIMIT {int(limit)}" if limit is not None else ""))

    def names(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables() if not t.isTemporary)

    # the derived tables under their usual names

    def daily_revenue(self, start: str | None = None, end: str | None = None) -> DataFrame:
        df = self.spark.table("daily_revenue")
        if start:
            df = df.where(F.col("date") >= F.lit(start).cast("date"))
        if end:
            df = df.where(F.col("date") <= F.lit(end).cast("date"))
        return df

    def anomalies(self, only_anomalies: bool = True) -> DataFrame:
        return self.get("anomaly_detection", where="is_anomaly" if only_anomalies else None)

    def rfm_segments(self) -> DataFrame:
        return self.get("rfm_segments")

    def forecast(self, days: int = 30) -> DataFrame:
        return self.get("revenue_forecast", order_by="date", limit=days)

    def cohort_retention(self) -> DataFrame:
        return self.get("cohort_retention")

    def churn(self) -> DataFrame:
        return self.get("churn_predictions")

    def customer_detail(self, customer_id) -> DataFrame:
        return self.query("SELECT * FROM master_dataset WHERE customer_id = ?", [customer_id])

    def review_sentiment(self) -> DataFrame:
        return (
            self.spark.table("reviews")
            .where("review_score IS NOT NULL")
            .withColumn("sentiment_score", (F.col("review_score") - 3) / F.lit(2.0))
        )
