"""Commerce views over the star-schema parquet tables.

Every view is a lazy DataFrame. Money is DECIMAL(12,2) so that sums do not depend on
the order in which partitions arrive; timestamps are read as UTC.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONEY
from ..session import apply_settings, scratch_path
from .files import write_bucketed
from .model import CommerceTables, in_months, item_sums

STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY)


class Commerce(CommerceTables):
    """The commerce tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = apply_settings(spark)
        self.folder = folder

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        places = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.raw("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_custkey").alias("customer_unique_id"),
                F.col("n_name").alias("customer_state"),
                F.col("r_name").alias("customer_city"),
                F.col("c_mktsegment").alias("customer_segment"),
            )
        )

    def _orders(self, stored: DataFrame, items: DataFrame | None = None, *sums: Column) -> DataFrame:
        """Orders, with the last shipment of their items and any other sums over these, in one fold."""
        status = F.col("o_orderstatus")
        *most, (_, last) = STATUS.items()
        named = F.when(status == most[0][0], most[0][1])
        for code, name in most[1:]:
            named = named.when(status == code, name)
        lines = self.raw("lineitem") if items is None else items
        shipped = (
            lines.select(*self._item_columns(), F.col("l_shipdate"))
            .groupBy("order_id")
            .agg(F.max("l_shipdate").alias("_last_ship"), *sums)
        )
        folded = [c for c in shipped.columns if c not in ("order_id", "_last_ship")]
        return (
            stored.withColumnRenamed("o_orderkey", "order_id")
            .join(shipped, "order_id", "left")
            .select(
                "order_id",
                F.col("o_custkey").alias("customer_id"),
                named.otherwise(last).alias("order_status"),
                # left without zone: a cast would keep time filters away from the scan
                F.col("o_orderdate").alias("order_purchase_timestamp"),
                F.when(status == "F", F.col("_last_ship")).alias("order_delivered_customer_date"),
                *folded,
            )
        )

    def orders_with_items(self) -> DataFrame:
        return self._orders(self.raw("orders"), None, *item_sums())

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders(self.raw("orders"))

    def orders_in(self, *statuses: str) -> DataFrame:
        """Orders of some statuses; the stored codes are filtered, so the scan can skip.

        Unknown and null codes count as the last status, here as in orders."""
        *most, (_, last) = STATUS.items()
        status = F.col("o_orderstatus")
        if last in statuses:
            others = [code for code, name in most if name not in statuses]
            wanted = status.isNull() | ~status.isin(*others)
        else:
            wanted = status.isin(*(code for code, name in most if name in statuses))
        return self._orders(self.raw("orders").where(wanted))

    def of_customer(self, customer_id) -> CommerceTables:
        return self._of(F.col("o_custkey") == F.lit(customer_id))

    def of_months(self, months: Sequence[tuple[int, int]]) -> CommerceTables:
        return self._of(in_months("o_orderdate", months))

    def _of(self, wanted: Column) -> CommerceTables:
        stored = self.raw("orders").where(wanted)
        ids = stored.select(F.col("o_orderkey").alias("order_id"))
        keys = ids.withColumnRenamed("order_id", "l_orderkey")
        items = self.raw("lineitem").join(keys, "l_orderkey", "left_semi")
        return self._narrowed(self._orders(stored, items), ids)

    def _item_columns(self) -> list[Column]:
        tax = F.col("l_tax").cast("decimal(4,2)")
        return [
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            _money("l_extendedprice").alias("price"),
            (_money("l_extendedprice") * tax).cast(MONEY).alias("freight_value"),
        ]

    @cached_property
    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(*self._item_columns())

    @cached_property
    def payments(self) -> DataFrame:
        total = _money("o_totalprice")
        first = (total * F.lit("0.6").cast("decimal(2,1)")).cast(MONEY)
        part = lambda n, value: F.struct(
            F.lit(n).alias("payment_sequential"), value.cast(MONEY).alias("payment_value")
        )
        parts = F.when(
            F.col("o_orderkey") % 10 == 0, F.array(part(1, first), part(2, total - first))
        ).otherwise(F.array(part(1, total)))
        return (
            self.raw("orders")
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_orderpriority").alias("payment_type"),
                (1 + F.col("o_orderkey") % 10).alias("payment_installments"),
                F.explode(parts).alias("_part"),
            )
            .select("order_id", "payment_type", "payment_installments", "_part.*")
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.col("p_brand").alias("product_brand"),
            F.col("p_name").alias("product_name"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        places = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        cents = F.floor(F.col("s_acctbal") + 1000.0)
        return (
            self.raw("supplier")
            .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("seller_id"),
                F.col("n_name").alias("seller_city"),
                F.col("r_name").alias("seller_state"),
                ((100 + cents % 401) / F.lit(100.0)).alias("seller_rating"),
            )
        )

    @cached_property
    def reviews(self) -> DataFrame:
        key = F.col("o_orderkey")
        return (
            self.raw("orders")
            .where(key % 5 != 0)
            .select(
                key.alias("review_id"),
                key.alias("order_id"),
                F.expr("1 + (o_orderkey div 5) % 5").cast("int").alias("review_score"),
                F.date_add(F.to_date("o_orderdate"), 10).alias("review_creation_date"),
            )
        )

    def texts(self, parts: int | None = None) -> DataFrame:
        """The documents; parts spreads them first, for a caller who knows that they lie in one row group."""
        documents = self.raw("documents")
        return documents if parts is None else documents.repartition(parts)

    @cached_property
    def review_texts(self) -> DataFrame:
        score = (
            F.when(F.col("toxic") == 1, 1)
            .when(F.col("quality") == 1, 5)
            .when(F.col("quality") == 0, 2)
        )
        day = (F.col("doc_id") % 366).cast("int")
        return (
            self.texts()
            .join(self.raw("labels"), "doc_id", "left")
            .select(
                F.col("doc_id").alias("review_id"),
                score.alias("review_score"),
                F.col("text").alias("review_comment_message"),
                F.date_add(F.lit("2024-01-01").cast("date"), day).alias("review_creation_date"),
            )
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("user_id").alias("customer_id"),
            F.col("event_type").alias("category"),
            _money("value").alias("revenue"),
            "props",
        )


class BucketedCommerce(Commerce):
    """The commerce tables over copies of orders and items that are bucketed and sorted by order.

    The copies are written once; every fold and join by order_id after that reads a bucket where it lies, without an
    exchange. The number of buckets should keep a bucket below the memory of a task: without a number, there are 16
    or more, one for each `bucket_bytes` of the stored orders and items, so a bucket stays the same size as they grow.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, bucket_bytes: int = 8 << 20) -> None:
        super().__init__(spark, folder)
        if buckets is None:
            stored = sum(self._stored_bytes(name) for name in ("orders", "lineitem"))
            buckets = max(16, -(-stored // bucket_bytes))
        self._copies = {}
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            table = f"by_order_{name}_{uuid.uuid4().hex}"
            write_bucketed(super().raw(name), table, key, buckets, scratch_path(spark, table))
            self._copies[name] = table

    def raw(self, table: str) -> DataFrame:
        return self.spark.table(self._copies[table]) if table in self._copies else super().raw(table)

    def _stored_bytes(self, table: str) -> int:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}.parquet")
        store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return int(store.getContentSummary(path).getLength())
