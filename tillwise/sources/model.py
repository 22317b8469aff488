"""The commerce tables as attributes, whatever they come from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_settings

TABLES = (
    "customers", "orders", "order_items", "payments", "products", "sellers", "reviews",
    "review_texts", "events",
)


def item_sums() -> list[Column]:
    return [
        F.count("order_item_id").alias("item_count"),
        F.sum("price").alias("revenue"),
        F.sum("freight_value").alias("freight"),
        F.countDistinct("product_id").alias("unique_products"),
    ]


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(*item_sums())


def in_months(column: str, months: Sequence[tuple[int, int]]) -> Column:
    """Whether a timestamp lies in one of the months; ranges, so that the filter reaches the scan."""
    starts = [f"{year:04d}-{month:02d}-01 00:00:00" for year, month in months]
    inside = [
        (F.col(column) >= F.lit(s).cast("timestamp_ntz"))
        & (F.col(column) < F.add_months(F.lit(s[:10]).cast("date"), 1).cast("timestamp_ntz"))
        for s in starts
    ]
    return reduce(Column.__or__, inside, F.lit(False))


class CommerceTables:
    """What the operators expect: one attribute per table.

    `frames` usually comes from `load_all`; the star-schema source derives its tables.
    """

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
        self.spark = apply_settings(spark)
        for name, df in frames.items():
            setattr(self, name, df)

    def orders_in(self, *statuses: str) -> DataFrame:
        return self.orders.where(F.col("order_status").isin(*statuses))

    def of_customer(self, customer_id) -> CommerceTables:
        """The tables with one customer's orders, and of the tables by order only their rows."""
        orders = self.orders.where(F.col("customer_id") == F.lit(customer_id))
        return self._narrowed(orders, orders.select("order_id"))

    def of_months(self, months: Sequence[tuple[int, int]]) -> CommerceTables:
        """The tables with the orders of some (year, month), and of the tables by order only their rows."""
        orders = self.orders.where(in_months("order_purchase_timestamp", months))
        return self._narrowed(orders, orders.select("order_id"))

    def orders_with_items(self) -> DataFrame:
        """Orders, with their items folded to one row per order."""
        return self.orders.join(items_per_order(self.order_items), "order_id", "left")

    def _narrowed(self, orders: DataFrame, ids: DataFrame) -> CommerceTables:
        frames = {name: getattr(self, name) for name in ("customers", "products", "sellers") if hasattr(self, name)}
        for name in ("order_items", "payments", "reviews"):
            frames[name] = getattr(self, name).join(ids, "order_id", "left_semi")
        return CommerceTables(self.spark, {**frames, "orders": orders})

    def register_views(self) -> None:
        """Expose the tables to spark.sql."""
        for name in TABLES:
            df = getattr(self, name, None)
            if df is not None:
                df.createOrReplaceTempView(name)
