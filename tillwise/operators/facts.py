"""Order-grain facts, the master dataset and the revenue rollups.

Items, payments and reviews are rolled up to one row per order before they meet, so no
join multiplies rows and a hot order is folded by the map-side aggregation. Where the
fan-out of payments x reviews is wanted, it enters as the weight `row_multiplicity`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import day_of, instant, month_of, order_calendar, whole_days
from ..functions.rounding import ratio


def item_value_per_order(items: DataFrame) -> DataFrame:
    """Price + freight per order, without the distinct count of the full rollup."""
    return items.groupBy("order_id").agg(
        F.sum("price").alias("revenue"), F.sum("freight_value").alias("freight")
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_payments"), F.sum("payment_value").alias("paid")
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count("review_score").alias("n_scores"),
        F.sum("review_score").alias("score_sum"),
    )


def order_value() -> Column:
    zero = F.lit(0).cast("decimal(12,2)")
    return F.coalesce("revenue", zero) + F.coalesce("freight", zero)


def order_facts(tables) -> DataFrame:
    """One row per order: value, payment and review rollups, fan-out weight.

    All inputs are hash-partitioned on order_id, so each table is shuffled once.
    """
    facts = (
        tables.orders.join(item_value_per_order(tables.order_items), "order_id", "left")
        .join(payments_per_order(tables.payments), "order_id", "left")
        .join(reviews_per_order(tables.reviews), "order_id", "left")
    )
    return facts.withColumns(
        {
            "total_order_value": order_value(),
            "row_multiplicity": F.greatest(F.coalesce("n_payments", F.lit(0)), F.lit(1))
            * F.greatest(F.coalesce("n_reviews", F.lit(0)), F.lit(1)),
        }
    )


def master_dataset(tables, grain: str = "rows") -> DataFrame:
    """Denormalised order fact table.

    grain="rows": one row per order x payment x review (left joins).
    grain="order": payments and reviews folded to one row per order.
    """
    # all joins on order_id share one partitioning; customers come last
    base = tables.orders_with_items()
    if grain == "rows":
        wide = base.join(
            tables.payments.select(
                "order_id", "payment_type", "payment_installments", "payment_value"
            ),
            "order_id",
            "left",
        ).join(tables.reviews.select("order_id", "review_score"), "order_id", "left")
    elif grain == "order":
        wide = base.join(payments_per_order(tables.payments), "order_id", "left").join(
            reviews_per_order(tables.reviews), "order_id", "left"
        )
    else:
        raise ValueError(f"unknown grain {grain!r}")
    bought = F.col("order_purchase_timestamp")
    return wide.join(tables.customers, "customer_id", "left").withColumns(
        {
            **order_calendar(bought),
            "total_order_value": order_value(),
            "delivery_days": whole_days(F.col("order_delivered_customer_date"), bought),
        }
    )


def _orders_with(tables, statuses: Sequence[str] | None, start=None, end=None) -> DataFrame:
    """Orders of some statuses and (inclusive) days; both filters reach the scan."""
    orders = tables.orders if statuses is None else tables.orders_in(*statuses)
    bought = F.col("order_purchase_timestamp")
    if start is not None:
        orders = orders.where(bought >= instant(start))
    if end is not None:
        orders = orders.where(bought < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return orders


def daily_revenue(
    tables, statuses: Sequence[str] | None = ("delivered",), start=None, end=None
) -> DataFrame:
    """Daily series: distinct orders, revenue, mean per payment row and per order, customers."""
    orders = _orders_with(tables, statuses, start, end)
    paid = orders.select("order_id", "customer_id", "order_purchase_timestamp").join(
        payments_per_order(tables.payments), "order_id"
    )
    return (
        paid.groupBy(day_of(F.col("order_purchase_timestamp")).alias("date"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("paid").alias("total_revenue"),
            F.sum("n_payments").alias("_rows"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .select(
            "date",
            "total_orders",
            "total_revenue",
            ratio(F.col("total_revenue"), F.col("_rows")).alias("avg_order_value"),
            ratio(F.col("total_revenue"), F.col("total_orders")).alias("avg_per_order"),
            "unique_customers",
        )
    )


def daily_series(
    tables, statuses: Sequence[str] | None = ("delivered",), start=None, end=None
) -> DataFrame:
    """The three measures the models use, without the distinct customer count."""
    orders = _orders_with(tables, statuses, start, end)
    paid = orders.select("order_id", "order_purchase_timestamp").join(
        payments_per_order(tables.payments), "order_id"
    )
    return (
        paid.groupBy(day_of(F.col("order_purchase_timestamp")).alias("date"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("paid").alias("_paid"),
            F.sum("n_payments").alias("_rows"),
        )
        .select(
            "date",
            F.col("_paid").cast("double").alias("total_revenue"),
            "total_orders",
            ratio(F.col("_paid"), F.col("_rows")).alias("avg_order_value"),
        )
    )


def between_dates(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Inclusive range on a date column; a missing bound does not filter."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def _item_months(tables) -> DataFrame:
    bought = tables.orders.select("order_id", "order_purchase_timestamp")
    return (
        tables.order_items.select("order_id", "product_id", "price")
        .join(tables.products.select("product_id", "product_category_name"), "product_id")
        .join(bought, "order_id")
    )


def category_month_revenue(tables) -> DataFrame:
    """Item revenue and distinct orders per category and month, all statuses."""
    return (
        _item_months(tables)
        .groupBy(
            "product_category_name",
            month_of(F.col("order_purchase_timestamp")).alias("month_year"),
        )
        .agg(F.sum("price").alias("revenue"), F.countDistinct("order_id").alias("orders"))
    )


def top_categories(tables, column: str, n: int) -> DataFrame:
    """Item revenue and distinct orders per product attribute, largest first."""
    return (
        tables.order_items.select("order_id", "product_id", "price")
        .join(tables.products.select("product_id", column), "product_id")
        .where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("category"))
        .agg(F.sum("price").alias("revenue"), F.countDistinct("order_id").alias("orders"))
        .orderBy(F.desc("revenue"), "category")
        .limit(n)
    )


def category_revenue_top(tables, n: int = 20) -> DataFrame:
    return top_categories(tables, "product_category_name", n)


def top_products(tables, n: int = 10) -> DataFrame:
    return (
        tables.order_items.groupBy("product_id")
        .agg(F.sum("price").alias("revenue"), F.count("order_id").alias("orders"))
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
    )


def state_revenue(tables, grain: str = "order") -> DataFrame:
    """Order value and distinct customers per state, with the log scale used for maps.

    Orders are folded per customer before the customers are joined, so a busy customer
    is one row there.
    """
    if grain == "rows":
        facts = order_facts(tables)
        value = F.col("total_order_value") * F.col("row_multiplicity")
    else:
        facts = tables.orders.select("order_id", "customer_id").join(
            item_value_per_order(tables.order_items), "order_id", "left"
        )
        value = order_value()
    return (
        facts.groupBy("customer_id")
        .agg(F.sum(value).alias("_value"))
        .join(tables.customers.select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(F.sum("_value").alias("revenue"), F.count("customer_id").alias("customers"))
        .withColumn("log_revenue", F.log1p(F.col("revenue").cast("double")))
        .orderBy(F.desc("revenue"), "state")
    )


def payment_mix(payments: DataFrame) -> DataFrame:
    """Rows and value per payment type, and the share of rows."""
    mix = payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("count"), F.sum("payment_value").alias("total_value")
    )
    everything = Window.partitionBy()  # one row per payment type reaches this window
    return mix.withColumn(
        "count_share_pct",
        ratio(F.col("count"), F.sum("count").over(everything)) * 100.0,
    ).orderBy(F.desc("total_value"), "payment_type")


def customer_orders(tables, customer_id) -> DataFrame:
    """Master rows of one customer: the customer's orders thin out every table before it is folded."""
    return master_dataset(tables.of_customer(customer_id))
