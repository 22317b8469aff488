"""Monthly cohorts: retention, revenue, lifetime value, summary, wide shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_of, months_apart
from ..functions.rounding import ratio, round_half_up, share_pct
from .facts import item_value_per_order, order_facts, order_value


def cohort_activity(tables, grain: str = "order") -> DataFrame:
    """Customers and order value per (cohort month, months since), all statuses.

    Orders are folded to one row per customer and month before the customer's first
    month is looked up, so no customer brings more rows than there are months.
    """
    if grain == "rows":
        facts = order_facts(tables)
        value = F.col("total_order_value") * F.col("row_multiplicity")
    else:
        facts = tables.orders.select("order_id", "customer_id", "order_purchase_timestamp").join(
            item_value_per_order(tables.order_items), "order_id", "left"
        )
        value = order_value()
    months = facts.groupBy(
        "customer_id", month_of(F.col("order_purchase_timestamp")).alias("order_month")
    ).agg(F.sum(value).alias("value"))
    first = F.min("order_month").over(Window.partitionBy("customer_id"))
    return (
        months.withColumn("cohort_month", first)
        .withColumn("period", months_apart(F.col("order_month"), F.col("cohort_month")))
        .groupBy("cohort_month", "period")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("value").alias("revenue"))
    )


def cohort_retention(activity: DataFrame) -> DataFrame:
    """Long form: share of the cohort active in each period, in percent."""
    own = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("period") == 0, F.col("customers"))).over(own)
    return activity.withColumn("cohort_size", size).select(
        "cohort_month",
        "period",
        "cohort_size",
        "customers",
        round_half_up(share_pct(F.col("customers"), F.col("cohort_size")), 1).alias("retention"),
        F.col("revenue").cast("double").alias("revenue"),
    )


def cohort_ltv(activity: DataFrame, periods: int = 12) -> DataFrame:
    """Long form: revenue accumulated over the cohort's own periods / cohort size."""
    own = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("period") == 0, F.col("customers"))).over(own)
    running = own.orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return (
        activity.withColumn("cohort_size", size)
        .where(F.col("period") < periods)
        .withColumn("_sum", F.sum("revenue").over(running))
        .select(
            "cohort_month",
            "period",
            round_half_up(ratio(F.col("_sum"), F.col("cohort_size")), 2).alias("ltv"),
        )
    )


def to_matrix(long: DataFrame, value: str, periods: Sequence[int], name: str = "{}") -> DataFrame:
    """One row per cohort, one column per period; a missing period stays NULL."""
    wide = long.groupBy("cohort_month").pivot("period", list(periods)).agg(F.first(value))
    return wide.select(
        "cohort_month", *[F.col(f"`{p}`").alias(name.format(p)) for p in periods]
    )


def heatmap(long: DataFrame, periods: int = 13) -> DataFrame:
    wide = to_matrix(long, "retention", range(periods), "Month {}")
    return wide.withColumn("cohort_month", F.date_format("cohort_month", "yyyy-MM"))


def summary(long: DataFrame) -> DataFrame:
    """Headline retention numbers; `long` has one row per cohort and period."""

    def mean_at(period: int) -> Column:
        rate = F.when(F.col("period") == period, F.col("retention"))
        tenths = F.sum(F.round(rate * 10).cast("bigint"))
        return F.coalesce(round_half_up(ratio(tenths, F.count(rate) * 10), 1), F.lit(0.0))

    def cohort_at(direction: int) -> Column:
        rate = F.when(F.col("period") == 1, F.col("retention"))
        best = F.max(
            F.when(
                rate.isNotNull(),
                F.struct(
                    (rate * direction).alias("rate"),
                    (-F.unix_date("cohort_month")).alias("earliest"),
                    F.date_format("cohort_month", "yyyy-MM").alias("name"),
                ),
            )
        )
        return F.coalesce(best["name"], F.lit("N/A"))

    size = F.when(F.col("period") == 0, F.col("customers"))
    return long.agg(
        F.countDistinct("cohort_month").alias("total_cohorts"),
        mean_at(1).alias("avg_m1_retention_pct"),
        mean_at(3).alias("avg_m3_retention_pct"),
        mean_at(6).alias("avg_m6_retention_pct"),
        cohort_at(1).alias("best_cohort_m1"),
        cohort_at(-1).alias("worst_cohort_m1"),
        round_half_up(ratio(F.sum(size), F.count(size)), 0).alias("avg_cohort_size"),
        F.sum(size).alias("total_customers"),
    )
