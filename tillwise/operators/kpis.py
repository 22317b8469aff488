"""Headline numbers, period comparisons, scenarios and text insights."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_of
from ..functions.rounding import ratio, round_half_up


def one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Put several one-row results side by side without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def kpi_summary(daily: DataFrame, facts: DataFrame, rfm: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Revenue, orders, order value, lifetime value, repeat rate and flagged days.

    The repeat rate counts customers with more than one master row, so an order with
    two payments makes its customer a repeat customer, as the row count does.
    """
    money = daily.agg(
        F.sum("total_revenue").cast("double").alias("total_revenue"),
        F.avg("avg_order_value").alias("avg_order_value"),
    )
    orders = facts.agg(F.count("order_id").alias("total_orders"))
    repeat = (
        facts.groupBy("customer_id")
        .agg(F.sum("row_multiplicity").alias("_rows"))
        .agg(ratio(F.count_if(F.col("_rows") > 1), F.count(F.lit(1))).alias("_repeat"))
        .select((F.col("_repeat") * 100.0).alias("repeat_rate_pct"))
    )
    value = rfm.agg(
        (ratio(F.sum("monetary"), F.count("monetary"))
         * ratio(F.sum("frequency"), F.count("frequency"))).alias("avg_ltv"),
        F.countDistinct("segment").alias("segments"),
    )
    flagged = anomalies.agg(F.count_if(F.col("is_anomaly")).alias("anomalies"))
    return one_row([money, orders, repeat, value, flagged])


def monthly_churn_rate(tables) -> DataFrame:
    """Falling master rows from month to month as a share of the month's customers."""
    from .facts import payments_per_order, reviews_per_order

    rows = F.greatest(F.coalesce("n_payments", F.lit(0)), F.lit(1)) * F.greatest(
        F.coalesce("n_reviews", F.lit(0)), F.lit(1)
    )
    monthly = (
        tables.orders.select("order_id", "customer_id", "order_purchase_timestamp")
        .join(payments_per_order(tables.payments), "order_id", "left")
        .join(reviews_per_order(tables.reviews), "order_id", "left")
        .groupBy(month_of(F.col("order_purchase_timestamp")).alias("month"))
        .agg(F.countDistinct("customer_id").alias("customers"), F.sum(rows).alias("orders"))
    )
    lost = F.greatest(F.lag("orders").over(Window.orderBy("month")) - F.col("orders"), F.lit(0))
    rate = ratio(lost, F.greatest(F.col("customers"), F.lit(1))) * 100.0
    return monthly.select(
        F.date_format("month", "yyyy-MM").alias("month"),
        "customers",
        "orders",
        F.when(F.lag("orders").over(Window.orderBy("month")).isNull(), 0.0)
        .otherwise(F.least(rate, F.lit(100.0)))
        .alias("churn_rate"),
    )


def period_comparison(daily: DataFrame, days: int = 30) -> DataFrame:
    """Mean revenue of the last rows against the rows before them (or the first rows)."""
    newest = F.row_number().over(Window.orderBy(F.desc("date")))
    oldest = F.row_number().over(Window.orderBy("date"))
    placed = daily.select(
        F.col("total_revenue").cast("decimal(22,2)").alias("_rev"),
        newest.alias("_new"),
        oldest.alias("_old"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"),
    )
    recent = F.col("_new") <= days
    previous = F.when(
        F.col("_n") > 2 * days, (F.col("_new") > days) & (F.col("_new") <= 2 * days)
    ).otherwise(F.col("_old") <= days)

    def mean(condition: Column) -> Column:
        kept = F.when(condition, F.col("_rev"))
        return ratio(F.sum(kept), F.count(kept))

    both = placed.agg(mean(recent).alias("recent_avg"), mean(previous).alias("previous_avg"))
    change = F.when(
        F.col("previous_avg") > 0,
        ratio(F.col("recent_avg") - F.col("previous_avg"), F.col("previous_avg")) * 100.0,
    ).otherwise(0.0)
    return both.withColumn("pct_change", change)


def insights(daily: DataFrame, states: DataFrame, segments: DataFrame) -> DataFrame:
    """Three sentences: revenue trend, best state, largest segment.

    `states` has (state, revenue) and `segments` (segment, customer_count) rows.
    """
    trend = period_comparison(daily).select(
        F.lit(1).alias("position"),
        F.format_string(
            "Revenue is %s %.1f%% vs previous period",
            F.when(F.col("pct_change") > 0, "up").otherwise("down"),
            round_half_up(F.abs("pct_change"), 1),
        ).alias("insight"),
    )
    top = states.agg(
        F.max(F.struct("revenue", F.col("state").alias("name"))).alias("_top")
    ).select(
        F.lit(2).alias("position"),
        F.concat(F.lit("Top performing state: "), F.col("_top.name")).alias("insight"),
    )
    largest = segments.agg(F.max(F.struct("customer_count", "segment")).alias("_top")).select(
        F.lit(3).alias("position"),
        F.format_string(
            "Largest segment: %s (%d customers)",
            F.col("_top.segment"),
            F.col("_top.customer_count"),
        ).alias("insight"),
    )
    return trend.unionByName(top).unionByName(largest)


def what_if(daily: DataFrame, aov_changes: Sequence[int], volume_changes: Sequence[int]) -> DataFrame:
    """Projected revenue for each pair of percentage changes."""
    base = daily.agg(F.sum(F.col("total_revenue").cast("decimal(22,2)")).alias("_base"))
    grid = F.array(
        *[
            F.struct(F.lit(a).alias("aov_change_pct"), F.lit(v).alias("volume_change_pct"))
            for a in aov_changes
            for v in volume_changes
        ]
    )
    factor = lambda c: 1.0 + F.col(c) / F.lit(100.0)
    return (
        base.select(F.col("_base").cast("double").alias("base_revenue"), F.explode(grid).alias("_g"))
        .select("base_revenue", "_g.*")
        .withColumn(
            "projected_revenue",
            F.col("base_revenue") * factor("aov_change_pct") * factor("volume_change_pct"),
        )
        .withColumn("delta", F.col("projected_revenue") - F.col("base_revenue"))
    )
