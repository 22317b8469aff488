"""The ten revenue reports.

Each takes the commerce tables and returns a lazy DataFrame. `digits` follows the
report's own rounding. Windows without a partition run only over days, payment types
x months, states or segments: sets that do not grow with the number of orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import day_of, instant, month_of, months_apart, week_of, whole_days
from ..functions.rounding import ratio, round_half_up, share_pct
from ..operators.facts import daily_revenue, payments_per_order, reviews_per_order
from ..operators.ordering import ranks_among, with_tiles
from ..session import materialize

BEFORE = Window.unboundedPreceding


def _dbl(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _mean_over(column: str, frame) -> Column:
    return ratio(F.sum(column).over(frame), F.count(column).over(frame))


def delivered(tables) -> DataFrame:
    return tables.orders_in("delivered")


def latest_purchase(tables):
    """The newest order timestamp; stands in for the wall clock."""
    return tables.orders.agg(F.max("order_purchase_timestamp")).first()[0]


def daily_revenue_moving_averages(tables) -> DataFrame:
    """Report 1: daily revenue with 7/30-day means, day and week change, running total."""
    days = daily_revenue(tables)
    by_day = Window.orderBy("date")
    rev = F.col("total_revenue")
    out = days.select(
        F.col("date").alias("order_date"),
        "total_orders",
        rev,
        "avg_order_value",
        "unique_customers",
        _mean_over("total_revenue", by_day.rowsBetween(-6, 0)).alias("_ma7"),
        _mean_over("total_revenue", by_day.rowsBetween(-29, 0)).alias("_ma30"),
        F.lag(rev).over(by_day).alias("_prev"),
        F.lag(rev, 7).over(by_day).alias("_week_ago"),
        F.sum(rev).over(by_day.rowsBetween(BEFORE, 0)).alias("_running"),
    )
    growth = lambda base: F.when(
        base > 0, ratio(rev - base, base) * 100.0
    )
    return out.select(
        "order_date",
        "total_orders",
        _dbl(rev).alias("total_revenue"),
        round_half_up(F.col("avg_order_value"), 2).alias("avg_order_value"),
        "unique_customers",
        round_half_up(F.col("_ma7"), 2).alias("ma_7d"),
        round_half_up(F.col("_ma30"), 2).alias("ma_30d"),
        _dbl(rev - F.col("_prev")).alias("daily_delta"),
        round_half_up(growth(F.col("_prev")), 2).alias("pct_change"),
        _dbl("_running").alias("cumulative_revenue"),
        round_half_up(growth(F.col("_week_ago")), 2).alias("wow_growth_pct"),
    ).orderBy("order_date")


def _customer_totals(tables) -> DataFrame:
    """Last purchase, orders and payments of every customer with a paid delivered order.

    Orders are folded per customer_id before the customers are joined.
    """
    return (
        delivered(tables)
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(payments_per_order(tables.payments), "order_id")
        .groupBy("customer_id")
        .agg(
            F.max("order_purchase_timestamp").alias("_last"),
            F.count(F.lit(1)).alias("_orders"),
            F.sum("paid").alias("_paid"),
        )
        .join(tables.customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.max("_last").alias("last_purchase"),
            F.sum("_orders").alias("frequency"),
            F.sum("_paid").alias("monetary"),
        )
    )


def rfm_by_tiles(tables, as_of=None) -> DataFrame:
    """Report 2: recency/frequency/monetary quintiles by NTILE, rolled up by segment."""
    as_of = as_of or latest_purchase(tables)
    raw = materialize(
        _customer_totals(tables).select(
            F.col("customer_unique_id").alias("customer_id"),
            whole_days(instant(as_of), F.col("last_purchase")).alias("recency"),
            "frequency",
            "monetary",
        ),
        "rfm-raw",
    )
    scored = with_tiles(
        raw,
        5,
        "customer_id",
        {"r_score": -F.col("recency"), "f_score": F.col("frequency")},
    )
    r, f = F.col("r_score"), F.col("f_score")
    segment = (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f < 3), "Potential Loyalist")
        .when((r <= 2) & (f >= 4), "At Risk")
        .when((r == 1) & (f <= 2), "Lost")
        .when((r >= 4) & (f == 1), "New Customers")
        .otherwise("Need Attention")
    )
    by_segment = scored.groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("recency").alias("_r"),
        F.sum("frequency").alias("_f"),
        F.sum("monetary").alias("_m"),
    )
    n, everything = F.col("customer_count"), Window.partitionBy()
    return by_segment.select(
        "segment",
        "customer_count",
        round_half_up(ratio(F.col("_r"), n), 0).alias("avg_recency_days"),
        round_half_up(ratio(F.col("_f"), n), 1).alias("avg_frequency"),
        round_half_up(ratio(F.col("_m"), n), 2).alias("avg_monetary"),
        _dbl("_m").alias("total_revenue"),
        round_half_up(share_pct(F.col("_m"), F.sum("_m").over(everything)), 1).alias(
            "revenue_share_pct"
        ),
    ).orderBy(F.desc("total_revenue"), "segment")


def _customer_months(tables, orders: DataFrame, *sums: str) -> DataFrame:
    """One row per (unique) customer and month with the customer's first month.

    Orders are folded to customer x month before the customers are joined, so neither the
    join nor the window per customer sees more than one row per calendar month and id.
    """
    month = month_of(F.col("order_purchase_timestamp")).alias("order_month")
    add_up = [F.sum(c).alias(c) for c in sums]
    months = (
        orders.groupBy("customer_id", month)
        .agg(F.count(F.lit(1)).alias("_orders"), *add_up)
        .join(tables.customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id", "order_month")
        .agg(F.sum("_orders").alias("_orders"), *add_up)
    )
    own = Window.partitionBy("customer_unique_id")
    return months.withColumn("cohort_month", F.min("order_month").over(own)).withColumn(
        "period", months_apart(F.col("order_month"), F.col("cohort_month"))
    )


def cohort_retention_report(tables, max_period: int = 12) -> DataFrame:
    """Report 3: customers of a first-month cohort that are active n months later."""
    active = _customer_months(
        tables, delivered(tables).select("customer_id", "order_purchase_timestamp")
    )
    counts = active.groupBy("cohort_month", "period").agg(F.count(F.lit(1)).alias("customers"))
    own = Window.partitionBy("cohort_month")
    sized = counts.withColumn(
        "cohort_size", F.max(F.when(F.col("period") == 0, F.col("customers"))).over(own)
    )
    return sized.where(F.col("period") <= max_period).select(
        "cohort_month",
        "cohort_size",
        "period",
        "customers",
        round_half_up(share_pct(F.col("customers"), F.col("cohort_size")), 1).alias(
            "retention_rate_pct"
        ),
    ).orderBy("cohort_month", "period")


def zscore_report(tables) -> DataFrame:
    """Report 4: days scored against the global mean and deviation."""
    orders = tables.orders_in("delivered", "shipped")
    days = (
        orders.select("order_id", "order_purchase_timestamp")
        .join(payments_per_order(tables.payments), "order_id")
        .groupBy(day_of(F.col("order_purchase_timestamp")).alias("dt"))
        .agg(F.sum("paid").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )
    all_days = Window.partitionBy()
    by_day = Window.orderBy("dt")
    mean = _mean_over("revenue", all_days)
    deviation = F.stddev_samp(_dbl("revenue")).over(all_days)
    scored = days.select(
        "dt",
        "revenue",
        "orders",
        ratio(_dbl("revenue") - mean, F.nullif(deviation, F.lit(0.0))).alias("_z"),
        _mean_over("revenue", by_day.rowsBetween(-6, 0)).alias("_m7"),
        F.stddev_samp(_dbl("revenue")).over(by_day.rowsBetween(-6, 0)).alias("_s7"),
        F.lag("revenue").over(by_day).alias("_prev"),
    )
    z = F.col("_z")
    return scored.select(
        "dt",
        _dbl("revenue").alias("revenue"),
        "orders",
        round_half_up(z, 3).alias("z_score"),
        round_half_up(F.col("_m7"), 2).alias("roll_mean_7d"),
        F.when(F.abs(z) > 3.0, "CRITICAL")
        .when(F.abs(z) > 2.5, "HIGH")
        .when(F.abs(z) > 2.0, "MEDIUM")
        .otherwise("NORMAL")
        .alias("severity"),
        F.when(z > 2.0, "SPIKE").when(z < -2.0, "DROP").otherwise("NORMAL").alias("anomaly_type"),
        (F.abs(z) > 2.0).alias("is_anomaly"),
    ).orderBy("dt")


def category_weekly_drops(tables, n: int = 20) -> DataFrame:
    """Report 5: the worst week-over-week drops per category."""
    orders = tables.orders_in("delivered", "shipped")
    weekly = (
        tables.order_items.select("order_id", "product_id", "price")
        .join(tables.products.select("product_id", "product_category_name"), "product_id")
        .join(orders.select("order_id", "order_purchase_timestamp"), "order_id")
        .groupBy(
            "product_category_name", week_of(F.col("order_purchase_timestamp")).alias("week")
        )
        .agg(F.sum("price").alias("_now"), F.countDistinct("order_id").alias("orders"))
    )
    own = Window.partitionBy("product_category_name").orderBy("week")
    compared = weekly.withColumns(
        {"_last": F.lag("_now").over(own), "last_week_orders": F.lag("orders").over(own)}
    ).where(F.col("_last").isNotNull())
    delta = F.col("_now") - F.col("_last")
    return (
        compared.withColumn("_delta", delta)
        .orderBy("_delta", "product_category_name", "week")
        .limit(n)
        .select(
            "product_category_name",
            "week",
            _dbl("_now").alias("this_week_revenue"),
            _dbl("_last").alias("last_week_revenue"),
            _dbl("_delta").alias("revenue_delta"),
            F.when(
                F.col("_last") > 0,
                round_half_up(ratio(F.col("_delta"), F.col("_last")) * 100.0, 1),
            ).alias("pct_change"),
            F.col("orders").alias("this_week_orders"),
            "last_week_orders",
        )
    )


def cohort_lifetime_value(tables) -> DataFrame:
    """Report 6: cumulative payments per initial cohort member."""
    paid = (
        delivered(tables)
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(payments_per_order(tables.payments), "order_id")
    )
    months = _customer_months(tables, paid, "paid")
    monthly = months.groupBy("cohort_month", F.col("period").alias("months_since_first")).agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("paid").alias("_revenue")
    )
    own = Window.partitionBy("cohort_month")
    running = own.orderBy("months_since_first").rowsBetween(BEFORE, 0)
    start = F.when(F.col("months_since_first") == 0, F.col("active_customers"))
    return monthly.withColumn("cohort_size", F.max(start).over(own)).select(
        "cohort_month",
        "months_since_first",
        "cohort_size",
        "active_customers",
        _dbl("_revenue").alias("period_revenue"),
        round_half_up(ratio(F.sum("_revenue").over(running), F.col("cohort_size")), 2).alias(
            "cumulative_ltv"
        ),
    ).orderBy("cohort_month", "months_since_first")


def seller_metrics(tables) -> DataFrame:
    """Totals per seller. Several reviews on an order weigh its items, as a row join would.

    Items meet their orders once. One fold with two grouping sets gives a row per seller, order and month, whose
    number per month and seller counts orders and months, and a row per seller and product, whose number counts products.
    """
    scores = reviews_per_order(tables.reviews)
    weight = F.greatest(F.coalesce("n_reviews", F.lit(0)), F.lit(1))
    sold = (
        tables.order_items.select("order_id", "product_id", "seller_id", "price")
        .join(delivered(tables).select("order_id", "order_purchase_timestamp"), "order_id")
        .join(scores, "order_id", "left")
        .withColumn("_month", month_of(F.col("order_purchase_timestamp")))
    )
    by = {c: F.col(c) for c in ("seller_id", "order_id", "_month", "product_id")}
    sums = ("_revenue", "_rows", "_score_sum", "_scores")
    folded = sold.groupingSets(
        [[by["seller_id"], by["order_id"], by["_month"]], [by["seller_id"], by["product_id"]]], *by.values()
    ).agg(
        F.grouping("order_id").cast("boolean").alias("_is_product"),
        F.sum(F.col("price") * weight).alias("_revenue"),
        F.sum(weight).alias("_rows"),
        F.sum("score_sum").alias("_score_sum"),
        F.sum("n_scores").alias("_scores"),
    )
    product = F.col("_is_product")
    per_month = folded.groupBy("seller_id", "_is_product", "_month").agg(
        F.count(F.when(~product, F.lit(1))).alias("_orders"),
        F.count(F.when(product, F.col("product_id"))).alias("_products"),
        *[F.sum(F.when(~product, F.col(c))).alias(c) for c in sums],
    )
    totals = per_month.groupBy("seller_id").agg(
        F.sum("_orders").alias("total_orders"),
        F.count(F.when(~product, F.lit(1))).alias("active_months"),
        F.sum("_products").alias("unique_products"),
        *[F.sum(c).alias(c) for c in sums],
    )
    totals = totals.withColumnRenamed("_revenue", "total_revenue")
    return totals.join(tables.sellers, "seller_id").select(
        "seller_id",
        "seller_city",
        "seller_state",
        "seller_rating",
        "total_orders",
        "unique_products",
        _dbl("total_revenue").alias("total_revenue"),
        ratio(F.col("total_revenue"), F.col("_rows")).alias("avg_item_price"),
        ratio(F.col("_score_sum"), F.col("_scores")).alias("avg_review_score"),
        "active_months",
    )


def seller_performance(tables, n: int = 50) -> DataFrame:
    """Report 7: the n best sellers with their ranks among all sellers.

    Ranks come from counting the sellers ahead of each of the n values, not from a
    window over all sellers.
    """
    spark = tables.spark
    metrics = materialize(seller_metrics(tables), "sellers")
    top = metrics.orderBy(F.desc("total_revenue"), "seller_id").limit(n).collect()
    places = ranks_among(
        metrics,
        {
            "total_revenue": [row["total_revenue"] for row in top],
            "avg_review_score": [
                row["avg_review_score"] if row["avg_review_score"] is not None else 0.0
                for row in top
            ],
        },
    )
    rows = []
    for i, row in enumerate(top):
        revenue, review = places["total_revenue"][i], places["avg_review_score"][i]
        others = revenue["all"] - 1
        rows.append(
            (
                row["seller_id"],
                revenue["greater"] + 1,
                # descending order puts sellers without a review first
                1 if row["avg_review_score"] is None else review["nulls"] + review["greater"] + 1,
                revenue["smaller"] / others if others else 0.0,
            )
        )
    id_type = metrics.schema["seller_id"].dataType.simpleString()
    ranked = spark.createDataFrame(
        rows, f"seller_id {id_type}, revenue_rank bigint, review_rank bigint, _pct double"
    )
    # n rows, 50 in the report
    return metrics.join(F.broadcast(ranked), "seller_id").select(
        "seller_id",
        "seller_city",
        "seller_state",
        "seller_rating",
        "total_orders",
        "unique_products",
        "total_revenue",
        round_half_up(F.col("avg_item_price"), 2).alias("avg_item_price"),
        round_half_up(F.col("avg_review_score"), 2).alias("avg_review_score"),
        "active_months",
        "revenue_rank",
        "review_rank",
        round_half_up(F.col("_pct") * 100.0, 1).alias("revenue_percentile"),
    ).orderBy("revenue_rank", "seller_id")


def payment_running_totals(tables) -> DataFrame:
    """Report 8: payment types by month, running total and share of the month."""
    stats = (
        tables.payments.join(
            delivered(tables).select("order_id", "order_purchase_timestamp"), "order_id"
        )
        .groupBy("payment_type", month_of(F.col("order_purchase_timestamp")).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("payment_value").alias("_value"),
            F.sum("payment_installments").alias("_inst"),
        )
    )
    running = Window.partitionBy("payment_type").orderBy("month").rowsBetween(BEFORE, 0)
    of_month = Window.partitionBy("month")
    n = F.col("transaction_count")
    return stats.select(
        "payment_type",
        "month",
        "transaction_count",
        _dbl("_value").alias("monthly_revenue"),
        round_half_up(ratio(F.col("_value"), n), 2).alias("avg_order_value"),
        round_half_up(ratio(F.col("_inst"), n), 1).alias("avg_installments"),
        _dbl(F.sum("_value").over(running)).alias("cumulative_revenue"),
        round_half_up(share_pct(F.col("_value"), F.sum("_value").over(of_month)), 1).alias(
            "monthly_share_pct"
        ),
    ).orderBy("payment_type", "month")


def geographic_revenue(tables) -> DataFrame:
    """Report 9: revenue, reviews and share per customer state."""
    orders = (
        delivered(tables)
        .select("order_id", "customer_id")
        .join(payments_per_order(tables.payments), "order_id")
        .join(reviews_per_order(tables.reviews), "order_id", "left")
    )
    copies = F.greatest(F.coalesce("n_reviews", F.lit(0)), F.lit(1))
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_orders"),
        F.sum(F.col("paid") * copies).alias("_paid"),
        F.sum(F.col("n_payments") * copies).alias("_rows"),
        F.sum(F.col("score_sum") * F.col("n_payments")).alias("_score"),
        F.sum(F.col("n_scores") * F.col("n_payments")).alias("_scores"),
    )
    states = (
        per_customer.join(
            tables.customers.select("customer_id", "customer_unique_id", "customer_state"),
            "customer_id",
        )
        .groupBy("customer_state")
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.countDistinct("customer_unique_id").alias("unique_customers"),
            *[F.sum(c).alias(c) for c in ("_paid", "_rows", "_score", "_scores")],
        )
    )
    everything = Window.partitionBy()
    return states.select(
        "customer_state",
        "total_orders",
        "unique_customers",
        _dbl("_paid").alias("total_revenue"),
        round_half_up(ratio(F.col("_paid"), F.col("_rows")), 2).alias("avg_order_value"),
        round_half_up(ratio(F.col("_score"), F.col("_scores")), 2).alias("avg_review_score"),
        round_half_up(share_pct(F.col("_paid"), F.sum("_paid").over(everything)), 2).alias(
            "revenue_share_pct"
        ),
        round_half_up(ratio(F.col("total_orders"), F.col("unique_customers")), 2).alias(
            "orders_per_customer"
        ),
    ).orderBy(F.desc("total_revenue"), "customer_state")


def realtime_kpis(tables, as_of=None) -> DataFrame:
    """Report 10: last hour, today and month to date, in one pass over the current month."""
    as_of = as_of or latest_purchase(tables)
    now = instant(as_of)
    bought = F.col("order_purchase_timestamp")
    month_start = F.trunc(F.to_date(now), "MM").cast("timestamp_ntz")
    first_needed = F.least(month_start, now - F.expr("INTERVAL '1' HOUR"))
    recent = tables.orders.where(bought >= first_needed).select(
        "order_id", "customer_id", "order_purchase_timestamp"
    )
    # the month's orders thin out the payments before they are folded
    paid = tables.payments.join(recent.select("order_id"), "order_id", "left_semi")
    recent = recent.join(payments_per_order(paid), "order_id")
    hour = bought >= now - F.expr("INTERVAL '1' HOUR")
    today = day_of(bought) == F.to_date(now)
    month = month_of(bought) == F.trunc(F.to_date(now), "MM")
    return recent.agg(
        F.count_if(hour).alias("orders_last_hour"),
        F.sum(F.when(hour, F.col("paid"))).alias("_h"),
        F.sum(F.when(hour, F.col("n_payments"))).alias("_hn"),
        F.count_if(today).alias("orders_today"),
        F.sum(F.when(today, F.col("paid"))).alias("_t"),
        F.count_if(month).alias("orders_mtd"),
        F.sum(F.when(month, F.col("paid"))).alias("_m"),
        F.countDistinct(F.when(month, F.col("customer_id"))).alias("customers_mtd"),
    ).select(
        "orders_last_hour",
        _dbl("_h").alias("revenue_last_hour"),
        round_half_up(ratio(F.col("_h"), F.col("_hn")), 2).alias("aov_last_hour"),
        "orders_today",
        _dbl("_t").alias("revenue_today"),
        "orders_mtd",
        _dbl("_m").alias("revenue_mtd"),
        "customers_mtd",
        now.alias("snapshot_time"),
    )
