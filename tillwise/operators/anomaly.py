"""Anomaly detection on a daily series, root causes and alerts.

A daily series has one row per day (and per `series` key, if given), so windows over a
whole series see at most a few thousand rows however large the order tables are. All
statistics are window aggregates over the one computed series: the orders are read once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import day_of
from ..functions.labels import severity
from ..functions.rounding import round_half_up
from ..session import materialize
from .facts import item_value_per_order, order_value

VOTES = ["anomaly_zscore", "anomaly_iqr", "anomaly_cc", "anomaly_iforest"]


def _whole(series: Sequence[str]):
    return Window.partitionBy(*series)


def _in_order(series: Sequence[str]):
    return Window.partitionBy(*series).orderBy("date")


def rolling_features(
    daily: DataFrame, window: int = 7, min_rows: int = 3, series: Sequence[str] = (),
    exclude_current: bool = False,
) -> DataFrame:
    """Trailing mean, deviation and median, day change and lags."""
    ordered = _in_order(series)
    frame = (
        ordered.rowsBetween(-window, -1) if exclude_current else ordered.rowsBetween(1 - window, 0)
    )
    x = F.col("total_revenue")
    enough = F.count(x).over(frame) >= min_rows
    previous = F.lag(x).over(ordered)
    return daily.withColumns(
        {
            "rolling_mean": F.when(enough, F.avg(x).over(frame)),
            "rolling_std": F.when(enough, F.stddev_samp(x).over(frame)),
            "rolling_median": F.when(enough, F.percentile(x, F.lit(0.5)).over(frame)),
            "revenue_change_pct": (F.try_divide(x, previous) - 1.0) * 100.0,
            "revenue_lag1": previous,
            "revenue_lag7": F.lag(x, 7).over(ordered),
        }
    )


def z_score(daily: DataFrame, threshold: float = 2.5, series: Sequence[str] = ()) -> DataFrame:
    x, whole = F.col("total_revenue"), _whole(series)
    spread = F.greatest(F.stddev_samp(x).over(whole), F.lit(1.0))
    return daily.withColumn("z_score", (x - F.avg(x).over(whole)) / spread).withColumn(
        "anomaly_zscore", F.coalesce(F.abs("z_score") > threshold, F.lit(False))
    )


def iqr_fences(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    x, whole = F.col("total_revenue"), _whole(series)
    q1 = F.percentile(x, F.lit(0.25)).over(whole)
    q3 = F.percentile(x, F.lit(0.75)).over(whole)
    return (
        daily.withColumns({"_q1": q1, "_q3": q3})
        .withColumns(
            {
                "iqr_lower": F.col("_q1") - 1.5 * (F.col("_q3") - F.col("_q1")),
                "iqr_upper": F.col("_q3") + 1.5 * (F.col("_q3") - F.col("_q1")),
            }
        )
        .withColumn("anomaly_iqr", (x < F.col("iqr_lower")) | (x > F.col("iqr_upper")))
        .drop("_q1", "_q3")
    )


def control_chart(rolled: DataFrame) -> DataFrame:
    """Limits at three rolling deviations; needs `rolling_features`."""
    x = F.col("total_revenue")
    ucl = F.col("rolling_mean") + 3 * F.col("rolling_std")
    lcl = F.col("rolling_mean") - 3 * F.col("rolling_std")
    outside = (x > F.col("ucl")) | (x < F.greatest(F.col("lcl"), F.lit(0.0)))
    known = F.col("ucl").isNotNull()
    return rolled.withColumns({"ucl": ucl, "lcl": lcl}).withColumn(
        "anomaly_cc", F.when(known, outside).otherwise(False)
    )


def vote_and_classify(scored: DataFrame, votes: Sequence[str] | None = None, need: int = 2) -> DataFrame:
    """Majority flag, spike or drop, distance from the rolling mean, severity."""
    votes = votes or [c for c in VOTES if c in scored.columns]
    total = sum((F.col(c).cast("int") for c in votes), F.lit(0))
    z = F.col("z_score")
    return scored.withColumn("anomaly_votes", total.cast("bigint")).withColumns(
        {
            "is_anomaly": F.col("anomaly_votes") >= need,
            "anomaly_type": F.when(F.col("anomaly_votes") < need, "normal")
            .when(z > 0, "spike")
            .otherwise("drop"),
            "anomaly_magnitude": F.abs(F.col("total_revenue") - F.col("rolling_mean")),
            "anomaly_severity": severity(z),
        }
    )


def detect(
    daily: DataFrame,
    threshold: float = 2.5,
    window: int = 7,
    series: Sequence[str] = (),
    contamination: float | None = None,
    exclude_current: bool = False,
) -> DataFrame:
    """All methods on a daily series. With `contamination` the isolation forest votes too."""
    scored = control_chart(
        iqr_fences(
            z_score(rolling_features(daily, window, 3, series, exclude_current), threshold, series),
            series,
        )
    )
    if contamination is not None:
        from .isolation_forest import isolation_forest

        scored = isolation_forest(
            scored, ["total_revenue", "total_orders", "avg_order_value"], contamination,
            key=[*series, "date"],
        ).withColumnsRenamed({"score": "iforest_score", "is_outlier": "anomaly_iforest"})
    return vote_and_classify(scored)


def anomaly_report(detected: DataFrame) -> DataFrame:
    """Flagged days with a confidence, largest distance first."""
    return (
        detected.where("is_anomaly")
        .select(
            "date",
            "total_revenue",
            "revenue_change_pct",
            "z_score",
            "anomaly_type",
            "anomaly_severity",
            "anomaly_magnitude",
            "is_anomaly",
            F.least(F.lit(0.95), 0.5 + F.abs("z_score") / 10.0).alias("confidence"),
        )
        .orderBy(F.desc("anomaly_magnitude"), "date")
    )


def recent_alerts(detected: DataFrame, n: int = 3) -> DataFrame:
    return (
        detected.where("is_anomaly")
        .orderBy(F.desc("date"))
        .limit(n)
        .select("date", "total_revenue", "z_score", "anomaly_type", "anomaly_severity")
    )


def flagged_days(daily: DataFrame, detected: DataFrame, kind: str) -> DataFrame:
    """Daily rows whose date was flagged as the given kind (spike or drop)."""
    dates = detected.where(F.col("is_anomaly") & (F.col("anomaly_type") == kind)).select("date")
    return daily.join(dates, "date", "left_semi")


def _asked_days(dates: DataFrame, window_days: int) -> DataFrame:
    """Each date with itself and its predecessors: (anomaly_date, _back, date)."""
    return dates.select(
        F.col("date").alias("anomaly_date"),
        F.explode(F.sequence(F.lit(0), F.lit(window_days))).alias("_back"),
    ).withColumn("date", F.date_sub("anomaly_date", F.col("_back")))


def dimension_days(tables, dates: DataFrame | None = None, window_days: int = 7) -> DataFrame:
    """Revenue per day for each state, payment type and product category.

    State and payment type use the order value once per order (and payment type);
    category uses item prices. Days are folded per customer and per product before those
    tables are joined. With dates (one row each, bounded by the calendar) only those days and the
    window_days before them are computed: their first and last day reach the scan of the orders, and
    items are read once, for these orders only.
    """
    moment = F.col("order_purchase_timestamp")
    date = day_of(moment)
    orders = tables.orders.select("order_id", "customer_id", "order_purchase_timestamp")
    items = tables.order_items.select("order_id", "product_id", "price", "freight_value")
    if dates is not None:
        asked = _asked_days(dates, window_days).select("date").distinct()
        first, last = asked.agg(F.min("date"), F.max("date")).first()
        if first is None:
            orders = orders.where(F.lit(False))
        else:
            until = F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz")
            orders = orders.where((moment >= F.lit(first).cast("timestamp_ntz")) & (moment < until))
            # days of a calendar
            orders = orders.join(F.broadcast(asked), date == F.col("date"), "left_semi")
        items = materialize(items.join(orders.select("order_id"), "order_id", "left_semi"), "asked-items")
    value = item_value_per_order(items)
    facts = orders.join(value, "order_id", "left").select(
        "order_id", "customer_id", date.alias("date"), order_value().alias("_value")
    )
    by_state = (
        facts.groupBy("date", "customer_id")
        .agg(F.sum("_value").alias("_value"))
        .join(tables.customers.select("customer_id", "customer_state"), "customer_id", "left")
        .select("date", F.lit("customer_state").alias("dimension"),
                F.col("customer_state").alias("value"), "_value")
    )
    by_type = facts.join(
        tables.payments.select("order_id", "payment_type").distinct(), "order_id"
    ).select("date", F.lit("payment_type").alias("dimension"),
             F.col("payment_type").alias("value"), "_value")
    by_category = (
        items.select("order_id", "product_id", "price")
        .join(orders, "order_id")
        .groupBy(date.alias("date"), "product_id")
        .agg(F.sum("price").alias("_value"))
        .join(tables.products.select("product_id", "product_category_name"), "product_id")
        .select("date", F.lit("product_category").alias("dimension"),
                F.col("product_category_name").alias("value"), "_value")
    )
    rolled = [
        part.where(F.col("value").isNotNull())
        .groupBy("date", "dimension", "value")
        .agg(F.sum(F.col("_value").cast("decimal(23,2)")).alias("revenue"))
        for part in (by_state, by_type, by_category)
    ]
    return rolled[0].unionByName(rolled[1]).unionByName(rolled[2])


def root_cause(days: DataFrame, dates: DataFrame, window_days: int = 7) -> DataFrame:
    """For each date: revenue per dimension value against the mean of the days before.

    Each date asks for itself and its `window_days` predecessors, so the day table
    (already rolled up) is met by an equi join and both sums come from one aggregation.
    """
    asked = _asked_days(dates, window_days)
    zero = F.lit(0).cast("decimal(33,2)")
    today = F.coalesce(F.sum(F.when(F.col("_back") == 0, F.col("revenue"))), zero)
    prior = F.coalesce(F.sum(F.when(F.col("_back") > 0, F.col("revenue"))), zero)
    sums = (
        days.join(asked, "date")
        .groupBy("anomaly_date", "dimension", "value")
        .agg(today.cast("double").alias("anomaly_revenue"),
             (prior.cast("double") / F.lit(float(max(window_days, 1)))).alias("prior_avg_revenue"))
        .withColumn("delta", F.col("anomaly_revenue") - F.col("prior_avg_revenue"))
    )
    own = Window.partitionBy("anomaly_date", "dimension").orderBy(F.desc("delta"), "value")
    base = F.nullif(F.col("prior_avg_revenue"), F.lit(0.0))
    return sums.withColumns(
        {
            "delta_pct": round_half_up(F.try_divide(F.col("delta"), base) * 100.0, 1),
            "position": F.row_number().over(own).cast("bigint"),
        }
    )


def anomaly_alerts(detected: DataFrame, causes: DataFrame, dimension: str = "customer_state") -> DataFrame:
    """Date, type, severity, impact and strongest driver of each flagged day."""
    top = causes.where((F.col("position") == 1) & (F.col("dimension") == dimension)).select(
        F.col("anomaly_date").alias("date"), F.col("value").alias("top_driver"), "delta"
    )
    return (
        detected.where("is_anomaly")
        .join(top, "date", "left")
        .select(
            "date",
            F.upper("anomaly_type").alias("anomaly_type"),
            F.col("anomaly_severity").alias("severity"),
            F.col("anomaly_magnitude").alias("revenue_impact"),
            "top_driver",
            F.col("delta").alias("driver_delta"),
        )
    )
