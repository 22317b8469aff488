"""Schemas of the commerce model: ten named datasets and the transaction event."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
RATING = T.DecimalType(3, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()

DATASETS: dict[str, T.StructType] = {
    "orders": _struct(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS),
    ),
    "customers": _struct(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code", S),
        ("customer_city", S), ("customer_state", S), ("customer_segment", S),
    ),
    "order_items": _struct(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", MONEY), ("freight_value", MONEY),
    ),
    "payments": _struct(
        ("order_id", S), ("payment_sequential", I), ("payment_type", S),
        ("payment_installments", I), ("payment_value", MONEY),
    ),
    "reviews": _struct(
        ("review_id", S), ("order_id", S), ("review_score", I),
        ("review_comment_title", S), ("review_comment_message", S),
        ("review_creation_date", TS), ("review_answer_timestamp", TS),
    ),
    "products": _struct(
        ("product_id", S), ("product_category_name", S),
        ("product_weight_g", I), ("unit_price", MONEY),
    ),
    "sellers": _struct(
        ("seller_id", S), ("seller_zip_code", S), ("seller_city", S),
        ("seller_state", S), ("seller_rating", RATING),
    ),
    "geolocation": _struct(
        ("zip_code_prefix", S), ("lat", D), ("lng", D), ("city", S), ("state", S),
    ),
    "category_translation": _struct(
        ("product_category_name", S), ("product_category_name_english", S),
    ),
    "daily_revenue": _struct(
        ("date", T.DateType()), ("total_revenue", D), ("total_orders", L), ("avg_order_value", D),
    ),
}

B, DAY = T.BooleanType(), T.DateType()

# the batch run's results, as far as a table read back from text needs types
DERIVED: dict[str, T.StructType] = {
    "anomaly_detection": _struct(
        ("date", DAY), ("total_revenue", D), ("total_orders", L), ("avg_order_value", D),
        ("rolling_mean", D), ("rolling_std", D), ("z_score", D), ("anomaly_zscore", B), ("anomaly_iqr", B),
        ("anomaly_cc", B), ("anomaly_votes", L), ("is_anomaly", B), ("anomaly_type", S),
        ("anomaly_magnitude", D), ("anomaly_severity", S),
    ),
    "revenue_forecast": _struct(
        ("step", L), ("date", DAY), ("seasonal_forecast", D), ("boosted_forecast", D),
        ("ensemble_forecast", D), ("lower_80", D), ("upper_80", D),
    ),
    "rfm_segments": _struct(
        ("customer_id", S), ("recency", L), ("frequency", L), ("monetary", D), ("R_score", L), ("F_score", L),
        ("M_score", L), ("segment", S),
    ),
    "cohort_retention": _struct(
        ("cohort_month", DAY), ("period", L), ("cohort_size", L), ("customers", L), ("retention", D),
    ),
    "churn_predictions": _struct(("customer_id", S), ("churn_probability", D), ("churn_risk", S)),
}

PRIMARY_KEYS = {
    "orders": ["order_id"],
    "customers": ["customer_id"],
    "order_items": ["order_id", "order_item_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "reviews": ["review_id"],
}

FOREIGN_KEYS = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("payments", "order_id", "orders"),
    ("reviews", "order_id", "orders"),
]

EVENT = _struct(
    ("event_id", S), ("order_id", S), ("customer_id", S), ("timestamp", S), ("revenue", D),
    ("category", S), ("state", S), ("payment_type", S), ("channel", S),
)
