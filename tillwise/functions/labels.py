"""Labels and bins, as expressions and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values: (recency score, frequency score) -> segment.
SEGMENT_MAP = {
    (5, 5): "Champions",
    (5, 4): "Champions",
    (5, 3): "Potential Loyalist",
    (5, 2): "New Customers",
    (5, 1): "New Customers",
    (4, 5): "Loyal Customers",
    (4, 4): "Loyal Customers",
    (4, 3): "Potential Loyalist",
    (4, 2): "Promising",
    (4, 1): "Promising",
    (3, 5): "At Risk",
    (3, 4): "At Risk",
    (3, 3): "Need Attention",
    (3, 2): "Need Attention",
    (3, 1): "About to Sleep",
    (2, 5): "Cannot Lose",
    (2, 4): "Cannot Lose",
    (2, 3): "About to Sleep",
    (2, 2): "Hibernating",
    (2, 1): "Hibernating",
    (1, 5): "Lost",
    (1, 4): "Lost",
    (1, 3): "Hibernating",
    (1, 2): "Hibernating",
    (1, 1): "Lost",
}
DEFAULT_SEGMENT = "Need Attention"

# Advice per segment.
SEGMENT_ACTIONS = {
    "Champions": "Reward them. Be early adopters for new products. Ask for reviews.",
    "Loyal Customers": "Upsell higher value products. Ask for reviews. Engage them.",
    "Potential Loyalist": "Offer membership/loyalty program. Recommend related products.",
    "At Risk": "Send personalized emails. Offer discounts. Re-engage them.",
    "Cannot Lose": "Win them back via renewals. Give freebies. Don't lose them.",
    "New Customers": "Provide onboarding support. Start building relationship.",
    "Promising": "Create brand awareness. Offer free trial.",
    "Need Attention": "Make limited-time offers. Recommend popular products.",
    "About to Sleep": "Share valuable resources. Recommend popular products. Offer discounts.",
    "Hibernating": "Offer popular products and discounts. Reconnect with them.",
    "Lost": "Revive interest with reach-out campaigns. Ignore otherwise.",
}

# Next step per segment; the rest falls through to the behaviour rules.
NEXT_STEP = {
    "Champions": "Reward program / Early access",
    "Loyal Customers": "Upsell premium products",
    "At Risk": "Win-back campaign with discount",
    "Hibernating": "Re-engagement email series",
    "Lost": "Survey for feedback",
    "New Customers": "Onboarding sequence",
    "Promising": "Product recommendations",
    "Need Attention": "Limited-time offer",
}


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def rfm_segment(r: Column, f: Column) -> Column:
    keyed = _literal_map({f"{a}{b}": name for (a, b), name in SEGMENT_MAP.items()})
    key = F.concat(r.cast("string"), f.cast("string"))
    return F.coalesce(F.try_element_at(keyed, key), F.lit(DEFAULT_SEGMENT))


def segment_action(segment: Column) -> Column:
    return F.try_element_at(_literal_map(SEGMENT_ACTIONS), segment)


def next_best_action(segment: Column, recency: Column, frequency: Column, monetary: Column) -> Column:
    return F.coalesce(
        F.try_element_at(_literal_map(NEXT_STEP), F.coalesce(segment, F.lit(""))),
        F.when((recency < 30) & (frequency < 2), "Second purchase incentive")
        .when(monetary > 1000, "VIP treatment")
        .otherwise("General newsletter"),
    )


def severity(z: Column) -> Column:
    size = F.abs(z)
    return (
        F.when(size < 2.0, "none")
        .when(size < 2.5, "low")
        .when(size < 3.5, "medium")
        .when(size < 5.0, "high")
        .otherwise("critical")
    )


def churn_risk(p: Column) -> Column:
    """Four bands; the lowest is closed at 0."""
    return (
        F.when((p >= 0) & (p <= 0.3), "Low")
        .when((p > 0.3) & (p <= 0.6), "Medium")
        .when((p > 0.6) & (p <= 0.8), "High")
        .when((p > 0.8) & (p <= 1.0), "Critical")
    )


def churn_risk_five(p: Column) -> Column:
    """Five bands of the driver report."""
    return (
        F.when(p >= 0.8, "Critical")
        .when(p >= 0.6, "High")
        .when(p >= 0.4, "Medium")
        .when(p >= 0.2, "Low")
        .otherwise("Very Low")
    )


# which driver a model's feature stands for, by parts of its name
DRIVERS = {
    "recency": ("recency", "days"),
    "frequency": ("frequency", "order_count"),
    "monetary": ("monetary", "revenue", "value"),
}
# The action for the strongest driver of a likely churn.
DRIVER_ACTIONS = {
    "recency": "Win-back campaign - time-sensitive discount",
    "frequency": "Engagement campaign - new product recommendations",
    "monetary": "VIP treatment - exclusive offers",
}


def retention_action(p: Column, top_factor: Column) -> Column:
    """Action by churn probability; above 0.7 the strongest factor decides."""
    factor = F.lower(F.coalesce(top_factor, F.lit("")))
    action = (
        F.when(p < 0.3, "Maintain engagement - send newsletter")
        .when(p < 0.5, "Monitor closely - check recent activity")
        .when(p < 0.7, "Proactive outreach - personalized offer")
    )
    for driver, parts in DRIVERS.items():
        action = action.when(factor.rlike("|".join(parts)), DRIVER_ACTIONS[driver])
    return action.otherwise("Urgent win-back - personal contact recommended")


def sentiment_band(score: Column) -> Column:
    return (
        F.when(score >= 0.5, "Very Positive")
        .when(score >= 0.2, "Positive")
        .when(score >= -0.2, "Neutral")
        .when(score >= -0.5, "Negative")
        .when(score < -0.5, "Very Negative")
    )


def register_sql_functions(spark: SparkSession) -> None:
    """severity(z), rfm_segment(r, f), churn_risk(p), sentiment_band(s) for SQL text.

    They are SQL-bodied functions, so Catalyst inlines them into the calling query.
    """
    pairs = " ".join(f"WHEN {r}{f} THEN '{name}'" for (r, f), name in SEGMENT_MAP.items())
    bodies = {
        "severity(z DOUBLE)": "CASE WHEN abs(z) < 2.0 THEN 'none' WHEN abs(z) < 2.5 THEN 'low' "
        "WHEN abs(z) < 3.5 THEN 'medium' WHEN abs(z) < 5.0 THEN 'high' ELSE 'critical' END",
        "rfm_segment(r INT, f INT)": f"CASE r * 10 + f {pairs} ELSE '{DEFAULT_SEGMENT}' END",
        "churn_risk(p DOUBLE)": "CASE WHEN p < 0.0 THEN NULL WHEN p <= 0.3 THEN 'Low' "
        "WHEN p <= 0.6 THEN 'Medium' WHEN p <= 0.8 THEN 'High' WHEN p <= 1.0 THEN 'Critical' END",
        "sentiment_band(s DOUBLE)": "CASE WHEN s >= 0.5 THEN 'Very Positive' WHEN s >= 0.2 THEN "
        "'Positive' WHEN s >= -0.2 THEN 'Neutral' WHEN s >= -0.5 THEN 'Negative' "
        "WHEN s < -0.5 THEN 'Very Negative' END",
    }
    for signature, body in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}"
        )
