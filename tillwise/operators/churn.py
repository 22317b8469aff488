"""Churn: features, boosted and forest classifiers, risk bands, driver attribution."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.calendar import instant, whole_days
from ..functions.labels import churn_risk, churn_risk_five, next_best_action, retention_action
from ..functions.rounding import ratio, round_half_up
from ..session import materialize, packed
from .facts import item_value_per_order, order_value, payments_per_order, reviews_per_order

# The label is a function of days_since_last, so that column is no default feature.
FEATURES = [
    "order_count",
    "total_revenue",
    "avg_order_value",
    "avg_review",
    "days_since_first",
    "purchase_frequency",
    "avg_inter_order_days",
]


def churn_features(tables, reference=None, inactive_days: int = 90) -> DataFrame:
    """One row per customer; label = no order in the last `inactive_days`.

    `unique_categories` is the row count the reports use under that name;
    `distinct_categories` counts real product categories.
    """
    if reference is None:
        reference = tables.orders.agg(F.max("order_purchase_timestamp")).first()[0]
    now = instant(reference)
    copies = F.greatest(F.coalesce("n_reviews", F.lit(0)), F.lit(1))
    rows = F.greatest(F.coalesce("n_payments", F.lit(0)), F.lit(1)) * copies
    orders = (
        tables.orders.select("order_id", "customer_id", "order_purchase_timestamp")
        .join(item_value_per_order(tables.order_items), "order_id", "left")
        .join(payments_per_order(tables.payments), "order_id", "left")
        .join(reviews_per_order(tables.reviews), "order_id", "left")
    )
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(order_value()).alias("_value"),
        F.sum("score_sum").alias("_score"),
        F.sum("n_scores").alias("_scores"),
        F.min("order_purchase_timestamp").alias("_first"),
        F.max("order_purchase_timestamp").alias("_last"),
        F.sum(rows).alias("unique_categories"),
    )
    first, last = whole_days(now, F.col("_first")), whole_days(now, F.col("_last"))
    n = F.col("order_count")
    return per_customer.select(
        "customer_id",
        n,
        F.col("_value").cast("double").alias("total_revenue"),
        ratio(F.col("_value"), n).alias("avg_order_value"),
        ratio(F.col("_score"), F.col("_scores")).alias("avg_review"),
        first.alias("days_since_first"),
        last.alias("days_since_last"),
        "unique_categories",
        (n / (F.greatest(first, F.lit(1)) / F.lit(30.0))).alias("purchase_frequency"),
        (last > inactive_days).cast("bigint").alias("is_churned"),
        ratio(first, F.greatest(n, F.lit(1))).alias("avg_inter_order_days"),
    )


def distinct_categories(tables) -> DataFrame:
    """Different product categories per customer."""
    return (
        tables.orders.select("order_id", "customer_id")
        .join(tables.order_items.select("order_id", "product_id"), "order_id")
        .join(tables.products.select("product_id", "product_category_name"), "product_id")
        .groupBy("customer_id")
        .agg(F.countDistinct("product_category_name").alias("distinct_categories"))
    )


def _training(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    return packed(
        materialize(
            features.select("customer_id", F.col("is_churned").cast("double").alias("label"), *filled),
            "churn-training",
        )
    )


def _stages(columns: Sequence[str], with_mean: bool = False) -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=with_mean, withStd=True),
    ]


def _stratified(training: DataFrame, parts: int, seed: int) -> DataFrame:
    """Stable pseudo-random part 0..parts-1, drawn inside each label by hashing the id.

    The label shares of the parts agree up to sampling noise; no window over a label
    (which would be one task for half of the customers) is needed.
    """
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col("label"), F.col("customer_id")), F.lit(parts))
    return training.withColumn("_part", bucket.cast("int"))


def boosted_model(
    trees: int = 200, depth: int = 4, rate: float = 0.05, subsample: float = 0.8, seed: int = 42
) -> GBTClassifier:
    return GBTClassifier(
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=subsample,
        seed=seed,
        featuresCol="features",
        labelCol="label",
    )


def cross_validated(
    training: DataFrame,
    columns: Sequence[str] = FEATURES,
    folds: int = 5,
    parallelism: int = 5,
    **boosting,
) -> list[float]:
    """Area under ROC of every fold's model on the part it left out, as CrossValidator with
    `foldCol="_part"` computes them, the folds fitted side by side; no final refit."""
    pipeline = Pipeline(stages=[*_stages(columns), boosted_model(**boosting)])
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")

    def fold(i: int) -> float:
        train = training.where(F.col("_part") != i).cache()
        held = training.where(F.col("_part") == i).cache()
        try:
            return evaluator.evaluate(pipeline.fit(train).transform(held))
        finally:
            train.unpersist()
            held.unpersist()

    with ThreadPool(max(1, min(parallelism, folds))) as pool:
        return pool.map(inheritable_thread_target(fold), range(folds))


def _model_metrics(training: DataFrame, aucs: Sequence[float]) -> DataFrame:
    return training.agg(
        F.lit(round(float(np.mean(aucs)), 3)).alias("cv_auc_mean"),
        F.lit(round(float(np.std(aucs)), 3)).alias("cv_auc_std"),
        F.round(F.avg("label"), 3).alias("churn_rate"),
        F.count(F.lit(1)).alias("customers"),
    )


def churn_metrics(
    features: DataFrame,
    columns: Sequence[str] = FEATURES,
    folds: int = 5,
    parallelism: int = 5,
    **boosting,
) -> DataFrame:
    """One row of cross-validated metrics of the boosted classifier, without the model on all rows."""
    training = _stratified(_training(features, columns), folds, 42)
    return _model_metrics(training, cross_validated(training, columns, folds, parallelism, **boosting))


def churn_model(
    features: DataFrame,
    columns: Sequence[str] = FEATURES,
    folds: int = 5,
    parallelism: int = 5,
    **boosting,
) -> tuple[object, DataFrame]:
    """Fit the boosted classifier; returns (pipeline model on all rows, one row of metrics)."""
    training = _stratified(_training(features, columns), folds, 42)
    aucs = cross_validated(training, columns, folds, parallelism, **boosting)
    model = Pipeline(stages=[*_stages(columns), boosted_model(**boosting)]).fit(training)
    return model, _model_metrics(training, aucs)


def fit_boosted(features: DataFrame, columns: Sequence[str] = FEATURES, **boosting):
    """The boosted classifier on all customers, without cross validation."""
    training = _training(features, columns)
    return Pipeline(stages=[*_stages(columns), boosted_model(**boosting)]).fit(training)


def feature_importance(spark, model, columns: Sequence[str] = FEATURES) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(w)) for c, w in zip(columns, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance")
    )


def churn_scores(model, features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Churn probability and risk band for every customer, most at risk first."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    p = vector_to_array("probability")[1]
    return (
        model.transform(features.withColumns(filled))
        .select("customer_id", p.alias("_p"))
        .select(
            "customer_id",
            round_half_up(F.col("_p"), 3).alias("churn_probability"),
            churn_risk(F.col("_p")).alias("churn_risk"),
        )
        .orderBy(F.desc("churn_probability"), "customer_id")
    )


def fit_forest(
    features: DataFrame,
    columns: Sequence[str] = FEATURES,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> tuple[object, DataFrame]:
    """Class-balanced random forest on 80 % of the customers (part 0 is left out); with the training rows."""
    training = _stratified(_training(features, columns), 5, seed)
    shares = training.where(F.col("_part") > 0).groupBy("label").count().collect()
    total = sum(row["count"] for row in shares)
    weight = F.lit(1.0)
    for row in shares:
        balanced = total / (len(shares) * row["count"])
        weight = F.when(F.col("label") == row["label"], F.lit(balanced)).otherwise(weight)
    weighted = training.withColumn("_weight", weight)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, weightCol="_weight", labelCol="label"
    )
    fit_rows = weighted.where(F.col("_part") > 0)
    # trees do not mind the centred features, which attribution needs
    return Pipeline(stages=[*_stages(columns, with_mean=True), forest]).fit(fit_rows), weighted


def forest_metrics(features: DataFrame, columns: Sequence[str] = FEATURES, **forest) -> DataFrame:
    """The forest, judged on the customers left out."""
    model, rows = fit_forest(features, columns, **forest)
    judged = model.transform(rows.where(F.col("_part") == 0))
    auc = BinaryClassificationEvaluator(labelCol="label").evaluate(judged)
    return rows.agg(
        F.lit(round(auc, 4)).alias("auc"),
        F.lit(len(columns)).alias("n_features"),
        F.count_if(F.col("_part") > 0).alias("n_train"),
        F.count_if(F.col("_part") == 0).alias("n_test"),
    )


def forest_attribution(
    features: DataFrame, columns: Sequence[str] = FEATURES, top: int = 5, **forest
) -> DataFrame:
    """Contribution of every feature by the forest that `forest_metrics` judges: its importance times
    the standardised value, for every customer."""
    model, rows = fit_forest(features, columns, **forest)
    weights = [float(w) for w in model.stages[-1].featureImportances.toArray()]
    return _attributed(model.transform(rows), columns, weights, top)


def churn_attribution(
    features: DataFrame, columns: Sequence[str] = FEATURES, top: int = 5
) -> DataFrame:
    """Signed contribution of every feature to every customer's churn score, in one job.

    For a logistic model with independent features the Shapley value of a feature is
    coefficient x standardised value, so the attribution is a projection.
    """
    training = _training(features, columns)
    model = Pipeline(
        stages=[*_stages(columns, with_mean=True), LogisticRegression(labelCol="label", regParam=0.01)]
    ).fit(training)
    coefficients = [float(c) for c in model.stages[-1].coefficients]
    return _attributed(model.transform(training), columns, coefficients, top)


def _attributed(scored: DataFrame, columns: Sequence[str], weights: Sequence[float], top: int) -> DataFrame:
    """Contributions weight x standardised value, the largest first, with bands and actions."""
    z = vector_to_array("features")
    parts = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"), (z[i] * F.lit(weights[i])).alias("contribution")
            )
            for i, name in enumerate(columns)
        ]
    )
    by_size = F.array_sort(
        parts, lambda a, b: F.signum(F.abs(b["contribution"]) - F.abs(a["contribution"])).cast("int")
    )
    named = lambda keep: F.slice(
        F.transform(F.filter("_parts", keep), lambda e: e["feature"]), 1, top
    )
    p = F.col("_p")
    return (
        scored.select("customer_id", vector_to_array("probability")[1].alias("_p"), by_size.alias("_parts"))
        .select(
            "customer_id",
            F.round(p, 4).alias("churn_probability"),
            churn_risk_five(p).alias("churn_risk"),
            F.col("_parts").alias("contributions"),
            named(lambda e: e["contribution"] > 0).alias("top_positive_factors"),
            named(lambda e: e["contribution"] < 0).alias("top_negative_factors"),
            retention_action(p, F.col("_parts")[0]["feature"]).alias("next_best_action"),
        )
    )


def attribution_summary(attribution: DataFrame) -> DataFrame:
    """Mean absolute contribution and direction per feature."""
    return (
        attribution.select(F.explode("contributions").alias("_c"))
        .groupBy(F.col("_c.feature").alias("feature"))
        .agg(
            F.avg(F.abs("_c.contribution")).alias("importance"),
            F.avg("_c.contribution").alias("_mean"),
        )
        .select(
            "feature",
            "importance",
            F.when(F.col("_mean") > 0, "Positive (increases churn)")
            .otherwise("Negative (decreases churn)")
            .alias("direction"),
        )
    )


def heuristic_impacts(rfm: DataFrame) -> DataFrame:
    """Rule-of-thumb churn impact of recency, frequency and monetary value."""
    r, f = F.col("recency").cast("double"), F.col("frequency").cast("double")
    m = F.col("monetary").cast("double")
    return rfm.withColumns(
        {
            "recency_impact": round_half_up((r - 90.0) / 180.0 * 0.4, 3),
            "frequency_impact": round_half_up((1.0 / F.greatest(f, F.lit(1.0)) - 0.5) * 0.35, 3),
            "monetary_impact": round_half_up((1.0 - m / 2000.0) * 0.25, 3),
        }
    )


def customer_detail(facts: DataFrame, rfm: DataFrame) -> DataFrame:
    """Rows, spending, impacts and next action per customer.

    `facts` is the order-grain table; the row count includes the payment/review fan-out.
    Filter either input by customer_id for a single customer.
    """
    spent = facts.groupBy("customer_id").agg(
        F.sum(F.col("total_order_value") * F.col("row_multiplicity")).alias("total_spent"),
        F.sum("row_multiplicity").alias("order_count"),
    )
    known = heuristic_impacts(rfm).withColumn(
        "next_best_action",
        next_best_action(
            F.col("segment"), F.col("recency"), F.col("frequency"), F.col("monetary")
        ),
    )
    impacts = ["recency_impact", "frequency_impact", "monetary_impact"]
    joined = spent.join(
        known.select("customer_id", "segment", *impacts, "next_best_action"), "customer_id", "left"
    )
    return joined.select(
        "customer_id",
        F.col("total_spent").cast("double").alias("total_spent"),
        "order_count",
        "segment",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in impacts],
        F.coalesce("next_best_action", F.lit("N/A")).alias("next_best_action"),
    )
