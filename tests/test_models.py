import pytest
from pyspark.sql import functions as F

from tillwise.operators import churn, rfm
from tillwise.sources.star import Commerce

from .conftest import SMALL


@pytest.fixture(scope="module")
def features(spark):
    """Customers whose churn follows from their order count."""
    rows = [(i, 1 + i % 10, float(100 + i), float(i % 5), i % 300, float(i % 7), float(i % 11)) for i in range(400)]
    columns = (
        "customer_id int, order_count int, total_revenue double, avg_review double, "
        "days_since_first int, purchase_frequency double, avg_inter_order_days double"
    )
    return spark.createDataFrame(rows, columns).withColumns(
        {
            "avg_order_value": F.col("total_revenue") / F.col("order_count"),
            "is_churned": (F.col("order_count") <= 4).cast("bigint"),
        }
    )


def test_boosted_churn(features, spark):
    model, metrics = churn.churn_model(features, trees=5, folds=3, parallelism=3)
    row = metrics.first()
    assert row["cv_auc_mean"] > 0.95 and row["churn_rate"] == 0.4 and row["customers"] == 400
    scores = churn.churn_scores(model, features).collect()
    assert len(scores) == 400 and {r["churn_risk"] for r in scores} <= {"Low", "Medium", "High", "Critical"}
    p = [r["churn_probability"] for r in scores]
    assert p == sorted(p, reverse=True)
    top = churn.feature_importance(spark, model).first()
    assert top["feature"] in ("order_count", "avg_order_value")


def test_forest_and_attribution(features):
    row = churn.forest_metrics(features, trees=10, depth=5).first()
    assert row["auc"] > 0.95 and row["n_train"] + row["n_test"] == 400
    found = churn.churn_attribution(features)
    r = found.where("customer_id = 3").first()
    sizes = [abs(c["contribution"]) for c in r["contributions"]]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) == len(churn.FEATURES)
    signs = {c["feature"]: c["contribution"] for c in r["contributions"]}
    assert all(signs[f] > 0 for f in r["top_positive_factors"])
    summary = {x["feature"]: x["direction"] for x in churn.attribution_summary(found).collect()}
    assert set(summary) == set(churn.FEATURES)


def test_clusters(spark):
    segments = rfm.rfm_segments(Commerce(spark, SMALL))
    got = rfm.cluster(segments, k=3)
    assert got.count() == segments.count()
    means = {r[0]: r[1] for r in got.groupBy("cluster_label").agg(F.avg(F.col("monetary").cast("double"))).collect()}
    assert means["Cluster_1_High"] >= means["Cluster_2_Mid"] >= means["Cluster_3_Low"]


def test_churn_metrics_fit_only_the_folds(features, monkeypatch):
    """The metrics query fits one model per fold, no refit on all rows, with CrossValidator's figures."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    training = churn._stratified(churn._training(features, churn.FEATURES), 3, 42)
    search = CrossValidator(
        estimator=Pipeline(stages=[*churn._stages(churn.FEATURES), churn.boosted_model(trees=5)]),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC"),
        numFolds=3,
        foldCol="_part",
    ).fit(training)
    fits, real = [], Pipeline._fit
    monkeypatch.setattr(Pipeline, "_fit", lambda self, df: fits.append(1) or real(self, df))
    row = churn.churn_metrics(features, trees=5, folds=3, parallelism=3).first()
    assert len(fits) == 3
    assert row["cv_auc_mean"] == round(search.avgMetrics[0], 3)
    assert row["cv_auc_std"] == round(search.stdMetrics[0], 3)
    assert row["churn_rate"] == 0.4 and row["customers"] == 400
