import pytest
from pyspark.sql import functions as F

from tillwise.plans import layers
from tillwise.session import scratch_path
from tillwise.sources.star import Commerce

from .conftest import SMALL


@pytest.fixture(scope="module")
def out(spark):
    tables = Commerce(spark, SMALL)
    done = layers.Output(scratch_path(spark, "layers"))
    few = {"trees": 3, "rate": 0.3}
    layers.ingest(tables, done)
    layers.customers(tables, done, k=2)
    layers.anomalies(tables, done, contamination=None)
    layers.forecasts(tables, done, horizon=10, **few)
    layers.cohorts(tables, done, folds=2, **few)
    layers.reviews(tables, done)
    return done


def test_outputs_hold_their_invariants(spark, out):
    load = lambda name: out.load(spark, name)
    assert load("master_dataset").count() == 1650
    daily = load("daily_revenue")
    assert load("anomaly_detection").count() == daily.count()
    rfm = load("rfm_segments")
    assert rfm.where("recency < 0 OR frequency < 1 OR R_score NOT BETWEEN 1 AND 5").count() == 0
    retention = load("cohort_retention")
    assert retention.where("period = 0 AND retention <> 100").count() == 0
    assert retention.where("retention > 100").count() == 0
    forecast = load("revenue_forecast")
    assert forecast.count() == 10
    assert forecast.where("lower_80 < 0 OR lower_80 > ensemble_forecast OR upper_80 < ensemble_forecast").count() == 0
    backtest = load("forecast_backtest")
    mixed = F.abs(0.4 * F.col("seasonal_forecast") + 0.6 * F.col("boosted_forecast") - F.col("ensemble_forecast"))
    assert backtest.count() == 10 and backtest.where(mixed > 0.01).count() == 0
    assert load("churn_predictions").count() == load("churn_features").count()
    assert load("sentiment_analysis").count() == Commerce(spark, SMALL).raw("documents").count()


def test_partitions_follow_the_month(spark, out):
    master = out.load(spark, "master_dataset")
    text = master.where("year = 1996 AND month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text


def test_a_rerun_replaces_its_months_only(spark, tmp_path):
    tables = Commerce(spark, SMALL)
    out = layers.Output(scratch_path(spark, "months"))
    layers.ingest(tables, out)
    names = ("master_dataset", "category_revenue", "daily_revenue")
    files = {n: set(out.load(spark, n).inputFiles()) for n in names}
    rows = {n: sorted(map(str, out.load(spark, n).collect())) for n in names}
    layers.ingest(tables, out, [(1996, 2), (1997, 11)])
    for name in names:
        again = out.load(spark, name)
        fresh = set(again.inputFiles()) - files[name]
        assert sorted(map(str, again.collect())) == rows[name]
        parts = {f.rsplit("/", 1)[0].split(name + "/")[1] for f in fresh}
        assert parts == ({"year=1996/month=2", "year=1997/month=11"} if name == "master_dataset" else {"part_month=1996-02", "part_month=1997-11"})


def test_the_command_line_run_names_its_results(spark):
    done = layers.run_all(Commerce(spark, SMALL), scratch_path(spark, "run"), ["ingest", "anomaly"])
    assert {"master_dataset", "category_revenue", "daily_revenue", "anomaly_detection", "root_cause"} <= set(done.store.names())
    assert done.store.anomalies(only_anomalies=False).count() == done.store.daily_revenue().count()
    assert done.store.get("master_dataset", where="year = 1996").count() > 0
