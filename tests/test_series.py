import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.operators import anomaly, forecast, kpis
from tillwise.operators.isolation_forest import isolation_forest


def by_date(df):
    return df.toPandas().sort_values("date").reset_index(drop=True)


def series(spark, values):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), float(v), 10, 20.0) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "date date, total_revenue double, total_orders bigint, avg_order_value double"
    )


def test_rolling_features_match_pandas(daily):
    got, x = by_date(anomaly.rolling_features(daily)), daily.pdf["total_revenue"]
    roll = x.rolling(7, min_periods=3)
    assert got["rolling_mean"].to_numpy() == pytest.approx(roll.mean().to_numpy(), nan_ok=True)
    assert got["rolling_std"].to_numpy() == pytest.approx(roll.std().to_numpy(), nan_ok=True)
    assert got["rolling_median"].to_numpy() == pytest.approx(roll.median().to_numpy(), nan_ok=True)
    change = (x.pct_change() * 100).to_numpy()
    assert got["revenue_change_pct"].to_numpy() == pytest.approx(change, nan_ok=True)
    assert pd.isna(got["revenue_change_pct"].iloc[0])


def test_zscore_and_iqr_match_pandas(daily):
    x = daily.pdf["total_revenue"]
    got = by_date(anomaly.iqr_fences(anomaly.z_score(daily)))
    z = (x - x.mean()) / x.std()
    assert got["z_score"].to_numpy() == pytest.approx(z.to_numpy())
    assert (got["anomaly_zscore"] == (z.abs() > 2.5)).all()
    q1, q3 = x.quantile(0.25), x.quantile(0.75)
    assert got["iqr_upper"].iloc[0] == pytest.approx(q3 + 1.5 * (q3 - q1))
    assert (got["anomaly_iqr"] == ((x > q3 + 1.5 * (q3 - q1)) | (x < q1 - 1.5 * (q3 - q1)))).all()


def test_spike_and_drop_are_named(spark):
    values = [100.0 + i % 3 for i in range(60)]
    values[30], values[45] = 1000.0, -800.0
    got = by_date(anomaly.detect(series(spark, values)))
    assert got["anomaly_type"].iloc[30] == "spike" and got["anomaly_type"].iloc[45] == "drop"
    assert got["is_anomaly"].sum() == 2
    assert not got["anomaly_cc"].iloc[30]  # the own point widens the limits
    strict = by_date(anomaly.detect(series(spark, values), exclude_current=True))
    assert strict["anomaly_cc"].iloc[30]
    report = anomaly.anomaly_report(anomaly.detect(series(spark, values))).collect()
    assert report[0]["anomaly_magnitude"] >= report[1]["anomaly_magnitude"]
    assert report[0]["confidence"] <= 0.95


def test_constant_and_single_row_series(spark):
    flat = by_date(anomaly.detect(series(spark, [50.0] * 20)))
    assert not flat["is_anomaly"].any() and (flat["z_score"] == 0).all()
    one = by_date(anomaly.detect(series(spark, [50.0])))
    assert not one["is_anomaly"].any()


def test_isolation_forest_finds_the_odd_day(spark):
    values = [100.0 + (i * 7) % 11 for i in range(200)]
    values[77] = 900.0
    df = series(spark, values)
    inputs = ["total_revenue", "total_orders", "avg_order_value"]
    got = by_date(isolation_forest(df, inputs, contamination=0.05, trees=50, sample=64))
    assert got["score"].idxmax() == 77 and got["is_outlier"].iloc[77]
    assert got["is_outlier"].sum() <= 10
    again = by_date(isolation_forest(df.repartition(3), inputs, 0.05, trees=50, sample=64))
    assert again["score"].to_numpy() == pytest.approx(got["score"].to_numpy())


def test_ts_features_match_pandas(daily):
    got, y = by_date(forecast.ts_features(daily)), daily.pdf["total_revenue"]
    dates = pd.to_datetime(daily.pdf["date"])
    assert got["lag_28"].to_numpy() == pytest.approx(y.shift(28).to_numpy(), nan_ok=True)
    for n in (3, 30):
        roll = y.shift(1).rolling(n)
        assert got[f"roll_mean_{n}"].to_numpy() == pytest.approx(roll.mean().to_numpy(), nan_ok=True)
        assert got[f"roll_std_{n}"].to_numpy() == pytest.approx(roll.std().to_numpy(), nan_ok=True)
        assert got[f"roll_max_{n}"].to_numpy() == pytest.approx(roll.max().to_numpy(), nan_ok=True)
    assert got["mom_30"].to_numpy() == pytest.approx((y.shift(1) / y.shift(31) - 1).to_numpy(), nan_ok=True)
    assert (got["day_of_week"] == dates.dt.dayofweek).all()
    assert (got["week_of_year"] == dates.dt.isocalendar().week).all()
    assert (got["is_month_end"] == dates.dt.is_month_end.astype(int)).all()
    assert got["dow_sin"].to_numpy() == pytest.approx(np.sin(2 * np.pi * dates.dt.dayofweek / 7).to_numpy())


def test_naive_and_seasonal(spark):
    weekly = [10, 20, 30, 40, 50, 60, 70]
    df = series(spark, weekly * 5)
    naive = forecast.naive_forecast(df, 3).orderBy("step").collect()
    assert [r["forecast"] for r in naive] == [70.0] * 3
    sd = np.std((weekly * 5)[-30:])
    assert naive[0]["upper"] == pytest.approx(70 + 1.28 * sd) and naive[0]["lower"] >= 0
    assert naive[0]["date"] == dt.date(2024, 1, 1) + dt.timedelta(days=35)
    seasonal = forecast.seasonal_forecast(df, 14).orderBy("step").collect()
    assert [r["forecast"] for r in seasonal] == [float(v) for v in weekly * 2]
    rising = series(spark, [v + 7 * (i // 7) for i, v in enumerate(weekly * 5)])
    steps = forecast.seasonal_forecast(rising, 8).orderBy("step").collect()
    assert steps[0]["forecast"] == 10 + 35 and steps[7]["forecast"] == 10 + 42


def test_short_series_fall_back(spark):
    one = forecast.seasonal_forecast(series(spark, [5.0]), 2).collect()
    assert [r["forecast"] for r in one] == [5.0, 5.0]
    few = forecast.naive_forecast(series(spark, [5.0, 6.0]), 1).first()
    assert (few["lower"], few["upper"]) == (6.0, 6.0)


def test_several_series_at_once(spark):
    both = series(spark, [1.0] * 10).withColumn("k", F.lit("a")).unionByName(
        series(spark, [2.0] * 10).withColumn("k", F.lit("b"))
    )
    got = forecast.naive_forecast(both, 2, ["k"]).groupBy("k").agg(F.avg("forecast")).collect()
    assert {r[0]: r[1] for r in got} == {"a": 1.0, "b": 2.0}


def test_backtest_and_ensemble(daily):
    train, test = forecast.split_last(daily, 30)
    assert train.count() == 335 and test.count() == 30
    compared = forecast.backtest(test, {"naive": forecast.naive_forecast(train)})
    got = forecast.backtest_metrics(compared, ["naive"]).first()
    y = daily.pdf["total_revenue"]
    error = (y.iloc[-30:] - y.iloc[-31]).abs()
    assert got["mae"] == pytest.approx(error.mean())
    assert got["mape"] == pytest.approx((error / y.iloc[-30:]).mean() * 100)
    seasonal = forecast.seasonal_forecast(daily)
    mixed = forecast.ensemble(seasonal, forecast.naive_forecast(daily)).collect()
    assert len(mixed) == 30
    for r in mixed:
        assert r["ensemble_forecast"] == pytest.approx(
            0.4 * r["seasonal_forecast"] + 0.6 * r["boosted_forecast"]
        )
        assert 0 <= r["lower_80"] <= r["ensemble_forecast"] <= r["upper_80"]


def test_boosted_model_beats_the_mean(spark):
    values = [100 + 50 * (i % 7) for i in range(150)]
    df = series(spark, values)
    _, metrics = forecast.boosted_metrics(df, trees=15, depth=4, rate=0.3)
    assert metrics.first()["mape"] < 15
    out = forecast.boosted_forecast(df, horizon=5, trees=15, depth=4, rate=0.3).orderBy("step").collect()
    assert [r["step"] for r in out] == [1, 2, 3, 4, 5]
    assert out[0]["date"] == dt.date(2024, 1, 1) + dt.timedelta(days=150)
    wanted = [100 + 50 * ((150 + i) % 7) for i in range(5)]
    assert [r["forecast"] for r in out] == pytest.approx(wanted, rel=0.3)


def test_what_if_and_comparison(spark):
    df = series(spark, [1.0] * 35 + [2.0] * 30)
    got = kpis.period_comparison(df).first()
    assert (got["recent_avg"], got["previous_avg"], got["pct_change"]) == (2.0, 1.0, 100.0)
    short = kpis.period_comparison(series(spark, [4.0] * 10)).first()
    assert short["pct_change"] == 0.0
    grid = {(r[1], r[2]): r["delta"] for r in kpis.what_if(df, [0, 10], [0, 50]).collect()}
    assert grid[(0, 0)] == 0.0 and grid[(10, 50)] == pytest.approx(95 * (1.1 * 1.5 - 1))
