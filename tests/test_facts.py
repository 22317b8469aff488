import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwise.operators import anomaly, churn, cohort, facts, kpis, rfm, trailing
from tillwise.plans import reports


def rows(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_master_rows_fan_out(shop):
    master = facts.master_dataset(shop)
    counts = rows(master.groupBy("order_id").count(), "order_id")
    assert counts["A1"]["count"] == 4  # two payments x two reviews
    assert counts["B1"]["count"] == 1 and master.count() == 9
    a1 = master.where("order_id = 'A1'").first()
    assert (a1["item_count"], float(a1["total_order_value"]), a1["unique_products"]) == (2, 33.0, 2)
    assert a1["delivery_days"] == 2  # 2 days 23 hours
    assert (a1["day_of_week"], a1["is_weekend"], a1["quarter"]) == (6, 1, 1)
    b1 = master.where("order_id = 'B1'").first()
    assert b1["item_count"] is None and float(b1["total_order_value"]) == 0.0


def test_order_grain_keeps_orders(shop):
    by_order = facts.master_dataset(shop, grain="order")
    assert by_order.count() == 6
    assert float(by_order.where("order_id = 'A1'").first()["paid"]) == 33.0
    with pytest.raises(ValueError):
        facts.master_dataset(shop, grain="other")


def test_daily_revenue_counts_orders_once(shop):
    got = rows(facts.daily_revenue(shop), "date")
    first = got[dt.date(2023, 1, 1)]
    assert (first["total_orders"], float(first["total_revenue"]), first["unique_customers"]) == (2, 42.0, 2)
    assert first["avg_order_value"] == pytest.approx(14.0)  # three payment rows
    assert first["avg_per_order"] == pytest.approx(21.0)
    assert facts.daily_revenue(shop, None).agg(F.sum("total_revenue")).first()[0] == 125


def test_daily_series_range_is_inclusive(shop):
    got = facts.daily_series(shop, None, start="2023-02-10", end="2023-02-15").collect()
    assert sorted(r["date"] for r in got) == [dt.date(2023, 2, 10), dt.date(2023, 2, 15)]


def test_rollups(shop):
    cats = rows(facts.category_revenue_top(shop), "category")
    assert (float(cats["toys"]["revenue"]), cats["toys"]["orders"]) == (87.0, 4)
    months = rows(facts.category_month_revenue(shop), "product_category_name", "month_year")
    assert months[("toys", dt.date(2023, 2, 1))]["orders"] == 3
    mix = rows(facts.payment_mix(shop.payments), "payment_type")
    assert (mix["card"]["count"], mix["card"]["count_share_pct"]) == (4, pytest.approx(400 / 6))
    order = rows(facts.state_revenue(shop), "state")
    assert (float(order["SP"]["revenue"]), order["SP"]["customers"]) == (79.0, 2)
    assert float(rows(facts.state_revenue(shop, "rows"), "state")["SP"]["revenue"]) == 79.0 + 3 * 33


def test_rfm_grain_and_recency(shop):
    base = rows(rfm.rfm_base(shop), "customer_id")
    assert set(base) == {"a", "b"}
    assert (base["a"]["frequency"], float(base["a"]["monetary"]), base["a"]["recency"]) == (3, 72.0, 0)
    assert base["b"]["recency"] == 100 and float(base["b"]["monetary"]) == 0.0
    fanned = rows(rfm.rfm_base(shop, grain="rows"), "customer_id")
    assert float(fanned["a"]["monetary"]) == 72.0 + 3 * 33


def test_cohort_with_gap(shop):
    activity = cohort.cohort_activity(shop)
    long = rows(cohort.cohort_retention(activity), "cohort_month", "period")
    jan = dt.date(2023, 1, 1)
    assert long[(jan, 0)]["retention"] == 100.0 and long[(jan, 1)]["customers"] == 2
    assert (jan, 2) not in long and long[(jan, 3)]["retention"] == 50.0
    wide = rows(cohort.to_matrix(cohort.cohort_ltv(activity), "ltv", range(4), "m{}"), "cohort_month")
    assert wide[jan]["m2"] is None and wide[jan]["m3"] >= wide[jan]["m1"] >= wide[jan]["m0"]
    summary = cohort.summary(cohort.cohort_retention(activity)).first()
    assert summary["total_cohorts"] == 2 and summary["total_customers"] == 3
    assert summary["best_cohort_m1"] == "2023-01" and summary["avg_m6_retention_pct"] == 0.0


def test_churn_features(shop):
    got = rows(churn.churn_features(shop), "customer_id")
    assert (got["a"]["order_count"], got["a"]["is_churned"], got["b"]["is_churned"]) == (3, 0, 0)
    assert got["a"]["avg_review"] == 4.0 and got["c"]["avg_review"] is None
    assert got["a"]["unique_categories"] == 6  # rows, fan-out included
    assert churn.distinct_categories(shop).where("customer_id = 'a'").first()[1] == 2


def test_customer_detail_without_rfm(shop):
    scored = rfm.with_segments(rfm.with_scores(rfm.rfm_base(shop)))
    got = rows(churn.customer_detail(facts.order_facts(shop), scored), "customer_id")
    assert got["c"]["next_best_action"] == "N/A" and got["c"]["recency_impact"] == 0.0
    assert got["a"]["total_spent"] == 72.0 + 3 * 33 and got["a"]["order_count"] == 6


def test_reports_on_fixture(shop):
    geo = rows(reports.geographic_revenue(shop), "customer_state")
    # A1: two payments x two reviews
    assert geo["SP"]["total_revenue"] == 2 * 33 + 33 + 6 and geo["SP"]["avg_review_score"] == 4.0
    sellers = rows(reports.seller_performance(shop), "seller_id")
    assert sellers["s1"]["total_revenue"] == 60.0  # two reviews double A1's items
    assert (sellers["s2"]["total_revenue"], sellers["s2"]["active_months"]) == (35.5, 2)
    assert sellers["s2"]["review_rank"] == 1 and sellers["s1"]["review_rank"] == 2  # no review first
    now = reports.realtime_kpis(shop, dt.datetime(2023, 1, 1, 10, 30)).first()
    assert (now["orders_last_hour"], now["revenue_last_hour"]) == (4, 116.0)  # A1 and everything later that was paid


def test_monthly_churn_rate(shop):
    got = rows(kpis.monthly_churn_rate(shop), "month")
    assert got["2023-01"]["churn_rate"] == 0.0 and got["2023-01"]["orders"] == 5
    assert got["2023-02"]["churn_rate"] == pytest.approx(2 / 3 * 100)


def test_event_history(shop):
    got = trailing.event_history(shop)
    assert got.where("order_id = 'A1'").count() == 2 and got.where("order_id = 'B1'").count() == 0
    assert got.where("order_id = 'A1'").first()["category"] == "toys"


def test_root_cause_window(shop, spark):
    flagged = spark.createDataFrame([(dt.date(2023, 2, 15),)], "date date")
    got = rows(anomaly.root_cause(anomaly.dimension_days(shop), flagged), "dimension", "value")
    rj = got[("customer_state", "RJ")]
    assert (rj["anomaly_revenue"], rj["prior_avg_revenue"], rj["delta_pct"], rj["position"]) == (44.0, 0.0, None, 1)
    sp = got[("customer_state", "SP")]
    assert sp["anomaly_revenue"] == 0.0 and sp["prior_avg_revenue"] == pytest.approx(40 / 7)
    assert got[("product_category", "toys")]["anomaly_revenue"] == 40.0
