"""Every named query with a SQL twin agrees with it; plans stay as designed."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tillwise.operators import anomaly, cohort, facts
from tillwise.plans import catalog, reports
from tillwise.sources.star import BucketedCommerce, Commerce
from tools.check import TABLES, canonical

from .conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, duck, name):
    ours = catalog.QUERIES[name](spark, SMALL).toPandas()
    theirs = duck.execute(catalog.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(facts.daily_series(Commerce(spark, SMALL), start="1996-01-01", end="1996-12-31"))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThanOrEqual(o" in text
    assert "l_shipdate" not in text  # the delivery date is not asked for, so no item is read


@pytest.mark.parametrize(
    "build",
    [reports.cohort_lifetime_value, reports.seller_metrics, cohort.cohort_activity,
     anomaly.dimension_days, facts.master_dataset, facts.state_revenue],
)
def test_nothing_large_in_one_task(spark, build):
    text = plan(build(Commerce(spark, SMALL)))
    assert "SinglePartition" not in text and "Python" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_orders_are_shuffled_once_for_all_order_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(facts.order_facts(Commerce(spark, SMALL)).drop("order_delivered_customer_date"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 4  # orders, items, payments, reviews


@pytest.mark.parametrize(
    "name, order",
    [
        ("q1_daily_revenue_ma", "order_date"), ("q2_rfm_sql", "total_revenue DESC"), ("q3_cohort_retention", "cohort_month, period"),
        ("q4_zscore", "dt"), ("q5_category_wow_drop", "revenue_delta"), ("q6_cohort_ltv", "cohort_month, months_since_first"),
        ("q7_seller_performance", "revenue_rank"), ("q8_payment_running", "payment_type, month"), ("q9_geo_revenue", "total_revenue DESC"),
    ],
)
def test_reports_come_in_their_order(spark, duck, name, order):
    ours = catalog.QUERIES[name](spark, SMALL).toPandas()
    keys = [k.split()[0] for k in order.split(", ")]
    theirs = duck.execute(f"SELECT {', '.join(keys)} FROM ({catalog.ORACLES[name]}) ORDER BY {order}").df()
    assert ours[keys].astype(str).values.tolist() == theirs.astype(str).values.tolist()


def test_one_customer_thins_out_every_table(spark):
    text = plan(facts.customer_orders(Commerce(spark, SMALL), 42))
    for scan in ("l_orderkey", "o_orderkey"):
        assert scan in text
    assert text.count("LeftSemi") >= 3  # items, payments and reviews, and the items of the delivery date


def test_root_cause_reads_items_once(spark):
    t = Commerce(spark, SMALL)
    days = spark.sql("SELECT DATE '1996-03-10' AS date")
    text = plan(anomaly.dimension_days(t, days))
    assert "l_extendedprice" not in text  # the few items that are asked for were written first
    assert "GreaterThanOrEqual(o_orderdate" in text


def scans(df, column):
    """Scans of a plan that read a column."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line and column in line.split("ReadSchema")[1] for line in text.split("\n"))


def test_sellers_read_items_and_orders_once(spark):
    metrics = reports.seller_metrics(Commerce(spark, SMALL))
    assert scans(metrics, "l_extendedprice") == scans(metrics, "l_orderkey") == 1
    assert scans(metrics, "o_orderdate") == 1


def test_master_dataset_folds_items_once(spark):
    assert scans(facts.master_dataset(Commerce(spark, SMALL)), "l_orderkey") == 1


def test_bucketed_orders_meet_without_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = facts.master_dataset(BucketedCommerce(spark, SMALL, 4), grain="order")
        text = plan(wide)
        assert "order_id" not in "".join(line for line in text.split("\n") if "Exchange hashpartitioning" in line)
        assert "Exchange hashpartitioning(customer_id" in text and text.count("Bucketed: true") >= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
