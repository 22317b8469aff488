from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwise.functions import geo
from tillwise.operators import quality
from tillwise.schemas import DATASETS, FOREIGN_KEYS, PRIMARY_KEYS
from tillwise.session import discard, materialize, scratch_path
from tillwise.sources import files, relational
from tillwise.sources.manifests import Manifests
from tillwise.sources.model import CommerceTables
from tillwise.sources.tables import Tables
from tillwise.streaming import events


@pytest.fixture()
def folder(spark, shop, tmp_path):
    """CSV files with the expected name endings, payments missing, one file empty."""
    for name, ending in {
        "orders": "shop_orders_dataset.csv",
        "order_items": "shop_order_items_dataset.csv",
        "customers": "shop_customers_dataset.csv",
        "products": "shop_products_dataset.csv",
    }.items():
        getattr(shop, name).toPandas().to_csv(tmp_path / ending, index=False)
    (tmp_path / "shop_sellers_dataset.csv").write_text("seller_id,seller_city\n")
    (tmp_path / "shop_order_reviews_dataset.csv").write_text(
        'review_id,order_id,review_score,review_comment_message\nr1,A1,5,"two\nlines"\n'
    )
    return str(tmp_path)


def test_load_all_skips_what_is_missing(spark, folder, shop):
    found = files.load_all(spark, folder)
    assert set(found) == {"orders", "order_items", "customers", "products", "reviews"}
    assert found["order_items"].count() == 6 and found["reviews"].count() == 1
    assert dict(found["order_items"].dtypes)["price"] == "decimal(12,2)"
    assert dict(found["orders"].dtypes)["order_purchase_timestamp"] == "timestamp"
    tables = CommerceTables(spark, found)
    assert tables.orders_in("delivered").count() == 4
    merged = tables.order_items.join(tables.orders, "order_id").join(tables.customers, "customer_id")
    assert merged.count() == tables.order_items.count()


def test_corrupt_rows_are_kept(spark, tmp_path):
    (tmp_path / "x.csv").write_text("order_id,price\na,1.50\nb,oops\n")
    df = files.read_csv(spark, str(tmp_path / "x.csv"), DATASETS["order_items"], keep_corrupt=True)
    got = {r["order_id"]: (r["price"], r[files.CORRUPT]) for r in df.collect()}
    assert got["a"][1] is None and got["b"][0] is None and got["b"][1] == "b,oops"


def test_parquet_sink_by_month(spark, shop):
    path = scratch_path(spark, "months")
    files.write_parquet(shop.orders.withColumn("m", F.month("order_purchase_timestamp")), path, ["m"])
    assert spark.read.parquet(path).where("m = 2").count() == 3


def test_bucketed_tables_join_without_exchange(spark, shop):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("orders", "payments"):
            spark.sql(f"DROP TABLE IF EXISTS b_{name}")
            files.write_bucketed(getattr(shop, name), f"b_{name}", "order_id", 4, scratch_path(spark, name))
        joined = spark.table("b_orders").join(spark.table("b_payments"), "order_id")
        assert joined.count() == 6
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables(spark, shop, tmp_path):
    store = Tables(spark)
    (tmp_path / "h.csv").write_text(" Order ID,Total Value\n1,2\n3,4\n")
    store.load_csv("cleaned", str(tmp_path / "h.csv"))
    assert store.get("cleaned").columns == ["order_id", "total_value"]
    assert store.get("cleaned", "total_value", where="order_id = 3").first()[0] == "4"
    store.replace("cleaned", store.get("cleaned").limit(1))
    assert store.get("cleaned").count() == 1 and "cleaned" in store.names()
    got = store.query("SELECT id FROM range(10) WHERE id > :low AND id < :high", {"low": 3, "high": 5})
    assert [r[0] for r in got.collect()] == [4]
    ordered = store.get("cleaned", order_by="greatest(order_id, total_value) desc, order_id", limit=5)
    assert ordered.count() == 1
    with pytest.raises(Exception):
        store.query("SELECT nothing FROM nowhere")
    store.replace("master_dataset", shop.orders)
    assert store.customer_detail("a").count() == 3
    store.replace("reviews", shop.reviews)
    assert {r["sentiment_score"] for r in store.review_sentiment().collect()} == {1.0, 0.0, -1.0}


def test_typed_tables_and_sql_columns(spark, tmp_path):
    store = Tables(spark)
    (tmp_path / "a.csv").write_text("date,total_revenue,is_anomaly\n2024-01-01,5.0,true\n2024-01-02,6.0,false\n")
    store.load_csv("anomaly_detection", str(tmp_path / "a.csv"))
    assert store.anomalies().count() == 1 and store.anomalies(only_anomalies=False).count() == 2
    assert store.get("anomaly_detection", limit=0).count() == 0
    got = store.get("anomaly_detection", "round(greatest(cast(total_revenue AS double), abs(-5.5)), 2) AS x, 'a,b' AS y", order_by="x")
    assert [tuple(r) for r in got.collect()] == [(5.5, "a,b"), (6.0, "a,b")]


def folders(tmp_path, name):
    return len(list((tmp_path / "tables" / name / "rows").iterdir()))


def test_a_reader_of_the_old_version_finishes(spark, tmp_path):
    store = Tables(spark, str(tmp_path / "tables"))
    store.replace("versions", spark.range(3))
    before = store.get("versions")
    for i in range(3):
        store.replace("versions", spark.range(i))
    assert before.count() == 3 and store.get("versions").count() == 2
    assert store.version("versions") == 4 and folders(tmp_path, "versions") == 4


def test_versions_beyond_the_retention_go_with_the_next_replace(spark, tmp_path):
    root = str(tmp_path / "tables")
    for i in range(3):  # as if every replace came from another session
        store = Tables(spark, root, retention=0)
        store.replace("versions", spark.range(i + 1) if i == 0 else store.get("versions").union(spark.range(1)))
    assert store.get("versions").count() == 3
    assert store.version("versions") == 3 and folders(tmp_path, "versions") == 1
    Tables(spark, root, retention=3600).replace("versions", spark.range(9))
    assert folders(tmp_path, "versions") == 2


def test_another_session_opens_the_newest_versions(spark, tmp_path):
    root = str(tmp_path / "tables")
    store = Tables(spark, root)
    for i in range(2):
        store.replace("opened", spark.range(i + 5))
    spark.sql("DROP VIEW opened")
    assert Tables(spark, root).open() == ["opened"]
    assert spark.table("opened").count() == 6


def test_a_manifest_number_is_given_once(spark, tmp_path):
    one, other = (Manifests(spark, str(tmp_path / "m")) for _ in range(2))
    assert one.newest() is None and one.numbers() == []
    assert one.commit(1, {"a": [1]}) and not other.commit(1, {"a": [2]})
    assert other.newest() == (1, {"a": [1]}) and len([f for f in (tmp_path / "m").iterdir() if f.suffix == ".draft"]) == 0


def test_quality_report_finds_defects(spark, shop):
    frames = {
        "orders": shop.orders.unionByName(shop.orders.limit(1)),
        "customers": shop.customers.where("customer_id <> 'c'"),
        "reviews": shop.reviews.withColumn("review_score", F.col("review_score") + 2),
        "products": shop.products.where("false"),
    }
    got = {
        (r["table_name"], r["check_name"]): (r["value"], r["failed"])
        for r in quality.quality_report(frames, PRIMARY_KEYS, FOREIGN_KEYS).collect()
    }
    assert got[("orders", "duplicate_key:order_id")] == (1.0, True)
    assert got[("orders", "missing_parent:customer_id->customers")] == (1.0, True)
    assert got[("reviews", "range:review_score")] == (1.0, True)
    assert got[("products", "row_count")] == (0.0, True)
    assert got[("orders", "max_null_share")][0] == pytest.approx(3 / 7)


def test_jdbc_and_kafka_options():
    pg = relational.jdbc_options("postgresql://u:p@host:5432/shop")
    assert pg == {
        "url": "jdbc:postgresql://host:5432/shop", "driver": "org.postgresql.Driver",
        "user": "u", "password": "p",
    }
    assert relational.jdbc_options("sqlite:///data/shop.db")["url"] == "jdbc:sqlite:data/shop.db"
    with pytest.raises(ValueError):
        relational.jdbc_options("mysql://x/y")
    options = events.kafka_options("b:9092", "orders", "readers")
    assert options["startingOffsets"] == "latest" and options["kafka.group.id"] == "readers"


def test_geo_defaults_to_zero(spark):
    states = spark.createDataFrame([("SP",), ("??",)], "state string")
    got = {r["state"]: (r["lat"], r["lon"]) for r in geo.with_coordinates(states, geo.coordinates(spark)).collect()}
    assert got == {"SP": (-22.2, -48.8), "??": (0.0, 0.0)} and len(geo.STATE_COORDINATES) == 27


def test_scratch_tables_are_deleted_when_told(spark):
    first = materialize(spark.range(5), "first")
    second = materialize(first.where("id > 2"), "second")
    folder = Path(first.inputFiles()[0].removeprefix("file:").removeprefix("//")).parent
    assert folder.exists()
    discard(first, spark.range(1))
    assert not folder.exists() and second.count() == 2
    discard(first)


def test_bucketed_copies_get_more_buckets_as_the_tables_grow(spark, tmp_path):
    from tillwise.sources.star import BucketedCommerce

    orders = spark.range(2000).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "'F' AS o_orderstatus", "CAST(id AS DOUBLE) AS o_totalprice",
        "DATE'1995-01-01' + CAST(id % 300 AS INT) AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    )
    items = orders.selectExpr(
        "o_orderkey AS l_orderkey", "o_orderkey % 7 AS l_partkey", "o_orderkey % 3 AS l_suppkey", "1 AS l_linenumber",
        "1.0 AS l_quantity", "o_totalprice AS l_extendedprice", "0.0 AS l_discount", "0.05 AS l_tax",
        "'N' AS l_returnflag", "'F' AS l_linestatus", "o_orderdate AS l_shipdate",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    items.write.parquet(str(tmp_path / "lineitem.parquet"))
    stored = sum(p.stat().st_size for p in tmp_path.rglob("*.parquet") if p.is_file())
    tables = BucketedCommerce(spark, str(tmp_path), bucket_bytes=stored // 40)
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {tables._copies['lineitem']}").collect()
    assert int(next(r.data_type for r in details if r.col_name == "Num Buckets")) >= 40
    assert tables.raw("lineitem").count() == 2000
    assert tables.orders_with_items().where("order_delivered_customer_date IS NOT NULL").count() == 2000
