import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillwise.session import build_session  # noqa: E402
from tillwise.sources.model import CommerceTables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session("4", shuffle_partitions=4, app="tests")


def day(n, hour=0):
    return dt.datetime(2023, 1, 1) + dt.timedelta(days=n, hours=hour)


@pytest.fixture(scope="session")
def shop(spark):
    """Six orders: A1 has two payments and two reviews, B1 has no items, C1 is not delivered."""
    money = lambda x: Decimal(str(x))
    frames = {
        "customers": spark.createDataFrame(
            [("a", "a", "SP", "x"), ("b", "b", "RJ", "y"), ("c", "c", "SP", "x")],
            "customer_id string, customer_unique_id string, customer_state string, customer_city string",
        ),
        "orders": spark.createDataFrame(
            [
                ("A1", "a", "delivered", day(0, 10), day(3, 9)),
                ("A2", "a", "delivered", day(40), day(42)),
                ("A3", "a", "delivered", day(100), None),
                ("B1", "b", "delivered", day(0), day(1)),
                ("B2", "b", "shipped", day(45), None),
                ("C1", "c", "processing", day(41), None),
            ],
            "order_id string, customer_id string, order_status string, "
            "order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz",
        ),
        "order_items": spark.createDataFrame(
            [
                ("A1", 1, "p1", "s1", money("10.00"), money("1.00")),
                ("A1", 2, "p2", "s1", money("20.00"), money("2.00")),
                ("A2", 1, "p1", "s2", money("30.00"), money("3.00")),
                ("A3", 1, "p2", "s2", money("5.50"), money("0.50")),
                ("B2", 1, "p1", "s1", money("40.00"), money("4.00")),
                ("C1", 1, "p1", "s1", money("7.00"), money("0.00")),
            ],
            "order_id string, order_item_id int, product_id string, seller_id string, "
            "price decimal(12,2), freight_value decimal(12,2)",
        ),
        "payments": spark.createDataFrame(
            [
                ("A1", 1, "card", 2, money("22.00")),
                ("A1", 2, "voucher", 1, money("11.00")),
                ("A2", 1, "card", 1, money("33.00")),
                ("A3", 1, "card", 1, money("6.00")),
                ("B1", 1, "boleto", 1, money("9.00")),
                ("B2", 1, "card", 1, money("44.00")),
            ],
            "order_id string, payment_sequential int, payment_type string, "
            "payment_installments int, payment_value decimal(12,2)",
        ),
        "products": spark.createDataFrame(
            [("p1", "toys"), ("p2", "books")], "product_id string, product_category_name string"
        ),
        "sellers": spark.createDataFrame(
            [("s1", "x", "SP", 4.5), ("s2", "y", "RJ", 3.0)],
            "seller_id string, seller_city string, seller_state string, seller_rating double",
        ),
        "reviews": spark.createDataFrame(
            [("r1", "A1", 5), ("r2", "A1", 3), ("r3", "B1", 1)],
            "review_id string, order_id string, review_score int",
        ),
    }
    return CommerceTables(spark, frames)


@pytest.fixture(scope="session")
def daily(spark):
    """A year of seeded daily revenue."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(42)
    frame = pd.DataFrame(
        {
            "date": pd.date_range("2023-01-01", periods=365).date,
            "total_revenue": np.clip(rng.normal(10000, 2000, 365), 1000, 20000).round(2),
            "total_orders": rng.integers(20, 100, 365),
            "avg_order_value": np.clip(rng.normal(200, 50, 365), 50, 500).round(2),
        }
    )
    df = spark.createDataFrame(
        frame, "date date, total_revenue double, total_orders bigint, avg_order_value double"
    )
    df.pdf = frame
    return df
