import datetime as dt
import decimal
from types import SimpleNamespace

import pytest

from stocktake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(root / "checkpoints"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            # Keep small partitions apart, so that slices have borders to carry over.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.streaming.stateStore.providerClass": (
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
            ),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def cash(text: str) -> decimal.Decimal:
    return decimal.Decimal(text)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return [tuple(r) for r in picked.collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def shop(spark):
    """A small shop: Eda and Fay never ordered, Dan only cancelled, Ann has two orders
    on one day, product 5 is never sold, some totals differ from their lines."""
    customers = [
        (1, "Ann", "West", "gold", "2023-01-15"),
        (2, "Bob", "North", "basic", "2023-01-20"),
        (3, "Cid", "West", "basic", "2023-02-10"),
        (4, "Dan", "North", "basic", "2023-02-11"),
        (5, "Eda", "South", "gold", "2023-03-01"),
        (6, "Fay", "South", "basic", "2023-03-02"),
    ]
    orders = [
        (1, 1, "2023-01-20", "done", "100.00", "card"),
        (2, 1, "2023-02-05", "done", "50.00", "upi"),
        (3, 1, "2023-02-05", "open", "30.05", "card"),
        (4, 1, "2023-04-01", "done", "20.00", "cod"),
        (5, 2, "2023-03-10", "done", "500.00", "upi"),
        (6, 2, "2023-03-11", "P", "999.00", "upi"),
        (7, 3, "2023-02-01", "done", "70.00", "cod"),
        (8, 3, "2023-06-01", "open", "70.00", "cod"),
        (9, 4, "2023-05-05", "P", "10.00", "card"),
    ]
    items = [
        (1, 1, 1, 1, "60.00"),
        (1, 2, 2, 2, "40.00"),
        (2, 1, 1, 1, "50.00"),
        (3, 1, 3, 1, "30.05"),
        (4, 1, 2, 1, "20.00"),
        (5, 1, 4, 5, "450.00"),
        (7, 1, 3, 2, "70.00"),
        (8, 1, 1, 1, "60.00"),
        (9, 1, 2, 1, "10.00"),
    ]
    products = [
        (1, "Lamp", "Home", "60.00"),
        (2, "Mug", "Home", "20.00"),
        (3, "Novel", "Books", "35.00"),
        (4, "Atlas", "Books", "90.00"),
        (5, "Scarf", "Wear", "15.00"),
    ]
    people = spark.createDataFrame(
        [(i, n, r, s, n, day(d)) for i, n, r, s, d in customers],
        "customer_id long, customer_name string, region string, segment string, nation string, "
        "signup_date date",
    )
    bought = spark.createDataFrame(
        [(i, c, day(d), s, cash(a), p) for i, c, d, s, a, p in orders],
        "order_id long, customer_id long, order_date date, status string, amount decimal(12,2), "
        "payment string",
    )
    return SimpleNamespace(
        spark=spark,
        customers=people.drop("signup_date"),
        signups=people.select("customer_id", "signup_date"),
        orders=bought,
        sales=bought.where("status <> 'P'"),
        items=spark.createDataFrame(
            [(o, n, p, q, cash(t)) for o, n, p, q, t in items],
            "order_id long, line_no int, product_id long, quantity int, line_total decimal(12,2)",
        ),
        products=spark.createDataFrame(
            [(i, n, c, cash(p)) for i, n, c, p in products],
            "product_id long, product_name string, category string, price decimal(10,2)",
        ),
    )
