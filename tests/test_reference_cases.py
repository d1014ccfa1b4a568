"""Cases taken from the reference's own unit tests and fixtures."""
import datetime as dt
import os

import pytest

from tidemart.plans.operations import orders_from_carts
from tidemart.plans.warehouse import Warehouse
from tidemart.sources.batch_io import append, batch_path, write_batch
from tidemart.sources.catalog import RawTable
from tidemart.sources.ingest import load_raw

T0 = dt.datetime(2024, 6, 1, 12, 0)


def test_batch_key_layout():
    assert batch_path("base", "web", "orders", "2024-06-01") == "base/web/orders/ds=2024-06-01"


@pytest.mark.parametrize("schema,rows", [
    ("id int, name string", [(1, "a"), (2, "b")]),
    ("id int, value double", [(1, 1.5), (2, -0.25)]),
    ("order_id int, unit_price double, quantity int", [(7, 19.99, 3)]),
])
def test_parquet_round_trip(spark, tmp_dir, schema, rows):
    df = spark.createDataFrame(rows, schema)
    assert write_batch(df, tmp_dir, "web", "t", "2024-06-01", "a").rows == len(rows)
    back = spark.read.parquet(batch_path(tmp_dir, "web", "t")).drop("ds", "run")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_empty_batch_writes_nothing(spark, tmp_dir):
    empty = spark.createDataFrame([], "id int, val string")
    assert write_batch(empty, tmp_dir, "web", "empty", "2024-06-01", "a").rows == 0
    assert not os.path.exists(batch_path(tmp_dir, "web", "empty", "2024-06-01"))


def test_load_append_and_truncate(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw_t")
    df = spark.createDataFrame([(1, "2024-06-01 12:00:00")], "id int, created_at string")
    t = RawTable("raw_t", "web", "t", ("id",), "created_at", "id int, created_at timestamp_ntz")
    assert load_raw(df, path, t) == 1
    assert load_raw(df, path, t) == 1
    assert spark.read.parquet(path).count() == 2
    assert load_raw(df, path, t, truncate=True) == 1
    back = spark.read.parquet(path)
    assert back.count() == 1 and dict(back.dtypes)["created_at"] == "timestamp_ntz"
    assert "loaded_at" in back.columns
    assert append(df.limit(0), path) == 0


def test_cart_total_reconciles(spark):
    """Items (qty 2, 100.0) and (qty 1, 200.0) make an order total of 400.0."""
    raw = {
        "raw_web_carts": spark.createDataFrame(
            [(1, 5, 10, "converted", T0, T0, T0), (2, 6, 11, "abandoned", T0, T0, T0)],
            "id long, user_id long, session_id long, status string, created_at timestamp_ntz, "
            "updated_at timestamp_ntz, loaded_at timestamp_ntz"),
        "raw_web_cart_items": spark.createDataFrame(
            [(1, 1, 3, 2, 100.0, 60.0, T0, T0), (2, 1, 4, 1, 200.0, 120.0, T0, T0)],
            "id long, cart_id long, product_id long, quantity int, price_at_time double, "
            "cost_price double, created_at timestamp_ntz, loaded_at timestamp_ntz"),
        "raw_web_orders": spark.createDataFrame(
            [(9, 5, 1, 400.0, "paid", T0, T0)],
            "id long, user_id long, cart_id long, total_amount double, status string, "
            "created_at timestamp_ntz, loaded_at timestamp_ntz"),
    }
    wh = Warehouse(raw.__getitem__)
    rows = orders_from_carts(wh).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.cart_id, r.n_items, r.items_total, r.n_orders, r.order_total, r.reconciled) == \
        (1, 2, 400.0, 1, 400.0, True)
