"""Scalar functions (F1-F8) and the silver transforms (B1-B4) on literal rows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starling.functions.hashing import change_hash
from starling.functions.text import name_token, to_date_safe
from starling.operators.rename import CUSTOMER_RENAMES, MissingColumnsError, rename_columns
from starling.operators.silver import silver_customer, silver_order_details, silver_orders, silver_product
from starling.schemas import BRONZE_COLUMNS

EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def frame(spark, cols, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=cols).astype(object))


def test_hash_collision_and_null_handling(spark):
    df = frame(spark, ["a", "b"], [("ab", "c"), ("a", "bc"), (None, None)])
    out = df.select(change_hash("a", "b").alias("h"), change_hash("a", "b", sep="\x1f", null_marker="\\N").alias("s"))
    rows = out.collect()
    assert rows[0].h == rows[1].h            # documented collision without separator
    assert rows[0].s != rows[1].s            # separator removes it
    assert rows[2].h == EMPTY_SHA            # all NULL -> hash of empty text


def test_name_tokens(spark):
    df = frame(spark, ["n"], [("Cher",), ("Dr. Ann Lee",), ("Ann Lee",)])
    got = [(r.f, r.l) for r in df.select(name_token("n", 0).alias("f"), name_token("n", 1).alias("l")).collect()]
    assert got == [("Cher", None), ("Dr.", "Ann"), ("Ann", "Lee")]


def test_bad_date_is_null_and_row_kept(spark):
    df = frame(spark, ["d"], [("2024-13-01",), ("2024-03-05 10:11:12",)])
    got = [r.x for r in df.select(to_date_safe("d").alias("x")).collect()]
    assert got[0] is None and str(got[1]) == "2024-03-05"


def test_rename_is_case_insensitive_and_strict(spark):
    df = frame(spark, ["CustomerId", "OP", "Name", "Email", "Phone", "Address", "Country", "City"], [tuple("x" * 8)])
    assert "customer_id" in rename_columns(df, CUSTOMER_RENAMES).columns
    with pytest.raises(MissingColumnsError):
        rename_columns(df.drop("Phone"), CUSTOMER_RENAMES)


def test_silver_customer(spark):
    cols = BRONZE_COLUMNS["customer"]
    df = frame(spark, cols, [("I", "7", "Dr. Ann Lee", "a@x", "555", "1 Main", "US", "NYC", "2024-01-01 00:00:00")])
    r = silver_customer(df, run_ts="2024-01-05 00:00:00").first()
    assert (r.customer_id, r.cdc_operation, r.cust_first_name, r.cust_last_name) == ("7", "I", "Dr.", "Ann")
    assert r.active_flag == 1 and r.record_end_ts.year == 9999 and str(r.ingestion_date) == "2024-01-05"
    import hashlib
    assert r.hash_value == hashlib.sha256("5551 MainUSNYCDr. Ann Lee".encode()).hexdigest()


def test_silver_product_hashes_unrounded_price(spark):
    cols = BRONZE_COLUMNS["product"]
    df = frame(spark, cols, [("I", "1", "n", "b", "d", "10.005", "c", "2024-01-01 00:00:00")])
    r = silver_product(df, run_ts="2024-01-05 00:00:00").first()
    import hashlib
    assert r.product_price == 10.01
    assert r.hash_value == hashlib.sha256("nbd10.005c".encode()).hexdigest()


def test_silver_orders_and_details(spark):
    o = frame(spark, BRONZE_COLUMNS["orders"],
              [("I", "1", "9", "2023-07-04 10:00:00", "PayPal", "Mobile", "2024-01-01 00:00:00"),
               ("I", "2", "9", "not a date", "PayPal", "Mobile", "2024-01-01 00:00:00")])
    rows = silver_orders(o, run_ts="2024-01-05 00:00:00").orderBy("order_id").collect()
    assert (rows[0].order_year, rows[0].order_month, rows[0].order_year_pk) == (2023, 7, 2023)
    assert rows[1].order_date is None and rows[1].order_year is None
    d = frame(spark, BRONZE_COLUMNS["orderdetails"], [("I", "1-1", "1", "5", "3", "2024-01-01 00:00:00")])
    r = silver_order_details(d, run_ts="2024-01-05 00:00:00").first()
    assert r.product_quantity == 3 and str(r.ingestion_date_pk) == "2024-01-05"
    assert "op" not in silver_order_details(d).columns


def test_silver_is_one_projection_without_shuffle(spark):
    cols = BRONZE_COLUMNS["customer"]
    df = frame(spark, cols, [tuple("x" * len(cols))])
    plan = silver_customer(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert F is not None


def test_sorted_orders_are_newest_first(spark):
    from starling.operators.sort import sort_for_query
    from starling.sources.testtables import order_changes
    from conftest import SF_SMALL
    rows = sort_for_query(silver_orders(order_changes(spark, SF_SMALL)), "order_date", "order_id").collect()
    keys = [(r.order_date, r.order_id) for r in rows]
    assert all(a[0] > b[0] or (a[0] == b[0] and a[1] <= b[1]) for a, b in zip(keys, keys[1:]))
