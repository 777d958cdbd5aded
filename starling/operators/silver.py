"""Bronze -> silver transforms of the four source tables.

Pure DataFrame functions: rename, type, derive the change hash, split names,
add audit columns. Each is a single projection after Catalyst collapses it, so
a silver job is a map-only scan -> write with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.audit import open_end, run_date, run_timestamp
from starling.functions.hashing import change_hash
from starling.functions.rescue import RESCUED, merge_rescued, unread
from starling.functions.text import (
    name_token,
    round_price,
    to_date_safe,
    to_int_safe,
    price_text,
    to_price_decimal,
    to_timestamp_safe,
)
from starling.operators.rename import CUSTOMER_RENAMES, ORDER_DETAIL_RENAMES, ORDER_RENAMES, PRODUCT_RENAMES, rename_columns

# The type-2 attributes hashed for change detection, in order.
CUSTOMER_HASHED = ("cust_phone", "cust_address", "cust_country", "cust_city", "cust_name")
PRODUCT_HASHED = ("product_name", "brand_name", "product_description", "product_price", "product_category")


def _change_ts(df: DataFrame):
    if "dms_timestamp" in {c.lower() for c in df.columns}:
        return to_timestamp_safe("dms_timestamp")
    return F.lit(None).cast("timestamp")


def _carried(df: DataFrame) -> list[str]:
    """Rescued data goes through silver as it is."""
    return [RESCUED] if RESCUED in df.columns else []


def silver_customer(bronze: DataFrame, run_ts: str | None = None, hash_sep: str = "",
                    hash_null_marker: str | None = None) -> DataFrame:
    """B1. Email is not hashed: an email-only change is not a new version."""
    r = rename_columns(bronze, CUSTOMER_RENAMES)
    return r.select(
        "cdc_operation", "customer_id", "cust_email", "cust_phone", "cust_address", "cust_country", "cust_city",
        change_hash(*CUSTOMER_HASHED, sep=hash_sep, null_marker=hash_null_marker).alias("hash_value"),
        run_timestamp(run_ts).alias("record_start_ts"),
        open_end().alias("record_end_ts"),
        F.lit(1).alias("active_flag"),
        name_token("cust_name", 0).alias("cust_first_name"),
        name_token("cust_name", 1).alias("cust_last_name"),
        _change_ts(r).alias("dms_timestamp"),
        run_date(run_ts).alias("ingestion_date"), *_carried(r),
    )


def silver_product(bronze: DataFrame, run_ts: str | None = None, hash_sep: str = "",
                   hash_null_marker: str | None = None) -> DataFrame:
    """B2. The hash sees the price as delivered; the stored price is parsed
    and rounded to 2 digits."""
    r = rename_columns(bronze, PRODUCT_RENAMES)
    return r.select(
        "cdc_operation", "product_id", "product_name", "brand_name", "product_description",
        round_price(to_price_decimal("product_price")).alias("product_price"),
        "product_category",
        change_hash(
            *PRODUCT_HASHED[:3], price_text("product_price"), *PRODUCT_HASHED[4:], sep=hash_sep,
            null_marker=hash_null_marker,
        ).alias("hash_value"),
        run_timestamp(run_ts).alias("record_start_ts"),
        open_end().alias("record_end_ts"),
        F.lit(1).alias("active_flag"),
        _change_ts(r).alias("dms_timestamp"),
        run_date(run_ts).alias("ingestion_date"), *_carried(r),
    )


def silver_orders(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """B3. Unparsable dates become NULL and the row is kept; ``order_year_pk``
    copies the year so the partition value also stays inside the files."""
    r = rename_columns(bronze, ORDER_RENAMES)
    d = to_date_safe("order_date")
    return r.select(
        "order_id", "order_customer_id", d.alias("order_date"), "payment_method", "order_platform",
        F.year(d).alias("order_year"), F.month(d).alias("order_month"),
        run_date(run_ts).alias("ingestion_date"),
        _change_ts(r).alias("dms_timestamp"),
        F.year(d).alias("order_year_pk"), *_carried(r),
    )


def silver_order_details(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """B4. Quantity is typed as an integer (the warehouse DDL's text is not kept)."""
    r = rename_columns(bronze, ORDER_DETAIL_RENAMES)
    return r.select(
        "order_details_id", "order_id", "product_id", to_int_safe("product_quantity").alias("product_quantity"),
        run_date(run_ts).alias("ingestion_date"),
        _change_ts(r).alias("dms_timestamp"),
        run_date(run_ts).alias("ingestion_date_pk"), *_carried(r),
    )


SILVER_FUNCTIONS = {
    "customer": silver_customer,
    "product": silver_product,
    "orders": silver_orders,
    "orderdetails": silver_order_details,
}

# Source columns that a silver function parses, and how.
PARSED = {
    "customer": {"dms_timestamp": to_timestamp_safe},
    "product": {"price": to_price_decimal, "dms_timestamp": to_timestamp_safe},
    "orders": {"orderdate": to_date_safe, "dms_timestamp": to_timestamp_safe},
    "orderdetails": {"quantity": to_int_safe, "dms_timestamp": to_timestamp_safe},
}


def silver_rescued(table: str, bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """The silver rows of ``table`` with a VARIANT column of what silver itself
    does not hold: texts that a typed column could not read, and whatever the
    scan has rescued already (``functions.rescue``)."""
    before = F.col(RESCUED) if RESCUED in bronze.columns else F.lit(None).cast("variant")
    values = {c: unread(F.col(c), parse(c)) for c, parse in PARSED[table].items()}
    return SILVER_FUNCTIONS[table](bronze.withColumn(RESCUED, merge_rescued(before, values)), run_ts=run_ts)


# Partition column of each silver dataset.
SILVER_PARTITION = {
    "customer": "ingestion_date",
    "product": "ingestion_date",
    "orders": "order_year_pk",
    "orderdetails": "ingestion_date_pk",
}
