"""Rename sets of the four source tables.

Matching is case-insensitive (change files carry camelCase headers, the
catalog lower-cases them). Unlike a chain of ``withColumnRenamed`` calls,
which silently ignores a missing column, every source column of a set must be
present; extra columns are kept for the caller to drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Source column -> silver column, per source table.
CUSTOMER_RENAMES = {
    "customerid": "customer_id",
    "op": "cdc_operation",
    "phone": "cust_phone",
    "address": "cust_address",
    "country": "cust_country",
    "city": "cust_city",
    "email": "cust_email",
    "name": "cust_name",
}
PRODUCT_RENAMES = {
    "productid": "product_id",
    "op": "cdc_operation",
    "productname": "product_name",
    "brandname": "brand_name",
    "productdescription": "product_description",
    "price": "product_price",
    "productcategory": "product_category",
}
ORDER_RENAMES = {
    "orderid": "order_id",
    "orderCustomerId": "order_customer_id",
    "orderDate": "order_date",
    "paymentMethod": "payment_method",
    "orderPlatform": "order_platform",
}
ORDER_DETAIL_RENAMES = {
    "orderDetailsId": "order_details_id",
    "orderId": "order_id",
    "productid": "product_id",
    "Quantity": "product_quantity",
}


class MissingColumnsError(ValueError):
    pass


def rename_columns(df: DataFrame, mapping: dict[str, str], strict: bool = True) -> DataFrame:
    """One projection renaming ``mapping`` keys (any case) to its values."""
    lower = {k.lower(): v for k, v in mapping.items()}
    present = {c.lower() for c in df.columns}
    missing = sorted(set(lower) - present)
    if strict and missing:
        raise MissingColumnsError(f"change file lacks required columns {missing}; has {df.columns}")
    return df.select(*[F.col(f"`{c}`").alias(lower.get(c.lower(), c)) for c in df.columns])
