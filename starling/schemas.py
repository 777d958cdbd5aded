"""Table shapes of every layer (bronze, silver, stage, fact, dimension).

Bronze is read as text: change files are CSV and a column may carry any text,
so typing happens once, by name, in the silver functions.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The open end of a version and the change-operation codes.
OPEN_END = "9999-12-31"
OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"

# Source column names as the catalog lists them (lower case),
# per source table, plus the two replication columns.
BRONZE_COLUMNS = {
    "customer": ["op", "customerid", "name", "email", "phone", "address", "country", "city", "dms_timestamp"],
    "product": [
        "op", "productid", "productname", "brandname", "productdescription", "price", "productcategory",
        "dms_timestamp",
    ],
    "orders": ["op", "orderid", "ordercustomerid", "orderdate", "paymentmethod", "orderplatform", "dms_timestamp"],
    "orderdetails": ["op", "orderdetailsid", "orderid", "productid", "quantity", "dms_timestamp"],
}


def text_schema(columns: list[str]) -> StructType:
    """All-string schema in the given (header) order."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def _s(name: str, dtype=None) -> StructField:
    return StructField(name, dtype or StringType(), True)


SILVER_CUSTOMER = StructType([
    _s("cdc_operation"), _s("customer_id"), _s("cust_email"), _s("cust_phone"), _s("cust_address"),
    _s("cust_country"), _s("cust_city"), _s("hash_value"), _s("record_start_ts", TimestampType()),
    _s("record_end_ts", TimestampType()), _s("active_flag", IntegerType()), _s("cust_first_name"),
    _s("cust_last_name"), _s("dms_timestamp", TimestampType()), _s("ingestion_date", DateType()),
])

SILVER_PRODUCT = StructType([
    _s("cdc_operation"), _s("product_id"), _s("product_name"), _s("brand_name"), _s("product_description"),
    _s("product_price", DoubleType()), _s("product_category"), _s("hash_value"),
    _s("record_start_ts", TimestampType()), _s("record_end_ts", TimestampType()),
    _s("active_flag", IntegerType()), _s("dms_timestamp", TimestampType()), _s("ingestion_date", DateType()),
])

SILVER_ORDERS = StructType([
    _s("order_id"), _s("order_customer_id"), _s("order_date", DateType()), _s("payment_method"),
    _s("order_platform"), _s("order_year", IntegerType()), _s("order_month", IntegerType()),
    _s("ingestion_date", DateType()), _s("dms_timestamp", TimestampType()), _s("order_year_pk", IntegerType()),
])

SILVER_ORDER_DETAILS = StructType([
    _s("order_details_id"), _s("order_id"), _s("product_id"), _s("product_quantity", IntegerType()),
    _s("ingestion_date", DateType()), _s("dms_timestamp", TimestampType()), _s("ingestion_date_pk", DateType()),
])

# Warehouse tables: column order of the target DDL. Text lengths are kept in
# JDBC DDL only (see sinks.jdbc); Parquet tables hold plain strings.
STAGE_DIM_CUSTOMER = StructType([
    _s("cdc_operation"), _s("customer_id"), _s("cust_email"), _s("cust_phone"), _s("cust_address"),
    _s("cust_country"), _s("cust_city"), _s("hash_value"), _s("record_start_ts", TimestampType()),
    _s("record_end_ts", TimestampType()), _s("active_flag", IntegerType()), _s("cust_first_name"),
    _s("cust_last_name"),
])

STAGE_DIM_PRODUCT = StructType([
    _s("cdc_operation"), _s("product_id"), _s("product_name"), _s("brand_name"), _s("product_description"),
    _s("product_price", DoubleType()), _s("product_category"), _s("hash_value"),
    _s("record_start_ts", TimestampType()), _s("record_end_ts", TimestampType()),
    _s("active_flag", IntegerType()),
])

FACT_ORDERS = StructType([
    _s("order_id"), _s("order_customer_id"), _s("order_date", DateType()), _s("payment_method"),
    _s("order_platform"), _s("order_year", IntegerType()), _s("order_month", IntegerType()),
    _s("ingestion_date", DateType()),
])

FACT_ORDER_DETAILS = StructType([
    _s("order_details_id"), _s("order_id"), _s("product_id"), _s("product_quantity", IntegerType()),
    _s("ingestion_date", DateType()),
])

# JDBC column types of the warehouse DDL (text lengths).
JDBC_COLUMN_TYPES = {
    "stage_dim_customer": (
        "cdc_operation VARCHAR(1), customer_id VARCHAR(50), cust_email VARCHAR(255), cust_phone VARCHAR(50), "
        "cust_address VARCHAR(500), cust_country VARCHAR(100), cust_city VARCHAR(100), hash_value VARCHAR(64), "
        "cust_first_name VARCHAR(255), cust_last_name VARCHAR(255)"
    ),
    "stage_dim_product": (
        "cdc_operation VARCHAR(1), product_id VARCHAR(50), product_name VARCHAR(255), brand_name VARCHAR(255), "
        "product_description VARCHAR(1000), product_category VARCHAR(255), hash_value VARCHAR(64)"
    ),
    "fact_orders": (
        "order_id VARCHAR(50), order_customer_id VARCHAR(50), payment_method VARCHAR(100), "
        "order_platform VARCHAR(100)"
    ),
    "fact_order_details": "order_details_id VARCHAR(50), order_id VARCHAR(50), product_id VARCHAR(50)",
}

# The versioned dimensions carry the stage columns; record_start_ts is the
# change time there, record_end_ts the start of the next version.
DIM_CUSTOMER = STAGE_DIM_CUSTOMER
DIM_PRODUCT = STAGE_DIM_PRODUCT

TABLE_SCHEMAS = {
    "stage_dim_customer": STAGE_DIM_CUSTOMER,
    "stage_dim_product": STAGE_DIM_PRODUCT,
    "fact_orders": FACT_ORDERS,
    "fact_order_details": FACT_ORDER_DETAILS,
}
