"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: the change logs as UNION ALL of
selections, the dimension merge as the textbook lag/lead formulation over a
key's whole change history. Time values are rendered as text, as the Spark
side does at the oracle boundary (``plans.oracle_format``).
"""

from __future__ import annotations

RUN_TS = "2024-01-05 00:00:00"
RUN_DATE = "2024-01-05"
TS = "'%Y-%m-%d %H:%M:%S'"
DT = "'%Y-%m-%d'"


def ts(expr: str, alias: str) -> str:
    return f"strftime({expr}, {TS}) AS {alias}"


def dt(expr: str, alias: str) -> str:
    return f"strftime({expr}, {DT}) AS {alias}"


# ---------------------------------------------------------------- bronze logs
BRONZE_CUSTOMER = """
cbase AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS customerid,
         concat('Customer N', CAST(c.c_custkey AS VARCHAR)) AS name,
         concat('c', CAST(c.c_custkey AS VARCHAR), '@email.com') AS email,
         concat('555-', CAST(c.c_custkey AS VARCHAR)) AS phone,
         concat(CAST(c.c_custkey AS VARCHAR), ' Main St, ', n.n_name, ', ', r.r_name) AS address,
         r.r_name AS country, n.n_name AS city, c.c_custkey AS k
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey),
bronze_customer AS (
  SELECT 'I' AS op, customerid, name, email, phone, address, country, city,
         '2024-01-01 00:00:00' AS dms_timestamp FROM cbase
  UNION ALL SELECT 'U', customerid, name, concat('new', email), concat('9', phone), address, country, city,
         '2024-01-02 00:00:00' FROM cbase WHERE k % 2 = 0
  UNION ALL SELECT 'U', customerid, name, concat('only', email), phone, address, country, city,
         '2024-01-02 00:00:00' FROM cbase WHERE k % 10 = 1
  UNION ALL SELECT 'D', customerid, name, email, phone, address, country, city,
         '2024-01-03 00:00:00' FROM cbase WHERE k % 10 = 4
  UNION ALL SELECT 'I', customerid, name, email, phone, address, country, city,
         '2024-01-04 00:00:00' FROM cbase WHERE k % 20 = 4)"""

BRONZE_PRODUCT = """
bronze_product AS (
  SELECT 'I' AS op, CAST(p_partkey AS VARCHAR) AS productid, p_name AS productname, p_brand AS brandname,
         concat(p_type, ' desc') AS productdescription,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price, p_type AS productcategory,
         '2024-01-01 00:00:00' AS dms_timestamp FROM part
  UNION ALL SELECT 'U', CAST(p_partkey AS VARCHAR), p_name, p_brand, concat(p_type, ' desc'),
         CAST(CAST(p_retailprice + 1.0 AS DECIMAL(12,2)) AS VARCHAR), p_type, '2024-01-02 00:00:00'
         FROM part WHERE p_partkey % 2 = 0
  UNION ALL SELECT 'U', CAST(p_partkey AS VARCHAR), p_name, p_brand, concat(p_type, ' desc'),
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), p_type, '2024-01-02 00:00:00'
         FROM part WHERE p_partkey % 10 = 1
  UNION ALL SELECT 'D', CAST(p_partkey AS VARCHAR), p_name, p_brand, concat(p_type, ' desc'),
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), p_type, '2024-01-03 00:00:00'
         FROM part WHERE p_partkey % 10 = 4)"""

BRONZE_ORDERS = """
bronze_orders AS (
  SELECT 'I' AS op, CAST(o_orderkey AS VARCHAR) AS orderid, CAST(o_custkey AS VARCHAR) AS ordercustomerid,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS orderdate,
         CASE WHEN o_orderkey % 20 < 16 THEN 'Credit Card' WHEN o_orderkey % 20 < 19 THEN 'PayPal'
              ELSE 'Bank Transfer' END AS paymentmethod,
         CASE WHEN o_orderkey % 10 < 5 THEN 'Website' WHEN o_orderkey % 10 < 8 THEN 'Mobile'
              ELSE 'In-store' END AS orderplatform,
         '2024-01-01 00:00:00' AS dms_timestamp
  FROM orders)"""

BRONZE_ORDER_DETAILS = """
bronze_orderdetails AS (
  SELECT 'I' AS op,
         concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR)) AS orderdetailsid,
         CAST(l_orderkey AS VARCHAR) AS orderid, CAST(l_partkey AS VARCHAR) AS productid,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
         '2024-01-01 00:00:00' AS dms_timestamp
  FROM lineitem)"""

# ---------------------------------------------------------------- silver
SILVER_CUSTOMER = f"""
silver_customer AS (
  SELECT op AS cdc_operation, customerid AS customer_id, email AS cust_email, phone AS cust_phone,
         address AS cust_address, country AS cust_country, city AS cust_city,
         sha256(concat_ws('', phone, address, country, city, name)) AS hash_value,
         TIMESTAMP '{RUN_TS}' AS record_start_ts, TIMESTAMP '9999-12-31 00:00:00' AS record_end_ts,
         1 AS active_flag, split(name, ' ')[1] AS cust_first_name, split(name, ' ')[2] AS cust_last_name,
         TRY_CAST(dms_timestamp AS TIMESTAMP) AS dms_timestamp, DATE '{RUN_DATE}' AS ingestion_date
  FROM bronze_customer)"""

SILVER_PRODUCT = f"""
silver_product AS (
  SELECT op AS cdc_operation, productid AS product_id, productname AS product_name, brandname AS brand_name,
         productdescription AS product_description,
         CAST(round(TRY_CAST(price AS DECIMAL(38,18)), 2) AS DOUBLE) AS product_price,
         productcategory AS product_category,
         sha256(concat_ws('', productname, brandname, productdescription,
                          trim(price), productcategory)) AS hash_value,
         TIMESTAMP '{RUN_TS}' AS record_start_ts, TIMESTAMP '9999-12-31 00:00:00' AS record_end_ts,
         1 AS active_flag, TRY_CAST(dms_timestamp AS TIMESTAMP) AS dms_timestamp,
         DATE '{RUN_DATE}' AS ingestion_date
  FROM bronze_product)"""

SILVER_ORDERS = f"""
silver_orders AS (
  SELECT orderid AS order_id, ordercustomerid AS order_customer_id, TRY_CAST(orderdate AS DATE) AS order_date,
         paymentmethod AS payment_method, orderplatform AS order_platform,
         CAST(year(TRY_CAST(orderdate AS DATE)) AS INTEGER) AS order_year,
         CAST(month(TRY_CAST(orderdate AS DATE)) AS INTEGER) AS order_month,
         DATE '{RUN_DATE}' AS ingestion_date, TRY_CAST(dms_timestamp AS TIMESTAMP) AS dms_timestamp,
         CAST(year(TRY_CAST(orderdate AS DATE)) AS INTEGER) AS order_year_pk
  FROM bronze_orders)"""

SILVER_ORDER_DETAILS = f"""
silver_orderdetails AS (
  SELECT orderdetailsid AS order_details_id, orderid AS order_id, productid AS product_id,
         TRY_CAST(quantity AS INTEGER) AS product_quantity, DATE '{RUN_DATE}' AS ingestion_date,
         TRY_CAST(dms_timestamp AS TIMESTAMP) AS dms_timestamp, DATE '{RUN_DATE}' AS ingestion_date_pk
  FROM bronze_orderdetails)"""

CUSTOMER_COLS = ["cdc_operation", "customer_id", "cust_email", "cust_phone", "cust_address", "cust_country",
                 "cust_city", "hash_value", "record_start_ts", "record_end_ts", "active_flag", "cust_first_name",
                 "cust_last_name"]
PRODUCT_COLS = ["cdc_operation", "product_id", "product_name", "brand_name", "product_description",
                "product_price", "product_category", "hash_value", "record_start_ts", "record_end_ts",
                "active_flag"]
SILVER_CUSTOMER_COLS = CUSTOMER_COLS + ["dms_timestamp", "ingestion_date"]
SILVER_PRODUCT_COLS = PRODUCT_COLS + ["dms_timestamp", "ingestion_date"]
ORDER_COLS = ["order_id", "order_customer_id", "order_date", "payment_method", "order_platform", "order_year",
              "order_month", "ingestion_date", "dms_timestamp", "order_year_pk"]
ORDER_DETAIL_COLS = ["order_details_id", "order_id", "product_id", "product_quantity", "ingestion_date",
                     "dms_timestamp", "ingestion_date_pk"]

TS_COLS = {"record_start_ts", "record_end_ts", "dms_timestamp", "late_boundary_ts"}
DATE_COLS = {"ingestion_date", "ingestion_date_pk", "order_date"}


def render(cols: list[str], prefix: str = "") -> str:
    out = []
    for c in cols:
        if c in TS_COLS:
            out.append(ts(prefix + c, c))
        elif c in DATE_COLS:
            out.append(dt(prefix + c, c))
        else:
            out.append(prefix + c)
    return ", ".join(out)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# ---------------------------------------------------------------- SCD2
OP_RANK = "CASE cdc_operation WHEN 'D' THEN 2 WHEN 'U' THEN 1 ELSE 0 END"
KEEP = ("((cdc_operation = 'D' AND po IS NOT NULL AND po <> 'D') OR "
        "(cdc_operation <> 'D' AND (po IS NULL OR po = 'D' OR ph <> hash_value)))")


def scd2_ctes(src: str, key: str, prefix: str = "") -> str:
    """Dedupe ties, previous change, keep flag, next kept change."""
    return f"""
{prefix}dd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {key}, dms_timestamp
                                 ORDER BY {OP_RANK} DESC, hash_value DESC) AS rn
    FROM {src} WHERE dms_timestamp IS NOT NULL) WHERE rn = 1),
{prefix}ev AS (
  SELECT *, lag(cdc_operation) OVER w AS po, lag(hash_value) OVER w AS ph FROM {prefix}dd
  WINDOW w AS (PARTITION BY {key} ORDER BY dms_timestamp)),
{prefix}ek AS (SELECT *, {KEEP} AS keep FROM {prefix}ev),
{prefix}vs AS (
  SELECT *, lead(dms_timestamp) OVER (PARTITION BY {key} ORDER BY dms_timestamp) AS nx
  FROM {prefix}ek WHERE keep)"""


def scd2_select(cols: list[str], prefix: str = "", where: str = "") -> str:
    out = []
    for c in cols:
        if c == "record_start_ts":
            out.append(ts("dms_timestamp", c))
        elif c == "record_end_ts":
            out.append(ts("coalesce(nx, TIMESTAMP '9999-12-31 00:00:00')", c))
        elif c == "active_flag":
            out.append("CASE WHEN nx IS NULL THEN 1 ELSE 0 END AS active_flag")
        else:
            out.append(c)
    cond = "cdc_operation <> 'D'" + (f" AND {where}" if where else "")
    return f"SELECT {', '.join(out)} FROM {prefix}vs WHERE {cond}"


DIM_CUSTOMER_SQL = with_(BRONZE_CUSTOMER, SILVER_CUSTOMER, scd2_ctes("silver_customer", "customer_id")) + "\n" + \
    scd2_select(CUSTOMER_COLS)
DIM_PRODUCT_SQL = with_(BRONZE_PRODUCT, SILVER_PRODUCT, scd2_ctes("silver_product", "product_id")) + "\n" + \
    scd2_select(PRODUCT_COLS)
DIM_CUSTOMER_ACTIVE_SQL = with_(BRONZE_CUSTOMER, SILVER_CUSTOMER, scd2_ctes("silver_customer", "customer_id")) + \
    "\n" + scd2_select(CUSTOMER_COLS, where="nx IS NULL")

# Type-1 email: every version carries the email of the last change of its run.
DIM_CUSTOMER_TYPE1_SQL = with_(
    BRONZE_CUSTOMER, SILVER_CUSTOMER, scd2_ctes("silver_customer", "customer_id"),
    """
runs AS (
  SELECT customer_id, dms_timestamp, cust_email,
         max(CASE WHEN keep THEN dms_timestamp END) OVER (
           PARTITION BY customer_id ORDER BY dms_timestamp
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vstart
  FROM ek),
t1 AS (SELECT customer_id, vstart, arg_max(cust_email, dms_timestamp) AS t1_email
       FROM runs WHERE vstart IS NOT NULL GROUP BY customer_id, vstart),
vt AS (SELECT vs.* REPLACE (t1.t1_email AS cust_email) FROM vs
       JOIN t1 ON vs.customer_id = t1.customer_id AND vs.dms_timestamp = t1.vstart)""",
) + "\n" + scd2_select(CUSTOMER_COLS).replace("FROM vs", "FROM vt")

# Late changes: the 2024-01-01 inserts of keys ending in 2 arrive after the
# rest of the log; their keys already have a version from 2024-01-02.
DELAYED = ("(cdc_operation = 'I' AND dms_timestamp = TIMESTAMP '2024-01-01 00:00:00' "
           "AND CAST(customer_id AS BIGINT) % 10 = 2)")
LATE_COLS = [c for c in CUSTOMER_COLS if c not in ("record_start_ts", "record_end_ts", "active_flag")]
LATE_CHANGES_SQL = with_(
    BRONZE_CUSTOMER, SILVER_CUSTOMER,
    f"\nb1 AS (SELECT * FROM silver_customer WHERE NOT {DELAYED})",
    f"\nb2 AS (SELECT * FROM silver_customer WHERE {DELAYED})",
    scd2_ctes("b1", "customer_id"),
    # the boundary is the time of the key's last kept change: the start of its
    # open version, or the delete that closed it
    "\nbnd AS (SELECT customer_id, max(dms_timestamp) AS late_boundary_ts FROM vs GROUP BY customer_id)",
) + f"""
SELECT {render(LATE_COLS, 'b2.')}, {ts('b2.dms_timestamp', 'dms_timestamp')},
       {ts('bnd.late_boundary_ts', 'late_boundary_ts')}
FROM b2 LEFT JOIN bnd ON b2.customer_id = bnd.customer_id
WHERE b2.dms_timestamp IS NULL OR b2.dms_timestamp <= bnd.late_boundary_ts"""


def silver_sql(bronze: str, silver: str, name: str, cols: list[str]) -> str:
    return with_(bronze, silver) + f"\nSELECT {render(cols)} FROM {name}"


SQL: dict[str, str] = {
    "bronze_customer_changes": with_(BRONZE_CUSTOMER) + "\nSELECT op, customerid, name, email, phone, address, "
                                                        "country, city, dms_timestamp FROM bronze_customer",
    "bronze_product_changes": with_(BRONZE_PRODUCT) + "\nSELECT * FROM bronze_product",
    "silver_customer": silver_sql(BRONZE_CUSTOMER, SILVER_CUSTOMER, "silver_customer", SILVER_CUSTOMER_COLS),
    "silver_product": silver_sql(BRONZE_PRODUCT, SILVER_PRODUCT, "silver_product", SILVER_PRODUCT_COLS),
    "silver_orders": silver_sql(BRONZE_ORDERS, SILVER_ORDERS, "silver_orders", ORDER_COLS),
    "silver_order_details": silver_sql(BRONZE_ORDER_DETAILS, SILVER_ORDER_DETAILS, "silver_orderdetails",
                                       ORDER_DETAIL_COLS),
    "customer_hash": with_(BRONZE_CUSTOMER) + f"""
SELECT customerid AS customer_id, {ts('CAST(dms_timestamp AS TIMESTAMP)', 'dms_timestamp')},
       sha256(concat_ws('', phone, address, country, city, name)) AS hash_value,
       sha256(concat_ws(chr(31), coalesce(phone, '\\N'), coalesce(address, '\\N'), coalesce(country, '\\N'),
                        coalesce(city, '\\N'), coalesce(name, '\\N'))) AS hash_value_sep
FROM bronze_customer""",
    "product_hash": with_(BRONZE_PRODUCT) + f"""
SELECT productid AS product_id, {ts('CAST(dms_timestamp AS TIMESTAMP)', 'dms_timestamp')},
       sha256(concat_ws('', productname, brandname, productdescription,
                        trim(price), productcategory)) AS hash_value
FROM bronze_product""",
    "customer_names": """
SELECT c_custkey AS customer_key, c_name AS full_name,
       split(c_name, ' ')[1] AS first_name, split(c_name, ' ')[2] AS last_name,
       concat_ws(' ', c_mktsegment, c_name, 'Jr.') AS titled_name,
       split(concat_ws(' ', c_mktsegment, c_name, 'Jr.'), ' ')[1] AS titled_first_name,
       split(concat_ws(' ', c_mktsegment, c_name, 'Jr.'), ' ')[2] AS titled_last_name
FROM customer""",
    "orders_sorted": silver_sql(BRONZE_ORDERS, SILVER_ORDERS, "silver_orders", ORDER_COLS)
    + " ORDER BY order_date DESC",
    "dim_customer_scd2": DIM_CUSTOMER_SQL,
    "dim_product_scd2": DIM_PRODUCT_SQL,
    "dim_customer_active": DIM_CUSTOMER_ACTIVE_SQL,
    "dim_customer_type1": DIM_CUSTOMER_TYPE1_SQL,
    "late_changes": LATE_CHANGES_SQL,
}


STAGE_CUSTOMER_SQL = silver_sql(BRONZE_CUSTOMER, SILVER_CUSTOMER, "silver_customer", CUSTOMER_COLS)
STAGE_PRODUCT_SQL = silver_sql(BRONZE_PRODUCT, SILVER_PRODUCT, "silver_product", PRODUCT_COLS)
FACT_ORDER_COLS = ["order_id", "order_customer_id", "order_date", "payment_method", "order_platform",
                   "order_year", "order_month", "ingestion_date"]
FACT_DETAIL_COLS = ["order_details_id", "order_id", "product_id", "product_quantity", "ingestion_date"]


def _counts(rows: list[tuple[str, str, str]]) -> str:
    """UNION ALL of (layer, table_name, count over a CTE)."""
    return "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS rows FROM {src}"
        for layer, table, src in rows
    )


ALL_CTES = [BRONZE_CUSTOMER, BRONZE_PRODUCT, BRONZE_ORDERS, BRONZE_ORDER_DETAILS, SILVER_CUSTOMER, SILVER_PRODUCT,
            SILVER_ORDERS, SILVER_ORDER_DETAILS,
            scd2_ctes("silver_customer", "customer_id", "c_"), scd2_ctes("silver_product", "product_id", "p_")]

PIPELINE_COUNTS_SQL = with_(*ALL_CTES) + "\n" + _counts([
    ("bronze", "customer", "bronze_customer"), ("silver", "customer", "silver_customer"),
    ("bronze", "product", "bronze_product"), ("silver", "product", "silver_product"),
    ("bronze", "orders", "bronze_orders"), ("silver", "orders", "silver_orders"),
    ("bronze", "orderdetails", "bronze_orderdetails"), ("silver", "orderdetails", "silver_orderdetails"),
    ("stage", "stage_dim_customer", "silver_customer"),
    ("dimension", "dim_customer", "c_vs WHERE cdc_operation <> 'D'"),
    ("dimension_active", "dim_customer", "c_vs WHERE cdc_operation <> 'D' AND nx IS NULL"),
    ("stage", "stage_dim_product", "silver_product"),
    ("dimension", "dim_product", "p_vs WHERE cdc_operation <> 'D'"),
    ("dimension_active", "dim_product", "p_vs WHERE cdc_operation <> 'D' AND nx IS NULL"),
    ("fact", "fact_orders", "silver_orders"),
    ("fact", "fact_order_details", "silver_orderdetails"),
])

LOAD_REPORT_SQL = with_(BRONZE_CUSTOMER, BRONZE_PRODUCT, BRONZE_ORDERS, BRONZE_ORDER_DETAILS) + """
SELECT 'stage_dim_customer' AS table_name, count(*) AS rows_read, count(*) AS rows_written,
       'truncate_load' AS load_mode, CAST(0 AS BIGINT) AS null_values FROM bronze_customer
UNION ALL SELECT 'stage_dim_product', count(*), count(*), 'truncate_load',
                 count(*) FILTER (TRY_CAST(price AS DECIMAL(38,18)) IS NULL) FROM bronze_product
UNION ALL SELECT 'fact_orders', count(*), count(*), 'append', count(*) FILTER (CAST(orderid AS BIGINT) % 7 = 0
                 OR TRY_CAST(orderdate AS DATE) IS NULL) FROM bronze_orders
UNION ALL SELECT 'fact_order_details', count(*), count(*), 'append',
                 count(*) FILTER (TRY_CAST(quantity AS INTEGER) IS NULL) FROM bronze_orderdetails"""

SQL.update({
    "dim_customer_scd2_incremental": DIM_CUSTOMER_SQL,
    "dim_customer_compacted": DIM_CUSTOMER_SQL,
    "bronze_csv_roundtrip": SQL["bronze_customer_changes"],
    "incremental_customer": SQL["silver_customer"],
    "silver_orders_partitions": with_(BRONZE_ORDERS, SILVER_ORDERS) + """
SELECT order_year_pk, count(*) AS rows, strftime(min(order_date), '%Y-%m-%d') AS first_order_date,
       strftime(max(order_date), '%Y-%m-%d') AS last_order_date
FROM silver_orders GROUP BY order_year_pk""",
    "stage_customer": STAGE_CUSTOMER_SQL,
    "stage_product": STAGE_PRODUCT_SQL,
    "fact_orders": silver_sql(BRONZE_ORDERS, SILVER_ORDERS, "silver_orders", FACT_ORDER_COLS),
    "fact_order_details": silver_sql(BRONZE_ORDER_DETAILS, SILVER_ORDER_DETAILS, "silver_orderdetails",
                                     FACT_DETAIL_COLS),
    "load_report": LOAD_REPORT_SQL,
    "layer_counts": PIPELINE_COUNTS_SQL,
    "snapshot_export_product": f"""
SELECT 'I' AS op, CAST(p_partkey AS VARCHAR) AS productid, p_name AS productname, p_brand AS brandname,
       concat(p_type, ' desc') AS productdescription, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
       p_type AS productcategory, '{RUN_TS}' AS dms_timestamp
FROM part""",
})


# Product price history: one price observation per line item (cents, as text).
PRICE_FEED = """
bronze_product AS (
  SELECT 'U' AS op, CAST(l_partkey AS VARCHAR) AS productid, p_name AS productname, p_brand AS brandname,
         concat(p_type, ' desc') AS productdescription,
         concat(CAST(cents // 100 AS VARCHAR), '.', lpad(CAST(cents % 100 AS VARCHAR), 2, '0')) AS price,
         p_type AS productcategory, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS dms_timestamp
  FROM (SELECT l_partkey, l_shipdate, p_name, p_brand, p_type,
               CAST(round(p_retailprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) // 100
                 AS cents
        FROM lineitem JOIN part ON l_partkey = p_partkey))"""

SQL["dim_product_price_history"] = with_(PRICE_FEED, SILVER_PRODUCT, scd2_ctes("silver_product", "product_id")) + \
    "\n" + scd2_select(PRODUCT_COLS)


# Every third product's price observations on product 3, and one of 1901.
HOT_FEED = PRICE_FEED.replace("bronze_product AS (", "feed AS (", 1) + """,
bronze_product AS (
  SELECT * REPLACE (CASE WHEN CAST(productid AS BIGINT) % 3 = 0 THEN '3' ELSE productid END AS productid) FROM feed
  UNION ALL SELECT * REPLACE ('1901-01-01 00:00:00' AS dms_timestamp)
  FROM (SELECT * FROM feed WHERE productid = '3' ORDER BY dms_timestamp, price LIMIT 1))"""

SQL["dim_product_hot_key"] = with_(HOT_FEED, SILVER_PRODUCT, scd2_ctes("silver_product", "product_id")) + \
    "\n" + scd2_select(PRODUCT_COLS)
SQL["dim_customer_type1_chunked"] = DIM_CUSTOMER_TYPE1_SQL
SQL["fact_orders_truncate_load"] = SQL["fact_orders"]
SQL["table_statistics"] = """
SELECT 'stage_dim_customer' AS table_name, (SELECT count(*) FROM bronze_customer) AS rows, 'customer_id' AS column_name,
       true AS has_column_statistics
UNION ALL SELECT 'stage_dim_product', (SELECT count(*) FROM bronze_product), 'product_id', true
UNION ALL SELECT 'fact_orders', (SELECT count(*) FROM orders), NULL, false
UNION ALL SELECT 'fact_order_details', (SELECT count(*) FROM lineitem), NULL, false"""
SQL["table_statistics"] = with_(BRONZE_CUSTOMER, BRONZE_PRODUCT) + SQL["table_statistics"]
SQL["silver_product_prices"] = """
WITH p AS (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part),
t AS (SELECT *, concat(CAST(cents // 100 + (p_partkey % 3) * 100000000 AS VARCHAR), '.',
               lpad(CAST(cents % 100 AS VARCHAR), 2, '0'), lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')) AS price FROM p)
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(round(CAST(price AS DECIMAL(38,18)), 2) AS DOUBLE) AS product_price,
       sha256(concat_ws('', p_name, p_brand, p_type, price, p_type)) AS hash_value
FROM t"""
_INT, _STR, _TS, _DATE = "int", "string", "timestamp", "date"
_SCHEMAS = {  # fixed values: input columns of the loads
    "stage_dim_customer": [(c, _INT if c == "active_flag" else _TS if c.endswith("_ts") or c == "dms_timestamp" else
                            _DATE if c == "ingestion_date" else _STR) for c in SILVER_CUSTOMER_COLS],
    "stage_dim_product": [(c, _INT if c == "active_flag" else "double" if c == "product_price" else
                           _TS if c.endswith("_ts") or c == "dms_timestamp" else
                           _DATE if c == "ingestion_date" else _STR) for c in SILVER_PRODUCT_COLS],
    "fact_orders": [(c, _INT if c.startswith(("order_year", "order_month")) else _TS if c == "dms_timestamp" else
                     _DATE if c.endswith("_date") else _STR) for c in ORDER_COLS],
    "fact_order_details": [(c, _INT if c == "product_quantity" else _TS if c == "dms_timestamp" else
                            _DATE if c.startswith("ingestion_date") else _STR) for c in ORDER_DETAIL_COLS],
}
SQL["load_schemas"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{d}' AS data_type"
    for t, cols in _SCHEMAS.items() for i, (c, d) in enumerate(cols))
SQL["retry_after_failure"] = SQL["silver_customer"]
SQL["silver_after_lost_checkpoint"] = SQL["silver_customer"]
SQL["fact_after_lost_checkpoint"] = SQL["fact_orders"]
SQL["fact_replay_after_read"] = SQL["fact_orders"]
SQL["pipeline_stops"] = with_(BRONZE_CUSTOMER, BRONZE_PRODUCT, BRONZE_ORDER_DETAILS) + """
SELECT 'silver' AS layer, 'customer' AS table_name, (SELECT count(*) FROM bronze_customer) AS rows, true AS stopped
UNION ALL SELECT 'silver', 'product', (SELECT count(*) FROM bronze_product), true
UNION ALL SELECT 'silver', 'orders', 0, true
UNION ALL SELECT 'silver', 'orderdetails', (SELECT count(*) FROM bronze_orderdetails), true
UNION ALL SELECT 'warehouse', 'stage_dim_customer', 0, true UNION ALL SELECT 'warehouse', 'stage_dim_product', 0, true
UNION ALL SELECT 'warehouse', 'fact_orders', 0, true UNION ALL SELECT 'warehouse', 'fact_order_details', 0, true"""

# Three headers: what silver has no place for, as JSON with its names in order.
_RESCUED_SILVER = SILVER_PRODUCT.replace("AS ingestion_date\n  FROM bronze_product", "AS ingestion_date, rescued FROM changed")
SQL["silver_three_headers"] = with_(BRONZE_PRODUCT, """
keyed AS (SELECT *, CAST(productid AS BIGINT) AS k FROM bronze_product),
parts AS (SELECT *, CASE WHEN k % 3 = 2 THEN concat('"colour":"c', k % 5, '"') END AS colour,
         CASE WHEN k % 7 = 0 THEN concat('"price":"about ', price, '"') END AS about FROM keyed),
changed AS (SELECT * REPLACE (CASE WHEN k % 7 = 0 THEN concat('about ', price) ELSE price END AS price),
         CASE WHEN colour IS NOT NULL OR about IS NOT NULL THEN concat('{', concat_ws(',', colour, about), '}') END AS rescued
         FROM parts)""", _RESCUED_SILVER) + f"\nSELECT {render(SILVER_PRODUCT_COLS)}, rescued FROM silver_product"
_PRICE = "concat('decimal(', max(length(split_part(price, '.', 1))) + 2, ',2)')"
_CRAWLED = {
    "customer": ["op", "customerid bigint", "name", "email", "phone", "address", "country", "city", "dms_timestamp timestamp"],
    "product": ["op", "productid bigint", "productname", "brandname", "productdescription", "price", "productcategory",
                "dms_timestamp timestamp"],
    "orders": ["op", "orderid bigint", "ordercustomerid bigint", "orderdate timestamp", "paymentmethod", "orderplatform",
               "dms_timestamp timestamp"],
    "orderdetails": ["op", "orderdetailsid", "orderid bigint", "productid bigint", "quantity bigint", "dms_timestamp timestamp"],
}
SQL["schema_crawl"] = with_(BRONZE_CUSTOMER, BRONZE_PRODUCT, BRONZE_ORDERS, BRONZE_ORDER_DETAILS) + "\nUNION ALL ".join(
    f"""
SELECT '{t}' AS table_name, CAST({k} AS INTEGER) AS position, '{c}' AS column_name,
       {_PRICE if c == "price" else f"'{kind or 'string'}'"} AS data_type,
       count(*) FILTER ({c} IS NULL OR trim({c}) = '') > 0 AS nullable, count(*) AS rows,
       count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS missing FROM bronze_{t}"""
    for t, cols in _CRAWLED.items() for k, (c, _, kind) in enumerate(x.partition(" ") for x in cols))

_FACTS = {"fact_orders": ("silver_orders", FACT_ORDER_COLS), "fact_order_details": ("silver_orderdetails", FACT_DETAIL_COLS)}
_NUMBERED = {"order_date", "order_year", "order_month", "ingestion_date", "product_quantity"}  # columns with quantiles
SQL["fact_column_statistics"] = with_(BRONZE_ORDERS, BRONZE_ORDER_DETAILS, SILVER_ORDERS, SILVER_ORDER_DETAILS) + "\nUNION ALL ".join(
    f"""
SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls,
       CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS distinct_values,
       true AS distinct_within, {"'true'" if c in _NUMBERED else "'none'"} AS quantiles_within FROM {src}"""
    for t, (src, cols) in _FACTS.items() for c in cols)

_BAD_DATE = "CAST(orderid AS BIGINT) % 7 = 0 OR TRY_CAST(orderdate AS DATE) IS NULL"
SQL["load_journal"] = with_(BRONZE_ORDERS) + f"""
SELECT 'run' AS kind, name, CAST(number AS BIGINT) AS number, status, CAST(batches AS BIGINT) AS batches,
       CAST(0 AS BIGINT) AS rows_written, CAST(0 AS BIGINT) AS null_values
FROM (VALUES ('silver_orders', 1, 'ended', 1), ('silver_orders', 2, 'ended', 1), ('fact_orders', 1, 'ended', 1),
             ('fact_orders', 2, 'failed', 0), ('fact_orders', 3, 'ended', 1)) AS r(name, number, status, batches)
UNION ALL SELECT 'load', 'fact_orders', CAST(CAST(orderid AS BIGINT) % 3 = 0 AS BIGINT), 'durable', 0, count(*),
       count(*) FILTER ({_BAD_DATE}) FROM bronze_orders GROUP BY CAST(orderid AS BIGINT) % 3 = 0"""
SQL["snapshot_tables_like"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'I' AS op, '{RUN_TS}' AS dms_timestamp, count(*) AS rows, CAST(min({k}) AS BIGINT) AS least_key FROM {t}"
    for t, k in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("supplier", "s_suppkey")))
