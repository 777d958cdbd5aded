"""Bronze change logs derived from the driver's TPC-H-like test tables.

The reference ships no sample data; these derivations (documented in
FIXTURES.md) turn ``customer``, ``part``, ``orders`` and ``lineitem`` into the
change-file shape of the four source tables: lower-case source column names,
an ``op`` code and a ``dms_timestamp`` text column, every value text as a CSV
file would carry it.

Each log is built in one scan of its source table: the changes a row causes
are an array of conditional structs, exploded in place. No union of several
scans and no shuffle (nation and region join as broadcast-sized lookups,
which Catalyst picks by their measured size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Change dates of the derived logs.
DAY_INSERT, DAY_UPDATE, DAY_DELETE, DAY_REINSERT = "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"
FULL_LOAD_TS = "2024-01-01 00:00:00"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts_text(day: str) -> Column:
    return F.lit(f"{day} 00:00:00")


def _events(*cands: Column) -> Column:
    """Array of the non-NULL candidate change structs."""
    return F.filter(F.array(*cands), lambda x: x.isNotNull())


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer change log: I for all; U of phone and email for even keys;
    email-only U for keys ending in 1; D for keys ending in 4; re-insert of
    every second deleted key."""
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = load_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    ks = k.cast("string")
    base = (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            k.alias("k"),
            ks.alias("customerid"),
            F.concat(F.lit("Customer N"), ks).alias("name"),
            F.concat(F.lit("c"), ks, F.lit("@email.com")).alias("email"),
            F.concat(F.lit("555-"), ks).alias("phone"),
            F.concat(ks, F.lit(" Main St, "), F.col("n_name"), F.lit(", "), F.col("r_name")).alias("address"),
            F.col("r_name").alias("country"),
            F.col("n_name").alias("city"),
        )
    )

    def ev(op: str, day: str, email: Column, phone: Column) -> Column:
        return F.struct(
            F.lit(op).alias("op"), email.alias("email"), phone.alias("phone"), _ts_text(day).alias("dms_timestamp")
        )

    email, phone = F.col("email"), F.col("phone")
    k = F.col("k")
    changes = _events(
        ev("I", DAY_INSERT, email, phone),
        F.when(k % 2 == 0, ev("U", DAY_UPDATE, F.concat(F.lit("new"), email), F.concat(F.lit("9"), phone))),
        F.when(k % 10 == 1, ev("U", DAY_UPDATE, F.concat(F.lit("only"), email), phone)),
        F.when(k % 10 == 4, ev("D", DAY_DELETE, email, phone)),
        F.when(k % 20 == 4, ev("I", DAY_REINSERT, email, phone)),
    )
    return base.select("*", F.explode(changes).alias("e")).select(
        F.col("e.op").alias("op"), "customerid", "name", F.col("e.email").alias("email"),
        F.col("e.phone").alias("phone"), "address", "country", "city", F.col("e.dms_timestamp").alias("dms_timestamp"),
    )


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product change log: I for all; price + 1 for even keys; an unchanged U
    for keys ending in 1; D for keys ending in 4."""
    p = load_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    k = F.col("p_partkey")

    def price(delta: float) -> Column:
        return (F.col("p_retailprice") + F.lit(delta)).cast("decimal(12,2)").cast("string")

    def ev(op: str, day: str, px: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), px.alias("price"), _ts_text(day).alias("dms_timestamp"))

    changes = _events(
        ev("I", DAY_INSERT, price(0.0)),
        F.when(k % 2 == 0, ev("U", DAY_UPDATE, price(1.0))),
        F.when(k % 10 == 1, ev("U", DAY_UPDATE, price(0.0))),
        F.when(k % 10 == 4, ev("D", DAY_DELETE, price(0.0))),
    )
    return p.select("*", F.explode(changes).alias("e")).select(
        F.col("e.op").alias("op"),
        k.cast("string").alias("productid"),
        F.col("p_name").alias("productname"),
        F.col("p_brand").alias("brandname"),
        F.concat(F.col("p_type"), F.lit(" desc")).alias("productdescription"),
        F.col("e.price").alias("price"),
        F.col("p_type").alias("productcategory"),
        F.col("e.dms_timestamp").alias("dms_timestamp"),
    )


# Payment methods and platforms of the source system.
PAYMENT_METHODS = ("Credit Card", "PayPal", "Bank Transfer")
ORDER_PLATFORMS = ("Website", "Mobile", "In-store")


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders full load: one I per order, order date as source text."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    pay = (
        F.when(k % 20 < 16, PAYMENT_METHODS[0]).when(k % 20 < 19, PAYMENT_METHODS[1]).otherwise(PAYMENT_METHODS[2])
    )
    plat = F.when(k % 10 < 5, ORDER_PLATFORMS[0]).when(k % 10 < 8, ORDER_PLATFORMS[1]).otherwise(ORDER_PLATFORMS[2])
    return o.select(
        F.lit("I").alias("op"),
        k.cast("string").alias("orderid"),
        F.col("o_custkey").cast("string").alias("ordercustomerid"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("orderdate"),
        pay.alias("paymentmethod"),
        plat.alias("orderplatform"),
        F.lit(FULL_LOAD_TS).alias("dms_timestamp"),
    )


def order_detail_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orderDetails full load: one I per line item; the id joins four columns
    because (orderkey, linenumber) alone is not unique in the test data."""
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    return li.select(
        F.lit("I").alias("op"),
        F.concat_ws(
            "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        ).alias("orderdetailsid"),
        F.col("l_orderkey").cast("string").alias("orderid"),
        F.col("l_partkey").cast("string").alias("productid"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.lit(FULL_LOAD_TS).alias("dms_timestamp"),
    )


def product_price_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product change log with one price observation per line item: the
    part's retail price less the line's discount, observed at the ship date.
    Many changes per product and same-day ties; prices are computed in
    integer cents and written as text, so every engine renders them alike."""
    li = load_table(spark, sf_dir, "lineitem").select("l_partkey", "l_discount", "l_shipdate")
    p = load_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    cents = "(CAST(round(p_retailprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) DIV 100)"
    price = F.expr(f"concat(CAST({cents} DIV 100 AS STRING), '.', lpad(CAST({cents} % 100 AS STRING), 2, '0'))")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.lit("U").alias("op"),
        F.col("l_partkey").cast("string").alias("productid"),
        F.col("p_name").alias("productname"),
        F.col("p_brand").alias("brandname"),
        F.concat(F.col("p_type"), F.lit(" desc")).alias("productdescription"),
        price.alias("price"),
        F.col("p_type").alias("productcategory"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("dms_timestamp"),
    )


CHANGE_LOGS = {
    "customer": customer_changes,
    "product": product_changes,
    "orders": order_changes,
    "orderdetails": order_detail_changes,
}
