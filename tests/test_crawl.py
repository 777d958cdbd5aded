"""Schema crawl, headers in one pass, rescued data."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from starling.functions.rescue import RESCUED
from starling.operators.rename import MissingColumnsError
from starling.operators.silver import silver_rescued
from starling.schemas import BRONZE_COLUMNS
from starling.sources.bronze import read_bronze_by_name
from starling.sources.crawl import crawl, crawl_files, merge, register_typed_view
from starling.sources.headers import header_groups


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}.csv.gz", "wt", encoding="utf-8") as f:
        f.write(text)
    return f"{folder}/{name}.csv.gz"


def types(df):
    return {r.column_name: (r.data_type, r.nullable, r.files, r.rows, r.missing) for r in df.collect()}


def test_types_are_folded_over_files(spark, local_tmp):
    put(local_tmp, "a", "i,d,x,day,t,mix,n,big\n1,1.50,1e3,2024-01-01,2024-01-01 10:00:00,2024-01-01,,9223372036854775807\n"
                        "-7,,2,2024-02-29,2024-01-01,5,,1\n")
    put(local_tmp, "b", "I,D,X,day,t,mix,n,big,more\n+3,20,7.25,2024-03-01,2024-01-02T11:00,z,,9223372036854775808,q\n")
    got = types(crawl(spark, local_tmp))
    assert got == {"i": ("bigint", False, 2, 3, 0), "d": ("decimal(4,2)", True, 2, 3, 1), "x": ("double", False, 2, 3, 0),
                   "day": ("date", False, 2, 3, 0), "t": ("timestamp", False, 2, 3, 0), "mix": ("string", False, 2, 3, 0),
                   "n": ("void", True, 2, 3, 3), "big": ("decimal(19,0)", False, 2, 3, 0), "more": ("string", True, 1, 1, 0)}
    assert [r.column_name for r in crawl(spark, local_tmp).orderBy("position", "column_name").collect()][:3] == ["i", "d", "x"]


def test_crawls_can_be_merged(spark, local_tmp):
    one, two = put(local_tmp, "a", "v,w\n1,x\n"), put(local_tmp, "b", "w,v\ny,2.5\n")
    apart = merge(crawl_files(spark, [one]).unionByName(crawl_files(spark, [two])))
    assert types(apart) == types(crawl(spark, local_tmp)) == {"v": ("decimal(2,1)", False, 2, 2, 0), "w": ("string", False, 2, 2, 0)}


def test_typed_view(spark, local_tmp):
    path = put(local_tmp, "a", "v,w,e,d\n1, x ,,2024-01-01\n2.5,y,,\n")
    raw = read_bronze_by_name(spark, [path], ["v", "w", "e", "d"])
    register_typed_view(spark, "typed_changes", raw, crawl(spark, local_tmp))
    view = spark.table("typed_changes")
    assert [t for _, t in view.dtypes] == ["decimal(2,1)", "string", "string", "date"]
    assert [(str(r.v), r.w, r.e, str(r.d)) for r in view.orderBy("v").collect()] == [
        ("1.0", " x ", None, "2024-01-01"), ("2.5", "y", None, "None")]


def test_headers_of_many_files_in_one_job(spark, local_tmp):
    for i in range(600):
        put(local_tmp, f"f{i}", ("a,b\n" if i % 3 else "﻿B,a,\"c,d\"\n") + "1,2,3\n" * (i % 2))
    open(f"{local_tmp}/empty.csv", "w").close()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "first lines")
    try:
        groups = header_groups(spark, local_tmp)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {k: len(v) for k, v in groups.items()} == {("a", "b"): 400, ("b", "a", "c,d"): 200}
    assert len(tracker.getJobIdsForGroup("headers")) <= 3  # the scan, and the plan's stages after it


def test_nothing_is_lost_on_the_way_to_silver(spark, local_tmp):
    agreed = BRONZE_COLUMNS["product"]
    row = {"op": "I", "productid": "1", "productname": "n", "brandname": "b", "productdescription": "d", "price": "9.5",
           "productcategory": "c", "dms_timestamp": "2024-01-01 00:00:00"}

    def file(name, columns, **changed):
        return put(local_tmp, name, ",".join(columns) + "\n" + ",".join((row | changed)[c] for c in columns) + "\n")

    paths = [file("a", agreed), file("b", agreed[::-1], productid="2", price="cheap"),
             file("c", [*agreed, "colour", "Size"], productid="3", colour="red", Size="", price="1,5".replace(",", "_")),
             file("d", agreed, productid="4", price="", dms_timestamp="soon")]
    bronze = read_bronze_by_name(spark, paths, agreed, rescue=True)
    silver = silver_rescued("product", bronze, run_ts="2024-01-05 00:00:00")
    silver.write.parquet(local_tmp + "/out")
    back = spark.read.parquet(local_tmp + "/out")
    got = {r.product_id: (r.product_price, r.j and json.loads(r.j)) for r in back.withColumn("j", F.to_json(RESCUED)).collect()}
    assert got == {"1": (9.5, None), "2": (None, {"price": "cheap"}), "3": (None, {"colour": "red", "price": "1_5"}),
                   "4": (None, {"dms_timestamp": "soon"})}
    assert back.selectExpr(f"variant_get({RESCUED}, '$.colour', 'string') AS c").where("c = 'red'").count() == 1
    with pytest.raises(MissingColumnsError):
        read_bronze_by_name(spark, [put(local_tmp + "/m", "x", "op,price\nI,1\n")], agreed)
