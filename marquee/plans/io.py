"""Sources and sinks (§2.1): generic reader, parquet / JSON / CSV /
text / ORC round trips, partitioned writes, SQL on files, schema merge,
text → typed rows, DDL tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from marquee.plans.registry import query
from marquee.sources.files import round_trip, scratch_path


@query("scan_generic", oracle="SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def scan_generic(t):
    """format().schema().options().load() with an explicit schema; the
    filter reaches the parquet scan (PushedFilters)."""
    path = os.path.join(t.sf_dir, "orders.parquet")
    df = (t.spark.read.format("parquet").schema("o_orderkey long, o_orderstatus string")
          .options(mergeSchema="false").load(path))
    return df.where(F.col("o_orderstatus") == "P")


@query("scan_parquet", oracle="""
SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_shipdate >= TIMESTAMP '1997-01-01'
""")
def scan_parquet(t):
    li = t.spark.read.parquet(os.path.join(t.sf_dir, "lineitem.parquet"))
    return (li.where((F.col("l_quantity") > 45) & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp")))
            .select("l_orderkey", "l_quantity"))


_CUST = "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment FROM customer"


def _cust(t):
    return t.customer.select("c_custkey", "c_name", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"), "c_mktsegment")


@query("roundtrip_json", oracle=_CUST)
def roundtrip_json(t):
    df = _cust(t)
    return round_trip(df, "json", "customer-json", read_schema=df.schema, write_options={"compression": "gzip"})


@query("roundtrip_csv", oracle=_CUST)
def roundtrip_csv(t):
    df = _cust(t)
    return round_trip(df, "csv", "customer-csv", read_schema=df.schema,
                      write_options={"header": "true", "sep": ";", "quoteAll": "true"},
                      read_options={"header": "true", "sep": ";", "mode": "FAILFAST"})


@query("roundtrip_text", oracle="SELECT c_custkey, c_name, c_mktsegment FROM customer")
def roundtrip_text(t):
    """Text lines (one record per line, custom separator) and back."""
    lines = t.customer.select(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value"))
    back = round_trip(lines, "text", "customer-text", write_options={"compression": "gzip"})
    parts = F.split("value", r"\|")
    return back.select(parts[0].cast("bigint").alias("c_custkey"), parts[1].alias("c_name"), parts[2].alias("c_mktsegment"))


@query("roundtrip_orc", oracle=_CUST)
def roundtrip_orc(t):
    return round_trip(_cust(t), "orc", "customer-orc", write_options={"compression": "zstd"})


@query("partitioned_write", oracle="""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
""")
def partitioned_write(t):
    """partitionBy on write; the read prunes partitions (only the
    matching directories are listed and scanned)."""
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    back = round_trip(o, "parquet", "orders-part", partition_by=["o_orderstatus", "o_orderpriority"])
    return back.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")) \
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("sql_on_file", oracle="SELECT n_name, n_regionkey FROM nation WHERE n_regionkey = 1")
def sql_on_file(t):
    path = os.path.join(t.sf_dir, "nation.parquet")
    return t.spark.sql(f"SELECT n_name, n_regionkey FROM parquet.`{path}` WHERE n_regionkey = 1")


@query("schema_merge", oracle="""
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, NULL::VARCHAR AS o_orderpriority, 'F' AS o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL::DOUBLE, o_orderpriority, 'O' FROM orders WHERE o_orderstatus = 'O'
""")
def schema_merge(t):
    """Two partitions written with different columns, read back with
    ``mergeSchema``: missing columns are null."""
    path = scratch_path(t.spark, "orders-merge")
    o = t.orders
    o.where("o_orderstatus = 'F'").select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice")) \
        .write.mode("overwrite").parquet(os.path.join(path, "o_orderstatus=F"))
    o.where("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority") \
        .write.mode("overwrite").parquet(os.path.join(path, "o_orderstatus=O"))
    return t.spark.read.option("mergeSchema", "true").parquet(path).select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")


@query("text_to_rows", oracle="SELECT c_name AS name, CAST(c_nationkey AS INTEGER) AS age FROM customer")
def text_to_rows(t):
    """'name, age' text lines → typed rows (split + cast; schema given
    programmatically)."""
    lines = t.customer.select(F.concat_ws(", ", "c_name", F.col("c_nationkey").cast("string")).alias("value"))
    parts = F.split("value", ", ")
    return lines.select(parts[0].alias("name"), F.trim(parts[1]).cast("int").alias("age"))


@query("ddl_join", oracle="""
SELECT k.key, k.value, n_name FROM (SELECT n_nationkey AS key, 'val_' || CAST(n_nationkey AS VARCHAR) AS value FROM nation) k
JOIN nation ON k.key = n_nationkey WHERE k.key < 10
""")
def ddl_join(t):
    """CREATE TABLE … USING parquet, INSERT, then a SQL join."""
    spark = t.spark
    loc = scratch_path(spark, "kv")
    spark.sql("DROP TABLE IF EXISTS marquee_kv")
    spark.sql(f"CREATE TABLE marquee_kv (key INT, value STRING) USING parquet LOCATION '{loc}'")
    t.nation.createOrReplaceTempView("marquee_nation_src")
    spark.sql("INSERT OVERWRITE marquee_kv SELECT n_nationkey, concat('val_', n_nationkey) FROM marquee_nation_src")
    return spark.sql("""SELECT k.key, k.value, n.n_name FROM marquee_kv k JOIN marquee_nation_src n
                        ON k.key = n.n_nationkey WHERE k.key < 10""")
