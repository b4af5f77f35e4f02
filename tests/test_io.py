"""Source / sink side effects: managed tables, JDBC (embedded Derby, no
port), bucketing, dynamic partition overwrite, file filters, catalog."""

import contextlib
import io
import os
import uuid

import pytest
from pyspark.sql import functions as F


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def test_table_roundtrip_and_catalog(spark, sf_dir):
    name = _name("marquee_nation")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    nation.write.mode("overwrite").format("parquet").saveAsTable(name)
    assert spark.catalog.tableExists(name)
    assert spark.table(name).count() == nation.count()
    nation.limit(3).write.insertInto(name)
    assert spark.table(name).count() == nation.count() + 3
    cols = {c.name for c in spark.catalog.listColumns(name)}
    assert cols == set(nation.columns)
    spark.catalog.cacheTable(name)
    assert spark.catalog.isCached(name)
    spark.catalog.uncacheTable(name)
    spark.catalog.refreshTable(name)
    assert any(tb.name == name for tb in spark.catalog.listTables())
    assert spark.catalog.databaseExists("default")
    assert spark.catalog.functionExists("upper")
    nation.createOrReplaceTempView(name + "_v")
    assert spark.catalog.dropTempView(name + "_v")
    spark.sql(f"DROP TABLE {name}")


def test_jdbc_roundtrip_embedded_derby(spark, sf_dir, scratch):
    url = f"jdbc:derby:{os.path.join(scratch, 'db')};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    movies = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("ID"), F.col("source").alias("TITLE"), F.col("n_chars").alias("DURATION"))
    try:
        movies.write.jdbc(url, "movies", mode="overwrite", properties=props)
    except Exception as e:  # driver missing on this build
        pytest.skip(f"Derby driver unavailable: {str(e)[:80]}")
    back = spark.read.jdbc(url, "movies", column="ID", lowerBound=0, upperBound=1000, numPartitions=4, properties=props)
    assert back.count() == movies.count()
    assert back.rdd.getNumPartitions() == 4
    # append twice, then read with predicates (one partition per predicate)
    movies.write.jdbc(url, "movies", mode="append", properties=props)
    parts = spark.read.jdbc(url, "movies", predicates=["ID < 100", "ID >= 100"], properties=props)
    assert parts.count() == 2 * movies.count()


def test_bucketed_write_avoids_shuffle(spark, sf_dir):
    a, b = _name("marquee_li_b"), _name("marquee_ord_b")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_quantity")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    li.write.bucketBy(8, "l_orderkey").sortBy("l_orderkey").mode("overwrite").saveAsTable(a)
    o.write.bucketBy(8, "o_orderkey").sortBy("o_orderkey").mode("overwrite").saveAsTable(b)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(a).join(spark.table(b), F.col("l_orderkey") == F.col("o_orderkey"))
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        assert "Exchange hashpartitioning" not in buf.getvalue()
        assert j.count() == li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE {a}")
        spark.sql(f"DROP TABLE {b}")


def test_dynamic_partition_overwrite(spark, sf_dir, scratch):
    path = os.path.join(scratch, "orders")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    o.write.partitionBy("o_orderstatus").parquet(path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        o.where("o_orderstatus = 'F'").limit(5).write.mode("overwrite").partitionBy("o_orderstatus").parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    back = spark.read.parquet(path)
    assert back.where("o_orderstatus = 'F'").count() == 5
    assert back.where("o_orderstatus = 'O'").count() == o.where("o_orderstatus = 'O'").count()


def test_v2_writer_and_partition_transforms(spark, sf_dir):
    name = _name("marquee_v2")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type")
    ev.writeTo(name).using("parquet").partitionedBy("event_type").create()
    # the built-in catalog holds v1 tables: appends go through insertInto
    ev.limit(10).select("event_id", "event_type").write.insertInto(name)
    assert spark.table(name).count() == ev.count() + 10
    spark.sql(f"DROP TABLE {name}")
    # transform expressions exist (a V2 catalog is needed to apply them)
    for f in (F.years("ts"), F.months("ts"), F.days("ts"), F.hours("ts"), F.bucket(4, "event_id")):
        assert f is not None


def test_file_filters(spark, scratch):
    base = os.path.join(scratch, "files")
    os.makedirs(os.path.join(base, "nested"))
    for p, txt in (("a.txt", "one"), ("b.csv", "x,y"), ("nested/c.txt", "two")):
        with open(os.path.join(base, p), "w") as f:
            f.write(txt + "\n")
    got = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").text(base)
    assert sorted(r.value for r in got.collect()) == ["one", "two"]
    whole = spark.read.text(os.path.join(base, "a.txt"), wholetext=True)
    assert whole.first().value == "one\n"
    old = spark.read.option("modifiedBefore", "2000-01-01T00:00:00").option("pathGlobFilter", "*.txt").text(base)
    assert old.count() == 0


def test_libsvm_and_binary_sources(spark, scratch):
    p = os.path.join(scratch, "d.libsvm")
    with open(p, "w") as f:
        f.write("1 1:0.5 3:1.0\n0 2:2.0\n")
    df = spark.read.format("libsvm").option("numFeatures", "3").load(p)
    assert df.count() == 2 and df.schema["features"] is not None
    b = spark.read.format("binaryFile").load(p)
    assert b.first().length > 0
