"""Matrices, neighbours, experiments, labelled frames, categories and the
replacement of stored data, over the driver tables."""

from __future__ import annotations

import random

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from marquee.operators import abtest, categories, frames, linalg, neighbours
from marquee.plans.registry import query
from marquee.sources import infer, replace
from marquee.sources.files import read_sound, round_trip, scratch_path


# ---------------------------------------------------------------- matrices
@query("svd_left", oracle="""
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) AS energy FROM embeddings
""")
def svd_left(t):
    """Left singular vectors of the embedding matrix, block by block.  Scaled
    by the singular values they have the length of their rows, whatever the
    right vectors are."""
    e = t.embeddings.select("vec_id", "embedding")
    f = linalg.svd(e, "embedding")
    s = F.array(*[F.lit(float(x)) for x in f.s])
    return f.u.select("vec_id", F.round(F.aggregate(F.zip_with("u", s, lambda u, x: u * u * x * x), F.lit(0.0), lambda a, x: a + x), 4).alias("energy"))


@query("svd_values")
def svd_values(t):
    """The ten largest singular values, as the lengths of the scores X V."""
    e = t.embeddings.select("vec_id", "embedding")
    f = linalg.svd(e, "embedding", k=10, compute_u=False)
    scores = linalg.project(e, "embedding", f.v, "score")
    row = scores.agg(*[F.sqrt(F.sum(F.col("score")[i] * F.col("score")[i])).alias(str(i)) for i in range(len(f.s))])
    return row.select(F.posexplode(F.array(*[F.col(str(i)) for i in range(len(f.s))])).alias("rank", "value"))


@query("pca_scores")
def pca_scores(t):
    """Scores of the centred vectors on the first three principal components."""
    e = t.embeddings.select("vec_id", "embedding")
    p = linalg.pca(e, "embedding", 3)
    return linalg.project(e, "embedding", p.components, "score", p.mean).select("vec_id", "score")


# ---------------------------------------------------------------- neighbours
@query("ann_lookup")
def ann_lookup(t):
    """About the ten nearest vectors to every vector whose id is divisible
    by 50, among all vectors."""
    e = t.embeddings.select("vec_id", "embedding")
    return neighbours.nearest(e, e.where("vec_id % 50 = 0"), "vec_id", "embedding", k=10)


# ---------------------------------------------------------------- experiments
# two-sided probability by Simpson's rule over the density of Student's t
_T_SQL = """1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) * (abs(statistic) / 2000) / 3 *
  list_sum(list_transform(range(0, 2001), lambda i: (CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
    * pow(1 + pow(abs(statistic) * i / 2000, 2) / df, -(df + 1) / 2)))"""


@query("ab_test", oracle=f"""
WITH day AS (SELECT CAST(ts AS DATE) AS period, count(*) FILTER (user_id % 2 = 0) AS nc, count(*) FILTER (user_id % 2 = 1) AS ne,
    coalesce(sum(value) FILTER (user_id % 2 = 0), 0) AS sc, coalesce(sum(value) FILTER (user_id % 2 = 1), 0) AS se,
    coalesce(sum(value * value) FILTER (user_id % 2 = 0), 0) AS qc, coalesce(sum(value * value) FILTER (user_id % 2 = 1), 0) AS qe
  FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL GROUP BY 1),
late AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY period) AS i FROM day) WHERE i > 2),
run AS (SELECT period, sum(nc) OVER w AS nc, sum(ne) OVER w AS ne, sum(sc) OVER w AS sc, sum(se) OVER w AS se, sum(qc) OVER w AS qc, sum(qe) OVER w AS qe
  FROM late WINDOW w AS (ORDER BY period ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
v AS (SELECT *, (qc - sc * sc / nc) / (nc - 1) AS vc, (qe - se * se / ne) / (ne - 1) AS ve FROM run),
st AS (SELECT *, (se / ne - sc / nc) / sqrt(ve / ne + vc / nc) AS statistic,
  pow(ve / ne + vc / nc, 2) / (pow(ve / ne, 2) / (ne - 1) + pow(vc / nc, 2) / (nc - 1)) AS df FROM v)
SELECT period, CAST(nc AS BIGINT) AS n_control, CAST(ne AS BIGINT) AS n_experiment, round(statistic, 6) AS statistic, round(df, 4) AS df, round({_T_SQL}, 6) AS p_value FROM st
""")
def ab_test(t):
    """Welch's test of event values, odd against even users: two days of
    peace, then the last seven days for each day."""
    m = abtest.moments(t.events.where("value is not null"), F.to_date("ts"), F.col("user_id") % 2 == 1, F.col("value"))
    r = abtest.test(m, peace=2, window=7)
    return r.select("period", "n_control", "n_experiment", F.round("statistic", 6).alias("statistic"), F.round("df", 4).alias("df"), F.round("p_value", 6).alias("p_value"))


# ---------------------------------------------------------------- replacement
def _orders(t, name):
    path = scratch_path(t.spark, name)
    o = t.orders.select("o_orderkey", F.round("o_totalprice", 2).alias("price"), "o_orderpriority", "o_orderstatus")
    o.write.partitionBy("o_orderstatus", "o_orderpriority").parquet(path)
    return path, o


@query("overwrite_partitions", oracle="""
SELECT o_orderkey, round(o_totalprice, 2) AS price, o_orderpriority, o_orderstatus FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
UNION ALL SELECT -o_orderkey, 0.5, o_orderpriority, 'F' FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 50000
""")
def overwrite_partitions(t):
    """Two partitions of stored orders are replaced, the others stay."""
    path, o = _orders(t, "orders-dynamic")
    new = (o.where("o_orderstatus = 'O' and o_orderpriority in ('1-URGENT', '2-HIGH') and price > 50000")
           .select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit(0.5).alias("price"), "o_orderpriority", F.lit("F").alias("o_orderstatus")))
    replace.overwrite_partitions(new, path, ["o_orderstatus", "o_orderpriority"])
    return t.spark.read.parquet(path).select("o_orderkey", "price", "o_orderpriority", "o_orderstatus")


@query("overwrite_where", oracle="""
SELECT o_orderkey, round(o_totalprice, 2) AS price, o_orderpriority, o_orderstatus FROM orders
WHERE NOT (o_orderstatus = 'P' OR (o_orderpriority = '5-LOW' AND round(o_totalprice, 2) < 100000))
UNION ALL SELECT -o_orderkey, 0.25, '5-LOW', 'F' FROM orders WHERE o_orderstatus = 'P'
""")
def overwrite_where(t):
    """Rows that meet a condition on partitions and values make way for others."""
    path, o = _orders(t, "orders-where")
    new = o.where("o_orderstatus = 'P'").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit(0.25).alias("price"),
                                                F.lit("5-LOW").alias("o_orderpriority"), F.lit("F").alias("o_orderstatus"))
    replace.overwrite_where(new, path, ["o_orderstatus", "o_orderpriority"], "o_orderstatus = 'P' or (o_orderpriority = '5-LOW' and price < 100000)")
    return t.spark.read.parquet(path).select("o_orderkey", "price", "o_orderpriority", "o_orderstatus")


@query("table_replace", oracle="SELECT s_suppkey, s_name, CAST(count(*) AS BIGINT) AS n_lines FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1, 2")
def table_replace(t):
    """A table is created, then replaced by one with another schema."""
    location = scratch_path(t.spark, "suppliers")
    name = "marquee_" + location.rsplit("-", 1)[-1]
    replace.create_or_replace(t.supplier, name, location)
    new = t.supplier.join(t.lineitem, F.col("s_suppkey") == F.col("l_suppkey")).groupBy("s_suppkey", "s_name").agg(F.count("*").alias("n_lines"))
    replace.create_or_replace(new, name, location)
    return t.spark.table(name)


# ---------------------------------------------------------------- labelled frames
_LABEL = "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey END"


def _spend(t, since, until, *aggs):
    o = t.orders.where((F.col("o_orderdate") >= F.lit(since).cast("timestamp")) & (F.col("o_orderdate") < F.lit(until).cast("timestamp")))
    return o.groupBy(F.expr(_LABEL).alias("label")).agg(*aggs)


def _spend_sql(since, until, aggs):
    return f"(SELECT {_LABEL} AS label, {aggs} FROM orders WHERE o_orderdate >= TIMESTAMP '{since}' AND o_orderdate < TIMESTAMP '{until}' GROUP BY 1)"


_LATEST = "max(o_orderkey) AS latest"


@query("frame_align", oracle=f"""
SELECT CASE WHEN a.n IS NULL THEN b.label ELSE a.label END AS label, a.n AS n_left, b.n AS n_right, a.latest AS latest_left, NULL::BIGINT AS latest_right,
  NULL::BIGINT AS first_left, b.first AS first_right
FROM {_spend_sql('1995-01-01', '1996-01-01', 'count(*) AS n, max(o_orderkey) AS latest')} a
FULL JOIN {_spend_sql('1997-01-01', '1998-01-01', 'count(*) AS n, min(o_orderkey) AS first')} b ON a.label IS NOT DISTINCT FROM b.label
""")
def frame_align(t):
    """Customers' orders of two years over one set of labels and columns;
    customers of one year alone, and the NULL label, on both sides."""
    a = _spend(t, "1995-01-01", "1996-01-01", F.count("*").alias("n"), F.max("o_orderkey").alias("latest"))
    b = _spend(t, "1997-01-01", "1998-01-01", F.count("*").alias("n"), F.min("o_orderkey").alias("first"))
    return frames.align(a, b, "label")


@query("frame_compare", oracle="""
SELECT p_partkey, CASE WHEN ds THEN p_size END AS p_size_self, CASE WHEN ds THEN size2 END AS p_size_other,
  CASE WHEN db THEN p_brand END AS p_brand_self, CASE WHEN db THEN brand2 END AS p_brand_other
FROM (SELECT *, p_size IS DISTINCT FROM size2 AS ds, p_brand IS DISTINCT FROM brand2 AS db FROM (
  SELECT p_partkey, p_size, p_brand, nullif(p_size, 10) AS size2, CASE WHEN p_partkey % 7 = 0 THEN 'none' ELSE p_brand END AS brand2 FROM part)) WHERE ds OR db
""")
def frame_compare(t):
    """Cells in which two versions of the parts differ; a column without a
    difference goes."""
    a = t.part.select("p_partkey", "p_size", "p_brand", "p_name")
    b = a.withColumn("p_size", F.nullif("p_size", F.lit(10))).withColumn("p_brand", F.when(F.col("p_partkey") % 7 == 0, "none").otherwise(F.col("p_brand")))
    return frames.compare(a, b, "p_partkey")


@query("frame_dot", oracle="""
WITH w AS (SELECT o_orderstatus AS s, count(*) / 1000.0::DOUBLE AS w1, avg(o_totalprice) / 1e5 AS w2 FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
l AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY 1)
SELECT o_custkey, round(f * (SELECT w1 FROM w WHERE s = 'F') + o * (SELECT w1 FROM w WHERE s = 'O'), 6) AS w1,
  round(f * (SELECT w2 FROM w WHERE s = 'F') + o * (SELECT w2 FROM w WHERE s = 'O'), 6) AS w2 FROM l
""")
def frame_dot(t):
    """Counts of each customer's orders by status times weights of the
    statuses; 'P' has no weights, 'Z' no counts."""
    left = t.orders.groupBy("o_custkey").agg(*[F.sum(F.when(F.col("o_orderstatus") == s, 1).otherwise(0)).alias(s) for s in "FOP"])
    right = (t.orders.where("o_orderstatus <> 'P'").groupBy(F.col("o_orderstatus").alias("status"))
             .agg((F.count("*") / 1000.0).alias("w1"), (F.avg("o_totalprice") / 1e5).alias("w2")))
    right = right.unionByName(t.nation.agg(F.lit("Z").alias("status"), F.count("*").cast("double").alias("w1"), F.lit(1.0).alias("w2")))
    r = frames.frame_dot(left, right, "o_custkey", "status", missing="zero")
    return r.select("o_custkey", F.round("w1", 6).alias("w1"), F.round("w2", 6).alias("w2"))


@query("series_dot", oracle=f"""
SELECT CAST(sum(a.n * b.n) AS DOUBLE) AS dot FROM {_spend_sql('1995-01-01', '1996-01-01', 'count(*) AS n')} a
JOIN {_spend_sql('1997-01-01', '1998-01-01', 'count(*) AS n')} b ON a.label IS NOT DISTINCT FROM b.label
""")
def series_dot(t):
    """Orders of one year times orders of another, over the labels of both."""
    a, b = (_spend(t, f"{y}-01-01", f"{y + 1}-01-01", F.count("*").cast("double").alias("n")) for y in (1995, 1997))
    return frames.series_dot(a, b, "label", "n", "n", missing="zero")


# ---------------------------------------------------------------- inferred types
@query("csv_infer", oracle="""
SELECT c_custkey, c_name || chr(10) || c_mktsegment AS note, c_custkey % 2 = 0 AS even, DATE '2000-01-01' + CAST(c_custkey % 900 AS INTEGER) AS day,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS DOUBLE) ELSE c_custkey + 0.5 END AS mixed_number,
  CASE WHEN c_custkey % 10 = 0 THEN 'none' ELSE CAST(c_custkey AS VARCHAR) END AS mixed, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS nation,
  CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2001-02-03 00:00:00' ELSE TIMESTAMP '2001-02-03 04:05:06' END AS moment FROM customer
""")
def csv_infer(t):
    """Columns of mixed values, texts with line ends: types from all rows."""
    k = F.col("c_custkey")
    d = t.customer.select(
        k.cast("string").alias("c_custkey"), F.concat("c_name", F.lit("\n"), "c_mktsegment").alias("note"), (k % 2 == 0).cast("string").alias("even"),
        F.date_add(F.lit("2000-01-01").cast("date"), (k % 900).cast("int")).cast("string").alias("day"),
        F.when(k % 2 == 0, k.cast("string")).otherwise((k + 0.5).cast("string")).alias("mixed_number"),
        F.when(k % 10 == 0, "none").otherwise(k.cast("string")).alias("mixed"), F.when(k % 3 != 0, F.col("c_nationkey").cast("string")).alias("nation"),
        F.when(k % 5 == 0, "2001-02-03").otherwise("2001-02-03 04:05:06").alias("moment"))
    path = scratch_path(t.spark, "customer-mixed")
    d.write.option("header", "true").csv(path)
    return infer.read_csv(t.spark, path, multiLine="true")


@query("json_multiline", oracle="SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS nation FROM customer")
def json_multiline(t):
    """Records spread over many lines: arrays of customers, a file each of
    about a thousand, types from all records."""
    c = t.customer.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("nation"))
    files = max(1, t.customer.count() // 1_000)
    rows = c.groupBy(F.pmod("c_custkey", F.lit(files)).alias("part")).agg(F.collect_list(F.struct(*c.columns)).alias("r"))
    path = scratch_path(t.spark, "customer-lines")
    rows.select("part", F.to_json("r", {"pretty": "true"}).alias("value")).repartition("part").write.partitionBy("part").text(path)
    back = t.spark.read.option("multiLine", "true").option("samplingRatio", "1.0").json(path)
    return back.select("c_custkey", "c_name", "c_acctbal", F.col("nation").cast("int"))


@query("orc_bloom", oracle="SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_partkey = 77")
def orc_bloom(t):
    """A key looked up in ORC files with bloom filters and dictionaries:
    row groups whose filter lacks it are not read."""
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    back = round_trip(d, "orc", "lineitem-bloom", read_schema=d.schema, write_options={
        "orc.bloom.filter.columns": "l_partkey", "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": "1000", "orc.dictionary.key.threshold": "1.0", "compression": "zstd"})
    return back.where("l_partkey = 77")


@query("read_sound", oracle="SELECT c_custkey, c_name, 1::BIGINT AS n_broken FROM customer")
def read_sound_(t):
    """A broken file between sound ones costs its own rows and is reported."""
    path = scratch_path(t.spark, "customer-sound")
    c = t.customer.select("c_custkey", "c_name")
    c.write.parquet(path)
    replace.Folder(t.spark, path).write("broken.parquet", "PAR1 this is no footer PAR1")
    rows, report = read_sound(t.spark, path, "parquet", c.schema)
    return rows.crossJoin(F.broadcast(report.agg(F.count("fault").alias("n_broken"))))


# ---------------------------------------------------------------- categories, user-defined types and functions
PRIORITIES = ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query("category_codes", oracle="""
SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '3-MEDIUM' THEN 0 WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 ELSE -1 END AS INTEGER) AS code,
  CASE o_orderpriority WHEN '3-MEDIUM' THEN 'middle' WHEN '5-LOW' THEN '5-LOW' WHEN '1-URGENT' THEN '1-URGENT' WHEN '2-HIGH' THEN '2-HIGH' END AS name,
  o_orderpriority IN ('3-MEDIUM', '5-LOW') AS below_high, CAST(n AS BIGINT) AS n
FROM orders LEFT JOIN (SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') GROUP BY 1) ON p = o_orderpriority
""")
def category_codes(t):
    """Ordered categories: one is missing (code -1), one is added and never
    used, one renamed; the order is changed, and the codes joined on."""
    d = categories.encode(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), "o_orderpriority", PRIORITIES, ordered=True)
    d = categories.rename(categories.add(d, "o_orderpriority", ["6-NONE"]), "o_orderpriority", {"3-MEDIUM": "middle"})
    d = categories.reorder(d, "o_orderpriority", ["middle", "5-LOW", "2-HIGH", "1-URGENT", "6-NONE"])
    counts = d.where("o_orderstatus = 'F' and o_orderpriority >= 0").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    j = d.join(counts, "o_orderpriority", "left")
    return categories.decode(j.withColumn("code", F.col("o_orderpriority")).withColumn("below_high", categories.below(j, "o_orderpriority", "2-HIGH")), "o_orderpriority") \
        .select("o_orderkey", "code", F.col("o_orderpriority").alias("name"), "below_high", "n")


@query("udt_round_trip", oracle="SELECT vec_id, len(embedding)::INTEGER AS size, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total FROM embeddings")
def udt_round_trip(t):
    """Vectors (a user-defined type) stored, read back and unwrapped."""
    d = t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    back = round_trip(d, "parquet", "vectors").select("vec_id", F.unwrap_udt("v").alias("v"))
    return back.select("vec_id", F.size("v.values").alias("size"), F.round(F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("udf_nondeterministic", oracle="SELECT o_orderkey, true AS once, true AS inside FROM orders")
def udf_nondeterministic(t):
    """A random function is evaluated once a row, however often its value is
    used: the optimiser neither repeats it nor moves filters across it."""
    ticket = F.udf(lambda key: random.random(), "double", useArrow=True).asNondeterministic()  # noqa: S311
    d = t.orders.select("o_orderkey", ticket("o_orderkey").alias("x"))
    d = d.select("o_orderkey", F.col("x").alias("a"), (F.col("x") * 2).alias("b"))
    return d.select("o_orderkey", (F.col("a") * 2 == F.col("b")).alias("once"), F.col("a").between(0, 1).alias("inside"))


@query("select_shape", oracle="SELECT s_suppkey::VARCHAR AS key, s_name AS name, s_nationkey::BIGINT AS nation FROM supplier")
def select_shape(t):
    """colRegex, to (a schema: order, types) and toDF (names)."""
    d = t.supplier.select(t.supplier.colRegex("`s_(name|suppkey|nationkey)`"))
    return d.to(_schema("s_suppkey string, s_name string, s_nationkey bigint")).toDF("key", "name", "nation")


def _schema(text: str):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(text)
