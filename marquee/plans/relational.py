"""Projection, filter, shape, dedup, sort/limit and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from marquee.operators import timeseries as TS
from marquee.operators.relational import dedup_keep_first
from marquee.plans.registry import query


def r(c, n=2):
    return F.round(c, n)


def money(c):
    """Exact decimal arithmetic for currency (rounding agrees across engines)."""
    return F.col(c).cast("decimal(15,2)")


# ---------------------------------------------------------------- §2.2
@query("project", oracle="""
SELECT l_orderkey AS orderkey, l_linenumber,
  CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))), 2) AS DOUBLE) AS disc_price,
  CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))
             * (1 + CAST(l_tax AS DECIMAL(15,2))), 2) AS DOUBLE) AS charge,
  l_quantity + 1 AS qty_plus_one, CAST(l_linenumber * 2 AS INTEGER) AS twice, -l_quantity AS neg_qty,
  l_quantity > 25 AND l_discount < 0.05 AS big_cheap, CAST(l_linenumber AS BIGINT) & 3 AS low_bits
FROM lineitem
""")
def project(t):
    li = t.lineitem
    price, disc, tax = (money("l_extendedprice"), money("l_discount"), money("l_tax"))
    out = (li.withColumn("disc_price", F.round(price * (1 - disc), 2).cast("double"))
           .withColumns({"charge": F.round(price * (1 - disc) * (1 + tax), 2).cast("double"),
                         "qty_plus_one": F.col("l_quantity") + 1})
           .selectExpr("l_orderkey", "l_linenumber", "disc_price", "charge", "qty_plus_one",
                       "l_linenumber * 2 AS twice", "-l_quantity AS neg_qty",
                       "l_quantity > 25 AND l_discount < 0.05 AS big_cheap",
                       "CAST(l_linenumber AS BIGINT) & 3 AS low_bits")
           .withColumnRenamed("l_orderkey", "orderkey"))
    return out.transform(lambda d: d.drop("nothing_to_drop"))


@query("filter", oracle="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
  AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24
""")
def filter_(t):
    li = t.lineitem
    return (li.filter((F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp"))
                      & (F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp")))
            .where(F.col("l_discount").between(0.05, 0.07))
            .where("l_quantity < 24")
            .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("pred_string", oracle="""
SELECT p_partkey, p_name LIKE '%green%' AS has_green, regexp_matches(p_name, '^[a-m]') AS a_to_m,
  p_name ILIKE '%GREEN%' AS has_green_ci, substring(p_name, 2, 5) AS sub,
  contains(p_type, 'BRASS') AS brass, starts_with(p_brand, 'Brand#1') AS b1, ends_with(p_type, 'TIN') AS tin
FROM part
""")
def pred_string(t):
    p = t.part
    return p.select("p_partkey", p.p_name.like("%green%").alias("has_green"),
                    p.p_name.rlike("^[a-m]").alias("a_to_m"),
                    p.p_name.ilike("%GREEN%").alias("has_green_ci"),
                    p.p_name.substr(2, 5).alias("sub"),
                    p.p_type.contains("BRASS").alias("brass"),
                    p.p_brand.startswith("Brand#1").alias("b1"),
                    p.p_type.endswith("TIN").alias("tin"))


@query("pred_membership", oracle="""
SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent,
  o_totalprice BETWEEN 100000 AND 200000 AS mid, nullif(o_custkey % 5, 0) IS NULL AS cust_null,
  nullif(o_custkey % 5, 0) IS NOT NULL AS cust_set
FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def pred_membership(t):
    o = t.orders
    c = F.nullif(o.o_custkey % 5, F.lit(0))
    return (o.where(o.o_orderstatus.isin("F", "O"))
            .select("o_orderkey", o.o_orderpriority.isin(["1-URGENT", "2-HIGH"]).alias("urgent"),
                    o.o_totalprice.between(100000, 200000).alias("mid"),
                    c.isNull().alias("cust_null"), c.isNotNull().alias("cust_set")))


@query("case_when", oracle="""
SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 200000 THEN 'mid'
  ELSE 'high' END AS tier, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS status_code
FROM orders
""")
def case_when(t):
    o = t.orders
    tier = (F.when(o.o_totalprice < 50000, "low").when(o.o_totalprice < 200000, "mid").otherwise("high"))
    code = F.when(o.o_orderstatus == "F", 1).when(o.o_orderstatus == "O", 2)
    return o.select("o_orderkey", tier.alias("tier"), code.alias("status_code"))


@query("null_safe_eq", oracle="""
SELECT c_custkey, a, b, a = b AS eq, a IS NOT DISTINCT FROM b AS eq_null_safe FROM (
  SELECT c_custkey, CAST(nullif(c_nationkey % 3, 0) AS INTEGER) AS a,
         CAST(nullif(c_custkey % 3, 0) AS BIGINT) AS b FROM customer)
""")
def null_safe_eq(t):
    c = t.customer
    d = c.select("c_custkey", F.nullif(c.c_nationkey % 3, F.lit(0)).alias("a"),
                 F.nullif(c.c_custkey % 3, F.lit(0)).alias("b"))
    return d.select("c_custkey", "a", "b", (d.a == d.b).alias("eq"), d.a.eqNullSafe(d.b).alias("eq_null_safe"))


@query("cast", oracle="""
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text, TRY_CAST(o_orderpriority AS INTEGER) AS prio_num,
  TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS prio_digit,
  CAST(floor(o_totalprice) AS BIGINT) AS price_floor, CAST(o_orderdate AS DATE) AS odate,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS odate_text, CAST(o_custkey AS DOUBLE) AS cust_double
FROM orders
""")
def cast(t):
    o = t.orders
    return o.select("o_orderkey", o.o_orderkey.cast("string").alias("key_text"),
                    o.o_orderpriority.try_cast("int").alias("prio_num"),
                    o.o_orderpriority.substr(1, 1).try_cast("int").alias("prio_digit"),
                    F.floor(o.o_totalprice).cast("bigint").alias("price_floor"),
                    o.o_orderdate.cast("date").alias("odate"),
                    o.o_orderdate.cast("date").cast("string").alias("odate_text"),
                    o.o_custkey.cast("double").alias("cust_double"))


@query("struct_edit", oracle="""
SELECT c_custkey, c_name AS name, c_nationkey * 10 AS nation10, c_mktsegment AS seg,
  c_name || '/' || c_mktsegment AS label FROM customer
""")
def struct_edit(t):
    c = t.customer
    s = F.struct("c_name", "c_nationkey", "c_acctbal")
    d = c.select("c_custkey", "c_mktsegment", s.alias("s"))
    d = d.withColumn("s", F.col("s").withField("nation10", F.col("s.c_nationkey") * 10)
                     .withField("seg", F.col("c_mktsegment")).dropFields("c_acctbal", "c_nationkey"))
    d = d.withColumn("s", F.col("s").withField("label", F.concat_ws("/", F.col("s").getField("c_name"), F.col("s.seg"))))
    return d.select("c_custkey", F.col("s").getField("c_name").alias("name"), F.col("s.nation10").alias("nation10"),
                    F.col("s")["seg"].alias("seg"), "s.label")


def _nulls(t):
    o = t.orders
    return o.select("o_orderkey",
                    F.nullif(o.o_custkey % 7, F.lit(0)).alias("a"),
                    F.when(o.o_orderkey % 5 == 0, F.lit(None)).otherwise(o.o_orderpriority).alias("prio"),
                    F.when(o.o_orderkey % 3 == 0, F.lit(None)).otherwise(F.round(o.o_totalprice, 2)).alias("price"))


_NULLS_SQL = """(SELECT o_orderkey, nullif(o_custkey % 7, 0) AS a,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS prio,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS price FROM orders)"""


@query("na_drop", oracle=f"""
SELECT * FROM {_NULLS_SQL} WHERE (CASE WHEN a IS NULL THEN 0 ELSE 1 END) + (CASE WHEN prio IS NULL THEN 0 ELSE 1 END)
  + (CASE WHEN price IS NULL THEN 0 ELSE 1 END) + 1 >= 3
""")
def na_drop(t):
    return _nulls(t).dropna(thresh=3)


@query("na_fill", oracle=f"""
SELECT o_orderkey, coalesce(a, -1) AS a, coalesce(prio, 'none') AS prio, coalesce(price, 0.0) AS price FROM {_NULLS_SQL}
""")
def na_fill(t):
    return _nulls(t).fillna(-1, subset=["a"]).na.fill({"prio": "none", "price": 0.0})


@query("na_replace", oracle="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '5-LOW' THEN 'LOW'
  ELSE o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders
""")
def na_replace(t):
    return (t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
            .replace({"1-URGENT": "URGENT", "5-LOW": "LOW"}, subset=["o_orderpriority"]))


@query("unpivot", oracle="""
SELECT l_orderkey, l_linenumber, metric, round(val, 2) AS val FROM (
  UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem)
  ON l_quantity, l_extendedprice, l_discount INTO NAME metric VALUE val)
""")
def unpivot(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    return (li.unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount"],
                       "metric", "val").withColumn("val", r(F.col("val"))))


@query("pivot", oracle="""
SELECT l_returnflag, round(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 2) AS "F",
  round(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 2) AS "O" FROM lineitem GROUP BY l_returnflag
""")
def pivot(t):
    p = t.lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity"))
    return p.select("l_returnflag", r(F.col("F")).alias("F"), r(F.col("O")).alias("O"))


@query("explode", oracle="""
SELECT p_partkey, pos, word, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words FROM (
  SELECT p_partkey, p_name, unnest(string_split(p_name, ' ')) AS word,
         CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INTEGER) AS pos FROM part)
""")
def explode(t):
    p = t.part
    return p.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word"),
                    F.size(F.split("p_name", " ")).alias("n_words"))


@query("explode_outer", oracle="""
SELECT p_partkey, pos, word FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN [] WHEN p_partkey % 3 = 1 THEN string_split(p_name, ' ') END AS w FROM part),
  LATERAL (SELECT * FROM (SELECT unnest(w) AS word, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos) UNION ALL SELECT NULL, NULL WHERE coalesce(len(w), 0) = 0)
""")
def explode_outer(t):
    """explode_outer / posexplode_outer: empty and NULL arrays keep their row."""
    k = F.col("p_partkey") % 3
    w = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.split("p_name", " "))
    p = t.part.select("p_partkey", w.alias("w"))
    pos = p.select("p_partkey", F.posexplode_outer("w").alias("pos", "word"))
    plain = p.select("p_partkey", F.explode_outer("w").alias("word"))
    # both keep the same rows: an outer explode without positions adds none
    return pos.join(plain.select("p_partkey").distinct(), "p_partkey", "left_semi")


@query("inline", oracle="""
SELECT o_orderkey, u.a AS a, u.b AS b, 'inner' AS kind FROM (SELECT o_orderkey, unnest([{'a': o_orderkey % 7, 'b': o_orderstatus}, {'a': o_custkey, 'b': 'x'}]) AS u
  FROM orders WHERE o_orderkey % 2 = 0)
UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, 'outer' FROM orders
""")
def inline(t):
    """inline / inline_outer: arrays of structs to rows and columns."""
    even = F.col("o_orderkey") % 2 == 0
    pair = F.array(F.struct((F.col("o_orderkey") % 7).alias("a"), F.col("o_orderstatus").alias("b")),
                   F.struct(F.col("o_custkey").alias("a"), F.lit("x").alias("b")))
    one = F.when(even, F.array(F.struct(F.col("o_custkey").alias("a"), F.col("o_orderstatus").alias("b"))))
    inner = t.orders.select("o_orderkey", F.inline(F.when(even, pair))).withColumn("kind", F.lit("inner"))
    return inner.unionByName(t.orders.select("o_orderkey", F.inline_outer(one)).withColumn("kind", F.lit("outer")))


@query("repartition", oracle="""
SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY l_suppkey
""")
def repartition(t):
    """Content is invariant to hash / range repartitioning and sorting
    inside partitions; the aggregate reuses the hash partitioning on
    ``l_suppkey`` (no second shuffle)."""
    li = t.lineitem.select("l_suppkey", "l_quantity")
    li = li.repartitionByRange(8, "l_suppkey").sortWithinPartitions("l_suppkey").repartition(8, "l_suppkey")
    return li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity")).alias("qty"))


@query("distinct", oracle="SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query("drop_duplicates", oracle="""
SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey
""")
def drop_duplicates(t):
    """Deterministic ``dropDuplicates(['o_custkey'])``: keep the first
    order per customer, reduced map-side (no per-key window)."""
    return dedup_keep_first(t.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey")


@query("global_view", oracle="""
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def global_view(t):
    t.customer.createOrReplaceGlobalTempView("marquee_customer")
    t.nation.createOrReplaceTempView("marquee_nation")
    return t.spark.sql("""SELECT n_name, count(*) AS customers FROM global_temp.marquee_customer
                          JOIN marquee_nation ON c_nationkey = n_nationkey GROUP BY n_name""")


@query("sql_params", oracle="""
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 150000 AND o_orderstatus = 'O'
GROUP BY o_orderpriority
""")
def sql_params(t):
    t.orders.createOrReplaceTempView("marquee_orders")
    return t.spark.sql("""SELECT o_orderpriority, count(*) AS n FROM marquee_orders
                          WHERE o_totalprice > :price AND o_orderstatus = :status GROUP BY o_orderpriority""",
                       args={"price": 150000, "status": "O"})


# ---------------------------------------------------------------- §2.6
@query("sort", oracle="""
SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS price, nullif(o_orderpriority, '1-URGENT') AS prio FROM orders
ORDER BY prio ASC NULLS FIRST, price DESC, o_orderkey
""")
def sort(t):
    """Global sort (range-partitioned, no single-task collect)."""
    o = t.orders.select("o_orderkey", "o_custkey", r(F.col("o_totalprice")).alias("price"),
                        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("prio"))
    return o.orderBy(F.asc_nulls_first("prio"), F.desc("price"), F.asc("o_orderkey"))


_NULL_ORDERS = (("asc_nulls_first", "ASC NULLS FIRST"), ("asc_nulls_last", "ASC NULLS LAST"),
                ("desc_nulls_first", "DESC NULLS FIRST"), ("desc_nulls_last", "DESC NULLS LAST"))


@query("sort_nulls", oracle="SELECT o_orderkey, " + ", ".join(
    f"CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderpriority, '1-URGENT') {sql}, o_orderkey) AS INTEGER) AS {name}"
    for name, sql in _NULL_ORDERS) + " FROM orders")
def sort_nulls(t):
    """The four null orders, as row numbers within a customer's orders."""
    prio = F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT"))
    o = t.orders.select("o_orderkey", "o_custkey", prio.alias("prio"))
    by = Window.partitionBy("o_custkey")
    return o.select("o_orderkey", *[F.row_number().over(by.orderBy(getattr(F, name)("prio"), "o_orderkey")).alias(name) for name, _ in _NULL_ORDERS])


@query("limit", oracle="SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50")
def limit(t):
    return t.orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(50)


@query("topk", oracle="""
SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def topk(t):
    """Top-k: sort+limit plans as TakeOrderedAndProject (per-partition
    heaps, k rows shuffled per partition)."""
    return (t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
            .select("o_orderkey", r(F.col("o_totalprice")).alias("price")))


# ---------------------------------------------------------------- §2.7
_A = "SELECT c_nationkey AS k, c_mktsegment AS seg FROM customer WHERE c_acctbal > 5000"
_B = "SELECT s_nationkey AS k, 'BUILDING' AS seg FROM supplier"


def _ab(t):
    c = t.customer.where("c_acctbal > 5000").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    s = t.supplier.select(F.col("s_nationkey").alias("k"), F.lit("BUILDING").alias("seg"))
    return c, s


@query("union_all", oracle=f"{_A} UNION ALL {_B}")
def union_all(t):
    a, b = _ab(t)
    return a.union(b)


@query("union_by_name", oracle="""
SELECT c_custkey AS id, c_name AS name, NULL::DOUBLE AS bal, 'c' AS src FROM customer
UNION ALL SELECT s_suppkey AS id, s_name AS name, round(s_acctbal, 2) AS bal, 's' AS src FROM supplier
""")
def union_by_name(t):
    c = t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), F.lit("c").alias("src"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), r(F.col("s_acctbal")).alias("bal"),
                          F.col("s_name").alias("name"), F.lit("s").alias("src"))
    return c.unionByName(s, allowMissingColumns=True)


@query("union_distinct", oracle=f"{_A} UNION {_B}")
def union_distinct(t):
    a, b = _ab(t)
    return a.union(b).distinct()


@query("intersect", oracle=f"{_A} INTERSECT {_B}")
def intersect(t):
    a, b = _ab(t)
    return a.intersect(b)


@query("intersect_all", oracle=f"{_A} INTERSECT ALL {_B}")
def intersect_all(t):
    a, b = _ab(t)
    return a.intersectAll(b)


@query("except_distinct", oracle=f"{_A} EXCEPT {_B}")
def except_distinct(t):
    a, b = _ab(t)
    return a.subtract(b)


@query("except_all", oracle=f"{_A} EXCEPT ALL {_B}")
def except_all(t):
    a, b = _ab(t)
    return a.exceptAll(b)


@query("concat", oracle="""
SELECT o_orderkey AS id, 'order' AS kind, round(o_totalprice, 2) AS amount, NULL::VARCHAR AS flag FROM orders
UNION ALL BY NAME
SELECT l_orderkey AS id, 'line' AS kind, round(l_extendedprice, 2) AS amount, l_returnflag AS flag FROM lineitem
""")
def concat(t):
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"),
                        r(F.col("o_totalprice")).alias("amount"))
    li = t.lineitem.select(F.col("l_returnflag").alias("flag"), F.col("l_orderkey").alias("id"),
                           F.lit("line").alias("kind"), r(F.col("l_extendedprice")).alias("amount"))
    return o.unionByName(li, allowMissingColumns=True)


@query("range_source", oracle="""
SELECT d.day, coalesce(n, 0) AS n FROM range(1, 32) AS d(day)
LEFT JOIN (SELECT CAST(dayofmonth(l_shipdate) AS BIGINT) AS day, count(*) AS n FROM lineitem GROUP BY 1) c USING (day)
""")
def range_source(t):
    """A generated calendar (``spark.range``) left-joined with per-day
    counts; the calendar is bounded (31 rows), so it is broadcast."""
    days = t.spark.range(1, 32).withColumnRenamed("id", "day")
    per_day = (t.lineitem.groupBy(F.dayofmonth("l_shipdate").cast("bigint").alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    return (per_day.join(F.broadcast(days), "day", "right")
            .select("day", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


@query("join_cross", oracle="""
SELECT f.l_returnflag, s.l_linestatus FROM (SELECT DISTINCT l_returnflag FROM lineitem) f
CROSS JOIN (SELECT DISTINCT l_linestatus FROM lineitem) s
""")
def join_cross(t):
    """Cartesian product of two domains (each bounded by its distinct
    values, so the product is bounded whatever the row count)."""
    f = t.lineitem.select("l_returnflag").distinct()
    s = t.lineitem.select("l_linestatus").distinct()
    return f.crossJoin(s)


# ---------------------------------------------------------------- sampling and ids (rows-only)
@query("sample")
def sample(t):
    """Bernoulli sample (fraction 0.1, seeded) — a sampling operator,
    so dropping rows is the feature."""
    return t.orders.select("o_orderkey", "o_orderstatus").sample(withReplacement=False, fraction=0.1, seed=7)


@query("sample_by")
def sample_by(t):
    """Stratified sample: one fraction per status."""
    return t.orders.select("o_orderkey", "o_orderstatus").sampleBy("o_orderstatus", {"F": 0.1, "O": 0.2, "P": 0.5}, seed=7)


@query("random_split")
def random_split(t):
    """randomSplit 70/30; both parts returned with their split tag (the
    parts are disjoint and cover every row)."""
    a, b = t.orders.select("o_orderkey").randomSplit([0.7, 0.3], seed=7)
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))


@query("hash_sample")
def hash_sample(t):
    """Deterministic 10 % sample by key hash: the same keys are chosen
    whatever the partitioning or retry."""
    return t.lineitem.select("l_orderkey", "l_linenumber").where(F.pmod(F.xxhash64("l_orderkey"), F.lit(100)) < 10)


@query("observe", oracle="SELECT o_orderkey, o_totalprice FROM orders")
def observe(t):
    """Metrics collected on the side of a query (named observation: the
    metrics reach query listeners; an ``Observation`` object can be used
    the same way, see tests)."""
    return t.orders.select("o_orderkey", "o_totalprice").observe(
        "order_stats", F.count(F.lit(1)).alias("rows"), F.max("o_totalprice").alias("max_price"))


@query("range_sort")
def range_sort(t):
    """repartitionAndSortWithinPartitions / sortByKey: range partitions
    (sampled bounds), sorted inside each partition — globally ordered by
    (partition, position) without a single-task sort."""
    li = t.lineitem.select("l_orderkey", "l_linenumber")
    return li.repartitionByRange(8, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber") \
        .withColumn("pid", F.spark_partition_id())


@query("row_index", oracle="SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders")
def row_index(t):
    """zipWithIndex: consecutive 0-based row numbers without a global
    window: one range-partitioned pass, offsets from the rows of earlier
    partitions."""
    base = t.orders.select("o_orderkey").withColumn("all", F.lit(0))
    return TS.positions(base, "all", ["o_orderkey"], "pos").select("o_orderkey", (F.col("pos") - 1).alias("row_index"))
