"""Aggregation queries (§2.4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import aggregates as A
from marquee.plans.registry import query


def r(c, n=2):
    return F.round(c, n)


def dec(c):
    return F.col(c).cast("decimal(15,2)")


_Q1_SQL = """
SELECT l_returnflag, l_linestatus,
  CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS sum_qty,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS sum_base_price,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))) AS DOUBLE) AS sum_disc_price,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) * (1 + CAST(l_tax AS DECIMAL(15,2)))) AS DOUBLE) AS sum_charge,
  round(avg(l_quantity), 4) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price,
  round(avg(l_discount), 4) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus
"""


@query("agg_group", oracle=_Q1_SQL)
def agg_group(t):
    return pricing_summary(t)


def pricing_summary(t):
    """TPC-H Q1: one scan, one shuffle of (flag, status) partials."""
    li = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    price, disc, tax = dec("l_extendedprice"), dec("l_discount"), dec("l_tax")
    return (li.groupBy("l_returnflag", "l_linestatus")
            .agg(F.sum(dec("l_quantity")).cast("double").alias("sum_qty"),
                 F.sum(price).cast("double").alias("sum_base_price"),
                 F.sum(price * (1 - disc)).cast("double").alias("sum_disc_price"),
                 F.sum(price * (1 - disc) * (1 + tax)).cast("double").alias("sum_charge"),
                 r(F.avg("l_quantity"), 4).alias("avg_qty"), r(F.avg("l_extendedprice"), 4).alias("avg_price"),
                 r(F.avg("l_discount"), 4).alias("avg_disc"), F.count(F.lit(1)).alias("count_order")))


@query("agg_global", oracle="""
SELECT count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS qty, min(l_shipdate) AS first_ship,
  max(l_shipdate) AS last_ship, count(DISTINCT l_suppkey) AS suppliers FROM lineitem
""")
def agg_global(t):
    li = t.lineitem
    return li.agg(F.count(F.lit(1)).alias("n"), F.sum(dec("l_quantity")).cast("double").alias("qty"),
                  F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
                  F.count_distinct("l_suppkey").alias("suppliers"))


@query("agg_having", oracle="""
SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey HAVING count(*) > 15
""")
def agg_having(t):
    return (t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), r(F.sum("o_totalprice")).alias("total"))
            .where(F.col("n_orders") > 15))


_ROLL_COLS = "count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS qty"


def _roll_aggs():
    return [F.count(F.lit(1)).alias("n"), F.sum(dec("l_quantity")).cast("double").alias("qty")]


@query("agg_rollup", oracle=f"""
SELECT l_returnflag, l_linestatus, {_ROLL_COLS}, CAST(grouping(l_returnflag, l_linestatus) AS INTEGER) AS gid
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""")
def agg_rollup(t):
    return (t.lineitem.rollup("l_returnflag", "l_linestatus")
            .agg(*_roll_aggs(), F.grouping_id("l_returnflag", "l_linestatus").cast("int").alias("gid")))


@query("agg_cube", oracle=f"""
SELECT l_returnflag, l_linestatus, {_ROLL_COLS}, CAST(grouping(l_returnflag) AS INTEGER) AS g_flag,
  CAST(grouping(l_returnflag, l_linestatus) AS INTEGER) AS gid
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""")
def agg_cube(t):
    return (t.lineitem.cube("l_returnflag", "l_linestatus")
            .agg(*_roll_aggs(), F.grouping("l_returnflag").cast("int").alias("g_flag"),
                 F.grouping_id("l_returnflag", "l_linestatus").cast("int").alias("gid")))


@query("agg_grouping_sets", oracle=f"""
SELECT l_returnflag, l_linestatus, {_ROLL_COLS} FROM lineitem
GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())
""")
def agg_grouping_sets(t):
    t.lineitem.createOrReplaceTempView("lineitem")
    return t.spark.sql(f"""SELECT l_returnflag, l_linestatus, count(*) AS n,
        CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS qty FROM lineitem
        GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())""")


@query("agg_filter", oracle="""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o, round(sum(o_totalprice) FILTER (WHERE o_totalprice > 200000), 2) AS big_total
FROM orders GROUP BY o_orderpriority
""")
def agg_filter(t):
    o = t.orders
    return o.groupBy("o_orderpriority").agg(
        F.count(F.when(o.o_orderstatus == "F", 1)).alias("n_f"),
        F.count(F.when(o.o_orderstatus == "O", 1)).alias("n_o"),
        r(F.sum(F.when(o.o_totalprice > 200000, o.o_totalprice))).alias("big_total"))


@query("agg_salted", oracle="""
SELECT l_suppkey, round(sum(l_quantity), 2) AS total, count(l_quantity) AS n, count(*) AS rows, round(avg(l_quantity), 4) AS mean
FROM lineitem GROUP BY l_suppkey
""")
def agg_salted(t):
    a = A.salted_sum_count(t.lineitem.select("l_suppkey", "l_quantity", "l_orderkey", "l_linenumber"),
                           "l_suppkey", "l_quantity")
    return a.select("l_suppkey", r(F.col("total")).alias("total"), "n", "rows", r(F.col("mean"), 4).alias("mean"))


@query("udaf_average", oracle="""
SELECT l_returnflag, round(avg(l_extendedprice), 4) AS avg_price FROM lineitem GROUP BY l_returnflag
""")
def udaf_average(t):
    return t.lineitem.groupBy("l_returnflag").agg(r(A.average_struct("l_extendedprice"), 4).alias("avg_price"))


@query("word_count", oracle=r"""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""")
def word_count(t):
    """Split, explode, count: partial aggregation per partition, so even
    the most frequent word ships one partial count per task."""
    words = t.documents.select(F.explode(F.split("text", r"\s+")).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("log_stats", oracle="""
SELECT CASE WHEN regexp_matches(url, '^(https?)://[^/]+/([a-z][a-z])/')
  THEN regexp_extract(url, '^(https?)://[^/]+/([a-z][a-z])/', 1) || ' ' || regexp_extract(url, '^(https?)://[^/]+/([a-z][a-z])/', 2) END AS key,
  count(*) AS n, CAST(sum(length(html)) AS BIGINT) AS bytes FROM pages GROUP BY 1
""")
def log_stats(t):
    """Log-query stats: a regex key per line (null when the line does not
    match), then count and bytes per key."""
    pat = r"^(https?)://[^/]+/([a-z][a-z])/"
    key = F.when(F.col("url").rlike(pat), F.concat_ws(" ", F.regexp_extract("url", pat, 1), F.regexp_extract("url", pat, 2)))
    return (t.pages.select(key.alias("key"), F.length("html").alias("len"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("len").cast("bigint").alias("bytes")))


@query("describe", oracle="""
SELECT statistic, "column", round(value, 4) AS value FROM (
  SELECT 'count' AS statistic, 'l_quantity' AS "column", CAST(count(l_quantity) AS DOUBLE) AS value FROM lineitem
  UNION ALL SELECT 'mean', 'l_quantity', avg(l_quantity) FROM lineitem
  UNION ALL SELECT 'stddev', 'l_quantity', stddev_samp(l_quantity) FROM lineitem
  UNION ALL SELECT 'min', 'l_quantity', min(l_quantity) FROM lineitem
  UNION ALL SELECT 'max', 'l_quantity', max(l_quantity) FROM lineitem
  UNION ALL SELECT 'count', 'l_discount', CAST(count(l_discount) AS DOUBLE) FROM lineitem
  UNION ALL SELECT 'mean', 'l_discount', avg(l_discount) FROM lineitem
  UNION ALL SELECT 'stddev', 'l_discount', stddev_samp(l_discount) FROM lineitem
  UNION ALL SELECT 'min', 'l_discount', min(l_discount) FROM lineitem
  UNION ALL SELECT 'max', 'l_discount', max(l_discount) FROM lineitem)
""")
def describe(t):
    d = A.describe(t.lineitem, ["l_quantity", "l_discount"])
    return d.withColumn("value", r(F.col("value"), 4))


@query("crosstab", oracle="""
SELECT l_returnflag AS l_returnflag_l_linestatus, count(*) FILTER (WHERE l_linestatus = 'F') AS "F",
  count(*) FILTER (WHERE l_linestatus = 'O') AS "O" FROM lineitem GROUP BY l_returnflag
""")
def crosstab(t):
    return t.lineitem.stat.crosstab("l_returnflag", "l_linestatus")


@query("corr_cov", oracle="""
SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr, round(covar_samp(l_quantity, l_extendedprice), 4) AS cov
FROM lineitem
""")
def corr_cov(t):
    li = t.lineitem
    return li.agg(r(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr"),
                  r(F.covar_samp("l_quantity", "l_extendedprice"), 4).alias("cov"))


@query("stats", oracle="""
SELECT count(*) AS count, round(avg(o_totalprice), 4) AS mean, round(sum(o_totalprice), 2) AS sum,
  round(min(o_totalprice), 2) AS min, round(max(o_totalprice), 2) AS max, round(var_pop(o_totalprice), 2) AS variance,
  round(var_samp(o_totalprice), 2) AS sample_variance, round(stddev_pop(o_totalprice), 4) AS stdev,
  round(stddev_samp(o_totalprice), 4) AS sample_stdev FROM orders
""")
def stats(t):
    v = "o_totalprice"
    return t.orders.agg(F.count(F.lit(1)).alias("count"), r(F.avg(v), 4).alias("mean"), r(F.sum(v)).alias("sum"),
                        r(F.min(v)).alias("min"), r(F.max(v)).alias("max"), r(F.var_pop(v)).alias("variance"),
                        r(F.var_samp(v)).alias("sample_variance"), r(F.stddev_pop(v), 4).alias("stdev"),
                        r(F.stddev_samp(v), 4).alias("sample_stdev"))


@query("histogram", oracle="""
SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN l_quantity >= 0 AND l_quantity < 10 THEN 0
  WHEN l_quantity >= 10 AND l_quantity < 20 THEN 1 WHEN l_quantity >= 20 AND l_quantity < 30 THEN 2
  WHEN l_quantity >= 30 AND l_quantity < 40 THEN 3 WHEN l_quantity >= 40 AND l_quantity <= 50 THEN 4 END AS bucket
  FROM lineitem) WHERE bucket IS NOT NULL GROUP BY bucket
""")
def histogram(t):
    return A.histogram(t.lineitem, "l_quantity", [0, 10, 20, 30, 40, 50])


@query("value_counts", oracle="""
SELECT o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY o_orderpriority
""")
def value_counts(t):
    c = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the aggregated rows (one per distinct value)
    return c.withColumn("share", r(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("agg_basic", oracle="""
SELECT l_orderkey, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(avg(l_quantity), 6) AS avg_qty,
  round(avg(l_discount), 6) AS mean_disc, min(l_shipdate) AS first_ship, max(l_quantity) AS max_qty,
  CAST(product(l_linenumber) AS DOUBLE) AS prod_lines FROM lineitem GROUP BY l_orderkey
""")
def agg_basic(t):
    li = t.lineitem
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity")).alias("qty"), r(F.avg("l_quantity"), 6).alias("avg_qty"),
        r(F.mean("l_discount"), 6).alias("mean_disc"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_quantity").alias("max_qty"), F.product("l_linenumber").alias("prod_lines"))


@query("agg_first_last", oracle="""
SELECT o_custkey, min(o_orderkey) AS first_all, min(nullif(o_orderstatus, 'O')) AS first_known, min(o_orderkey) AS last_all,
  count(*) FILTER (WHERE o_orderstatus <> 'O') > 0 AS any_known
FROM orders GROUP BY o_custkey
""")
def agg_first_last(t):
    """first / last as aggregates, with and without NULLs, over values that
    are one per group (their result is then the same in any row order)."""
    o = t.orders.withColumn("known", F.nullif(F.col("o_orderstatus"), F.lit("O")))
    low = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("k"), F.min("known").alias("s")).withColumnRenamed("o_custkey", "c")
    j = o.join(low, o.o_custkey.eqNullSafe(low.c))
    return j.groupBy("o_custkey").agg(
        F.first("k").alias("first_all"), F.first(F.when(F.col("known").isNotNull(), F.col("s")), ignorenulls=True).alias("first_known"),
        F.last("k").alias("last_all"), F.last(F.col("known").isNotNull() | F.lit(None).cast("boolean"), ignorenulls=True).isNotNull().alias("any_known"))


@query("agg_argext", oracle="""
SELECT o_custkey, arg_max(o_orderkey, o_totalprice) AS top_order, arg_min(o_orderkey, o_totalprice) AS low_order
FROM orders GROUP BY o_custkey
""")
def agg_argext(t):
    o = t.orders
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", "o_totalprice").alias("top_order"),
                                      F.min_by("o_orderkey", "o_totalprice").alias("low_order"))


@query("agg_distinct", oracle="""
SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, CAST(sum(DISTINCT o_custkey % 100) AS BIGINT) AS sum_distinct
FROM orders GROUP BY o_orderpriority
""")
def agg_distinct(t):
    o = t.orders
    return o.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"),
                                            F.sum_distinct(o.o_custkey % 100).alias("sum_distinct"))


@query("agg_median_mode", oracle="""
SELECT l_returnflag, median(l_quantity) AS med,
  (SELECT q FROM (SELECT l_quantity AS q, count(*) AS c FROM lineitem i WHERE i.l_returnflag = o.l_returnflag GROUP BY q)
   ORDER BY c DESC, q LIMIT 1) AS mode_qty
FROM lineitem o GROUP BY l_returnflag
""")
def agg_median_mode(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.median("l_quantity").alias("med"),
                                                  F.mode("l_quantity", deterministic=True).alias("mode_qty"))


@query("agg_moments", oracle="""
SELECT l_returnflag, round(stddev(x), 4) AS sd, round(stddev_samp(x), 4) AS sd_samp, round(stddev_pop(x), 4) AS sd_pop,
  round(variance(x), 4) AS var, round(var_samp(x), 4) AS var_samp, round(var_pop(x), 4) AS var_pop,
  round(avg(power(x - m, 3)) / power(avg(power(x - m, 2)), 1.5), 6) AS skew,
  round(avg(power(x - m, 4)) / power(avg(power(x - m, 2)), 2) - 3, 6) AS kurt
FROM (SELECT l_returnflag, l_discount AS x, avg(l_discount) OVER (PARTITION BY l_returnflag) AS m FROM lineitem)
GROUP BY l_returnflag
""")
def agg_moments(t):
    x = "l_discount"
    return t.lineitem.groupBy("l_returnflag").agg(
        r(F.stddev(x), 4).alias("sd"), r(F.stddev_samp(x), 4).alias("sd_samp"), r(F.stddev_pop(x), 4).alias("sd_pop"),
        r(F.variance(x), 4).alias("var"), r(F.var_samp(x), 4).alias("var_samp"), r(F.var_pop(x), 4).alias("var_pop"),
        r(F.skewness(x), 6).alias("skew"), r(F.kurtosis(x), 6).alias("kurt"))


@query("agg_bivariate", oracle="""
SELECT l_returnflag, round(corr(l_quantity, l_discount), 6) AS corr, round(covar_pop(l_quantity, l_discount), 6) AS cov_pop,
  round(covar_samp(l_quantity, l_discount), 6) AS cov_samp FROM lineitem GROUP BY l_returnflag
""")
def agg_bivariate(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        r(F.corr("l_quantity", "l_discount"), 6).alias("corr"),
        r(F.covar_pop("l_quantity", "l_discount"), 6).alias("cov_pop"),
        r(F.covar_samp("l_quantity", "l_discount"), 6).alias("cov_samp"))


@query("agg_collect", oracle="""
SELECT l_orderkey, array_to_string(list_sort(list(CAST(l_linenumber AS VARCHAR))), ',') AS lines,
  array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS flags FROM lineitem GROUP BY l_orderkey
""")
def agg_collect(t):
    """Lists per order: bounded by the data model (a handful of lines per
    order), sorted before they are compared."""
    li = t.lineitem
    return li.groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_list(F.col("l_linenumber").cast("string"))), ",").alias("lines"),
        F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"))


# ---------------------------------------------------------------- approximate (rows-only)
@query("agg_approx")
def agg_approx(t):
    """HyperLogLog++ distinct count and approximate percentiles (t-digest
    style sketch merge), both with partial aggregation."""
    li = t.lineitem
    # sketches in one aggregate; the exact distinct count separately (a
    # distinct aggregate would expand the rows the sketches consume)
    sketches = li.groupBy("l_returnflag").agg(
        F.approx_count_distinct("l_partkey", rsd=0.02).alias("parts_approx"),
        F.percentile_approx("l_quantity", [0.25, 0.5, 0.75], 10000).alias("quartiles"))
    exact = (li.select("l_returnflag", "l_partkey").distinct().groupBy("l_returnflag")
             .agg(F.count(F.lit(1)).alias("parts_exact")))
    return sketches.join(exact, "l_returnflag")


@query("approx_quantile")
def approx_quantile(t):
    """``approxQuantile`` as a DataFrame aggregate (no driver-side list)."""
    return t.orders.agg(F.percentile_approx("o_totalprice", [0.1, 0.5, 0.9], 1000).alias("q"))


@query("freq_items")
def freq_items(t):
    """Frequent items (Karp et al. sketch): a superset of the values with
    frequency above the support."""
    return t.orders.stat.freqItems(["o_orderpriority", "o_orderstatus"], support=0.2)
