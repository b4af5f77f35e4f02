"""Window queries (§2.5)."""

# no ``from __future__ import annotations``: pandas UDF type hints must
# stay real types.
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.functions.exact import cents, fixed_mean, fixed_mean_sql
from marquee.operators import timeseries as TS
from marquee.operators.relational import topk_per_group
from marquee.plans.registry import query


def r(c, n=2):
    return F.round(c, n)


@query("win_rank", oracle="""
SELECT o_orderkey, o_custkey,
  row_number() OVER w AS rn, rank() OVER w AS rnk, dense_rank() OVER w AS drnk,
  round(percent_rank() OVER w, 6) AS prank, round(cume_dist() OVER w, 6) AS cdist, ntile(4) OVER w AS quartile
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)
""")
def win_rank(t):
    """Ranking functions per customer by price (desc) in one
    range-partitioned pass."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    d = TS.rank_columns(o, "o_custkey", "o_totalprice", "o_orderkey", descending=True)
    return d.select("o_orderkey", "o_custkey", F.col("rn").cast("int").alias("rn"), F.col("rnk").cast("int").alias("rnk"),
                    F.col("drnk").cast("int").alias("drnk"), r(F.col("prank"), 6).alias("prank"),
                    r(F.col("cdist"), 6).alias("cdist"), F.col("ntile").alias("quartile"))


@query("win_offset", oracle="""
SELECT o_orderkey, lag(o_orderkey) OVER w AS prev_order, lead(o_orderkey, 2, -1) OVER w AS next2,
  nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_order
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def win_offset(t):
    """lag(1), lead(2, default -1) and nth_value(2) per customer: one
    range-partitioned pass; nth_value is a per-customer aggregate joined
    back, null-safe."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    order = ["o_orderdate", "o_orderkey"]
    d = TS.ranged(o.withColumn("one", F.lit(1)), "o_custkey", order)
    d = TS.running(d, "o_custkey", order, {"pos": ("count", "one")})
    d = TS.shifted(d, "o_custkey", order, {"prev_order": ("o_orderkey", 1), "next2": ("o_orderkey", -2)})
    second = d.where("pos = 2").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("second_order"))
    return d.join(second, d.o_custkey.eqNullSafe(second.k), "left").select(
        "o_orderkey", "prev_order", F.coalesce("next2", F.lit(-1).cast("bigint")).alias("next2"), "second_order")


@query("nth_value", oracle="""
SELECT o_orderkey, first_value(k IGNORE NULLS) OVER w AS first_known, nth_value(k, 2 IGNORE NULLS) OVER w AS second_known, nth_value(k, 2) OVER w AS second_any
FROM (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS k, l.n FROM orders
  JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey)
WINDOW w AS (PARTITION BY n, o_orderkey // 50 ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")
def nth_value(t):
    """nth_value with and without NULLs over windows of a few rows (orders of
    one line count within fifty keys)."""
    n = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = t.orders.join(n, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "n", F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")).alias("k"))
    w = (Window.partitionBy("n", F.floor(F.col("o_orderkey") / 50)).orderBy("o_orderkey")
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return o.select("o_orderkey", F.first("k", ignorenulls=True).over(w).alias("first_known"),
                    F.nth_value("k", 2, ignoreNulls=True).over(w).alias("second_known"), F.nth_value("k", 2).over(w).alias("second_any"))


@query("win_rows", oracle="""
SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total FROM orders
""")
def win_rows(t):
    """Running total per customer (ROWS frame): running sums inside
    (customer, partition) plus the totals of earlier partitions."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    run = TS.bucketed_running(o, "o_custkey", ["o_orderdate", "o_orderkey"], {"rt": ("sum", "o_totalprice")})
    return run.select("o_orderkey", r(F.col("rt")).alias("running_total"))


_ROLL_SQL = """
SELECT event_id,
  CASE WHEN count(value) OVER w >= 3 THEN round(avg(value) OVER w, 6) END AS mean3,
  CASE WHEN count(value) OVER w >= 3 THEN round(sum(value) OVER w, 4) END AS sum3,
  CASE WHEN count(value) OVER w >= 3 THEN min(value) OVER w END AS min3,
  CASE WHEN count(value) OVER w >= 3 THEN max(value) OVER w END AS max3,
  CASE WHEN count(value) OVER w >= 3 THEN round(stddev_samp(value) OVER w, 6) END AS std3
FROM events WINDOW w AS ({part} ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
"""


def _rolling(df, part):
    """3-row moving window with min_periods=3 over the two preceding rows of
    the range-partitioned key (no single-key window partition)."""
    key = part[0]
    d = TS.rolling_rows(df.select(key, "ts", "event_id", "value"), key, ["ts", "event_id"], "value", 3)
    a, b, c = F.col("value"), F.col("_lag1"), F.col("_lag2")
    ok = a.isNotNull() & b.isNotNull() & c.isNotNull()
    s = a + b + c
    m = s / 3
    var = ((a - m) * (a - m) + (b - m) * (b - m) + (c - m) * (c - m)) / 2
    return d.select("event_id", F.when(ok, r(m, 6)).alias("mean3"), F.when(ok, r(s, 4)).alias("sum3"),
                    F.when(ok, F.least(a, b, c)).alias("min3"), F.when(ok, F.greatest(a, b, c)).alias("max3"),
                    F.when(ok, r(F.sqrt(var), 6)).alias("std3"))


@query("rolling", oracle=_ROLL_SQL.format(part="PARTITION BY event_type"))
def rolling(t):
    """Moving window of 3 rows with ``min_periods=3`` per event type."""
    return _rolling(t.events, ["event_type"])


@query("rolling_group", oracle=_ROLL_SQL.format(part="PARTITION BY user_id"))
def rolling_group(t):
    return _rolling(t.events, ["user_id"])


@query("expanding", oracle=f"""
SELECT event_id, count(value) OVER w AS cnt, round(sum(value) OVER w, 4) AS total,
  {fixed_mean_sql("sum(CAST(round(value * 100) AS BIGINT)) OVER w", "count(value) OVER w")} AS mean,
  min(value) OVER w AS lo, max(value) OVER w AS hi
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def expanding(t):
    """Expanding count / sum / mean / min / max per user, in one
    range-partitioned pass."""
    ev = t.events.select("user_id", "ts", "event_id", "value").withColumn("c", cents("value"))
    run = TS.bucketed_running(ev, "user_id", ["ts", "event_id"],
                              {"cnt": ("count", "value"), "total": ("sum", "value"), "cents": ("sum", "c"),
                               "lo": ("min", "value"), "hi": ("max", "value")})
    return run.select("event_id", "cnt", r(F.col("total"), 4).alias("total"),
                      fixed_mean(F.col("cents"), F.col("cnt")).alias("mean"), "lo", "hi")


@query("win_range", oracle="""
SELECT event_id, count(*) OVER w AS n_last_hour, round(sum(value) OVER w, 4) AS value_last_hour FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)
""")
def win_range(t):
    """RANGE frame of one hour per user, computed per (user, hour bucket)
    with the previous bucket copied in as context (one-bucket halo)."""
    ev = t.events.select("event_id", "user_id", "ts", "value")
    d = TS.range_window(ev, "user_id", "ts", 3600, "value")
    return d.select("event_id", F.col("_n").alias("n_last_hour"), r(F.col("_s"), 4).alias("value_last_hour"))


@query("win_share", oracle="""
SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS share FROM orders
""")
def win_share(t):
    """Share of the whole-partition total: the total is an aggregate
    (partial per task) joined back, not a whole-key window buffer."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    tot = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("tot"))
    tot = tot.withColumnRenamed("o_custkey", "k")
    return (o.join(tot, o.o_custkey.eqNullSafe(tot.k))
            .select("o_orderkey", r(F.col("o_totalprice") / F.col("tot"), 6).alias("share")))


_FILL_SRC = "(SELECT user_id, ts, event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END AS v FROM events)"


def _fill_src(t):
    ev = t.events
    return ev.select("user_id", "ts", "event_id",
                     F.when(F.col("event_type").isin("error", "signup"), F.lit(None)).otherwise(F.col("value")).alias("v"))


@query("ffill", oracle=f"""
SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v_ffill FROM {_FILL_SRC}
""")
def ffill(t):
    d = _fill_src(t)
    return TS.bucketed_fill(d, "user_id", ["ts", "event_id"], "v", "v_ffill").select("event_id", "v_ffill")


@query("bfill", oracle=f"""
SELECT event_id, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v_bfill FROM {_FILL_SRC}
""")
def bfill(t):
    d = _fill_src(t)
    return TS.bucketed_fill(d, "user_id", ["ts", "event_id"], "v", "v_bfill", backward=True).select("event_id", "v_bfill")


@query("topk_group", oracle="""
SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS price, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
WHERE rank <= 3
""")
def topk_group(t):
    """Top 3 orders per customer, two-stage (salted) so a hot customer
    is ranked by many tasks first."""
    o = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    top = topk_per_group(o, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, salt_col="o_orderkey")
    return top.select("o_custkey", "o_orderkey", r(F.col("o_totalprice")).alias("price"), F.col("rank").cast("bigint"))


_SESSIONS_SQL = """
SELECT user_id, session_id, min(ts) AS start, max(ts) AS "end", count(*) AS events FROM (
  SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_id FROM (
    SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
      OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new
    FROM events))
GROUP BY user_id, session_id
"""


@query("sessions_batch", oracle=_SESSIONS_SQL)
def sessions_batch(t):
    """Sessions with a 30-minute gap: one range-partitioned pass with a
    carry over partition borders."""
    ev = t.events.select("user_id", "ts", "event_id")
    return TS.sessions_summary(ev, "user_id", "ts", gap_s=1800)


@query("win_pandas", oracle="""
SELECT event_id, round(avg(value) OVER (PARTITION BY event_type), 6) AS type_mean FROM events
""")
def win_pandas(t):
    """Whole-group mean by a grouped-aggregate pandas UDF.  A mean is made
    of sums and counts, so the UDF runs over (type, salt) groups of bounded
    size, the partial sums meet in a built-in aggregate, and the result is
    joined back, null-safe: no Python worker sees a whole event type."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def sum_udf(v: pd.Series) -> float:
        return float(v.sum())

    ev = t.events.select("event_id", "event_type", "value")
    # about as many salts as it takes for 100,000 rows a group
    salts = max(1, -(-ev.count() // 100_000))
    known = ev.where("value is not null")
    part = (known.groupBy("event_type", F.pmod(F.xxhash64("event_id"), F.lit(salts)).alias("salt")).agg(sum_udf("value").alias("s")))
    n = known.groupBy(F.col("event_type").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    total = part.groupBy(F.col("event_type").alias("k")).agg(F.sum("s").alias("s"))
    mean = total.join(n, total.k.eqNullSafe(n.t)).select("k", (F.col("s") / F.col("n")).alias("m"))
    return ev.join(mean, ev.event_type.eqNullSafe(mean.k), "left").select("event_id", r(F.col("m"), 6).alias("type_mean"))
