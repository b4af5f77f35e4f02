"""Indexed-frame and time-series queries (§2.12), pandas semantics
re-expressed as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.functions.exact import micros
from marquee.operators import timeseries as TS
from marquee.plans.registry import query


def r(c, n=6):
    return F.round(c, n)


_EV_ORDER = ["ts", "event_id"]


@query("resample", oracle="""
WITH per AS (SELECT user_id, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS b, count(*) AS n, round(sum(value), 2) AS total,
  min(value) AS lo, max(value) AS hi FROM events GROUP BY 1, 2),
span AS (SELECT user_id, min(b) AS lo_b, max(b) AS hi_b FROM per GROUP BY user_id),
cal AS (SELECT user_id, unnest(range(lo_b, hi_b + 1)) AS b FROM span)
SELECT cal.user_id, cal.b * 86400 AS bucket_epoch, coalesce(n, 0) AS n, coalesce(total, 0.0) AS total, lo, hi
FROM cal LEFT JOIN per USING (user_id, b)
""")
def resample(t):
    """Daily resample per user; empty days inside a user's span appear
    with n = 0, total = 0 and null min/max."""
    out = TS.resample(t.events, "user_id", "ts", 86400,
                      [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"),
                       F.min("value").alias("lo"), F.max("value").alias("hi")])
    return out.select("user_id", F.unix_seconds("bucket_start").alias("bucket_epoch"),
                      F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.coalesce("total", F.lit(0.0)).alias("total"),
                      "lo", "hi")


@query("diff", oracle="""
SELECT event_id, round(value - lag(value) OVER w, 4) AS d1, round(value - lag(value, 2) OVER w, 4) AS d2
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def diff(t):
    """diff(1), diff(2) per user: earlier rows joined by position."""
    d = TS.rolling_rows(t.events.select("user_id", "ts", "event_id", "value"), "user_id", _EV_ORDER, "value", 3)
    v = F.col("value")
    return d.select("event_id", r(v - F.col("_lag1"), 4).alias("d1"), r(v - F.col("_lag2"), 4).alias("d2"))


@query("pct_change", oracle="""
SELECT event_id, round(value / nullif(lag(value) OVER w, 0) - 1, 6) AS pct
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def pct_change(t):
    d = TS.rolling_rows(t.events.select("user_id", "ts", "event_id", "value"), "user_id", _EV_ORDER, "value", 2)
    v = F.col("value")
    return d.select("event_id", r(F.try_divide(v, F.nullif(F.col("_lag1"), F.lit(0.0))) - 1).alias("pct"))


_LINE_W = "PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query("cumulative", oracle=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(sum(l_quantity) OVER w, 2) AS cumsum,
  round(product(1 + l_discount) OVER w, 6) AS cumprod, max(l_extendedprice) OVER w AS cummax,
  min(l_extendedprice) OVER w AS cummin, count(*) OVER w - 1 AS cumcount
FROM lineitem WINDOW w AS ({_LINE_W})
""")
def cumulative(t):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey").rowsBetween(Window.unboundedPreceding, 0)
    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r(F.sum("l_quantity").over(w), 2).alias("cumsum"),
                     r(F.product(1 + F.col("l_discount")).over(w)).alias("cumprod"),
                     F.max("l_extendedprice").over(w).alias("cummax"), F.min("l_extendedprice").over(w).alias("cummin"),
                     (F.count(F.lit(1)).over(w) - 1).alias("cumcount"))


_NULLED = "(SELECT user_id, ts, event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END AS v FROM events)"


@query("interpolate", oracle=f"""
WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM {_NULLED}),
y AS (SELECT *,
  last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM x)
SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN pp IS NOT NULL AND np IS NOT NULL THEN pv + (nv - pv) * (pos - pp) / (np - pp)
  WHEN pp IS NOT NULL THEN pv END, 6) AS v_interp FROM y
""")
def interpolate(t):
    ev = t.events
    d = ev.select("user_id", "ts", "event_id",
                  F.when(F.col("event_type").isin("error", "signup"), F.lit(None)).otherwise(F.col("value")).alias("v"))
    out = TS.interpolate_linear(d, "user_id", _EV_ORDER, "v", "v_interp")
    return out.select("event_id", r(F.col("v_interp")).alias("v_interp"))


@query("rank_methods", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(rank() OVER w AS DOUBLE) AS r_min,
  CAST(rank() OVER w + count(*) OVER (PARTITION BY l_orderkey, l_quantity) - 1 AS DOUBLE) AS r_max,
  (rank() OVER w + (rank() OVER w + count(*) OVER (PARTITION BY l_orderkey, l_quantity) - 1)) / 2.0 AS r_avg,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_partkey, l_suppkey) AS DOUBLE) AS r_first,
  CAST(dense_rank() OVER w AS DOUBLE) AS r_dense
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity)
""")
def rank_methods(t):
    """pandas ``rank(method=min|max|average|first|dense)`` per order.

    The whole order of the lines is made first and serves all windows, so a
    task holds one sort; parts follow the counted lines."""
    li = TS.parted(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), "l_orderkey")
    w = Window.partitionBy("l_orderkey").orderBy("l_quantity")
    lo = F.rank().over(w)
    hi = F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))    # with all its ties
    first = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_quantity", "l_linenumber", "l_partkey", "l_suppkey"))
    return (li.withColumn("first", first).withColumns({"lo": lo, "hi": hi, "dense": F.dense_rank().over(w)})
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("lo").cast("double").alias("r_min"),
                    F.col("hi").cast("double").alias("r_max"), ((F.col("lo") + F.col("hi")) / 2.0).alias("r_avg"),
                    F.col("first").cast("double").alias("r_first"), F.col("dense").cast("double").alias("r_dense")))


@query("group_nth", oracle="""
SELECT o_orderkey, o_custkey, rn = 2 AS is_nth1, rn <= 2 AS in_head2, rd = 1 AS is_tail1 FROM (
  SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rd FROM orders)
""")
def group_nth(t):
    """nth / head / tail per customer from skew-safe positions and the
    group size (aggregate + join)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    p = TS.positions(o, "o_custkey", ["o_orderdate", "o_orderkey"], "rn")
    size = o.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    d = p.join(size, p.o_custkey.eqNullSafe(size.k)).withColumn("rd", F.col("n") - F.col("rn") + 1)
    return d.select("o_orderkey", "o_custkey", (F.col("rn") == 2).alias("is_nth1"), (F.col("rn") <= 2).alias("in_head2"),
                    (F.col("rd") == 1).alias("is_tail1"))


@query("group_filter", oracle="""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING sum(o_totalprice) > 2000000)
""")
def group_filter(t):
    """groupby.filter: keep the rows of groups passing a group predicate
    (aggregate, then semi join — no per-group collect)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    keep = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s")).where("s > 2000000")
    return o.join(keep, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("group_transform", oracle="""
SELECT event_id, round(sum(value) OVER g, 2) AS grp_sum, max(value) OVER g AS grp_max, count(*) OVER g AS grp_n,
  round(value - min(value) OVER g, 4) AS above_min FROM events WINDOW g AS (PARTITION BY user_id)
""")
def group_transform(t):
    """groupby.transform: group aggregates (partial aggregation) joined
    back to the rows — no whole-group window partition."""
    ev = t.events.select("event_id", "user_id", "value")
    g = ev.groupBy(F.col("user_id").alias("k")).agg(F.sum("value").alias("s"), F.max("value").alias("mx"),
                                  F.count(F.lit(1)).alias("grp_n"), F.min("value").alias("mn"))
    j = ev.join(g, ev.user_id.eqNullSafe(g.k))
    return j.select("event_id", F.round("s", 2).alias("grp_sum"), F.col("mx").alias("grp_max"), "grp_n",
                    F.round(F.col("value") - F.col("mn"), 4).alias("above_min"))


@query("group_stats", oracle="""
SELECT o_orderpriority, count(*) AS size, count(DISTINCT o_custkey) AS nunique, round(median(o_totalprice), 4) AS med,
  round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(stddev_samp(o_totalprice), 4) AS std, round(var_samp(o_totalprice), 2) AS var,
  round(stddev_samp(o_totalprice) / sqrt(count(o_totalprice)), 4) AS sem, bool_and(o_totalprice > 1000) AS all_big,
  bool_or(o_totalprice > 400000) AS any_huge
FROM orders GROUP BY o_orderpriority
""")
def group_stats(t):
    """Group statistics; median and quantile come from exact positions in
    one range-partitioned pass, so no task holds a whole group's values."""
    v = F.col("o_totalprice")
    o = t.orders
    stats = o.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("size"), F.count_distinct("o_custkey").alias("nunique"), F.round(F.stddev_samp(v), 4).alias("std"),
        F.round(F.var_samp(v), 2).alias("var"), F.round(F.stddev_samp(v) / F.sqrt(F.count(v)), 4).alias("sem"),
        F.bool_and(v > 1000).alias("all_big"), F.bool_or(v > 400000).alias("any_huge"), F.count(v).alias("n"))
    p = TS.positions(o.where(v.isNotNull()).select("o_orderpriority", "o_totalprice"), "o_orderpriority", ["o_totalprice"], "pos")
    p = p.join(stats.select(F.col("o_orderpriority").alias("k"), "n"), F.col("o_orderpriority").eqNullSafe(F.col("k")))
    picks = []
    for name, q in (("med", 0.5), ("q25", 0.25)):
        at = (F.col("n") - 1) * q + 1
        low, high = F.max(F.when(F.col("pos") == F.floor(at), v)), F.max(F.when(F.col("pos") == F.ceil(at), v))
        picks.append(F.round(low + (high - low) * F.max(at - F.floor(at)), 4).alias(name))
    quant = p.groupBy("k").agg(*picks)
    return (stats.join(quant, F.col("o_orderpriority").eqNullSafe(F.col("k")), "left")
            .select("o_orderpriority", "size", "nunique", "med", "q25", "std", "var", "sem", "all_big", "any_huge"))


@query("pivot_table", oracle="""
SELECT o_orderpriority, coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2), 0) AS "F",
  coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2), 0) AS "O",
  coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2), 0) AS "P" FROM orders GROUP BY o_orderpriority
""")
def pivot_table(t):
    p = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.round(F.sum("o_totalprice"), 2))
    return p.na.fill(0.0, subset=["F", "O", "P"])


@query("stack", oracle="""
SELECT c_custkey, variable, value FROM (
  SELECT c_custkey, 'acctbal' AS variable, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE round(c_acctbal, 2) END AS value FROM customer
  UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS DOUBLE) FROM customer) WHERE value IS NOT NULL
""")
def stack(t):
    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).otherwise(F.round("c_acctbal", 2)).alias("a"),
                          F.col("c_nationkey").cast("double").alias("n"))
    return (c.selectExpr("c_custkey", "stack(2, 'acctbal', a, 'nation', n) AS (variable, value)")
            .where(F.col("value").isNotNull()))


# fixed values: the statuses of an order
ORDER_STATUSES = ("F", "O", "P")


@query("get_dummies", oracle="""
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F", CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
  CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders
""")
def get_dummies(t):
    """One-hot columns of a declared category list (no pass over the data
    to find it)."""
    o, cats = t.orders, ORDER_STATUSES
    return o.select("o_orderkey", *[(F.col("o_orderstatus") == c).cast("int").alias(f"o_orderstatus_{c}") for c in cats])


@query("factorize", oracle="""
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS code FROM orders
""")
def factorize(t):
    """Codes from the sorted distinct values (NULL: -1), numbered in one
    range-partitioned pass over the distinct table and joined back."""
    o = t.orders.select("o_orderkey", "o_orderpriority")
    cats = o.where("o_orderpriority is not null").select(F.col("o_orderpriority").alias("cat"), F.lit(0).alias("all")).distinct()
    codes = TS.positions(cats, "all", ["cat"], "pos")
    return (o.join(codes, F.col("o_orderpriority") == F.col("cat"), "left")
            .select("o_orderkey", F.coalesce(F.col("pos") - 1, F.lit(-1)).cast("bigint").alias("code")))


@query("duplicated", oracle="""
SELECT o_orderkey, o_orderkey <> min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderstatus) AS dup FROM orders
""")
def duplicated(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    first = o.groupBy(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s")).agg(F.min("o_orderkey").alias("first_key"))
    return o.join(first, o.o_custkey.eqNullSafe(first.k) & o.o_orderstatus.eqNullSafe(first.s)).select("o_orderkey", (F.col("o_orderkey") != F.col("first_key")).alias("dup"))


@query("clip", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, least(greatest(l_quantity, 10), 40) AS q_clipped,
  round(least(greatest(l_extendedprice, 5000), 50000), 2) AS p_clipped FROM lineitem
""")
def clip(t):
    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.least(F.greatest("l_quantity", F.lit(10.0)), F.lit(40.0)).alias("q_clipped"),
                     F.round(F.least(F.greatest("l_extendedprice", F.lit(5000.0)), F.lit(50000.0)), 2).alias("p_clipped"))


@query("mask", oracle="""
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN NULL ELSE round(o_totalprice, 2) END AS masked,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'other' END AS kept FROM orders
""")
def mask(t):
    o = t.orders
    return o.select("o_orderkey", F.when(~(o.o_totalprice > 300000), F.round(o.o_totalprice, 2)).alias("masked"),
                    F.when(o.o_orderstatus == "F", o.o_orderpriority).otherwise(F.lit("other")).alias("kept"))


@query("between_time", oracle="""
SELECT event_id FROM events WHERE strftime(ts, '%H:%M:%S') BETWEEN '09:00:00' AND '17:30:00'
""")
def between_time(t):
    hms = F.date_format("ts", "HH:mm:ss")
    return t.events.where(hms.between("09:00:00", "17:30:00")).select("event_id")


@query("reindex", oracle="""
SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o
ON c_custkey = o_custkey
""")
def reindex(t):
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return (t.customer.select("c_custkey").join(n, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders")))


@query("corrwith", oracle="""
SELECT round(corr(o_totalprice, ext), 6) AS corr_price, round(corr(CAST(o_orderkey AS DOUBLE), n), 6) AS corr_lines FROM orders
JOIN (SELECT l_orderkey, sum(l_extendedprice) AS ext, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
""")
def corrwith(t):
    li = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("ext"), F.count(F.lit(1)).cast("double").alias("n"))
    j = t.orders.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.agg(r(F.corr("o_totalprice", "ext")).alias("corr_price"), r(F.corr(F.col("o_orderkey").cast("double"), "n")).alias("corr_lines"))


_CORR_COLS = ("l_quantity", "l_extendedprice", "l_discount")


@query("corr_matrix", oracle=" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in _CORR_COLS for b in _CORR_COLS))
def corr_matrix(t):
    """Pairwise Pearson matrix in long form, computed in one aggregate."""
    li = t.lineitem
    aggs = [F.corr(a, b).alias(f"{a}|{b}") for a in _CORR_COLS for b in _CORR_COLS]
    wide = li.agg(*aggs)
    pairs = ", ".join(f"'{c.split('|')[0]}', '{c.split('|')[1]}', `{c}`" for c in wide.columns)
    return wide.selectExpr(f"stack({len(wide.columns)}, {pairs}) AS (a, b, corr)").withColumn("corr", r(F.col("corr")))


@query("date_range", oracle="""
SELECT unnest(range(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) + INTERVAL 1 DAY, INTERVAL 7 DAY))::DATE AS d FROM orders
""")
def date_range(t):
    """``date_range(start, end, freq='7D')`` with bounds taken from the data."""
    b = t.orders.agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("d"))


@query("to_numeric", oracle="""
SELECT o_orderkey, TRY_CAST(substring(o_orderpriority, 1, 1) AS DOUBLE) AS prio_num, TRY_CAST(o_orderstatus AS DOUBLE) AS bad_num FROM orders
""")
def to_numeric(t):
    o = t.orders
    return o.select("o_orderkey", o.o_orderpriority.substr(1, 1).try_cast("double").alias("prio_num"),
                    o.o_orderstatus.try_cast("double").alias("bad_num"))


@query("str_accessor", oracle=r"""
SELECT p_partkey, upper(p_type[1]) || lower(p_type[2:]) AS capitalized, lower(p_type) AS low, starts_with(p_type, 'STANDARD') AS sw,
  ends_with(p_type, 'TIN') AS ew, trim('  ' || p_brand || ' ') AS stripped, p_type[1] AS first_char,
  regexp_matches(p_brand, '^[A-Za-z0-9]+$') AS isalnum, regexp_matches(p_mfgr, '^[A-Za-z]+$') AS isalpha,
  regexp_matches(CAST(p_size AS VARCHAR), '^[0-9]+$') AS isdigit, contains(p_name, 'red') AS has_red,
  CAST((length(p_name) - length(replace(p_name, 'e', ''))) AS BIGINT) AS count_e, CAST(instr(p_name, 'e') - 1 AS BIGINT) AS find_e,
  array_to_string(regexp_extract_all(p_name, '[a-z]*en', 0), ',') AS findall_en, CAST(length(p_name) AS BIGINT) AS len,
  rpad(p_brand, 12, '.') AS ljust, lpad(p_brand, 12, '.') AS rjust, regexp_matches(p_type, '^STANDARD') AS match_std,
  lpad(CAST(p_size AS VARCHAR), 4, '0') AS zfill, replace(p_type, ' ', '_') AS replaced, p_name[3:6] AS sliced,
  split_part(p_type, ' ', 2) AS split2, repeat(p_brand[7:], 2) AS repeated
FROM (SELECT *, substring(p_brand, 1, 5) AS p_mfgr FROM part)
""")
def str_accessor(t):
    p = t.part.withColumn("p_mfgr", F.substring("p_brand", 1, 5))
    name, typ, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    return p.select(
        "p_partkey", F.concat(F.upper(typ.substr(1, 1)), F.lower(F.substring(typ, F.lit(2), F.length(typ)))).alias("capitalized"),
        F.lower(typ).alias("low"), typ.startswith("STANDARD").alias("sw"), typ.endswith("TIN").alias("ew"),
        F.trim(F.concat(F.lit("  "), brand, F.lit(" "))).alias("stripped"), typ.substr(1, 1).alias("first_char"),
        brand.rlike("^[A-Za-z0-9]+$").alias("isalnum"), F.col("p_mfgr").rlike("^[A-Za-z]+$").alias("isalpha"),
        F.col("p_size").cast("string").rlike("^[0-9]+$").alias("isdigit"), name.contains("red").alias("has_red"),
        (F.length(name) - F.length(F.replace(name, F.lit("e"), F.lit("")))).cast("bigint").alias("count_e"),
        (F.instr(name, "e") - 1).cast("bigint").alias("find_e"),
        F.array_join(F.regexp_extract_all(name, F.lit("[a-z]*en"), F.lit(0)), ",").alias("findall_en"),
        F.length(name).cast("bigint").alias("len"), F.rpad(brand, 12, ".").alias("ljust"), F.lpad(brand, 12, ".").alias("rjust"),
        typ.rlike("^STANDARD").alias("match_std"), F.lpad(F.col("p_size").cast("string"), 4, "0").alias("zfill"),
        F.replace(typ, F.lit(" "), F.lit("_")).alias("replaced"), name.substr(3, 4).alias("sliced"),
        F.split_part(typ, F.lit(" "), F.lit(2)).alias("split2"), F.repeat(F.substring(brand, F.lit(7), F.length(brand)), 2).alias("repeated"))


@query("frame_arith", oracle="""
SELECT o_orderkey, a + b AS add, a - b AS sub, a * b AS mul, round(a / b, 6) AS div, CAST(floor(a / b) AS BIGINT) AS floordiv,
  CAST(a - b * floor(a / b) AS BIGINT) AS mod, CAST(b - a AS DOUBLE) AS rsub, round(pow(b, 2), 0) AS pow2,
  a = b AS eq, a <> b AS ne, a > b AS gt, a >= b AS ge, a < b AS lt, a <= b AS le
FROM (SELECT o_orderkey, o_custkey - 700 AS a, CASE WHEN o_orderkey % 2 = 0 THEN -7 ELSE 7 END AS b FROM orders)
""")
def frame_arith(t):
    o = t.orders.select("o_orderkey", (F.col("o_custkey") - 700).alias("a"),
                        F.when(F.col("o_orderkey") % 2 == 0, F.lit(-7)).otherwise(F.lit(7)).alias("b"))
    a, b = F.col("a"), F.col("b")
    fl = F.floor(a / b)
    return o.select("o_orderkey", (a + b).alias("add"), (a - b).alias("sub"), (a * b).alias("mul"), r(a / b).alias("div"),
                    fl.cast("bigint").alias("floordiv"), (a - b * fl).cast("bigint").alias("mod"),
                    F.round((b - a).cast("double"), 0).alias("rsub"), F.round(F.pow(b, 2), 0).alias("pow2"),
                    (a == b).alias("eq"), (a != b).alias("ne"), (a > b).alias("gt"), (a >= b).alias("ge"),
                    (a < b).alias("lt"), (a <= b).alias("le"))


# fixed values: priority → weight mapping used by the Series.map example
PRIORITY_WEIGHT = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}


@query("series_map", oracle="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
  WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 END AS weight FROM orders
""")
def series_map(t):
    """``Series.map(dict)`` as a literal map lookup (JVM-side)."""
    m = F.create_map(*[x for k, v in PRIORITY_WEIGHT.items() for x in (F.lit(k), F.lit(v))])
    return t.orders.select("o_orderkey", m[F.col("o_orderpriority")].alias("weight"))


@query("first_offset", oracle="""
SELECT event_id, 'first' AS part FROM events WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 3 DAY
UNION ALL SELECT event_id, 'last' FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 3 DAY
""")
def first_offset(t):
    """``first('3D')`` / ``last('3D')``: rows within 3 days of the first
    / last timestamp (one-row bounds joined by broadcast)."""
    ev = t.events.select("event_id", "ts")
    b = F.broadcast(ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")))
    j = ev.crossJoin(b)
    first = j.where(F.col("ts") < F.col("lo") + F.expr("INTERVAL 3 DAYS")).select("event_id", F.lit("first").alias("part"))
    last = j.where(F.col("ts") > F.col("hi") - F.expr("INTERVAL 3 DAYS")).select("event_id", F.lit("last").alias("part"))
    return first.unionByName(last)


@query("row_repeat", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, unnest(range(l_linenumber)) AS copy FROM lineitem
""")
def row_repeat(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    seq = F.sequence(F.lit(0).cast("bigint"), (F.col("l_linenumber") - 1).cast("bigint"))
    return li.select("*", F.explode(seq).alias("copy"))


# fixed values: category order of the priority categorical
PRIORITY_CATEGORIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query("categories", oracle="""
SELECT o_orderkey, CAST(coalesce(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], o_orderpriority), 0) - 1 AS INTEGER) AS code,
  CAST(coalesce(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH'], o_orderpriority), 0) - 1 AS INTEGER) AS code_removed
FROM orders
""")
def categories(t):
    """Categorical codes by an explicit category order (dictionary joined
    by broadcast — its size is the category list); removing a category
    turns its rows into code -1."""
    spark = t.spark
    cats = spark.createDataFrame([(c, i) for i, c in enumerate(PRIORITY_CATEGORIES)], "cat string, code int")
    removed = cats.where(F.col("cat") != "1-URGENT").withColumnRenamed("code", "code_removed")
    o = t.orders.select("o_orderkey", "o_orderpriority")
    j = (o.join(F.broadcast(cats), o.o_orderpriority == cats.cat, "left").drop("cat")
         .join(F.broadcast(removed), F.col("o_orderpriority") == F.col("cat"), "left"))
    return j.select("o_orderkey", F.coalesce("code", F.lit(-1)).alias("code"),
                    F.coalesce("code_removed", F.lit(-1)).alias("code_removed"))


@query("timedelta_range", oracle="""
WITH g AS (SELECT CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 3600000000) AS BIGINT) AS h
  FROM events), c AS (SELECT h, count(*) AS n FROM g WHERE h IS NOT NULL GROUP BY h)
SELECT b.h * 3600 AS gap_start_s, coalesce(c.n, 0) AS n FROM (SELECT unnest(range(0, max(h) + 1)) AS h FROM c) b LEFT JOIN c USING (h)
""")
def timedelta_range(t):
    """Gaps between a user's consecutive events, counted per hour on a
    ``timedelta_range(0, max_gap, '1h')`` calendar (empty hours = 0)."""
    ev = t.events.select("user_id", "ts", "event_id").withColumn("us", micros("ts"))
    d = TS.rolling_rows(ev, "user_id", _EV_ORDER, "us", 2)
    gap = F.col("us") - F.col("_lag1")
    g = d.select(F.floor(gap / 3_600_000_000).cast("bigint").alias("h")).where(F.col("h").isNotNull())
    c = g.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    cal = c.agg(F.max("h").alias("mx")).select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("mx"))).alias("h"))
    return cal.join(c, "h", "left").select((F.col("h") * 3600).alias("gap_start_s"), F.coalesce("n", F.lit(0)).alias("n"))


@query("valid_bounds", oracle=f"""
SELECT user_id, strftime(min(ts) FILTER (WHERE v IS NOT NULL), '%Y-%m-%d %H:%M:%S') AS first_valid,
  strftime(max(ts) FILTER (WHERE v IS NOT NULL), '%Y-%m-%d %H:%M:%S') AS last_valid FROM {_NULLED} GROUP BY user_id
""")
def valid_bounds(t):
    d = t.events.select("user_id", "ts", F.when(F.col("event_type").isin("error", "signup"), F.lit(None)).otherwise(F.col("value")).alias("v"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return d.groupBy("user_id").agg(F.date_format(F.min(F.when(F.col("v").isNotNull(), F.col("ts"))), fmt).alias("first_valid"),
                                    F.date_format(F.max(F.when(F.col("v").isNotNull(), F.col("ts"))), fmt).alias("last_valid"))


@query("dt_accessor", oracle="""
SELECT event_id, CAST(ts AS DATE) AS d, CAST(epoch_us(ts) % 1000000 AS BIGINT) AS microsecond, CAST(weekofyear(ts) AS INTEGER) AS week,
  CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek, day(ts) = 1 AS is_month_start, CAST(ts AS DATE) = last_day(CAST(ts AS DATE)) AS is_month_end,
  day(ts) = 1 AND month(ts) IN (1, 4, 7, 10) AS is_quarter_start,
  CAST(ts AS DATE) = last_day(CAST(ts AS DATE)) AND month(ts) IN (3, 6, 9, 12) AS is_quarter_end,
  day(ts) = 1 AND month(ts) = 1 AS is_year_start, day(ts) = 31 AND month(ts) = 12 AS is_year_end,
  (year(ts) % 4 = 0 AND year(ts) % 100 <> 0) OR year(ts) % 400 = 0 AS is_leap_year, CAST(day(last_day(CAST(ts AS DATE))) AS INTEGER) AS daysinmonth,
  strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS normalized, strftime(ts, '%d/%m/%Y') AS strf,
  strftime(date_trunc('hour', ts + INTERVAL 30 MINUTE), '%Y-%m-%d %H:%M:%S') AS round_h,
  strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS floor_h,
  strftime(CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END, '%Y-%m-%d %H:%M:%S') AS ceil_h,
  monthname(ts) AS month_name, dayname(ts) AS day_name
FROM events
""")
def dt_accessor(t):
    ts = F.col("ts")
    d = ts.cast("date")
    fmt = "yyyy-MM-dd HH:mm:ss"
    floor_h = F.date_trunc("hour", ts)
    m, day = F.month(ts), F.dayofmonth(ts)
    y = F.year(ts)
    return t.events.select(
        "event_id", d.alias("d"), (micros(ts) % 1_000_000).alias("microsecond"), F.weekofyear(ts).alias("week"),
        ((F.dayofweek(ts) + 5) % 7).alias("dayofweek"), (day == 1).alias("is_month_start"), (d == F.last_day(d)).alias("is_month_end"),
        ((day == 1) & m.isin(1, 4, 7, 10)).alias("is_quarter_start"), ((d == F.last_day(d)) & m.isin(3, 6, 9, 12)).alias("is_quarter_end"),
        ((day == 1) & (m == 1)).alias("is_year_start"), ((day == 31) & (m == 12)).alias("is_year_end"),
        (((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)).alias("is_leap_year"), F.dayofmonth(F.last_day(d)).alias("daysinmonth"),
        F.date_format(F.date_trunc("day", ts), fmt).alias("normalized"), F.date_format(ts, "dd/MM/yyyy").alias("strf"),
        F.date_format(F.date_trunc("hour", ts + F.expr("INTERVAL 30 MINUTES")), fmt).alias("round_h"),
        F.date_format(floor_h, fmt).alias("floor_h"),
        F.date_format(F.when(floor_h == ts.cast("timestamp"), ts).otherwise(floor_h + F.expr("INTERVAL 1 HOUR")), fmt).alias("ceil_h"),
        F.date_format(ts, "MMMM").alias("month_name"), F.date_format(ts, "EEEE").alias("day_name"))


@query("ewm", oracle="""
WITH x AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
  count(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM events)
SELECT a.event_id, CASE WHEN any_value(a.n) >= 2 THEN round(sum(b.value * power(0.7, a.pos - b.pos)) / sum(power(0.7, a.pos - b.pos)), 5) END AS ewm
FROM x a JOIN x b ON a.user_id = b.user_id AND b.pos <= a.pos AND b.value IS NOT NULL GROUP BY a.event_id
""")
def ewm(t):
    """EWM mean (alpha 0.3, min_periods 2) of event values per user; see
    ``operators.timeseries.ewm_mean``."""
    ev = t.events.select("user_id", "ts", "event_id", "value")
    return TS.ewm_mean(ev, "user_id", "ts", "value", alpha=0.3, min_periods=2).select("event_id", r(F.col("ewm"), 5).alias("ewm"))


@query("resample_right", oracle="""
WITH per AS (SELECT user_id, CAST(ceil(epoch_us(ts) / 86400000000) AS BIGINT) - 1 AS b, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS std, round(var_samp(value), 7) AS var FROM events GROUP BY 1, 2),
span AS (SELECT user_id, min(b) AS lo_b, max(b) AS hi_b FROM per GROUP BY user_id),
cal AS (SELECT user_id, unnest(range(lo_b, hi_b + 1)) AS b FROM span)
SELECT cal.user_id, (cal.b + 1) * 86400 AS bucket_epoch, mean, std, var FROM cal LEFT JOIN per USING (user_id, b)
""")
def resample_right(t):
    """Daily mean, std and var per user, right-closed and right-labelled."""
    out = TS.resample(t.events, "user_id", "ts", 86400, [r(F.avg("value")).alias("mean"), r(F.stddev_samp("value")).alias("std"),
                                                          r(F.var_samp("value"), 7).alias("var")], closed="right", label="right")
    return out.select("user_id", F.unix_seconds("bucket_start").alias("bucket_epoch"), "mean", "std", "var")


@query("autocorr", oracle="""
SELECT user_id, round(corr(value, before), 6) AS lag1 FROM (
  SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) GROUP BY user_id
""")
def autocorr(t):
    """Lag-1 autocorrelation of the values of each user."""
    d = TS.rolling_rows(t.events.select("user_id", "ts", "event_id", "value"), "user_id", _EV_ORDER, "value", 2)
    c = F.corr(F.when(F.col("_lag1").isNotNull(), F.col("value")), "_lag1")
    return d.groupBy("user_id").agg(r(c).alias("lag1"))


@query("mad", oracle="""
SELECT o_orderpriority, round(avg(abs(o_totalprice - m)), 4) AS mad FROM (
  SELECT o_orderpriority, o_totalprice, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS m FROM orders) GROUP BY o_orderpriority
""")
def mad(t):
    """Mean absolute deviation per group: group means joined back, null-safe."""
    o = t.orders.select("o_orderpriority", "o_totalprice")
    m = o.groupBy(F.col("o_orderpriority").alias("k")).agg(F.avg("o_totalprice").alias("m"))
    return o.join(m, o.o_orderpriority.eqNullSafe(m.k)).groupBy("o_orderpriority").agg(
        r(F.avg(F.abs(F.col("o_totalprice") - F.col("m"))), 4).alias("mad"))
