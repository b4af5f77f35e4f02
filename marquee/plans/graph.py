"""Graph queries (§2.11) over graphs derived from the order lines.

Supplier graph: an edge s1 → s2 when s2 supplies the line right after a
line of s1 in the same order (distinct, no self loops).  Nation graph:
the same succession between the suppliers' nations.  Both grow with
``lineitem``; per-order windows are bounded by the lines of an order.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.functions.exact import cents, fixed_mean, fixed_mean_sql
from marquee.operators import graph as G
from marquee.operators import timeseries as TS
from marquee.plans.registry import query

# (l_orderkey, l_linenumber) is not unique in the data: order lines by a total order
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey")

SUCC_SQL = """SELECT DISTINCT src, dst FROM (SELECT l_suppkey AS src,
  lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst FROM lineitem)
  WHERE dst IS NOT NULL AND src <> dst"""

NATION_SQL = f"""SELECT DISTINCT a.s_nationkey AS src, b.s_nationkey AS dst FROM ({SUCC_SQL}) e
  JOIN supplier a ON e.src = a.s_suppkey JOIN supplier b ON e.dst = b.s_suppkey"""


def supplier_edges(t):
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    succ = t.lineitem.select(F.col("l_suppkey").alias("src"), F.lead("l_suppkey").over(w).alias("dst"))
    return succ.where(F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))).distinct()


def nation_edges(t):
    e = supplier_edges(t)
    s = t.supplier.select("s_suppkey", "s_nationkey")
    a = s.select(F.col("s_suppkey").alias("src"), F.col("s_nationkey").alias("ns"))
    b = s.select(F.col("s_suppkey").alias("dst"), F.col("s_nationkey").alias("nd"))
    return (e.join(a, "src").join(b, "dst")
            .select(F.col("ns").cast("bigint").alias("src"), F.col("nd").cast("bigint").alias("dst")).distinct())


# ---------------------------------------------------------------- load
@query("edges_load", oracle=f"SELECT src, dst FROM ({SUCC_SQL})")
def edges_load(t):
    """Edge-list text (white-space pairs with ``#`` comment lines) parsed
    back into distinct edges."""
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    li = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("src"),
                           F.lead("l_suppkey").over(w).alias("dst"))
    text = li.select(F.when(F.col("dst").isNull(), F.concat(F.lit("# order "), F.col("l_orderkey").cast("string")))
                     .otherwise(F.concat_ws("  ", "src", "dst")).alias("value"))
    parts = F.split(F.trim("value"), r"\s+")
    parsed = (text.where(~F.col("value").startswith("#"))
              .select(parts[0].cast("bigint").alias("src"), parts[1].cast("bigint").alias("dst")))
    return parsed.where(F.col("src") != F.col("dst")).distinct()


# ---------------------------------------------------------------- PageRank
def _pr_simple_sql(iters: int) -> str:
    ctes = [f"e AS ({NATION_SQL})",
            "l AS (SELECT e.src, e.dst, d.deg FROM e JOIN (SELECT src, count(*) AS deg FROM e GROUP BY src) d USING (src))",
            "r0 AS (SELECT DISTINCT src AS id, 1.0::DOUBLE AS rank FROM l)"]
    for i in range(1, iters + 1):
        ctes.append(f"r{i} AS (SELECT l.dst AS id, 0.15 + 0.85 * sum(r.rank / l.deg) AS rank "
                    f"FROM l JOIN r{i - 1} r ON l.src = r.id GROUP BY l.dst)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT id, round(rank, 6) AS rank FROM r{iters}"


def _pr_sql(iters: int) -> str:
    ctes = [f"e AS ({SUCC_SQL})",
            "l AS (SELECT e.src, e.dst, d.deg FROM e JOIN (SELECT src, count(*) AS deg FROM e GROUP BY src) d USING (src))",
            "v AS (SELECT src AS id FROM e UNION SELECT dst FROM e)",
            "r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM v)"]
    for i in range(1, iters + 1):
        ctes.append(f"r{i} AS (SELECT v.id, 0.15 + 0.85 * coalesce(c.s, 0.0) AS rank FROM v LEFT JOIN "
                    f"(SELECT l.dst, sum(r.rank / l.deg) AS s FROM l JOIN r{i - 1} r ON l.src = r.id GROUP BY l.dst) c "
                    f"ON v.id = c.dst)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT id, round(rank, 6) AS rank FROM r{iters}"


@query("pagerank_simple", oracle=_pr_simple_sql(10))
def pagerank_simple(t):
    pr = G.pagerank_simple(nation_edges(t), iterations=10)
    return pr.select("id", F.round("rank", 6).alias("rank"))


@query("pagerank", oracle=_pr_sql(20))
def pagerank(t):
    """Static 20-round PageRank over the supplier graph (all vertices kept)."""
    pr = G.pagerank(supplier_edges(t), iterations=20)
    return pr.select("id", F.round("rank", 6).alias("rank"))


# ---------------------------------------------------------------- components, triangles, paths
@query("components", oracle=f"""
WITH RECURSIVE e AS ({SUCC_SQL}), u AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
cc(id, label) AS (SELECT src, src FROM u UNION SELECT u.dst, cc.label FROM cc JOIN u ON cc.id = u.src)
SELECT id, min(label) AS label FROM cc GROUP BY id
""")
def components(t):
    """Connected components of the whole supplier graph."""
    return G.connected_components(supplier_edges(t))


# customers (as negative numbers) and the parts of their largest, most discounted lines
_BULK_SQL = "SELECT DISTINCT -o_custkey AS src, l_partkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity >= 49 AND l_discount >= 0.09"


@query("components_bulk", oracle=f"""
WITH RECURSIVE e AS ({_BULK_SQL}), u AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
cc(id, label) AS (SELECT src, src FROM u UNION SELECT u.dst, cc.label FROM cc JOIN u ON cc.id = u.src)
SELECT id, min(label) AS label FROM cc GROUP BY id
""")
def components_bulk(t):
    """Components of the graph of customers and the parts that they buy in
    bulk at a high discount: many, of all sizes."""
    li = t.lineitem.where("l_quantity >= 49 and l_discount >= 0.09").select("l_orderkey", F.col("l_partkey").alias("dst"))
    e = li.join(t.orders.select("o_orderkey", (-F.col("o_custkey")).alias("src")), F.col("l_orderkey") == F.col("o_orderkey")).select("src", "dst").distinct()
    return G.connected_components(e)


@query("triangles", oracle=f"""
WITH c AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM ({SUCC_SQL})),
v AS (SELECT src AS id FROM c UNION SELECT dst FROM c),
t AS (SELECT a.src AS p, a.dst AS q, b.dst AS r FROM c a JOIN c b ON a.src = b.src AND a.dst < b.dst
      JOIN c z ON z.src = a.dst AND z.dst = b.dst),
x AS (SELECT p AS id FROM t UNION ALL SELECT q FROM t UNION ALL SELECT r FROM t)
SELECT v.id, count(x.id) AS triangles FROM v LEFT JOIN x ON v.id = x.id GROUP BY v.id
""")
def triangles(t):
    return G.triangle_counts(supplier_edges(t))


@query("sssp", oracle=f"""
WITH RECURSIVE e AS (SELECT src, dst, 1 + (src + dst) % 3 AS w FROM ({SUCC_SQL})),
v AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
p(id, d) AS (SELECT 1::BIGINT, 0 UNION SELECT e.dst, p.d + e.w FROM p JOIN e ON p.id = e.src WHERE p.d + e.w <= 40)
SELECT v.id, coalesce(CAST(min(p.d) AS DOUBLE), 'inf'::DOUBLE) AS dist FROM v LEFT JOIN p USING (id) GROUP BY v.id
""")
def sssp(t):
    """Shortest paths from supplier 1, weight 1 + (src + dst) mod 3."""
    e = supplier_edges(t).withColumn("w", 1 + (F.col("src") + F.col("dst")) % 3)
    return G.shortest_paths(e, source=1, weight="w")


@query("older_followers", oracle=f"""
SELECT e.dst AS id, count(*) AS n_richer,
  {fixed_mean_sql("sum(CAST(round(a.s_acctbal * 100) AS BIGINT))", "count(*)")} AS mean_richer FROM ({SUCC_SQL}) e
JOIN supplier a ON e.src = a.s_suppkey JOIN supplier b ON e.dst = b.s_suppkey WHERE a.s_acctbal > b.s_acctbal GROUP BY e.dst
""")
def older_followers(t):
    """aggregateMessages: per vertex, count and mean attribute of the
    in-neighbours with a larger attribute (here: account balance)."""
    e = supplier_edges(t)
    s = t.supplier.select("s_suppkey", "s_acctbal")
    a = s.select(F.col("s_suppkey").alias("src"), F.col("s_acctbal").alias("sa"))
    b = s.select(F.col("s_suppkey").alias("dst"), F.col("s_acctbal").alias("sb"))
    j = e.join(a, "src").join(b, "dst").where(F.col("sa") > F.col("sb"))
    return j.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n_richer"),
                                                   fixed_mean(F.sum(cents("sa")), F.count(F.lit(1))).alias("mean_richer"))


@query("subgraph_top", oracle=f"""
WITH sv AS (SELECT s_suppkey AS id, s_name FROM supplier WHERE s_acctbal > 0),
se AS (SELECT e.* FROM ({SUCC_SQL}) e JOIN sv a ON e.src = a.id JOIN sv b ON e.dst = b.id),
d AS (SELECT sv.id, sv.s_name, count(se.dst) AS in_deg FROM sv LEFT JOIN se ON sv.id = se.dst GROUP BY sv.id, sv.s_name)
SELECT id, s_name, in_deg FROM d ORDER BY in_deg DESC, id LIMIT 5
""")
def subgraph_top(t):
    """Subgraph of vertices with a positive balance, in-degrees joined
    back onto all its vertices (0 default), top 5."""
    sv = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("id"), "s_name")
    e = supplier_edges(t)
    se = e.join(sv.select(F.col("id").alias("src")), "src").join(sv.select(F.col("id").alias("dst")), "dst")
    indeg = se.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_deg"))
    d = sv.join(indeg, "id", "left").select("id", "s_name", F.coalesce("in_deg", F.lit(0)).alias("in_deg"))
    return d.orderBy(F.desc("in_deg"), "id").limit(5)


@query("degree_hist", oracle=f"""
WITH e AS ({SUCC_SQL}),
d AS (SELECT s_suppkey AS id, (SELECT count(*) FROM e WHERE e.src = s_suppkey) + (SELECT count(*) FROM e WHERE e.dst = s_suppkey) AS degree FROM supplier)
SELECT degree, count(*) AS vertices FROM d GROUP BY degree
""")
def degree_hist(t):
    deg = G.degrees(supplier_edges(t))
    allv = t.supplier.select(F.col("s_suppkey").alias("id"))
    d = allv.join(deg, "id", "left").select((F.coalesce("in_deg", F.lit(0)) + F.coalesce("out_deg", F.lit(0))).alias("degree"))
    return d.groupBy("degree").agg(F.count(F.lit(1)).alias("vertices"))


_FOLLOW_SQL = """SELECT src, dst FROM (SELECT o_orderkey AS src, lead(o_orderkey) OVER w AS dst, o_orderdate AS day, lead(o_orderdate) OVER w AS next_day
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE next_day <= day + INTERVAL 180 DAY"""


@query("transitive_closure", oracle=f"""
WITH RECURSIVE e AS ({_FOLLOW_SQL}),
tc(src, dst) AS (SELECT src, dst FROM e UNION SELECT tc.src, e.dst FROM tc JOIN e ON tc.dst = e.src)
SELECT src, dst FROM tc
""")
def transitive_closure(t):
    """Closure of the follow-up graph of all orders: an edge leads to the
    customer's next order if that comes within 180 days."""
    d = TS.ranged(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey", ["o_orderdate", "o_orderkey"])
    nxt = TS.shifted(d, "o_custkey", ["o_orderdate", "o_orderkey"], {"dst": ("o_orderkey", -1), "next_day": ("o_orderdate", -1)})
    e = nxt.where(F.col("next_day") <= F.col("o_orderdate") + F.expr("INTERVAL 180 DAYS")).select(F.col("o_orderkey").alias("src"), "dst")
    return G.transitive_closure(e)
