"""Aggregation operators with explicit skew handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.relational import salt


def salted_sum_count(df: DataFrame, key: str | list[str], value: str, buckets: int = 32) -> DataFrame:
    """Two-level aggregate: partial (key, salt) sums and counts, then the
    final per-key merge.  A key holding a third of all rows is reduced by
    ``buckets`` tasks before the final shuffle carries one row per
    (key, salt)."""
    keys = [key] if isinstance(key, str) else list(key)
    s = salt(F.xxhash64(*df.columns), buckets)
    partial = (df.withColumn("_salt", s).groupBy(*keys, "_salt")
               .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"), F.count(F.lit(1)).alias("_rows")))
    return (partial.groupBy(*keys)
            .agg(F.sum("_s").alias("total"), F.sum("_n").alias("n"), F.sum("_rows").alias("rows"))
            .withColumn("mean", F.col("total") / F.col("n")))


def average_struct(value: Column | str) -> Column:
    """A user-defined average as a composition of mergeable partials
    (sum, count) — the typed-Aggregator pattern without a Python UDAF, so
    Spark keeps map-side partial aggregation."""
    v = F.col(value) if isinstance(value, str) else value
    return (F.sum(v) / F.count(v))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long-format summary (statistic, column, value) in one pass."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).cast("double").alias(f"count|{c}"), F.avg(c).alias(f"mean|{c}"),
                 F.stddev(c).alias(f"stddev|{c}"), F.min(c).cast("double").alias(f"min|{c}"),
                 F.max(c).cast("double").alias(f"max|{c}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{a.split('|')[0]}', '{a.split('|')[1]}', `{a}`" for a in wide.columns)
    return wide.selectExpr(f"stack({len(wide.columns)}, {pairs}) AS (statistic, column, value)")


def histogram(df: DataFrame, col: str, edges: list[float]) -> DataFrame:
    """Counts per bucket [edges[i], edges[i+1]); the last bucket also
    holds its upper edge (RDD ``histogram`` semantics).  Values outside
    the edges are not counted."""
    lo, hi = edges[0], edges[-1]
    expr = None
    for i in range(len(edges) - 1):
        cond = (F.col(col) >= edges[i]) & ((F.col(col) < edges[i + 1]) if i < len(edges) - 2 else (F.col(col) <= hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    b = df.select(expr.alias("bucket")).where(F.col("bucket").isNotNull())
    counts = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    _ = lo
    return counts
