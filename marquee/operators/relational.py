"""Relational building blocks with explicit scale behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def dedup_keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the smallest ``order``.  Uses
    ``min_by`` (partial aggregation), so a key holding a third of all
    rows is reduced on the map side instead of in one task."""
    rest = [c for c in df.columns if c not in keys and c != order]
    agg = [F.min(order).alias(order)]
    if rest:
        agg.append(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    out = df.groupBy(*keys).agg(*agg)
    return out.select(*keys, order, *([f"_r.{c}" for c in rest]))


def salt(col: Column | str, buckets: int) -> Column:
    """Deterministic salt in [0, buckets) from a row attribute."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def key_bucket(key: str, rows: int, most: int = 20_000) -> Column:
    """Bucket of a key for functions on groups, which cost a call a group:
    all rows of a key are in one bucket, which holds about ``most`` of
    ``rows`` rows; NULL keys are a bucket of their own (NULL)."""
    return F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows // most)))))


def topk_per_group(df: DataFrame, key: str | list[str], order: list[Column], k: int,
                   salt_col: str | None = None, buckets: int = 16) -> DataFrame:
    """Top-k rows per key, skew-safe.

    Stage 1 ranks inside (key, salt) partitions and keeps k rows each;
    stage 2 ranks the at most k * buckets survivors per key.  A hot key is
    spread over ``buckets`` tasks in stage 1.  ``order`` must be a total
    order (include a unique tie-breaker).
    """
    keys = [key] if isinstance(key, str) else list(key)
    s = salt(F.col(salt_col) if salt_col else F.xxhash64(*df.columns), buckets)
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    stage1 = (df.withColumn("_salt", s).withColumn("_rn", F.row_number().over(w1))
              .where(F.col("_rn") <= k).drop("_rn", "_salt"))
    return stage1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)
