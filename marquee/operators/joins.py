"""Join operators Spark has no single built-in for.

* ``asof_join`` — backward / forward / nearest, optional ``by`` keys,
  tolerance and exact-match flag.  Both sides are sorted into one
  range-partitioned pass over (by, time), so a key that holds a third of
  all rows is split by its rows; the last right row before (or the first
  after) a part's rows crosses its border in a carry of one row a part.
* ``range_join`` — point-in-interval without an equality key: intervals
  are exploded onto fixed-width bins, then an equi join on the bin plus
  the exact range filter.
* ``range_count`` — how many points each interval holds, without the pairs.
* ``salted_join`` — spreads a hot join key over ``buckets`` tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import timeseries as TS
from marquee.operators.relational import salt


def _time_num(df: DataFrame, col: str) -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(col)).cast("bigint")
    return F.col(col)


def asof_join(left: DataFrame, right: DataFrame, on: str, by: list[str] | str | None = None,
              right_on: str | None = None, direction: str = "backward",
              tolerance: float | None = None, allow_exact_matches: bool = True,
              suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """pandas-style ``merge_asof`` on DataFrames.

    Every left row is kept; right columns (all but ``by``, and but ``on``
    where both sides call it so) are NULL when there is no match.  Columns
    that both sides have get the suffixes.  ``on`` timestamps are compared
    in microseconds (``tolerance`` too), other ``on`` columns as they are.
    Of right rows at one time the largest counts, in every direction; a NULL
    key or time matches nothing."""
    by = [by] if isinstance(by, str) else list(by or [])
    right_on = right_on or on
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(direction)
    payload = [c for c in right.columns if c not in by and not (c == on == right_on)]
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in by], F.lit(True))
    # all columns of a side travel in one struct: no name can clash
    keys = lambda df: F.struct(*[F.col(c).cast(left.schema[c].dataType) for c in by]) if by else F.lit(0)
    lefts = left.select(keys(left).alias("key"), _time_num(left, on).alias("t"), known.alias("known"), F.struct(*left.columns).alias("l"))
    rights = right.where(known).select(keys(right).alias("key"), _time_num(right, right_on).alias("t"),
                                       *[F.col(c).alias(f"c{i}") for i, c in enumerate(payload)]).where("t is not null")
    value = F.struct(F.col("t").alias("t"), F.struct(*[F.col(f"c{i}") for i in range(len(payload))]).alias("row")) if payload else F.struct(F.col("t").alias("t"))
    rights = rights.select("key", "t", value.alias("r")).groupBy("key", "t").agg(F.max("r").alias("r"))

    def matched(right_first: bool) -> DataFrame:
        """Rows of both sides in one order; right rows at a left row's time
        come before it or after it."""
        u = lefts.withColumn("o", F.lit(1)).unionByName(rights.withColumn("o", F.lit(0 if right_first else 2)), allowMissingColumns=True)
        return TS.ranged(u, "key", ["t", "o"])

    fill = lambda d, out, backward: TS.fill(d, "key", ["t", "o"], "r", out, backward)
    if direction == "nearest":
        if allow_exact_matches:
            # a match at the same time is found by looking back: no other is nearer
            d = fill(fill(matched(True), "p", False), "n", True)
        else:
            d = fill(matched(False), "p", False).drop("_b")
            d = fill(TS.ranged(d.withColumn("o", F.when(F.col("l").isNull(), 0).otherwise(1)), "key", ["t", "o"]), "n", True)
        earlier = F.col("n").isNull() | (F.col("p").isNotNull() & (F.col("t") - F.col("p.t") <= F.col("n.t") - F.col("t")))
        d = d.withColumn("m", F.when(earlier, F.col("p")).otherwise(F.col("n")))
    else:
        back = direction == "backward"
        d = fill(matched(back == allow_exact_matches), "m", not back)
    fits = F.col("known") & F.col("t").isNotNull()
    if tolerance is not None:
        fits = fits & (F.abs(F.col("t") - F.col("m.t")) <= F.lit(tolerance))
    d = d.where("l is not null").withColumn("m", F.when(fits, F.col("m")))
    shared = set(left.columns) & set(payload)
    return d.select(*[F.col(f"l.`{c}`").alias(c + suffixes[0] if c in shared else c) for c in left.columns],
                    *[F.col(f"m.row.c{i}").alias(c + suffixes[1] if c in shared else c) for i, c in enumerate(payload)])


def range_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str,
               bin_width: float, how: str = "inner") -> DataFrame:
    """Rows of ``points`` joined with every interval ``[start, end)``
    containing ``point``.  Timestamps are compared in microseconds and
    ``bin_width`` uses that unit.  An interval covers
    ``(end - start) / bin_width + 1`` bins at most."""
    p = _time_num(points, point)
    s, e = _time_num(intervals, start), _time_num(intervals, end)
    pb = points.withColumn("_p", p).withColumn("_bin", F.floor(F.col("_p") / bin_width))
    ib = (intervals.withColumn("_s", s).withColumn("_e", e)
          .withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_s") / bin_width),
                                                   F.floor((F.col("_e") - F.lit(1)) / bin_width)))))
    cond = (pb["_bin"] == ib["_bin"]) & (pb["_p"] >= ib["_s"]) & (pb["_p"] < ib["_e"])
    out = pb.join(ib, cond, how)
    return out.drop("_p", "_s", "_e", "_bin")


def range_count(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, by: str, out: str = "n") -> DataFrame:
    """Rows (``by``, ``out``): the points in the intervals ``[start, end)`` of
    each ``by`` of ``intervals``, summed over its rows; what a range join and
    a count return, without making the pairs, so that dense times cost no
    more than sparse ones.  Points and both ends of the intervals lie in one
    order, in which the points before each end are a running sum.  Ends that
    are NULL belong to no interval."""
    known = intervals.select(F.col(by).alias("by"), _time_num(intervals, start).alias("s"), _time_num(intervals, end).alias("e")).where("s < e")
    ends = known.select("by", F.explode(F.array(F.struct(F.col("s").alias("t"), F.lit(-1).alias("sign")),
                                                F.struct(F.col("e").alias("t"), F.lit(1).alias("sign")))).alias("x")).select("by", "x.t", "x.sign")
    held = points.select(_time_num(points, point).alias("t")).where("t is not null").groupBy("t").agg(F.count(F.lit(1)).alias("w"))
    # ends come before the points at their time: a start includes them, an end does not
    u = (ends.withColumn("o", F.lit(0)).unionByName(held.withColumn("o", F.lit(1)), allowMissingColumns=True)
         .withColumns({"one": F.lit(0), "w": F.coalesce("w", F.lit(0).cast("long"))}))
    r = TS.running(TS.ranged(u, "one", ["t", "o"]), "one", ["t", "o"], {"before": ("sum", "w")}).where("o = 0")
    return r.groupBy(F.col("by").alias(by)).agg(F.sum(F.col("sign") * F.col("before")).alias(out))


def salted_join(big: DataFrame, small: DataFrame, on: list[str] | str, buckets: int = 16,
                how: str = "inner") -> DataFrame:
    """Equi join with the big side's rows spread over ``buckets`` salts
    and the small side replicated once per salt.  Both sides are shuffled:
    the planner knows nothing of the replicas and would broadcast them, all
    through the driver."""
    keys = [on] if isinstance(on, str) else list(on)
    b = big.withColumn("_salt", salt(F.xxhash64(*big.columns), buckets))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s.hint("merge"), on=[*keys, "_salt"], how=how).drop("_salt")


def merge_update(target: DataFrame, updates: DataFrame, on: list[str] | str,
                 overwrite: bool = True) -> DataFrame:
    """pandas ``update`` / ``combine_first`` on key-aligned frames: the
    updates' non-null values replace (``overwrite``) or fill
    (``combine_first``) the target's.  Keys match null-safely; of updates
    that repeat a key the largest value of each column counts, so no target
    row is multiplied."""
    keys = [on] if isinstance(on, str) else list(on)
    cols = [c for c in target.columns if c not in keys and c in updates.columns]
    u = updates.groupBy(*keys).agg(F.struct(*[F.max(c).alias(c) for c in cols]).alias("new")) if cols else updates.select(*keys).distinct().withColumn("new", F.lit(None))
    match = reduce(Column.__and__, [F.col(f"old.{k}").eqNullSafe(F.col(f"upd.{k}")) for k in keys])
    j = target.alias("old").join(u.alias("upd"), match, "left")

    def value(c: str) -> Column:
        if c not in cols:
            return F.col(f"old.{c}")
        new, old = F.col(f"upd.new.{c}"), F.col(f"old.{c}")
        return (F.coalesce(new, old) if overwrite else F.coalesce(old, new)).alias(c)
    return j.select(*[value(c) for c in target.columns])
