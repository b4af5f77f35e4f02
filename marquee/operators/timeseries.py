"""Time-series operators over keyed event tables.

All windowed helpers share one layout: the rows are range-partitioned once
by (key, order) and cut there (``checkpoint``), so a hot key is split by its
rows, whatever the data look like.  Windows run inside (key, partition).
What crosses a partition border is carried by a table with one row for each
(key, partition); only a key that began in an earlier partition needs it,
and that is at most one key a partition, so the carry is broadcast with a
proven bound: the number of partitions.

NULL keys form a group of their own and NULL times sort first, as in a
plain window; no row is ever lost.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import checkpoint_dir

ALL = Window.unboundedPreceding, Window.unboundedFollowing


def _epoch_s(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000.0


def _cols(order: list) -> list[Column]:
    return [o if isinstance(o, Column) else F.col(o) for o in order]


def parted(df: DataFrame, key: str, most: int = 1_000_000) -> DataFrame:
    """``df`` hash-partitioned by ``key`` into parts of about ``most`` rows,
    however many rows it has: sorts and windows on the key stay bounded."""
    fewest = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(fewest, -(-df.count() // most)), key)


def ranged(df: DataFrame, key: str, order: list) -> DataFrame:
    """``df`` range-partitioned by (key, order) and materialised, with the
    partition number in ``_b``: it never decreases along a key's order."""
    checkpoint_dir(df.sparkSession)
    by = [F.col(key).asc()] + _cols(order)
    return df.repartitionByRange(*by).withColumn("_b", F.spark_partition_id()).checkpoint()


def _inside(key: str, order: list):
    return Window.partitionBy(key, "_b").orderBy(*_cols(order))


def _attach(d: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    """Join the carry (at most two rows a partition) to the rows, null-safe."""
    c = carry.withColumnsRenamed({key: "_ck", "_b": "_cb"})
    return d.join(F.broadcast(c), F.col(key).eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left").drop("_ck", "_cb")


def running(d: DataFrame, key: str, order: list, aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Running aggregates on a ranged frame: ``aggs`` maps an output column
    to (``sum`` | ``count`` | ``min`` | ``max``, input column)."""
    fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    w = _inside(key, order).rowsBetween(Window.unboundedPreceding, 0)
    out = d.withColumns({f"_l_{o}": fn[k](c).over(w) for o, (k, c) in aggs.items()})
    per = Window.partitionBy(key).orderBy("_b")
    total = d.groupBy(key, "_b").agg(*[fn[k](c).alias(f"_t_{o}") for o, (k, c) in aggs.items()])
    carry = total.select(key, "_b", F.row_number().over(per).alias("_i"), *[
        merge[k](f"_t_{o}").over(per.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_c_{o}") for o, (k, _) in aggs.items()])
    out = _attach(out, carry.where("_i > 1").drop("_i"), key)
    for o, (k, _) in aggs.items():
        local, before = F.col(f"_l_{o}"), F.col(f"_c_{o}")
        joint = F.coalesce(local + before, local, before) if k in ("sum", "count") else (F.least if k == "min" else F.greatest)(local, before)
        out = out.withColumn(o, joint)
    return out.drop(*[f"_{x}_{o}" for o in aggs for x in "lc"])


def fill(d: DataFrame, key: str, order: list, col: str, out: str, backward: bool = False) -> DataFrame:
    """Last (``backward``: next) known value of ``col`` on a ranged frame."""
    w, per = _inside(key, order), Window.partitionBy(key).orderBy("_b")
    d = d.withColumn("_rn", F.row_number().over(w))
    known = F.when(F.col(col).isNotNull(), F.col("_rn"))
    pick, frame, beyond = (F.min_by, w.rowsBetween(0, Window.unboundedFollowing), per.rowsBetween(1, Window.unboundedFollowing)) if backward else \
        (F.max_by, w.rowsBetween(Window.unboundedPreceding, 0), per.rowsBetween(Window.unboundedPreceding, -1))
    near = F.first if backward else F.last
    ends = d.groupBy(key, "_b").agg(pick(col, known).alias("_v"))
    carry = ends.select(key, "_b", near("_v", ignorenulls=True).over(beyond).alias("_c"), F.count(F.lit(1)).over(beyond).alias("_i"))
    local = d.withColumn("_l", near(col, ignorenulls=True).over(frame))
    return _attach(local, carry.where("_i > 0").drop("_i"), key).withColumn(out, F.coalesce("_l", "_c")).drop("_l", "_c", "_rn")


def shifted(d: DataFrame, key: str, order: list, shifts: dict[str, tuple[str, int]]) -> DataFrame:
    """Values ``i`` rows back (i > 0) or ahead (i < 0) on a ranged frame:
    ``shifts`` maps an output column to (input column, i).  The last and
    first max(|i|) rows of every (key, partition) are the carry."""
    w, per = _inside(key, order), Window.partitionBy(key).orderBy("_b")
    back = max([i for _, i in shifts.values() if i > 0], default=0)
    ahead = max([-i for _, i in shifts.values() if i < 0], default=0)
    cols = sorted({c for c, _ in shifts.values()})
    d = d.withColumns({"_rn": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy(key, "_b"))})
    row = F.struct("_rn", *[F.col(c).alias(f"_x_{c}") for c in cols])
    ends = d.where((F.col("_rn") <= ahead) | (F.col("_rn") > F.col("_n") - back)).groupBy(key, "_b").agg(
        F.array_sort(F.collect_list(F.when(F.col("_rn") > F.col("_n") - back, row))).alias("_tail"),
        F.array_sort(F.collect_list(F.when(F.col("_rn") <= ahead, row))).alias("_head"))
    # every (key, partition) holds a row at least, so |i| neighbours are enough
    carry = ends.select(key, "_b",
                        F.flatten(F.collect_list("_tail").over(per.rowsBetween(-max(back, 1), -1))).alias("_before"),
                        F.flatten(F.collect_list("_head").over(per.rowsBetween(1, max(ahead, 1)))).alias("_after"),
                        F.count(F.lit(1)).over(Window.partitionBy(key)).alias("_i"))
    out = d.withColumns({f"_s_{o}": (F.lag(c, i) if i > 0 else F.lead(c, -i)).over(w) for o, (c, i) in shifts.items()})
    out = _attach(out, carry.where("_i > 1").drop("_i"), key)
    for o, (c, i) in shifts.items():
        if i > 0:
            at = F.size("_before") - (F.lit(i) - F.col("_rn"))          # 1-based place from the end
            far = F.when((F.col("_rn") <= i) & (at >= 1), F.try_element_at("_before", at.cast("int"))[f"_x_{c}"])
            here = F.when(F.col("_rn") > i, F.col(f"_s_{o}"))
        else:
            at = F.lit(-i) - (F.col("_n") - F.col("_rn"))
            far = F.when(at >= 1, F.try_element_at("_after", at.cast("int"))[f"_x_{c}"])
            here = F.when(F.col("_rn") - i <= F.col("_n"), F.col(f"_s_{o}"))
        out = out.withColumn(o, F.coalesce(here, far))
    return out.drop("_rn", "_n", "_before", "_after", *[f"_s_{o}" for o in shifts])


def sessionize(df: DataFrame, key: str, ts: str, gap_s: float, close: Column | None = None) -> DataFrame:
    """Gaps-and-islands sessions: a new session starts when the previous
    event of the key is more than ``gap_s`` seconds earlier.

    Adds ``session_id`` (1-based, per key, in order of time and then all
    columns).  ``close`` (boolean column) marks events that end their
    session.  An event with or after an unknown time starts a session."""
    order = [F.col("_t")] + [F.col(c) for c in df.columns]
    d = df.withColumn("_t", _epoch_s(ts)).withColumn("_close", F.coalesce(close, F.lit(False)) if close is not None else F.lit(False))
    d = ranged(d, key, order)
    w, per = _inside(key, order), Window.partitionBy(key).orderBy("_b")
    opens = lambda t, last, shut: F.coalesce(last.isNull() | (t - last > gap_s) | shut, F.lit(True))
    d = d.withColumns({"_rn": F.row_number().over(w), "_prev": F.lag("_t").over(w), "_shut": F.lag("_close").over(w)})
    d = d.withColumn("_new", F.when(F.col("_rn") > 1, opens(F.col("_t"), F.col("_prev"), F.col("_shut")).cast("int")).otherwise(0))
    ends = d.groupBy(key, "_b").agg(F.min_by("_t", "_rn").alias("_first"), F.max_by(F.struct("_t", "_close"), "_rn").alias("_last"), F.sum("_new").alias("_n"))
    ends = ends.withColumn("_before", F.lag("_last").over(per))
    ends = ends.withColumn("_open", F.when(F.col("_before").isNull(), 1).otherwise(opens(F.col("_first"), F.col("_before._t"), F.col("_before._close")).cast("int")))
    carry = ends.withColumn("_offset", F.sum(F.col("_n") + F.col("_open")).over(per.rowsBetween(Window.unboundedPreceding, -1)))
    carry = carry.where("_before is not null").select(key, "_b", (F.col("_offset") + F.col("_open")).alias("_start"))
    d = d.withColumn("_local", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (_attach(d, carry, key).withColumn("session_id", (F.coalesce("_start", F.lit(1)) + F.col("_local")).cast("bigint"))
            .select(*df.columns, "session_id"))


def sessions_summary(df: DataFrame, key: str, ts: str, gap_s: float) -> DataFrame:
    """One row per session: start, end (last event), events."""
    s = sessionize(df, key, ts, gap_s)
    return s.groupBy(key, "session_id").agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
                                            F.count(F.lit(1)).alias("events"))


def bucketed_fill(df: DataFrame, key: str, order: list, col: str, out: str, backward: bool = False) -> DataFrame:
    """Forward (or backward) fill of ``col`` per key in ``order``."""
    return fill(ranged(df, key, order), key, order, col, out, backward).drop("_b")


def bucketed_running(df: DataFrame, key: str, order: list, aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Running (expanding) aggregates per key; see :func:`running`."""
    return running(ranged(df, key, order), key, order, aggs).drop("_b")


def positions(df: DataFrame, key: str, order: list, out: str = "pos") -> DataFrame:
    """1-based row position per key in ``order``."""
    return bucketed_running(df.withColumn("_one", F.lit(1)), key, order, {out: ("count", "_one")}).drop("_one")


def rank_columns(df: DataFrame, key: str, value: str, tie: str, descending: bool = True, ntiles: int = 4) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank, cume_dist and ntile per
    key ordered by ``value`` (then ``tie``).

    One pass: ranks inside (key, partition); the carry has the rows and
    distinct values before, the first rank of a value that began earlier
    and the last position of one that goes on."""
    v = F.col(value).desc() if descending else F.col(value).asc()
    order = [v, F.col(tie).asc()]
    d = ranged(df, key, order)
    w, peers, per = _inside(key, order), Window.partitionBy(key, "_b").orderBy(v), Window.partitionBy(key).orderBy("_b")
    d = d.withColumns({"_rn": F.row_number().over(w), "_rank": F.rank().over(peers), "_dense": F.dense_rank().over(peers),
                       "_end": F.count(F.lit(1)).over(peers.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
                       "_n": F.count(F.lit(1)).over(Window.partitionBy(key, "_b"))})
    s = d.groupBy(key, "_b").agg(
        F.first("_n").alias("n"), F.max("_dense").alias("dense"),
        F.min_by(F.struct(F.col(value).alias("v"), F.col("_end").alias("end")), "_rn").alias("head"),
        F.max_by(F.struct(F.col(value).alias("v"), F.col("_rank").alias("rank")), "_rn").alias("tail"))
    earlier, later = per.rowsBetween(Window.unboundedPreceding, -1), per.rowsBetween(1, Window.unboundedFollowing)
    s = s.withColumns({
        "i": F.row_number().over(per), "total": F.sum("n").over(Window.partitionBy(key)),
        "parts": F.count(F.lit(1)).over(Window.partitionBy(key)),
        "rows": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        "goes_back": F.lag("tail").over(per), "goes_on": F.lead("head").over(per)})
    s = s.withColumns({"back": F.col("goes_back").isNotNull() & F.col("goes_back.v").eqNullSafe(F.col("head.v")),
                       "on": F.col("goes_on").isNotNull() & F.col("goes_on.v").eqNullSafe(F.col("tail.v")),
                       "one": F.col("dense") == 1})
    s = s.withColumns({
        "values": F.coalesce(F.sum("dense").over(earlier), F.lit(0)) - F.sum(F.col("back").cast("int")).over(per.rowsBetween(Window.unboundedPreceding, 0)),
        "began": F.when(~(F.col("back") & F.col("one")), F.col("rows") + F.col("tail.rank")),
        "ends": F.when(~(F.col("on") & F.col("one")), F.col("rows") + F.col("head.end"))})
    s = s.withColumns({"first_rank": F.when(F.col("back"), F.last("began", ignorenulls=True).over(earlier)),
                       "last_end": F.when(F.col("on"), F.first("ends", ignorenulls=True).over(later))})
    carry = s.where("parts > 1").select(key, "_b", *[F.col(c).alias(f"_c_{c}") for c in ("total", "rows", "values", "first_rank", "last_end", "dense")])
    j = _attach(d, carry, key)
    zero = lambda c: F.coalesce(F.col(f"_c_{c}"), F.lit(0))
    rn, n = F.col("_rn") + zero("rows"), F.coalesce("_c_total", "_n")
    rank = F.coalesce(F.when(F.col("_dense") == 1, F.col("_c_first_rank")), F.col("_rank") + zero("rows"))
    end = F.coalesce(F.when(F.col("_dense") == F.col("_c_dense"), F.col("_c_last_end")), F.col("_end") + zero("rows"))
    q, r = F.floor(n / ntiles), n % ntiles
    big = (q + 1) * r
    tile = (F.when(q == 0, rn).when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1)
            .otherwise(r + F.floor((rn - big - 1) / F.when(q > 0, q)) + 1)).cast("int")
    return j.select(*df.columns, rn.alias("rn"), rank.alias("rnk"), (F.col("_dense") + zero("values")).alias("drnk"),
                    F.when(n > 1, (rank - 1) / (n - 1)).otherwise(F.lit(0.0)).alias("prank"), (end / n).alias("cdist"), tile.alias("ntile"))


def rolling_rows(df: DataFrame, key: str, order: list, col: str, k: int) -> DataFrame:
    """Values of the k-1 preceding rows per key as columns ``_lag1``…"""
    return shifted(ranged(df, key, order), key, order, {f"_lag{i}": (col, i) for i in range(1, k)}).drop("_b")


def range_window(df: DataFrame, key: str, ts: str, range_s: int, col: str,
                 bucket_s: int | None = None) -> DataFrame:
    """Count and sum of ``col`` over each row's trailing time range
    [t - range, t] per key (RANGE frame), skew-safe.

    Buckets are at least as wide as the range, so a frame touches its own
    bucket and the previous one: each row is also copied once into the
    next bucket as context (a one-bucket halo), the window runs inside
    (key, bucket), and only native rows are kept.  Rows without a time are
    each other's frame, as in a plain window."""
    bucket_s = max(bucket_s or range_s, range_s)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.withColumn("_us", us).withColumn("_b", F.floor(F.col("_us") / (bucket_s * 1_000_000)).cast("bigint"))
    native = d.withColumn("_native", F.lit(True))
    halo = d.where("_b is not null").withColumn("_b", F.col("_b") + 1).withColumn("_native", F.lit(False))
    u = native.unionByName(halo)
    w = Window.partitionBy(key, "_b").orderBy("_us").rangeBetween(-range_s * 1_000_000, 0)
    u = u.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_s", F.sum(col).over(w))
    return u.where("_native").drop("_us", "_b", "_native")


def interpolate_linear(df: DataFrame, key: str, order: list, col: str, out: str | None = None, limit: int | None = None,
                       limit_direction: str = "forward") -> DataFrame:
    """pandas ``interpolate(method='linear')`` per key: nulls between two
    known values are filled on the straight line by row position;
    leading nulls stay null, trailing nulls take the last value.

    ``limit``: at most so many nulls in a row are filled, counted from the
    known value before (``forward``), after (``backward``, which fills
    leading nulls and not trailing ones) or both."""
    out = out or col
    d = running(ranged(df.withColumn("_one", F.lit(1)), key, order), key, order, {"_pos": ("count", "_one")}).drop("_one")
    d = d.withColumn("_kn", F.when(F.col(col).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(col).alias("v"))))
    d = fill(fill(d, key, order, "_kn", "_prev"), key, order, "_kn", "_next", backward=True)
    back, ahead = F.col("_pos") - F.col("_prev.p"), F.col("_next.p") - F.col("_pos")
    line = F.col("_prev.v") + (F.col("_next.v") - F.col("_prev.v")) * back / (F.col("_next.p") - F.col("_prev.p"))
    end = F.col("_prev.v") if limit_direction == "forward" else F.col("_next.v") if limit_direction == "backward" else F.coalesce("_prev.v", "_next.v")
    near = F.lit(True)
    if limit is not None:
        from_before, from_after = F.coalesce(back <= limit, F.lit(False)), F.coalesce(ahead <= limit, F.lit(False))
        near = {"forward": from_before, "backward": from_after, "both": from_before | from_after}[limit_direction]
    val = F.when(F.col(col).isNotNull(), F.col(col)).when(near, F.coalesce(line, end))
    return d.withColumn(out, val).select(*df.columns, *([out] if out not in df.columns else []))


def ewm_alpha(alpha: float | None = None, com: float | None = None, span: float | None = None, halflife: float | None = None) -> float:
    """The smoothing factor of exactly one of the four parameters."""
    given = [x for x in (alpha, com, span, halflife) if x is not None]
    if len(given) != 1:
        raise ValueError("give one of alpha, com, span and halflife")
    if com is not None:
        return 1 / (1 + com)
    if span is not None:
        return 2 / (span + 1)
    return 1 - 0.5 ** (1 / halflife) if halflife is not None else alpha


def ewm_mean(df: DataFrame, key: str, ts: str, value: str, alpha: float | None = None, min_periods: int = 0, out: str = "ewm",
             com: float | None = None, span: float | None = None, halflife: float | None = None, ignore_na: bool = False) -> DataFrame:
    """Exponentially weighted mean (pandas ``ewm(…, adjust=True).mean()``)
    per key in time order (ties broken by all columns).

    y_t = S_t / W_t, where S and W decay by 1-α a row (``ignore_na``: a known
    value) and a known x adds x to S and 1 to W.  The recurrence runs over
    sorted partitions as a stream, so no task holds a key; the states at
    partition ends are chained over one row for each (key, partition) and
    added, decayed, to the rows of a key that began earlier."""
    import math

    import numpy as np
    import pandas as pd

    beta = 1.0 - ewm_alpha(alpha, com, span, halflife)
    order = [F.col("_t"), *[F.col(c) for c in df.columns]]
    d = df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    d = d.repartitionByRange(F.col(key).asc(), *order).sortWithinPartitions(F.col(key).asc(), *order)
    d = d.withColumn("_b", F.spark_partition_id()).withColumn("_x", F.col(value).cast("double"))
    d = d.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit("\x00null")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields)

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, s, w, k, n, i = None, 0.0, 0.0, 0, 0, 0
        for pdf in frames:
            rows = []
            for cur, x in zip(pdf["_key"], pdf["_x"].to_numpy(dtype="float64")):
                if cur != last:
                    last, s, w, k, n, i = cur, 0.0, 0.0, 0, 0, 0
                known = not math.isnan(x)
                if known or not ignore_na:
                    s, w, k = beta * s, beta * w, k + 1
                if known:
                    s, w, n = s + x, w + 1.0, n + 1
                i += 1
                rows.append((s, w, k, n, i))
            a = np.array(rows, float).reshape(-1, 5)
            yield pdf.assign(_s=a[:, 0], _w=a[:, 1], _k=a[:, 2].astype("int64"), _n=a[:, 3].astype("int64"), _i=a[:, 4].astype("int64"))

    checkpoint_dir(df.sparkSession)
    loc = d.mapInPandas(local, f"{fields}, _s double, _w double, _k long, _n long, _i long").checkpoint()
    ends = loc.groupBy("_key", "_b").agg(F.max_by(F.struct("_s", "_w", "_k", "_n"), "_i").alias("e"))
    ends = ends.withColumn("_parts", F.count(F.lit(1)).over(Window.partitionBy("_key"))).where("_parts > 1").select("_key", "_b", "e.*")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_b")
        s = w = 0.0
        n, rows = 0, []
        for b, se, we, k, m in zip(pdf["_b"], pdf["_s"], pdf["_w"], pdf["_k"], pdf["_n"]):
            rows.append((pdf["_key"].iloc[0], int(b), s, w, n))
            s, w, n = se + beta ** int(k) * s, we + beta ** int(k) * w, n + int(m)
        return pd.DataFrame(rows, columns=["_ck", "_cb", "_cs", "_cw", "_cn"])

    # one row for each partition of a key that spans several
    carry = ends.groupBy("_key").applyInPandas(chain, "_ck string, _cb int, _cs double, _cw double, _cn long")
    j = loc.join(F.broadcast(carry), (F.col("_key") == F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left")
    decay = F.pow(F.lit(beta), F.col("_k"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    s, w = F.col("_s") + decay * zero("_cs"), F.col("_w") + decay * zero("_cw")
    n = F.col("_n") + F.coalesce("_cn", F.lit(0))
    return j.withColumn(out, F.when((w > 0) & (n >= min_periods), s / w)).select(*df.columns, out)


def resample(df: DataFrame, key: str, ts: str, rule_s: int, aggs: list[Column], closed: str = "left", label: str = "left") -> DataFrame:
    """pandas ``resample(rule, closed=, label=).agg(...)`` per key; empty
    buckets between a key's first and last bucket appear with null
    aggregates (count-like aggregates → 0 is up to the caller).  Rows
    without a time are in no bucket."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    step = rule_s * 1_000_000
    b = F.floor(us / step) if closed == "left" else F.ceil(us / step) - 1
    per = df.where(F.col(ts).isNotNull()).groupBy(key, b.cast("bigint").alias("_b")).agg(*aggs)
    span = per.groupBy(key).agg(F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    cal = span.select(F.col(key).alias("_ck"), F.explode(F.sequence("_lo", "_hi")).alias("_cb"))
    out = cal.join(per, F.col("_ck").eqNullSafe(F.col(key)) & (F.col("_cb") == F.col("_b")), "left")
    edge = F.col("_cb") if label == "left" else F.col("_cb") + 1
    return out.select(F.col("_ck").alias(key), *[c for c in per.columns if c not in (key, "_b")],
                      F.timestamp_seconds(edge * rule_s).alias("bucket_start"))
