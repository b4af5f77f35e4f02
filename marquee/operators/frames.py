"""Labelled frames: alignment on an index, comparison, products.

A frame's index is one or more columns; labels match null-safely (a NULL
label is a label).  An index label may occur once only in each frame: a
second row with it is an error (``check``), as its partner would not be
defined.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.linalg import BLOCK_ROWS, MAX_COLUMNS


def _keys(on: list[str] | str) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _fresh(taken: list[str], name: str) -> str:
    while name in taken:
        name += "_"
    return name


def checked(df: DataFrame, on: list[str] | str) -> DataFrame:
    """``df``, failing where a label of its index repeats."""
    keys = _keys(on)
    rest = [c for c in df.columns if c not in keys]
    n = _fresh(df.columns, "n")
    one = df.groupBy(*keys).agg(F.count("*").alias(n), F.any_value(F.struct(*rest)).alias(_fresh(df.columns, "row")))
    row = one.columns[-1]
    # the label is read through the check, so that no plan can drop it
    safe = F.when(F.col(n) == 1, F.col(keys[0])).otherwise(F.raise_error(F.concat(F.lit("repeated label "), F.coalesce(F.to_json(F.struct(*keys)), F.lit("null")))).cast(df.schema[keys[0]].dataType))
    return one.select(safe.alias(keys[0]), *keys[1:], *[F.col(f"{row}.{c}").alias(c) for c in rest]).select(*df.columns)


def align(left: DataFrame, right: DataFrame, on: list[str] | str, join: str = "outer", fill=None,
          suffixes: tuple[str, str] = ("_left", "_right"), check: bool = True) -> DataFrame:
    """Both frames over one index and one set of columns.

    Columns: the index, then each column of either frame with both suffixes
    (NULL, or ``fill``, where a frame lacks the label or the column).
    ``join``: outer, inner, left or right labels."""
    keys = _keys(on)
    if check:
        left, right = checked(left, keys), checked(right, keys)
    cols = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys and c not in left.columns]
    both = left.columns + right.columns
    there = {"a": _fresh(both, "in_left"), "b": _fresh(both, "in_right")}
    a = left.withColumn(there["a"], F.lit(True)).alias("a")
    b = right.withColumn(there["b"], F.lit(True)).alias("b")
    match = reduce(Column.__and__, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    j = a.join(b, match, {"outer": "full", "inner": "inner", "left": "left", "right": "right"}[join])
    index = [F.when(F.col(there["a"]), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys]

    def value(side: str, frame: DataFrame, c: str) -> Column:
        kind = (frame if c in frame.columns else (right if frame is left else left)).schema[c].dataType
        v = F.col(f"{side}.{c}") if c in frame.columns else F.lit(None).cast(kind)
        return F.coalesce(v, F.lit(fill).cast(kind)) if fill is not None else v
    return j.select(*index, *[value(side, frame, c).alias(c + s) for c in cols for side, frame, s in (("a", left, suffixes[0]), ("b", right, suffixes[1]))])


def compare(left: DataFrame, right: DataFrame, on: list[str] | str, keep_shape: bool = False, keep_equal: bool = False,
            names: tuple[str, str] = ("self", "other"), check: bool = True) -> DataFrame:
    """Cells in which two frames with the same labels differ (two NULLs are
    equal): the index and, for each column, both values, NULL where they are
    equal (``keep_equal``: as they are).  Rows and columns without a
    difference go, unless ``keep_shape``.  A label of one frame alone is an
    error with ``check``; without it, its cells differ from NULL."""
    keys = _keys(on)
    cols = [c for c in left.columns if c not in keys]
    if sorted(cols) != sorted(c for c in right.columns if c not in keys):
        raise ValueError("frames with different columns cannot be compared")
    mark = _fresh(left.columns, "here")
    a, b = (d.withColumn(mark, F.lit(1)) for d in (left, right))
    j = align(a, b, keys, suffixes=("_a", "_b"), check=check)
    if check:
        lone = F.col(f"{mark}_a").isNull() | F.col(f"{mark}_b").isNull()
        k = keys[0]
        j = j.withColumn(k, F.when(lone, F.raise_error(F.lit("frames with different labels cannot be compared")).cast(j.schema[k].dataType)).otherwise(F.col(k)))
    differs = {c: ~F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in cols}
    if not keep_shape and cols:
        found = j.agg(*[F.coalesce(F.bool_or(differs[c]), F.lit(False)).alias(f"d{i}") for i, c in enumerate(cols)]).first()
        cols = [c for i, c in enumerate(cols) if found[f"d{i}"]]
        j = j.where(reduce(Column.__or__, [differs[c] for c in cols], F.lit(False)))
    show = lambda c, s: F.col(f"{c}_{s}") if keep_equal else F.when(differs[c], F.col(f"{c}_{s}"))
    return j.select(*keys, *[show(c, s).alias(f"{c}_{n}") for c in cols for s, n in zip("ab", names)])


def series_dot(left: DataFrame, right: DataFrame, on: list[str] | str, a: str, b: str, missing: str = "error") -> DataFrame:
    """Sum of products of two labelled columns, aligned: one row (dot).
    A label of one side alone is an error or (``missing="zero"``) adds 0;
    a NULL value makes the sum NULL, as an unknown number does."""
    keys = _keys(on)
    l = left.select(*keys, F.col(a).alias("x"), F.lit(True).alias("in_x"))  # noqa: E741
    r = right.select(*keys, F.col(b).alias("y"), F.lit(True).alias("in_y"))
    j = align(l, r, keys)
    both = F.col("in_x_left").isNotNull() & F.col("in_y_right").isNotNull()
    lone = F.lit(0.0) if missing == "zero" else F.raise_error(F.lit("matrices are not aligned")).cast("double")
    j = j.select(F.when(both, F.col("x_left") * F.col("y_right")).otherwise(lone).alias("p"))
    return j.agg(F.when(F.count("*") == F.count("p"), F.sum("p")).alias("dot"))


def frame_dot(left: DataFrame, right: DataFrame, index: list[str] | str, label: str, missing: str = "error") -> DataFrame:
    """Product of a frame (one row a label of ``index``, m number columns)
    and a frame whose rows are labelled with those columns' names.

    The right side has a row for each of the left's columns, so its m x p
    numbers are bounded by the schemas; they go to the tasks once, and every
    block of left rows is one matrix product.  ``missing="zero"`` leaves out
    labels that one side alone has; NULL values give NULL."""
    keys = _keys(index)
    cols = [c for c in left.columns if c not in keys]
    out = [c for c in right.columns if c != label]
    if len(cols) > MAX_COLUMNS or len(out) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")
    rows = right.where(F.col(label).isin(cols)).select(label, *[F.col(c).cast("double") for c in out]).limit(len(cols) + 1).collect()
    have = [r[0] for r in rows]
    if len(set(have)) < len(have):
        raise ValueError("repeated label")
    if missing == "error" and (len(have) < len(cols) or not right.where(F.col(label).isNull() | ~F.col(label).isin(cols)).isEmpty()):
        raise ValueError("matrices are not aligned")
    used = [c for c in cols if c in have]
    by = {r[0]: [np.nan if x is None else x for x in r[1:]] for r in rows}
    m = np.array([by[c] for c in used], float).reshape(len(used), len(out))
    work = left.select(*keys, *[F.col(c).cast("double") for c in used])
    schema = T.StructType([*left.select(*keys).schema.fields, *[T.StructField(c, T.DoubleType()) for c in out]])
    n = len(keys)

    def run(batches):
        for b in batches:
            for i in range(0, max(1, b.num_rows), BLOCK_ROWS):
                part = b.slice(i, BLOCK_ROWS)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns[n:]]) if used else np.zeros((part.num_rows, 0))
                y = x @ m
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *[pa.array(y[:, j], mask=np.isnan(y[:, j])) for j in range(len(out))]], names=schema.names)
    return work.mapInArrow(run, schema)
