"""Tests of an experiment against its control, period by period.

Each period (a micro-batch, a day) is reduced to the moments of both
groups: count, mean and squared deviations.  The first ``peace`` periods
are left out; a test covers the last ``window`` periods (0: all since).
Moments of periods are merged exactly (parallel-axis sums), so no period
is read again.  ``welch`` has unequal variances, ``student`` a pooled one.

A test has a NULL statistic where a group has fewer than two values or
both groups have no variance.  NULL values and NULL groups do not count;
a period without values of a group has count 0 there.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moments(df: DataFrame, period: Column, experiment: Column, value: Column) -> DataFrame:
    """Rows (period, experiment, n, mean, m2)."""
    d = df.select(period.alias("period"), experiment.cast("boolean").alias("experiment"), value.cast("double").alias("x")).where("experiment is not null and x is not null")
    return d.groupBy("period", "experiment").agg(F.count("*").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("*")).alias("m2"))


def _beta_fraction(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + top / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            h = h * step
        if np.nanmax(np.abs(step - 1), initial=0) < 1e-15:
            break
    return h


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Probability of a statistic at least as far from 0, by the regularised
    incomplete beta function I(df / (df + t^2); df / 2, 1 / 2)."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    a, b, x = df / 2, np.full_like(df, 0.5), df / (df + t * t)
    front = np.exp([math.lgamma(p + 0.5) - math.lgamma(p) - math.lgamma(0.5) if np.isfinite(p) else math.nan for p in a]
                   + a * np.log(x) + b * np.log1p(-np.minimum(x, np.nextafter(1, 0))))
    low = x < (a + 1) / (a + b + 2)
    inner = np.where(low, front * _beta_fraction(np.where(low, x, 0), a, b) / a, 1 - front * _beta_fraction(np.where(low, 0, 1 - x), b, a) / b)
    return np.where(t == 0, 1.0, np.where(np.isfinite(t) & np.isfinite(df), inner, np.nan))


def p_value(t: str, df: str) -> Column:
    """The probability as a column, one value a period."""
    def run(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series(t_two_sided(t.to_numpy(float), df.to_numpy(float))).where(t.notna() & df.notna(), None)
    return F.pandas_udf(run, "double")(t, df)


def test(moment_rows: DataFrame, peace: int = 0, window: int = 0, method: str = "welch") -> DataFrame:
    """Rows (period, n_control, n_experiment, mean_control, mean_experiment,
    statistic, df, p_value), one for each period after the peace.

    The window runs over one row a period: its size is the number of
    periods, not of values."""
    if method not in ("welch", "student"):
        raise ValueError(method)
    side = lambda flag, c: F.coalesce(F.sum(F.when(F.col("experiment") == flag, F.col(c))), F.lit(0))
    cols = {}
    for g, flag in (("c", False), ("e", True)):
        cols |= {f"n_{g}": side(flag, "n"), f"s_{g}": side(flag, "sum"), f"q_{g}": side(flag, "square")}
    d = (moment_rows.withColumn("sum", F.col("n") * F.col("mean")).withColumn("square", F.col("m2") + F.col("n") * F.col("mean") * F.col("mean"))
         .groupBy("period").agg(*[v.alias(k) for k, v in cols.items()]))
    order = Window.orderBy("period")
    d = d.withColumn("i", F.row_number().over(order)).where(F.col("i") > peace)
    over = order.rowsBetween(Window.unboundedPreceding if window == 0 else 1 - window, 0)
    for g in "ce":
        n, s, q = (F.sum(f"{x}_{g}").over(over) for x in "nsq")
        d = d.withColumns({f"N_{g}": n, f"S_{g}": s, f"Q_{g}": q})
    for g in "ce":
        n = F.col(f"N_{g}")
        d = d.withColumn(f"mean_{g}", F.when(n > 0, F.col(f"S_{g}") / n))
        d = d.withColumn(f"var_{g}", F.when(n > 1, F.greatest(F.lit(0.0), F.col(f"Q_{g}") - n * F.col(f"mean_{g}") ** 2) / (n - 1)))
    ne, nc, ve, vc = F.col("N_e"), F.col("N_c"), F.col("var_e"), F.col("var_c")
    if method == "welch":
        err = ve / ne + vc / nc
        df = err * err / (F.pow(ve / ne, F.lit(2)) / (ne - 1) + F.pow(vc / nc, F.lit(2)) / (nc - 1))
    else:
        err = ((ne - 1) * ve + (nc - 1) * vc) / (ne + nc - 2) * (1 / ne + 1 / nc)
        df = (ne + nc - 2).cast("double")
    sound = (ne > 1) & (nc > 1) & (err > 0)
    d = d.withColumn("statistic", F.when(sound, (F.col("mean_e") - F.col("mean_c")) / F.sqrt(err))).withColumn("df", F.when(sound, df))
    return d.select("period", F.col("N_c").alias("n_control"), F.col("N_e").alias("n_experiment"), F.col("mean_c").alias("mean_control"),
                    F.col("mean_e").alias("mean_experiment"), "statistic", "df", p_value("statistic", "df").alias("p_value"))
