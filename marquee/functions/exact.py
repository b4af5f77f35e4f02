"""Exact arithmetic helpers.

Averages of fixed-point data (money with 2 decimals) are computed from
integer sums, so the result is the same in every engine: rounding a
floating mean can land exactly on a half unit (e.g. n = 32) and engines
break such ties differently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(c) -> Column:
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def cents(c, scale: int = 2) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * (10 ** scale)).cast("bigint")


def fixed_mean(total_cents: Column, n: Column, scale: int = 2, digits: int = 6) -> Column:
    """floor(mean * 10^digits) / 10^digits from an integer cents sum."""
    num = (total_cents * F.lit(10 ** (digits - scale))).cast("bigint")
    n = n.cast("bigint")
    q = F.floor(num / n).cast("bigint")
    # exact integer floor division (the double quotient may be off by one)
    q = F.when(q * n > num, q - 1).when((q + 1) * n <= num, q + 1).otherwise(q)
    return F.when(n > 0, q) / F.lit(float(10 ** digits))


def fixed_mean_sql(total_cents: str, n: str, scale: int = 2, digits: int = 6) -> str:
    num = f"(CAST({total_cents} AS BIGINT) * {10 ** (digits - scale)})"
    # exact floor division whatever the sign: subtract the non-negative remainder first
    floor_div = f"(({num} - ((({num}) % ({n})) + ({n})) % ({n})) // ({n}))"
    return f"CASE WHEN {n} > 0 THEN CAST({floor_div} AS BIGINT) / {float(10 ** digits)} END"
