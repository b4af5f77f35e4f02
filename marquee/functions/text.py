"""Column expressions for the catalog record fields.

All helpers return JVM-side ``Column`` expressions (no Python UDF), so
they stay inside whole-stage codegen and never block filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.patterns import (
    DEFAULT_TEXT, DURATION_HM, DURATION_H, DURATION_M, RATING, STRIP_WS, VIEWS,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract(c, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` (group ``group``), null when absent."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def parse_rating(c) -> Column:
    """``(6.6 / 10)`` → 6.6; no ``(d.d`` → 0.0."""
    return F.coalesce(extract(c, RATING).try_cast("double"), F.lit(0.0))


def parse_views(c) -> Column:
    """``desde 612 usuarios`` → 612; no match → 0."""
    return F.coalesce(extract(c, VIEWS).try_cast("bigint"), F.lit(0).cast("bigint"))


def duration_minutes(c, extended: bool = True, strict: bool = False) -> Column:
    """``'1h 32m'`` → 92.

    ``extended`` also accepts ``'45m'`` and ``'2h'``.  Anything else is
    null (the row can be quarantined), or raises when ``strict``.
    """
    c = _c(c)
    hm = (extract(c, DURATION_HM, 1).try_cast("int") * 60
          + extract(c, DURATION_HM, 2).try_cast("int"))
    out = hm
    if extended:
        out = F.coalesce(hm,
                         extract(c, DURATION_H, 1).try_cast("int") * 60,
                         extract(c, DURATION_M, 1).try_cast("int"))
    if strict:
        out = F.when(c.isNull() | out.isNotNull(), out).otherwise(
            F.raise_error(F.concat(F.lit("bad duration: "), c)).cast("int"))
    return out


def strip_ws(c) -> Column:
    """Remove white space at both ends (Python ``str.strip`` of ASCII
    white space; Spark ``trim`` only removes blanks)."""
    return F.regexp_replace(_c(c), STRIP_WS, "")


def clean_marker(c, marker: str) -> Column:
    """Text after the first ``marker``, stripped; unchanged (not
    stripped) when the marker is absent."""
    c = _c(c)
    pos = F.instr(c, marker)
    rest = c.substr(pos + F.lit(len(marker)), F.lit(2147483647))
    return F.when(pos > 0, strip_ws(rest)).otherwise(c)


def fill_default(c, default: str = DEFAULT_TEXT) -> Column:
    """Empty or missing text → the default label."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default))


def fill_empty_list(c) -> Column:
    return F.coalesce(_c(c), F.array().cast("array<string>"))


def list_flatten(c, sep: str = ", ", strip_trailing_comma: bool = False) -> Column:
    c = _c(c)
    if strip_trailing_comma:
        c = F.transform(c, lambda x: F.regexp_replace(x, ",$", ""))
    return F.array_join(c, sep)


def canonical_url(c) -> Column:
    """URL without query string and fragment."""
    return F.regexp_replace(_c(c), r"[?#].*$", "")
