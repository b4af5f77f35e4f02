"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_days(c) -> Column:
    """Days from a date (or timestamp) to today."""
    c = F.col(c) if isinstance(c, str) else c
    return F.datediff(F.current_date(), c.cast("date"))
