"""Small per-row Python helpers used by Python UDF examples.

Kept in a module with no Spark objects at import time: Python workers
import it to unpickle the functions.
"""

from __future__ import annotations

import re

from marquee.functions import patterns as P


def minutes_py(d):
    """'1h 32m' → 92, '45m' → 45, '2h' → 120, else None."""
    if d is None:
        return None
    m = re.match(P.DURATION_HM, d)
    if m:
        return int(m.group(1)) * 60 + int(m.group(2))
    m = re.match(P.DURATION_M, d)
    if m:
        return int(m.group(1))
    m = re.match(P.DURATION_H, d)
    return int(m.group(1)) * 60 if m else None
