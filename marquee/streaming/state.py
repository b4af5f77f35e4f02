"""Custom stateful stream operators (``applyInPandasWithState``).

State per key holds the open sessions and the events newer than the
watermark; sessions are emitted when the watermark passes their end, so
state is bounded by the watermark delay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SESSION_OUT = "key string, start timestamp, end timestamp, num_events long, duration_s long, closed boolean"
SESSION_STATE = "start array<long>, last array<long>, n array<long>, closed array<boolean>"


def _micros(s: pd.Series) -> pd.Series:
    if getattr(s.dt, "tz", None) is not None:
        s = s.dt.tz_convert("UTC").dt.tz_localize(None)
    return s.astype("datetime64[ns]").astype("int64") // 1000


def _emit(key, start_us, end_us, n, closed):
    return {"key": key, "start": pd.Timestamp(start_us, unit="us"), "end": pd.Timestamp(end_us, unit="us"),
            "num_events": n, "duration_s": (end_us // 1_000_000) - (start_us // 1_000_000), "closed": closed}


def merge_runs(runs: list[tuple], gap_us: int) -> list[list[tuple]]:
    """Sessions of sorted runs (start, last, n, closed): a run joins the
    session before it unless that one is closed or ended a gap ago."""
    out: list[list[tuple]] = []
    for r in sorted(runs):
        if out and not out[-1][-1][3] and r[0] - max(x[1] for x in out[-1]) <= gap_us:
            out[-1].append(r)
        else:
            out.append([r])
    return out


def sessions_with_close(events: DataFrame, key: str, ts: str, close_col: str, gap_s: int,
                        watermark: str = "10 seconds") -> DataFrame:
    """Event-time sessions ended by a gap or by a closing event.

    ``events`` must be a stream with columns (key, ts, close_col boolean).
    End of a session = closing event time, else last event + gap.  A session
    is emitted once the watermark passes its end.

    State of a key: its open sessions as runs (start, last, events, closed).
    Events newer than the watermark are runs of their own, since one that
    comes late may still join, divide or close them; older neighbours of a
    session are put together, as nothing can come between them any more.
    """
    gap_us = gap_s * 1_000_000

    def update(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        runs = list(zip(*state.get)) if state.exists else []
        if not state.hasTimedOut:
            for pdf in pdfs:
                runs += [(t, t, 1, bool(c)) for t, c in zip(_micros(pdf[ts]).tolist(), pdf[close_col].fillna(False).tolist())]
        mark = state.getCurrentWatermarkMs() * 1000
        out, kept, ends = [], [], []
        for session in merge_runs(runs, gap_us):
            last, closed = max(r[1] for r in session), session[-1][3]
            end = last if closed else last + gap_us
            if end <= mark:
                out.append(_emit(str(k[0]), session[0][0], end, sum(r[2] for r in session), closed))
                continue
            ends.append(end)
            done: list[tuple] = []
            for r in session:
                if done and not done[-1][3] and not r[3] and r[1] < mark:
                    done[-1] = (done[-1][0], max(done[-1][1], r[1]), done[-1][2] + r[2], False)
                else:
                    done.append(r)
            kept += done
        if kept:
            state.update(tuple(list(c) for c in zip(*kept)))
            state.setTimeoutTimestamp(max(min(ends) // 1000, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out)

    return (events.withWatermark(ts, watermark).groupBy(key)
            .applyInPandasWithState(update, SESSION_OUT, SESSION_STATE, "append", GroupStateTimeout.EventTimeTimeout))


COUNT_OUT = "key string, n long, first_seen timestamp, last_seen timestamp"
COUNT_STATE = "n long, first long, last long"


def count_until_idle(events: DataFrame, key: str, ts: str, idle_ms: int) -> DataFrame:
    """Per-key running count with a processing-time timeout: the key's
    (count, first, last) is emitted once no event arrived for ``idle_ms``
    (the earlier start is kept when more events arrive)."""

    def update(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            n, first, last = state.get
            state.remove()
            yield pd.DataFrame([{"key": str(k[0]), "n": n, "first_seen": pd.Timestamp(first, unit="us"),
                                 "last_seen": pd.Timestamp(last, unit="us")}])
            return
        cur = state.get if state.exists else None
        for pdf in pdfs:
            us = _micros(pdf[ts])
            n, first, last = cur or (0, int(us.min()), int(us.max()))
            cur = (n + len(pdf), min(first, int(us.min())), max(last, int(us.max())))
        state.update(cur)
        state.setTimeoutDuration(idle_ms)
        yield from ()

    return events.groupBy(key).applyInPandasWithState(update, COUNT_OUT, COUNT_STATE, "update",
                                                      GroupStateTimeout.ProcessingTimeTimeout)
