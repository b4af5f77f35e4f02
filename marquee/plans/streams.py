"""Batch twins of the streaming jobs (§2.10).

The same transformations run unchanged on a streaming DataFrame (see
``marquee.streaming.jobs`` and ``tests/test_streaming.py``); here they
run over the ``events`` / text tables so the oracle can check them.
Window starts are epoch-aligned, as in Spark's ``window``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import timeseries as TS
from marquee.plans.registry import query
from marquee.streaming import jobs as SJ


def epoch(c):
    return F.unix_seconds(c.cast("timestamp"))


def _sliding_sql(size_s: int, slide_s: int, select: str, group: str, src: str = "events", where: str = "") -> str:
    k = -(-size_s // slide_s)
    return f"""
SELECT {select} FROM (
  SELECT *, CAST(floor(epoch(ts) / {slide_s}) AS BIGINT) * {slide_s} - i * {slide_s} AS w_start
  FROM {src}, range({k}) r(i) {where})
WHERE epoch(ts) < w_start + {size_s} AND epoch(ts) >= w_start GROUP BY {group}"""


@query("tumbling", oracle="""
SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS w_start, event_type, count(*) AS n FROM events GROUP BY 1, 2
""")
def tumbling(t):
    w = SJ.windowed_counts(t.events, "1 hour", None, ["event_type"])
    return w.select(epoch(F.col("window.start")).alias("w_start"), "event_type", "n")


@query("sliding", oracle=_sliding_sql(3600, 1800, "w_start, event_type, count(*) AS n", "w_start, event_type"))
def sliding(t):
    w = SJ.windowed_counts(t.events, "1 hour", "30 minutes", ["event_type"])
    return w.select(epoch(F.col("window.start")).alias("w_start"), "event_type", "n")


_SESSION_WINDOW_SQL = """
SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS s_start, CAST(floor(epoch(max(ts) + INTERVAL 30 MINUTE)) AS BIGINT) AS s_end, count(*) AS n FROM (
  SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM (
    SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
      OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events))
GROUP BY user_id, sid
"""


@query("session_window", oracle=_SESSION_WINDOW_SQL)
def session_window(t):
    """``session_window(ts, '30 minutes')`` per user (end = last event + gap)."""
    s = SJ.session_counts(t.events, "30 minutes", ["user_id"])
    return s.select("user_id", epoch(F.col("session_window.start")).alias("s_start"),
                    epoch(F.col("session_window.end")).alias("s_end"), "n")


@query("stream_window", oracle="""
SELECT CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 AS w_start,
  strftime(make_timestamp((CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 + 900) * 1000000 - 1), '%Y-%m-%d %H:%M:%S.%f') AS w_time,
  count(DISTINCT user_id) AS users, round(sum(value), 2) AS total FROM events GROUP BY 1, 2
""")
def stream_window(t):
    """Tumbling 15-minute windows with ``window_time`` (event time of the
    window = end - 1 µs) — the aggregation a watermarked stream emits."""
    ev = t.events
    w = ev.groupBy(F.window("ts", "15 minutes")).agg(F.count_distinct("user_id").alias("users"),
                                                     F.round(F.sum("value"), 2).alias("total"))
    return w.select(epoch(F.col("window.start")).alias("w_start"),
                    F.date_format(F.window_time("window"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("w_time"), "users", "total")


_WORDS_SQL = r"unnest(string_split_regex(lower(text), '[^a-z]+'))"


@query("word_sentiment", oracle=f"""
WITH s AS (SELECT word, 1 - 2 * avg(toxic) AS score FROM (SELECT {_WORDS_SQL} AS word, toxic FROM documents JOIN labels USING (doc_id))
           WHERE word <> '' GROUP BY word),
c AS (SELECT word, count(*) AS n FROM (SELECT {_WORDS_SQL} AS word FROM benchmark) WHERE word <> '' GROUP BY word)
SELECT word, n, round(score, 6) AS score, round(score * n, 6) AS weighted FROM c JOIN s USING (word)
ORDER BY score * n DESC, word LIMIT 5
""")
def word_sentiment(t):
    """Word counts joined with a per-word sentiment table (1 - 2·toxic
    share over labelled documents), top 5 by score × count."""
    return SJ.word_sentiment(t.benchmark, t.documents.join(t.labels, "doc_id"), top=5)


@query("grep_count", oracle="""
SELECT src, count(*) AS n FROM (SELECT 'documents' AS src, text FROM documents UNION ALL SELECT 'conversations', text FROM conversations)
WHERE contains(text, 'the') GROUP BY src
""")
def grep_count(t):
    a = t.documents.select(F.lit("documents").alias("src"), "text")
    b = t.conversations.select(F.lit("conversations").alias("src"), "text")
    return SJ.grep_count(a.unionByName(b), "the")


@query("click_counts", oracle="SELECT event_type AS url, count(*) AS views FROM events GROUP BY event_type")
def click_counts(t):
    return SJ.click_counts(SJ.as_clicks(t.events))


@query("click_sliding", oracle=_sliding_sql(600, 120, "w_start, event_type AS url, count(*) AS views", "w_start, event_type"))
def click_sliding(t):
    w = SJ.click_sliding(SJ.as_clicks(t.events), "10 minutes", "2 minutes")
    return w.select(epoch(F.col("window.start")).alias("w_start"), "url", "views")


@query("click_error_rate", oracle=_sliding_sql(
    1800, 120, "w_start, zip, round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate, "
               "avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0.05 AS alert", "w_start, zip",
    src="(SELECT *, user_id % 10 AS zip FROM events)"))
def click_error_rate(t):
    w = SJ.click_error_rate(SJ.as_clicks(t.events), "30 minutes", "2 minutes", threshold=0.05)
    return w.select(epoch(F.col("window.start")).alias("w_start"), "zip", F.round("error_rate", 6).alias("error_rate"), "alert")


@query("click_active_users", oracle=_sliding_sql(900, 120, "w_start, count(DISTINCT user_id) AS active_users", "w_start"))
def click_active_users(t):
    w = SJ.click_active_users(SJ.as_clicks(t.events), "15 minutes", "2 minutes")
    return w.select(epoch(F.col("window.start")).alias("w_start"), "active_users")


@query("click_known_users", oracle="""
SELECT DISTINCT user_id FROM events JOIN customer ON user_id = c_custkey ORDER BY user_id LIMIT 10
""")
def click_known_users(t):
    return SJ.click_known_users(SJ.as_clicks(t.events), t.customer.select(F.col("c_custkey").alias("user_id")), 10)


@query("sessions_close", oracle="""
WITH o AS (SELECT user_id, ts, event_id, event_type = 'purchase' AS is_close,
  lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts,
  lag(event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_close FROM events),
s AS (SELECT *, sum(CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 30 MINUTE OR prev_close THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_id FROM o)
SELECT user_id, session_id, count(*) AS num_events,
  CAST(floor(epoch(CASE WHEN arg_max(is_close, ts) THEN max(ts) ELSE max(ts) + INTERVAL 30 MINUTE END)) AS BIGINT)
    - CAST(floor(epoch(min(ts))) AS BIGINT) AS duration_s
FROM s GROUP BY user_id, session_id
""")
def sessions_close(t):
    """Event-time sessions ended by a gap of 30 minutes or by a closing
    event (here: a purchase); end = closing event time, else last event
    + gap.  Batch twin of the stateful stream job."""
    ev = t.events.select("user_id", "ts", "event_id", "event_type")
    s = TS.sessionize(ev, "user_id", "ts", gap_s=1800, close=F.col("event_type") == "purchase")
    g = s.groupBy("user_id", "session_id").agg(
        F.count(F.lit(1)).alias("num_events"), F.min("ts").alias("start"), F.max("ts").alias("last"),
        F.max_by(F.col("event_type") == "purchase", F.struct("ts", "event_id")).alias("closed"))
    end = F.when(F.col("closed"), F.col("last")).otherwise(F.col("last") + F.expr("INTERVAL 30 MINUTES"))
    return g.select("user_id", "session_id", "num_events",
                    (F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(F.col("start").cast("timestamp"))).alias("duration_s"))
