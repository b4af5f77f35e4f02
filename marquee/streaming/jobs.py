"""Stream jobs written once for batch and streaming DataFrames.

Every function takes a DataFrame (``isStreaming`` or not) and returns
the transformed DataFrame; the caller adds ``withWatermark`` for
streams and picks the output mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(lines: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """Split on one separator, count per word (complete / update mode)."""
    words = lines.select(F.explode(F.split(F.col(col), sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(events: DataFrame, size: str, slide: str | None, keys: list[str], ts: str = "ts") -> DataFrame:
    """Counts per (window, keys); ``slide`` None = tumbling.  A slide
    larger than the window is rejected (it would skip events)."""
    if slide is not None and _seconds(slide) > _seconds(size):
        raise ValueError(f"slide {slide} is larger than the window {size}")
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return events.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))


def session_counts(events: DataFrame, gap: str, keys: list[str], ts: str = "ts") -> DataFrame:
    return events.groupBy(F.session_window(ts, gap).alias("session_window"), *keys).agg(F.count(F.lit(1)).alias("n"))


def grep_count(lines: DataFrame, needle: str, col: str = "text", key: str = "src") -> DataFrame:
    return lines.where(F.col(col).contains(needle)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def as_clicks(events: DataFrame) -> DataFrame:
    """Page-view records (url, status, zip, user) from events."""
    return events.select("ts", F.col("event_type").alias("url"), "event_type",
                         F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
                         (F.col("user_id") % 10).alias("zip"), "user_id")


def click_counts(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("url").agg(F.count(F.lit(1)).alias("views"))


def click_sliding(clicks: DataFrame, size: str, slide: str) -> DataFrame:
    return clicks.groupBy(F.window("ts", size, slide).alias("window"), "url").agg(F.count(F.lit(1)).alias("views"))


def click_error_rate(clicks: DataFrame, size: str, slide: str, threshold: float = 0.05) -> DataFrame:
    rate = F.avg(F.when(F.col("status") != 200, 1.0).otherwise(0.0))
    return (clicks.groupBy(F.window("ts", size, slide).alias("window"), "zip").agg(rate.alias("error_rate"))
            .withColumn("alert", F.col("error_rate") > threshold))


def click_active_users(clicks: DataFrame, size: str, slide: str, approx: bool = False) -> DataFrame:
    """Distinct users per window: exact in batch; streams use the
    mergeable HyperLogLog sketch (``approx=True``)."""
    agg = F.approx_count_distinct("user_id") if approx else F.count_distinct("user_id")
    return clicks.groupBy(F.window("ts", size, slide).alias("window")).agg(agg.alias("active_users"))


def click_known_users(clicks: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """Users seen that are in a known-user table (stream-static join)."""
    seen = clicks.select("user_id").join(users, "user_id", "left_semi").distinct()
    return seen.orderBy("user_id").limit(k)


def words_of(df: DataFrame, col: str = "text") -> DataFrame:
    return (df.select("*", F.explode(F.split(F.lower(col), "[^a-z]+")).alias("word"))
            .where(F.col("word") != ""))


def word_sentiment(texts: DataFrame, labelled: DataFrame, top: int = 5) -> DataFrame:
    """Word counts of ``texts`` joined with a word score table derived
    from labelled texts: score = 1 - 2·(share of toxic texts)."""
    scores = (words_of(labelled.select("text", "toxic")).groupBy("word")
              .agg((1 - 2 * F.avg("toxic")).alias("score")))
    counts = words_of(texts.select("text")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    j = counts.join(scores, "word")
    return (j.orderBy(F.desc(F.col("score") * F.col("n")), "word").limit(top)
            .select("word", "n", F.round("score", 6).alias("score"), F.round(F.col("score") * F.col("n"), 6).alias("weighted")))


def _seconds(d: str) -> float:
    n, unit = d.split()[:2]
    unit = unit.rstrip("s")
    return float(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
