"""Structured Streaming jobs: file sources in scratch folders,
``availableNow`` triggers, memory / foreachBatch sinks; each result is
compared with its batch twin."""

import os
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from marquee.streaming import jobs as SJ
from marquee.streaming.models import StreamingKMeans, StreamingLinearRegression
from marquee.streaming.sinks import idempotent_append, sql_per_batch
from marquee.streaming.sources import SourceUnavailable, source
from marquee.streaming.state import count_until_idle, sessions_with_close

EV_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _write_parts(df, path, parts=3, fmt="parquet"):
    """Split ``df`` into ``parts`` files by event id (one folder write each)."""
    for i in range(parts):
        df.where(F.col("event_id") % parts == i).coalesce(1).write.mode("append").format(fmt).save(path)


def _run(q):
    q.awaitTermination(120)
    assert q.exception() is None, q.exception()


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stream_files_windowed_equals_batch(spark, sf_dir, scratch):
    ev = _events(spark, sf_dir)
    src = os.path.join(scratch, "in")
    _write_parts(ev, src)
    stream = source(spark, "files", src, EV_SCHEMA, maxFilesPerTrigger=1)
    agg = SJ.windowed_counts(stream.withWatermark("ts", "1 hour"), "1 hour", None, ["event_type"])
    name = "w" + uuid.uuid4().hex[:8]
    q = (agg.writeStream.outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    _run(q)
    got = _rows(spark.table(name).select("window.start", "event_type", "n"), "start", "event_type", "n")
    want = _rows(SJ.windowed_counts(ev, "1 hour", None, ["event_type"]).select("window.start", "event_type", "n"),
                 "start", "event_type", "n")
    assert got == want
    assert len(q.recentProgress) >= 3  # one file per trigger


def test_stream_modes_and_word_count(spark, scratch):
    src = os.path.join(scratch, "text")
    os.makedirs(src)
    for i, line in enumerate(["a b a", "b c", "a"]):
        with open(os.path.join(src, f"{i}.txt"), "w") as f:
            f.write(line + "\n")
    lines = source(spark, "files", src, fmt="text")
    for mode in ("complete", "update"):
        name = "wc" + uuid.uuid4().hex[:8]
        q = (SJ.word_count(lines).writeStream.outputMode(mode).format("memory").queryName(name)
             .trigger(availableNow=True).start())
        _run(q)
        got = dict((r.word, r.n) for r in spark.table(name).collect())
        assert got == {"a": 3, "b": 2, "c": 1}


def test_late_rows_dropped_by_watermark(spark, scratch):
    src = os.path.join(scratch, "late")
    rows1 = [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:20:00"), (3, "2024-01-01 12:00:00")]
    rows2 = [(4, "2024-01-01 10:05:00"), (5, "2024-01-01 12:10:00")]  # 4 is late (watermark 11:50)
    name = "late" + uuid.uuid4().hex[:8]
    for rows in (rows1, rows2):  # second run restarts from the checkpoint (watermark kept)
        spark.createDataFrame(rows, "event_id long, t string").select(
            "event_id", F.to_timestamp("t").alias("ts")).coalesce(1).write.mode("append").parquet(src)
        stream = source(spark, "files", src, "event_id long, ts timestamp")
        agg = (stream.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("n")))
        q = (agg.select(F.col("window.start").alias("start"), "n").writeStream.outputMode("append")
             .format("parquet").option("path", os.path.join(scratch, "out"))
             .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
        _run(q)
    got = {r.start.hour: r.n for r in spark.read.parquet(os.path.join(scratch, "out")).collect()}
    assert name
    assert got.get(10) == 2  # the late 10:05 row did not count


def test_stream_session_window_and_dedup(spark, sf_dir, scratch):
    ev = _events(spark, sf_dir)
    src = os.path.join(scratch, "s")
    _write_parts(ev, src, parts=2)
    stream = source(spark, "files", src, EV_SCHEMA)
    sess = SJ.session_counts(stream.withWatermark("ts", "1 hour"), "30 minutes", ["user_id"])
    name = "sw" + uuid.uuid4().hex[:8]
    q = (sess.writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    _run(q)
    got = spark.table(name)
    want = SJ.session_counts(ev, "30 minutes", ["user_id"])
    # append mode emits sessions closed by the watermark: all but the last per user at most
    assert 0 < got.count() <= want.count()
    assert got.join(want, ["user_id", "session_window", "n"], "left_anti").count() == 0
    # dedup within watermark: each event id once
    dd = stream.withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"])
    name2 = "dd" + uuid.uuid4().hex[:8]
    q2 = (dd.writeStream.format("memory").queryName(name2).option("checkpointLocation", os.path.join(scratch, "ck2"))
          .trigger(availableNow=True).start())
    _run(q2)
    assert spark.table(name2).count() == ev.count()


def test_stateful_sessions_with_close(spark, scratch):
    src = os.path.join(scratch, "close")
    rows = [("u1", "2024-01-01 10:00:00", False), ("u1", "2024-01-01 10:00:03", True),
            ("u1", "2024-01-01 10:00:04", False), ("u2", "2024-01-01 10:00:01", False),
            ("u2", "2024-01-01 10:00:20", False)]
    late = [("u3", "2024-01-01 10:05:00", False)]  # moves the watermark past every session
    for batch in (rows, late):
        spark.createDataFrame(batch, "key string, t string, is_close boolean").select(
            "key", F.to_timestamp("t").alias("ts"), "is_close").coalesce(1).write.mode("append").parquet(src)
    stream = source(spark, "files", src, "key string, ts timestamp, is_close boolean", maxFilesPerTrigger=1)
    out = sessions_with_close(stream, "key", "ts", "is_close", gap_s=5, watermark="1 second")
    name = "sc" + uuid.uuid4().hex[:8]
    q = (out.writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.key, r.num_events, r.duration_s, r.closed) for r in spark.table(name).collect())
    assert ("u1", 2, 3, True) in got          # closed by the CLOSE event
    assert ("u1", 1, 5, False) in got         # new session after the close, ended by the gap
    assert got.count(("u2", 1, 5, False)) == 2  # gap of 19 s splits u2


def test_stateful_sessions_out_of_order(spark, scratch):
    """Late events inside the watermark join, divide and close sessions as
    the whole sorted input would."""
    day = "2024-01-01 10:"
    batches = [
        [("a", "00:10", False), ("b", "00:10", False), ("c", "00:10", True), ("d", "00:00", False), ("d", "00:04", False), ("d", "00:08", False)],
        [("a", "00:07", False), ("a", "00:00", False), ("b", "00:05", False), ("b", "00:15", True), ("c", "00:08", False), ("d", "00:05", True)],
        [("z", "30:00", False)], [("z", "59:00", False)]]
    src = os.path.join(scratch, "ooo")
    for b in batches:
        spark.createDataFrame(b, "key string, t string, is_close boolean").select(
            "key", F.to_timestamp(F.concat(F.lit(day), "t")).alias("ts"), "is_close").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = source(spark, "files", src, "key string, ts timestamp, is_close boolean", maxFilesPerTrigger=1)
    name = "oo" + uuid.uuid4().hex[:8]
    q = (sessions_with_close(stream, "key", "ts", "is_close", gap_s=5, watermark="1 minute").writeStream.outputMode("append")
         .format("memory").queryName(name).option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.key, r.start.strftime("%M:%S"), r.num_events, r.closed) for r in spark.table(name).collect() if r.key != "z")
    assert got == [("a", "00:00", 1, False), ("a", "00:07", 2, False), ("b", "00:05", 3, True), ("c", "00:08", 2, True),
                   ("d", "00:00", 3, True), ("d", "00:08", 1, False)]


def test_count_until_idle_processing_timeout(spark, scratch):
    src = os.path.join(scratch, "idle")
    spark.createDataFrame([("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:05"), ("b", "2024-01-01 10:00:01")],
                          "key string, t string").select("key", F.to_timestamp("t").alias("ts")).write.parquet(src)
    stream = source(spark, "files", src, "key string, ts timestamp")
    name = "idle" + uuid.uuid4().hex[:8]
    q = (count_until_idle(stream, "key", "ts", idle_ms=10).writeStream.outputMode("update").format("memory")
         .queryName(name).option("checkpointLocation", os.path.join(scratch, "ck")).trigger(processingTime="200 milliseconds").start())
    deadline = time.time() + 60
    while time.time() < deadline and spark.table(name).count() < 2:
        time.sleep(0.5)
    q.stop()
    got = {r.key: r.n for r in spark.table(name).collect()}
    assert got == {"a": 2, "b": 1}


def test_running_counts_with_initial_state(spark, scratch):
    src = os.path.join(scratch, "run")
    os.makedirs(src)
    with open(os.path.join(src, "0.txt"), "w") as f:
        f.write("hello spark hello\n")
    initial = spark.createDataFrame([("hello", 1), ("world", 1)], "word string, n long")
    lines = source(spark, "files", src, fmt="text")
    words = lines.select(F.explode(F.split("value", " ")).alias("word")).withColumn("n", F.lit(1).cast("long"))
    counts = words.groupBy("word").agg(F.sum("n").alias("n"))
    name = "run" + uuid.uuid4().hex[:8]
    q = counts.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    _run(q)
    merged = (spark.table(name).unionByName(initial).groupBy("word").agg(F.sum("n").alias("n")))
    assert {r.word: r.n for r in merged.collect()} == {"hello": 3, "spark": 1, "world": 1}


def test_recover_from_checkpoint_and_idempotent_sink(spark, sf_dir, scratch):
    ev = _events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value", "props")
    src, out, ck = (os.path.join(scratch, d) for d in ("in", "out", "ck"))
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(src)
    stream = source(spark, "files", src, EV_SCHEMA)
    sink = idempotent_append(out, keys=["event_id"], order="ts")

    def run():
        q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", ck).trigger(availableNow=True).start())
        _run(q)

    run()
    first = spark.read.parquet(out).count()
    ev.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(src)
    run()  # restart: only the new file is processed
    assert spark.read.parquet(out).count() == ev.count() and first < ev.count()
    # re-sent records (a rerun) are not appended twice
    ev.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(src)
    run()
    assert spark.read.parquet(out).select("event_id").distinct().count() == spark.read.parquet(out).count()


def test_foreach_batch_sql_and_listener(spark, sf_dir, scratch):
    ev = _events(spark, sf_dir)
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    _write_parts(ev, src, parts=2)
    seen = []

    class L(StreamingQueryListener):
        def onQueryStarted(self, event):
            seen.append("start")

        def onQueryProgress(self, event):
            seen.append(event.progress.numInputRows)

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            seen.append("end")

    listener = L()
    spark.streams.addListener(listener)
    try:
        stream = source(spark, "files", src, EV_SCHEMA, maxFilesPerTrigger=1)
        f = sql_per_batch("batch_events", "SELECT event_type, count(*) AS n FROM batch_events GROUP BY event_type", out)
        q = stream.writeStream.foreachBatch(f).option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start()
        _run(q)
        time.sleep(1)
    finally:
        spark.streams.removeListener(listener)
    total = spark.read.parquet(out).agg(F.sum("n")).first()[0]
    assert total == ev.count()
    assert "start" in seen and sum(x for x in seen if isinstance(x, int)) == ev.count()


def test_stream_static_and_stream_stream_join(spark, sf_dir, scratch):
    ev = _events(spark, sf_dir)
    src = os.path.join(scratch, "in")
    _write_parts(ev, src, parts=2)
    stream = source(spark, "files", src, EV_SCHEMA)
    known = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"))
    j = stream.join(known, "user_id", "left_semi")
    name = "ss" + uuid.uuid4().hex[:8]
    q = j.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    _run(q)
    assert spark.table(name).count() == ev.join(known, "user_id", "left_semi").count()
    # stream-stream interval join: purchases followed by another event of the user within 10 minutes
    a = source(spark, "files", src, EV_SCHEMA).where("event_type = 'purchase'").withWatermark("ts", "1 hour").alias("a")
    b = source(spark, "files", src, EV_SCHEMA).withWatermark("ts", "1 hour").alias("b")
    cond = (F.col("a.user_id") == F.col("b.user_id")) & (F.col("b.ts") > F.col("a.ts")) & \
        (F.col("b.ts") <= F.col("a.ts") + F.expr("INTERVAL 10 MINUTES"))
    sj = a.join(b, cond).select(F.col("a.event_id").alias("p"), F.col("b.event_id").alias("e"))
    name2 = "sj" + uuid.uuid4().hex[:8]
    q2 = sj.writeStream.format("memory").queryName(name2).option("checkpointLocation", os.path.join(scratch, "ck2")).trigger(availableNow=True).start()
    _run(q2)
    ea, eb = ev.where("event_type = 'purchase'").alias("a"), ev.alias("b")
    want = ea.join(eb, cond).count()
    assert spark.table(name2).count() == want


def test_catalog_stream_append(spark, sf_dir, scratch):
    """Pages arriving as files → catalog records → idempotent sink."""
    from marquee.plans.catalog import catalog_records
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    src, out = os.path.join(scratch, "pages"), os.path.join(scratch, "movies")
    pages.coalesce(2).write.parquet(src)
    stream = source(spark, "files", src, pages.schema)
    rec = catalog_records(stream)
    q = (rec.writeStream.foreachBatch(idempotent_append(out, keys=["image_url"], order="page_id"))
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    _run(q)
    assert spark.read.parquet(out).count() == catalog_records(pages).select("image_url").distinct().count()


def test_cadence_trigger_and_sources(spark, scratch):
    rate = source(spark, "rate", rowsPerSecond=5)
    name = "rate" + uuid.uuid4().hex[:8]
    q = rate.writeStream.format("memory").queryName(name).trigger(processingTime="1 second").start()
    time.sleep(3)
    q.stop()
    assert spark.table(name).count() > 0
    with pytest.raises(SourceUnavailable):
        source(spark, "kafka", "movie-urls").writeStream.format("memory").queryName("k").start()
    with pytest.raises(ValueError):
        SJ.windowed_counts(spark.range(1).withColumn("ts", F.current_timestamp()), "1 minute", "2 minutes", [])


def test_streaming_models(spark, scratch):
    rng = np.random.default_rng(0)
    pts = np.vstack([rng.normal(0, 0.1, (50, 2)), rng.normal(5, 0.1, (50, 2))])
    src = os.path.join(scratch, "pts")
    for i in range(2):
        spark.createDataFrame([(float(a), float(b), float(2 * a + 1)) for a, b in pts[i::2]], "x double, y double, z double") \
            .coalesce(1).write.mode("append").parquet(src)
    km = StreamingKMeans(np.array([[1.0, 1.0], [4.0, 4.0]]), decay=1.0)
    lr = StreamingLinearRegression(1, step=0.05)
    stream = source(spark, "files", src, "x double, y double, z double", maxFilesPerTrigger=1)

    def both(batch, bid):
        km.update(batch, ["x", "y"])
        for _ in range(50):
            lr.update(batch, ["x"], "z")

    q = stream.writeStream.foreachBatch(both).trigger(availableNow=True).start()
    _run(q)
    assert np.allclose(sorted(km.centers[:, 0]), [0, 5], atol=0.2)
    assert km.weights.sum() == 100
    assert abs(lr.w[0] - 2) < 0.3


def test_stream_links_topic(spark, sf_dir, scratch):
    """Link topic: a stream of pages publishes one message per link to a
    JSON 'topic' folder; a second stream consumes it from the earliest
    file and resolves the URLs (the producer/consumer pair of the
    catalog)."""
    from marquee.operators import catalog as C
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    src, topic = os.path.join(scratch, "pages"), os.path.join(scratch, "topic")
    pages.coalesce(2).write.parquet(src)
    links = C.page_links(source(spark, "files", src, pages.schema)).select("page_id", "url", "pos", "path")
    q1 = (links.writeStream.format("json").option("path", topic)
          .option("checkpointLocation", os.path.join(scratch, "ck1")).trigger(availableNow=True).start())
    _run(q1)
    consumed = source(spark, "files", topic, "page_id long, url string, pos int, path string", fmt="json")
    resolved = C.url_resolve(consumed)
    name = "links" + uuid.uuid4().hex[:8]
    q2 = resolved.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    _run(q2)
    want = C.url_resolve(C.page_links(pages)).select("page_id", "pos", "abs_url")
    got = spark.table(name).select("page_id", "pos", "abs_url")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
