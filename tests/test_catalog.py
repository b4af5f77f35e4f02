"""Catalog operators: golden pairs from the reference run logs, fixture
detail pages, quarantine and sink behaviour."""

import contextlib
import io
import json

import pytest
from pyspark.sql import functions as F

from marquee.functions.text import (clean_marker, duration_minutes, fill_default, parse_rating,
                                    parse_views)
from marquee.operators import catalog as C

DETAIL_PAGE = """<html><body><article class="TPost single">
<img data-src="https://img.example/tarot.jpg">
<h1 class="Title">Tarot</h1>
<span class="post-ratings">(6.6 / 10) desde 612 usuarios</span>
<p class="meta"><span>1h 32m</span><a href="/y/2024">2024</a></p>
<span class="Qlty">HD</span>
<div class="Description">Ver Tarot online gratis en Cuevana3.   Un grupo de amigos...</div>
<ul class="InfoList">
 <li><strong>Género:</strong> <a>Terror</a>, <a>Misterio</a></li>
 <li><strong>País:</strong> <a>Estados Unidos</a></li>
 <li><strong>Director:</strong> <span class="color-w">Spenser Cohen</span></li>
 <li><strong>Actores:</strong> <a>Harriet Slater,</a> <a>Adain Bradley,</a></li>
</ul></article></body></html>"""

def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


NO_ARTICLE = "<html><body><div>nothing</div></body></html>"
NO_TITLE = '<article class="TPost"><span class="post-ratings">(8</span><p class="meta"><span>2h</span><a>2020</a></p><div class="Description">x</div></article>'
MINIMAL = ('<article class="TPost"><img data-src="i.jpg"><h1 class="Title">Solo</h1>'
           '<span class="post-ratings">(8</span><p class="meta"><span>45m</span><a>2020</a></p>'
           '<div class="Description">Sin marcador</div></article>')


def test_golden_durations(spark):
    df = spark.createDataFrame([("2h 10m",), ("1h 35m",), ("1h 55m",), ("1h 32m",), ("45m",), ("2h",),
                                ("0h 5m",), ("",), (None,), ("1h 32x",)], "d string")
    got = [r.m for r in df.select(duration_minutes("d").alias("m")).collect()]
    assert got == [130, 95, 115, 92, 45, 120, 5, None, None, None]
    strict_only = [r.m for r in df.select(duration_minutes("d", extended=False).alias("m")).collect()]
    assert strict_only[:6] == [130, 95, 115, 92, None, None]


def test_strict_duration_raises(spark):
    df = spark.createDataFrame([("45x",)], "d string")
    with pytest.raises(Exception):
        df.select(duration_minutes("d", strict=True)).collect()


def test_clean_description(spark):
    rows = [("Ver La academia online Cuevana3. \tHola mundo  ",), ("Sin marcador  ",),
            ("a Cuevana3. b Cuevana3. c",), ("fin Cuevana3.",)]
    df = spark.createDataFrame(rows, "d string")
    got = [r.c for r in df.select(clean_marker("d", "Cuevana3.").alias("c")).collect()]
    assert got == ["Hola mundo", "Sin marcador  ", "b Cuevana3. c", ""]


def test_rating_and_views(spark):
    df = spark.createDataFrame([("(6.6 / 10) desde 612 usuarios",), ("(8",), (None,)], "t string")
    got = df.select(parse_rating("t").alias("r"), parse_views("t").alias("v")).collect()
    assert [(r.r, r.v) for r in got] == [(6.6, 612), (0.0, 0), (0.0, 0)]


def test_fill_default(spark):
    df = spark.createDataFrame([("",), (None,), ("HD",)], "q string")
    assert [r.q for r in df.select(fill_default("q").alias("q")).collect()] == ["Sin dato", "Sin dato", "HD"]


def test_detail_page_fixture(spark):
    pages = spark.createDataFrame([(1, DETAIL_PAGE), (2, NO_ARTICLE), (3, NO_TITLE), (4, MINIMAL)],
                                  "page_id long, html string")
    rows = {r.page_id: r for r in C.extract_movies(pages).collect()}
    assert set(rows) == {1, 4}
    m = rows[1]
    assert m.title == "Tarot" and m.rating == 6.6 and m.views == 612
    assert m.duration == "1h 32m" and m.year == "2024" and m.quality == "HD"
    assert m.genre == ["Terror", "Misterio"] and m.country == "Estados Unidos"
    assert m.director == "Spenser Cohen" and m.actors == ["Harriet Slater,", "Adain Bradley,"]
    assert m.image_url == "https://img.example/tarot.jpg"
    d = rows[4]
    assert (d.rating, d.views, d.quality, d.country, d.genre, d.actors) == (0.0, 0, "Sin dato", "Sin dato", [], [])


def test_detail_page_quarantine_and_nesting(spark):
    deep = DETAIL_PAGE.replace("Tarot</h1>", "<i> Ta </i> <b>rot</b></h1>") + "<li>" * 3000 + "<b>" * 600
    pages = spark.createDataFrame([(1, deep), (2, NO_ARTICLE), (3, NO_TITLE), (4, None), (5, ""), (None, MINIMAL)], "page_id long, html string")
    assert {r.page_id: r.title for r in C.extract_movies(pages).collect()} == {1: "Tarot", None: "Solo"}
    assert {r.page_id: r.reason for r in C.movie_quarantine(pages).collect()} == {2: "no article", 3: "no title", 4: "no article", 5: "no article"}


def test_record_round_trip_and_sink(spark):
    pages = spark.createDataFrame([(1, DETAIL_PAGE)], "page_id long, html string")
    rec = C.extract_movies(pages).drop("page_id")
    msgs = C.encode_records(rec, "title")
    assert msgs.first().key == "Tarot"
    dec = C.decode_records(msgs, C.MOVIE_SCHEMA)
    ok, bad = C.split_quarantine(dec)
    assert bad.count() == 0
    sink = C.sink_project(C.transform_movie(ok)).first()
    assert sink.duration == 92
    assert sink.descriptions == "Un grupo de amigos..."
    assert sink.genre == "Terror, Misterio"
    assert sink.actors == "Harriet Slater,, Adain Bradley,"
    assert sink.years == "2024" and sink.img_url.endswith("tarot.jpg")


def test_quarantine(spark):
    good = json.dumps({"title": "A", "duration": "1h 2m"})
    msgs = spark.createDataFrame([(0, good), (1, "{broken"), (2, None), (3, '["a", "b"]'),
                                  (4, "{'title': 'repr'}")], "offset long, value string")
    dec = C.decode_records(msgs, "title STRING, duration STRING", keep=("offset",))
    ok, bad = C.split_quarantine(dec)
    # the parser takes single quotes; a list is no record
    assert [r.offset for r in ok.collect()] == [0, 4]
    assert {r.offset for r in bad.collect()} == {1, 2, 3}


def test_latest_and_first_message(spark):
    msgs = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("j", 5, "x")],
                                 "key string, offset int, value string")
    last = {r.key: r.value for r in C.keyed_message(msgs, "key", "offset", "last").collect()}
    first = {r.key: r.value for r in C.keyed_message(msgs, "key", "offset", "first").collect()}
    assert last == {"k": "c", "j": "x"} and first == {"k": "a", "j": "x"}
    assert C.keyed_message(msgs, "key", "offset", "all").count() == 4


def test_emit_cap(spark):
    df = spark.range(100).withColumnRenamed("id", "offset")
    got = [r.offset for r in C.emit_cap(df, "offset", 40).collect()]
    assert got == list(range(40))


def test_width_guard_and_dedup(spark):
    df = spark.createDataFrame([(1, "x" * 10), (2, "y" * 3), (3, "y" * 3)], "id long, d string")
    ok, bad = C.width_guard(df, {"d": 5})
    assert [r.id for r in ok.collect()] == [2, 3] and bad.first()._too_long == "d"
    dd = {r.id: r.copies for r in C.dedup_by_content(df, "d", "id").collect()}
    assert dd == {1: 1, 2: 2}


def test_label_pivot_modes(spark):
    items = spark.createDataFrame([(1, 0, "Género:", "Terror"), (1, 1, "Género:", "Drama"),
                                   (1, 2, "País:", "MX"), (1, 3, "País:", "AR"),
                                   (1, 4, "Director:", "A"), (1, 5, "Director:", "B"),
                                   (1, 6, "Otro:", "z")], "doc long, pos int, label string, value string")
    spec = {"Género:": ("genre", "list"), "País:": ("country", "first"), "Director:": ("director", "last")}
    row = C.label_pivot(items, "doc", "label", "value", "pos", spec).first()
    assert row.genre == ["Terror", "Drama"] and row.country == "MX" and row.director == "B"


def test_flagship_has_no_python_udf(spark, sf_dir):
    from marquee.plans import registry
    df = registry.queries()["catalog_pipeline"](spark, sf_dir)
    plan = plan_text(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert df.count() > 0
    assert F is not None
