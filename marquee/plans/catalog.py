"""Catalog queries (project operators P1–P25) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions.text import (
    canonical_url, clean_marker, duration_minutes, extract, fill_default,
    list_flatten, parse_rating, parse_views,
)
from marquee.operators import catalog as C
from marquee.plans.registry import query


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sx(col: str, pat: str, g: int = 1) -> str:
    """SQL twin of ``extract``."""
    return f"nullif(regexp_extract({col}, {q(pat)}, {g}), '')"


STRIP_SQL = lambda e: f"regexp_replace({e}, {q(P.STRIP_WS)}, '', 'g')"


def clean_sql(e: str, marker: str) -> str:
    return (f"CASE WHEN instr({e}, {q(marker)}) > 0 THEN "
            f"{STRIP_SQL(f'substring({e}, instr({e}, {q(marker)}) + {len(marker)})')} ELSE {e} END")


def duration_sql(e: str) -> str:
    hm = (f"TRY_CAST({sx(e, P.DURATION_HM, 1)} AS INTEGER) * 60 + "
          f"TRY_CAST({sx(e, P.DURATION_HM, 2)} AS INTEGER)")
    return (f"coalesce({hm}, TRY_CAST({sx(e, P.DURATION_H)} AS INTEGER) * 60, "
            f"TRY_CAST({sx(e, P.DURATION_M)} AS INTEGER))")


# ---------------------------------------------------------------- P1
@query("page_links", oracle=f"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, path FROM (
  SELECT page_id, unnest(regexp_extract_all(html, {q(P.PAGE_LINK)}, 1)) AS path,
         generate_subscripts(regexp_extract_all(html, {q(P.PAGE_LINK)}, 1), 1) AS pos
  FROM pages) WHERE path <> ''
""")
def page_links(t):
    return C.page_links(t.pages).select("page_id", "pos", "path")


# ---------------------------------------------------------------- P2
@query("page_next", oracle=f"""
SELECT page_id, page_number, has_next, has_next AS continue_crawl FROM (
  SELECT page_id, coalesce(TRY_CAST({sx('url', P.URL_PAGE_NUMBER)} AS INTEGER), 1) AS page_number,
         regexp_matches(html, {q(P.PAGE_NEXT)}) AS has_next FROM pages)
""")
def page_next(t):
    return C.page_next(t.pages)


# ---------------------------------------------------------------- P4
@query("url_resolve", oracle=f"""
SELECT page_id, path,
  CASE WHEN regexp_matches(path, '^https?://') THEN path
       ELSE regexp_extract(url, {q(P.URL_ORIGIN)}, 1) || path END AS abs_url
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, {q(P.PAGE_LINK)}, 1)) AS path FROM pages)
WHERE path <> ''
""")
def url_resolve(t):
    return C.url_resolve(C.page_links(t.pages)).select("page_id", "path", "abs_url")


# ---------------------------------------------------------------- P5
_VALID_SQL = f"""
SELECT page_id,
  CASE WHEN html IS NULL THEN 'no body'
       WHEN instr(html, {q(P.PAGE_ARTICLE)}) = 0 THEN 'no article'
       WHEN {sx('html', P.PAGE_H1)} IS NULL THEN 'no title' END AS reason
FROM pages"""


@query("page_valid", oracle=f"SELECT page_id, reason, reason IS NULL AS valid FROM ({_VALID_SQL})")
def page_valid(t):
    return C.page_validity(t.pages).select("page_id", "reason", "valid")


# ---------------------------------------------------------------- P6
@query("page_fields", oracle=f"""
SELECT page_id, {sx('html', P.PAGE_TITLE)} AS title, {sx('html', P.PAGE_LANG)} AS lang,
  {sx('html', P.PAGE_CHARSET)} AS charset, {sx('html', P.PAGE_H1)} AS h1,
  CAST(len(regexp_extract_all(html, {q(P.PAGE_LINK)}, 1)) AS BIGINT) AS n_links,
  CAST((length(html) - length(replace(html, '<p>', ''))) / 3 AS BIGINT) AS n_paragraphs
FROM pages
""")
def page_fields(t):
    return C.page_fields(t.pages)


def detail_markup(pages):
    """Detail pages written out from columns of the stored pages; every
    seventh lacks its description, every eleventh its article."""
    i = F.col("page_id").cast("string")
    safe = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    host, lang = extract("url", P.URL_HOST), F.coalesce(extract("html", P.PAGE_LANG), F.lit("xx"))
    title = safe(F.coalesce(extract("html", P.PAGE_H1), F.lit("untitled")))
    body = F.concat(
        F.lit('<img class="lazy" data-src="'), safe(canonical_url("url")), F.lit('">\n<h1 class="Title">\n  <b>'), title, F.lit('</b>\n</h1>'),
        F.lit('<span class="post-ratings"><b>('), (F.col("page_id") % 100 / 10).cast("string"), F.lit(" / 10)</b> desde "), (F.col("page_id") * 3).cast("string"),
        F.lit(' usuarios</span><p class="meta"><span>'), (F.col("page_id") % 3).cast("string"), F.lit("h "), (F.col("page_id") % 60).cast("string"),
        F.lit('m</span> <a href="/y">'), (F.col("page_id") % 50 + 1970).cast("string"), F.lit('</a></p><span class="Qlty">'), F.upper(lang), F.lit("</span>"),
        F.when(F.col("page_id") % 7 != 0, F.concat(F.lit('<div class="Description"><p>Ver online Cuevana3. '), title, F.lit("</p></div>"))).otherwise(F.lit("")),
        F.lit(f'<ul class="InfoList"><li><strong>{P.LABEL_GENRE}</strong> <a>'), lang, F.lit("</a>, <a>g"), i, F.lit("</a></li>"),
        F.lit(f"<li class=x><strong>{P.LABEL_COUNTRY}</strong><a>old</a><li><strong>{P.LABEL_COUNTRY}</strong> <a> "), extract("url", P.URL_TLD), F.lit(" </a></li>"),
        F.lit(f'<li><strong>{P.LABEL_DIRECTOR}</strong><span class="color-w">'), host, F.lit("</span></li>"),
        F.lit(f"<li><strong>Otro:</strong><a>no</a><li><strong>{P.LABEL_ACTORS}</strong><a>a"), i, F.lit(",</a> <a>b"), i, F.lit(",</a></li></ul>"))
    page = F.when(F.col("page_id") % 11 == 0, F.concat(F.lit("<div>"), body, F.lit("</div>"))).otherwise(
        F.concat(F.lit('<body><article class="post TPost single">'), body, F.lit("</article></body>")))
    return pages.select("page_id", page.alias("html"))


_TITLE_SQL = f"regexp_replace(coalesce({sx('html', P.PAGE_H1)}, 'untitled'), '{P.STRIP_WS}', '', 'g')"


@query("movie_extract", oracle=f"""
SELECT page_id, regexp_replace(url, '[?#].*$', '') AS image_url, {_TITLE_SQL} AS title, page_id % 100 / 10 AS rating,
  (page_id % 3) || 'h ' || (page_id % 60) || 'm' AS duration, CAST(page_id % 50 + 1970 AS VARCHAR) AS year,
  upper(coalesce({sx('html', P.PAGE_LANG)}, 'xx')) AS quality, 'Ver online Cuevana3. ' || {_TITLE_SQL} AS description,
  coalesce({sx('html', P.PAGE_LANG)}, 'xx') || '|g' || page_id AS genre, {sx('url', P.URL_TLD)} AS country, {sx('url', P.URL_HOST)} AS director,
  'a' || page_id || ',|b' || page_id || ',' AS actors, page_id * 3 AS views
FROM pages WHERE page_id % 7 <> 0 AND page_id % 11 <> 0
""")
def movie_extract(t):
    """All twelve fields of the detail pages: flat ones by pattern, list
    items as rows pivoted by label; no Python on the executors."""
    r = C.extract_movies(detail_markup(t.pages))
    return r.withColumns({"genre": F.array_join("genre", "|"), "actors": F.array_join("actors", "|")})


@query("movie_quarantine", oracle="""
SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'no article' ELSE 'no description' END AS reason
FROM pages WHERE page_id % 7 = 0 OR page_id % 11 = 0
""")
def movie_quarantine(t):
    """Detail pages without a record, with the element they lack."""
    return C.movie_quarantine(detail_markup(t.pages))


# Listing markup around the stored links: the class an item must have, and others.
_LISTING_SQL = f"""(SELECT page_id, CAST(pos - 1 AS INTEGER) AS item, path FROM (
  SELECT page_id, unnest(regexp_extract_all(html, {q(P.PAGE_LINK)}, 1)) AS path,
         generate_subscripts(regexp_extract_all(html, {q(P.PAGE_LINK)}, 1), 1) AS pos FROM pages) WHERE path <> '')"""


@query("listing_links", oracle=f"""
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY item) - 1 AS INTEGER) AS pos, path
FROM {_LISTING_SQL} WHERE item % 2 = 0
""")
def listing_links(t):
    """Listing pages: only items of the exact listing class give links;
    pages without any end the crawl (no rows)."""
    link = C.page_links(t.pages).select("page_id", "pos", "path")
    item = F.when(F.col("pos") % 2 == 0, F.concat(F.lit('<li class="xxx TPostMv"> <a title="x" href="'), "path", F.lit('">t</a></li>'))).otherwise(
        F.concat(F.lit('<li class="TPostMv"><a href="'), "path", F.lit('">t</a></li>')))
    pages = (link.select("page_id", F.struct("pos", item.alias("li")).alias("s")).groupBy("page_id")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["li"]), "").alias("html")))
    return C.page_links(pages.withColumn("url", F.lit("")), P.LISTING_ITEM_LINK).select("page_id", "pos", "path")


# ---------------------------------------------------------------- P7 / P8
_RATING_TEXT = ("CASE WHEN event_type = 'error' THEN '(' || CAST(user_id AS VARCHAR) "
                "ELSE '(' || CAST(floor(value) / 10.0 AS VARCHAR) || ' / 10) desde ' || CAST(user_id AS VARCHAR) || ' usuarios' END")


def _rating_text(t):
    ev = t.events
    txt = F.when(F.col("event_type") == "error", F.concat(F.lit("("), F.col("user_id").cast("string"))) \
        .otherwise(F.concat(F.lit("("), (F.floor("value") / 10.0).cast("string"),
                            F.lit(" / 10) desde "), F.col("user_id").cast("string"), F.lit(" usuarios")))
    return ev.select("event_id", txt.alias("txt"))


@query("parse_rating", oracle=f"""
SELECT event_id, txt, coalesce(TRY_CAST({sx('txt', P.RATING)} AS DOUBLE), 0.0) AS rating
FROM (SELECT event_id, {_RATING_TEXT} AS txt FROM events)
""")
def parse_rating_q(t):
    return _rating_text(t).withColumn("rating", parse_rating("txt"))


@query("parse_views", oracle=f"""
SELECT event_id, coalesce(TRY_CAST({sx('txt', P.VIEWS)} AS BIGINT), 0) AS views
FROM (SELECT event_id, {_RATING_TEXT} AS txt FROM events)
""")
def parse_views_q(t):
    return _rating_text(t).select("event_id", parse_views("txt").alias("views"))


# ---------------------------------------------------------------- P9 / P10
_PIVOT_SPEC = {"view": ("genre", "set"), "click": ("country", "first"),
               "purchase": ("director", "last"), "signup": ("actors", "set")}


def _pivot(t):
    ev = t.events.select("user_id", "event_id", "event_type",
                         F.get_json_object("props", "$.k").alias("k"))
    return C.label_pivot(ev, "user_id", "event_type", "k", "event_id", _PIVOT_SPEC)


_PIVOT_SQL = """
SELECT user_id,
  array_to_string(list_sort(list_distinct(list(k) FILTER (WHERE event_type = 'view'))), ', ') AS genre,
  arg_min(k, event_id) FILTER (WHERE event_type = 'click') AS country,
  arg_max(k, event_id) FILTER (WHERE event_type = 'purchase') AS director,
  array_to_string(list_sort(list_distinct(list(k) FILTER (WHERE event_type = 'signup'))), ', ') AS actors
FROM (SELECT user_id, event_id, event_type, json_extract_string(props, '$.k') AS k FROM events
      WHERE event_type IN ('view', 'click', 'purchase', 'signup'))
GROUP BY user_id"""


@query("label_pivot", oracle=f"""
SELECT user_id, nullif(genre, '') AS genre, country, director, nullif(actors, '') AS actors
FROM ({_PIVOT_SQL})""")
def label_pivot(t):
    p = _pivot(t)
    return p.select("user_id",
                    F.nullif(F.array_join("genre", ", "), F.lit("")).alias("genre"),
                    "country", "director",
                    F.nullif(F.array_join("actors", ", "), F.lit("")).alias("actors"))


@query("fill_defaults", oracle=f"""
SELECT user_id, genre, coalesce(nullif(country, ''), 'Sin dato') AS country,
  coalesce(nullif(director, ''), 'Sin dato') AS director, actors
FROM ({_PIVOT_SQL})""")
def fill_defaults(t):
    p = C.fill_movie_defaults(_pivot(t).withColumn("quality", F.lit(None).cast("string")))
    return p.select("user_id", list_flatten("genre").alias("genre"), fill_default("country").alias("country"),
                    fill_default("director").alias("director"), list_flatten("actors").alias("actors"))


# ---------------------------------------------------------------- P11 / P14
@query("emit_cap", oracle="SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 40")
def emit_cap(t):
    return C.emit_cap(t.events.select("event_id", "user_id", "event_type"), "event_id", P.EMIT_CAP)


_MSG_COLS = "event_id, event_type, round(value, 2) AS value"


@query("latest_message", oracle=f"""
SELECT user_id, {_MSG_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def latest_message(t):
    m = C.keyed_message(t.events.select("user_id", "event_id", "event_type", "value"),
                        "user_id", "event_id", "last")
    return m.withColumn("value", F.round("value", 2))


@query("first_message", oracle=f"""
SELECT user_id, {_MSG_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def first_message(t):
    m = C.keyed_message(t.events.select("user_id", "event_id", "event_type", "value"),
                        "user_id", "event_id", "first")
    return m.withColumn("value", F.round("value", 2))


# ---------------------------------------------------------------- P12 / P15
@query("json_decode", oracle="""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_decode(t):
    d = C.decode_records(t.events, "k INT", value="props", keep=("event_id",))
    return d.select("event_id", "k")


def _broken_props(t):
    ev = t.events
    broken = F.when(F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)")) \
        .when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("props"))
    return ev.select("event_id", broken.alias("props"))


@query("json_quarantine", oracle="""
SELECT event_id, CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
  CASE WHEN event_type = 'error' THEN substring(props, 1, length(props) - 1) WHEN event_type = 'signup' THEN '' END AS _corrupt
FROM events
""")
def json_quarantine(t):
    """Valid payloads decode; truncated or missing ones go to quarantine
    (``_corrupt`` holds the raw text)."""
    return C.decode_records(_broken_props(t), "k INT", value="props", keep=("event_id",))


@query("record_encode", oracle="""
SELECT event_type AS key, '{"title":"' || event_type || '","event_id":' || event_id || ',"user_id":' || user_id || ',"value":' || cents || '}' AS value
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
""")
def record_encode(t):
    """Records → (key, JSON value) messages, keyed by title."""
    rec = t.events.select(F.col("event_type").alias("title"), "event_id", "user_id", F.round(F.col("value") * 100).cast("bigint").alias("value"))
    return C.encode_records(rec, "title")


# ---------------------------------------------------------------- P16
_DURATION_TEXT_SQL = """CASE WHEN event_type = 'error' THEN CAST(minute(ts) AS VARCHAR) || 'm'
  WHEN event_type = 'signup' THEN 'x' || CAST(hour(ts) AS VARCHAR)
  WHEN event_type = 'purchase' THEN CAST(hour(ts) AS VARCHAR) || 'h'
  ELSE CAST(hour(ts) AS VARCHAR) || 'h ' || CAST(minute(ts) AS VARCHAR) || 'm' END"""


@query("duration_minutes", oracle=f"""
SELECT event_id, d, {duration_sql('d')} AS minutes FROM (SELECT event_id, {_DURATION_TEXT_SQL} AS d FROM events)
""")
def duration_minutes_q(t):
    ev = t.events
    h, m = F.hour("ts").cast("string"), F.minute("ts").cast("string")
    d = (F.when(F.col("event_type") == "error", F.concat(m, F.lit("m")))
         .when(F.col("event_type") == "signup", F.concat(F.lit("x"), h))
         .when(F.col("event_type") == "purchase", F.concat(h, F.lit("h")))
         .otherwise(F.concat(h, F.lit("h "), m, F.lit("m"))))
    return ev.select("event_id", d.alias("d")).withColumn("minutes", duration_minutes("d"))


# ---------------------------------------------------------------- P17
_MARKED_SQL = "CASE WHEN doc_id % 2 = 0 THEN source || ' Marker.' || text ELSE text END"


@query("clean_marker", oracle=f"""
SELECT doc_id, {clean_sql('t', 'Marker.')} AS cleaned FROM (SELECT doc_id, {_MARKED_SQL} AS t FROM documents)
""")
def clean_marker_q(t):
    d = t.documents
    marked = F.when(F.col("doc_id") % 2 == 0, F.concat("source", F.lit(" Marker."), "text")).otherwise(F.col("text"))
    return d.select("doc_id", clean_marker(marked, "Marker.").alias("cleaned"))


# ---------------------------------------------------------------- P18
@query("list_flatten", oracle="""
SELECT user_id, array_to_string(list_sort(list_distinct(list(event_type))), ', ') AS types
FROM events GROUP BY user_id
""")
def list_flatten_q(t):
    return (t.events.groupBy("user_id")
            .agg(list_flatten(F.array_sort(F.collect_set("event_type"))).alias("types")))


# ---------------------------------------------------------------- P19–P21
@query("sink_project", oracle="""
SELECT source AS title, CAST(doc_id AS VARCHAR) AS years, lang AS quality, n_chars AS duration,
  text AS descriptions, 'Sin dato' AS director, doc_id FROM documents
""")
def sink_project(t):
    d = t.documents
    return d.select(F.col("source").alias("title"), F.col("doc_id").cast("string").alias("years"),
                    F.col("lang").alias("quality"), F.col("n_chars").alias("duration"),
                    F.col("text").alias("descriptions"), F.lit(P.DEFAULT_TEXT).alias("director"), "doc_id")


@query("sink_dedup", oracle="""
SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, count(*) AS copies
FROM documents GROUP BY sha256(text)
""")
def sink_dedup(t):
    return C.dedup_by_content(t.documents.select("doc_id", "text", "source"), "text", "doc_id") \
        .select("doc_id", "source", "copies")


@query("width_guard", oracle="""
SELECT doc_id, length(text) AS width, length(text) <= 2000 AS fits FROM documents
""")
def width_guard(t):
    d = t.documents.select("doc_id", "text")
    ok, bad = C.width_guard(d, {"text": 2000})
    return (ok.select("doc_id", F.length("text").alias("width"), F.lit(True).alias("fits"))
            .unionByName(bad.select("doc_id", F.length("text").alias("width"), F.lit(False).alias("fits"))))


# ---------------------------------------------------------------- P25 flagship
def catalog_records(pages):
    """Stored pages → movie records (before sink projection)."""
    ok, _quarantine = C.split_valid(pages)
    n_chars = F.length("html")
    minutes = F.ceil(n_chars / 1000)
    rec = ok.select(
        "page_id",
        canonical_url("url").alias("image_url"),
        extract("html", P.PAGE_H1).alias("title"),
        parse_rating(F.col("html")).alias("rating"),
        F.concat(F.floor(minutes / 60).cast("string"), F.lit("h "),
                 (minutes % 60).cast("string"), F.lit("m")).alias("duration"),
        extract("url", P.URL_PATH_NUMBER).alias("year"),
        extract("html", P.PAGE_LANG).alias("quality"),
        extract("html", P.PAGE_FIRST_PARAGRAPH).alias("description"),
        F.regexp_extract_all("html", F.lit(P.PAGE_LINK_TEXT), F.lit(1)).alias("genre"),
        extract("url", P.URL_TLD).alias("country"),
        extract("url", P.URL_HOST).alias("director"),
        F.filter(F.regexp_extract_all("url", F.lit(r"/([a-z]{2})/"), F.lit(1)), lambda x: x != "").alias("actors"),
        C.count_of("html", "<p>").alias("views"),
    )
    # topic hand-off: encode to JSON and decode under the explicit schema
    msgs = rec.select("page_id", F.to_json(F.struct(*[c for c in rec.columns if c != "page_id"])).alias("value"))
    dec, _bad = C.split_quarantine(C.decode_records(msgs, C.MOVIE_SCHEMA, keep=("page_id",)))
    out = C.fill_movie_defaults(C.transform_movie(dec, marker="."))
    return out


@query("catalog_pipeline", oracle=f"""
WITH ok AS (
  SELECT page_id, url, html FROM ({_VALID_SQL}) v JOIN pages USING (page_id) WHERE reason IS NULL
), rec AS (
  SELECT page_id,
    regexp_replace(url, '[?#].*$', '') AS img_url,
    {sx('html', P.PAGE_H1)} AS title,
    coalesce(TRY_CAST({sx('html', P.RATING)} AS DOUBLE), 0.0) AS rating,
    {duration_sql("CAST(floor(ceil(length(html) / 1000) / 60) AS BIGINT) || 'h ' || "
                  "CAST(CAST(ceil(length(html) / 1000) AS BIGINT) % 60 AS VARCHAR) || 'm'")} AS duration,
    {sx('url', P.URL_PATH_NUMBER)} AS years,
    coalesce({sx('html', P.PAGE_LANG)}, 'Sin dato') AS quality,
    {clean_sql(sx('html', P.PAGE_FIRST_PARAGRAPH), '.')} AS descriptions,
    array_to_string(regexp_extract_all(html, {q(P.PAGE_LINK_TEXT)}, 1), ', ') AS genre,
    coalesce({sx('url', P.URL_TLD)}, 'Sin dato') AS country,
    coalesce({sx('url', P.URL_HOST)}, 'Sin dato') AS director,
    array_to_string(list_filter(regexp_extract_all(url, '/([a-z]{{2}})/', 1), lambda x: x <> ''), ', ') AS actors,
    CAST((length(html) - length(replace(html, '<p>', ''))) / 3 AS BIGINT) AS views
  FROM ok
)
SELECT min(page_id) AS page_id, arg_min(title, page_id) AS title, arg_min(years, page_id) AS years,
  arg_min(quality, page_id) AS quality, arg_min(duration, page_id) AS duration,
  arg_min(rating, page_id) AS rating, arg_min(descriptions, page_id) AS descriptions,
  arg_min(genre, page_id) AS genre, arg_min(director, page_id) AS director,
  arg_min(actors, page_id) AS actors, img_url, arg_min(country, page_id) AS country,
  arg_min(views, page_id) AS views, count(*) AS copies
FROM rec GROUP BY img_url
""")
def catalog_pipeline(t):
    """Flagship: pages → validity → fields → JSON hand-off → transform
    → defaults → dedup on the canonical URL (idempotent sink) → sink rows."""
    rec = catalog_records(t.pages)
    deduped = C.dedup_by_content(rec, "image_url", "page_id")
    return C.sink_project(deduped, keep=("page_id", "copies"))
