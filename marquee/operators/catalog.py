"""Catalog operators: stored pages → links → typed records → sink rows.

Each operator is a ``DataFrame -> DataFrame`` transformation.  Per-row
work (regex extraction, JSON encode/decode, clean-up) is narrow: no
shuffle, fully parallel over any number of pages.  The only shuffles are
keyed reductions (latest message per key, label pivot, dedup), and those
use aggregate functions with map-side partial aggregation (``max_by``,
``min_by``, ``collect_set`` over a bounded domain), so a hot key never
funnels its raw rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import patterns as P
from marquee.functions.text import (
    canonical_url, clean_marker, extract, fill_default, list_flatten,
)

MOVIE_SCHEMA = T.StructType([
    T.StructField("image_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("duration", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("quality", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("genre", T.ArrayType(T.StringType())),
    T.StructField("country", T.StringType()),
    T.StructField("director", T.StringType()),
    T.StructField("actors", T.ArrayType(T.StringType())),
    T.StructField("views", T.LongType()),
])


# --- P1 / P2 / P4: links and crawl control ------------------------------

def page_links(pages: DataFrame, pattern: str = P.PAGE_LINK) -> DataFrame:
    """One row per link (page_id, pos, path); empty hrefs are skipped."""
    return (pages
            .select("page_id", "url",
                    F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)))
                    .alias("pos", "path"))
            .where(F.col("path") != ""))


def page_next(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Crawl control: the page number, whether a next link exists and
    whether the crawl goes on (``has_next`` and, if a limit is given, the
    page is below ``max_pages``)."""
    num = F.coalesce(extract("url", P.URL_PAGE_NUMBER).try_cast("int"), F.lit(1))
    has_next = F.col("html").rlike(P.PAGE_NEXT)
    return (pages.select("page_id", num.alias("page_number"), has_next.alias("has_next"))
            .withColumn("continue_crawl", F.col("has_next") if max_pages is None else F.col("has_next") & (F.col("page_number") < max_pages)))


def url_resolve(links: DataFrame, base: Column | str | None = None) -> DataFrame:
    """Absolute URL: ``base + path`` for site-relative paths."""
    origin = F.regexp_extract("url", P.URL_ORIGIN, 1) if base is None else (
        F.lit(base) if isinstance(base, str) else base)
    absolute = F.col("path").rlike("^https?://")
    return links.withColumn("abs_url", F.when(absolute, F.col("path"))
                            .otherwise(F.concat(origin, F.col("path"))))


# --- P5 / P6: validity and field extraction ------------------------------

def page_validity(pages: DataFrame) -> DataFrame:
    """Adds ``valid`` and ``reason`` (first failed rule) columns."""
    has_article = F.instr("html", P.PAGE_ARTICLE) > 0
    has_h1 = extract("html", P.PAGE_H1).isNotNull()
    reason = (F.when(F.col("html").isNull(), F.lit("no body"))
              .when(~has_article, F.lit("no article"))
              .when(~has_h1, F.lit("no title")))
    return pages.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def split_valid(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) — both lazy; quarantine keeps the reason."""
    v = page_validity(pages)
    return v.where("valid").drop("valid", "reason"), v.where(~F.col("valid"))


def count_of(c, needle: str) -> Column:
    """Occurrences of a literal substring."""
    c = F.col(c) if isinstance(c, str) else c
    return ((F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) / len(needle)).cast("bigint")


def page_fields(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id",
        extract("html", P.PAGE_TITLE).alias("title"),
        extract("html", P.PAGE_LANG).alias("lang"),
        extract("html", P.PAGE_CHARSET).alias("charset"),
        extract("html", P.PAGE_H1).alias("h1"),
        F.size(F.regexp_extract_all("html", F.lit(P.PAGE_LINK), F.lit(1))).cast("bigint").alias("n_links"),
        count_of("html", "<p>").alias("n_paragraphs"),
    )


# --- P10: keyed pivot of (label, value) items -----------------------------

def label_pivot(items: DataFrame, key: str, label: str, value: str, pos: str,
                spec: dict[str, tuple[str, str]]) -> DataFrame:
    """Pivot (key, pos, label, value) items into one row per key.

    ``spec`` maps a label to ``(column, mode)``; modes: ``first`` (value
    at the smallest pos), ``last`` (largest pos: a later item overwrites),
    ``set`` (sorted distinct values — bounded by the value domain),
    ``list`` (all values by pos; for small per-key item lists only).
    Labels not in ``spec`` are ignored.  All but ``list`` reduce with
    partial aggregation, so a hot key stays cheap.
    """
    aggs = []
    for lab, (col, mode) in spec.items():
        hit = F.col(label) == lab
        v = F.when(hit, F.col(value))
        p = F.when(hit, F.col(pos))
        if mode == "first":
            aggs.append(F.min_by(v, p).alias(col))
        elif mode == "last":
            aggs.append(F.max_by(v, p).alias(col))
        elif mode == "set":
            aggs.append(F.array_sort(F.collect_set(v)).alias(col))
        elif mode == "list":
            aggs.append(F.transform(F.array_sort(F.collect_list(
                F.when(hit, F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))))),
                lambda s: s["v"]).alias(col))
        else:
            raise ValueError(mode)
    return items.where(F.col(label).isin(list(spec))).groupBy(key).agg(*aggs)


# --- P11 / P14: emit cap, latest / first message ------------------------

def emit_cap(messages: DataFrame, order: str, cap: int) -> DataFrame:
    """At most ``cap`` records, in message order (top-k; no full sort)."""
    return messages.orderBy(order).limit(cap)


def keyed_message(messages: DataFrame, key: str, order: str, mode: str = "last") -> DataFrame:
    """``last``: latest message per key wins; ``first``: earliest;
    ``all``: every message.  ``max_by``/``min_by`` reduce map-side."""
    if mode == "all":
        return messages
    pick = F.max_by if mode == "last" else F.min_by
    cols = [c for c in messages.columns if c != key]
    return (messages.groupBy(key)
            .agg(pick(F.struct(*cols), F.col(order)).alias("m"))
            .select(key, "m.*"))


# --- P12 / P15: record encode / decode with quarantine --------------------

def encode_records(df: DataFrame, key_col: str = "title") -> DataFrame:
    """(key, value) message rows: value is the JSON of all columns."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*df.columns)).alias("value"))


def decode_records(msgs: DataFrame, schema: T.StructType | str, value: str = "value",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse JSON text under an explicit schema (PERMISSIVE).  Adds
    ``_corrupt``: the raw text when it does not parse (or is null), else
    null — the quarantine marker."""
    if isinstance(schema, T.StructType):
        ddl = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType())])
    else:
        ddl = f"{schema}, _corrupt STRING"
    parsed = F.from_json(F.col(value), ddl,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = msgs.select(*keep, F.col(value).alias("_raw"), parsed.alias("r"))
    bad = F.col("_raw").isNull() | F.col("r._corrupt").isNotNull()
    return (out.select(*keep, "r.*", F.when(bad, F.coalesce(F.col("_raw"), F.lit(""))).alias("_bad"))
            .drop("_corrupt").withColumnRenamed("_bad", "_corrupt"))


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = decoded.where(F.col("_corrupt").isNull()).drop("_corrupt")
    bad = decoded.where(F.col("_corrupt").isNotNull())
    return ok, bad


# --- P16–P21: transform and sink -----------------------------------------

def transform_movie(df: DataFrame, marker: str = P.DESCRIPTION_MARKER) -> DataFrame:
    """Reference transform: duration to minutes, description cleaned."""
    from marquee.functions.text import duration_minutes
    return (df.withColumn("duration", duration_minutes("duration"))
            .withColumn("description", clean_marker("description", marker)))


def sink_project(df: DataFrame, strip_trailing_comma: bool = False,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Movie record → sink row (renames, list flattening, fixed order)."""
    return df.select(*keep,
        F.col("title"), F.col("year").alias("years"), F.col("quality"),
        F.col("duration"), F.col("rating"), F.col("description").alias("descriptions"),
        list_flatten("genre").alias("genre"), F.col("director"),
        list_flatten("actors", strip_trailing_comma=strip_trailing_comma).alias("actors"),
        F.col("image_url").alias("img_url"), F.col("country"), F.col("views"))


def fill_movie_defaults(df: DataFrame) -> DataFrame:
    out = df
    for c in ("quality", "country", "director"):
        out = out.withColumn(c, fill_default(c))
    for c in ("genre", "actors"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.array().cast("array<string>")))
    return out


def width_guard(df: DataFrame, widths: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Rows whose text fits every width, and the rest (with the column
    that failed first)."""
    failed = None
    for c, n in widths.items():
        failed = F.when(F.length(c) > n, F.lit(c)) if failed is None else \
            F.coalesce(failed, F.when(F.length(c) > n, F.lit(c)))
    tagged = df.withColumn("_too_long", failed)
    return (tagged.where(F.col("_too_long").isNull()).drop("_too_long"),
            tagged.where(F.col("_too_long").isNotNull()))


def dedup_by_content(df: DataFrame, content: str, keep_min: str) -> DataFrame:
    """Idempotent-sink dedup: one row per distinct content (kept: the
    smallest ``keep_min``), keyed by SHA-256 so the shuffle moves a
    fixed-width key instead of the text."""
    others = [c for c in df.columns if c != keep_min]
    return (df.groupBy(F.sha2(F.col(content), 256).alias("_h"))
            .agg(F.min_by(F.struct(*others), F.col(keep_min)).alias("r"),
                 F.min(keep_min).alias(keep_min), F.count(F.lit(1)).alias("copies"))
            .select(keep_min, "r.*", "copies"))


# --- P6 / P10 (nested fields): detail pages -------------------------------

def node_text(markup: Column) -> Column:
    """Visible text of a piece of markup: the texts between its tags, each
    stripped, put together; the five predefined character references and
    the hard space are decoded."""
    text = F.regexp_replace(markup, r"\s*<[^>]*>\s*", "")
    text = F.regexp_replace(F.regexp_replace(text, P.STRIP_WS, ""), "&nbsp;", "\u00a0")
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(ref), F.lit(char))
    return text


def _found(markup: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(markup, pattern, 1), F.lit(""))


def detail_fields(pages: DataFrame, html_col: str = "html", key: str = "page_id") -> DataFrame:
    """(key, article, list markup, one column for each flat field, reason).

    ``reason`` names the first mandatory element a page lacks; accepted
    pages have none."""
    art = pages.select(key, _found(F.col(html_col), P.DETAIL_ARTICLE).alias("article"))
    for name, pattern in P.DETAIL_FIELDS.items():
        raw = _found(F.col("article"), pattern)
        art = art.withColumn(name, raw if name in P.DETAIL_ATTRIBUTES else node_text(raw))
    reason = F.when(F.col("article").isNull(), F.lit("no article"))
    for name in P.DETAIL_MANDATORY:
        reason = F.coalesce(reason, F.when(F.col(name).isNull(), F.lit(f"no {name}")))
    return art.withColumn("items", _found(F.col("article"), P.DETAIL_LIST)).withColumn("reason", reason)


def detail_items(fields: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, pos, label, values): the info-list items whose label a rule of
    ``P.DETAIL_LABELS`` names, with the texts that the rule picks."""
    item = (fields.select(key, F.posexplode(F.split("items", "<li[^>]*>")).alias("pos", "item"))
            .withColumn("caption", node_text(_found(F.col("item"), P.DETAIL_CAPTION))))
    label, values = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    for name, (caption, pattern) in reversed(P.DETAIL_LABELS.items()):
        hit = F.contains("caption", F.lit(caption))
        texts = F.transform(F.regexp_extract_all("item", F.lit(pattern), F.lit(1)), node_text)
        label, values = F.when(hit, F.lit(name)).otherwise(label), F.when(hit, texts).otherwise(values)
    return item.select(key, "pos", label.alias("label"), values.alias("values")).where("label is not null and size(values) > 0")


def extract_movies(pages: DataFrame, html_col: str = "html", key: str = "page_id") -> DataFrame:
    """Detail pages → movie records, column expressions only: flat fields by
    pattern, list items as rows pivoted by label (a later item of a label
    overwrites).  Pages with a ``reason`` go to :func:`movie_quarantine`."""
    fields = detail_fields(pages, html_col, key)
    items = label_pivot(detail_items(fields, key), key, "label", "values", "pos", {name: (name, "last") for name in P.DETAIL_LABELS})
    items = items.withColumnRenamed(key, "_key")
    rec = fields.where("reason is null").join(items, F.col(key).eqNullSafe(F.col("_key")), "left")
    many = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    one = lambda c: F.coalesce(F.get(F.col(c), 0), F.lit(P.DEFAULT_TEXT))
    return rec.select(
        key, "image_url", "title", F.coalesce(F.regexp_extract("rating", P.RATING, 1).try_cast("double"), F.lit(0.0)).alias("rating"),
        "duration", "year", F.coalesce("quality", F.lit(P.DEFAULT_TEXT)).alias("quality"), "description", many("genre").alias("genre"),
        one("country").alias("country"), one("director").alias("director"), many("actors").alias("actors"),
        F.coalesce(F.regexp_extract("rating", P.VIEWS, 1).try_cast("bigint"), F.lit(0)).alias("views"))


def movie_quarantine(pages: DataFrame, html_col: str = "html", key: str = "page_id") -> DataFrame:
    """(key, reason) of the pages that yield no record."""
    return detail_fields(pages, html_col, key).where("reason is not null").select(key, "reason")
