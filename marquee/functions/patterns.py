"""Fixed values.

These strings must equal the catalog semantics for right results (field
regexes, default labels, label names, sink column order).  They use only
the regex subset shared by Java and RE2 (no look-around, no
back-references) so the DuckDB oracle can use them verbatim.
"""

# --- fixed values: record field rules ---------------------------------
RATING = r"\((\d+\.\d+)"
VIEWS = r"desde (\d+) usuarios"
DURATION_HM = r"^(\d+)h (\d+)m$"
DURATION_H = r"^(\d+)h$"
DURATION_M = r"^(\d+)m$"
STRIP_WS = r"^\s+|\s+$"
DEFAULT_TEXT = "Sin dato"
DESCRIPTION_MARKER = "Cuevana3."
EMIT_CAP = 40

# Labels of the detail-page info list, in dispatch order.
LABEL_GENRE = "Género:"
LABEL_COUNTRY = "País:"
LABEL_DIRECTOR = "Director:"
LABEL_ACTORS = "Actores:"

# --- fixed values: stored-page markup ---------------------------------
PAGE_LINK = r'<li><a href="([^"]*)"'
PAGE_LINK_TEXT = r'<li><a href="[^"]*">([^<]*)</a>'
LISTING_ITEM_LINK = r'<li class="xxx TPostMv">[^<]*<a[^>]*href="([^"]*)"'
PAGE_TITLE = r"<title>([^<]*)</title>"
PAGE_LANG = r'<html lang="([^"]*)"'
PAGE_CHARSET = r'<meta charset="([^"]*)"'
PAGE_H1 = r"<h1>([^<]*)</h1>"
PAGE_FIRST_PARAGRAPH = r"<p>([^<]*)</p>"
PAGE_ARTICLE = "<article"
PAGE_NEXT = r'<a[^>]*class="next"'
URL_ORIGIN = r"^(https?://[^/?#]+)"
URL_HOST = r"^https?://([^/?#:]+)"
URL_TLD = r"^https?://[^/?#]*\.([a-z]+)(/|$)"
URL_PAGE_NUMBER = r"[?&]page=(\d+)"
URL_PATH_NUMBER = r"^https?://[^/]+/[^/]+/(\d+)"
URL_LANG = r"^https?://[^/]+/([a-z][a-z])/"

# --- fixed values: detail-page markup ---------------------------------
DETAIL_ARTICLE = r'(?s)<article[^>]*class="(?:[^"]* )?TPost(?: [^"]*)?"[^>]*>(.*?)(?:</article>|$)'
DETAIL_FIELDS = {
    "image_url": r'(?s)<img[^>]*data-src="([^"]*)"',
    "title": r'(?s)<h1[^>]*class="(?:[^"]* )?Title(?: [^"]*)?"[^>]*>(.*?)</h1>',
    "rating": r'(?s)<span[^>]*class="(?:[^"]* )?post-ratings(?: [^"]*)?"[^>]*>(.*?)</span>',
    "duration": r'(?s)<p[^>]*class="(?:[^"]* )?meta(?: [^"]*)?"[^>]*>.*?<span[^>]*>(.*?)</span>.*?</p>',
    "year": r'(?s)<p[^>]*class="(?:[^"]* )?meta(?: [^"]*)?"[^>]*>.*?<a[^>]*>(.*?)</a>.*?</p>',
    "quality": r'(?s)<span[^>]*class="(?:[^"]* )?Qlty(?: [^"]*)?"[^>]*>(.*?)</span>',
    "description": r'(?s)<div[^>]*class="(?:[^"]* )?Description(?: [^"]*)?"[^>]*>(.*?)</div>',
}
DETAIL_ATTRIBUTES = ("image_url",)
DETAIL_MANDATORY = ("title", "rating", "duration", "year", "description")
DETAIL_LIST = r'(?s)<ul[^>]*class="(?:[^"]* )?InfoList(?: [^"]*)?"[^>]*>(.*?)(?:</ul>|$)'
DETAIL_CAPTION = r"(?s)<strong[^>]*>(.*?)</strong>"
# Record field, caption of its list item, texts it takes; in dispatch order.
DETAIL_LABELS = {
    "genre": (LABEL_GENRE, r"(?s)<a[^>]*>(.*?)</a>"),
    "country": (LABEL_COUNTRY, r"(?s)<a[^>]*>(.*?)</a>"),
    "director": (LABEL_DIRECTOR, r'(?s)<span[^>]*class="(?:[^"]* )?color-w(?: [^"]*)?"[^>]*>(.*?)</span>'),
    "actors": (LABEL_ACTORS, r"(?s)<a[^>]*>(.*?)</a>"),
}
