"""Main text of web pages by wrappers inferred for each host.

A wrapper is a union-free expression over page structure: a sequence of
elements, each required, optional or in a repeated group, with text slots.
The first page of a host is its own wrapper; every further page (or
wrapper) is aligned with it.  Where children do not match, the odd one
becomes optional; a child that comes back makes everything from its first
to its last place one repeated group; texts that differ turn fixed text
into a slot.  Labels are unique within a sequence after folding, so a
wrapper stays as small as the host's markup, however many pages it has.

Merging is associative in effect, so tasks infer wrappers from their own
pages, these are merged in salted groups and then by host: all pages take
part and a host with a third of all pages is no single group.

The wrapper decides three things.  Where the article is: the article
elements outside of boilerplate, else the main element, else the smallest
element that holds most of the text in slots outside links and boilerplate.
Which marks count: an element whose class, id or role only sounds like
boilerplate (layout names such as share-enabled or search-result) is none if
it holds the page's longest article or main element, or most of its text.
What is template: inside the article, text that is the same on all pages
that have its element, ``SEVERAL`` at least, goes, provided that most of the
article is text in slots.  A page is then read along these paths; menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out wherever they stand.  Character references are decoded, white space inside a block
becomes one space, blocks are joined by a newline.

Cases: NULL and empty html give the empty text; broken, unclosed and
deeply nested markup is read as far as it goes (elements below depth 40
are parts of the one at that depth, side by side); a page that lacks its host's article is read by its
own structure; pages with a NULL url form one host; repeated rows are rows;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Roles of HTML elements and of words in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video select xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
DROP = frozenset("nav footer aside form button dialog menu fieldset".split())
WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer header masthead topbar toolbar ad ads adv advert adverts advertisement "
    "advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert warning popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations teaser comment comments reply replies "
    "respond discussion disqus pager pagination search skip copyright contentinfo complementary dialog form hidden".split())
#: On the elements that hold the page or an article only these words count.
HARD = frozenset("comment comments reply replies ad advert advertisement sponsored teaser related".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TEXT = frozenset("p li ul ol dl dt dd h1 h2 h3 h4 h5 h6 blockquote pre table thead tbody tr td th figure figcaption details summary address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: First words of a class that say what a layout has or lacks: ``with-sidebar``, ``no-comments``.
LAYOUT = frozenset("with without has have no not hide hides show shows".split())
DEPTH = 40
SEVERAL = 3          # pages that make a text a template

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
SPLIT = re.compile(r"[^a-zA-Z]+")


def label_of(name: str, attributes: str) -> tuple[str, int]:
    """Structure label of an element and whether it is boilerplate: 2 by its
    kind, 1 if only a word says so, 0 if not."""
    words, hidden, shown = [], False, ""
    if attributes and not attributes.isspace():
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id", "role"):
                for token in value.lower().split():
                    parts = [w for w in SPLIT.split(token) if w]
                    words += [] if parts and parts[0] in LAYOUT else parts
                if key != "id" or not shown and name in ("div", "section"):
                    shown = ".".join(w.lower() for w in SPLIT.split(value)[:3] if w) or shown
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif key == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
    kind = 0
    if hidden or name in DROP or name == "header" or any(w in HARD for w in words):
        kind = 2
    elif name not in ("html", "body", "main", "article") and any(w in WORDS for w in words):
        kind = 1
    return f"{name}.{shown}" if shown else name, kind


def events(page: str):
    """(kind, label, boilerplate, text) with kind "open", "close", "break" or
    "text"; labels of close events are element names."""
    at, end = 0, len(page)
    while at < end:
        m = MARKUP.search(page, at)
        if m is None:
            yield "text", "", False, page[at:]
            return
        if m.start() > at:
            yield "text", "", False, page[at:m.start()]
        at = m.end()
        if m[2]:
            closing, name, attributes = m[1], m[2].lower(), m[3]
        elif m[5]:
            closing, name, attributes = m[4], m[5].lower(), m[6]
        else:
            continue
        if name in INLINE:
            if not closing:
                _, drop = label_of(name, attributes)
                if drop and not attributes.rstrip().endswith("/"):
                    yield "open", name + ".-", 2, name
            else:
                yield "close", name, False, name
            continue
        if name in VOID:
            yield "break", name, False, ""
        elif closing:
            yield "close", name, False, name
        elif name in RAW:
            stop = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
        else:
            label, drop = label_of(name, attributes)
            yield "open", label, drop, name


class Reader:
    """Walks a page: an open-element stack of (name, label, boilerplate)."""

    def __init__(self):
        self.stack: list[tuple[str, str, bool]] = []
        self.names: dict[str, int] = {}

    def push(self, name: str, label: str, drop: bool) -> None:
        above = bool(self.stack) and self.stack[-1][2]
        if name == "header" and drop:
            drop = "header"
        self.stack.append((name, label, above or drop))
        self.names[name] = self.names.get(name, 0) + 1

    def clear(self) -> None:
        """The mark of the element just opened does not count."""
        name, label, _ = self.stack[-1]
        self.stack[-1] = (name, label, len(self.stack) > 1 and self.stack[-2][2])

    def pop(self) -> None:
        name, *_ = self.stack.pop()
        self.names[name] -= 1

    def open(self, name: str, label: str, drop: bool) -> None:
        if name not in INLINE and self.names.get("p"):
            # a block ends an open paragraph, with what stands open inside it
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == "p":
                    while len(self.stack) > i:
                        self.pop()
                    break
                if self.stack[i][0] not in INLINE:
                    break
        ends = CLOSES.get(name)
        if ends:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in ends:
                    while len(self.stack) > i:
                        self.pop()
                    break
                if self.stack[i][0] in ("ul", "ol", "dl", "table", "tbody", "thead", "div", "article", "section", "tr"):
                    break
        self.push(name, label, drop)

    def close(self, name: str) -> None:
        if self.names.get(name):
            while self.stack:
                last = self.stack[-1][0]
                self.pop()
                if last == name:
                    return

    def dropped(self) -> bool:
        """Whether text here is boilerplate; a heading in an article's header is not."""
        if not self.stack or not self.stack[-1][2]:
            return False
        if self.stack[-1][2] == "header" or self.names.get("header"):
            names = [s[0] for s in self.stack]
            if "article" in names and any(n in HEADINGS for n in names):
                i = names.index("article")
                cause = [s for j, s in enumerate(self.stack) if s[2] and not (j and self.stack[j - 1][2])]
                return not (names[i:].count("header") == 1 and cause and cause[0][0] == "header")
        return True


# --- wrappers ---------------------------------------------------------------------------------
# node: {"n": pages, "s": slot chars, "f": fixed text hash or None, "x": boilerplate, "w": by a word of its own, "c": groups}
# group: {"o": optional, "r": repeated, "m": {label: node}}


def structure(page: str) -> dict:
    """The wrapper of one page."""
    root = {"n": 1, "s": 0, "f": 0, "x": 0, "w": 0, "c": []}
    nodes, reader = [root], Reader()

    def sync(size: int):
        while len(nodes) > size:
            fold(nodes.pop())

    for kind, label, drop, text in events(page):
        if kind == "open":
            reader.open(text, label, drop)
            # the stack may have shrunk before it grew by one
            sync(len(reader.stack))
            node = {"n": 1, "s": 0, "f": 0, "x": int(drop == 2), "w": int(drop == 1), "c": []}
            nodes[min(len(nodes) - 1, DEPTH)]["c"].append({"o": 0, "r": 0, "m": {label: node}})
            nodes.append(node)
        elif kind == "close":
            reader.close(text)
            sync(len(reader.stack) + 1)
        elif kind == "text":
            words = text.split()
            if words:
                node = nodes[-1]
                node["s"] += len(text)
                node["f"] = hash_of(" ".join(words)) ^ (node["f"] or 0)
    sync(0)
    return root


def hash_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def fold(node: dict) -> None:
    """Make labels unique among the children: adjacent equals become a
    repeated element, a label that comes back a repeated group."""
    out: list[dict] = []
    where: dict[str, int] = {}
    for g in node["c"]:
        at = min((where[x] for x in g["m"] if x in where), default=None)
        if at is None:
            out.append(g)
        else:
            merged = out[at]
            for other in out[at + 1:] + [g]:
                merge_group(merged, other, repeat=True)
            del out[at + 1:]
        start = len(out) - 1 if at is None else at
        for x in out[start]["m"]:
            where[x] = start
    node["c"] = out


def merge_group(a: dict, b: dict, repeat: bool = False) -> None:
    a["o"] |= b["o"]
    a["r"] |= b["r"] or int(repeat)
    for label, node in b["m"].items():
        if label in a["m"]:
            merge_node(a["m"][label], node, pages=not repeat)
        else:
            a["m"][label] = node
            a["r"] = 1


def merge_node(a: dict, b: dict, pages: bool = True) -> None:
    """Align node b with node a, in place.  ``pages``: both come from
    different pages (else: repeats within one)."""
    if a["f"] != b["f"]:
        a["f"] = None                       # fixed text becomes a slot
    a["n"] = a["n"] + b["n"] if pages else max(a["n"], b["n"])
    a["s"] += b["s"]
    a["x"] &= b["x"]
    a["w"] &= b["w"]
    mine, other = a["c"], b["c"]
    place = {x: i for i, g in enumerate(mine) for x in g["m"]}
    out, i = [], 0
    for g in other:
        at = min((place[x] for x in g["m"] if x in place), default=None)
        if at is None:
            g["o"] = 1                      # only in b
            out.append(g)
        elif at < i:                        # out of order: folded below
            out.append(g)
        else:
            for h in mine[i:at]:
                h["o"] = 1                  # only in a
                out.append(h)
            merge_group(mine[at], g)
            out.append(mine[at])
            i = at + 1
    for h in mine[i:]:
        h["o"] = 1
        out.append(h)
    a["c"] = out
    fold(a)


def rule_of(wrapper: dict) -> dict:
    """What a wrapper says: ``paths`` (labels joined by >) of the elements
    that hold the article (the empty path is the whole page), ``clear`` paths
    whose word marks do not count, and ``fixed`` paths of template text."""
    flat: list = []                # (node, path, parent's place, name, label), parents first
    todo = [(wrapper, "", -1, "", "")]
    while todo:
        node, path, up, name, label = todo.pop()
        flat.append((node, path, up, name, label))
        here = len(flat) - 1
        todo += [(c, f"{path}>{x}", here, x.split(".")[0], x) for g in node["c"] for x, c in g["m"].items()]
    many = wrapper["n"] > 1
    own = [0 if many and n["n"] > 1 and n["f"] is not None else n["s"] for n, *_ in flat]

    def article(i: int) -> str:
        name, label = flat[i][3:]
        return "article" if name == "article" else "main" if name == "main" or "main" in label.split(".")[1:] else ""

    # marks that do not count: by the text under each element without what is marked below
    text = own.copy()
    for i in range(len(flat) - 1, 0, -1):
        node, _, up, *_ = flat[i]
        if not node["x"] and not node["w"]:
            text[up] += text[i]
    hard = [False] * len(flat)
    longest = [0] * len(flat)      # longest article in the element
    for i, (node, _, up, *_) in enumerate(flat):
        hard[i] = bool(node["x"]) or (up >= 0 and hard[up])
    for i in range(len(flat) - 1, -1, -1):
        if not hard[i]:
            if article(i) and not flat[i][0]["w"]:
                longest[i] = max(longest[i], text[i])
            if i:
                up = flat[i][2]
                longest[up] = max(longest[up], longest[i])
    whole = sum(own[i] for i in range(len(flat)) if not hard[i])
    clear = {i for i, (node, *_) in enumerate(flat) if node["w"] and not hard[i] and (
        2 * longest[i] >= longest[0] if longest[0] else 10 * text[i] >= 7 * whole > 0)}

    drop, inside = [False] * len(flat), [""] * len(flat)
    for i, (node, _, up, *_) in enumerate(flat):
        drop[i] = bool(node["x"]) or bool(node["w"] and i not in clear) or (up >= 0 and drop[up])
        if up >= 0:
            inside[i] = inside[up] + article(up)
    text = [0 if drop[i] else own[i] for i in range(len(flat))]
    for i in range(len(flat) - 1, 0, -1):
        text[flat[i][2]] += text[i]
    found: dict[str, list[int]] = {"article": [], "main": []}
    best, depth = 0, [0] * len(flat)
    for i, (_, _, up, name, _) in enumerate(flat):
        if up < 0 or drop[i]:
            continue
        depth[i] = depth[up] + 1
        kind = article(i)
        if kind and kind not in inside[i]:
            found[kind].append(i)
        if text[0] and name not in TEXT and 10 * text[i] >= 7 * text[0] and depth[i] >= depth[best]:
            best = i
    at = found["article"] or found["main"] or [best]

    # template text: the same on all pages that have its element
    within, slots, fixed = set(at), 0, []
    for i, (node, path, up, *_) in enumerate(flat):
        if i in within or up in within:
            within.add(i)
            if drop[i] or not node["s"]:
                continue
            if node["f"] is not None and node["n"] >= SEVERAL:
                fixed.append((path, node["s"]))
            else:
                slots += node["s"]
    keep = 2 * slots < slots + sum(n for _, n in fixed)
    return {"paths": sorted(flat[i][1] for i in at), "clear": sorted(flat[i][1] for i in clear), "fixed": [] if keep else sorted(p for p, _ in fixed)}


def article_paths(wrapper: dict) -> list[str]:
    return rule_of(wrapper)["paths"]


def main_text(page: str | None, rule: dict) -> str:
    """Blocks of a page under any of the rule's paths, without boilerplate
    and template text."""
    paths, clear, fixed = (frozenset(rule[k]) for k in ("paths", "clear", "fixed"))
    blocks, current, reader = [], [], Reader()
    path, inside, seen = [""], ["" in paths], "" in paths

    def flush():
        words = html.unescape("".join(current)).split()
        current.clear()
        if words:
            blocks.append(" ".join(words))

    for kind, label, drop, text in events(page or ""):
        if kind == "text":
            if inside[-1] and path[-1] not in fixed and not reader.dropped():
                current.append(text)
        elif kind == "break":
            current.append("\n" if label != "hr" else "")
            if label == "hr":
                flush()
        elif kind == "open":
            if text not in INLINE:
                flush()
            # open elements may end before this one begins
            reader.open(text, label, drop)
            del path[len(reader.stack):], inside[len(reader.stack):]
            here = f"{path[min(len(path) - 1, DEPTH)]}>{label}"
            if drop == 1 and here in clear:
                reader.clear()
            path.append(here)
            inside.append(inside[-1] or here in paths)
            seen |= inside[-1]
        else:
            if text not in INLINE:
                flush()
            elif not reader.names.get(text):
                continue
            elif not any(s[0] == text and s[1].endswith(".-") for s in reader.stack):
                continue
            reader.close(text)
            del path[len(reader.stack) + 1:], inside[len(reader.stack) + 1:]
    flush()
    if not seen and page:
        own = rule_of(structure(page))
        if own["paths"] and own["paths"] != sorted(paths):
            return main_text(page, own)
    return "\n".join(blocks)


# --- Spark ------------------------------------------------------------------------------------


def _infer(batches):
    """One wrapper for each host of the task's pages."""
    hosts: dict[str, dict] = {}
    for b in batches:
        for host, page in zip(b.column(0).to_pylist(), b.column(1)):
            wrapper = structure(page.as_py() or "")
            if host in hosts:
                merge_node(hosts[host], wrapper)
            else:
                hosts[host] = wrapper
        if len(hosts) > 5_000:              # memory stays bounded; the groups below merge the rest
            yield _rows(hosts)
            hosts = {}
    yield _rows(hosts)


def _rows(hosts: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(hosts), pa.string()), pa.array([json.dumps(w) for w in hosts.values()], pa.string())], names=["host", "wrapper"])


def _merge_all(wrappers) -> dict:
    first = None
    for w in wrappers:
        w = json.loads(w)
        if first is None:
            first = w
        else:
            merge_node(first, w)
    return first


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(_merge_all(pdf["wrapper"]))]})


def _decide(pdf: pd.DataFrame) -> pd.DataFrame:
    wrapper = _merge_all(pdf["wrapper"])
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(wrapper)], "paths": [json.dumps(rule_of(wrapper))]})


def host_of(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/?#:]*)", 1))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", salts: int = 64) -> DataFrame:
    """Rows (host, wrapper json, paths): one for each host."""
    part = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).mapInArrow(_infer, "host string, wrapper string")
    part = part.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
    part = part.groupBy("host", "salt").applyInPandas(lambda key, pdf: _merge(pdf), "host string, wrapper string")
    return part.groupBy("host").applyInPandas(lambda key, pdf: _decide(pdf), "host string, wrapper string, paths string")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", salts: int = 32) -> DataFrame:
    """Rows (id, url, text) of all pages.

    Wrappers meet the pages by host; both sides are salted, so that a hot
    host's pages are spread over ``salts`` groups."""
    rules = infer_wrappers(pages, url_col, html_col).select("host", "paths").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"))
    p = p.withColumn("salt", F.pmod(F.xxhash64("id", "html"), F.lit(salts)).cast("int"))

    def read(batches):
        known: dict[str, dict] = {}
        for b in batches:
            out = []
            for page, paths in zip(b.column(2), b.column(3).to_pylist()):
                if paths not in known:
                    known[paths] = json.loads(paths) if paths else {"paths": [], "clear": [], "fixed": []}
                out.append(main_text(page.as_py(), known[paths]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["id", "url", "text"])

    joined = p.join(rules, ["host", "salt"], "left").select("id", "url", "html", "paths")
    return joined.mapInArrow(read, f"id {dict(pages.dtypes)[id_col]}, url {dict(pages.dtypes)[url_col]}, text string")
