"""Mixing, sharding, extraction and the pipeline."""

import hashlib
import html
import random
import re
import zlib

import pytest
from helpers import ODD_ROWS, empty_docs, odd_docs, spaced
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import html_wrappers, kk_shards, queries, source_mix


def waterfill(path, budget, rows, weights, epochs):
    """Brute-force budgets of the leaves: shares, then shortages to siblings."""
    if len(path) == 2:
        return {path: budget}
    kids = sorted({r[len(path)] for r in rows}, key=str)
    under = {k: [r for r in rows if r[len(path)] == k] for k in kids}
    cap = {k: epochs * sum(r[2] for r in under[k]) for k in kids}
    w = {k: weights.get(path + (k,), 1.0) for k in kids}
    got, open_, left = dict.fromkeys(kids, 0.0), [k for k in kids if w[k] > 0], budget
    while open_:
        total = sum(w[k] for k in open_)
        full = [k for k in open_ if left * w[k] / total >= cap[k]]
        for k in full or open_:
            got[k] = cap[k] if full else left * w[k] / total
        left -= sum(cap[k] for k in full) if full else left
        open_ = [k for k in open_ if k not in full] if full else []
    idle = [k for k in kids if w[k] == 0]
    room = sum(cap[k] for k in idle)
    if left > 1e-9 and room:
        for k in idle:
            got[k] = min(cap[k], left * cap[k] / room)
    out = {}
    for k in kids:
        out |= waterfill(path + (k,), got[k], under[k], weights, epochs)
    return out


def mixed_by_brute_force(rows, weights, share, epochs, seed):
    leaf = [(lang, source, len(spaced(text)), i) for i, text, lang, source, _ in rows]
    target = waterfill((), share * sum(r[2] for r in leaf), leaf, weights, epochs)
    out = []
    for (lang, source), budget in target.items():
        mine = [r for r in leaf if r[:2] == (lang, source)]
        avail, left = sum(r[2] for r in mine), int(round(budget, 6))
        whole = min(left // avail, epochs) if avail else 1
        out += [(r[3], e) for e in range(whole) for r in mine]
        left -= whole * avail
        total = 0
        for key, i, n in sorted((hashlib.md5(f"{seed}:{whole}:{r[3]}".encode()).hexdigest(), r[3], r[2]) for r in mine):
            total += n
            if left <= 0 or total > left:
                break
            out.append((i, whole))
    return sorted(out)


@pytest.mark.parametrize("share, epochs, weights", [
    (0.5, 1, {("en",): 0.5, ("de",): 0.3, ("fr",): 0.2}), (1.7, 3, {("en",): 0.1, ("en", "src3"): 0.0, ("de", "s1"): 5.0}), (5.0, 2, {})])
def test_mix_against_brute_force(spark, share, epochs, weights):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(40)) or None, rng.choice(["en", "en", "de", "fr", None]), rng.choice(["src1", "src3", "s1", None]), 0) for i in range(400)]
    df = spark.createDataFrame(rows, odd_docs(spark).schema).repartition(6)
    got = sorted((r.doc_id, r.epoch) for r in source_mix.mix(df, ["lang", "source"], weights, share, epochs, seed=9).collect())
    assert got == mixed_by_brute_force(rows, weights, share, epochs, 9)


def test_mix_odd_rows(spark):
    df = odd_docs(spark, True)
    got = source_mix.mix(df, ["lang", "source"], {}, 0.9, 1)
    assert set(df.columns) <= set(got.columns) and got.count() == got.select("doc_id").distinct().count()
    assert source_mix.mix(empty_docs(spark), ["lang", "source"], {}, 0.9, 1).count() == 0


def test_differencing_balances():
    rng = random.Random(5)
    parts = [[rng.randrange(1, 10_000)] + [0] * 4 for _ in range(400)]
    moves = kk_shards.differencing(parts)
    sums = [0] * 5
    for p, m in zip(parts, moves):
        assert sorted(m) == list(range(5))
        sums[m[0]] += p[0]
    assert max(sums) - min(sums) < 100
    # the classic example: 8 7 6 5 4 ends two apart
    two = kk_shards.differencing([[x, 0] for x in (8, 7, 6, 5, 4)])
    sides = [sum(x for x, m in zip((8, 7, 6, 5, 4), two) if m[0] == s) for s in (0, 1)]
    assert abs(sides[0] - sides[1]) == 2


@pytest.mark.parametrize("extra", [False, True])
def test_shards_odd_rows(spark, extra):
    df = odd_docs(spark, extra).unionByName(odd_docs(spark, extra))
    rows = kk_shards.shard_by_bytes(df, 4, slot_rows=7).collect()
    assert len(rows) == 2 * len(ODD_ROWS)
    by_text = {}
    for r in rows:
        assert r["size"] == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode())
        by_text.setdefault(r.text, set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots))) and 0 <= s < 4
    assert kk_shards.shard_by_bytes(empty_docs(spark), 4).count() == 0


def test_shards_many_levels(spark):
    """Nodes of three parts and a fan-in of two give a deep tree; sizes stay near."""
    from marquee.llm.store import Scratch
    rng = random.Random(8)
    rows = [(f"g{i}", rng.randrange(1, 1000)) for i in range(500)]
    got = dict(kk_shards.assign_groups(spark.createDataFrame(rows, "part string, size long"), 8, Scratch(spark, "t"), node=60, fan_in=3).collect())
    assert set(got) == {p for p, _ in rows}
    sums = [sum(s for p, s in rows if got[p] == k) for k in range(8)]
    assert max(sums) - min(sums) < 0.02 * sum(sums)


PAGE = ("<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class='has-sidebar'><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<div class=\"cookie-notice\">We use cookies</div><article><h1>{h}</h1>{body}</article><section id=comments><div class=comment><p>Nice!</p></div></section>"
        "<form><p>Your mail</p></form><aside>{s}</aside><footer>&copy; x</footer></body></html>")


def test_extract_template_pages(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for i in range(60):
        blocks = [" ".join(f"w{rng.randrange(999)}" for _ in range(9)) + " &amp; caf&eacute;" for _ in range(rng.randrange(1, 6))]
        body = "".join(rng.choice([f"<p>{b}</p>", f"<p><b>{b}<br>", f"<ul><li>{b}</li></ul>", f"<div class='ad'>buy</div><p>{b}</p>"]) for b in blocks)
        rows.append((i, f"https://host{i % 2}.example/x{i}", PAGE.format(h=f"Head {i}", body=body, s=f"side {i}"), "clash"))
        want[i] = "\n".join([f"Head {i}"] + [html.unescape(b) for b in blocks])
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    assert {r.id: r.text for r in html_wrappers.extract(df).collect()} == want


def test_extract_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "http://a.b/", "<div>" * 3000 + "deep" + "</div>" * 3000), (4, "http://a.b/", "plain &lt; text"),
            (5, "http://c.d/", "<main><p>a<p>b <script>if(a<b){}</script><!-- x > <p>c --> d</main><div class='related'>no</div>"),
            (6, "http://c.d/", "<main><p>a<p>b <script>if(a<b){}</script><!-- x > <p>c --> d</main><div class='related'>no</div>"),
            (7, "http://e.f/", "<div id=top><p>menu</p></div><div id=mid><h2>Head</h2><p>" + "long text " * 50 + "</p></div>" + "<p " * 50),
            (8, "http://g.h/", "<article>x<div class=ad>buy<p>now</div>y &nbsp; z</article><p>" + "word " * 5000),
            (None, "http://i.j/", "<li>1<li>2<table><tr><td>3<td>4</table>")]
    got = {r.id: r.text for r in html_wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and got[1] == got[2] == "" and got[3] == "deep" and got[4] == "plain < text"
    assert got[5] == got[6] == "a\nb d" and got[7].startswith("Head\nlong text") and got[8] == "x\ny z"
    assert got[None] == "1\n2\n3\n4"
    assert html_wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_operators():
    a = html_wrappers.structure("<div><h1>A</h1><p>x</p><p>y</p></div>")
    b = html_wrappers.structure("<div><h1>B</h1><h2>sub</h2><p>z</p></div>")
    html_wrappers.merge_node(a, b)
    div = a["c"][0]["m"]["div"]
    groups = {tuple(g["m"]): (g["o"], g["r"]) for g in div["c"]}
    assert groups == {("h1",): (0, 0), ("h2",): (1, 0), ("p",): (0, 1)}
    assert div["c"][0]["m"]["h1"]["f"] is None               # a text slot
    c = html_wrappers.structure("<div><p>1</p><h2>2</h2><p>3</p><h2>4</h2></div>")
    (group,) = c["c"][0]["m"]["div"]["c"]
    assert group["r"] == 1 and set(group["m"]) == {"p", "h2"}


def test_pages_table_matches_markup(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r.text for r in queries.op1_extract(spark, sf_dir).collect()}
    for p in pages:
        article = p.html[p.html.index("<article>") + 9:p.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))]
        assert got[p.page_id] == "\n".join(b for b in blocks if b)


def test_pipeline_stages(spark, sf_dir):
    """Every stage on its predecessor's rows; each one's decisions against brute force."""
    from helpers import jaccard_classes
    from test_pairs import brute_hits

    from marquee.llm import toxic_grammar
    from marquee.llm.store import Scratch
    scratch = Scratch(spark, "test")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(scratch.save(stage(spark, steps[-1], sf_dir), name))
        if name != "sharding":
            assert steps[-1].columns == docs.columns
    rows = [{r.doc_id: r for r in s.collect()} for s in steps]
    for before, after in zip(rows, rows[1:]):
        assert set(after) <= set(before) and all(after[i].text == before[i].text for i in after)
    model = toxic_grammar.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = {r.id: r.score for r in toxic_grammar.score(docs, model).collect()}
    assert set(rows[1]) == {i for i in rows[0] if score[i] < 0.5}
    classes = jaccard_classes({i: r.text for i, r in rows[1].items()})
    assert set(rows[2]) == {i for i, c in classes.items() if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert set(rows[3]) == {i for i, r in rows[2].items() if not brute_hits(r.text, items)[1]}
    assert len({r.shard for r in rows[5].values()}) <= 8 and set(rows[5]) == set(rows[4])
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()} == set(rows[5])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, sf_dir, name):
    """Columns called like the operators' own, NULLs, repeated rows and an
    empty table: every stage keeps the columns, and no value changes."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd_docs(spark, True)
    docs = docs.unionByName(docs.where("doc_id in (5, 13, 16)")).unionByName(docs.where("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long")))
    out = stage(spark, docs, sf_dir)
    assert set(docs.columns) <= set(out.columns) and (name == "sharding" or out.columns == docs.columns)
    own = {c for c in docs.columns if name == "sharding" and c in ("size", "text_crc32", "shard", "slot")}
    texts = {(r[0], r[1]) for r in ODD_ROWS} | {(None, dict((r[0], r[1]) for r in ODD_ROWS)[9])}
    rows = out.collect()
    assert rows and all((r.doc_id, r.text) in texts for r in rows)
    assert all(r[c] == "clash" for r in rows for c in docs.columns if c not in own and c not in [x[0] for x in odd_docs(spark).dtypes])
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


ARTICLE = "<article><h1>Title {i}</h1><p>First words of page {i}, and more of them {i}.</p><p>Second block {i}.</p></article>"
PLAIN = "Title {i}\nFirst words of page {i}, and more of them {i}.\nSecond block {i}."


def extracted(spark, pages):
    rows = [(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)]
    return {r.id: r.text for r in html_wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_layout_names_do_not_drop_an_article(spark):
    """Classes of elements around the article say what the layout has."""
    for name in ("layout with-sidebar", "page has-header", "no-comments", "share-enabled", "search-result", "content subscribe-layout"):
        page = f"<html><body><nav>Home</nav><div class='{name}'>" + ARTICLE + "</div><div class='related'><article><p>Teaser</p></article></div></body></html>"
        one = extracted(spark, [page.replace("{i}", "0")])
        assert one == {0: PLAIN.replace("{i}", "0")}, name
    pages = ["<body><div class='share-bar'>Share this</div><main><div class='search-area'>" + ARTICLE.replace("{i}", str(i)) + "</div></main></body>" for i in range(4)]
    assert extracted(spark, pages) == {i: PLAIN.replace("{i}", str(i)) for i in range(4)}
    # without an article the element with most of the text is none either
    body = "<body><div class='notice-board'><p>" + "words and words of {i} " * 20 + "</p></div><div class='promo'>Buy</div></body>"
    assert extracted(spark, [body.replace("{i}", "x")]) == {0: ("words and words of x " * 20).strip()}


def test_template_text_goes_and_slots_stay(spark, monkeypatch):
    """What a host's pages share inside the article is template, whatever it
    is called; with the word lists emptied the wrapper alone knows it."""
    page = ("<body><article><h1>Title {i}</h1><p>First words of page {i}, and more of them {i}.</p><div class='alpha'>Follow us and tell your friends</div>"
            "<p>Second block {i}.</p><div class='beta'><span>More</span> stories</div></article></body>")
    pages = [page.replace("{i}", str(i)) for i in range(6)]
    assert extracted(spark, pages) == {i: PLAIN.replace("{i}", str(i)) for i in range(6)}
    # two pages are not enough to tell, and copies of one page are no template
    assert "Follow us" in extracted(spark, pages[:2])[0]
    assert "Second block 0." in extracted(spark, [pages[0]] * 5)[3]
    rule = html_wrappers.rule_of
    monkeypatch.setattr(html_wrappers, "WORDS", frozenset())
    monkeypatch.setattr(html_wrappers, "HARD", frozenset())
    whole = html_wrappers.structure(pages[0])
    for p in pages[1:]:
        html_wrappers.merge_node(whole, html_wrappers.structure(p))
    assert [html_wrappers.main_text(p, rule(whole)) for p in pages] == [PLAIN.replace("{i}", str(i)) for i in range(6)]


@pytest.mark.parametrize("depth", [5, 39, 40, 46, 300])
def test_articles_at_any_depth(spark, depth):
    page = "<body>" + "<div>" * depth + "<ul class='menu'><li>Menu</li></ul>" + ARTICLE + "<div class='footer'>Foot</div>" + "</div>" * depth + "</body>"
    assert extracted(spark, [page.replace("{i}", str(i)) for i in range(2)]) == {i: PLAIN.replace("{i}", str(i)) for i in range(2)}
