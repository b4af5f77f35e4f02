"""The registered queries of the training-data operators, with production
parameters over whole tables, and their SQL twins where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    html_wrappers, kk_shards, lang_bitmask, lattice_lm, license_join, line_crf, norm_buckets, paren_trie, prefix_join, source_mix,
    suffix_decontam, threshold_sketch, toxic_grammar,
)
from marquee.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
ORACLES: dict[str, str] = {}


def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    r = html_wrappers.extract(table(spark, sf_dir, "pages"))
    return r.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


#: File of the public vocabulary whose pieces and scores span the lattice.
VOCABULARY = os.environ.get("MARQUEE_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")


def op2_lattice_lm(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Marginal log-probability of every document under the lattice learned
    from the training documents; ``vocabulary_score`` is that of the
    vocabulary's own scores."""
    r = lattice_lm.score(table(spark, sf_dir, "documents"), lattice_lm.read_vocabulary(vocabulary))
    return r.select(F.col("id").alias("doc_id"), F.coalesce(_held_out(7, 2), F.lit(False)).alias("held_out"),
                    "n_tokens", "n_known", "train_tokens", "base_score", F.col("learned_score").alias("score"), "fitted_score", F.col("score").alias("vocabulary_score"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    r = lang_bitmask.predict(docs, lang_bitmask.fit(docs))
    return r.select(F.col("id").alias("doc_id"), F.coalesce(_held_out(5, 0), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (five words, 0.8)."""
    r = prefix_join.jaccard_components(table(spark, sf_dir, "documents"))
    return r.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_rows")


def _held_out(mod: int, rest: int):
    return (F.crc32(F.col("id").cast("string")) % mod == rest)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    r = toxic_grammar.score(docs, toxic_grammar.fit(docs, table(spark, sf_dir, "labels")))
    return r.select(F.col("id").alias("doc_id"), F.coalesce(_held_out(5, 0), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every text, of its edited text and their likeness."""
    r = threshold_sketch.half_edits(table(spark, sf_dir, "documents"))
    same = threshold_sketch.likeness
    return r.select(F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    threshold_sketch.as_text(F.col("sketch")).alias("fingerprint"),
                    threshold_sketch.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                    same(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    same(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    r = license_join.scan(table(spark, sf_dir, "documents"))
    return r.select(F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
                    F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
                    F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


#: Target weights of the mix: domains, languages within them; sources within a
#: language share alike.
MIX_WEIGHTS = {("web",): 0.5, ("books",): 0.3, ("forums",): 0.2,
               **{(d, lang): w for d in ("web", "books", "forums") for lang, w in (("en", 0.5), ("de", 0.2), ("fr", 0.2), ("es", 0.1))}}


def with_domain(docs: DataFrame) -> DataFrame:
    """``docs`` with the domain of their source: the number in its name decides."""
    rest = F.coalesce(F.expr("try_cast(regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) as int)"), F.lit(0)) % 3
    return docs.withColumn("domain", F.when(rest == 0, "web").when(rest == 1, "books").otherwise("forums"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to MIX_WEIGHTS: eight tenths of all tokens, two epochs at most."""
    r = source_mix.mix(with_domain(table(spark, sf_dir, "documents")), ["domain", "lang", "source"], MIX_WEIGHTS, share=0.8, epochs=2)
    return r.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes, equal texts together."""
    r = kk_shards.shard_by_bytes(table(spark, sf_dir, "documents"), 8)
    return r.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a benchmark window."""
    r = suffix_decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return r.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from the labels of its lines."""
    docs = table(spark, sf_dir, "documents")
    r = line_crf.score(docs, line_crf.fit(docs, table(spark, sf_dir, "labels")))
    return r.select(F.col("id").alias("doc_id"), F.coalesce(_held_out(3, 1), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "good_share", "n_lines")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return paren_trie.trie(paren_trie.rebuild(table(spark, sf_dir, "conversations"), shared=8, group=5))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    r = norm_buckets.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
    return r.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


_BENCH_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

ORACLES["op10_decontaminate"] = rf"""
with d as (select row_number() over () as r, doc_id, {_BENCH_WORDS} as w from documents),
b as (select item_id, {_BENCH_WORDS} as w from benchmark),
win as (select distinct item_id, unnest(case when len(w) < 10 then [array_to_string(w, ' ')]
          else [array_to_string(w[i:i + 9], ' ') for i in range(1, len(w) - 8)] end) as g, least(len(w), 10) as n
        from b where len(w) > 0),
sizes as (select distinct n from win),
pos as (select r, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n),
gram as (select p.r, p.n, p.i, array_to_string(d.w[p.i:p.i + p.n - 1], ' ') as g from pos p join d using (r)),
hit as (select gram.r, gram.i, gram.n, win.item_id from gram join win using (g, n)),
words as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from hit) group by r),
ids as (select r, count(distinct item_id) as n_items, array_to_string(list_sort(list(distinct item_id::varchar)), ',') as s from hit group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join ids using (r)
"""

_SPACED_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES["op4_jaccard_join"] = rf"""
with recursive d as (select doc_id, {_SPACED_WORDS} as w from documents),
s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end) as g from d),
n as (select doc_id, count(*) as n from s group by doc_id),
keyed as (select doc_id, md5(string_agg(g, chr(10) order by g)) as k from s group by doc_id),
link as (select a.doc_id as x, b.doc_id as y from s a join s b using (g) join n p on p.doc_id = a.doc_id join n q on q.doc_id = b.doc_id
         where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, p.n, q.n
         having 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach as (select distinct x as doc_id, x as node from link
          union select reach.doc_id, link.y from reach join link on link.x = reach.node),
least_ as (select doc_id, min(node) as c from reach group by doc_id)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c, d.doc_id) as component_id,
       coalesce(r.rows, 1)::bigint as class_rows
from d left join n using (doc_id) left join least_ using (doc_id)
left join (select doc_id, count(*) over (partition by k) as rows from keyed) r using (doc_id)
"""


def _budget_level(name: str, source: str, path: str, above: str, weight: str) -> str:
    """One level of the budget tree: children of ``above`` share ``b``."""
    part = f"partition by {above}" if above else ""
    return f"""
{name}_n as (select {path}, sum(avail) * 2 as cap, any_value(b) as b from {source} group by {path}),
{name}_w as (select *, {weight} as w from {name}_n),
{name}_l as (select *, (b - coalesce(sum(cap) over ({part} order by cap / w, {path} rows between unbounded preceding and 1 preceding), 0))
   / sum(w) over ({part} order by cap / w, {path} rows between current row and unbounded following) as lev from {name}_w),
{name}_m as (select *, max(lev) over ({part}) as level from {name}_l),
{name} as (select leaf.*, greatest(0, least(m.cap, m.level * m.w)) as b from leaf join {name}_m m on {' and '.join(f'leaf.{c} is not distinct from m.{c}' for c in path.split(', '))})"""


def _case(weights: dict) -> str:
    return "case " + " ".join("when " + " and ".join(f"{c} = '{v}'" for c, v in zip(("domain", "lang"), k)) + f" then {w}::double" for k, w in weights.items()) + " else 1.0::double end"


ORACLES["op8_mix"] = rf"""
with d as (select doc_id, lang, source, case coalesce(try_cast(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) as integer), 0) % 3
    when 0 then 'web' when 1 then 'books' else 'forums' end as domain,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::bigint as n from documents),
leaf as (select domain, lang, source, sum(n)::double as avail from d group by all),
root as (select leaf.*, 0.8::double * (select sum(n)::double from d) as b from leaf),{
    _budget_level("l1", "root", "domain", "", _case({k: w for k, w in MIX_WEIGHTS.items() if len(k) == 1}))},{
    _budget_level("l2", "l1", "domain, lang", "domain", _case({k: w for k, w in MIX_WEIGHTS.items() if len(k) == 2}))},{
    _budget_level("l3", "l2", "domain, lang, source", "domain, lang", "1.0::double")},
plan as (select *, floor(round(b, 6)) as target, case when avail > 0 then least(floor(floor(round(b, 6)) / avail), 2) else 1 end::bigint as whole from l3),
rows as (select d.*, p.whole, p.target - p.whole * p.avail as rest,
    sum(d.n) over (partition by d.domain, d.lang, d.source order by md5('17:' || p.whole || ':' || coalesce(d.doc_id::varchar, 'null')) range between unbounded preceding and current row) as through
    from d join plan p on d.domain = p.domain and d.lang is not distinct from p.lang and d.source is not distinct from p.source)
select doc_id, domain, lang, source, n as n_tokens, unnest(range(whole + case when rest > 0 and through <= rest then 1 else 0 end)) as epoch from rows
"""


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _places(phrase: str) -> str:
    q = phrase.split()
    return "list_filter(range(len(w)), lambda i: " + " and ".join(f"coalesce(w[i + {j + 1}] = '{x}', false)" for j, x in enumerate(q)) + ")"


_T_SETS = [sorted(set(t.split())) for t in license_join.TEMPLATES]
_RELATIVES = ", ".join(f"({u}, {t})" for u, t in license_join.relatives(_T_SETS, 80))

ORACLES["op7_licenses"] = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text, {_BENCH_WORDS} as w from documents),
templates(n, t, tells, label, span) as (values {', '.join(f"({i}, {_sql_list(_T_SETS[i])}, {_sql_list(m.split())}, '{label}', {license_join.span(t, 80)})" for i, (t, (label, m)) in enumerate(license_join.TEMPLATES.items()))}),
relatives(u, v) as (values {_RELATIVES}),
lines as (select r, generate_subscripts(x, 1) as b, unnest(x) as text from (select r, string_split_regex(text, '\n|[.!?;]\s') as x from d)),
runs as (select r, generate_subscripts(x, 1) as b, unnest(x) as text from (select r, string_split_regex(text, '\n\s*\n|[.!?;]\s') as x from d)),
flat as (select r, 'line' || b as b, {_BENCH_WORDS} as w from lines),
cross_ as (select r, 'run' || b as b, {_BENCH_WORDS} as w from runs where contains(text, chr(10))),
whole as (select r, b, n, w, t, tells, label, span, len(list_intersect(list_distinct(w), t)) as shared from flat, templates
          where len(list_intersect(list_distinct(w), t)) * 100 >= 80 * len(t)
  union all select r, b, n, w, t, tells, label, span,
    list_max(list_transform(range(1, len(w) + 1), lambda k: len(list_intersect(list_distinct(w[greatest(k - span + 1, 1):k]), t)))) as shared
  from cross_, templates where len(list_intersect(list_distinct(w), t)) * 100 >= 80 * len(t)),
graded as (select *, shared / len(t) as part, len(list_intersect(list_distinct(w), list_distinct(tells))) = len(list_distinct(tells)) as told from whole where shared * 100 >= 80 * len(t)),
hit as (select * from graded g where not exists (select 1 from graded o join relatives on u = o.n and v = g.n
        where o.r = g.r and o.b = g.b and (o.part > g.part or (o.part = g.part and o.told and not g.told)))),
found as (select r, list(distinct label) as labels, max(part) as part from hit group by r),
base as (select *, {', '.join(f"{_places(p)} as p{i}" for i, p in enumerate(license_join.PHRASES))} from d),
named as (select *, {' || '.join(f"p{i}" for i in range(len(license_join.PHRASES)))} as places,
   list_filter([{', '.join(f"case when len(p{i}) > 0 then '{label}' end" for i, label in enumerate(license_join.PHRASES.values()))}], lambda x: x is not null) as base_labels from base)
select doc_id, len(w)::bigint as n_words, len(places)::bigint as n_base, list_min(places) as first_word, list_max(places) as last_word,
  array_to_string(list_sort(list_distinct(base_labels)), ',') as base_labels,
  array_to_string(list_sort(list_distinct(base_labels || coalesce(labels, []))), ',') as labels,
  case when len(base_labels) > 0 then 1.0 else coalesce(part, 0.0) end::double as score
from named left join found using (r)
"""


ORACLES["op13_search"] = rf"""
with d as (select row_number() over () as r, doc_id, {_BENCH_WORDS} as w from documents),
total as (select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as n_words from d),
tf as (select r, t, count(*) as f from (select r, unnest(w) as t from d) group by r, t),
terms as (select distinct item_id, unnest({_BENCH_WORDS}) as t from benchmark),
weight as (select t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint as wt
           from (select t, count(*) as df from tf where t in (select t from terms) group by t), total),
size as (select r, 100 - 50 + ((50 * len(w) * n_docs) // n_words) as m from d, total where len(w) > 0),
score as (select item_id, r, sum(wt * ((1000000000 * f) // (1000 * f + 20 * m)))::bigint as score
          from terms join weight using (t) join tf using (t) join size using (r) group by item_id, r),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls first) as rank, doc_id, score
           from score join d using (r) where score > 0)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 50
"""

#: CRC-32 of a decimal number, bit by bit (the reflected polynomial 0xEDB88320).
_CRC = ("xor(list_reduce([4294967295::bigint] || list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint), lambda a, x: "
        "list_reduce([xor(a, x)] || [1::bigint, 2, 3, 4, 5, 6, 7, 8], lambda p, i: case when p & 1 = 1 then xor(p >> 1, 3988292384::bigint) else p >> 1 end)), 4294967295::bigint)")

ORACLES["op12_prefix_trie"] = rf"""
with t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i,
             struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) as turn from conversations where conv_id is not null),
own as (select c, list(turn order by i) as turns from t group by c),
part as (select c, turns, {_CRC} % 9 as h from own),
full_ as (select a.c, coalesce(b.turns, [])[1:a.h] || a.turns[a.h + 1:] as path from part a left join own b on b.c = a.c - a.c % 5),
pre as (select c, unnest(range(len(path) + 1)) as d, path from full_),
node as (select d, path[1:d] as k, min(c) as conv_id, count(*) as n, list(c order by c) filter (len(path) = d) as ends,
           coalesce(strlen((path[1:d])[d].x), 0) as bytes from pre group by d, path[1:d]),
kids as (select d - 1 as d, k[1:d - 1] as k, count(*) as n_children from node where d > 0 group by all),
flat as (select node.*, coalesce(n_children, 0) as n_children from node left join kids using (d, k)),
up as (select a.d, a.k, sum((b.n - 1) * b.bytes) as saved, count(*) filter (b.n_children = 0) as leaves
       from (select *, unnest(range(d + 1)) as e from flat) b join flat a on a.d = b.e and a.k = b.k[1:b.e] group by a.d, a.k)
select flat.conv_id, flat.d as depth, p.conv_id as parent_conv_id, flat.n as n_convs, flat.n_children::bigint as n_children,
       up.leaves::bigint as n_leaves, up.saved::bigint as saved_tokens,
       sha256(coalesce(array_to_string(list_transform(flat.ends, lambda x: x::varchar), ','), '')) as ends_sha256
from flat join up using (d, k) left join flat p on p.d = flat.d - 1 and p.k = flat.k[1:flat.d - 1]
"""


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (op1_extract, op2_lattice_lm, op3_language_id, op4_jaccard_join, op5_toxicity, op6_sketch, op7_licenses, op8_mix, op9_shards, op10_decontaminate, op11_quality,
                                   op12_prefix_trie, op13_search)}


def oracle_sql() -> dict[str, str]:
    return {k: v.strip() for k, v in ORACLES.items()}
