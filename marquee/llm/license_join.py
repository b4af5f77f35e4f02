"""License scans: exact set-similarity join of text blocks and templates.

Blocks are the sentences of a text's lines, and the windows of sentences
that cross line ends: at every place as many consecutive words as hold the
template's number of them at ``percent`` percent.  A template T is found in a block B if at least ``percent``
percent of T's distinct words are in B, whatever their order.

One join finds them all.  Words are put in one order, rare ones first by
their count in the corpus.  Such a block must hold one of the first
m - need + 1 of T's m words (prefix filter), have at least ``need`` distinct
words of the templates (length filter), and from the first shared word on
both sides must still have enough words left (positional filter).  What
passes is counted exactly.  A sentence that crosses line ends passes the
filters as a whole (its windows hold no other words); then each of its
windows that ends at a template word is counted, and the best one stands
for it.

Every block at the threshold is labelled.  Where templates that are
relatives meet in one block (one has ``percent`` percent of the other's
words, so that a block with the one has the other too), those with the
highest containment give their labels, of equal ones those whose telling
words are all there.

A base scan finds fixed phrases as consecutive words.

Everything is DataFrame expressions: no Python runs on the executors.

Cases: NULL and empty texts have no words, labels or places; repeated rows
are rows; a template that occurs in several blocks gives one label; ties of
word counts are broken by the word; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.store import Scratch

# Phrases of the base scan and wording of common license notices.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Wording of a notice: its label and the words that tell it from its relatives.
TEMPLATES = {
    "released under the mit license": ("mit", "mit"),
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": ("mit", "granted copy"),
    "licensed under the apache license version 2": ("apache-2", "apache 2"),
    "licensed under cc by nc": ("cc-by-nc", "cc nc"),
    "this work is licensed under the creative commons attribution noncommercial license": ("cc-by-nc", "commons noncommercial"),
    "this work is licensed under the creative commons attribution license": ("cc-by", "commons attribution"),
    "this work is licensed under the gnu general public license version 3": ("gpl-3", "gnu general 3"),
    "you can redistribute it and or modify it under the terms of the gnu general public license": ("gpl", "gnu general"),
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license": ("lgpl", "gnu lesser"),
    "you can redistribute it and or modify it under the terms of the gnu affero general public license": ("agpl", "gnu affero"),
    "redistribution and use in source and binary forms with or without modification are permitted": ("bsd", "redistribution binary"),
    "this source code form is subject to the terms of the mozilla public license": ("mpl-2", "mozilla"),
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": ("isc", "fee granted"),
    "this is free and unencumbered software released into the public domain": ("unlicense", "unencumbered"),
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"       # between words, before lower-casing


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of digits, letters and non-ASCII characters."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BREAK), lambda w: w != "")


def phrase_places(w: Column, phrase: str) -> Column:
    """Word positions (from 0) at which the phrase's words stand consecutively."""
    first, *rest = phrase.split()

    def here(i):
        ok = F.get(w, i) == first
        for j, x in enumerate(rest, 1):
            ok = ok & (F.get(w, i + j) == x)
        return F.coalesce(ok, F.lit(False))
    return F.filter(F.sequence(F.lit(0), F.size(w) - 1), here)


#: A line's sentences, and the sentences of paragraphs.
LINE, PARAGRAPH = r"\n|[.!?;]\s", r"\n\s*\n|[.!?;]\s"


def relatives(sets: list[list[str]], percent: int) -> list[tuple[int, int]]:
    """Pairs (u, t): a block that holds all of u meets t's threshold."""
    return [(u, t) for u in range(len(sets)) for t in range(len(sets))
            if u != t and 100 * len(set(sets[u]) & set(sets[t])) >= percent * len(sets[t])]


def span(template: str, percent: int) -> int:
    """Words of a template's window."""
    return -(-100 * len(template.split()) // percent)


def best_window(words: Column, template: Column, length: Column) -> Column:
    """Most distinct words of ``template`` within ``length`` consecutive words."""
    ends = F.filter(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_contains(template, F.element_at(words, k)))
    return F.coalesce(F.array_max(F.transform(ends, lambda k: F.size(F.array_intersect(
        F.slice(words, F.greatest(k - length + 1, F.lit(1)), F.least(length, k)), template)))), F.lit(0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES,
         templates: dict[str, tuple[str, str]] = TEMPLATES, percent: int = 80) -> DataFrame:
    """Rows (id, n_words, places array<long>, base_labels, labels, score):
    labels are sorted arrays; ``score`` is the highest containment of a
    template, 1 where a phrase stands."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "license")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = list(templates)
    sets = [sorted(set(t.split())) for t in names]
    universe = F.array(*[F.lit(w) for w in sorted({w for x in sets for w in x})])
    least = min(-(-(len(x) * percent) // 100) for x in sets)

    # one pass: words, phrase places, and the blocks that hold enough words of the templates
    one = F.col("w")
    found = [F.when(F.array_contains(one, F.lit(p.split()[-1])), phrase_places(one, p)).otherwise(F.array().cast("array<int>")) for p in phrases]
    enough = lambda b: F.size(F.array_intersect(b, universe)) >= least
    none = F.array().cast("array<string>")
    lines = F.transform(F.filter(F.transform(F.split("text", LINE), lambda b: F.array_intersect(words(b), universe)), lambda b: F.size(b) >= least),
                        lambda b: F.struct(b.alias("words"), none.alias("run")))
    crossing = F.transform(F.filter(F.transform(F.filter(F.split("text", PARAGRAPH), lambda b: F.contains(b, F.lit("\n"))), words), enough),
                           lambda w: F.struct(F.array_intersect(w, universe).alias("words"), w.alias("run")))
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), words(text).alias("w"), text.alias("text"))
            .select("row", "id", F.size(one).cast("long").alias("n_words"), F.array(*found).alias("found"),
                    F.when(enough(one), F.concat(lines, crossing)).alias("blocks")))
    rows = scratch.save(rows, "rows")

    # global order of the templates' words, rare first: a bounded number of rows
    block = rows.select("row", F.posexplode("blocks").alias("block", "b")).select("row", "block", "b.words", "b.run")
    often = {r.word: r.n for r in block.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    rank = {w: i for i, w in enumerate(sorted({w for x in sets for w in x}, key=lambda w: (often.get(w, 0), w)))}
    prefix, whole = [], []
    for i, t in enumerate(names):
        x = sorted(sets[i], key=rank.get)
        m = len(x)
        need = -(-(m * percent) // 100)
        prefix += [(x[p], i, p, m, need) for p in range(m - need + 1)]
        label, tells = templates[t]
        whole.append((i, x, tells.split(), label, span(t, percent)))
    # fixed templates: a few dozen rows
    heads = F.array(*[F.lit(w) for w in sorted({w for w, *_ in prefix})])
    prefix = F.broadcast(spark.createDataFrame(prefix, "word string, t int, p int, m int, need int"))
    whole = F.broadcast(spark.createDataFrame(whole, "t int, template array<string>, tells array<string>, label string, length int"))

    order = F.create_map(*[x for w, i in rank.items() for x in (F.lit(w), F.lit(i))])
    sorted_words = F.transform(F.array_sort(F.transform("words", lambda w: F.struct(F.element_at(order, w).alias("r"), w.alias("w")))), lambda x: x["w"])
    entry = block.where(F.arrays_overlap("words", heads)).withColumn("words", sorted_words)
    candidates = (entry.select("row", "block", "words", "run", F.posexplode("words").alias("q", "word")).join(prefix, "word")
                  .where(F.size("words") >= F.col("need"))                                               # length
                  .where(F.least(F.col("m") - F.col("p"), F.size("words") - F.col("q")) >= F.col("need"))     # position
                  .groupBy("row", "block", "t").agg(F.any_value("words").alias("words"), F.any_value("run").alias("run"), F.any_value("m").alias("m"), F.any_value("need").alias("need")))
    held = F.size(F.array_intersect("words", "template"))
    shared = F.when(F.size("run") == 0, held).when(held >= F.col("need"), best_window(F.col("run"), F.col("template"), F.col("length"))).otherwise(0)
    hits = candidates.join(whole, "t").withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    # of relatives in one block the best
    pairs = F.array(*[F.lit(u * len(names) + t) for u, t in relatives(sets, percent)]).cast("array<int>")
    grade = F.struct((F.col("shared") / F.col("m")).alias("part"), (F.size(F.array_except("tells", "words")) == 0).cast("int").alias("told"))
    per = hits.select("row", "block", F.struct("t", "label", grade.alias("grade")).alias("h")).groupBy("row", "block").agg(F.collect_list("h").alias("h"))
    best = F.filter("h", lambda x: ~F.exists("h", lambda y: F.array_contains(pairs, y["t"] * len(names) + x["t"]) & (y["grade"] > x["grade"])))
    hits = (per.select("row", F.explode(best).alias("h")).groupBy("row")
            .agg(F.collect_set("h.label").alias("method"), F.max("h.grade.part").alias("best")))

    names = list(phrases.values())
    base = F.filter(F.array(*[F.when(F.size(F.col("found")[i]) > 0, F.lit(n)) for i, n in enumerate(names)]), lambda x: x.isNotNull())
    places = F.flatten("found")
    out = rows.select("row", "id", "n_words", places.alias("places"), F.array_sort(F.array_distinct(base)).alias("base_labels")).join(hits, "row", "left")
    none = F.array().cast("array<string>")
    return out.select("id", "n_words", F.transform("places", lambda p: p.cast("long")).alias("places"), "base_labels",
                      F.array_sort(F.array_union("base_labels", F.coalesce("method", none))).alias("labels"),
                      F.when(F.size("base_labels") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
