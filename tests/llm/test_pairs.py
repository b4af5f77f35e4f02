"""N-gram Jaccard join and decontamination against brute force."""

from collections import defaultdict
import random

import numpy as np
import pytest
from helpers import BASE, ODD_ROWS, alnum, empty_docs, jaccard_classes, odd_docs, shingle_set

from marquee.llm import prefix_join, suffix_decontam

ITEMS = [(1, " ".join(f"alpha{i} beta{i}" for i in range(5, 15))), (2, "two, words"), (3, None), (4, ""), (5, "..."), (None, "漢字"),
         (6, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x0 w14x1 w15x2"), (6, "one TWO three")]


@pytest.mark.parametrize("extra", [False, True])
def test_jaccard_odd_rows(spark, extra):
    got = {r.id: r for r in prefix_join.jaccard_components(odd_docs(spark, extra)).collect()}
    texts = {r[0]: r[1] for r in ODD_ROWS}
    want = jaccard_classes(texts)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingle_set(t)) for i, t in texts.items()}
    assert got[7].class_rows == 2 and got[1].class_rows == 1


def test_jaccard_empty_and_repeated(spark):
    assert prefix_join.jaccard_components(empty_docs(spark)).count() == 0
    twice = odd_docs(spark).unionByName(odd_docs(spark))
    got = prefix_join.jaccard_components(twice).collect()
    want = jaccard_classes({r[0]: r[1] for r in ODD_ROWS})
    assert len(got) == 2 * len(ODD_ROWS) and all(r.component_id == want[r.id] for r in got)
    kept = prefix_join.keep_one(twice)
    assert kept.columns == twice.columns
    ids = sorted(r.doc_id for r in kept.collect())
    no_words = [i for i, t, *_ in ODD_ROWS if not shingle_set(t)]
    assert ids == sorted([i for i, c in want.items() if i == c and i not in no_words] + 2 * no_words)


def test_jaccard_chains_and_hot_group(spark):
    """A chain of near copies, each near to the next only, and many copies around one text."""
    rng = np.random.RandomState(3)
    words = [f"v{i}" for i in range(5000)]
    rows, text = [], list(rng.choice(words, 120))
    for i in range(40):                      # drifts a few words at a time
        rows.append((100 + i, " ".join(text)))
        text[(i * 3) % 120] = f"new{i}"
    hot = list(rng.choice(words, 150))
    for i in range(200):
        t = list(hot)
        t[rng.randint(150)] = f"edit{i}"
        rows.append((1000 + i, " ".join(t)))
    rows += [(5000 + i, " ".join(rng.choice(words, 60)) + " " + " ".join(hot[:30])) for i in range(40)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.id: r.component_id for r in prefix_join.jaccard_components(df.repartition(7)).collect()}
    assert got == jaccard_classes(dict(rows))


def test_levels_need_no_luck():
    """Every level choice keeps the join exact: more shared shingles are asked only within longer prefixes."""
    assert prefix_join.choose_levels(np.zeros(50, int), 11, 4, 8.0) == 1
    assert prefix_join.choose_levels(np.full(50, 1000), 11, 4, 8.0) == 4
    assert prefix_join.choose_levels(np.array([7]), 1, 4, 8.0) == 1
    assert [prefix_join.need(n, 80) for n in (1, 4, 5, 6, 10, 11)] == [1, 4, 4, 5, 8, 9]


def brute_hits(text, items, window=10):
    w = alnum(text)
    hit, ids = set(), set()
    for item, t in items:
        v = alnum(t)
        n = min(window, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1 if v else 0):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                if item is not None:
                    ids.add(item)
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block_words", [4_000_000, 20])
def test_decontamination_odd_rows(spark, block_words, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.id: r for r in suffix_decontam.matches(odd_docs(spark, True), items, block_words=block_words).collect()}
    for i, t, *_ in ODD_ROWS:
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute_hits(t, ITEMS), i
    clean = suffix_decontam.decontaminate(odd_docs(spark, True), items, block_words=block_words)
    assert clean.columns == odd_docs(spark, True).columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, t, *_ in ODD_ROWS if not brute_hits(t, ITEMS)[1])


def test_decontamination_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert suffix_decontam.matches(empty_docs(spark), items).count() == 0
    got = suffix_decontam.matches(odd_docs(spark), none).collect()
    assert len(got) == len(ODD_ROWS) and all(r.n_hit == 0 and r["items"] == [] for r in got)


def test_suffix_array_shards(monkeypatch):
    """Small shards: windows over shard borders are found, matches are the longest."""
    rng = np.random.RandomState(5)
    h = rng.randint(1, 6, 4000).astype(np.uint64)
    array = suffix_decontam.SuffixArray(h, 64)
    seq = [tuple(h[i:i + 64]) for i in array.order]
    assert seq == sorted(seq)
    monkeypatch.setattr(suffix_decontam, "SHARD_WORDS", 64)
    text = h[:500]
    s = suffix_decontam.Suffixes(h[100:130].copy(), np.array([0, 30]), np.array([7]), 10)
    seen = set()
    for at, shard, _ in suffix_decontam._shards(text, np.array([0, 500]), min(s.depth, 32)):
        which, place, _, _ = s.search(shard)
        seen |= {(int(w), int(p) + at) for w, p in zip(which, place)}
    want = {(j, i) for j in range(21) for i in range(491) if (text[i:i + 10] == h[100 + j:110 + j]).all()}
    assert seen == want


def test_keep_one_keeps_clean(spark):
    df = spark.createDataFrame([(1, BASE), (2, BASE), (3, "quite another text of some words")], "doc_id long, text string")
    assert sorted(r.doc_id for r in prefix_join.keep_one(df).collect()) == [1, 3]


def test_decontamination_with_text_ids_and_many_blocks(spark):
    """Ids of any type; every block count gives the same result."""
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(5_000)}"
    items = [(f"q-{i}", " ".join(word() for _ in range(rng.randrange(1, 40)))) for i in range(60)] + [(None, "lone words here"), ("q-3", "again w1 w2")]
    docs = []
    for i in range(120):
        lead, tail = (" ".join(word() for _ in range(15)) for _ in "ab")
        docs.append((f"d{i}", f"{lead} {items[i % 62][1] if i % 3 == 0 else ''} {tail}"))
    d = spark.createDataFrame(docs, "doc_id string, text string").repartition(4)
    q = spark.createDataFrame(items, "item_id string, text string")
    plain = None
    for words in (10 ** 6, 200, 40):
        got = sorted((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in suffix_decontam.matches(d, q, block_words=words).collect())
        assert plain is None or got == plain
        plain = got
        clean = suffix_decontam.decontaminate(d, q, block_words=words)
        assert {r.doc_id for r in clean.collect()} == {i for i, _, n, _ in got if not n} and clean.columns == d.columns
    windows = defaultdict(set)
    for i, t in items:
        w = alnum(t)
        for k in range(max(1, len(w) - 9)):
            windows[tuple(w[k:k + 10])].add(i)
    for i, text in docs:
        w, hit, ids = alnum(text), set(), set()
        for g, owners in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    ids |= owners - {None}
        assert dict((r[0], r[1:]) for r in plain)[i] == (len(w), len(hit), tuple(sorted(ids)))
