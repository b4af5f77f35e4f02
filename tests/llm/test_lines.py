"""Line field, prefix trie and ranked search against brute force."""

import hashlib
import itertools
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import ODD_ROWS, alnum, empty_docs, held_out, odd_docs

from marquee.llm import line_crf, norm_buckets, paren_trie


# ---------------------------------------------------------------- line field
def brute_marginals(score, switch, ends):
    """Marginals and log normaliser of one chain, over all labelings."""
    n = len(score)
    p, z = np.zeros((n, 2)), 0.0
    for y in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(score[i][y[i]] for i in range(n)) + sum(switch[a][b] for a, b in zip(y, y[1:])) + ends[0][y[0]] + ends[1][y[-1]])
        z += w
        for i, a in enumerate(y):
            p[i, a] += w
    return p / z, math.log(z)


def test_marginals_are_sums_over_all_labelings():
    rng = np.random.RandomState(5)
    sizes = [1, 2, 7, 1, 9, 4]
    head = np.concatenate([[True] + [False] * (n - 1) for n in sizes])
    score, switch, ends = rng.normal(size=(len(head), 2)) * 3, rng.normal(size=(2, 2)), rng.normal(size=(2, 2))
    p, pair, z = line_crf.marginals(score, switch, ends, head)
    at = 0
    for i, n in enumerate(sizes):
        want, log = brute_marginals(score[at:at + n], switch, ends)
        assert np.allclose(p[at:at + n], want) and math.isclose(z[i], log)
        at += n
    assert math.isclose(pair.sum(), len(head) - len(sizes))
    # a chain of many lines stays in range
    long_, _, z = line_crf.marginals(np.tile([[300.0, -300.0]], (5_000, 1)), switch, ends, np.arange(5_000) == 0)
    assert np.isfinite(z).all() and np.allclose(long_[:, 0], 1)


def test_gradient_is_that_of_the_likelihood():
    """Training finds weights at which a small move does not help."""
    rng = np.random.RandomState(1)
    x = (rng.rand(60, 3) > 0.5).astype(float)
    head = np.arange(60) % 6 == 0
    y = (x[:, 0] > 0).astype(int)

    def loss(w):
        k = 6
        _, _, z = line_crf.marginals(x @ w[:k].reshape(3, 2), w[k:k + 4].reshape(2, 2), w[k + 4:].reshape(2, 2), head)
        tail = np.append(head[1:], True)
        s = (x @ w[:k].reshape(3, 2))[np.arange(60), y].sum() + sum(w[k + 2 * y[i] + y[i + 1]] for i in np.flatnonzero(~tail))
        return z.sum() - s - sum(w[k + 4 + a] for a in y[head]) - sum(w[k + 6 + a] for a in y[tail]) + w @ w / 2
    w = line_crf.train(x, head, y, rounds=200)
    best = loss(w)
    assert all(loss(w + d) >= best - 1e-3 for d in np.vstack([np.eye(14), -np.eye(14)]) * 0.05)


def test_line_measures():
    texts = ["HELLO World!!\nplain text here.\n\nplain text here.", None, "", "a | b | c", "x" * 40, " \n", "1234 5678"]
    value, length, owner = line_crf.lines(texts)
    at = {k: i for i, k in enumerate(line_crf.CUTS)}
    assert owner.tolist() == [0, 0, 0, 0, 1, 2, 3, 4, 5, 5, 6]
    assert value[0, at["upper"]] == 6 / 10 and value[0, at["mark"]] == 2 / 12 and value[0, at["double"]] == 1 / 12 and value[0, at["words"]] == 2
    assert value[[0, 1, 2, 3], at["repeated"]].tolist() == [0, 1, 0, 1] and value[2, at["blank"]] == 1 and length[0] == 13
    assert value[1, at["ended"]] == 1 and value[0, at["opened"]] == 1 and value[1, at["opened"]] == 0
    assert value[6, at["bar"]] == 2 / 5 and value[7, at["word"]] == 40 and value[10, at["digit"]] == 1
    x, _, o = line_crf.features(texts)
    assert o.tolist() == [0, 0, 0, 0, 3, 4, 5, 5, 6] and x.shape == (9, line_crf.SIZE)
    # the neighbours' features are the neighbours' own ones
    n, m = 1 + len(line_crf.NAMES), len(line_crf.NEAR_AT)
    own = x[:, 1:n][:, line_crf.NEAR_AT]
    assert (x[1, n + 1:n + 1 + m] == own[0]).all() and (x[1, n + 2 + m:] == own[2]).all() and not x[0, n:n + 1 + m].any() and not x[4, n:].any()


def _quality(spark, n=600, seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    good = lambda: " ".join(word() for _ in range(12)).capitalize() + "."
    bad = [lambda: " | ".join(word() for _ in range(12)), lambda: " ".join(word().upper() + "!!" for _ in range(12)), lambda: " ".join(word() + "$$$" for _ in range(12))]
    rows, labels = [], []
    for i in range(n):
        wrong = i % 3 == 0
        lines = [good() for _ in range(rng.randrange(1, 6))]
        if wrong:
            lines[len(lines) // 2:] = [rng.choice(bad)() for _ in range(rng.randrange(2, 6))]
        rows.append((i, "\n".join(lines), "en", "s", 0))
        labels.append((i, int(not wrong), 0))
    return spark.createDataFrame(rows, odd_docs(spark).schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((a, b) for a, b, _ in labels), rows


def test_quality_held_out(spark):
    docs, labels, truth, rows = _quality(spark)
    model = line_crf.fit(docs, labels)
    got = {r.id: r.score for r in line_crf.score(docs.repartition(5), model).collect()}
    kept = [i for i in truth if held_out(i, 3, 1)]
    assert len(kept) > 150 and sum((got[i] >= 0.5) == truth[i] for i in kept) >= 0.97 * len(kept)
    # a document's score from its lines' marginals, by brute force
    for i in (0, 1, 2, 3, 30):
        x, length, _ = line_crf.features([rows[i][1]])
        p, _ = brute_marginals(x @ model.emit, model.switch, model.ends)
        share = (p[:, 1] * length).sum() / length.sum()
        assert math.isclose(got[i], 1 / (1 + math.exp(-(model.logistic[0] + model.logistic[1] * share))), rel_tol=1e-6)
    # labels held out teach nothing
    other = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality")
    again = line_crf.fit(docs, other)
    assert np.array_equal(again.emit, model.emit) and again.logistic == model.logistic
    # the bound on rows holds; a good line next to bad ones is read with them
    assert line_crf.fit(docs, labels, fit_rows=50, fit_lines=100).emit.shape == model.emit.shape


@pytest.mark.parametrize("extra", [False, True])
def test_quality_odd_rows(spark, extra):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = line_crf.fit(odd_docs(spark, extra), none)
    got = line_crf.score(odd_docs(spark, extra).unionAll(odd_docs(spark, extra)), model).collect()
    assert len(got) == 2 * len(ODD_ROWS) and all(0 <= r.score <= 1 for r in got)
    by = defaultdict(set)
    for r in got:
        by[r.id].add((r.score, r.n_lines))
    assert all(len(v) == 1 for v in by.values()) and by[1] == by[2] == {(0.5, 0)}
    assert line_crf.score(empty_docs(spark), model).count() == 0
    one = line_crf.fit(odd_docs(spark), spark.createDataFrame([(i, 1) for i in range(1, 18)], "doc_id long, quality int"))
    assert one.prior == 1.0
    words = spark.createDataFrame([("a", "text"), (None, None)], "doc_id string, text string")
    assert sorted(r.id or "" for r in line_crf.score(words, model).collect()) == ["", "a"]


# ---------------------------------------------------------------- prefix trie
def test_findclose_and_ranks():
    rng = random.Random(3)
    for n in (1, 2, 5, 40, 500, 3_000):
        bits, depth = [], 0
        for i in range(2 * n):
            up = depth == 0 or (2 * n - i > depth and rng.random() < (0.9 if n == 3_000 and i < n else 0.5))
            bits.append(up)
            depth += 1 if up else -1
        stack, close, leaves = [], {}, 0
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        assert not stack
        p = paren_trie.Parens(np.array(bits))
        opens = np.flatnonzero(p.bits)
        assert p.findclose(opens).tolist() == [close[i] for i in opens]
        leaves = sum(1 for i in range(len(bits) - 1) if bits[i] and not bits[i + 1])
        assert p.leaf_rank[-1] == leaves


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda t: t[:3])] for c, v in turns.items()}
    full = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + mine[h:]
    nodes = defaultdict(list)
    for c, path in full.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    out = set()
    for key, members in nodes.items():
        below = [k for k in nodes if k[:len(key)] == key]
        kids = [k for k in below if len(k) == len(key) + 1]
        ends = sorted(c for c in members if len(full[c]) == len(key))
        out.add((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(kids),
                 sum(not any(len(j) > len(k) and j[:len(k)] == k for j in below) for k in below),
                 sum((len(nodes[k]) - 1) * len(k[-1][1].encode()) for k in below if k),
                 hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def conversations(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turns = [(i, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else ("user", "assistant")[i % 2], rng.choice(["hi", "é ü", "so", "a longer text"]))
                 for i in range(rng.randrange(0, 6))]
        rows += [(c, *t) for t in turns]
    copies = [(n + c, i, "user", f"turn {i}") for c in range(40) for i in range(12)]
    odd = [(n + 50, None, None, None), (n + 50, None, None, "x"), (n + 50, 0, "user", ""), (n + 50, 3, "user", "y"), (None, 1, "user", "z"), (-7, 1, "user", "hi"), (-5, 0, None, "neg")]
    deep = [(n + 60, i, "user", "t" + str(i % 3)) for i in range(30)]
    return rows + copies + odd + deep


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("shard_nodes", [1, 1_000, paren_trie.SHARD_NODES])
def test_trie_against_brute_force(spark, shard_nodes, monkeypatch):
    rows = conversations(150, 4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'clash' as path", "1 as base", "1 as t").repartition(6)
    got = [tuple(r[c] for c in COLUMNS) for r in paren_trie.trie(paren_trie.rebuild(df), shard_nodes).collect()]
    want = brute_trie(rows)
    assert len(got) == len(want) and set(got) == want


def test_trie_of_runs(spark, monkeypatch):
    """A path's members come from several runs, in order."""
    rows = [(c, 0, "user", "same") for c in range(100)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    paths = paren_trie.rebuild(df)
    whole = {tuple(r[c] for c in COLUMNS) for r in paren_trie.trie(paths).collect()}
    assert whole == brute_trie(rows)
    batches = [paths.orderBy("path", "conv_id").toArrow().combine_chunks().to_batches()[0]]
    monkeypatch.setattr(paren_trie, "RUN", 7)
    runs = list(paren_trie._runs(iter([b.select(["conv_id", "path", "bytes"]) for b in batches])))
    paths_ = [r for b in runs for r in b.to_pylist()]
    assert max(r["n"] for r in paths_) == 7
    table = [b.select(["path", "bytes", "first_id", "n", "ids"]) for b in runs]
    ends = {len(r["path"]) - 1: r["digest"][-1] for r in paren_trie._members(iter(table))}
    assert set(ends.values()) == {x[-1] for x in whole if x[-1] != paren_trie.NO_ENDS}


def test_trie_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert paren_trie.trie(paren_trie.rebuild(none)).count() == 0
    # an absent base and more shared turns than there are: the root alone
    c = next(c for c in range(6, 1_000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    one = spark.createDataFrame([(c, 0, "user", "x")], none.schema)
    assert [tuple(r[k] for k in COLUMNS) for r in paren_trie.trie(paren_trie.rebuild(one)).collect()] == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


# ---------------------------------------------------------------- ranked search
def brute_search(docs, items, k):
    words = [(i, alnum(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, n_words = len(words), sum(len(w) for _, w in words)
    df = defaultdict(int)
    for _, w in words:
        for t in set(w):
            df[t] += 1
    sets = defaultdict(set)
    for i, t in items:
        sets[i] |= set(alnum(t))
    out = []
    for item, terms in sets.items():
        scored = []
        for i, w in words:
            m = 50 + 50 * len(w) * n_docs // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * w.count(t) // (1000 * w.count(t) + 20 * m)) for t in terms if t in w)
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weight = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weight, k=rng.randrange(1, 60)))) for i in range(n)]
    docs += [(n + i, "w5 w17 w40 w41") for i in range(30)] + [(n + 100, " ".join(vocabulary * 3)), (n + 101, None), (n + 102, " .. "), (None, "w200 w201"), (3, docs[3][1])]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 25)))) for i in range(40)] + [(1, "w5 W17!"), (None, "w200, x"), (90, ""), (91, None), (92, "none here")]
    return docs, items


@pytest.mark.parametrize("sizes", [(64, 1 << 18, 16), (7, 50, 2), (1_024, 1 << 18, 1_000)])
def test_search_against_brute_force(spark, sizes, monkeypatch):
    docs, items = corpus(400, 8)
    rows, terms, few = sizes
    monkeypatch.setattr(norm_buckets, "BUCKET_ROWS", rows)
    monkeypatch.setattr(norm_buckets, "BUCKET_TERMS", terms)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as t", "1 as norm", "2 as item").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc")
    got = sorted((tuple(r) for r in norm_buckets.top_k(d, q, k=10).collect()), key=repr)
    assert got == brute_search(docs, items, 10)


def test_search_in_groups_and_with_text_ids(spark, monkeypatch):
    docs, items = corpus(120, 9)
    monkeypatch.setattr(norm_buckets, "GROUP_ITEMS", 7)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in norm_buckets.top_k(d, q, k=5).collect()), key=repr)
    assert got == brute_search(docs, items, 5)
    named = norm_buckets.top_k(d.selectExpr("concat('d', doc_id) as doc_id", "text"), q.selectExpr("concat('q-', item_id) as item_id", "text"), k=5).collect()
    texts = [(None if i is None else f"d{i}", t) for i, t in docs]
    want = [(f"q-{i}" if i is not None else None, t) for i, t in items]
    sort = lambda x: sorted(x, key=repr)
    assert sort((r.item, r.rank, r.score) for r in named) == sort((a, b, d_) for a, b, _, d_ in brute_search([(i if i is None else int(i[1:]), t) for i, t in texts], want, 5))


def test_walk_keeps_the_best_whatever_the_thresholds(monkeypatch):
    """Pruning by norms and coordinates loses nothing, few coordinates or many."""
    rng = np.random.RandomState(0)
    for few in (0, 3, 100):
        monkeypatch.setattr(norm_buckets, "FEW", few)
        sets = [np.unique(rng.randint(0, 60, rng.randint(1, 20))).astype(np.int64) for _ in range(25)]
        import pyarrow as pa
        items = norm_buckets.Items.of(pa.array(range(25)), sets)
        items.weighted(np.ones(len(items.vocabulary), np.int64))
        vectors = [(np.unique(rng.randint(0, len(items.vocabulary), rng.randint(1, 30))),) for _ in range(300)]
        vectors = [(t, rng.randint(1, 1_000, len(t)).astype(np.int64)) for t, in vectors]
        vectors.sort(key=lambda x: -float((x[1].astype(float) ** 2).sum()))
        walk = norm_buckets.Walk(items, 4, np.ones(25, np.int64))
        for i in range(0, 300, 32):
            part = vectors[i:i + 32]
            edge = np.concatenate([[0], np.cumsum([len(t) for t, _ in part])])
            norm = np.array([math.sqrt((v.astype(float) ** 2).sum()) for _, v in part])
            ids = np.arange(i, i + len(part))
            walk.bucket(ids, np.zeros(len(part), bool), norm, np.concatenate([t for t, _ in part]), np.concatenate([v for _, v in part]), edge)
        item, score, ids, _ = walk.best[0]
        for j, s in enumerate(sets):
            known = set(np.searchsorted(items.vocabulary, s).tolist())
            all_ = sorted((-sum(int(x) for t, x in zip(*v) if t in known), i) for i, v in enumerate(vectors))
            want = [(-a, i) for a, i in all_ if a < 0][:4]
            assert [(int(a), int(b)) for a, b in zip(score[item == j], ids[item == j])] == want


def test_search_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert norm_buckets.top_k(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b"), (2, None)], docs.schema)
    assert norm_buckets.top_k(some, items.limit(0)).count() == 0
    assert norm_buckets.top_k(some, items).columns == ["item", "rank", "doc", "score"]
