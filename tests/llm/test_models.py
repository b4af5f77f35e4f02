"""Language model, language identification and toxicity."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD_ROWS, empty_docs, held_out, odd_docs, spaced

from marquee.llm import lang_bitmask, lattice_lm, toxic_grammar

VOCABULARY = [("▁", -3.0), ("o", -4.0), ("ne", -1.0), ("▁one", -2.0), ("n", -5.0), ("e", -6.0), ("tw", -7.0), ("▁t", -0.5), ("▁▁", -9.0), ("é", -8.0)]


def lattice_brute(word, pieces, logp):
    """Probability of a word by plain recursion over its bytes."""
    b = b" " + word
    alpha = [1.0] + [0.0] * len(b)
    for j in range(1, len(b) + 1):
        alpha[j] = alpha[j - 1] * math.exp(logp[b[j - 1]])
        for piece, i in pieces.items():
            if j >= len(piece) and b[j - len(piece):j] == piece:
                alpha[j] += alpha[j - len(piece)] * math.exp(logp[i])
    return math.log(alpha[-1])


def lattice_brute_log(word, pieces, logp):
    """The same in log space, for words whose probability is no double."""
    b = b" " + word
    alpha = [0.0] + [-math.inf] * len(b)
    for j in range(1, len(b) + 1):
        ways = [alpha[j - 1] + logp[b[j - 1]]] + [alpha[j - len(p)] + logp[i] for p, i in pieces.items() if j >= len(p) and b[j - len(p):j] == p]
        top = max(ways)
        alpha[j] = top + math.log(sum(math.exp(w - top) for w in ways))
    return alpha[-1]


def vocabulary_index(vocabulary):
    usable = sorted({(p.replace("▁", " ").encode(), s) for p, s in vocabulary if p and "▁" not in p[1:]}, key=lambda x: (-x[1], x[0]))
    return {p: 256 + i for i, (p, _) in enumerate(usable)}


def test_forward_is_the_sum_over_segmentations():
    pieces = lattice_lm.Pieces.of(VOCABULARY)
    index = vocabulary_index(VOCABULARY)
    words = [b"one", b"two", b"onene", b"x", "é".encode(), b"none" * 5]
    got = np.zeros(len(words))
    for rows, m in lattice_lm._by_length(pa.array(words, pa.binary())):
        got[rows] = pieces.forward(m)[:, -1]
    assert np.allclose(got, [lattice_brute(w, index, pieces.logp) for w in words])
    assert math.isclose(np.exp(pieces.logp).sum(), 1.0)


def test_expected_counts_cover_every_byte():
    pieces = lattice_lm.Pieces.of(VOCABULARY)
    length = np.ones(pieces.size)
    for p, i in vocabulary_index(VOCABULARY).items():
        length[i] = len(p)
    words = [b"one", b"two", b"none"]
    total = sum(pieces.expected(m, np.full(len(rows), 2)) for rows, m in lattice_lm._by_length(pa.array(words, pa.binary())))
    assert math.isclose((total * length).sum(), 2 * sum(len(w) + 1 for w in words))


@pytest.mark.parametrize("extra", [False, True])
def test_lattice_scores_and_base(spark, extra):
    rows = lattice_lm.score(odd_docs(spark, extra), VOCABULARY).collect()
    got = {r.id: r for r in rows}
    tokens = {i: spaced(t) + [None] for i, t, *_ in ODD_ROWS}
    count = Counter(w for i, ws in tokens.items() if not held_out(i, 7, 2) for w in ws)
    total, types = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = got[i]
        base = sum(math.log10((count[w] + 1) / (total + types + 1)) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0 and math.isfinite(r.score)
    # the whole score of every text, by plain recursion over its words
    pieces, index, seen = lattice_lm.Pieces.of(VOCABULARY), vocabulary_index(VOCABULARY), {}
    for i, ws in tokens.items():
        want = pieces.logp[-1]
        for w in ws[:-1]:
            if w not in seen:
                seen[w] = lattice_brute_log(w.encode(), index, pieces.logp)
            want += seen[w]
        assert math.isclose(got[i].score, want / math.log(10), rel_tol=1e-9), i
        assert math.isfinite(got[i].fitted_score) and got[i].fitted_score < 0
    assert got[1].score == got[2].score == got[3].score and got[4].score == got[5].score and got[7].score == got[8].score


def test_lattice_learns_words(spark):
    """Held-out scores keep up with the counts of known words, and the
    learned probabilities of all tokens are those of the formula."""
    ids = range(1, 400)
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 23}" for j in range(40)) + (" new" if i % 5 == 0 else "")) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r for r in lattice_lm.score(docs, VOCABULARY).collect()}
    held = [i for i in ids if held_out(i, 7, 2)]
    known = [i for i in held if got[i].n_known == got[i].n_tokens]
    assert known and all(math.isfinite(got[i].learned_score) for i in held)
    assert sum(got[i].learned_score for i in known) > 1.01 * sum(got[i].base_score for i in known)
    assert sum(got[i].score for i in known) < 2 * sum(got[i].base_score for i in known)
    # without training rows the pieces alone decide
    alone = lattice_lm.score(docs.where("crc32(cast(doc_id as string)) % 7 = 2"), VOCABULARY).collect()
    assert len(alone) == len(held) and all(math.isfinite(r.learned_score) and r.learned_score < 0 for r in alone)


def test_lattice_pieces_are_a_distribution():
    """Words of all lengths and the end: their probabilities sum to one."""
    p = lattice_lm.Pieces.of(VOCABULARY)
    q_start, q_end = np.exp(p.logp[p.starts]).sum(), np.exp(p.logp[-1])
    # a word starts with a blank edge (four of them) and goes on until the next blank or the end
    words = q_start / (q_start + q_end)
    assert math.isclose(words + p.end_share(), 1.0) and p.starts.sum() == 4
    seen, total, types, d = np.array([3, 1, 0]), 5, 3, 0.6
    spelt = np.log(np.array([0.2, 0.1, 0.3]))
    want = np.log((np.maximum(seen - d, 0) + d * types * np.exp(spelt)) / total)
    assert np.allclose(lattice_lm._learned(seen, spelt, total, types, d), want)


def test_weights_are_the_scores_of_the_file():
    """Log-probabilities are taken as they are, merge orders as places."""
    own = lattice_lm.Pieces.of(VOCABULARY)
    index = vocabulary_index(VOCABULARY)
    a, b = index[b"ne"], index[b" one"]
    assert math.isclose(own.logp[a] - own.logp[b], 1.0)
    merged = lattice_lm.Pieces.of([(f"{x}{y}", -float(i)) for i, (x, y) in enumerate((x, y) for x in "abcdefghijklmnopqrst" for y in "abcdefghijklmnopqrst")])
    assert math.isclose(merged.logp[256] - merged.logp[256 + 90], math.log(10))


def test_lattice_empty(spark):
    assert lattice_lm.score(empty_docs(spark), VOCABULARY).count() == 0


def test_language_filter(spark):
    rng = np.random.RandomState(1)
    syllables = {"en": "the er on ing tion".split(), "de": "sch ung ich ei ver".split(), "xx": "ąę łó źć rzy szy".split()}
    rows = [(i, " ".join("".join(rng.choice(syllables[lang], 3)) for _ in range(30)), lang, "s", 0) for i, lang in enumerate(["en", "de", "xx"] * 40)]
    df = spark.createDataFrame(rows + [(900 + r[0], r[1], None, None, None) for r in ODD_ROWS if r[0] in (1, 2, 3, 14, 15)], odd_docs(spark).schema)
    model = lang_bitmask.fit(df)
    got = {r.id: r for r in lang_bitmask.predict(df, model).collect()}
    assert len(got) == len(rows) + 5 and model.langs == ["de", "en", "xx"]
    assert all(got[i].lang_pred == lang for i, _, lang, *_ in rows)
    assert all(got[900 + i].lang_pred == "und" and got[900 + i].score == 0 for i in (1, 2, 3, 15))
    assert all(0 <= r.score <= 1 for r in got.values())
    # probes return all languages that hold an n-gram, as sets do
    none = lang_bitmask.fit(empty_docs(spark))
    assert {r.lang_pred for r in lang_bitmask.predict(df, none).collect()} == {"und"}
    assert lang_bitmask.predict(empty_docs(spark), model).count() == 0


def test_language_filter_holds_every_gram():
    """No false negatives; false positives at the rate that is corrected for."""
    grams = np.random.RandomState(2).randint(0, 1 << 62, 20_000).astype(np.uint64) * np.uint64(3)
    mask = np.zeros(1 << lang_bitmask.SLOT_BITS, np.uint64)
    for at in lang_bitmask._slots(grams[:10_000]):
        mask[at] |= np.uint64(1)
    f = lang_bitmask.Filter(["a"], [mask])
    first, second = lang_bitmask._slots(grams)
    hit = (mask[first] & mask[second]) > 0
    assert hit[:10_000].all()
    assert abs(hit[10_000:].mean() - f.false[0]) < 0.002


def test_language_filter_grows_with_the_ngrams(spark):
    """A language of several million n-grams does not draw texts of another one."""
    rng = np.random.RandomState(5)
    common = "the and of to in is that for it was on with".split()
    many = [(i, "".join(map(chr, rng.randint(0x4E00, 0x9FA0, 4_000))), "zh", "s", 0) for i in range(750)]
    few = [(1_000 + i, " ".join(rng.choice(common, 30)) + f" {chr(97 + i % 26)}q{chr(97 + i // 26)}x", "en", "s", 0) for i in range(200)]
    model = lang_bitmask.fit(spark.createDataFrame(many + few, odd_docs(spark).schema).repartition(8))
    assert model.langs == ["en", "zh"] and model.bits > lang_bitmask.SLOT_BITS and model.false.max() < 0.3
    held = [r for r in few if held_out(r[0], 5, 0)]
    assert model.predict([r[1] for r in held])[0] == ["en"] * len(held)
    learned = [r[1] for r in many if not held_out(r[0], 5, 0)][:20]
    names, scores = model.predict(learned)
    assert names == ["zh"] * len(learned) and min(scores) > 0.99


def labelled(spark):
    rng = np.random.RandomState(4)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("ban", "dol", "fim", "gur", "hep")]
    rows, labels = [], []
    for i in range(600):
        text = list(rng.choice(words, 40))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randint(40), rng.choice(["zorgbut", "vexmir" + rng.choice(words)]))
        rows.append((i, " ".join(text) + ".", "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(rows, odd_docs(spark).schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels)


def test_toxicity_held_out(spark):
    docs, labels, rows, truth = labelled(spark)
    model = toxic_grammar.fit(docs, labels)
    odd = odd_docs(spark)
    got = {r.id: r.score for r in toxic_grammar.score(docs.unionByName(odd.withColumn("doc_id", odd.doc_id + 10_000)), model).collect()}
    assert len(got) == len(rows) + len(ODD_ROWS) and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in truth if held_out(i, 5, 0))
    assert got[10_001] == got[10_002] == got[10_003] < 0.5
    kept = toxic_grammar.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5 and i < 10_000}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "You are a stupid idiot, you pathetic moron!"), (2, "A fine day."), (3, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nulls = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, nulls):
        got = {r.id: r.score for r in toxic_grammar.score(docs, toxic_grammar.fit(docs, labels)).collect()}
        assert got[1] > got[2] == got[3] < 0.5
    assert toxic_grammar.score(docs.limit(0), toxic_grammar.fit(docs.limit(0), none)).count() == 0


def test_grammar_readings():
    machine = toxic_grammar.grammar()
    lexicon = toxic_grammar.Lexicon({"idiot$": 2.0, "vex": 1.5})
    read = lambda t: [r for r, _ in toxic_grammar.readings(t, lexicon, machine)[0]]
    assert read("an idiot") == ["plain"]
    assert read("you idiot") == ["targeted"]
    assert read("you are not an idiot") == ["negated"]
    assert read("he said idiot") == ["reported"]
    assert read("you said. idiot") == ["plain"]          # scopes end with the clause
    assert read("vexing day") == ["plain"] and read("convex idiots") == []
    assert read("i will kill you") == ["threat"]
    assert toxic_grammar.features(None, lexicon, machine) == [0.0] * len(toxic_grammar.FEATURES)


def test_clauses_are_scored_by_their_readings(spark):
    """After learning, the same words count by how they are meant."""
    docs, labels, _, _ = labelled(spark)
    model = toxic_grammar.fit(docs, labels)
    assert set(model.terms) == {"zorgbut$", "vexmir"} or {"zorgbut$"} <= set(model.terms) and all(t.startswith("vexm") or t == "zorgbut$" for t in model.terms)
    grade = lambda *t: model.scorer()(pa.array(list(t)))
    plain, targeted, negated, reported, threat = grade("zorgbut", "you zorgbut", "you are not a zorgbut", "he said zorgbut", "i will kill you")
    assert min(plain, targeted, threat) >= 0.5 > max(negated, reported) and targeted > plain
    # the same words in another order are read another way
    meant, turned = grade("a zorgbut is not kaban lodol", "kaban lodol is not a zorgbut")
    assert meant >= 0.5 > turned
    # what labels never show keeps its fixed weight
    w = dict(zip(("intercept", *toxic_grammar.FEATURES), model.weights))
    fixed = dict(zip(("intercept", *toxic_grammar.FEATURES), toxic_grammar.DEFAULT))
    assert all(math.isclose(w[r], fixed[r], abs_tol=1e-6) for r in w if "negated" in r or "reported" in r or "threat" in r)


def brute_readings(text, insults):
    """Readings of a text's clauses from the positions of its words alone."""
    out = []
    for part in re.split(r"[.!?;:\n|]", text.lower()):
        w = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)?", part)
        kinds = ["I" if x in insults else next((k for k, s in (("H", toxic_grammar.THREATS), ("R", toxic_grammar.REPORTS), ("N", toxic_grammar.NEGATIONS), ("T", toxic_grammar.TARGETS)) if x in s.split()), "O") for x in w]
        best = []
        for i, k in enumerate(kinds):
            if k not in "IH":
                continue
            near = {s: s in kinds[max(0, i - n):i] for s, n in toxic_grammar.SCOPE.items()}
            way = "negated" if near["N"] else "reported" if near["R"] else "targeted" if near["T"] or (k == "H" and "T" in kinds[i:i + 1 + toxic_grammar.SCOPE["T"]]) else "plain"
            kind = "threat" if k == "H" else "strong" if insults[w[i]] >= toxic_grammar.STRONG else "weak"
            best.append(f"{kind} {way}")
        if best:
            out.append(max(best, key=toxic_grammar.VALUE.get))
    return out


def test_features_against_brute_force():
    insults = {"idiot": 3.0, "meh": 1.6}
    lexicon, machine = toxic_grammar.Lexicon({f"{k}$": v for k, v in insults.items()}), toxic_grammar.grammar()
    rng = np.random.RandomState(9)
    pool = ["idiot", "meh", "you", "not", "said", "kill", "day", "sun", "a", "they", "never", ".", ";", "\n"]
    for _ in range(300):
        text = " ".join(rng.choice(pool, rng.randint(0, 30)))
        got = dict(zip(toxic_grammar.FEATURES, toxic_grammar.features(text, lexicon, machine)))
        want = brute_readings(text, insults)
        assert all(math.isclose(got[r], math.log1p(want.count(r))) for r in toxic_grammar.VALUE), text
        assert got["top"] == max((toxic_grammar.VALUE[r] for r in want), default=0.0)


def test_specific_terms():
    found = {"idi": (5.0, 100), "idiot$": (5.0, 98), "low": (4.0, 50), "lowei": (4.0, 50), "loweis": (4.0, 20)}
    assert toxic_grammar._specific(found) == {"idiot$": 5.0, "lowei": 4.0}


def test_crc_agrees(spark):
    from pyspark.sql import functions as F
    r = spark.range(50).select("id", (F.crc32(F.col("id").cast("string")) % 5).alias("m")).collect()
    assert all(x.m == zlib.crc32(str(x.id).encode()) % 5 for x in r)
