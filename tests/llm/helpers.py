"""Brute-force twins and awkward rows shared by the operator tests."""

import re
import zlib

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def held_out(doc_id, mod, rest):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % mod == rest


def shingle_set(text, k=5):
    w = spaced(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard_classes(texts):
    """Smallest reachable id by links of Jaccard >= 0.8, by brute force."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y:
                shared = len(x & y)
                if 100 * shared >= 80 * (len(x) + len(y) - shared):
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
BASE = " ".join(f"alpha{i} beta{i}" for i in range(40))
ODD_ROWS = [
    (1, None, None, None, None), (2, "", "en", "src0", 0), (3, " \t\n ", "en", "src0", 4), (4, "One", "en", "src1", 3),
    (5, "ONE", "de", None, 3), (6, "two words", None, "src1", 9), (7, BASE, "en", "src0", len(BASE)), (8, BASE, "en", "src0", len(BASE)),
    (9, BASE + " tail", "en", "src2", 0), (10, BASE.replace("beta20", "x"), "en", "src0", 0), (11, LONG, "en", "src0", len(LONG)),
    (12, LONG + " more", "en", "src3", 0), (13, "é ü ñ 漢字   \U0001F600 Ünïcode", "fr", "srcx", 0), (14, "a" * 20_000, "en", "src0", 0),
    (15, "... !!! ???", "en", "src0", 0), (16, "one two three four five", "en", "src9", 0), (17, "one two three four five", "en", "src9", 0),
]


def odd_docs(spark, extra=False):
    df = spark.createDataFrame(ODD_ROWS, DOC_SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        # names that the operators use inside, in all their spellings
        clash = ("_id", "_least", "_rows", "_part", "_bucket", "_before", "_placed", "_whole", "_cut", "_l0", "l0", "l1", "l0_of", "_n", "_partial",
                 "doc", "known", "worded", "least", "bucket", "before", "readings", "epoch_", "rest", "keyed", "words", "order", "y", "norm", "t", "v",
                 "path", "bytes", "base", "up", "held", "n_lines", "good_share", "item", "rank", "id", "row", "size", "shard", "slot", "n_tokens", "epoch", "component_id", "score", "token", "word", "block", "key", "range", "labels", "part", "whole", "cut", "avail", "a", "b", "x", "n", "last", "rows")
        df = df.withColumns({c: F.lit("clash") for c in clash})
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
