"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set holds its distinct k-word shingles.  All sets are sorted
by one global order, rare shingles first.  If two sets of sizes n and m
have Jaccard similarity t or more, then for every l they share at least l
shingles within their prefixes of n - ceil(t*n) + l and m - ceil(t*m) + l
shingles.  Each document picks its own l: a longer prefix costs more rows
in the join, but demands l shared shingles and so leaves fewer candidates
to verify.  A pair is held against the smaller l of its two documents.

Steps (all documents, whole texts):

1. one pass gives each document's set size and 128-bit set key, and an
   estimate of how common shingles are (a table of fixed size);
2. documents with equal sets form a class; only classes are joined;
3. a second pass writes the prefixes; shingles seen in one class only are
   dropped by one aggregation.  They also bound the overlap: a class whose
   prefix holds many of them cannot be near to a class of a like size;
4. each class is held against the class of least such shingles in the
   lists that they share most, and verified; the links give provisional
   components, so a large group of copies costs a row a copy, not a pair;
5. all pairs of classes in different components are met at the first
   shingle that both hold, where its places (what stands before is not
   shared), the sizes and the unshared shingles leave room for the
   threshold, and their prefixes are compared.  At most (shared prefix shingles) +
   (the rest behind the prefix that ends first) shingles can be shared, which demands
   l of them at least, more of unequal sizes; pairs that meet this are
   verified, which makes the components exact.

Cases: NULL and empty texts and texts without words have empty sets and
are linked with nothing; fewer than k words give one shingle, the whole
sequence; repeated rows and equal texts fall into one class; an empty
table gives an empty result; further columns are ignored.  Repeated
doc_ids are joined as one document each row, under the same id; a NULL
doc_id is its own component unless linked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import words as W
from marquee.llm.store import Scratch, components, packed, unpacked

SKETCH = 1 << 18        # slots of the shingle frequency estimate (fixed: at most 2 MB)


def _sets(column: pa.Array, k: int):
    """Of each slice of a column: start, stop, distinct shingles, their text, sizes."""
    for start, stop in W.pieces(column):
        part = column.slice(start, stop - start)
        data, offsets = W.text_bytes(part)
        starts, ends, first = W.spans(data, offsets, W.SPACED)
        g, owner = W.distinct(*W.shingles(W.word_hashes(data, starts, ends), first, k))
        yield start, stop, g, owner, np.bincount(owner, minlength=stop - start)


def _set_keys(g: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each text's distinct shingles."""
    edge = np.concatenate([[0], np.cumsum(sizes)])
    keys = []
    for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(g ^ np.uint64(salt)))])
        keys.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
    return keys[0], keys[1]


def _slot(g: np.ndarray) -> np.ndarray:
    return (g >> np.uint64(40)).astype(np.int64) & (SKETCH - 1)


def need(n, percent: int):
    """ceil(percent * n / 100) for a Jaccard threshold given in percent."""
    return -(-(n * percent) // 100)


def _summaries(k: int, flush: int = 2_000_000):
    """Set sizes and keys; and, of shingles that come back within about
    ``flush`` of them, counts by slot."""
    def common(seen):
        g = np.concatenate(seen)
        g.sort()
        edge = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]]))
        often = np.diff(edge)
        more = often > 1
        count = np.bincount(_slot(g[edge[:-1][more]]), often[more], SKETCH)
        at = np.flatnonzero(count)
        none = pa.nulls(len(at), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(count[at].astype(np.int64)), none, none, pa.array(at.astype(np.int32))],
                                          names=["id", "n", "k1", "k2", "slot"])

    def run(batches):
        seen, size = [], 0
        for b in batches:
            for start, stop, g, _, sizes in _sets(b.column(1), k):
                k1, k2 = _set_keys(g, sizes)
                n = stop - start
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, n), pa.array(sizes, pa.int64()), pa.array(k1), pa.array(k2), pa.nulls(n, pa.int32())],
                    names=["id", "n", "k1", "k2", "slot"])
                seen.append(g)
                size += len(g)
                if size >= flush:
                    yield common(seen)
                    seen, size = [], 0
        if size:
            yield common(seen)
    return run


def choose_levels(often: np.ndarray, base: int, most: int, weight: float) -> int:
    """l of one document: ``often`` are the estimated frequencies of its
    shingles in global order, ``base`` its prefix length for l = 1.

    Reading the lists of a prefix costs their lengths; at most
    (sum of lengths) / l documents share l of its shingles, and each costs
    ``weight`` to verify."""
    top = min(most, len(often) - base + 1)
    if top <= 1:
        return 1
    lists = np.cumsum(often[:base + top - 1])[base - 1:]
    return int(np.argmin(lists * (1 + weight / np.arange(1, top + 1)))) + 1


def _prefixes(k: int, percent: int, most: int, weight: float, often: np.ndarray):
    def run(batches):
        for b in batches:
            for _, _, g, owner, sizes in _sets(b.column(0), k):
                if not len(g):
                    continue
                k1, k2 = _set_keys(g, sizes)
                count = np.minimum(often[_slot(g)], (1 << 23) - 1)
                order = np.lexsort((g, count, owner))
                g, count = g[order], count[order]
                edge = np.concatenate([[0], np.cumsum(sizes)])
                base = sizes - need(sizes, percent) + 1
                level = np.ones(len(sizes), np.int64)
                hot = np.flatnonzero(np.add.reduceat(np.concatenate([count, [0]]), np.minimum(edge[:-1], len(count))) * (sizes > 0))
                for i in hot:
                    level[i] = choose_levels(count[edge[i]:edge[i + 1]], int(base[i]), most, weight)
                rank = np.arange(len(g)) - np.repeat(edge[:-1], sizes)
                low = np.repeat(base, sizes)
                keep = rank < low + np.repeat(level, sizes) - 1
                mine = np.repeat(np.arange(len(sizes)), sizes)[keep]
                # where each prefix ends in the global order, as a row of its own (m < 0)
                some = np.flatnonzero(sizes)
                end = edge[some] + base[some] + level[some] - 2
                place = (count[end] << 40) | (g[end] >> np.uint64(24)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([g[keep].view(np.int64), place])), pa.array(np.concatenate([k1[mine], k1[some]])),
                     pa.array(np.concatenate([sizes[mine] * 16 + level[mine], np.full(len(some), -1)])),
                     pa.array(np.concatenate([rank[keep], np.zeros(len(some), np.int64)]))], names=["token", "x", "m", "pos"])
    return run


def _members(k: int):
    def run(batches):
        for b in batches:
            for start, stop, g, _, sizes in _sets(b.column(1), k):
                edge = np.concatenate([[0], np.cumsum(sizes)])
                raw = g.view(np.uint8).tobytes() if len(g) else b""
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, stop - start), pa.array(_set_keys(g, sizes)[0]),
                     pa.array([raw[8 * s:8 * e] for s, e in zip(edge[:-1], edge[1:])], pa.binary())],
                    names=["id", "k1", "shingles"])
    return run


def _verify(percent: int):
    def run(batches):
        for b in batches:
            xs, ys = b.column(2), b.column(3)
            keep = []
            for i in range(b.num_rows):
                p, q = np.frombuffer(xs[i].as_buffer(), np.int64), np.frombuffer(ys[i].as_buffer(), np.int64)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       percent: int = 80, levels: int = 4, verify_weight: float = 8.0) -> DataFrame:
    """Rows (id, n_shingles, component_id, class_rows): see the module text.

    ``class_rows`` counts the rows whose set equals this one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    seen = scratch.save(d.mapInArrow(_summaries(k), "id long, n long, k1 long, k2 long, slot int"), "seen")
    often = np.zeros(SKETCH, np.int64)
    for r in seen.where("slot is not null").groupBy("slot").agg(F.sum("n").alias("n")).toLocalIterator():
        often[r.slot] = r.n                                     # at most SKETCH rows
    rows = seen.where("slot is null").drop("slot")
    classes = scratch.save(rows.where("n > 0").groupBy("k1", "k2", "n")
                           .agg(F.min("id").alias("rep"), F.count("*").alias("rows")), "classes")

    prefix = scratch.save(d.select("text").mapInArrow(_prefixes(k, percent, levels, verify_weight, often), "token long, x long, m long, pos long"), "prefix")
    ends = prefix.where("m < 0").groupBy("x").agg(F.max("token").alias("last"))
    # the aggregation and the join read the same columns, so that Spark shuffles the prefixes once
    prefix = prefix.where("m >= 0").repartition("token")
    shared = (prefix.groupBy("token").agg(F.min(F.struct("x", "m", "pos")).alias("lo"), F.max(F.struct("x", "m", "pos")).alias("hi"))
              .where("lo.x <> hi.x").select("token"))
    lists = scratch.save(prefix.join(shared, "token").select("token", "x", F.shiftright("m", 4).alias("n"), F.expr("m & 15").alias("l"), "pos").distinct(), "shared")
    # shingles of a prefix that nobody else has: the others bound the overlap
    live = lists.groupBy("x").agg(F.count("*").alias("rows"), F.first("n").alias("n"), F.first("l").alias("l"))
    live = live.withColumn("rest", F.expr(f"(n * {percent} + 99) div 100 - l"))
    live = live.withColumn("dead", F.col("n") - F.col("rest") - F.col("rows")).select("x", "rest", "dead")
    lists = scratch.save(lists.join(live.join(ends, "x"), "x").select("token", "x", "pos", "n", "rest", "dead", "last"), "lists")
    scratch.drop("prefix")
    scratch.drop("shared")

    def bound(u: str, v: str, of: str) -> str:
        """``of`` the set whose prefix ends first in the global order: what the
        two share of that prefix, the other prefix holds too."""
        return (f"case when {u}.last < {v}.last then {of.format(u)} when {u}.last > {v}.last then {of.format(v)}"
                f" else greatest({of.format(u)}, {of.format(v)}) end")

    def may(u: str, v: str) -> str:
        """Sizes and live shingles of two sets allow for the threshold."""
        return (f"least({u}.n, {v}.n) * 100 >= greatest({u}.n, {v}.n) * {percent}"
                f" and {bound(u, v, '({0}.n - {0}.dead)')} * {100 + percent} >= ({u}.n + {v}.n) * {percent}")

    # with ``met`` shingles in both prefixes, and ``rest`` behind the one that ends first
    enough = f"(met + rest) * {100 + percent} >= size * {percent}"

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Links (a, b) between class representatives among pairs (x, y) of keys."""
        keys = pairs.select(F.col("x").alias("k1")).unionByName(pairs.select(F.col("y").alias("k1"))).distinct()
        ids = classes.join(keys, "k1", "left_semi").select(F.col("rep").alias("id")).distinct()
        sets = scratch.save(d.where("text is not null").join(ids, "id", "left_semi")
                            .mapInArrow(_members(k), "id long, k1 long, shingles binary").where(F.length("shingles") > 0), f"sets-{name}")
        left = sets.select(F.col("k1").alias("x"), F.col("id").alias("a"), F.col("shingles").alias("s"))
        right = sets.select(F.col("k1").alias("y"), F.col("id").alias("b"), F.col("shingles").alias("r"))
        return (pairs.join(left, "x").join(right, "y").select("a", "b", "s", "r").mapInArrow(_verify(percent), "a long, b long")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    # each key with the key of least dead shingles in the lists that it shares most with
    center = lists.groupBy("token").agg(F.min(F.struct((F.col("dead") / F.col("n")).alias("d"), "x", "n", "rest", "dead", "last")).alias("v"))
    star = lists.alias("u").join(center, "token").where("u.x <> v.x").where(F.expr(may("u", "v")))
    star = star.groupBy(F.col("u.x").alias("x"), F.col("v.x").alias("y")).agg(
        F.count("*").alias("met"), F.first(F.expr(bound("u", "v", "{}.rest"))).alias("rest"), F.first(F.col("u.n") + F.col("v.n")).alias("size"))
    star = star.where(enough).groupBy("x").agg(F.max_by("y", F.struct("met", "y")).alias("y"))
    star = scratch.save(star.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "star")
    links = scratch.save(verified(star, "star"), "links-star")

    # exact rest: all pairs in different components, counted before they are verified
    near = components(links, scratch, "cc-star")
    node = F.coalesce("component", "rep")
    of = (classes.join(near, classes.rep == near.node, "left").groupBy(F.col("k1").alias("x"))
          .agg(F.min(node).alias("c"), F.max(node).alias("c2")))
    rest = lists.join(of, "x")
    several = rest.groupBy("token").agg(F.min("c").alias("p"), F.max("c2").alias("q")).where("p <> q").select("token")
    rest = scratch.save(rest.join(several, "token"), "apart")
    # a pair is met at the first shingle, in the global order, that both hold: what stands before it is not shared
    first = " and ".join(f"({s}.n - {s}.pos) * {100 + percent} >= (u.n + v.n) * {percent}" for s in "uv")
    met = (rest.alias("u").join(rest.alias("v"), F.expr(
        f"u.token = v.token and u.x < v.x and (u.c <> v.c or u.c <> u.c2 or v.c <> v.c2) and {first} and " + may("u", "v")))
        .select(F.col("u.x").alias("x"), F.col("v.x").alias("y"), F.expr(bound("u", "v", "{}.rest")).alias("rest"), F.expr("u.n + v.n").alias("size")).distinct())
    held = lists.groupBy("x").agg(F.collect_list("token").alias("tokens"))       # of one prefix
    met = (met.join(held, "x").join(held.select(F.col("x").alias("y"), F.col("tokens").alias("others")), "y")
           .withColumn("met", F.size(F.array_intersect("tokens", "others"))).where(enough).select("x", "y"))
    met = scratch.save(met, "met")
    if not met.isEmpty():
        links = scratch.save(links.unionByName(verified(met, "met")).distinct(), "links")
    linked = components(links, scratch, "cc")

    final = (classes.join(linked, classes.rep == linked.node, "left")
             .select("k1", "k2", "n", "rows", F.coalesce("component", "rep").alias("component")))
    return (rows.join(final, ["k1", "k2", "n"], "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
                    F.coalesce("rows", F.lit(1)).alias("class_rows")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id.

    Rows without words are in no component and stay, as do rows with a NULL
    id.  Of rows that repeat a kept id one stays."""
    r = jaccard_components(docs, id_col, text_col, **options).where("n_shingles > 0 and id is not null")
    known = (r.groupBy("id").agg(F.min("component_id").alias("least"), F.count("*").alias("rows"))
             .where("id <> least or rows > 1"))
    words = F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = packed(docs, key=F.col(id_col).cast("long"), worded=words).join(known, F.col("key") == F.col("id"), "left")
    alone = marked.where(F.col("id").isNull() | ~F.col("worded"))
    again = marked.where((F.col("id") == F.col("least")) & F.col("worded")).dropDuplicates(["key"])
    return alone.unionByName(again).select(*unpacked(docs.columns))
