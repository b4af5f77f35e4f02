"""Graph jobs as iterative DataFrame programs.

Vertices and edges are DataFrames (``edges(src, dst[, w])``).  Each
iteration is one join + one aggregation; lineage is cut every few
iterations with a reliable ``checkpoint()`` into the folder the cluster
names in ``spark.checkpoint.dir`` (a lost executor then recomputes from
the last checkpoint, not from the first iteration).  Convergence tests
pull a single aggregate value to the driver, never the data.
"""

from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import checkpoint_dir

# measured: cutting lineage every 2 rounds beats 4 or 10 (plan growth
# costs more than the checkpoint writes) and bounds recomputation on a
# lost executor to two rounds
CHECKPOINT_EVERY = 2


def _cut(df: DataFrame, i: int, every: int = CHECKPOINT_EVERY) -> DataFrame:
    if every and (i + 1) % every == 0:
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df


def vertices_of(edges: DataFrame) -> DataFrame:
    return (edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct())


def pagerank_simple(edges: DataFrame, iterations: int = 10) -> DataFrame:
    """Classic example semantics: ranks start at 1 for every page with
    out-links; each round r = 0.15 + 0.85 * sum(r_src / outdeg_src) over
    in-links; pages without in-links drop out after a round."""
    links = edges.select("src", "dst").distinct()
    outdeg = links.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    links = links.join(outdeg, "src").cache()
    ranks = links.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    for i in range(iterations):
        contrib = links.join(ranks, links.src == ranks.id).select(
            F.col("dst").alias("id"), (F.col("rank") / F.col("deg")).alias("c"))
        ranks = contrib.groupBy("id").agg((F.lit(0.15) + F.lit(0.85) * F.sum("c")).alias("rank"))
        ranks = _cut(ranks, i, 1 if i == iterations - 1 else CHECKPOINT_EVERY)
    links.unpersist()
    return ranks


def pagerank(edges: DataFrame, iterations: int = 20, tol: float | None = None,
             reset: float = 0.15) -> DataFrame:
    """Static (``iterations``) or dynamic (stop when the largest change
    is below ``tol``) PageRank keeping every vertex; a vertex without
    in-links has rank ``reset``."""
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = edges.select("src", "dst").distinct()
    outdeg = links.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    # out-degree attached once; the edge list is hash-partitioned by src
    # and cached, and ranks are partitioned by id the same way, so each
    # iteration's join moves only the rank messages, never the edges.
    links = (links.join(outdeg, "src").select("src", "dst", F.col("deg").cast("double").alias("deg"))
             .repartition(n, "src").cache())
    verts = vertices_of(links).cache()
    zero = verts.select("id", F.lit(0.0).alias("c"))
    ranks = verts.withColumn("rank", F.lit(1.0)).repartition(n, "id")
    for i in range(iterations):
        # contributions plus a zero row per vertex: one aggregation keeps
        # vertices without in-links (no extra outer join per iteration)
        contrib = (links.join(ranks, links.src == ranks.id)
                   .select(F.col("dst").alias("id"), (F.col("rank") / F.col("deg")).alias("c")))
        new = (contrib.unionByName(zero).groupBy("id")
               .agg((F.lit(reset) + F.lit(1 - reset) * F.sum("c")).alias("rank")))
        new = _cut(new, i, 1 if i == iterations - 1 or tol is not None else CHECKPOINT_EVERY)
        if tol is not None:
            delta = (new.alias("n").join(ranks.alias("o"), "id")
                     .agg(F.max(F.abs(F.col("n.rank") - F.col("o.rank")))).first()[0])
            ranks = new
            if delta is None or delta < tol:
                break
        else:
            ranks = new
    links.unpersist()
    verts.unpersist()
    return ranks


def connected_components(edges: DataFrame) -> DataFrame:
    """Undirected components; label = smallest vertex id.

    Large-star and small-star rounds: each vertex's larger neighbours are
    hung on the smallest vertex it sees, then its smaller ones, until all
    components are stars.  A path of n vertices takes about log n rounds; a
    round is a few aggregations over one row a link, and links only fall.
    Vertices whose edges are all self loops keep their own label."""
    checkpoint_dir(edges.sparkSession)
    verts = vertices_of(edges)
    links = canonical_edges(edges.select("src", "dst")).select(F.col("dst").alias("a"), F.col("src").alias("b")).checkpoint()
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        links = small.checkpoint()
        # stars: a vertex hangs on one other, which hangs on none
        ends = (links.select(F.col("a").alias("v"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
                .unionByName(links.select(F.col("b").alias("v"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))))
        loose = ends.groupBy("v").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or (hangs = 1 and holds = 1)")
        if loose.isEmpty():
            break
    labels = links.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return verts.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Undirected simple edges as (src < dst), self loops removed."""
    e = edges.where(F.col("src") != F.col("dst"))
    return e.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


#: Edges of one block of the triangle count, wedges looked at together, and edges packed together.
TRIANGLE_EDGES = 2_000_000
_WEDGES = 2_000_000
_PACK = 1_000_000


def _pack(a, b) -> bytes:
    """Edges sorted by (a, b) in a few bytes each: steps of ``a`` and the
    ends, byte by byte, so that the high bytes shrink to nothing."""
    return zlib.compress(np.stack([np.diff(a, prepend=np.int64(0)), b]).view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes(), 1)


def _unpack(packed: bytes):
    a, b = np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(2, 8, -1).transpose(0, 2, 1)).view(np.int64)[..., 0]
    return np.cumsum(a), b


def _packed_edges(batches):
    """One row for the edges (a, b) of each pair of colours (ca, cb)."""
    def rows(held):
        a, b, ca, cb = (np.concatenate([t[c].to_numpy(zero_copy_only=False) for t in held]) for c in ("a", "b", "ca", "cb"))
        order = np.lexsort((b, a, cb, ca))
        a, b, ca, cb = a[order], b[order], ca[order], cb[order]
        at = np.flatnonzero(np.diff(ca, prepend=-1) | np.diff(cb, prepend=-1))
        packed = [_pack(a[i:j], b[i:j]) for i, j in zip(at, [*at[1:], len(a)])]
        return pa.RecordBatch.from_arrays([pa.array(ca[at], pa.int64()), pa.array(cb[at], pa.int64()), pa.array(packed, pa.binary())], names=["ca", "cb", "edges"])
    held = []
    for t in batches:
        held.append(t)
        if sum(x.num_rows for x in held) >= _PACK:
            yield rows(held)
            held = []
    if any(x.num_rows for x in held):
        yield rows(held)


def _block_triangles(colours: int):
    """Triangles of one block whose three colours are the block's."""
    def run(key, t):
        parts = [_unpack(x.as_py()) for x in t["edges"]]
        ids = np.unique(np.concatenate([np.unique(x) for ab in parts for x in ab]))
        n, colour = len(ids), np.zeros(len(ids), np.int64)
        for k, (ca, cb) in enumerate(zip(t["ca"].to_pylist(), t["cb"].to_pylist())):
            a, b = (np.searchsorted(ids, x).astype(np.int32) for x in parts[k])
            colour[a], colour[b], parts[k] = ca, cb, (a, b)
        a, b = (np.concatenate(x) for x in zip(*parts))
        del parts
        m = len(a)
        # numbered by degree: every edge goes up
        order = np.argsort(np.bincount(a, minlength=n) + np.bincount(b, minlength=n), kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        ids, colour, a, b = ids[order], colour[order], rank[a], rank[b]
        code = np.minimum(a, b) * n + np.maximum(a, b)
        code.sort()                                                    # edges by (low, high)
        a, b = np.divmod(code, n)
        first = np.searchsorted(a, np.arange(n + 1))
        out = np.diff(first)[b]                                        # wedges a -> b -> c of each edge
        block = key[0].as_py()
        count, ends = np.zeros(n, np.int64), np.cumsum(out)
        i = 0
        while i < m:
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _WEDGES, side="right")))
            k = out[i:j]
            edge = np.repeat(np.arange(i, j), k)
            c = b[first[b[edge]] + np.arange(len(edge)) - np.repeat(np.cumsum(k) - k, k)]
            p, q = a[edge], b[edge]
            want = p * n + c
            found = np.searchsorted(code, want)
            closed = code[np.minimum(found, m - 1)] == want
            p, q, c = p[closed], q[closed], c[closed]
            three = np.sort(np.stack([colour[p], colour[q], colour[c]]), axis=0)
            mine = (three[0] * colours + three[1]) * colours + three[2] == block
            count += np.bincount(np.concatenate([p[mine], q[mine], c[mine]]), minlength=n)
            i = j
        return pa.table([pa.array(ids, pa.int64()), pa.array(count, pa.int64())], names=["id", "triangles"])
    return run


def triangle_counts(edges: DataFrame) -> DataFrame:
    """Per-vertex triangle count.  Inside a block edges are oriented from the
    lower to the higher (degree, id) endpoint, which bounds the wedges each
    vertex emits (no all-pairs expansion of hub neighbourhoods).

    No wedge leaves its task: vertices are dealt over colours, a block is a
    set of three colours with all edges between them, and counts the
    triangles that have just these.  An edge goes to one block for each
    colour, packed with others of its two colours; the colours follow the
    counted edges, so that blocks stay bounded.  Every vertex is in a block,
    so those without triangles come out too."""
    e = canonical_edges(edges)
    kind = e.schema["src"].dataType
    checkpoint_dir(edges.sparkSession)
    e = e.select(F.col("src").cast("long").alias("a"), F.col("dst").cast("long").alias("b")).checkpoint()      # counted and dealt
    colours = max(1, math.ceil(math.sqrt(6 * e.count() / TRIANGLE_EDGES)))
    colour = lambda c: F.pmod(F.xxhash64(c), F.lit(colours))
    three = F.array_sort(F.array("ca", "cb", "z"))
    dealt = (e.select("a", "b", colour("a").alias("ca"), colour("b").alias("cb"))
             .mapInArrow(_packed_edges, "ca long, cb long, edges binary")
             .withColumn("z", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(colours - 1).cast("long"))))
             .select(((three[0] * colours + three[1]) * colours + three[2]).alias("block"), "ca", "cb", "edges"))
    # few bytes, much work: not to be coalesced by size
    parts = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), edges.sparkSession.sparkContext.defaultParallelism)
    return (dealt.repartition(parts, "block").groupBy("block").applyInArrow(_block_triangles(colours), "id long, triangles long")
            .groupBy("id").agg(F.sum("triangles").alias("triangles"))
            .select(F.col("id").cast(kind).alias("id"), "triangles"))


def shortest_paths(edges: DataFrame, source, weight: str = "w") -> DataFrame:
    """Single-source shortest paths (Bellman-Ford relaxation, directed);
    unreachable vertices get +inf.  Rounds go on until no distance falls;
    a cycle of negative weight raises once there were more rounds than
    vertices."""
    e = edges.select("src", "dst", F.col(weight).cast("double").alias("w")).cache()
    verts = vertices_of(e)
    dist = verts.withColumn("dist", F.when(F.col("id") == F.lit(source), F.lit(0.0)).otherwise(F.lit(float("inf"))))
    bound = verts.count()
    for i in itertools.count():
        if i > bound:
            raise ValueError("the graph has a cycle of negative weight")
        relax = (e.join(dist.where(F.col("dist") < float("inf")), e.src == dist.id)
                 .groupBy("dst").agg(F.min(F.col("dist") + F.col("w")).alias("nd")))
        new = (dist.join(relax, dist.id == relax.dst, "left")
               .select("id", F.least("dist", F.coalesce("nd", F.lit(float("inf")))).alias("dist")))
        new = _cut(new, i, every=2)
        changed = (new.alias("n").join(dist.alias("o"), "id").where(F.col("n.dist") < F.col("o.dist")).limit(1).count())
        dist = new
        if changed == 0:
            break
    e.unpersist()
    return dist


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All (src, dst) pairs joined by a directed path.  Each round extends
    only the pairs found in the round before by one edge, until none is new."""
    e = edges.select("src", "dst").distinct().cache()
    closure = new = _cut(e, 0, every=1)
    for i in itertools.count(1):
        step = new.alias("p").join(e.alias("q"), F.col("p.dst") == F.col("q.src")).select(
            F.col("p.src").alias("src"), F.col("q.dst").alias("dst")).distinct()
        new = _cut(step.join(closure, ["src", "dst"], "left_anti"), i, every=1)
        if new.isEmpty():
            break
        closure = _cut(closure.unionByName(new), i, every=1)
    e.unpersist()
    return closure


def degrees(edges: DataFrame) -> DataFrame:
    e = edges.select("src", "dst")
    out = e.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_deg"))
    inn = e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_deg"))
    return out.join(inn, "id", "full").select("id", F.coalesce("in_deg", F.lit(0)).alias("in_deg"),
                                              F.coalesce("out_deg", F.lit(0)).alias("out_deg"))

