"""Ranked lexical search by norm buckets.

Each document is a vector of integer impacts over the terms of the items
(weight of the term times a share that saturates with its count and falls
with the document's length); an item is the set of its distinct terms, and
a document's score is the sum of its impacts over that set.

The impact vectors are range-partitioned and sorted by their length (norm),
longest first, and written once.  A task walks its part bucket by bucket:

* *buckets*: by Cauchy-Schwarz no vector of a bucket scores more for an item
  than the bucket's longest norm times the square root of the item's terms;
  items whose threshold (their k-th best score so far) lies above are left
  out, and a bucket without items is skipped;
* *coordinates*: the coordinates that few items hold are summed as they are
  (through the item lists of their terms), the rest is bounded by the norm
  of the document's other coordinates;
* *survivors* are scored anew over all their coordinates in 64-bit integers.

The first walk covers only the longest vectors (``SEED`` of them) and sets
the starting thresholds of the second one, which covers all; a threshold
is always the k-th best of scores already found, so nothing is lost.

Items are searched in groups of about ``GROUP_ITEMS`` items and
``GROUP_PAIRS`` (item, term) pairs, each one pass, so that what goes to the
tasks stays bounded for a benchmark of any size.  Terms are known by a
64-bit hash.

Cases: NULL and empty texts have no terms, are not counted in N and never
rank; items without terms get no rows; rows that repeat an item id are one
item with the terms of all (so are those with a NULL id); repeated
documents count and rank as often as they occur, equal scores by ascending
id, NULL ids first; empty tables give an empty result; further columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import words as W
from marquee.llm.store import Scratch

GROUP_ITEMS, GROUP_PAIRS = 2_048, 1 << 19
BUCKET_ROWS, BUCKET_TERMS = 1_024, 1 << 18
SEED = 0.05           # share of the longest vectors that set the first thresholds
FEW = 16              # a coordinate is summed as it is if at most so many items hold it
SAFE = 1 + 1e-9       # bounds are rounded up by more than the error of doubles


def term_hashes(column: pa.Array):
    """Hashes of all terms and the first one of each text (n + 1)."""
    data, offsets = W.text_bytes(column)
    starts, ends, first = W.spans(data, offsets, W.ALNUM)
    return W.word_hashes(data, starts, ends).view(np.int64), first


def _item_terms(batches):
    for b in batches:
        for start, stop in W.pieces(b.column(1)):
            h, first = term_hashes(b.column(1).slice(start, stop - start))
            owner = np.repeat(np.arange(stop - start), np.diff(first))
            h, owner = W.distinct(h, owner)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(start, stop - start).take(pa.array(owner)), pa.array(h)], names=["item", "term"])


@dataclass
class Items:
    """A group of items over its own vocabulary (sorted term hashes)."""

    ids: pa.Array
    vocabulary: np.ndarray
    item: np.ndarray              # (item, term) pairs by term, then item
    term: np.ndarray

    @classmethod
    def of(cls, ids: pa.Array, terms: list[np.ndarray]) -> Items:
        every = np.concatenate(terms) if terms else np.empty(0, np.int64)
        vocabulary, at = np.unique(every, return_inverse=True)
        item = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        order = np.lexsort((item, at))
        return cls(ids, vocabulary, item[order], at[order])

    def weighted(self, weight: np.ndarray) -> None:
        """Lists per coordinate, without the coordinates of weight 0."""
        live = weight[self.term] > 0
        item, term = self.item[live], self.term[live]
        n, size = len(self.ids), len(self.vocabulary)
        self.holders = np.bincount(term, minlength=size)
        self.first = np.concatenate([[0], np.cumsum(self.holders)])
        self.list = item
        self.many = self.holders > FEW
        self.pairs = np.sort(item * np.int64(size) + term)
        self.reach = np.sqrt(np.bincount(item, minlength=n).astype(float))
        self.rest = np.sqrt(np.bincount(item[self.many[term]], minlength=n).astype(float))


def _repeat(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places first[i] .. first[i] + count[i] - 1 for all i."""
    through = np.cumsum(count)
    return np.arange(through[-1] if len(through) else 0) + np.repeat(first - through + count, count)


def _vocabulary_counts(items):
    """Per text with terms of the vocabulary: its terms (numbers) and counts;
    one row without terms for each slice sums all its texts and words."""
    def run(batches):
        vocabulary = items.value.vocabulary
        for b in batches:
            for start, stop in W.pieces(b.column(1)):
                h, first = term_hashes(b.column(1).slice(start, stop - start))
                n = np.diff(first)
                at = np.minimum(np.searchsorted(vocabulary, h), max(0, len(vocabulary) - 1))
                hit = np.flatnonzero(vocabulary[at] == h) if len(vocabulary) else np.empty(0, np.int64)
                key, count = np.unique(np.repeat(np.arange(stop - start), n)[hit] * np.int64(max(1, len(vocabulary))) + at[hit], return_counts=True)
                text, term = np.divmod(key, max(1, len(vocabulary)))
                rows, begin = np.unique(text, return_index=True)
                edges = pa.array(np.append(begin, len(text)), pa.int32())
                ids = b.column(0).slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array(n[rows]), pa.array(np.ones(len(rows), np.int64)),
                     pa.ListArray.from_arrays(edges, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(edges, pa.array(count))],
                    names=["doc", "n", "docs", "t", "f"])
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, ids.type), pa.array([int(n.sum())], pa.int64()), pa.array([int((n > 0).sum())], pa.int64()),
                     pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64()))], names=["doc", "n", "docs", "t", "f"])
    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column and the n + 1 edges of its rows."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """Integer weight of terms that ``df`` of ``n_docs`` documents hold."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(weight: np.ndarray, count: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * count) // (1000 * count + 20 * m))


def _vectors(weight, n_docs: int, n_words: int):
    def run(batches):
        w = weight.value
        for b in batches:
            t, edge = _lists(b.column(2))
            f, _ = _lists(b.column(3))
            n = b.column(1).to_numpy()
            owner = np.repeat(np.arange(len(n)), np.diff(edge))
            m = 50 + (50 * n * n_docs) // n_words
            v = impacts(w[t], f, m[owner])
            keep = v > 0
            t, v, owner = t[keep], v[keep], owner[keep]
            norm = np.sqrt(np.bincount(owner, v.astype(float) ** 2, len(n)))
            rows = np.flatnonzero(norm > 0)
            edges = pa.array(np.searchsorted(owner, np.append(rows, len(n))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(norm[rows]), pa.ListArray.from_arrays(edges, pa.array(t)), pa.ListArray.from_arrays(edges, pa.array(v))],
                names=["doc", "norm", "t", "v"])
    return run


class Walk:
    """Best ``k`` documents of each item over the buckets walked so far."""

    def __init__(self, items: Items, k: int, threshold: np.ndarray):
        self.items, self.k = items, k
        self.threshold = np.maximum(threshold, 1)
        self.best: list[tuple] = []               # (item, score, id, NULL id) arrays

    def bucket(self, ids: np.ndarray, null: np.ndarray, norm: np.ndarray, t: np.ndarray, v: np.ndarray, edge: np.ndarray) -> None:
        g, n = self.items, len(self.items.ids)
        active = np.flatnonzero(g.reach * norm.max() * SAFE >= self.threshold)
        if not len(active):
            return
        rows = len(norm)
        owner = np.repeat(np.arange(rows), np.diff(edge))
        few = ~g.many[t]
        count = g.holders[t[few]]
        item = g.list[_repeat(g.first[t[few]], count)]
        known = np.bincount(np.repeat(owner[few], count) * n + item, np.repeat(v[few], count), rows * n).reshape(rows, n)[:, active]
        other = np.sqrt(np.bincount(owner[~few], v[~few].astype(float) ** 2, rows))
        bound = np.minimum(known + other[:, None] * g.rest[active], norm[:, None] * g.reach[active])
        doc, at = np.nonzero(bound * SAFE >= self.threshold[active])
        self.rescore(doc, active[at], ids, null, t, v, edge)

    def rescore(self, doc, item, ids, null, t, v, edge) -> None:
        """Exact scores of the (document, item) survivors, in slices."""
        size = np.diff(edge)[doc]
        through = np.cumsum(size)
        start = 0
        while start < len(doc):
            stop = max(start + 1, int(np.searchsorted(through, (through[start - 1] if start else 0) + (1 << 21), side="right")))
            s = slice(start, stop)
            place = _repeat(edge[doc[s]], size[s])
            key = np.repeat(item[s], size[s]) * np.int64(len(self.items.vocabulary)) + t[place]
            at = np.minimum(np.searchsorted(self.items.pairs, key), len(self.items.pairs) - 1)
            value = np.where(self.items.pairs[at] == key, v[place], 0)
            score = np.add.reduceat(value, np.cumsum(size[s]) - size[s])
            good = np.flatnonzero(score >= self.threshold[item[s]])
            self.best.append((item[s][good], score[good], ids[doc[s][good]], null[doc[s][good]]))
            self.cut()
            start = stop

    def cut(self) -> None:
        """Keep each item's best; its k-th score is its threshold from now on."""
        item, score, ids, null = (np.concatenate(x) for x in zip(*self.best))
        order = np.lexsort((ids, ~null, -score, item))
        item, score, ids, null = item[order], score[order], ids[order], null[order]
        begin = np.searchsorted(item, item)
        rank = np.arange(len(item)) - begin
        last = rank == self.k - 1
        self.threshold[item[last]] = np.maximum(self.threshold[item[last]], score[last])
        keep = rank < self.k
        self.best = [(item[keep], score[keep], ids[keep], null[keep])]


def _order_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as an array that sorts like them, and which of them are NULL."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    if pa.types.is_integer(column.type):
        return column.fill_null(0).cast(pa.int64()).to_numpy(), null
    return np.array([x or "" for x in column.cast(pa.string()).to_pylist()], dtype="U"), null


def _walk(items, threshold, k: int):
    """Each task's best documents of each item."""
    def run(batches):
        walk, id_type = Walk(items.value, k, threshold.value.copy()), None
        for b in batches:
            id_type = b.column(0).type
            ids, null = _order_keys(b.column(0))
            norm = b.column(1).to_numpy()
            t, edge = _lists(b.column(2))
            v, _ = _lists(b.column(3))
            start = 0
            while start < len(norm):
                stop = int(np.searchsorted(edge, edge[start] + BUCKET_TERMS, side="right")) - 1
                stop = min(max(start + 1, stop), start + BUCKET_ROWS, len(norm))
                s, p = slice(start, stop), slice(edge[start], edge[stop])
                walk.bucket(ids[s], null[s], norm[s], t[p], v[p], edge[start:stop + 1] - edge[start])
                start = stop
        if walk.best:
            item, score, ids, null = walk.best[0]
            yield pa.RecordBatch.from_arrays([items.value.ids.take(pa.array(item)), pa.array(item.astype(np.int32)), pa.array(ids, mask=null).cast(id_type), pa.array(score)],
                                             names=["item", "item_no", "doc", "score"])
    return run


def _search(docs: DataFrame, group: DataFrame, k: int, scratch: Scratch, name: str) -> DataFrame | None:
    """Rows (item, doc, score) that hold each item's best ``k`` documents."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    table = group.toArrow()                  # about GROUP_ITEMS items, GROUP_PAIRS terms
    if not table.num_rows:
        return None
    ids = table.column("item").combine_chunks()
    items = Items.of(ids, [np.array(x, np.int64) for x in table.column("terms").to_pylist()])
    doc_type, item_type = docs.schema["doc"].dataType, group.schema["item"].dataType
    counted = scratch.save(docs.mapInArrow(_vocabulary_counts(sc.broadcast(items)), T.StructType(
        [T.StructField("doc", doc_type), T.StructField("n", T.LongType()), T.StructField("docs", T.LongType()),
         T.StructField("t", T.ArrayType(T.IntegerType())), T.StructField("f", T.ArrayType(T.LongType()))])), f"{name}-counts")
    total = counted.where("t is null").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).first()
    if not total.n:
        return None
    counted = counted.where("t is not null")
    held = counted.select(F.explode("t").alias("t")).groupBy("t").count().toArrow()
    df = np.zeros(len(items.vocabulary), np.int64)
    df[held.column(0).to_numpy()] = held.column(1).to_numpy()
    weight = weights(df, total.docs)
    items.weighted(weight)
    rows = counted.select("doc", "n", "t", "f").mapInArrow(_vectors(sc.broadcast(weight), int(total.docs), int(total.n)), T.StructType(
        [T.StructField("doc", doc_type), T.StructField("norm", T.DoubleType()),
         T.StructField("t", T.ArrayType(T.IntegerType())), T.StructField("v", T.ArrayType(T.LongType()))]))
    vectors = scratch.save(rows.repartitionByRange(F.desc("norm"), F.xxhash64("doc")).sortWithinPartitions(F.desc("norm")), f"{name}-vectors")
    shared = sc.broadcast(items)
    schema = T.StructType([T.StructField("item", item_type), T.StructField("item_no", T.IntegerType()), T.StructField("doc", doc_type), T.StructField("score", T.LongType())])
    threshold = np.ones(len(ids), np.int64)
    longest = vectors.agg(F.percentile_approx("norm", 1 - SEED, 1_000).alias("x")).first().x
    if longest is not None:
        first = vectors.where(F.col("norm") >= longest).mapInArrow(_walk(shared, sc.broadcast(threshold), k), schema)
        order = Window.partitionBy("item_no").orderBy(F.desc("score"))
        kth = first.select("item_no", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k).where(F.col("rank") == k).collect()
        for r in kth:                        # one row an item at most
            threshold[r.item_no] = r.score
    return vectors.mapInArrow(_walk(shared, sc.broadcast(threshold), k), schema).select("item", "doc", "score")


def top_k(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (item, rank, doc, score): each item's ``k`` best documents."""
    scratch = Scratch(docs.sparkSession, "search")
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    wanted = items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("item", wanted.schema["item"].dataType), T.StructField("term", T.LongType())])
    pairs = wanted.mapInArrow(_item_terms, schema).distinct()
    sets = scratch.save(pairs.groupBy("item").agg(F.collect_list("term").alias("terms")), "items")
    size = sets.agg(F.count("*").alias("items"), F.sum(F.size("terms")).alias("pairs")).first()
    groups = max(1, -(-size.items // GROUP_ITEMS), -(-(size.pairs or 0) // GROUP_PAIRS))
    number = F.pmod(F.xxhash64("item"), F.lit(groups))
    found = [x for i in range(groups) if (x := _search(docs, sets.where(number == i), k, scratch, f"g{i}")) is not None]
    if not found:
        none = T.StructType([T.StructField("item", wanted.schema["item"].dataType), T.StructField("rank", T.IntegerType()),
                             T.StructField("doc", docs.schema["doc"].dataType), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], none)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    return (reduce(DataFrame.unionAll, found).select("item", F.row_number().over(order).alias("rank"), "doc", "score").where(F.col("rank") <= k))
