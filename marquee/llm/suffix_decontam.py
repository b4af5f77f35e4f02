"""Benchmark decontamination with suffix arrays of the training words.

The documents of a task are cut into shards of at most 2**20 words (a
longer document is continued in the next shard with an overlap).  Each
shard gets a word-level suffix array by prefix doubling: the ranks of
2, 4, 8 ... words are sorted as (rank, next rank, position) packed in 63
bits.  Every test suffix is binary-searched in the array; its longest
verbatim match is the longer common prefix with its two neighbours, and
all places that share a whole window with it form one range of the array.

A window is ``window`` consecutive item words; an item of fewer words,
but not none, is one window.  The items are turned into words by a Spark
job and dealt into blocks of about ``block_words`` words.  One block at a
time goes through the driver to the tasks, is searched in one pass over the
documents whose finds are written, and is given up before the next one; so
a benchmark of any size is searched with one block in memory.

Cases: NULL and empty texts have no words and no hits; items without
words have no window; repeated items are searched as given and counted by
their distinct ids; NULL item ids are skipped in the list of ids but their
words are hit; empty tables give empty results or no hits; repeated rows
are handled row by row; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import words as W
from marquee.llm.store import Scratch, packed, unpacked

SHARD_WORDS = 1 << 20
STOP = np.uint64(0)      # follows each text, so that no match runs from one into the next
FOUND = "n_words long, spans binary, items array<string>, best binary"


class SuffixArray:
    """Suffix array of word hashes, ordered by their first ``depth`` words.

    ``stop`` marks the words that end a document: a suffix ends there."""

    def __init__(self, h: np.ndarray, depth: int):
        self.n = len(h)
        bits = max(1, int(self.n).bit_length())
        mask = (1 << bits) - 1
        self.vocabulary = np.unique(h)
        rank = np.searchsorted(self.vocabulary, h).astype(np.int64) + 1
        self.word = np.append(rank, 0)                  # 0: past the end
        span, place = 1, np.arange(self.n, dtype=np.int64)
        order, top = None, int(rank.max(initial=0))
        while order is None or (span < depth and top < self.n):
            ahead = np.zeros(self.n, np.int64)
            if order is not None:
                ahead[:self.n - span] = rank[span:]
                span *= 2
            else:
                ahead[:self.n - 1] = rank[1:]
                span = 2
            if 3 * bits <= 63:
                packed = np.sort((rank << (2 * bits)) | (ahead << bits) | place)
                order, key = packed & mask, packed >> bits
            else:
                key = (rank << bits) | ahead
                order = np.argsort(key, kind="stable")
                key = key[order]
            fresh = np.ones(self.n, np.int64)
            fresh[1:] = key[1:] != key[:-1]
            rank = np.empty(self.n, np.int64)
            rank[order] = np.cumsum(fresh)
            top = int(rank.max(initial=0))
        self.order = order

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """Ranks of test words, -1 for words that the shard lacks."""
        if not len(self.vocabulary):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at + 1, -1).astype(np.int64)

    def common(self, test: np.ndarray, start: np.ndarray, length: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Words shared by each test suffix and the shard's suffix at ``place``."""
        out = np.zeros(len(start), np.int64)
        live = np.flatnonzero((place >= 0) & (place < self.n))
        i = 0
        while len(live):
            ok = (i < length[live])
            live = live[ok]
            same = test[start[live] + i] == self.word[np.minimum(place[live] + i, self.n)]
            live = live[same]
            out[live] += 1
            i += 1
        return out

    def bound(self, test: np.ndarray, start: np.ndarray, length: np.ndarray, after: bool = False) -> np.ndarray:
        """First place in the array not before (or, with ``after``, behind) each test suffix."""
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), self.n, np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            place = self.order[mid]
            s, n = start[open_], length[open_]
            c = self.common(test, s, n, place)
            done = c >= n
            left = self.word[np.minimum(place + c, self.n)]
            right = test[np.minimum(s + c, len(test) - 1)]
            less = np.where(done, after, left < right)
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)


class Suffixes:
    """One block of test suffixes: word hashes, and per suffix its item,
    start, window length and full length."""

    def __init__(self, h: np.ndarray, first: np.ndarray, ids: list, window: int):
        n = np.diff(first)
        self.h, self.ids = h, ids
        item = np.repeat(np.arange(len(n)), n)
        start = np.arange(len(h))
        left = first[1:][item] - start if len(h) else start
        size = np.minimum(window, n)[item] if len(h) else start
        self.item, self.start, self.left, self.size = item, start, left, size
        self.depth = int(left.max(initial=1))

    def search(self, h: np.ndarray):
        """(suffix, place, words shared) of every occurrence of a window in a
        shard, and each suffix's longest match as (words, place)."""
        array = SuffixArray(h, self.depth)
        test = array.ranks(self.h)
        low = array.bound(test, self.start, self.left)
        at = np.append(array.order, -1)
        best, where = np.zeros(len(low), np.int64), np.full(len(low), -1, np.int64)
        for place in (at[low], np.where(low > 0, at[low - 1], -1)):
            c = array.common(test, self.start, self.left, place)
            where, best = np.where(c > best, place, where), np.maximum(c, best)
        hit = np.flatnonzero((best >= self.size) & (self.left >= self.size))
        a = array.bound(test, self.start[hit], self.size[hit])
        b = array.bound(test, self.start[hit], self.size[hit], after=True)
        n = b - a
        which = np.repeat(hit, n)
        place = array.order[np.repeat(a, n) + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)]
        return which, place, best, where


def _shards(h: np.ndarray, first: np.ndarray, overlap: int):
    """Cut the words of many texts into shards: (first word, words, index of
    each word's text); neighbours share ``overlap`` words."""
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    i = 0
    while i < len(h):
        j = min(len(h), i + SHARD_WORDS)
        yield i, h[i:j], text[i:j]
        if j == len(h):
            return
        i = j - overlap


def _found(suffixes: Suffixes, column: pa.Array):
    """Of each slice of a text column: start, stop, words per text, and by
    text the hit spans, the items and the longest match."""
    overlap = min(suffixes.depth, SHARD_WORDS // 2)
    for start, stop in W.pieces(column, 8 << 20):
        data, offsets = W.text_bytes(column.slice(start, stop - start))
        s, e, first = W.spans(data, offsets, W.ALNUM)
        h = W.word_hashes(data, s, e)
        del data, s, e
        n = np.diff(first)
        h = np.insert(h, first[1:], STOP) if len(h) else h
        edge = first + np.arange(len(first))
        spans, items, best = {}, {}, {}
        for at, shard, text in _shards(h, edge, overlap) if len(suffixes.h) else ():
            which, place, longest, _ = suffixes.search(shard)
            owner, size = text[place], suffixes.size[which]
            for t in np.unique(owner):
                m = owner == t
                lo = place[m] + at - edge[t]
                spans.setdefault(t, []).append(np.stack([lo, lo + size[m]]))
                items.setdefault(t, []).append(suffixes.item[which[m]])
                best[t] = max(best.get(t, 0), int(longest[which[m]].max()))
        yield start, stop, n, spans, items, best


def _search(block):
    def run(batches):
        suffixes = block.value
        for b in batches:
            for start, stop, n, spans, items, best in _found(suffixes, b.column(2)):
                out = {c: [None] * (stop - start) for c in ("spans", "items", "best")}
                for t in spans:
                    out["spans"][t] = np.unique(np.concatenate(spans[t], axis=1), axis=1).astype(np.int64).tobytes()
                    out["items"][t] = sorted({suffixes.ids[i] for i in np.unique(np.concatenate(items[t])).tolist()} - {None})
                    out["best"][t] = np.int64(best[t]).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, stop - start), b.column(1).slice(start, stop - start), pa.array(n.astype(np.int64))]
                    + [pa.array(out["spans"], pa.binary()), pa.array(out["items"], pa.list_(pa.string())), pa.array(out["best"], pa.binary())],
                    names=["row", "id", "n_words", "spans", "items", "best"])
    return run


def _flagged(block):
    """Whether each text holds no window of the block."""
    def run(batches):
        suffixes = block.value
        for b in batches:
            clean = np.ones(b.num_rows, bool)
            for start, _, _, spans, _, _ in _found(suffixes, b.column(1)):
                clean[[start + int(t) for t in spans]] = False
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(~clean))], names=["row"])
    return run


def _clean(block, column: int):
    def run(batches):
        suffixes = block.value
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            for start, _, _, spans, _, _ in _found(suffixes, b.column(column)):
                keep[[start + int(t) for t in spans]] = False
            yield b.filter(pa.array(keep))
    return run


def _merge(batches):
    """Per document: words covered by any window, item ids, longest match."""
    for b in batches:
        hit, items, best = [], [], []
        for spans, ids, longest in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
            total = end = 0
            if spans:
                both = np.concatenate([np.frombuffer(x, np.int64).reshape(2, -1) for x in spans], axis=1)
                for lo, hi in both[:, np.lexsort(both[::-1])].T.tolist():
                    total += max(0, hi - max(lo, end))
                    end = max(end, hi)
            hit.append(total)
            items.append(sorted({x for part in ids for x in part}))
            best.append(max((int(np.frombuffer(x, np.int64)[0]) for x in longest), default=0))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(best, pa.int64())],
            names=["id", "n_words", "n_hit", "items", "longest"])


def _item_words(batches):
    """Word hashes of every item text."""
    for b in batches:
        for start, stop in W.pieces(b.column(2)):
            data, offsets = W.text_bytes(b.column(2).slice(start, stop - start))
            s, e, first = W.spans(data, offsets, W.ALNUM)
            h = W.word_hashes(data, s, e)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(start, stop - start), b.column(1).slice(start, stop - start), pa.array(np.diff(first)),
                 pa.array([h[i:j].tobytes() for i, j in zip(first[:-1], first[1:])], pa.binary())], names=["no", "id", "n", "words"])


class Blocks:
    """The items' words in a table, dealt into blocks of about ``block_words``."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str, window: int, block_words: int, scratch: Scratch):
        self.window, self.context = window, items.sparkSession.sparkContext
        rows = items.select(F.monotonically_increasing_id().alias("no"), F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
        self.table = scratch.save(rows.mapInArrow(_item_words, "no long, id string, n long, words binary").where("n > 0"), "items")
        total = self.table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.count = max(1, -(-int(total) // block_words))

    def broadcast(self, k: int):
        """Block ``k`` for the tasks; the caller destroys it after use."""
        rows = self.table.where(F.pmod(F.xxhash64("no"), F.lit(self.count)) == k).toArrow()
        parts = [np.frombuffer(x, np.uint64) for x in rows.column("words").to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        h = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        return self.context.broadcast(Suffixes(h, first, rows.column("id").to_pylist(), self.window))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
            item_text: str = "text", window: int = 10, block_words: int = 4_000_000) -> DataFrame:
    """Rows (id, n_words, n_hit, items, longest) for every document row.

    ``n_hit``: document words inside any occurrence of a window; ``items``:
    ids of the items with occurring windows, sorted; ``longest``: words of
    the longest verbatim match found through them.
    """
    scratch = Scratch(docs.sparkSession, "decontam")
    blocks = Blocks(items, item_id, item_text, window, block_words, scratch)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    schema = f"row long, id {id_type}, {FOUND}"
    if blocks.count == 1:
        found = d.select(F.lit(0).cast("long").alias("row"), "id", "text").mapInArrow(_search(blocks.broadcast(0)), schema)
        found = found.select("id", "n_words", *[F.expr(f"if({c} is null, array(), array({c}))").alias(c) for c in ("spans", "items", "best")])
    else:
        # a row number that every pass sees alike
        d = scratch.save(d.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "rows")
        passes = []
        for k in range(blocks.count):
            block = blocks.broadcast(k)
            passes.append(scratch.save(d.mapInArrow(_search(block), schema), f"found-{k}"))
            block.destroy()
        found = reduce(DataFrame.unionByName, passes)
        found = found.groupBy("row", "id").agg(F.max("n_words").alias("n_words"), *[F.collect_list(c).alias(c) for c in ("spans", "items", "best")]).drop("row")
    kind = items.schema[item_id].dataType
    merged = found.mapInArrow(_merge, f"id {id_type}, n_words long, n_hit long, items array<string>, longest long")
    return merged.withColumn("items", F.array_sort(F.col("items").cast(T.ArrayType(kind))))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, block_words: int = 4_000_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no occurrence
    of an item window.  With several blocks each pass writes the numbers of
    the rows it would drop, and all of them go at the end."""
    scratch = Scratch(docs.sparkSession, "clean")
    blocks = Blocks(items, item_id, item_text, window, block_words, scratch)
    if blocks.count == 1:
        return docs.mapInArrow(_clean(blocks.broadcast(0), docs.columns.index(text_col)), docs.schema)
    rows = scratch.save(packed(docs, row=F.monotonically_increasing_id(), text=F.col(text_col).cast("string")), "rows")
    passes = []
    for k in range(blocks.count):
        block = blocks.broadcast(k)
        passes.append(scratch.save(rows.select("row", "text").mapInArrow(_flagged(block), "row long"), f"flagged-{k}"))
        block.destroy()
    return rows.join(reduce(DataFrame.unionByName, passes).distinct(), "row", "left_anti").select(*unpacked(docs.columns))
