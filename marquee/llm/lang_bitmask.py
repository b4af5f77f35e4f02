"""Language identification by language-bitmask n-gram filters.

Letter n-grams (n = 3 and 4 code points, words padded by one blank) of the
labelled texts are counted per language.  A bit-sliced Bloom filter stores,
at each of its slots, one bit for every language; an n-gram sets the bits
of all languages that hold it at its ``HASHES`` slots, and the AND of these
slots gives back all languages containing it in one probe.  An n-gram
belongs to a language if its relative frequency there is at least ``share``
of its highest one, so that a few mislabelled or mixed texts do not write
everything into every language.

A text's n-grams are probed, and each language gets the popcount of its
bit.  A filter with fill f answers a foreign n-gram with probability
f ** HASHES; the count h of n probes is corrected to
(h - n * p) / (1 - p).  The language with the highest corrected share wins
(ties: the first in sorted order); the share is the score.

Texts are read in lower case; every code point that is not a letter is a
blank.  Learning uses all rows with text and language whose crc32(id) mod 5
is not 0.  The filter has as many slots as keep the fill of every language
under about a half, by the counted n-grams; the driver and the tasks hold it.

Cases: NULL or empty texts and texts without letters give ``und`` with
score 0, as does every text when nothing was learned; texts none of whose
n-grams is known take the language with the most n-grams, score 0; NULL
ids are held-in rows; repeated rows count each; an empty table gives an
empty result; further columns are ignored.  Languages are kept in masks
of 64 bits, as many as needed.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.store import Scratch
from marquee.llm.words import mix, pieces, trim

SLOT_BITS = 20        # slots of a filter: 2**20 at least
HASHES = 2
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def ngrams(texts: list[str | None], most: int = 1 << 19):
    """Slices of the texts as (start, stop, 64-bit n-gram hashes, their text,
    letters per text)."""
    start = size = 0
    stops = []
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= most:
            stops.append(i + 1)
            size = 0
    if texts and (not stops or stops[-1] < len(texts)):
        stops.append(len(texts))
    for stop in stops:
        lower = [(t or "").lower() for t in texts[start:stop]]
        code = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        edge = np.cumsum([1] + [len(t) + 1 for t in lower])
        letter = _letters()[code]
        c = np.where(letter, code, 32).astype(np.uint64)
        grams, owners = [], []
        for n in (3, 4):
            if len(c) < n:
                continue
            key = np.zeros(len(c) - n + 1, np.uint64)
            inner = np.ones(len(key), bool)
            for j in range(n):
                key = key * np.uint64(0x9E3779B97F4A7C15) + c[j:len(c) - n + 1 + j] + np.uint64(n)
                if 0 < j < n - 1:
                    inner &= letter[j:len(c) - n + 1 + j]
            at = np.flatnonzero(inner)
            grams.append(mix(key[at]))
            owners.append(np.searchsorted(edge, at + 1, side="right") - 1)
        count = np.concatenate([[0], np.cumsum(letter)])
        yield (start, stop, np.concatenate(grams) if grams else np.empty(0, np.uint64),
               np.concatenate(owners) if owners else np.empty(0, np.int64), count[edge[1:] - 1] - count[edge[:-1]])
        start = stop


def _slots(g: np.ndarray, bits: int = SLOT_BITS) -> list[np.ndarray]:
    return [((g >> np.uint64(64 - bits * (i + 1))) & np.uint64((1 << bits) - 1)).astype(np.int64) for i in range(HASHES)]


def slot_bits(n_grams: int) -> int:
    """Bits of a slot number, so that ``n_grams`` n-grams fill at most half of a filter."""
    bits = SLOT_BITS
    while HASHES * n_grams > 0.69 * (1 << bits):
        bits += 1
    if bits * HASHES > 64:
        raise ValueError(f"{n_grams} n-grams of a language need more slots than a 64-bit hash can name")
    return bits


def _counts(batches):
    """n-grams per language: (language, gram, n) summed within a batch slice."""
    for b in batches:
        texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
        names = sorted(set(langs))
        code = np.array([names.index(x) for x in langs], np.int64)
        for start, _, g, owner, _ in ngrams(texts, 1 << 20):
            lang = code[start + owner]
            for i, name in enumerate(names):
                mine = np.sort(g[lang == i])
                if not len(mine):
                    continue
                edge = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1], [True]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(edge) - 1)), pa.array(mine[edge[:-1]].view(np.int64)), pa.array(np.diff(edge))],
                    names=["lang", "gram", "n"])
            trim()


@dataclass
class Filter:
    """Languages (sorted) and one mask array, a word for each slot, for each 64 of them."""

    langs: list[str]
    masks: list[np.ndarray]

    def __post_init__(self):
        size = len(self.masks[0]) if self.masks else 1 << SLOT_BITS
        self.bits = size.bit_length() - 1
        fill = [np.count_nonzero(m & m.dtype.type(1 << (i % 64))) / size for i in range(len(self.langs)) for m in (self.masks[i // 64],)]
        self.false = np.minimum(np.array(fill) ** HASHES, 0.999)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for start, stop, g, owner, letters in ngrams(texts):
            n = stop - start
            at = _slots(g, self.bits)
            words = []
            for m in self.masks:
                w = m[at[0]]
                for a in at[1:]:
                    w = w & m[a]
                words.append(w)
            probes = np.bincount(owner, minlength=n).astype(float)
            share = np.zeros((len(self.langs), n))
            for i, false in enumerate(self.false):
                w = words[i // 64]
                bit = ((w >> w.dtype.type(i % 64)) & w.dtype.type(1)).astype(float)
                hits = np.bincount(owner, bit, n)
                share[i] = np.clip((hits - probes * false) / (1 - false), 0, None) / np.maximum(probes, 1)
            best = share.argmax(axis=0) if self.langs else np.zeros(n, int)
            for i in range(n):
                known = self.langs and letters[i] > 0
                names.append(self.langs[best[i]] if known else "und")
                scores[start + i] = min(1.0, share[best[i], i]) if known else 0.0
        return names, scores


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", share: float = 0.25) -> Filter:
    """Learn the filter from all rows with crc32(id as text) mod 5 <> 0.

    n-grams are summed per language, kept where the language's relative
    frequency is at least ``share`` of the highest, and reduced to slots
    with OR-ed masks.  The number of slots follows the kept n-grams of the
    richest language; the masks reach the driver 2**20 slots at a time."""
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    known = known.where("text is not null and lang is not null").where(F.coalesce(F.crc32("id") % 5 != 0, F.lit(True)))
    counts = (known.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(_counts, "lang string, gram long, n long")
              .groupBy("gram", "lang").agg(F.sum("n").alias("n")))
    langs = sorted(r.lang for r in known.select("lang").distinct().collect())
    if not langs:
        return Filter([], [])
    code = F.element_at(F.create_map(*[x for i, v in enumerate(langs) for x in (F.lit(v), F.lit(i))]), F.col("lang"))
    by_gram = counts.groupBy("gram").agg(F.collect_list(F.struct(code.alias("l"), "n")).alias("in"))
    scratch = Scratch(docs.sparkSession, "langs")
    by_gram = scratch.save(by_gram, "grams")
    total = {r.l: r.n for r in by_gram.select(F.explode("in").alias("e")).groupBy(F.col("e.l").alias("l")).agg(F.sum("e.n").alias("n")).collect()}
    rate = F.create_map(*[x for i in range(len(langs)) for x in (F.lit(i), F.lit(1.0 / max(1, total.get(i, 0))))])
    rated = by_gram.select("gram", F.transform("in", lambda e: F.struct(e["l"].alias("l"), (e["n"] * F.element_at(rate, e["l"])).alias("r"))).alias("in"))
    top = F.array_max(F.transform("in", lambda e: e["r"]))
    kept = rated.withColumn("top", top).select("gram", F.explode("in").alias("e"), "top").where(F.col("e.r") >= share * F.col("top"))
    size = slot_bits(max((r.n for r in kept.groupBy("e.l").agg(F.count("*").alias("n")).collect()), default=0))
    slots = [F.shiftrightunsigned("gram", 64 - size * (i + 1)).bitwiseAND(F.lit((1 << size) - 1)) for i in range(HASHES)]
    bits = (kept.select(F.explode(F.array(*slots)).alias("slot"), (F.col("e.l") / 64).cast("int").alias("word"), (F.col("e.l") % 64).alias("bit"))
            .groupBy("slot", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")))
    wide = lambda n: next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if n <= 8 * t().nbytes)
    masks = [np.zeros(1 << size, wide(min(64, len(langs) - i))) for i in range(0, len(langs), 64)]
    parts = [bits]
    if size > SLOT_BITS:
        bits = scratch.save(bits.withColumn("part", F.shiftright("slot", SLOT_BITS).cast("int")), "bits", partition_by="part")
        parts = [bits.where(F.col("part") == i) for i in range(1 << (size - SLOT_BITS))]
    for part in (b for p in parts for b in p.toArrow().to_batches()):
        slot, word = part.column(0).to_numpy(), part.column(1).to_numpy()
        mask = part.column(2).to_numpy().view(np.uint64)
        for w in range(len(masks)):
            masks[w][slot[word == w]] = mask[word == w].astype(masks[w].dtype)
    scratch.drop()
    return Filter(langs, masks)


def predict(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, lang_pred, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # a byte a slot for up to 8 languages, 8 bytes for each 64

    def run(batches):
        for b in batches:
            for start, stop in pieces(b.column(1)):
                names, scores = shared.value.predict(b.column(1).slice(start, stop - start).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, stop - start), pa.array(names, pa.string()), pa.array(scores)],
                                                 names=["id", "lang_pred", "score"])
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "id long, lang_pred string, score double"))
