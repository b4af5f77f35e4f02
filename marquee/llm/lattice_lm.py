"""Subword-lattice language model.

An existing unigram vocabulary (pieces with scores) spans a lattice over
the UTF-8 bytes of every word: an edge is a piece, every byte is an edge of
last resort.  The probability of a word is the sum over all its
segmentations, found by a forward recursion in log space; a document's is
the product over its words and one end symbol, since no piece crosses a
word boundary.

The vocabulary's own scores, normalised once, weigh the edges; ``score``
comes from them alone.  Scores that are log-probabilities are taken as they
are; those of a merge-ordered file (0, -1, -2, ...: places in a list) are
places of Zipf's law.  ``fitted_score`` is the same recursion with weights
fitted to the training documents by one round of expected counts over all
their words (forward-backward).  Pieces themselves are never changed.

``learned_score`` adds one edge a training word to the lattice, from the
word's start to its end: an absolute discount d is taken from the count of
every training word (and of the end), and what it frees goes to the
segmentations into pieces, whose weights are fitted to the distinct training
words, since a new word is more like a rare one than like a frequent one:
P(w) = (max(c - d, 0) + d * V * P(pieces of w)) / N.  The pieces' part is a
distribution over all words and the end, so the probabilities of all tokens
sum to one.

Steps:

1. one pass cuts the documents into blocks of words: each document as codes
   into the block's sorted list of distinct words, each distinct word with
   its count in training documents;
2. words are counted over all blocks (exactly): one row a word;
3. expected counts of pieces over the distinct training words: one row a
   piece and task, so the model has the size of the vocabulary;
4. every distinct word is scored once; scores are joined back to the blocks
   that hold the word (a word of very many blocks is one row on the other
   side, so a skewed part of the join is split), where the documents are
   summed.

A word is known by a 64-bit hash of its lower-cased bytes between steps.

Cases: NULL and empty texts consist of the end alone; words of any length
and any bytes have a positive probability; without training documents all
scores are the vocabulary's; NULL ids are training rows; repeated rows
count each; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import words as W
from marquee.llm.store import Scratch

MARK = "▁"           # word start in the vocabulary; a blank in the lattice
NONE = -np.inf


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, without control and byte pieces."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size())
            if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]


def own_weights(scores: np.ndarray) -> np.ndarray:
    """Weights of pieces from the scores of their file, highest first."""
    if len(scores) > 256 and (scores == np.rint(scores)).all():
        return 1.0 / (scores[0] - scores + 10)             # places in a list
    return np.exp(scores - scores.max(initial=0.0))


@dataclass
class Pieces:
    """Lattice edges: pieces by byte length, sorted by hash, and all bytes.

    Index 0-255 are the bytes, then the pieces, last the end symbol."""

    size: int
    tables: dict          # length -> (sorted hashes, piece indexes)
    logp: np.ndarray
    starts: np.ndarray    # edges that begin with the blank of a word start

    def end_share(self) -> float:
        """Probability that the end, not a word, comes next."""
        end = np.exp(self.logp[-1])
        return float(end / (end + np.exp(self.logp[self.starts]).sum()))

    @staticmethod
    def of(vocabulary: list[tuple[str, float]]) -> Pieces:
        usable = sorted({(p.replace(MARK, " ").encode(), s) for p, s in vocabulary if p and MARK not in p[1:]}, key=lambda x: (-x[1], x[0]))
        seen, lists, scores, starts = set(), {}, [], [b == 32 for b in range(256)]
        for piece, s in usable:
            if piece in seen:
                continue
            seen.add(piece)
            lists.setdefault(len(piece), []).append((piece, 256 + len(scores)))
            scores.append(s)
            starts.append(piece[:1] == b" ")
        own = own_weights(np.array(scores, float))
        # a byte of last resort weighs a thousandth of the lightest piece; the end as much as one piece in 200
        weight = [own.min(initial=1.0) / 1_000] * 256 + own.tolist() + [own.sum() / 200 if len(own) else 1.0]
        tables = {}
        for n, items in lists.items():
            h = np.zeros(len(items), np.uint64)
            raw = np.frombuffer(b"".join(p for p, _ in items), np.uint8).reshape(-1, n)
            for j in range(n):
                h = _roll(h, raw[:, j])
            order = np.argsort(h)
            tables[n] = (h[order], np.array([i for _, i in items])[order])
        w = np.array(weight)
        return Pieces(len(w), tables, np.log(w / w.sum()), np.array(starts + [False]))

    def edges(self, b: np.ndarray) -> dict[int, np.ndarray]:
        """For rows of equally long words: by edge length, the piece index
        that starts at each byte (-1: none)."""
        n, width = b.shape
        out, h = {}, np.zeros((n, width), np.uint64)
        for k in range(1, min(width, max(self.tables, default=1)) + 1):
            h = _roll(h[:, :width - k + 1], b[:, k - 1:])
            if k in self.tables:
                keys, index = self.tables[k]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                out[k] = np.where(keys[at] == h, index[at], -1)
        return out

    def forward(self, b: np.ndarray, edges=None) -> np.ndarray:
        """Log-probability of every prefix of every row."""
        n, width = b.shape
        edges = self.edges(b) if edges is None else edges
        alpha = np.full((n, width + 1), NONE)
        alpha[:, 0] = 0
        weights = {k: np.where(e >= 0, self.logp[e], NONE) for k, e in edges.items()}
        for j in range(1, width + 1):
            a = alpha[:, j - 1] + self.logp[b[:, j - 1]]
            for k, w in weights.items():
                if k <= j:
                    a = np.logaddexp(a, alpha[:, j - k] + w[:, j - k])
            alpha[:, j] = a
        return alpha

    def expected(self, b: np.ndarray, *counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece in the rows, each taken ``count`` times;
        one row of uses for each of several ``counts``."""
        n, width = b.shape
        edges = self.edges(b)
        alpha = self.forward(b, edges)
        beta = np.full((n, width + 1), NONE)
        beta[:, width] = 0
        weights = {k: np.where(e >= 0, self.logp[e], NONE) for k, e in edges.items()}
        for j in range(width - 1, -1, -1):
            a = beta[:, j + 1] + self.logp[b[:, j]]
            for k, w in weights.items():
                if j + k <= width:
                    a = np.logaddexp(a, beta[:, j + k] + w[:, j])
            beta[:, j] = a
        total = alpha[:, width:]
        use = np.exp(alpha[:, :width] + self.logp[b] + beta[:, 1:] - total)
        out = np.array([np.bincount(b.ravel(), (use * c[:, None]).ravel(), self.size) for c in counts])
        for k, e in edges.items():
            use = np.exp(alpha[:, :width - k + 1] + weights[k] + beta[:, k:] - total)
            on = e >= 0
            for o, c in zip(out, counts):
                o += np.bincount(e[on], (use * c[:, None])[on], self.size)
        return out[0] if len(counts) == 1 else out


def _roll(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return h * np.uint64(0x100000001B3) + byte.astype(np.uint64) + np.uint64(1)


def _by_length(words: pa.Array, most: int = 300_000):
    """Rows of equally long words as byte matrices, a blank before each:
    (row numbers, matrix), at most about ``most`` bytes each."""
    words = words.cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    size = np.diff(at)
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for rows in np.split(order, cuts):
        if not len(rows):
            continue
        n = int(size[rows[0]])
        step = max(1, most // (n + 1))
        for i in range(0, len(rows), step):
            part = rows[i:i + step]
            b = np.full((len(part), n + 1), 32, np.uint8)
            b[:, 1:] = data[at[part][:, None] + np.arange(n)]
            yield part, b


def _blocks(mod: int, rest: int):
    """Blocks of documents (codes into sorted distinct words) and their words."""
    def run(batches):
        number = 0
        codec = pa.Codec("zstd")
        for b in batches:
            ids = b.column(0)
            train = np.array([i is None or zlib.crc32(str(i).encode()) % mod != rest for i in ids.to_pylist()], bool)
            for start, stop in W.pieces(b.column(1), 16 << 20):
                hashes, firsts, texts, total = [], [np.zeros(1, np.int64)], [], 0
                for s, e in W.pieces(b.column(1).slice(start, stop - start)):
                    data, offsets = W.text_bytes(b.column(1).slice(start + s, e - s))
                    lo, hi, first = W.spans(data, offsets, W.SPACED)
                    hashes.append(W.word_hashes(data, lo, hi))
                    firsts.append(first[1:] + total)
                    total += len(lo)
                    keep = np.unique(hashes[-1], return_index=True)[1]
                    raw = data.tobytes()
                    texts.append((hashes[-1][keep], [raw[x:y] for x, y in zip(lo[keep].tolist(), hi[keep].tolist())]))
                    del lo, hi, offsets
                h, first = np.concatenate(hashes), np.concatenate(firsts)
                del hashes, data, raw
                known = np.unique(np.concatenate([t[0] for t in texts]))
                word: list = [None] * len(known)
                for t, w in texts:
                    for i, x in zip(np.searchsorted(known, t).tolist(), w):
                        word[i] = x
                del texts
                code = np.searchsorted(known, h).astype(np.int32)
                del h
                mine = np.repeat(train[start:stop], np.diff(first))
                n = np.bincount(code[mine], minlength=len(known))
                block = (TaskContext.get().partitionId() << 32) + number
                number += 1
                raw = code.tobytes()
                packed = codec.compress(raw, asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([ids.slice(start, stop - start).to_pylist()], pa.list_(pa.int64())),
                     pa.array([first.tobytes()], pa.binary()), pa.array([packed], pa.binary()), pa.array([len(raw)], pa.int64()),
                     pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())], names=_BLOCK_NAMES)
                for i in range(0, len(known), 100_000):
                    m = len(known[i:i + 100_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, block, np.int64)), pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()),
                         pa.nulls(m, pa.int64()), pa.array(known[i:i + m].view(np.int64)), pa.array(word[i:i + m], pa.binary()),
                         pa.array(n[i:i + m])], names=_BLOCK_NAMES)
    return run


_BLOCK_NAMES = ["block", "ids", "first", "codes", "raw", "hash", "word", "n"]
_BLOCK_SCHEMA = "block long, ids array<long>, first binary, codes binary, raw long, hash long, word binary, n long"


def _expected(pieces: Pieces):
    def run(batches):
        total = np.zeros((2, pieces.size))                 # by words, by distinct words
        for b in batches:
            count = b.column(1).to_numpy()
            for rows, matrix in _by_length(b.column(0)):
                total += pieces.expected(matrix, count[rows], np.ones(len(rows)))
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(t[used]) for t in total)], names=["piece", "n", "once"])
    return run


def _learned(count, spelt, total: int, distinct: int, discount: float):
    """Natural logarithm of a token's learned probability from its training
    count and the logarithm of its pieces' probability."""
    if not total:
        return spelt
    with np.errstate(divide="ignore"):
        seen = np.log(np.maximum(np.asarray(count) - discount, 0) / total)
    return np.logaddexp(seen, np.log(discount * distinct / total) + spelt)


def _word_scores(own: Pieces, fitted: Pieces, spelling: Pieces, total: int, distinct: int, discount: float):
    """The log-probabilities of distinct words, each scored once."""
    def run(batches):
        for b in batches:
            logp, fit, spelt = np.zeros(b.num_rows), np.zeros(b.num_rows), np.zeros(b.num_rows)
            for rows, matrix in _by_length(b.column(1)):
                edges = own.edges(matrix)
                logp[rows] = own.forward(matrix, edges)[:, -1]
                fit[rows] = fitted.forward(matrix, edges)[:, -1]
                spelt[rows] = spelling.forward(matrix, edges)[:, -1]
            learned = _learned(b.column(2).to_numpy(), spelt, total, distinct, discount)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(logp), pa.array(fit.astype(np.float32)), pa.array(learned.astype(np.float32))],
                                             names=["hash", "c", "logp", "fit", "learned"])
            W.trim()
    return run


def _sum_block(total: int, distinct: int, ends: int, end_logp: float, end_fit: float, end_learned: float):
    """Scores of one block's documents from its words' counts and scores."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "n_tokens", "n_known", "base_score", "score", "fitted_score", "learned_score"]
        order = np.argsort(right["hash"].to_numpy().view(np.uint64))
        c, logp, fit, learned = (right[x].to_numpy()[order] for x in ("c", "logp", "fit", "learned"))
        base = np.log10((c + 1) / (total + distinct + 1))
        out = []
        for i in range(left.num_rows):
            ids, first = left["ids"][i].values, np.frombuffer(left["first"][i].as_buffer(), np.int64)
            code = np.frombuffer(pa.Codec("zstd").decompress(left["codes"][i].as_buffer(), left["raw"][i].as_py()), np.int32)
            text = np.repeat(np.arange(len(ids)), np.diff(first))
            sums = lambda w: np.bincount(text, w[code], len(ids))
            out.append(pa.table([
                ids, pa.array(np.diff(first) + 1), pa.array(sums((c > 0).astype(float)).astype(np.int64) + (ends > 0)),
                pa.array(sums(base) + np.log10((ends + 1) / (total + distinct + 1))),
                pa.array((sums(logp) + end_logp) / np.log(10)), pa.array((sums(fit) + end_fit) / np.log(10)),
                pa.array((sums(learned) + end_learned) / np.log(10))], names=names))
        return pa.concat_tables(out)
    return run


def score(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text",
          mod: int = 7, rest: int = 2, prior: float = 10_000.0) -> DataFrame:
    """Rows (id, n_tokens, n_known, train_tokens, base_score, score, fitted_score, learned_score).

    Documents with crc32(id as text) mod ``mod`` = ``rest`` are held out of
    all counts.  ``prior`` is the weight of the vocabulary's scores against
    the expected counts of the corpus in the fitted models, in pieces."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lattice")
    pieces = Pieces.of(vocabulary)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = scratch.save(d.mapInArrow(_blocks(mod, rest), _BLOCK_SCHEMA), "blocks")
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % mod == rest, F.lit(False))
    ends = d.where(~held).count()

    words = blocks.where("hash is not null")
    distinct = scratch.save(words.groupBy("hash").agg(F.min("word").alias("word"), F.sum("n").alias("c")), "words")
    counted = distinct.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                                            F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")).first()
    total, types = counted.n + ends, counted.v + (ends > 0)

    found = (distinct.where("c > 0").select("word", "c").mapInArrow(_expected(pieces), "piece long, n double, once double")
             .groupBy("piece").agg(F.sum("n").alias("n"), F.sum("once").alias("once")).collect())   # one row a piece
    uses, once = np.exp(pieces.logp) * prior, np.exp(pieces.logp) * prior
    for r in found:
        uses[r.piece] += r.n
        once[r.piece] += r.once
    uses[-1] += ends
    once[-1] += ends > 0
    fitted, spelling = (replace(pieces, logp=np.log(u / u.sum())) for u in (uses, once))
    # the usual estimate from the words that occur once and twice, never 0 or 1
    discount = (counted.once + 0.5) / (counted.once + 2 * counted.twice + 1)
    end_learned = float(_learned(ends, np.log(spelling.end_share()), total, types, discount))

    scored = distinct.select("hash", "word", "c").mapInArrow(_word_scores(pieces, fitted, spelling, total, types, discount),
                                                             "hash long, c long, logp double, fit float, learned float")
    scored = words.select(F.col("block").alias("of"), "hash").join(scored, "hash").select("of", "hash", "c", "logp", "fit", "learned")
    out = (blocks.where("codes is not null").select("block", "ids", "first", "codes", "raw").groupBy("block")
           .cogroup(scored.groupBy("of"))
           .applyInArrow(_sum_block(total, types, ends, float(pieces.logp[-1]), float(fitted.logp[-1]), end_learned),
                         "id long, n_tokens long, n_known long, base_score double, score double, fitted_score double, learned_score double"))
    return out.select("id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", "fitted_score", "learned_score")
