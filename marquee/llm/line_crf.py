"""Document quality from a linear-chain conditional random field over lines.

Every line (text between line ends) is good or bad.  Its features are
counts of its characters and words read as shares and cut at fixed
thresholds, the same of the line before and after it, and whether the line
occurs elsewhere in the text.  The field has a weight for each (feature,
label), for each pair of neighbouring labels, and for the first and last
label.  Forward and backward messages are products of 2 x 2 matrices, taken
by doubling over all lines of a batch at once, so that a text of many lines
needs few steps; they give each line's marginal probability of being good.

A document's good share is the mean of its marginals, weighted by the
length of the lines.  A logistic function of it, fitted on the same rows,
is the score.

Only documents are labelled, so the labels of lines are learned in turns:
lines of good documents are good; lines of bad documents are bad at first,
then those whose marginal under the fitted field is over a half become good,
except the worst line of each document, and the field is fitted again.

Learning uses labelled rows whose crc32(id as text) mod 3 is not 1: of
these, ``fit_rows`` documents and ``fit_lines`` lines at most, in the order
of a hash of their ids.  Everything else covers every whole text.

Cases: NULL and empty texts have no lines and score the learned share of
good documents (0.5 where nothing was learned); without labelled rows, or
with one class only, fixed weights are used; labels with NULL quality or id
are not used; a document labelled twice counts once for each label; NULL
ids are scored, never learned from; repeated rows are scored alike; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import words as W

LETTER, UPPER, DIGIT, SPACE, MARK = 1, 2, 4, 8, 16
_CLASS: list[np.ndarray] = []

#: Shares of a line and the thresholds they are cut at.
CUTS = {
    "upper": (0.1, 0.25, 0.5, 0.8), "digit": (0.05, 0.15, 0.35), "mark": (0.03, 0.06, 0.1, 0.15, 0.25, 0.4), "space": (0.08, 0.14, 0.2, 0.3),
    "letter": (0.5, 0.65, 0.75, 0.85), "double": (0.01, 0.05, 0.15), "bar": (0.01, 0.03, 0.08), "word": (2.5, 4.0, 6.0, 9.0, 14.0),
    "words": (2.0, 5.0, 12.0, 30.0, 100.0), "stops": (0.02, 0.06, 0.15), "ended": (0.5,), "opened": (0.5,), "blank": (0.5,), "repeated": (0.5,),
}
NAMES = [f"{name}>={cut}" for name, cuts in CUTS.items() for cut in cuts]
#: Of the neighbours: whether there is one, and these shares.
NEAR = ("upper", "mark", "space", "letter", "double", "bar", "words", "repeated")
NEAR_AT = [i for i, name in enumerate(NAMES) if name.split(">=")[0] in NEAR]
SIZE = 1 + len(NAMES) + 2 * (1 + len(NEAR_AT))


def _classes() -> np.ndarray:
    """Bits of every code point's class."""
    if not _CLASS:
        out = np.full(sys.maxunicode + 1, MARK, np.uint8)
        for i in range(sys.maxunicode + 1):
            c = chr(i)
            if c.isalpha():
                out[i] = LETTER | (UPPER if c.isupper() else 0)
            elif c.isdigit():
                out[i] = DIGIT
            elif c.isspace():
                out[i] = SPACE
            elif c > "\x7f" and not c.isprintable():
                out[i] = 0
        _CLASS.append(out)
    return _CLASS[0]


def lines(texts: list[str | None]):
    """Measures of all lines: (values by NAMES order of CUTS, length in code
    points, the text each belongs to).  A line's length is at least 1."""
    raw = np.frombuffer("".join((t or "") + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(raw):
        return np.empty((0, len(CUTS))), np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.cumsum([0] + [len(t or "") + 1 for t in texts])
    end = np.flatnonzero(raw == 10)
    start = np.concatenate([[0], end[:-1] + 1])
    owner = np.searchsorted(edge, start, side="right") - 1
    kind = _classes()[raw]
    kind[end] = 0

    def count(flag):
        c = np.concatenate([[0], np.cumsum(flag)])
        return (c[end] - c[start]).astype(float)
    before = np.concatenate([[10], raw[:-1]])
    n = (end - start).astype(float)
    space = (kind & SPACE) > 0
    begins = ~space & (raw != 10) & (np.concatenate([[True], space[:-1]]) | (before == 10))
    letters, spaces, words = count(kind & LETTER > 0), count(space), count(begins)
    solid = np.maximum(n - spaces, 1)
    # first and last character that is no space
    place = np.where(~space & (raw != 10), np.arange(len(raw)), -1)
    last = np.maximum.accumulate(place)[end]
    nearest = np.where(place >= 0, place, len(raw))
    first = np.minimum.accumulate(nearest[::-1])[::-1][start]
    some = words > 0
    closing, opening = np.zeros(len(n)), np.zeros(len(n))
    closing[some] = np.isin(raw[last[some]], [ord(c) for c in ".!?…:;\"”»"])
    opening[some] = (kind[first[some]] & UPPER) > 0
    # a line's hash: the same line elsewhere in its text
    alike = np.zeros(len(n))
    codes = raw.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    local = (np.arange(len(raw)) - np.repeat(start, end - start + 1)).astype(np.uint64)
    total = np.concatenate([[0], np.cumsum(W.mix(codes + local), dtype=np.uint64)])
    h = total[end] - total[start]
    order = np.lexsort((h, owner))
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    alike[order[1:][same]] = 1
    alike[order[:-1][same]] = 1
    alike[~some] = 0
    value = {
        "upper": count(kind & UPPER > 0) / np.maximum(letters, 1), "digit": count(kind & DIGIT > 0) / solid, "mark": count(kind & MARK > 0) / solid,
        "space": spaces / np.maximum(n, 1), "letter": letters / solid, "double": count((kind & MARK > 0) & (raw == before)) / solid,
        "bar": count(np.isin(raw, [ord("|"), ord("•"), ord("·"), ord("»")])) / solid, "word": solid / np.maximum(words, 1), "words": words,
        "stops": count(np.isin(raw, [ord(c) for c in ".!?"])) / np.maximum(words, 1), "ended": closing, "opened": opening,
        "blank": (~some).astype(float), "repeated": alike,
    }
    return np.column_stack([value[k] for k in CUTS]), np.maximum(end - start, 1), owner


def features(texts: list[str | None]):
    """Rows of 0/1 features of all lines, their lengths and their texts;
    empty texts have no lines."""
    value, length, owner = lines(texts)
    full = np.array([bool(t) for t in texts], bool)
    keep = full[owner] if len(owner) else np.empty(0, bool)
    value, length, owner = value[keep], length[keep], owner[keep]
    own = np.column_stack([value[:, [i]] >= np.array(cuts) for i, cuts in enumerate(CUTS.values())]) if len(value) else np.empty((0, len(NAMES)), bool)
    x = np.zeros((len(value), SIZE), np.float32)
    x[:, 0] = 1
    x[:, 1:1 + len(NAMES)] = own
    if len(x) > 1:
        linked = owner[1:] == owner[:-1]
        at = 1 + len(NAMES)
        x[1:, at] = linked
        x[1:, at + 1:at + 1 + len(NEAR_AT)] = own[:-1, NEAR_AT] & linked[:, None]
        at += 1 + len(NEAR_AT)
        x[:-1, at] = linked
        x[:-1, at + 1:] = own[1:, NEAR_AT] & linked[:, None]
    return x, length, owner


def _products(m: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running products of 2 x 2 matrices from each chain's head on, scaled to
    a largest entry of 1, with the logarithm of the scale; by doubling."""
    scale = m.max(axis=(1, 2))
    m, log = m / scale[:, None, None], np.log(scale)
    reach = np.arange(len(m)) - np.maximum.accumulate(np.where(head, np.arange(len(m)), 0))      # places since the head
    step = 1
    while step <= reach.max(initial=0):
        at = np.flatnonzero(reach >= step)
        p = np.matmul(m[at - step], m[at])
        s = p.max(axis=(1, 2))
        log_at = log[at] + log[at - step] + np.log(s)
        m, log = m.copy(), log.copy()
        m[at], log[at] = p / s[:, None, None], log_at
        step *= 2
    return m, log


def marginals(score: np.ndarray, switch: np.ndarray, ends: np.ndarray, head: np.ndarray):
    """Forward-backward over chains of lines.

    ``score`` (n, 2) of each line's labels, ``switch`` (2, 2) of neighbouring
    labels, ``ends`` (2, 2) of the first and last label, ``head``: first line
    of a chain.  Returns the marginals (n, 2), the sum over places of the
    pair marginals (2, 2) and the log of each chain's normaliser."""
    n = len(score)
    tail = np.append(head[1:], True)
    full = score + np.where(head[:, None], ends[0], 0) + np.where(tail[:, None], ends[1], 0)
    shift = full.max(axis=1)
    e = np.exp(full - shift[:, None])
    t = np.exp(switch)
    # row vector times matrices: the head's matrix has its scores in both rows
    m = np.where(head[:, None, None], e[:, None, :], t[None] * e[:, None, :])
    forward, log = _products(m, head)
    a = forward[:, 0]
    # backward: columns from the tail on, b[i] = t e[i+1] b[i+1]
    back = np.ones((n, 2, 2))
    inner = np.flatnonzero(~tail)
    back[inner] = t[None] * e[inner + 1][:, None, :]
    turned, _ = _products(np.swapaxes(back, 1, 2)[::-1], tail[::-1])
    b = turned[::-1].sum(axis=1)
    p = a * b
    p /= p.sum(axis=1, keepdims=True)
    pair = np.zeros((2, 2))
    if len(inner):
        q = a[inner][:, :, None] * t[None] * (e[inner + 1] * b[inner + 1])[:, None, :]
        pair = (q / q.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    last = np.flatnonzero(tail)
    z = log[last] + np.log(a[last].sum(axis=1)) + np.add.reduceat(shift, np.flatnonzero(head)) if n else np.empty(0)
    return p, pair, z


@dataclass
class Model:
    """Weights of the field (features x labels bad and good), of neighbouring
    and of first and last labels; logistic function of the good share."""

    emit: np.ndarray
    switch: np.ndarray
    ends: np.ndarray
    logistic: tuple[float, float] = (-5.0, 10.0)
    prior: float = 0.5

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Length-weighted share of good lines (NaN: no lines) and line counts."""
        x, length, owner = features(texts)
        count = np.bincount(owner, minlength=len(texts))
        if not len(x):
            return np.full(len(texts), np.nan), count
        head = np.append(True, owner[1:] != owner[:-1])
        p, _, _ = marginals(x @ self.emit, self.switch, self.ends, head)
        with np.errstate(invalid="ignore"):
            return np.bincount(owner, p[:, 1] * length, len(texts)) / np.bincount(owner, length, len(texts)), count

    def grade(self, share: np.ndarray) -> np.ndarray:
        z = self.logistic[0] + self.logistic[1] * np.nan_to_num(share)
        return np.where(np.isnan(share), self.prior, 1 / (1 + np.exp(-np.clip(z, -30, 30))))


def default_model() -> Model:
    """Fixed weights without labels: marks, capitals, bars and repeats are bad."""
    emit = np.zeros((SIZE, 2))
    emit[0, 1] = 2.0
    for name in ("mark>=0.15", "mark>=0.25", "upper>=0.5", "bar>=0.03", "digit>=0.35", "double>=0.05"):
        emit[1 + NAMES.index(name), 0] = 2.0
    return Model(emit, np.array([[0.5, -0.5], [-0.5, 0.5]]), np.zeros((2, 2)))


def train(x: np.ndarray, head: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 60, start: np.ndarray | None = None) -> np.ndarray:
    """Weights of the labelled chains' largest penalised likelihood, by
    limited-memory quasi-Newton steps.  Layout: bad minus good is not fixed;
    emission (features x 2), switch (4), ends (4) in one vector."""
    k = 2 * x.shape[1]
    one = np.eye(2)[y]
    tail = np.append(head[1:], True)
    inner = np.flatnonzero(~tail)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner], y[inner + 1]), 1)
    want = np.concatenate([(x.T @ one).ravel(), seen.ravel(), one[head].sum(axis=0), one[tail].sum(axis=0)])

    def loss(w):
        p, pair, z = marginals(x @ w[:k].reshape(-1, 2), w[k:k + 4].reshape(2, 2), w[k + 4:].reshape(2, 2), head)
        got = np.concatenate([(x.T @ p).ravel(), pair.ravel(), p[head].sum(axis=0), p[tail].sum(axis=0)])
        return z.sum() - want @ w + ridge / 2 * w @ w, got - want + ridge * w
    w = np.zeros(k + 8) if start is None else start.copy()
    f, g = loss(w)
    past: list[tuple] = []
    for _ in range(rounds):
        d, stack = -g.copy(), []
        for s, v, rho in reversed(past):
            c = rho * (s @ d)
            stack.append(c)
            d -= c * v
        if past:
            s, v, rho = past[-1]
            d *= (s @ v) / (v @ v)
        for (s, v, rho), c in zip(past, reversed(stack)):
            d += s * (c - rho * (v @ d))
        if not past:
            d /= max(1.0, np.abs(g).sum())
        step = 1.0
        while step > 1e-6:
            f2, g2 = loss(w + step * d)
            if f2 <= f + 1e-4 * step * (g @ d):
                break
            step /= 2
        else:
            break
        s, v = step * d, g2 - g
        if s @ v > 1e-10:
            past = [*past, (s, v, 1 / (s @ v))][-8:]
        w, gain, f, g = w + s, f - f2, f2, g2
        if gain < 1e-5 * max(1.0, abs(f)):
            break
    return w


def learn(x: np.ndarray, length: np.ndarray, owner: np.ndarray, good: np.ndarray, turns: int = 3) -> Model:
    """A model from the lines of documents labelled good (1) or bad (0)."""
    if not len(x) or len(set(good[owner].tolist())) < 2:
        m = default_model()
        m.prior = float(good.mean()) if len(good) else 0.5
        return m
    head = np.append(True, owner[1:] != owner[:-1])
    x = x.astype(float)
    k = 2 * x.shape[1]
    y, w = good[owner].astype(np.int64), None
    for turn in range(turns):
        w = train(x, head, y, start=w)
        p, _, _ = marginals(x @ w[:k].reshape(-1, 2), w[k:k + 4].reshape(2, 2), w[k + 4:].reshape(2, 2), head)
        order = np.lexsort((p[:, 1], owner))
        worst = np.zeros(len(x), bool)
        worst[order[np.append(True, owner[order][1:] != owner[order][:-1])]] = True
        then = np.where(good[owner] == 1, 1, ((p[:, 1] > 0.5) & ~worst).astype(np.int64))
        if turn == turns - 1 or (then == y).all():
            break
        y = then
    model = Model(w[:k].reshape(-1, 2), w[k:k + 4].reshape(2, 2), w[k + 4:].reshape(2, 2), prior=float(good.mean()))
    share = np.bincount(owner, p[:, 1] * length, len(good)) / np.maximum(np.bincount(owner, length, len(good)), 1)
    some = np.bincount(owner, minlength=len(good)) > 0
    model.logistic = _logistic(share[some], good[some].astype(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Penalised logistic regression of one variable, by Newton steps."""
    a, b = np.column_stack([np.ones(len(x)), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def _line_rows(batches):
    """Packed features of every line of the labelled texts."""
    for b in batches:
        for start, stop in W.pieces(b.column(1), 1 << 20):
            x, length, owner = features(b.column(1).slice(start, stop - start).to_pylist())
            edge = np.searchsorted(owner, np.arange(stop - start + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(start, stop - start), b.column(2).slice(start, stop - start),
                 pa.array([np.packbits(x[i:j].astype(bool), axis=1).tobytes() for i, j in zip(edge[:-1], edge[1:])], pa.binary()),
                 pa.array([length[i:j] for i, j in zip(edge[:-1], edge[1:])], pa.list_(pa.int64()))], names=["order", "y", "x", "length"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        fit_rows: int = 6_000, fit_lines: int = 60_000) -> Model:
    """Learn from labelled rows with crc32(id as text) mod 3 <> 1: the first
    ``fit_rows`` of them by a hash of their ids, and of these as many as have
    no more than ``fit_lines`` lines together."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and id is not null")
    known = known.where(F.crc32(F.col("id").cast("string")) % 3 != 1).distinct()
    known = known.withColumn("order", F.xxhash64(F.col("id").cast("string"))).orderBy("order", "y").limit(fit_rows)
    # at most fit_rows ids: the bound makes the broadcast safe
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known), "id").select("order", "text", "y")
    count = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    # a repeated id brings more rows: the bound is kept whatever the table holds
    sizes = texts.select("order", "y", count.alias("n")).orderBy("order", "y", "n").limit(fit_rows).collect()
    through, within = 0, []
    for r in sizes:
        through += r.n or 0
        if through > fit_lines and within:
            break
        within.append(r.order)
    last = max(within, default=None)
    rows = [] if last is None else texts.where(F.col("order") <= last).mapInArrow(_line_rows, "order long, y int, x binary, length array<long>").limit(fit_rows).collect()
    rows = sorted(rows, key=lambda r: (r.order, r.y, r.x))
    width = -(-SIZE // 8)
    bits = np.frombuffer(b"".join(r.x for r in rows), np.uint8).reshape(-1, width)
    x = np.unpackbits(bits, axis=1)[:, :SIZE].astype(np.float32)
    length = np.concatenate([np.array(r.length, np.int64) for r in rows]) if rows else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r.length) for r in rows]) if rows else np.empty(0, np.int64)
    return learn(x, length, owner, np.array([r.y for r in rows], np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score, good_share, n_lines) of every document."""
    def run(batches):
        for b in batches:
            for start, stop in W.pieces(b.column(1), 1 << 20):
                share, n = model.shares(b.column(1).slice(start, stop - start).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, stop - start), pa.array(model.grade(share)), pa.array(share, mask=np.isnan(share)),
                                                  pa.array(n.astype(np.int64))], names=["id", "score", "good_share", "n_lines"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double, good_share double, n_lines long")
