"""Toxicity by a weighted finite-state pattern grammar.

Three transducers over the words of a clause are composed into one:

* *lexicon*: a word becomes an insult, threat, target, negation, report or
  other symbol; insults carry weights learned from labels (whole words and
  stems, log-odds of toxic against clean documents), closed classes are
  fixed word lists;
* *scope*: remembers an open negation, report or target for a few words;
* *reading*: turns an insult or threat into a plain, targeted, negated or
  reported match and multiplies its weight.

The matched clause is what is scored.  Its reading is that of its heaviest
match: the class of the match (strong or weak insult by its learned weight,
threat) and the way it is meant (plain, targeted, negated, reported; a
threat is also targeted by a target that follows it).  Clauses without an
insult or threat match nothing.  A document's features are the numbers of
its clauses by reading, the heaviest clause, and the mean weight of all its
clauses, by the fixed ``VALUE`` of each reading.  A logistic function of
them is fitted on the labelled rows around fixed weights: a reading that the
labels never show keeps its fixed weight.

Words and stems are learned on two thirds of the labelled rows and stay only
if the other third bears them out.

Learning uses labelled rows with crc32(id) mod 5 <> 0: the first
``fit_rows`` of them by a hash of their ids (all if there are fewer);
scoring covers every whole text.

Cases: NULL and empty texts score like a text without matches, under 0.5;
without labelled rows, or with one class only, insults come from the fixed
list and the logistic function from fixed values; labels with NULL toxic
are not used; a document labelled twice counts once for each label;
repeated rows are scored alike; of equally heavy matches the first gives the
clause its reading; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Closed word classes of the grammar.
TARGETS = "you your yours you're u ya he she they them him her these those du dich ihr euch sie er tu toi vous te ton tú te usted ustedes él ella ellos"
NEGATIONS = "not no never neither nor isn't aren't wasn't don't doesn't without nicht kein keine keinen nie niemals ne n'est jamais aucun sin nunca jamás ni tampoco"
REPORTS = "said says say told wrote writes called calls claimed quoted quote allegedly sagte sagt schrieb nannte behauptete dit disait écrit appelle dijo dice escribió llamó según"
THREATS = "kill murder destroy hurt hang shoot burn töten umbringen vernichten tuer détruire matar destruir"
INSULTS = "idiot moron stupid pathetic worthless disgusting loser scum trash clown bastard imbecile"

#: Words for which a negation, report or target stays open.
SCOPE = {"N": 2, "R": 4, "T": 3}
#: What a clause of each reading counts, against a plain strong insult.
VALUE = {
    "strong plain": 1.0, "strong targeted": 1.3, "strong negated": 0.05, "strong reported": 0.15,
    "weak plain": 0.4, "weak targeted": 0.6, "weak negated": 0.0, "weak reported": 0.05,
    "threat plain": 0.3, "threat targeted": 1.3, "threat negated": 0.0, "threat reported": 0.1,
}
STRONG = 2.0          # weight of a strong insult
FEATURES = (*VALUE, "top", "mean")
#: Logistic function without labels, and the middle of the fitted ones: intercept, then FEATURES.
DEFAULT = (-3.0, *[3 * v for v in VALUE.values()], 2.0, 1.0)

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n|]")


@dataclass
class Transducer:
    """step(state, symbol) -> (state, output symbol, weight); start state 0."""

    arcs: dict = field(default_factory=dict)
    start: object = 0

    def step(self, state, symbol):
        return self.arcs[state, symbol]


def compose(a: Transducer, b: Transducer, symbols: str) -> Transducer:
    """The transducer that feeds a's output to b; weights are multiplied."""
    out, todo = Transducer({}, (a.start, b.start)), [(a.start, b.start)]
    seen = set(todo)
    while todo:
        p, q = state = todo.pop()
        for s in symbols:
            p2, middle, w1 = a.step(p, s)
            q2, end, w2 = b.step(q, middle)
            out.arcs[state, s] = ((p2, q2), end, w1 * w2)
            if (p2, q2) not in seen:
                seen.add((p2, q2))
                todo.append((p2, q2))
    return out


def scope_transducer(symbol: str) -> Transducer:
    """Marks insults (I) and threats (H) by whether ``symbol`` was read up to
    SCOPE words before: (mark, symbol) pairs pass the marks of others on."""
    t = Transducer({}, 0)
    for state in range(SCOPE[symbol] + 1):
        for mark in ("", "N", "R", "T", "NR", "NT", "RT", "NRT"):
            for s in "INHRTO":
                then = SCOPE[symbol] if s == symbol else max(0, state - 1)
                now = "".join(sorted(set(mark) | {symbol})) if state and s in "IH" else mark
                t.arcs[state, (mark, s)] = (then, (now, s), 1.0)
    return t


def reading_transducer() -> Transducer:
    """Final reading of a marked insult or threat."""
    t = Transducer({}, 0)
    for mark in ("", "N", "R", "T", "NR", "NT", "RT", "NRT"):
        for s in "INHRTO":
            if s not in "IH":
                out, w = None, 1.0
            elif "N" in mark:
                out, w = "negated", 1.0
            elif "R" in mark:
                out, w = "reported", 1.0
            elif s == "H":
                out, w = "threat", 2.0 if "T" in mark else 0.5
            else:
                out, w = ("targeted", 1.0) if "T" in mark else ("plain", 1.0)
            t.arcs[0, (mark, s)] = (0, out, w)
    return t


def grammar() -> Transducer:
    """lexicon symbols -> readings: negation, report and target scope, then reading."""
    entry = Transducer({(0, s): (0, ("", s), 1.0) for s in "INHRTO"}, 0)
    t = entry
    for s in "NRT":
        t = compose(t, scope_transducer(s), "INHRTO")
    return compose(t, reading_transducer(), "INHRTO")


class Lexicon:
    """Word -> (symbol, weight).  Learned terms are whole words (``word$``)
    or stems; a word takes its strongest term."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.lengths = sorted({len(t) for t in terms if not t.endswith("$")})
        self.fixed = {}
        for symbol, words in (("H", THREATS), ("R", REPORTS), ("N", NEGATIONS), ("T", TARGETS)):
            self.fixed |= {w: (symbol, 1.0) for w in words.split()}
        self.seen: dict[str, tuple[str, float]] = {}

    def look_up(self, word: str) -> tuple[str, float]:
        got = self.seen.get(word)
        if got is None:
            w = max([self.terms.get(word + "$", 0.0), *(self.terms.get(word[:n], 0.0) for n in self.lengths if n <= len(word))])
            got = ("I", w) if w > 0 else self.fixed.get(word, ("O", 0.0))
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[word] = got
        return got


def clauses(text: str, lexicon: Lexicon, machine: Transducer):
    """Matches (reading, weight) of every matched clause, and the number of
    all clauses."""
    out, clause, count = [], [], 0
    open_ = False

    def read():
        state, found = machine.start, []
        for i, (symbol, weight) in enumerate(clause):
            state, end, _ = machine.step(state, symbol)
            if end == "threat":
                aimed = symbol == "H" and any(s == "T" for s, _ in clause[max(0, i - SCOPE["T"]):i + 1 + SCOPE["T"]])
                found.append((end, 2.0 if aimed else 0.5, "threat targeted" if aimed else "threat plain"))
            elif end:
                kind = "threat" if symbol == "H" else "strong" if weight >= STRONG else "weak"
                found.append((end, weight, f"{kind} {end}"))
        return found

    look = lexicon.look_up
    for token in TOKEN.findall(text.lower()):
        if token in ".!?;:\n|":
            count += bool(clause)
            if open_:
                out.append(read())
            clause, open_ = [], False
            continue
        got = look(token)
        clause.append(got)
        open_ |= got[0] in "IH"
    count += bool(clause)
    if open_:
        out.append(read())
    return out, count


def readings(text: str, lexicon: Lexicon, machine: Transducer):
    """(way, weight) of every match, and the number of clauses."""
    found, count = clauses(text, lexicon, machine)
    return [(way, w) for c in found for way, w, _ in c], count


def features(text: str | None, lexicon: Lexicon, machine: Transducer) -> list[float]:
    """Numbers of clauses by reading, the heaviest one and the mean of all."""
    found, count = clauses(text or "", lexicon, machine)
    n = dict.fromkeys(VALUE, 0)
    top = total = 0.0
    for c in found:
        reading = max((r for _, _, r in c), key=VALUE.get)
        n[reading] += 1
        top = max(top, VALUE[reading])
        total += VALUE[reading]
    return [*(math.log1p(v) for v in n.values()), top, total / max(1, count)]


def _terms(shortest: int, longest: int):
    """Documents per term by class (clean, toxic; kept back: clean, toxic),
    counted within each batch."""
    def run(batches):
        for b in batches:
            count: dict[str, list[int]] = {}
            for text, toxic, back in zip(*(c.to_pylist() for c in b.columns)):
                mine = set()
                for w in {x for x in TOKEN.findall((text or "").lower()) if x[0].isalpha()}:
                    mine.add(w + "$")
                    mine.update(w[:n] for n in range(shortest, min(longest, len(w)) + 1))
                for t in mine:
                    count.setdefault(t, [0, 0, 0, 0])[toxic + 2 * back] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.string()), *[pa.array([c[i] for c in count.values()], pa.int64()) for i in range(4)]],
                names=["term", "clean", "toxic", "clean_back", "toxic_back"])
    return run


def learn_terms(sample: DataFrame, min_docs: int, least: float, borne_out: float = 1.0) -> dict[str, float]:
    """Terms by log-odds of their document shares: at least ``least`` where
    they are learned, ``borne_out`` on the rows kept back, and ``least`` on
    all rows with two standard errors taken off."""
    n = {(bool(r.y), bool(r.back)): r.n for r in sample.groupBy("y", "back").agg(F.count("*").alias("n")).collect()}
    pos, neg, pos_back, neg_back = (n.get(k, 0) for k in ((True, False), (False, False), (True, True), (False, True)))
    if not pos + pos_back or not neg + neg_back:
        return {w + "$": STRONG for w in INSULTS.split()}
    c = (sample.select("text", "y", F.col("back").cast("int").alias("back")).mapInArrow(_terms(3, 9), "term string, clean long, toxic long, clean_back long, toxic_back long")
         .groupBy("term").agg(*[F.sum(x).alias(x) for x in ("clean", "toxic", "clean_back", "toxic_back")]))
    odds = lambda t, p, f, q: F.log(((t + 0.5) / (p + 1)) / ((f + 0.5) / (q + 1)))
    toxic, clean, toxic_back, clean_back = (F.col(x) for x in ("toxic", "clean", "toxic_back", "clean_back"))
    if pos and neg:
        c = c.where((toxic >= min_docs) & (odds(toxic, pos, clean, neg) >= least))
    if pos_back and neg_back:
        c = c.where((toxic_back > 0) & (odds(toxic_back, pos_back, clean_back, neg_back) >= borne_out))
    c = c.withColumn("w", odds(toxic + toxic_back, pos + pos_back, clean + clean_back, neg + neg_back))
    c = c.where(F.col("w") - 2 * F.sqrt(1 / (toxic + toxic_back + 0.5) + 1 / (clean + clean_back + 0.5)) >= least)
    return _specific({r.term: (float(r.w), r.n) for r in c.select("term", "w", (toxic + toxic_back).alias("n")).collect()})


def _specific(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Of terms that begin alike: a stem gives way to a longer term that
    stands for nine tenths of its toxic documents; then a longer term goes
    that says no more than a stem that stays."""
    heir: dict[str, int] = {}
    for t, (_, n) in found.items():
        for i in range(3, len(t)):
            heir[t[:i]] = max(heir.get(t[:i], 0), n)
    kept = {t: w for t, (w, n) in found.items() if heir.get(t, 0) < 0.9 * n}
    return {t: w for t, w in kept.items() if not any(kept.get(t[:i], 0.0) >= w for i in range(3, len(t)))}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> tuple[float, ...]:
    """Logistic regression by Newton steps, drawn towards the fixed weights
    (the intercept hardly): what the rows do not show stays as it is."""
    if len(y) == 0 or y.min() == y.max():
        return DEFAULT
    a = np.column_stack([np.ones(len(x)), x])
    middle = np.array(DEFAULT)
    b = middle.copy()
    penalty = np.diag([1e-2] + [ridge] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ (b - middle))
        b += step * min(1.0, 3 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in b)


@dataclass
class Model:
    terms: dict[str, float]
    weights: tuple[float, ...]

    def scorer(self):
        """Function of an Arrow text column that gives its scores."""
        lexicon, machine, w = Lexicon(self.terms), grammar(), self.weights

        def score(column: pa.Array) -> np.ndarray:
            x = np.array([features(t.as_py(), lexicon, machine) for t in column], float).reshape(-1, len(FEATURES))
            return 1 / (1 + np.exp(-np.clip(w[0] + x @ np.array(w[1:]), -30, 30)))
        return score


def _feature_rows(terms: dict[str, float]):
    def run(batches):
        lexicon, machine = Lexicon(terms), grammar()
        for b in batches:
            x = [features(t.as_py(), lexicon, machine) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], names=["x", "y"])
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fit_rows: int = 20_000, min_docs: int = 3, least: float = 1.5) -> Model:
    """Learn the lexicon and the logistic function from labelled rows whose
    crc32(id as text) mod 5 is not 0: the first ``fit_rows`` by a hash."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and id is not null")
    known = known.where(F.crc32(F.col("id").cast("string")) % 5 != 0).distinct()
    mark = F.xxhash64(F.col("id").cast("string"))
    known = known.orderBy(mark, "id", "y").limit(fit_rows).withColumn("back", F.pmod(F.xxhash64(mark), F.lit(3)) == 0)
    # at most fit_rows ids: the bound makes the broadcast safe
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(known), "id").select("text", "y", "back"))
    terms = learn_terms(sample, min_docs, least)
    rows = sample.select("text", "y").mapInArrow(_feature_rows(terms), "x array<double>, y int").collect()
    x = np.array([r.x for r in rows], float).reshape(-1, len(FEATURES))
    return Model(terms, fit_logistic(x, np.array([r.y for r in rows], float)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score) of every document."""
    def run(batches):
        grade = model.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(grade(b.column(1)))], names=["id", "score"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that score under ``threshold``."""
    at = docs.columns.index(text_col)

    def run(batches):
        grade = model.scorer()
        for b in batches:
            yield b.filter(pa.array(grade(b.column(at)) < threshold))
    return docs.mapInArrow(run, docs.schema)
