"""Toxicity scores: Levenshtein automata intersected with a lexicon trie, and context windows.

A lexicon of words and word beginnings is kept in a trie. A word is run through the automaton of all
strings within the allowed edits of a term (determinised lazily: one dictionary lookup per character, and
a word that can no longer reach a term is left at once), so misspelled terms are found. Short and rare terms have no
misspellings, and words that clean training texts hold are none. Each hit is
weighed by its context: inside quotation marks or beside a reporting verb (quotation), beside a
second-person word or another hit (abuse). A logistic model turns the sums into a score.

The lexicon and the model are learned from labelled rows only, at most ``MAX_TRAIN`` documents (a fixed
hash order of their ids); half of them choose the terms, the other half fit the model. Scoring covers
every whole text.

Defined results: null and empty texts score as texts without hits; null ids are scored and never train;
repeated ids train once, with the largest label; without usable labels every score is the prior 0.05;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.tables import resident, stage
from plotwise.llm.text import slices

#: Most labelled documents that the lexicon and model are learned from.
MAX_TRAIN = 20_000
#: Least number of toxic training documents that hold a lexicon term, and its least log odds.
MIN_DOCS = 3
MIN_ODDS = 4.0
THRESHOLD = 0.3
PRIOR = 0.05
#: Words on either side of a hit that count as its context.
WINDOW = 8
#: Toxic training documents from which a term's misspellings count, too: those of rarer terms are mostly other words.
FUZZY_DOCS = 8
#: Words and automaton states that a worker remembers (about 150 and 1,000 bytes each).
CACHE_WORDS, CACHE_STATES = 200_000, 50_000

WORD = re.compile(r"\w+")
REPORTING = frozenset("said says wrote writes called calls quoted quote reported word words term sagte schrieb genannt wort dit écrit appelé mot dijo escribió llamó palabra".split())
SECOND_PERSON = frozenset("you your youre yours u ur du dich dir dein ihr euch tu te toi vous votre ton tú ti usted ustedes vos".split())
QUOTES = "\"“”„«»‟"


def allowed_edits(term: str) -> int:
    """Edits within which a word still counts as the term."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class TrieAutomaton:
    """Finds for a word the heaviest lexicon term within its allowed edits.

    A term that ends in ``*`` is a word beginning and is matched exactly, and so are the terms of ``exact``. Configurations are
    (trie node, edits spent), numbered node * 4 + edits; a set of them, packed, is one state of the lazily built automaton.
    """

    def __init__(self, terms: dict[str, float], exact: frozenset = frozenset()):
        self.children: list[dict[str, int]] = [{}]
        self.end: list[float | None] = [None]
        self.begin: list[float | None] = [None]
        self.edits = [0]
        self.most = [0]
        for term, weight in terms.items():
            start = term.endswith("*")
            text, k, node = term.rstrip("*"), 0 if start or term in exact else allowed_edits(term), 0
            if not text:
                continue
            self.most[0] = max(self.most[0], k)
            for ch in text:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.end.append(None)
                    self.begin.append(None)
                    self.edits.append(0)
                    self.most.append(0)
                node = self.children[node][ch]
                self.most[node] = max(self.most[node], k)
            if start:
                self.begin[node] = max(weight, self.begin[node] or 0.0)
            else:
                self.end[node], self.edits[node] = max(weight, self.end[node] or 0.0), k
        self._reset()

    def _reset(self) -> None:
        self.states: list[bytes] = []
        self.number: dict[tuple[bytes, float], int] = {}
        self.step: dict[int, int] = {}  # by state and character
        self.accept: list[tuple[int, float]] = []
        self.begun: list[float] = []
        self.first = self._state({0}, 0.0)

    def _state(self, configs: set[int], begun: float) -> int:
        """The state's number, with term characters skipped (deletions) as far as edits allow; -1: dead."""
        todo = list(configs)
        while todo:
            c = todo.pop()
            node, e = c >> 2, c & 3
            for child in self.children[node].values():
                if e + 1 <= self.most[child] and child << 2 | e + 1 not in configs:
                    configs.add(child << 2 | e + 1)
                    todo.append(child << 2 | e + 1)
        if not configs and not begun:
            return -1
        packed = array("i", sorted(configs)).tobytes()
        at = self.number.get((packed, begun))
        if at is None:
            exact = max((self.end[c >> 2] for c in configs if c & 3 == 0 and self.end[c >> 2]), default=0.0)
            fuzzy = max((self.end[c >> 2] for c in configs if 0 < c & 3 <= self.edits[c >> 2] and self.end[c >> 2]), default=0.0)
            at = self.number[packed, begun] = len(self.states)
            self.states.append(packed)
            self.begun.append(begun)
            self.accept.append((1, exact) if exact else (3, begun) if begun else (2, fuzzy) if fuzzy else (0, 0.0))
        return at

    def _next(self, at: int, ch: str, begun: float) -> int:
        out = set()
        for config in array("i", self.states[at]):
            node, e = config >> 2, config & 3
            if e + 1 <= self.most[node]:
                out.add(node << 2 | e + 1)  # a character too many
            for c, child in self.children[node].items():
                if c == ch:
                    out.add(child << 2 | e)
                elif e + 1 <= self.most[child]:
                    out.add(child << 2 | e + 1)  # another character
        for c in out:
            if c & 3 == 0 and self.begin[c >> 2]:
                begun = max(begun, self.begin[c >> 2])
        return self._state(out, begun)

    def match(self, word: str) -> tuple[int, float]:
        """(0 none, 1 exact, 2 misspelled, 3 beginning; the term's weight)."""
        if len(self.states) > CACHE_STATES:
            self._reset()
        at, steps = self.first, self.step
        for ch in word:
            key = at << 21 | ord(ch)
            to = steps.get(key)
            if to is None:
                to = steps[key] = self._next(at, ch, self.begun[at])
            if to < 0:
                return NO_HIT
            at = to
        return self.accept[at]


N_FEATURES = 7
NO_HIT = (0, 0.0)


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)
    weights: list[float] | None = None
    prior: float = PRIOR
    #: Terms that are only matched exactly, and words that clean texts hold and that are no misspellings.
    exact: frozenset = frozenset()
    clean: frozenset = frozenset()


class Scorer:
    """Feature sums and scores of texts; keeps a bounded memory of words."""

    def __init__(self, model: Model):
        self.model, self.automaton, self.known = model, TrieAutomaton(model.terms, model.exact), {}

    def _hits(self, words: set) -> dict[str, tuple[int, float]]:
        known, match, out = self.known, self.automaton.match, {}
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            got = known.get(w)
            if got is None:
                got = match(w)
                if got[0] == 2 and w in self.model.clean:
                    got = NO_HIT
                known[w] = got
            if got[0]:
                out[w] = got
        return out

    def features(self, text: str | None) -> list[float]:
        """Log sums of weights: plain exact, misspelled, beginnings, quoted, beside second person; density; most."""
        out = [0.0] * N_FEATURES
        if not text or not self.model.terms:
            return out
        low = text.lower()
        words = WORD.findall(low)
        hits = self._hits(set(words))
        if not hits:
            return out
        at = [i for i, w in enumerate(words) if w in hits]
        inside = self._quoted(low, words, at) if any(q in low for q in QUOTES) else set()
        n, close = 0.0, set(at)
        for i in at:
            kind, weight = hits[words[i]]
            around = words[max(0, i - WINDOW) : i + WINDOW + 1]
            if i in inside or any(w in REPORTING for w in around):
                out[3] += weight
                n += 0.3
                continue
            out[kind - 1] += weight
            n += 1.0
            out[6] = max(out[6], weight)
            if any(w in SECOND_PERSON for w in around) or any(j in close for j in range(i - WINDOW, i + WINDOW + 1) if j != i):
                out[4] += weight
        for k in range(5):
            out[k] = float(np.log1p(out[k]))
        out[5] = float(np.log1p(1000.0 * n / len(words)))
        return out

    def misspelt(self, text: str | None) -> str | None:
        """The text with a letter doubled in every exact hit whose misspellings count."""
        if not text:
            return text
        hits = {w for w, (kind, _) in self._hits(set(WORD.findall(text.lower()))).items() if kind == 1 and w not in self.model.exact and allowed_edits(w)}
        return WORD.sub(lambda m: m[0][: len(m[0]) // 2] + m[0][len(m[0]) // 2 - 1 :] if m[0].lower() in hits else m[0], text) if hits else text

    @staticmethod
    def _quoted(low: str, words: list[str], at: list[int]) -> set[int]:
        """Hits that stand between quotation marks on one line."""
        spans = [m.span() for m in re.finditer(r'["“„«][^"“”„«»\n]*["”“»]', low)]
        if not spans:
            return set()
        want, out, k = set(at), set(), 0
        for i, m in enumerate(WORD.finditer(low)):
            if i in want:
                while k < len(spans) and spans[k][1] <= m.start():
                    k += 1
                if k < len(spans) and spans[k][0] < m.start():
                    out.add(i)
        return out

    def score(self, text: str | None) -> float:
        if self.model.weights is None:
            return self.model.prior
        w = self.model.weights
        z = w[-1] + sum(a * b for a, b in zip(w, self.features(text), strict=False))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def _scorer(model: Model) -> Scorer:
    """The process's scorer of ``model``: tasks that follow each other share its words and states."""
    key = hashlib.sha256(repr((sorted(model.terms.items()), model.weights, model.prior, sorted(model.exact), sorted(model.clean))).encode()).hexdigest()
    return resident(("scorer", key), lambda: Scorer(model))


def held_out(doc_id):
    """crc32 of the id's text, mod 4, is 2 (a null id: held out, it never trains)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _terms(text: str | None) -> set[str]:
    """Distinct words and word beginnings of a text."""
    words = set(WORD.findall((text or "").lower()))
    return words | {f"{w[:k]}*" for w in words for k in (3, 4, 5, 6) if len(w) > k}


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per (term, label), summed within slices: each slice gives each term once."""
    for b in slices(batches):
        sums: dict[str, list[int]] = {}
        for text, label in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            for t in _terms(text):
                sums.setdefault(t, [0, 0])[label] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v[1] for v in sums.values()], pa.int64()), pa.array([v[0] for v in sums.values()], pa.int64())], ["term", "pos", "neg"])


def _near_rows(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for b in slices(batches):
            words = {w for t in b.column("text").to_pylist() for w in WORD.findall((t or "").lower())}
            yield pa.RecordBatch.from_arrays([pa.array([w for w, (kind, _) in scorer._hits(words).items() if kind == 2], pa.string())], ["word"])

    return rows


def prune(terms: dict[str, float]) -> dict[str, float]:
    """``terms`` without the beginnings that change no match: those with a shorter beginning of at least their weight.
    Every word stays, so its misspellings count."""
    def idle(term):
        return term.endswith("*") and any(terms.get(f"{term[:k]}*", -1.0) >= terms[term] for k in range(1, len(term) - 1))

    return {t: w for t, w in terms.items() if not idle(t)}


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learns lexicon and model from the labelled rows outside the held-out fold."""
    ids = (labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # the sample bound: at most max_train ids, so the list may be broadcast
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    half = F.crc32(F.concat(F.lit("half"), F.col("doc_id").cast("string")).cast("binary")) % 2
    train = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("half", half), "toxic-train")
    counts = (train.filter("half = 0").select("text", "toxic").mapInArrow(_term_rows, "term string, pos long, neg long")
              .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    totals = train.filter("half = 0").groupBy().agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    if not totals["p"] or totals["p"] == totals["n"]:
        return Model()
    p, n = float(totals["p"]), float(totals["n"] - totals["p"])
    odds = F.log((F.col("pos") + 0.1) / (p + 0.2)) - F.log((F.col("neg") + 0.1) / (n + 0.2))
    best = (counts.filter(F.col("pos") >= MIN_DOCS).withColumn("odds", odds).filter(F.col("odds") >= MIN_ODDS)
            .orderBy(F.desc("pos"), F.desc("odds"), "term").collect())  # of at most max_train documents, each term in MIN_DOCS of them
    model = Model(prune({r["term"]: min(float(r["odds"]), 8.0) for r in best}), exact=frozenset(r["term"] for r in best if r["pos"] < FUZZY_DOCS))
    # words within the edits of a term that clean training documents hold
    near = train.filter("half = 0 and toxic = 0").select("text").mapInArrow(_near_rows(model), "word string").distinct().collect()
    model.clean = frozenset(r["word"] for r in near)

    def rows(batches):
        scorer = _scorer(model)
        for b in slices(batches):
            x, y = [], []
            for t, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                for text in {t, scorer.misspelt(t)} if toxic else {t}:
                    x.append(scorer.features(text))
                    y.append(toxic)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32())], ["x", "toxic"])

    # at most twice max_train rows of N_FEATURES numbers: toxic texts also count with their terms misspelt
    sample = train.filter("half = 1").select("text", "toxic").mapInArrow(rows, "x array<double>, toxic int").toPandas()
    if sample.empty or sample["toxic"].nunique() < 2:
        return Model()
    model.weights = fit(np.array(sample["x"].tolist()), sample["toxic"].to_numpy(float)).tolist()
    return model


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, rounds: int = 100) -> np.ndarray:
    """Logistic regression with an L2 penalty (none on the bias, the last weight): Newton steps,
    halved until the loss falls."""
    a = np.column_stack([x, np.ones(len(x))])
    l2 = np.array([penalty] * x.shape[1] + [1e-6])
    w = np.zeros(a.shape[1])
    w[-1] = np.log(y.mean() / (1 - y.mean()))

    def loss(v):
        z = a @ v
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(l2 * v * v))

    now = loss(w)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (q * (1 - q) + 1e-9)[:, None]).T @ a + np.diag(l2), a.T @ (q - y) + l2 * w)
        scale = 1.0
        while scale > 1e-6 and loss(w - scale * step) > now:
            scale /= 2
        new = loss(w - scale * step)
        if now - new < 1e-9:
            break
        w, now = w - scale * step, new
    return w


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, score and predicted for every row; only ``text`` enters the score."""
    given = docs.select(*keep, F.col("text"))
    kept = [given.schema[c] for c in keep]

    def rows(batches):
        scorer = _scorer(model)
        for b in slices(batches):
            s = [scorer.score(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32())], [*keep, "score", "predicted"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["score double", "predicted int"])
    return given.mapInArrow(rows, schema)


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text the model rejects; same columns."""
    def rows(batches):
        scorer = _scorer(model)
        for b in slices(batches):
            yield b.filter(pa.array([scorer.score(t) < threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
