"""Toxicity scores from a learned lexicon, matched with spelling errors and read in context.

Terms are learned from labelled rows: whole words and word beginnings that
occur in toxic documents far more than in others. Words of a document are run
through Levenshtein automata of the terms, intersected with the trie of the
lexicon: states are sets of (trie node, edits) and are built as words need
them. Each hit is weighed by its window: inside quotation marks or beside a
word of reporting it counts as quoted. A misspelled term counts less than the
term. A logistic regression over the sums of plain and quoted hits gives the
score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches, materialize

#: Labelled rows at most that the classifier is fitted on, and terms at most in its lexicon (the strongest).
TRAIN_ROWS = 12_000
TERMS = 2_000
#: Words on either side of a hit that its context is read from.
CONTEXT = 6
THRESHOLD = 0.7
#: Toxic documents that a term, or a word beside one, must have for each clean one.
CLEAN_SHARE = 3
_LEAST_PREFIX, _MOST_PREFIX, _LEAST_FUZZY, _MISSPELLED = 3, 8, 5, 0.7

# Signs that open or close a quotation, and words that report speech.
QUOTES = "\"“”„«»‹›"
REPORTS = frozenset(
    "said says wrote called calls quote quoted quoting word term phrase slur insult reported "
    "dit disait écrit appelé mot terme insulte sagte schrieb nannte wort begriff zitat "
    "dijo escribió llamó palabra término insulto".split()
)
_EDGE = re.compile(r"^[^\w@$*]+|[^\w@$*]+$")


class Automaton:
    """Words within one edit of the lexicon's words, as a lazily built deterministic automaton."""

    def __init__(self, words: dict[str, int], edits: int = 1):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.edits = edits
        for word, number in words.items():
            node = 0
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = self.children[node][c]
            self.ends[node] = number
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The number of a set of (node, edits) closed under leaving out letters of a term; -1 for none."""
        closed, todo = dict(), list(pairs)
        while todo:
            node, e = todo.pop()
            if closed.get(node, self.edits + 1) <= e:
                continue
            closed[node] = e
            if e < self.edits:
                todo += [(child, e + 1) for child in self.children[node].values()]
        if not closed:
            return -1
        key = frozenset(closed.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        following = set()
        for node, e in self.states[state]:
            if c in self.children[node]:
                following.add((self.children[node][c], e))
            if e < self.edits:
                following.add((node, e + 1))
                following.update((child, e + 1) for child in self.children[node].values())
        self.steps[state][c] = found = self._state(following)
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term, or None."""
        state = self.start
        for c in word:
            state = self.steps[state].get(c, -2) if state >= 0 else -1
            if state == -2:
                state = self._resume(word)
                break
            if state < 0:
                return None
        if state < 0:
            return None
        best = min(((e, self.ends[n]) for n, e in self.states[state] if self.ends[n] >= 0), default=None)
        return best and (best[1], best[0])

    def _resume(self, word: str) -> int:
        state = self.start
        for c in word:
            following = self.steps[state].get(c, -2)
            state = self._step(state, c) if following == -2 else following
            if state < 0:
                return -1
        return state


@dataclass
class Model:
    """Lexicon (term, weight; words may be misspelled, beginnings not), ordinary words beside it, regression weights."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    fuzzy: list[str] = field(default_factory=list)
    ordinary: frozenset[str] = frozenset()
    weights: list[float] = field(default_factory=lambda: [-2.0, 0.0, 0.0])

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _ready(self):
        if "_cache" not in self.__dict__:
            self._cache: dict[str, float | None] = {}
            self._automaton = Automaton({w: i for i, w in enumerate(self.fuzzy)})
        return self._cache

    def _look(self, token: str) -> float | None:
        """The weight of a token, less if it is misspelled, or None."""
        word = _EDGE.sub("", token)
        found = None
        if word in self.words:
            found = self.words[word]
        else:
            begun = [self.prefixes.get(word[:n], 0.0) for n in range(_LEAST_PREFIX, min(len(word), _MOST_PREFIX) + 1)]
            if max(begun, default=0.0) > 0:
                found = max(begun)
            if found is None and _LEAST_FUZZY - 1 <= len(word) <= 40 and word not in self.ordinary and (hit := self._automaton.match(word)):
                found = self.words[self.fuzzy[hit[0]]] * (_MISSPELLED if hit[1] else 1.0)
        if len(self._cache) > 400_000:
            self._cache.clear()
        if len(token) <= 64:
            self._cache[token] = found
        return found

    def features(self, text: str) -> tuple[float, float]:
        """Logarithms of the summed weights of plain and of quoted hits."""
        cache = self._ready()
        tokens = text.lower().split()
        sums = [0.0, 0.0]
        for i, token in enumerate(tokens):
            try:
                hit = cache[token]
            except KeyError:
                hit = self._look(token)
            if hit is not None:
                sums[quoted(tokens, i)] += hit
        return tuple(math.log1p(s) for s in sums)

    def score(self, text: str | None) -> float:
        z = self.weights[0]
        if text and (self.words or self.prefixes):
            z += sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def quoted(tokens: list[str], at: int) -> bool:
    """Whether the word stands inside quotation marks or near a word of reporting."""
    low, high = max(0, at - CONTEXT), min(len(tokens), at + CONTEXT + 1)
    before = any(t[0] in QUOTES for t in tokens[low : at + 1])
    after = any(t.rstrip(".,;:!?")[-1:] in QUOTES and t.rstrip(".,;:!?") for t in tokens[at:high])
    if before and after:
        return True
    return any(_EDGE.sub("", t) in REPORTS for t in tokens[max(0, at - 3) : at])


def _terms(text: str) -> set[str]:
    """Distinct words (marked by a final $) and word beginnings of a text."""
    out = set()
    for token in set(text.lower().split()):
        word = _EDGE.sub("", token)
        if len(word) < 4 or len(word) > 40 or not word[0].isalpha():
            continue
        out.add(word + "$")
        for n in range(_LEAST_PREFIX, min(len(word), _MOST_PREFIX) + 1):
            out.add(word[:n])
    return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", toxic: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """A model fitted on at most ``rows`` labelled documents for which ``learn`` (over the key) holds.

    Rows are taken by the hash of their key. A document labelled both ways is
    toxic; null labels, keys and texts are left out. Without a toxic or a clean
    row the model knows no terms and scores every text alike.
    """
    known = labels.where(learn & F.col(f"`{toxic}`").isNotNull() & F.col(f"`{key}`").isNotNull())
    known = known.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max((F.col(f"`{toxic}`") > 0).cast("int")).alias("_toxic"))
    chosen = known.orderBy(F.xxhash64("_key"), "_key").limit(rows)
    texts = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).where("_text IS NOT NULL")
    # Bounded by ``rows``: two numbers each.
    sample = materialize(texts.join(F.broadcast(chosen), "_key").select("_toxic", "_text"), "toxic-sample")
    counts = {bool(r["_toxic"]): r["count"] for r in sample.groupBy("_toxic").count().collect()}
    t_all, c_all = counts.get(True, 0), counts.get(False, 0)
    if not t_all or not c_all:
        return Model(weights=[3.0 if t_all else -3.0, 0.0, 0.0])

    def tally(batch: pa.RecordBatch) -> pa.Table:
        toxic_, clean_ = Counter(), Counter()
        for y, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (toxic_ if y else clean_).update(_terms(x))
        names = list(toxic_.keys() | clean_.keys())
        return pa.table({"term": names, "t": [toxic_[n] for n in names], "c": [clean_[n] for n in names]})

    tallied = map_batches(sample, "term string, t bigint, c bigint", tally).groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    weight = F.log(t / (t_all - F.col("t") + 0.5)) - F.log(c / (c_all - F.col("c") + 0.5))
    sure = weight / F.sqrt(1 / t + 1 / c)
    strong = tallied.where("t >= 4").withColumn("weight", weight).withColumn("sure", sure).where((sure > 3.0) & (F.col("c") * CLEAN_SHARE <= F.col("t")))
    kept = strong.orderBy(F.desc("sure"), "term").limit(TERMS).collect()
    # Of nested beginnings with the same support the longest says most: it is the least likely to begin other words.
    support = {r["term"]: r["t"] for r in kept if not r["term"].endswith("$")}
    nested = {x[:-1] for x, t in support.items() if 20 * t >= 19 * support.get(x[:-1], math.inf)}
    words, prefixes = {}, {}
    for r in sorted(kept, key=lambda r: (len(r["term"]), r["term"])):
        term = r["term"]
        if term.endswith("$"):
            words[term[:-1]] = float(r["weight"])
        elif term not in nested:
            prefixes[term] = float(r["weight"])
    model = Model(words=words, prefixes=prefixes)
    _choose_fuzzy(sample, model)
    return _fit(sample, model)


def _choose_fuzzy(sample: DataFrame, model: Model) -> None:
    """Words that may be misspelled, and the words beside them that are none of their misspellings.

    A word one edit away from a term is ordinary where clean documents hold it
    too often against toxic ones, by the share that is asked of a term. Only
    that word goes; the other misspellings of the term still count.
    """
    model.fuzzy = long = sorted(w for w in model.words if len(w) >= _LEAST_FUZZY)
    if not long:
        return
    terms = frozenset(model.words)

    def near(batch: pa.RecordBatch) -> pa.Table:
        automaton, toxic_, clean_, seen = Automaton({w: i for i, w in enumerate(long)}), Counter(), Counter(), {}
        for y, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set()
            for token in set(x.lower().split()):
                if token not in seen:
                    word = _EDGE.sub("", token)
                    fits = _LEAST_FUZZY - 1 <= len(word) <= 40 and word not in terms
                    seen[token] = word if fits and automaton.match(word) else None
                if seen[token]:
                    found.add(seen[token])
            (toxic_ if y else clean_).update(found)
        names = list(toxic_.keys() | clean_.keys())
        counts = [pa.array([c[n] for n in names], pa.int64()) for c in (toxic_, clean_)]
        return pa.table([pa.array(names, pa.string()), *counts], ["word", "t", "c"])

    rows = map_batches(sample, "word string, t bigint, c bigint", near).groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    model.ordinary = frozenset(r["word"] for r in rows.where(F.col("c") * CLEAN_SHARE > F.col("t")).select("word").collect())


def _fit(sample: DataFrame, model: Model, pull: float = 1.0) -> Model:
    """Logistic regression on the sample's features, drawn towards a prior where hits of a kind are rare."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        made = [model.features(x) for x in batch.column(1).to_pylist()]
        return pa.table([batch.column(0), *[pa.array([m[i] for m in made], pa.float64()) for i in range(2)]], ["y", "a", "b"])

    rows = map_batches(sample, "y int, a double, b double", run).groupBy("y", *[F.round(x, 2).alias(x) for x in "ab"]).count().collect()
    x = np.array([[1.0, r["a"], r["b"]] for r in rows])
    y, n = np.array([r["y"] for r in rows], float), np.array([r["count"] for r in rows], float)
    prior = np.array([-4.0, 3.0, 1.2])
    hold = pull * np.array([0.01, 0.3, 1.0])
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + hold * (w - prior)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(curve, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    model.weights = [round(float(v), 6) for v in w]
    return model


def with_scores(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out`` (0 to 1); a null or empty text gets the score of no hits. All other columns stay."""
    rows = docs.drop(out)
    at = rows.columns.index(text)
    schema = rows.withColumn(out, F.lit(0.0)).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = pa.array([model.score(t) for t in batch.column(at).to_pylist()], pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, out])

    return map_batches(rows, schema, run, 1_000)


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows scored below the threshold, columns as they are."""
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = pa.array([model.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_())
        return batch.filter(keep)

    return map_batches(docs, docs.schema, run, 1_000)


def fold(key: Column) -> Column:
    """Remainder by 3 of the CRC-32 of the key as text; 1 is held out."""
    return F.crc32(key.cast("string")) % 3
