"""Toxicity from a lexicon that also catches misspelled terms.

The lexicon is learned from labelled texts.  It is a trie; a word is matched by the
Levenshtein automata of all terms at once, intersected with the trie: a state is the
set of trie nodes that can be reached with their edits so far, and states are
remembered, so most words leave the automaton after a few characters.

Around each hit a window of words tells quotation from abuse: a hit between quotation
marks counts apart, and hits close to one another add up.  Logistic regression turns
these sums into a probability.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import bounded, held_out, map_arrow, stored, utf8
from tillcast.llm.logistic import fit, sigmoid

FIT_MOST = 20_000  # labelled texts the lexicon and the weights are fitted on
LEAST_TEXTS = 3  # toxic texts that hold a term
LEAST_ODDS = 3.0  # log-odds of a term between toxic and other texts
CLOSE, CONTEXT = 4, 12  # words on each side: quotation marks, other hits
CUT = 0.7
QUOTES = "\"'`‘’‚“”„«»‹›"
EDGES = QUOTES + ".,;:!?()[]{}<>|*#$%&/\\~^_=+-…¿¡@"
NAMES = ("plain", "quoted", "fuzzy", "window", "hits", "density")


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """All terms within their edit distance of a word."""

    REMEMBERED = 200_000

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.most = [0]  # edits that some term below a node allows
        self.ends: dict[int, int] = {}
        for k, term in enumerate(terms):
            node, allowed = 0, edits_allowed(term)
            self.most[0] = max(self.most[0], allowed)
            for c in term:
                node = self.children[node].setdefault(c, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.most.append(0)
                self.most[node] = max(self.most[node], allowed)
            self.ends[node] = k
        self.allowed = [edits_allowed(t) for t in terms]
        self._forget()

    def _forget(self) -> None:
        self.start = self._close({0: 0})
        self.steps: dict = {}

    def _close(self, nodes: dict[int, int]) -> frozenset:
        """With the nodes reached by skipping characters of a term."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e < self.most[child] and e + 1 < nodes.get(child, 99):
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(nodes.items())

    def _step(self, state: frozenset, c: str) -> frozenset:
        nodes: dict[int, int] = {}
        for node, e in state:
            if e < self.most[node]:  # a character too many
                nodes[node] = min(e + 1, nodes.get(node, 99))
            for have, child in self.children[node].items():
                cost = e + (have != c)
                if cost <= self.most[child]:
                    nodes[child] = min(cost, nodes.get(child, 99))
        return self._close(nodes)

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term, the first one in a tie."""
        if len(self.steps) > self.REMEMBERED:
            self._forget()
        state = self.start
        for c in word:
            after = self.steps.get((state, c))
            if after is None:
                after = self.steps[(state, c)] = self._step(state, c)
            state = after
            if not state:
                return None
        found = [(e, self.ends[n]) for n, e in state if n in self.ends and e <= self.allowed[self.ends[n]]]
        return min(found)[::-1] if found else None


def normal(word: str) -> str:
    return word.strip(EDGES)


class Matcher:
    """Hits of a text; a task remembers what became of each word."""

    REMEMBERED = 300_000

    def __init__(self, terms: list[tuple[str, float]]):
        self.automaton = Automaton([t for t, _ in terms])
        self.weights = [w for _, w in terms]
        self.known: dict[str, tuple[int, int] | None] = {}

    def features(self, text: str) -> np.ndarray:
        words = text.lower().split()
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > self.REMEMBERED:
            self.known.clear()
            new = set(words)
        for w in new:
            n = normal(w)
            self.known[w] = self.automaton.match(n) if n else None
        out = np.zeros(len(NAMES))
        hits = [(k, m) for k, m in enumerate(map(self.known.__getitem__, words)) if m]
        if not hits:
            return out
        weight = np.array([self.weights[t] * (1.0, 0.5, 0.3)[e] for _, (t, e) in hits])
        place = np.array([k for k, _ in hits])
        total = np.r_[0, np.cumsum(weight)]
        window = total[np.searchsorted(place, place + CONTEXT, "right")] - total[np.searchsorted(place, place - CONTEXT)]
        quoted = np.array([self._quoted(words, k) for k in place])
        fuzzy = np.array([e > 0 for _, (_, e) in hits])
        out[0] = np.log1p(weight[~quoted & ~fuzzy].sum())
        out[1] = np.log1p(weight[quoted].sum())
        out[2] = np.log1p(weight[~quoted & fuzzy].sum())
        out[3] = np.log1p(window[~quoted].max(initial=0))
        out[4] = np.log1p(len(hits))
        out[5] = min(1.0, 10 * len(hits) / len(words))
        return out

    @staticmethod
    def _quoted(words: list[str], k: int) -> bool:
        before = any(w[0] in QUOTES for w in words[max(0, k - CLOSE) : k + 1])
        return before and any(w.rstrip(".,;:!?")[-1:] in (*QUOTES,) for w in words[k : k + CLOSE + 1])


def learned_terms(taught: DataFrame) -> list[tuple[str, float]]:
    """The lexicon from (text, toxic): terms with their log-odds.

    The texts are at most ``FIT_MOST``, which bounds their terms.
    """

    def rows(batch: pa.RecordBatch):
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
            for w in {normal(w) for w in text.decode("utf-8", "replace").lower().split()}:
                if w:
                    counts.setdefault(w, [0, 0])[toxic] += 1
        yield {
            "term": list(counts), "clean": [c for c, _ in counts.values()], "toxic": [t for _, t in counts.values()]
        }

    n1, n0 = taught.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not n1:
        return []
    terms = map_arrow(taught.select("text", "toxic"), rows, "term string, clean long, toxic long")
    terms = terms.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / ((n0 or 0) + 1.0))
    terms = stored(terms.withColumn("odds", odds).where(F.col("toxic") >= LEAST_TEXTS), "terms")
    # by the likelihood ratio, less than one of the terms tested is expected to pass by chance
    held, share = F.col("toxic") + F.col("clean"), n1 / (n1 + (n0 or 0))

    def surprise(n: str, part: float):
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (held * part))).otherwise(0.0)

    sure = surprise("toxic", share) + (surprise("clean", 1 - share) if n0 else F.lit(0.0))
    terms = terms.where((F.col("odds") >= LEAST_ODDS) & (sure >= math.log(max(1, terms.count()))))
    top = terms.orderBy(F.col("odds").desc(), "term").collect()
    return [(r.term, r.odds / top[0].odds) for r in top]


def judged(docs: DataFrame, labels: DataFrame, modulus: int = 3, holdout: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= CUT).

    Labels come from rows whose crc32(doc_id as text) mod ``modulus`` is not ``holdout``,
    at most ``FIT_MOST`` of them; null labels and ids teach nothing, any
    label above 0 means toxic.  Texts without a hit,
    null and empty ones too, share one low score.  Without toxic labels every score is 0.
    """
    known = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    teach = labels.where("toxic is not null and doc_id is not null").where(~held_out("doc_id", modulus, holdout))
    teach = teach.select(F.col("doc_id").cast("long"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    teach = bounded(teach, F.xxhash64(F.lit(4), "doc_id"), FIT_MOST, "doc_id", "toxic")
    taught = stored(known.join(F.broadcast(teach), "doc_id"), "taught")  # bounded by FIT_MOST
    terms = learned_terms(taught)

    def sample(batch: pa.RecordBatch):
        matcher = Matcher(terms)
        x = [matcher.features(t.decode("utf-8", "replace")) for t in utf8(batch.column(0))]
        yield {"x": x, "toxic": batch.column(1)}

    if terms:
        rows = map_arrow(taught.select("text", "toxic"), sample, "x array<double>, toxic int").collect()
        rows = sorted((r.toxic, r.x) for r in rows)  # one order of summation in every run
        x = np.array([r[1] for r in rows])
        y = np.array([r[0] for r in rows], float)
        weights = fit(np.c_[x, np.ones(len(x))], y, penalty=1e-4)
    else:
        weights = np.zeros(len(NAMES) + 1)
        weights[-1] = -40.0
    state: dict = {}

    def scores(batch: pa.RecordBatch):
        matcher = state.get("m") or Matcher(terms)
        state["m"] = matcher
        x = np.stack([matcher.features(t.decode("utf-8", "replace")) for t in utf8(batch.column(1))])
        yield {"doc_id": batch.column(0), "score": sigmoid(x @ weights[:-1] + weights[-1])}

    out = map_arrow(known, scores, "doc_id long, score double")
    return out.select(
        "doc_id",
        held_out("doc_id", modulus, holdout).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
