"""Toxicity scores: fuzzy lexicon matches judged in their context.

1. A lexicon is learned from labelled documents: words, and stems (prefixes
   with several continuations), whose document frequency is far higher in
   toxic documents.
2. The lexicon is a trie. A Levenshtein automaton over it, made
   deterministic as it is used, reads the distinct words of a document: a
   state is the set of (trie node, edits so far) that the characters read
   can reach, so one walk compares a word with every term at once and most
   words fall out after a few characters. Terms of at least `fuzzy_len`
   characters match with one edit, shorter ones exactly, stems exactly.
3. The words around each match are its context window. A window in quotation
   marks, or with a reporting word, is a quotation; words of windows that
   occur in toxic documents more than in others (or less) add their
   log-odds, learned from the same rows.
4. A logistic regression over the document's sums of these scores gives the
   probability.

Learning runs on a bounded sample of labelled rows (`per_class` of each
class); the lexicon is bounded by `max_terms` for stems and words together,
so the model is small and is broadcast. Scoring is one narrow pass.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchcost.llm.common import ascii_lower, free_name, stage_table
from branchcost.llm.labelled import training_ids

PER_CLASS = 8_000
MAX_TERMS = 4_000
MIN_DOCS = 4
MIN_LOG_ODDS = 2.0
MIN_SHARE = 0.6
MIN_RATIO = 28.0
STEM_LENGTHS = (4, 5, 6)
MIN_CONTINUATIONS = 6
FUZZY_LEN = 5
CONTEXT = 6

WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of text in ASCII lower case
_WORD = re.compile(WORD_CLASS)
_QUOTES = re.compile("[\"“”„«»]")
#: Words that introduce reported speech.
REPORTING = frozenset(
    "said says wrote called quoted quote sagte schrieb nannte zitat dit écrit appelé citation dijo escribió llamó cita".split()
)
_TABLE = {c: c + 32 for c in range(0x41, 0x5B)}


class FuzzyTrie:
    """Lexicon trie read through a lazily determinised Levenshtein automaton of one edit."""

    def __init__(self, words, stems=(), fuzzy_len: int = FUZZY_LEN):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        for terms, ends in ((words, self.word), (stems, self.stem)):
            for t in terms:
                node = 0
                for c in t:
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        self.word.append(None)
                        self.stem.append(None)
                    node = self.children[node][c]
                ends[node] = t
        self.fuzzy_len = fuzzy_len
        # nodes below which a term long enough for an edit ends
        self.fuzzy = [False] * len(self.children)
        depth = [0] * len(self.children)
        for node, kids in enumerate(self.children):
            for k in kids.values():
                depth[k] = depth[node] + 1
        for node in reversed(range(len(self.children))):
            own = self.word[node] is not None and depth[node] >= fuzzy_len
            self.fuzzy[node] = own or any(self.fuzzy[k] for k in self.children[node].values())
        self.states: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []  # of each state: character -> state, -1 for none
        self.members: list[frozenset] = []
        self.accept: list[tuple[str, int] | None] = []
        self.prefix: list[str | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        closed = set(pairs)
        for n, e in pairs:  # a term character left out of the word
            if e == 0:
                closed |= {(k, 1) for k in self.children[n].values() if self.fuzzy[k]}
        closed = frozenset((n, e) for n, e in closed if e == 0 or (n, 0) not in closed)
        if not closed:
            return -1
        if closed not in self.states:
            self.states[closed] = len(self.steps)
            self.steps.append({})
            self.members.append(closed)
            ends = [
                (e, self.word[n]) for n, e in closed if self.word[n] and (e == 0 or len(self.word[n]) >= self.fuzzy_len)
            ]
            self.accept.append((min(ends)[1], min(ends)[0]) if ends else None)
            self.prefix.append(next((self.stem[n] for n, e in closed if e == 0 and self.stem[n]), None))
        return self.states[closed]

    def _step(self, state: int, c: str) -> int:
        after: set[tuple[int, int]] = set()
        for n, e in self.members[state]:
            k = self.children[n].get(c)
            if k is not None and (e == 0 or self.fuzzy[k]):
                after.add((k, e))
            if e == 0:
                if self.fuzzy[n]:
                    after.add((n, 1))  # a character too many
                after |= {(x, 1) for d, x in self.children[n].items() if d != c and self.fuzzy[x]}  # another one
        return self._state(after)

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the best match; stems are given as ``stem*``."""
        state, stem = self.start, None
        for c in word:
            steps = self.steps[state]
            nxt = steps.get(c)
            if nxt is None:
                nxt = steps[c] = self._step(state, c)
            if nxt < 0:
                return (stem + "*", 0) if stem else None
            state = nxt
            if stem is None:
                stem = self.prefix[state]
        hit = self.accept[state]
        if hit and (hit[1] == 0 or not stem):
            return hit
        return (stem + "*", 0) if stem else None


@dataclass
class Model:
    terms: dict[str, float]  # words, and stems with a trailing *
    context: dict[str, float] = field(default_factory=dict)
    coefficients: list[float] = field(default_factory=list)
    bias: float = 0.0

    def trie(self) -> FuzzyTrie:
        return FuzzyTrie([t for t in self.terms if t[-1] != "*"], [t[:-1] for t in self.terms if t[-1] == "*"])


N_FEATURES = 7


def find_hits(text: str | None, trie: FuzzyTrie) -> tuple[str, dict[str, tuple[str, int]]]:
    """(ASCII-lowered text, {distinct word: (term, edits)})."""
    low = text.translate(_TABLE) if text else ""
    hits = {}
    for w in set(_WORD.findall(low)):
        m = trie.match(w)
        if m:
            hits[w] = m
    return low, hits


def contexts(low: str, hits: dict, size: int = CONTEXT):
    """For each occurrence of a hit: (word, words of its window, whether quoted)."""
    at = list(_WORD.finditer(low))
    words = [m.group() for m in at]
    for i, w in enumerate(words):
        if w in hits:
            lo, hi = max(0, i - size), min(len(words), i + size + 1)
            before = _QUOTES.search(low, at[lo].start(), at[i].start())
            after = _QUOTES.search(low, at[i].end(), at[hi - 1].end() + 2)
            near = words[lo:i] + words[i + 1 : hi]
            yield w, near, bool(before and after) or any(x in REPORTING for x in near)


def features(low: str, hits: dict, model: Model) -> list[float]:
    exact = fuzzy = quoted = context = 0.0
    weights: dict[str, float] = {}
    if hits:
        for w, near, quote in contexts(low, hits):
            term, edits = hits[w]
            if quote:
                quoted += 1
                continue
            exact += edits == 0
            fuzzy += edits > 0
            weights[term] = max(weights.get(term, 0.0), model.terms[term] / (1 + edits))
            context += sum(model.context.get(x, 0.0) for x in near) / (len(near) or 1)
    return [
        max(weights.values(), default=0.0) / 10,
        math.log1p(sum(weights.values())),
        math.log1p(exact),
        math.log1p(fuzzy),
        math.log1p(quoted),
        math.copysign(math.log1p(abs(context)), context),
        math.log1p(600 * (exact + fuzzy) / (len(low) + 6)),
    ]


def learn_terms(
    train: DataFrame, n_pos: int, n_neg: int, max_terms: int = MAX_TERMS, weights: dict[int, float] | None = None
) -> dict[str, float]:
    """Words and stems (``stem*``) of (text, train_label) rows with their log-odds.

    A term counts once per document. It is taken when its share of toxic
    documents exceeds the sample's base rate beyond chance (likelihood ratio
    of the rows counted), most of its documents are toxic, and, for stems,
    several words continue it. That share and the odds count documents with
    the weight of their class, so they are those of all labelled rows,
    however the classes were sampled; the test of chance counts rows, as a
    weight adds no evidence.
    Spark counts; only the best `max_terms` come to the driver.
    """
    words = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"({WORD_CLASS})"), F.lit(1)))
    bags = train.select("train_label", words.alias("words"))
    starts = F.concat(
        *[F.transform(F.filter("words", lambda w: F.length(w) > n), lambda w: F.substring(w, 1, n)) for n in STEM_LENGTHS]
    )
    count = [F.sum("train_label").alias("pos"), F.count("*").alias("docs")]
    per_word = bags.select("train_label", F.explode("words").alias("term")).groupBy("term").agg(*count)
    kinds = per_word.select(
        F.explode(F.array_compact(F.array(*[F.when(F.length("term") > n, F.substring("term", 1, n)) for n in STEM_LENGTHS]))).alias("term")
    ).groupBy("term").agg(F.count("*").alias("words"))
    per_stem = bags.select("train_label", F.explode(F.array_distinct(starts)).alias("term")).groupBy("term").agg(*count)

    weights = weights or {0: 1.0, 1: 1.0}
    all_pos, all_neg = n_pos * weights[1], n_neg * weights[0]

    def scored(df):
        k, n = F.col("pos").cast("double"), F.col("docs").cast("double")
        pos, neg, base = k * weights[1], (n - k) * weights[0], n_pos / (n_pos + n_neg)
        part = lambda x, share: F.when(x > 0, x * F.log(x / n / share)).otherwise(0.0)
        odds = F.log((pos + 0.5) / (all_pos - pos + 0.5)) - F.log((neg + 0.5) / (all_neg - neg + 0.5))
        return df.where((k >= MIN_DOCS) & (pos >= MIN_SHARE * (pos + neg))).withColumns(
            {"odds": odds, "ratio": 2 * (part(k, base) + part(n - k, 1 - base))}
        ).where((F.col("odds") >= MIN_LOG_ODDS) & (F.col("ratio") >= MIN_RATIO))

    stems = scored(per_stem).join(kinds.where(F.col("words") >= MIN_CONTINUATIONS), "term")
    both = scored(per_word).select("term", "odds").unionByName(
        stems.select(F.concat("term", F.lit("*")).alias("term"), "odds")
    )
    found = {r["term"]: r["odds"] for r in both.orderBy(F.desc("odds"), "term").limit(max_terms).collect()}
    # a word or longer stem below a chosen stem adds nothing
    chosen = {t[:-1] for t in found if t[-1] == "*"}
    covered = lambda t: any(t[:n] in chosen and len(t) > n for n in STEM_LENGTHS)
    return {t: o for t, o in found.items() if not covered(t.rstrip("*"))}


def _fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 1e-3):
    """Weighted logistic regression by Newton's method; (coefficients, bias)."""
    a = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(a.shape[1])
    penalty = l2 * np.eye(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        g = a.T @ (w * (p - y)) / w.sum() + penalty @ beta
        h = (a * (w * p * (1 - p))[:, None]).T @ a / w.sum() + penalty
        step = np.linalg.solve(h, g)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1].tolist(), float(beta[-1])


def train_model(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | bool = True,
    per_class: int = PER_CLASS,
    max_terms: int = MAX_TERMS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Learn a model from the labelled rows for which `train` holds.

    At most `per_class` labelled rows of each class are used. Without a
    positive (or without any) label the lexicon is empty and every document
    gets the smoothed share of positive labels.
    """
    cond = train if isinstance(train, Column) else F.lit(train)
    ids, weights = training_ids(labels, label_col, cond, per_class, id_col)
    sample = docs.select(F.col(id_col).alias("train_id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), "train_id"
    )
    # a copied text is one example; written once, so that nothing that reads the sample reads the corpus again
    sample = stage_table(sample.dropDuplicates(["text", "train_label"]).select("text", "train_label"), "toxicity-sample")
    n = {r["train_label"]: r["n"] for r in sample.groupBy("train_label").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    prior = math.log((weights[1] * n_pos + 0.5) / (weights[0] * n_neg + 0.5))
    if not n_pos or not n_neg:
        return Model({}, bias=max(-6.0, min(6.0, prior)), coefficients=[0.0] * N_FEATURES)
    model = Model(learn_terms(sample, n_pos, n_neg, max_terms, weights))

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, trie = shared.value, shared.value.trie()
        for b in batches:
            rows = [(label, features(*find_hits(t, trie), m)) for t, label in zip(b["text"], b["train_label"])]
            yield pd.DataFrame(rows, columns=["y", "x"])

    def window_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = shared.value.trie()
        for b in batches:
            out: list[tuple] = []
            for text, label in zip(b["text"], b["train_label"]):
                low, hits = find_hits(text, trie)
                near = {x for _, words, _ in contexts(low, hits) for x in words} - set(hits) if hits else ()
                out += [(x, label) for x in near]
            yield pd.DataFrame(out, columns=["term", "label"]).astype({"label": "int32"})

    # context words: odds among documents that hold a hit at all
    around = (
        sample.mapInPandas(window_words, "term string, label int")
        .groupBy("term")
        .agg(F.sum("label").alias("pos"), F.count("*").alias("docs"))
        .where(F.col("docs") >= 5 * MIN_DOCS)
        .orderBy(F.desc("docs"), "term")
        .limit(max_terms)
        .collect()
    )
    toxic = [r["pos"] * weights[1] for r in around]
    clean = [(r["docs"] - r["pos"]) * weights[0] for r in around]
    base = math.log((sum(toxic) + 0.5) / (sum(clean) + 0.5))
    model.context = {r["term"]: math.log((t + 1) / (c + 1)) - base for r, t, c in zip(around, toxic, clean) if c}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = sample.mapInPandas(measure, "y int, x array<double>").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float)
    model.coefficients, model.bias = _fit(x, y, np.where(y == 1, weights[1], weights[0]))
    return model


_TRIES: dict = {}


def score_column(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Score of each text, 0 to 1; a null text scores like an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        if id(m) not in _TRIES:
            _TRIES.clear()
            _TRIES[id(m)] = (m.trie(), m)
        trie = _TRIES[id(m)][0]
        beta = np.array(m.coefficients)
        for texts in batches:
            z = [float(np.dot(features(*find_hits(t, trie), m), beta)) + m.bias for t in texts]
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))), dtype="float64")

    return score(F.col(text_col))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below `threshold`, with the columns of `docs`."""
    out = free_name(docs, "toxicity")
    return docs.withColumn(out, score_column(docs, model, text_col)).where(F.col(out) < threshold).drop(out)
