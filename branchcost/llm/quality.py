"""Quality classifier: supervised subword embeddings.

Every word and every character n-gram is hashed into `buckets` rows of an
embedding table; so is the pair of a word with itself, as one n-gram for all
words, since pairs hashed word by word do not carry over to words that the
sample lacks. A document is the average of its rows, followed by a linear
layer and softmax; table and layer are learned together by stochastic gradient
descent in numpy on a bounded sample of labelled rows (`per_class` of each
class, weighted back to the true shares).
The sample's texts are hashed where they are; what the driver collects is a
bag of at most `buckets` numbers for each row.

To score, the linear layer is applied to the table once, so a document's
logit is the average of one number per feature; that list is what is
broadcast (`buckets` numbers), and scoring is one narrow pass over the
whole texts. Texts are hashed in pieces of `PIECE` characters, so a very long
text needs no more memory than a piece; an open word, the word before and the
last characters are carried over, so the features do not depend on the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchcost.llm.labelled import training_ids

PER_CLASS = 2_000
BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4)
EPOCHS = 6
RATE = 0.5
PIECE = 1 << 20  # characters
SEED = 7
REPEAT = 12_345  # bucket of the pair of a word with itself

_MULT = 0x9E3779B97F4A7C15
_ODD = 0xD6E8FEB86659FD93
_INVERSE = pow(_ODD, -1, 1 << 64)
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_ODD, PIECE + 1)
_INV = _powers(_INVERSE, PIECE + 1)


def _codes(text: str) -> np.ndarray:
    """Code points, A-Z in lower case."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((raw >= 0x41) & (raw <= 0x5A), raw + np.uint32(32), raw)


def _in_word(raw: np.ndarray) -> np.ndarray:
    return (raw >= 0x80) | ((raw >= 0x30) & (raw <= 0x39)) | ((raw >= 0x61) & (raw <= 0x7A))


def _mix(h: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * np.uint64(_MULT)
    h ^= h >> np.uint64(29)
    h *= np.uint64(_ODD)
    return (h >> np.uint64(40)).astype(np.int64) % buckets


def _grams(raw: np.ndarray, k: int, buckets: int) -> np.ndarray:
    n = len(raw)
    code = raw.astype(np.uint64) + np.uint64(1)
    h = code[: n - k + 1].copy()
    for j in range(1, k):
        h = h * np.uint64(0x100000001B3) + code[j : n - k + 1 + j]
    return _mix(h, k, buckets)


def _word_hashes(raw: np.ndarray, open_word: tuple[int, int], last: bool) -> tuple[np.ndarray, tuple[int, int]]:
    """Hashes of the words that end in this piece, and (hash, length) of the one that is open at its end.

    A word's hash is the sum of code * ODD**place, so those of a piece are
    differences of one prefix sum modulo 2**64.
    """
    carried, length = open_word
    inside = np.concatenate([[False], _in_word(raw), [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    code = raw.astype(np.uint64) + np.uint64(1)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * _POW[: len(raw)], dtype=np.uint64)])
    words = (prefix[end] - prefix[start]) * _INV[start]
    lengths = end - start
    if length and inside[1]:  # the open word goes on
        words[0] = np.uint64((carried + int(words[0]) * pow(_ODD, length, 1 << 64)) & _MASK)
        lengths[0] += length
    elif length:
        words, lengths = np.append(np.uint64(carried), words), np.append(length, lengths)
    if not last and inside[-2]:
        return words[:-1], (int(words[-1]), int(lengths[-1]))
    return words, (0, 0)


def hashed_features(text: str | None, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Arrays of bucket numbers of a text's features, piece by piece."""
    tail, before = np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    open_word = (0, 0)
    for at in range(0, len(text or ""), PIECE):
        raw = _codes(text[at : at + PIECE])
        for k in GRAMS:  # character n-grams that end in this piece, blanks included
            joined = np.concatenate([tail[max(0, len(tail) - k + 1) :], raw])
            if len(joined) >= k:
                yield _grams(joined, k, buckets)
        tail = np.concatenate([tail, raw])[-max(GRAMS) + 1 :]
        words, open_word = _word_hashes(raw, open_word, at + PIECE >= len(text))
        if len(words):
            yield _mix(words, 101, buckets)
            chain = np.concatenate([before, words])
            # the pair of a word with itself is one n-gram for all words
            yield np.full(int((chain[1:] == chain[:-1]).sum()), REPEAT % buckets, np.int64)
            before = words[-1:]


def bag_of(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, their shares) of a text's features."""
    counts = np.zeros(buckets, np.int64)
    for idx in hashed_features(text, buckets):
        counts += np.bincount(idx, minlength=buckets)
    idx = np.flatnonzero(counts)
    return idx.astype(np.int32), (counts[idx] / max(1, counts.sum())).astype(np.float32)


@dataclass
class Model:
    logits: np.ndarray  # per bucket: score of class 1 minus score of class 0
    bias: float


def fit(texts: list[str | None], labels: list[int], weights: dict[int, float], buckets: int = BUCKETS) -> Model:
    """Train on texts in memory."""
    return fit_bags([bag_of(t, buckets) for t in texts], labels, weights, buckets)


def fit_bags(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], weights: dict[int, float], buckets: int = BUCKETS) -> Model:
    rng = np.random.default_rng(SEED)
    table = (rng.random((buckets, DIM), dtype=np.float32) - 0.5) / DIM
    layer = np.zeros((DIM, 2), np.float32)
    prior = np.array([max(weights[y] * labels.count(y), 0.5) for y in (0, 1)])
    bias = np.log(prior / prior.sum()).astype(np.float32)
    mean_weight = sum(weights[y] for y in labels) / max(1, len(labels))
    total, step = EPOCHS * max(1, len(bags)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            idx, share = bags[i]
            rate = RATE * (1 - step / total)
            step += 1
            hidden = share @ table[idx]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= min(2.0, weights[labels[i]] / mean_weight)
            back = layer @ p
            # rows move by their share, scaled so that long texts learn as fast as short ones
            table[idx] -= rate * np.outer(share * len(idx) ** 0.5, back)
            layer -= rate * 4 * np.outer(hidden, p)
            bias -= rate * 0.1 * p
    diff = layer[:, 1] - layer[:, 0]
    return Model((table @ diff).astype(np.float32), float(bias[1] - bias[0]))


def train_model(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | bool = True,
    per_class: int = PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Learn from at most `per_class` labelled rows of each class for which `train` holds.

    Without labelled rows of both classes every document gets the share of
    label 1 (one half without any).
    """
    cond = train if isinstance(train, Column) else F.lit(train)
    ids, weights = training_ids(labels, label_col, cond, per_class, id_col)

    def bags(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [bag_of(t) for t in texts]
            yield pd.DataFrame({"idx": [i.tobytes() for i, _ in found], "share": [x.tobytes() for _, x in found]})

    bag = F.pandas_udf(bags, "idx binary, share binary")  # 8 bytes a feature, on the driver too
    rows = (
        docs.select(F.col(id_col).alias("train_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(ids), "train_id")
        .select("train_label", F.xxhash64("train_id").alias("o"), F.xxhash64("text").alias("t"), bag("text").alias("bag"))
        .orderBy("o", "t", "train_label")
        .limit(2 * per_class)  # the bound holds for repeated rows too
        .collect()
    )
    found = [(np.frombuffer(r["bag"]["idx"], np.int32), np.frombuffer(r["bag"]["share"], np.float32)) for r in rows]
    return fit_bags(found, [r["train_label"] for r in rows], weights)


def score(text: str | None, model: Model) -> float:
    total, n = 0.0, 0
    for idx in hashed_features(text, len(model.logits)):
        total += float(model.logits[idx].sum())
        n += len(idx)
    z = model.bias + (total / n if n else 0.0)
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def score_column(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Score of each text, 0 to 1; empty and null texts get the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([score(t, shared.value) for t in texts], dtype="float64")

    return run(F.col(text_col))
