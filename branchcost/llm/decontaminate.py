"""Benchmark decontamination with one Aho-Corasick automaton.

The benchmark's texts (questions and answers) are normalised to words, every
window of `window` consecutive words becomes a pattern, and one automaton
over all patterns scans each normalised document once. Matches are mapped
back to word numbers and to code-point offsets of the original text.

Normalising: A-Z in lower case, words are runs of characters other than
ASCII punctuation, controls and blanks. The automaton's letters are word
numbers in two digits, so a window costs at most two nodes for each of its
words and a pattern can match whole words only.

The documents are scanned where they are, without a shuffle or a rewrite.
What is broadcast is the benchmark. The nodes that it can take are counted
first; above `shard_nodes` it is dealt into shards, a long item in pieces
that overlap by a window less one word. A task then holds at most
`HELD_BYTES` of text at a time and lets one shard's automaton after the other
scan it, so it never has more than one automaton.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchcost.llm.common import free_name

WINDOW = 13
SHARD_NODES = 2_000_000
PIECE = 4_096  # windows
HELD_BYTES = 64 << 20

#: UTF-8 bytes: A-Z to a-z, the remaining ASCII but digits and letters to a blank.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

HIT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hits", T.ArrayType(T.LongType())),  # first and last+1 word of each hit run, flat
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StringType())),  # start:end in the original text
    ]
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_BYTES).split() if text else []


class Matcher:
    """Automaton over the word numbers of all windows; its values are (words, item ids).

    A node's children are searched one by one, so a word number is written in
    two digits of about the square root of the vocabulary, the low ones from
    an alphabet of their own: a pattern still starts and ends at a word.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        vocabulary = list(dict.fromkeys(w for _, words in items for w in words))
        base = math.isqrt(len(vocabulary)) + 1
        self.digits = {w: (i // base, base + i % base) for i, w in enumerate(vocabulary)}
        self.unknown = (2 * base, 2 * base)
        patterns: dict[tuple[bytes, ...], set[str]] = {}
        for item_id, words in items:
            for i in range(max(1, len(words) - window + 1) if words else 0):
                patterns.setdefault(tuple(words[i : i + window]), set()).add(item_id)
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for p, ids in patterns.items():
            self.auto.add_word(self._letters(p), (len(p), ids))
        if patterns:
            self.auto.make_automaton()

    def _letters(self, words) -> tuple[int, ...]:
        digits, unknown = self.digits, self.unknown
        return tuple([d for w in words for d in digits.get(w, unknown)])

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs (first word, last + 1) and items of all windows in `words`."""
        runs: list[tuple[int, int]] = []
        ids: set[str] = set()
        if words and self.digits:
            for at, (n, found) in self.auto.iter(self._letters(words)):
                end = at // 2 + 1
                runs.append((end - n, end))
                ids |= found
        return runs, ids


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(runs):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def hit_row(text: str | None, words: list[bytes], runs: list[tuple[int, int]], items: set[str]) -> tuple:
    """One HIT row of a text from the runs and items that were found in its words."""
    merged = _merge(runs)
    spans = []
    if merged:
        at = [m.span() for m in _WORD.finditer(text)]
        spans = [f"{at[s][0]}:{at[e - 1][1]}" for s, e in merged]
    return len(words), sum(e - s for s, e in merged), [x for r in merged for x in r], sorted(items), spans


def scan(text: str | None, matcher: Matcher) -> tuple:
    words = words_of(text)
    return hit_row(text, words, *matcher.find(words))


_CACHE: dict = {}


def _matcher(broadcast, window: int) -> Matcher:
    """The automaton of a shard; a worker keeps the last one between tasks."""
    key = (id(broadcast.value), window)
    if key not in _CACHE:
        _CACHE.clear()  # before the next one is built; the entry keeps the broadcast value alive
        _CACHE[key] = (Matcher(pickle.loads(zlib.decompress(broadcast.value)), window), broadcast.value)
    return _CACHE[key][0]


def _held(batches: Iterator[pd.Series], limit: int) -> Iterator[list[pd.Series]]:
    """Batches in lists of about `limit` characters (a larger batch is alone in its own)."""
    held, size = [], 0
    for b in batches:
        n = int(b.str.len().sum())
        if held and size + n > limit:
            yield held
            held, size = [], 0
        held.append(b)
        size += n
    if held:
        yield held


def _scan_udf(shards: list, window: int):
    @F.pandas_udf(HIT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if len(shards) == 1:
            matcher = _matcher(shards[0], window)
            for b in batches:
                yield pd.DataFrame([scan(t, matcher) for t in b], columns=HIT.names)
            return
        for held in _held(batches, HELD_BYTES):
            found: list[list] = [[([], set()) for _ in b] for b in held]
            for shard in shards:
                matcher = _matcher(shard, window)
                for b, hits in zip(held, found):
                    for text, (runs, items) in zip(b, hits):
                        more, ids = matcher.find(words_of(text))
                        runs += more
                        items |= ids
            for b, hits in zip(held, found):
                rows = [hit_row(t, words_of(t), *h) for t, h in zip(b, hits)]
                yield pd.DataFrame(rows, columns=HIT.names)

    return run


def pieces(items: DataFrame, window: int) -> DataFrame:
    """(item, words, nodes): the words of each item, in pieces of at most `PIECE` windows that overlap by window - 1 words."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for item, body in zip(b["item"], b["body"]):
                words = words_of(body)
                for i in range(0, max(1, len(words) - window + 1) if words else 0, PIECE):
                    part = words[i : i + PIECE + window - 1]
                    out.append((item, part, 2 * max(1, len(part) - window + 1) * min(window, len(part))))
            yield pd.DataFrame(out, columns=["item", "words", "nodes"])

    return items.mapInPandas(cut, "item string, words array<binary>, nodes bigint")


def with_hits(
    docs: DataFrame,
    bench: DataFrame,
    out: str,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """`docs` with the struct column `out` (HIT): words, hit words, hit runs, items, spans.

    An item of fewer than `window` words, but not none, is one window. A
    null or empty text has no words, on either side; items without an id
    take no part; repeated items count once. All columns of `docs` stay;
    `out` must not be one of them.
    """
    spark = docs.sparkSession
    items = bench.select(
        F.col(item_id_col).cast("string").alias("item"), F.col(item_text_col).alias("body")
    ).where("item IS NOT NULL AND body IS NOT NULL")
    parts = pieces(items.distinct(), window)
    nodes = parts.agg(F.sum("nodes")).first()[0] or 0
    n = max(1, -(-nodes // shard_nodes))
    shards = []
    for k in range(n):
        part = parts.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k) if n > 1 else parts
        rows = sorted((r["item"], [bytes(w) for w in r["words"]]) for r in part.select("item", "words").collect())
        shards.append(spark.sparkContext.broadcast(zlib.compress(pickle.dumps(rows))))
    return docs.withColumn(out, _scan_udf(shards, window)(F.col(text_col)))


def is_contaminated(hit: Column) -> Column:
    return (hit["n_hit"] > 0) & (hit["n_hit"] * 20 >= hit["n_words"])


def drop_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with the columns of `docs`."""
    out = free_name(docs, "hit")
    return with_hits(docs, bench, out, text_col).where(~is_contaminated(F.col(out))).drop(out)


def items_digest(items: Column) -> Column:
    """Lower-case hex SHA-256 of the ids, sorted as strings and comma-joined."""
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)


def digest_of(ids) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
