"""Byte-level BPE encoding and decoding over a public vocabulary.

1. Pre-tokenising without regular expressions. Every code point has a class
   (`code_classes`), and a class is a function from states to states: the
   state says what kind of token the text is in (letters, digits, others,
   blanks, an apostrophe that may begin a contraction). Composition of such
   functions is associative, so the states before all characters of a batch
   come from one scan: the characters are laid out in rows of `ROW`, the
   functions of all rows are composed column by column in numpy, the rows'
   functions are scanned by doubling, and a second walk over the columns
   fills in the states. Boundaries follow from the state before a character,
   its class and what comes behind it.
2. The slices between boundaries are looked up in a cache of merged pieces.
   Those of a scan that are not there are merged pair by pair, lowest rank
   first and leftmost among equals: short ones all together as rows of numpy
   arrays, long ones with a heap (n log n for a piece of n bytes).
3. Ids are kept as packed 32-bit integers with the byte offset at which each
   token starts, so that any range of tokens can be decoded to its place.

The boundaries are those of the pattern of byte-level BPE vocabularies:
contractions ('s 't 're 've 'm 'll 'd), runs of letters, of digits and of
other characters, each with one leading blank, and runs of white space, of
which the last character is left to what follows.

The vocabulary (a file of base64 tokens and ranks, some 50,000 lines) is read
by the driver and broadcast; its size does not depend on the corpus. Encoding
and decoding are narrow passes.
"""

from __future__ import annotations

import base64
import bisect
import heapq
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROW = 64  # characters of a row of the scan
SCAN = 1 << 18  # code points that are scanned at once, or one whole text
CACHED_PIECES = 250_000  # a fuller cache is emptied before the next scan, which adds at most its own pieces
WIDTHS = (8, 16, 32, 64)  # pieces of up to so many bytes are merged together; longer ones alone, with a heap
NO_RANK = (1 << 31) - 1

# classes of code points; END stands between texts
END, LETTER, DIGIT, OTHER, BLANK, SPACE, APOSTROPHE, STMD, RV, E, L = range(11)
# states: none yet, in letters, digits, others, after a blank, after other white space, at an apostrophe
# that starts a token, behind a contraction, at the first letter of 're or 've, of 'll
NONE, IN_LETTERS, IN_DIGITS, IN_OTHERS, AT_BLANK, AT_SPACE, AT_APOSTROPHE, CONTRACTED, AT_RV, AT_L = range(10)
LETTERS = (LETTER, STMD, RV, E, L)

#: The code points of Unicode's White_Space other than the blank.
WHITE_SPACE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

ENCODED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),  # unsigned 32-bit, little-endian
        T.StructField("starts", T.BinaryType()),  # byte offset of each token in the text, unsigned 32-bit, little-endian
    ]
)
DECODED = T.StructField("decoded", T.BinaryType())


@lru_cache(1)
def code_classes() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": DIGIT}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    out[WHITE_SPACE] = SPACE
    out[ord(" ")] = BLANK
    out[ord("'")] = APOSTROPHE
    for letters, kind in (("stmd", STMD), ("rv", RV), ("e", E), ("l", L)):
        out[[ord(c) for c in letters]] = kind
    return out


@lru_cache(1)
def transitions() -> np.ndarray:
    """[class, state before] -> state after."""
    t = np.zeros((11, 10), np.uint8)
    for kind, state in ((END, NONE), (DIGIT, IN_DIGITS), (OTHER, IN_OTHERS), (BLANK, AT_BLANK), (SPACE, AT_SPACE)):
        t[kind] = state
    # others and a blank before it take an apostrophe into their token
    t[APOSTROPHE] = AT_APOSTROPHE
    t[APOSTROPHE, [IN_OTHERS, AT_BLANK, AT_APOSTROPHE]] = IN_OTHERS
    t[list(LETTERS)] = IN_LETTERS
    t[STMD, AT_APOSTROPHE] = CONTRACTED
    t[RV, AT_APOSTROPHE] = AT_RV
    t[L, AT_APOSTROPHE] = AT_L
    t[E, AT_RV] = CONTRACTED
    t[L, AT_L] = CONTRACTED
    return t


@lru_cache(1)
def _starts_token() -> np.ndarray:
    """[class, state before]: whether the character starts a token, but for white space and pending contractions."""
    s = np.ones((11, 10), bool)
    s[DIGIT, [IN_DIGITS, AT_BLANK]] = False
    for kind in (OTHER, APOSTROPHE):
        s[kind, [IN_OTHERS, AT_BLANK, AT_APOSTROPHE]] = False
    for kind in LETTERS:
        s[kind, [IN_LETTERS, AT_BLANK, AT_RV, AT_L]] = False
    s[STMD, AT_APOSTROPHE] = False
    for kind in (BLANK, SPACE):
        s[kind, [AT_BLANK, AT_SPACE]] = False
    return s


def states_after(kinds: np.ndarray) -> np.ndarray:
    """State after each character, by a scan over the composed transition functions."""
    t = transitions().ravel()
    n_states = 10
    rows = -(-len(kinds) // ROW)
    grid = np.zeros((rows, ROW), np.int16)
    grid.ravel()[: len(kinds)] = kinds
    grid *= n_states
    whole = np.tile(np.arange(n_states, dtype=np.int16), (rows, 1))  # function of each row, as its values
    for j in range(ROW):
        whole = t.take(grid[:, j : j + 1] + whole)
    before = whole  # inclusive scan of the rows' functions: f, then g, is g[f]
    step = 1
    while step < rows:
        before = np.concatenate([before[:step], np.take_along_axis(before[step:], before[:-step].astype(np.intp), 1)])
        step *= 2
    state = np.concatenate([[NONE], before[:-1, NONE]]).astype(np.int16)
    out = np.empty((rows, ROW), np.uint8)
    for j in range(ROW):
        state = t.take(grid[:, j] + state)
        out[:, j] = state
    return out.ravel()[: len(kinds)]


def token_starts(kinds: np.ndarray) -> np.ndarray:
    """Whether each character starts a piece (for END: True)."""
    after = states_after(kinds)
    before = np.concatenate([[NONE], after[:-1]]).astype(np.uint8)
    start = _starts_token()[kinds, before]
    behind = np.concatenate([kinds[1:], [END]]).astype(np.uint8)
    white = (kinds == BLANK) | (kinds == SPACE)
    # the last white space of a run is left to what follows, if anything does
    start |= white & ~((behind == BLANK) | (behind == SPACE) | (behind == END))
    # 'r, 'v and 'l are contractions only if their second letter comes
    pending = np.flatnonzero((after == AT_RV) | (after == AT_L))
    done = np.concatenate([after, [NONE]])[pending + 1] == CONTRACTED
    start[pending] = ~done
    return start


def distinct_pieces(data: bytes, cuts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each piece's bytes in the list, list of piece contents); `cuts` are the starts of the pieces.

    Pieces of up to 16 bytes are compared as two numbers each; a content may
    be listed twice.
    """
    length = np.diff(cuts, append=len(data))
    at = np.ndarray((len(data) + 1,), "<u8", data + bytes(16), strides=(1,))
    mask = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
    low = at[cuts] & mask[np.minimum(length, 8)]
    high = at[np.minimum(cuts + 8, len(data))] & mask[np.clip(length - 8, 0, 8)]
    short = np.flatnonzero(length <= 16)
    key = (low[short] * np.uint64(0x9E3779B97F4A7C15)) ^ (high[short] * np.uint64(0xD6E8FEB86659FD93) + length[short].astype(np.uint64))
    order = short[np.argsort(key, kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]]) | (length[order[1:]] != length[order[:-1]])
    number = np.empty(len(cuts), np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    out = [data[a:b] for a, b in zip(cuts[first].tolist(), (cuts + length)[first].tolist())]
    known: dict[bytes, int] = {}
    for i in np.flatnonzero(length > 16).tolist():
        x = data[cuts[i] : cuts[i] + length[i]]
        if x not in known:
            known[x] = len(out)
            out.append(x)
        number[i] = known[x]
    return number, out


def read_ranks(path: str) -> bytes:
    """Content of a rank file: lines of a base64 token, a blank and its rank."""
    with open(path, "rb") as f:
        return f.read()


class Codec:
    """A vocabulary with its caches."""

    def __init__(self, ranks: bytes):
        pairs = [line.split() for line in ranks.splitlines() if line.strip()]
        self.rank = {base64.b64decode(token): int(r) for token, r in pairs}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, r in self.rank.items():
            self.token[r] = token
        self.length = np.array([len(x) for x in self.token], np.int64)
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        # every pair of tokens that makes a token: key of the pair -> the token
        pairs = sorted(
            (rank[token[:k]] * len(self.token) + rank[token[k:]], r)
            for rank in [self.rank]
            for token, r in rank.items()
            for k in range(1, len(token))
            if token[:k] in rank and token[k:] in rank
        )
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int32)
        self.byte_pairs = self._pair_rank(np.repeat(self.byte, 256), np.tile(self.byte, 256))
        self.pieces: dict[bytes, bytes] = {}  # cache: packed ids by piece

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        rank = self.rank
        if piece in rank:
            return [rank[piece]]
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # start of the part behind and in front
        heap = [(r, i) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or rank.get(piece[i : after[j]]) != r:
                continue  # one of the two parts has changed since
            alive[j] = False
            end = after[i] = after[j]
            if end < n:
                before[end] = i
                if (x := rank.get(piece[i : after[end]])) is not None:
                    heapq.heappush(heap, (x, i))
            h = before[i]
            if h >= 0 and (x := rank.get(piece[h:end])) is not None:
                heapq.heappush(heap, (x, h))
        out, i = [], 0
        while i < n:
            out.append(rank[piece[i : after[i]]])
            i = after[i]
        return out

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * len(self.token) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK).astype(np.int32)

    def _merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Packed ids of pieces of 2 to `width` bytes: all are merged together, one pair of each in a step."""
        raw = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in pieces]), np.uint8).reshape(-1, width)
        n = np.array([len(x) for x in pieces])
        ids = self.byte[raw]
        ranks = self.byte_pairs[raw[:, :-1].astype(np.int32) * 256 + raw[:, 1:]]
        ranks[np.arange(width - 1) >= n[:, None] - 1] = NO_RANK
        row = np.arange(len(pieces))
        out: list[bytes] = [b""] * len(pieces)
        while True:
            at = np.arange(len(row))
            i = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            r = ranks[at, i] if ranks.shape[1] else np.full(len(row), NO_RANK)
            done = r == NO_RANK
            blob, step = ids[done].astype("<u4").tobytes(), 4 * ids.shape[1]
            for k, (piece, length) in enumerate(zip(row[done].tolist(), n[done].tolist())):
                out[piece] = blob[k * step : k * step + 4 * length]
            left = ~done
            if not left.any():
                return out
            row, n, i, r, ids, ranks = row[left], n[left] - 1, i[left], r[left], ids[left], ranks[left]
            at = np.arange(len(row))
            ids[at, i] = r
            # the part behind the pair goes, and so does the pair
            ids = np.where(np.arange(ids.shape[1] - 1) > i[:, None], ids[:, 1:], ids[:, :-1])
            ranks = np.where(np.arange(ranks.shape[1] - 1) >= i[:, None], ranks[:, 1:], ranks[:, :-1])
            has = np.flatnonzero(i < n - 1)
            ranks[has, i[has]] = self._pair_rank(ids[has, i[has]], ids[has, i[has] + 1])
            has = np.flatnonzero(i > 0)
            ranks[has, i[has] - 1] = self._pair_rank(ids[has, i[has] - 1], ids[has, i[has]])

    def _learn(self, missing: list[bytes]) -> None:
        """Put the ids of pieces into the cache."""
        rest: list[bytes] = []
        for x in missing:
            if x in self.rank:
                self.pieces[x] = struct.pack("<I", self.rank[x])
            else:
                rest.append(x)
        rest.sort(key=len)
        lengths = [len(x) for x in rest]
        lo = 0
        for width in WIDTHS:
            hi = bisect.bisect_right(lengths, width)
            if hi > lo:
                self.pieces.update(zip(rest[lo:hi], self._merge_many(rest[lo:hi], width)))
            lo = hi
        for x in rest[lo:]:
            ids = self.merge(x)
            self.pieces[x] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; the texts are scanned together."""
        joined = "\0".join(texts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kinds = code_classes()[codes]
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1  # the separators
        kinds[ends] = END
        start = token_starts(kinds)
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        at = np.cumsum(width) - width
        data = joined.encode()
        cuts = at[start]  # separators start pieces of their own
        first = np.searchsorted(cuts, at[ends])  # of each text: the number of its separator among the cuts
        number, distinct = distinct_pieces(data, cuts)
        if len(self.pieces) > CACHED_PIECES:
            self.pieces.clear()
        self._learn(list(set(distinct).difference(self.pieces)))
        packed = [self.pieces[x] for x in distinct]
        tokens = np.frombuffer(b"".join(packed), "<u4")
        n = np.array([len(x) // 4 for x in packed])
        # a separator has no tokens; the others take those of their distinct piece
        each = n[number]
        each[first] = 0
        behind = np.cumsum(each)
        from_ = np.cumsum(n) - n
        ids = tokens[np.repeat(from_[number] - (behind - each), each) + np.arange(behind[-1])]
        return [x.tobytes() for x in np.split(ids, behind[first[:-1]])]

    def starts(self, ids: bytes) -> np.ndarray:
        """Byte offset of each token."""
        width = self.length[np.frombuffer(ids, "<u4")]
        return np.cumsum(width) - width

    def decode(self, ids: bytes) -> bytes:
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _groups(texts: Iterable[str], size: int) -> Iterator[list[str]]:
    group, n = [], 0
    for t in texts:
        if group and n + len(t) > size:
            yield group
            group, n = [], 0
        group.append(t)
        n += len(t) + 1
    if group:
        yield group


_CODECS: dict = {}


def _codec(shared) -> Codec:
    # a worker keeps a broadcast value between tasks; the entry keeps it alive
    key = id(shared.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = (Codec(shared.value), shared.value)
    return _CODECS[key][0]


def encode_documents(
    docs: DataFrame, vocabulary: str, out: str, text_col: str = "text", round_trip: bool = False
) -> DataFrame:
    """`docs` with the struct column `out` (ENCODED), over the rank file at `vocabulary` (a path of the driver).

    A null text is encoded like an empty one: no tokens. A very long text is
    scanned alone and needs memory for itself only. Equal texts have equal
    ids, whatever other rows there are; all columns stay, and `out` must not
    be one of them. With `round_trip` the struct has one field more,
    `decoded`: the bytes that the packed ids decode to, made by the same task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    kind = T.StructType([*ENCODED.fields, DECODED]) if round_trip else ENCODED
    at = docs.columns.index(text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            done = 0
            # a group's rows go back as soon as they are encoded, so that a task holds one group's results
            for group in _groups((t.as_py() or "" for t in batch.column(at)), SCAN):
                ids = codec.encode(group)
                columns = [
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([codec.starts(i).astype("<u4").tobytes() for i in ids], pa.binary()),
                ]
                if round_trip:
                    columns.append(pa.array([codec.decode(i) for i in ids], pa.binary()))
                found = pa.StructArray.from_arrays(columns, names=kind.names)
                part = batch.slice(done, len(group))
                done += len(group)
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*batch.schema.names, out])

    return docs.mapInArrow(encode, T.StructType([*docs.schema.fields, T.StructField(out, kind)]))


def decode_documents(df: DataFrame, vocabulary: str, ids_col: str, out: str) -> DataFrame:
    """`df` with the binary column `out`: the bytes of each row's packed ids, null for null."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    at = df.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            found = [None if i is None else codec.decode(i) for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, out])

    return df.mapInArrow(decode, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))


def decode_range(codec: Codec, ids: bytes, starts: bytes, first: int, last: int) -> tuple[int, bytes]:
    """(byte offset, bytes) of the tokens `first` to `last` (exclusive) of an encoded text."""
    part = ids[4 * first : 4 * last]
    at = np.frombuffer(starts, "<u4")
    return (int(at[first]) if first < len(at) else int(codec.length[np.frombuffer(ids, "<u4")].sum())), codec.decode(part)
