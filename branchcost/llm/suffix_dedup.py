"""Removal of repeated byte strings, with suffix arrays built by two-stage sorting.

A byte goes when it lies in a string of `LENGTH` (50) bytes that also starts
in a document with a smaller id. No task sees the corpus as a whole:

1. *Anchors.* Of the 31 positions in a 50-byte window, the one whose 20-byte
   hash is smallest is the window's anchor. It depends on the window's bytes
   alone, so equal windows have equal anchors, and about one position in 16
   is one. The stretch of text under the windows an anchor serves (50 to 80
   bytes) is its segment. Tasks send, packed per hash bucket, 48 bits of the
   anchor's and 48 bits of the segment's hash for a block of documents.
2. *Equal segments.* Of the documents with one segment only the smallest
   counts; in all others the segment goes. A block of documents settles this
   for itself and sends each segment once, so a passage in a third of all
   documents is one entry per block. Where an anchor has several distinct
   segments in several documents, those need their bytes compared: they are
   cut out of the smallest document of each.
3. *Suffix arrays.* The segments of an anchor meet in one block of text.
   Over a block a suffix array is built by two-stage sorting; neighbours with
   a common prefix of 50 bytes are equal windows, and each group's smallest
   id tells which windows occur in a smaller document. Anchors with more than
   `HOT` distinct segments (say, a common line before all kinds of text) are
   dealt out as single windows by the windows' own hashes instead, and a
   block of documents that sees more than `BLOCK_HOT` says so without sending
   them.
4. The removed runs are gathered per document and joined to the texts.

Segments and single windows are matched by 96 and 128 bits of hash, windows
within segments by their bytes.

What a task holds does not depend on the rows of a batch: texts come one at a
time out of small Arrow batches, results go back as soon as `BATCH_ROWS` or
`BATCH_TEXT` of them are there, and a bucket's marks are sorted in `PARTS`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchcost.llm.common import arrow_batches, release, stage_table

LENGTH = 50
GRAM = 20
SPREAD = LENGTH - GRAM + 1
PIECE = 1 << 20
BLOCK_TEXT = 8 << 20  # bytes of text whose anchors are sent together
BUCKET_TEXT = 24 << 20  # bytes of text per anchor bucket
PARTS = 4  # of a bucket, by anchor, sorted one after the other
BLOCK_SEGMENTS = 1 << 20  # bytes of segments per suffix array
BATCH_ROWS = 1_000  # texts that go to a task's Python at once, results that come back
BATCH_TEXT = 4 << 20  # and bytes of them
HOT = 2_000
BLOCK_HOT = 200

_U = np.uint64
_ODD = 0xD6E8FEB86659FD93
_LOW20 = _U((1 << 20) - 1)
_MASK48 = _U((1 << 48) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_ODD, PIECE + LENGTH)
_INV = _powers(pow(_ODD, -1, 1 << 64), PIECE + LENGTH)


def window_anchors(data: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For pieces of a text: (offset of the piece, marks, first window, last window + 1).

    One row of `marks` per anchor: 48 bits of its hash, 48 bits of its
    segment's. Windows are numbered by their start within the piece; every
    window of the text lies in exactly one piece. (A segment cut by the end
    of a piece is two segments; they are as good as one.)
    """
    for lo in range(0, max(0, len(data) - LENGTH + 1), PIECE - LENGTH + 1):
        raw = np.frombuffer(data, np.uint8, min(PIECE, len(data) - lo), lo)
        code = raw.astype(np.uint64) + _U(1)
        code *= _POW[: len(raw)]
        prefix = np.empty(len(raw) + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(code, out=prefix[1:])
        h = prefix[GRAM:] - prefix[:-GRAM]
        h *= _INV[: len(h)]
        _finish(h)
        # the position in the low bits: the least key is the least hash, first of equals
        low = (h & ~_LOW20) | np.arange(len(h), dtype=np.uint64)
        for step in (1, 2, 4, 8):
            low = np.minimum(low[:-step], low[step:])
        low = np.minimum(low[: -(SPREAD - 16)], low[SPREAD - 16 :])
        at = (low & _LOW20).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], len(at))
        segment = (prefix[last + LENGTH - 1] - prefix[first]) * _INV[first] + (last - first).astype(np.uint64)
        yield lo, np.stack([h[at[first]], _finish(segment)], 1) & _MASK48, first, last


def _finish(h: np.ndarray) -> np.ndarray:
    h ^= h >> _U(31)
    h *= _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(29)
    return h


def two_stage_suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of a byte array in the order of their first `depth` bytes (at least).

    Only suffixes smaller than their successor are sorted directly. The
    others begin with a byte not smaller than the next one, so they follow
    from a scan over the byte buckets in order: every suffix met yields the
    one before it, which takes the next free place at the head of its own
    bucket.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # smaller[i]: suffix i < suffix i + 1. Runs of equal bytes take the type of their end; the last suffix is larger.
    ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    after = np.append(text, 0)[ends + 1].astype(np.int16)
    after[-1] = -1
    smaller = np.repeat(text[ends] < after, np.diff(np.append(-1, ends)))

    keys = byte_keys(text, depth)
    direct = np.flatnonzero(smaller)
    order = direct[np.argsort(keys[direct], kind="stable")]
    group = _ranks(keys[order])
    for at in range(8, depth, 8):
        # only ties are compared further
        tied = np.flatnonzero(np.append(group[1:] == group[:-1], False) | np.append(False, group[1:] == group[:-1]))
        if not len(tied):
            break
        part = order[tied]
        key = keys[np.minimum(part + at, n)]
        again = np.lexsort((key, group[tied]))
        order[tied] = part[again]
        changed = np.zeros(len(order), bool)
        changed[tied[1:]] = key[again][1:] != key[again][:-1]
        changed |= np.append(True, group[1:] != group[:-1])
        group = np.cumsum(changed)

    count = np.bincount(text, minlength=256)
    start = np.concatenate([[0], np.cumsum(count)])
    sa = np.full(n, -1, np.int64)
    head = start[:-1].copy()  # next free place for induced suffixes, by byte
    first = text[order]
    low = np.searchsorted(first, np.arange(257))
    for c in range(256):  # directly sorted suffixes fill the tails of their buckets
        mine = order[low[c] : low[c + 1]]
        sa[start[c + 1] - len(mine) : start[c + 1]] = mine

    def induce(found: np.ndarray) -> np.ndarray:
        """Place the larger suffixes before `found`; those of the same byte are returned as well."""
        prev = found[found > 0] - 1
        prev = prev[~smaller[prev]]
        byte = text[prev]
        by = np.argsort(byte, kind="stable")
        prev, byte = prev[by], byte[by]
        cuts = np.flatnonzero(np.append(True, byte[1:] != byte[:-1])) if len(prev) else []
        for lo, hi in zip(cuts, np.append(cuts[1:], len(prev)) if len(prev) else []):
            b = byte[lo]
            sa[head[b] : head[b] + hi - lo] = prev[lo:hi]
            head[b] += hi - lo
        return prev

    # the empty suffix comes first and yields the last one
    sa[head[text[-1]]] = n - 1
    head[text[-1]] += 1
    for c in range(256):
        done = start[c]
        while done < head[c]:  # induced ones of this bucket may induce more of it
            upto = head[c]
            induce(sa[done:upto])
            done = upto
        induce(sa[done : start[c + 1]])
    return sa


def byte_keys(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Big-endian numbers of the 8 bytes from each position (zeros past the end), one more for the end."""
    padded = np.append(text, np.zeros(8, np.uint8)).astype(np.uint64)
    n = len(text) + 1
    out = np.zeros(n, np.uint64)
    for j in range(8):
        out = (out << _U(8)) | padded[j : j + n]
    return out


def _ranks(sorted_keys: np.ndarray) -> np.ndarray:
    return np.cumsum(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else sorted_keys


def adjacent_prefixes(text: np.ndarray, sa: np.ndarray, cap: int = LENGTH) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in `sa`, at most `cap`."""
    keys, n = byte_keys(text), len(text)
    out = np.zeros(len(sa), np.int64)
    live = np.arange(1, len(sa))
    for at in range(0, cap, 8):
        p, q = sa[live - 1], sa[live]
        x = keys[np.minimum(p + at, n)] ^ keys[np.minimum(q + at, n)]
        same = np.full(len(live), 8)
        for t in range(8):
            same -= x >= _U(1) << _U(8 * t)
        out[live] += same
        live = live[same == 8]
        if not len(live):
            break
    if len(sa) > 1:  # nothing is common past the end of the text
        out[1:] = np.minimum(out[1:], n - np.maximum(sa[1:], sa[:-1]))
    return np.minimum(out, cap)


def least_ids(segments: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """For each window of each segment, the smallest id of a segment that holds the same window."""
    text = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments])
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(segments)), sizes)
    sa = two_stage_suffix_array(text)
    sa = sa[sa + LENGTH <= (starts + sizes)[owner[sa]]]  # windows within one segment
    new = adjacent_prefixes(text, sa) < LENGTH
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[owner[sa]], heads)
    of_window = np.zeros(len(text), np.int64)
    of_window[sa] = np.repeat(least, np.diff(np.append(heads, len(sa))))
    return [of_window[s : s + n - LENGTH + 1] for s, n in zip(starts, sizes)]


def _pack(marks: np.ndarray) -> bytes:
    """Marks (n, 2) as 12 bytes each."""
    return np.ascontiguousarray(marks, "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").astype(np.uint64).reshape(-1, 2)


#: What is to be done with a segment of a document.
GONE, COMPARE, SINGLE = "gone", "compare", "single"
#: In place of a segment's hash: the anchor is hot.
_HOT_MARK = _MASK48
PACKET = "bucket bigint, docs binary, marks binary, owners binary, kind string"
_PACKET = pa.schema(
    [("bucket", pa.int64()), ("docs", pa.binary()), ("marks", pa.binary()), ("owners", pa.binary()), ("kind", pa.string())]
)
VERDICT = "doc bigint, kind string, marks binary"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of all batches, one at a time; texts as their UTF-8 bytes."""
    for batch in batches:
        text = [pa.types.is_string(c.type) or pa.types.is_large_string(c.type) for c in batch.columns]
        columns = [c.cast(pa.binary()) if t else c for c, t in zip(batch.columns, text)]
        del batch
        for row in zip(*columns):
            yield tuple(x.as_py() for x in row)
        del columns


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _heads(values: np.ndarray) -> np.ndarray:
    return np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)


def _by_document(d: np.ndarray, marks: np.ndarray, kind: str) -> Iterator[tuple[int, str, bytes]]:
    order = np.argsort(d, kind="stable")
    d, marks = d[order], marks[order]
    cuts = np.flatnonzero(_heads(d))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(d))):
        yield int(d[lo]), kind, _pack(marks[lo:hi])


def _settle(marks: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted marks and documents, and which of them are the first of their segment."""
    order = np.lexsort((d, marks[:, 1], marks[:, 0]))
    marks, d = marks[order], d[order]
    new = _heads(marks[:, 0]) | _heads(marks[:, 1])
    keep = new | _heads(d)
    return marks[keep], d[keep], new[keep]


def _per_anchor(marks: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted marks: segments, smallest and largest document of each one's anchor."""
    at = np.flatnonzero(_heads(marks[:, 0]))
    size = np.diff(np.append(at, len(d)))
    spread = lambda x: np.repeat(x, size)
    return spread(size), spread(np.minimum.reduceat(d, at)), spread(np.maximum.reduceat(d, at))


def _anchor_packets(n_buckets: int, block_hot: int):
    """Map function: blocks of documents to packets of their marks.

    A packet names its documents (`docs`) and, for each mark, the number of
    the document that has it (`owners`). A packet without owners is a
    verdict (`kind`) on marks of the one document named.
    """

    def flush(docs: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        ids = np.array(docs, np.int64)
        numbers = np.repeat(np.arange(len(docs)), [len(x) for x in found])
        by_id = np.argsort(np.argsort(ids, kind="stable"), kind="stable")  # smaller number, smaller id
        ids = np.sort(ids, kind="stable")
        marks, d, new = _settle(np.concatenate(found), by_id[numbers])
        head = np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))  # first document of the segment
        again = ids[d] > ids[d[head]]
        rows = [(doc % n_buckets, doc, kind, own) for doc, kind, own in _by_document(ids[d[again]], marks[again], GONE)]
        marks, d = marks[new], d[new]
        size, _, _ = _per_anchor(marks, d)
        hot = size > block_hot
        rows += [(doc % n_buckets, doc, kind, own) for doc, kind, own in _by_document(ids[d[hot]], marks[hot], SINGLE)]
        out = [(b, np.int64(doc).tobytes(), own, None, kind) for b, doc, kind, own in rows]
        # one entry for each segment, or for each hot anchor, goes to the anchor's bucket
        send = ~hot | _heads(marks[:, 0])
        marks = np.where(hot[:, None] & np.array([[False, True]]), _HOT_MARK, marks)[send]
        d = d[send]
        bucket = (marks[:, 0] % _U(n_buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        marks, d, bucket = marks[by], d[by], bucket[by]
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
        for k in range(n_buckets):
            lo, hi = cuts[k], cuts[k + 1]
            if lo < hi:
                used, number = np.unique(d[lo:hi], return_inverse=True)
                out.append((k, ids[used].tobytes(), _pack(marks[lo:hi]), number.astype(np.uint16).tobytes(), None))
        return _batch(out, _PACKET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, found, size = [], [], 0
        for doc, data in _rows(batches):
            docs.append(doc)
            found.append(np.concatenate([m for _, m, _, _ in window_anchors(data)]))
            size += len(data)
            if size > BLOCK_TEXT or len(docs) == 60_000:
                yield flush(docs, found)
                docs, found, size = [], [], 0
        if docs:
            yield flush(docs, found)

    return run


def _part(packets: list[tuple], part: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks and documents of the packets' anchors that belong to one of the `PARTS`."""
    marks, docs = [], []
    for ids, packed, owners in packets:
        m = _unpack(packed)
        mine = (m[:, 0] >> _U(40)) % _U(PARTS) == part
        marks.append(m[mine])
        docs.append(ids[np.frombuffer(owners, np.uint16)[mine]])
    return np.concatenate(marks), np.concatenate(docs)


def _bucket_verdicts(pdf: pd.DataFrame, hot_bound: int) -> pd.DataFrame:
    """What is to be done with the segments of a bucket, by document."""
    rows, packets = [], []
    for named, packed, owners, kind in zip(pdf["docs"], pdf["marks"], pdf["owners"], pdf["kind"]):
        ids = np.frombuffer(named, np.int64)
        if owners is None:
            rows.append((int(ids[0]), kind, packed))
        else:
            packets.append((ids, packed, owners))
    found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {GONE: [], SINGLE: [], COMPARE: []}
    for part in range(PARTS if packets else 0):
        m, d, new = _settle(*_part(packets, part))
        if not len(d):
            continue
        told = m[:, 1] == _HOT_MARK
        found[GONE].append((d[~new & ~told], m[~new & ~told]))
        m, d, told = m[new], d[new], told[new]
        size, low, high = _per_anchor(m, d)
        at = np.flatnonzero(_heads(m[:, 0]))
        hot = np.repeat(np.logical_or.reduceat(told, at), np.diff(np.append(at, len(d)))) | (size > hot_bound)
        single = hot & ~told
        found[SINGLE].append((d[single], m[single]))
        compare = ~hot & (size > 1) & (low < high)
        found[COMPARE].append((d[compare], m[compare]))
    for kind, parts in found.items():
        if parts:
            rows += _by_document(*map(np.concatenate, zip(*parts)), kind)
    return pd.DataFrame(rows, columns=["doc", "kind", "marks"]).astype({"doc": "int64"})


CUT = "id bigint, tag bigint, kind string, cuts array<bigint>, anchor bigint, seg binary, starts array<bigint>"
_CUT = pa.schema(
    [("id", pa.int64()), ("tag", pa.int64()), ("kind", pa.string()), ("cuts", pa.list_(pa.int64()))]
    + [("anchor", pa.int64()), ("seg", pa.binary()), ("starts", pa.list_(pa.int64()))]
)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply the verdicts to the texts: runs that are gone, segments to compare, single windows."""
    rows: list[tuple] = []
    for row in _rows(batches):
        for cut in _cuts(*row):
            rows.append(cut)
            if len(rows) == BATCH_ROWS:
                yield _batch(rows, _CUT)
                rows = []
    if rows:
        yield _batch(rows, _CUT)


def _cuts(doc: int, tag: int, data: bytes, kinds: list[str], verdicts: list[bytes]) -> Iterator[tuple]:
    """Rows of `CUT` of a text. A segment or window may come again with other starts."""
    wanted = {k: _joined_marks([v for v, kind in zip(verdicts, kinds) if kind == k]) for k in (GONE, COMPARE, SINGLE)}
    gone: list[int] = []
    places: dict[tuple, list[int]] = {}

    def found() -> Iterator[tuple]:
        yield from ((doc, tag, SINGLE if a < 0 else COMPARE, None, a, seg, at) for (a, seg), at in places.items())
        places.clear()

    for lo, marks, first, last in window_anchors(data):
        own = _as_key(marks)
        for k, keys in wanted.items():
            if not len(keys):
                continue
            pos = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            for i in np.flatnonzero(keys[pos] == own).tolist():
                s, e = int(first[i]) + lo, int(last[i]) + lo + LENGTH - 1
                if k == GONE:
                    if gone and s <= gone[-1]:
                        gone[-1] = max(e, gone[-1])
                    else:
                        gone += [s, e]
                elif k == COMPARE:
                    places.setdefault((int(marks[i, 0]), data[s:e]), []).append(s)
                else:
                    for w in range(s, e - LENGTH + 1):
                        places.setdefault((-1, xxhash.xxh3_128_digest(data[w : w + LENGTH])), []).append(w)
                if len(places) > BATCH_ROWS:
                    yield from found()
    if gone:
        yield doc, tag, GONE, gone, None, None, None
    yield from found()


def _as_key(marks: np.ndarray) -> np.ndarray:
    """Marks as one 64-bit key each, to search a document's few verdicts by."""
    return marks[:, 0] * _U(_ODD) ^ marks[:, 1]


def _joined_marks(parts: list[bytes]) -> np.ndarray:
    return np.unique(_as_key(_unpack(b"".join(parts)))) if parts else np.zeros(0, np.uint64)


def _block_verdicts(pdf: pd.DataFrame) -> pd.DataFrame:
    """For the segments of a block: runs whose windows occur under a smaller id."""
    ids = pdf["id"].to_numpy(np.int64)
    rows = []
    for doc, tag, starts, least in zip(ids.tolist(), pdf["tag"], pdf["starts"], least_ids(list(pdf["seg"]), ids)):
        runs = _runs(least < doc)
        if runs:
            rows.append((doc, tag, [int(s) + x for s in starts for x in runs]))
    return pd.DataFrame(rows, columns=["id", "tag", "cuts"]).astype({"id": "int64", "tag": "int64"})


def _runs(flags: np.ndarray) -> list[int]:
    """Byte runs covered by the flagged windows: start, stop, start, stop, ..."""
    if not flags.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [x for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()) for x in (s, e + LENGTH - 1)]


REMOVED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


def removed(text: bytes | None, cuts) -> tuple[int, int, int, bytes]:
    """(bytes, removed bytes, maximal removed runs, kept bytes) of a text in UTF-8.

    `cuts` is a list of flat arrays start, stop, start, stop, ...
    """
    data = text or b""
    at, spans, gone, kept = 0, 0, 0, []
    for s, e in sorted(p for c in cuts for p in zip(c[::2], c[1::2])):
        if s > at or not spans:
            kept.append(data[at:s])
            spans += 1
            at = s
        if e > at:
            gone += e - at
            at = e
    kept.append(data[at:])
    return len(data), int(gone), spans, b"".join(kept)


_REMOVED = pa.schema([(f, pa.binary() if f == "kept" else pa.int64()) for f in REMOVED.names])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    for doc, data, cuts in _rows(batches):
        rows.append((doc, *removed(data, cuts or ())))
        size += len(data or b"")
        if size > BATCH_TEXT or len(rows) == BATCH_ROWS:
            yield _batch(rows, _REMOVED)
            rows, size = [], 0
    if rows:
        yield _batch(rows, _REMOVED)


def removed_runs(rows: DataFrame, hot: int = HOT, block_hot: int = BLOCK_HOT) -> DataFrame:
    """(id, tag, cuts): removed runs of `rows` (id, tag, text); each of `cuts` is start, stop, start, stop, ..."""
    long = rows.where(F.octet_length("text") >= LENGTH).where(F.col("id").isNotNull())
    total = long.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(12, -(-total // BUCKET_TEXT))
    packets = long.select("id", "text").mapInArrow(_anchor_packets(n_buckets, block_hot), PACKET)
    with arrow_batches(rows.sparkSession, BATCH_ROWS, BATCH_TEXT):
        verdicts = stage_table(
            packets.groupBy("bucket")
            .applyInPandas(lambda pdf: _bucket_verdicts(pdf, hot), VERDICT)
            .groupBy("doc")
            .agg(F.collect_list(F.struct("kind", "marks")).alias("verdicts")),
            "verdicts",
        )
        cut = stage_table(
            long.join(verdicts, F.col("id") == F.col("doc"))
            .select("id", "tag", "text", "verdicts.kind", "verdicts.marks")
            .mapInArrow(_cut_out, CUT),
            "cut",
        )
    release(verdicts)
    compare = cut.where(F.col("kind") == COMPARE)
    n_blocks = max(12, -(-(compare.agg(F.sum(F.octet_length("seg"))).first()[0] or 0) // BLOCK_SEGMENTS))
    compared = (
        compare.select("id", "tag", "seg", "starts", F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)).alias("block"))
        .groupBy("block")
        .applyInPandas(_block_verdicts, "id bigint, tag bigint, cuts array<bigint>")
    )
    single = cut.where(F.col("kind") == SINGLE).select("id", "tag", "starts", F.col("seg").alias("key"))
    least = stage_table(
        single.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most"), "least"
    )
    later = single.join(least, "key").where("id > least")
    windows = F.flatten(F.transform("starts", lambda s: F.array(s, s + LENGTH)))
    runs = stage_table(
        cut.where(F.col("kind") == GONE)
        .select("id", "tag", "cuts")
        .unionByName(compared)
        .unionByName(later.select("id", "tag", windows.alias("cuts")))
        .groupBy("id", "tag")
        .agg(F.collect_list("cuts").alias("cuts")),
        "runs",
    )
    release(cut, least)
    return runs


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, block_hot: int = BLOCK_HOT
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept), one row per input row; `kept` is the remaining bytes.

    A null text is empty. A null id is not smaller or larger than any, so
    its text stays whole and removes nothing. Rows with one id, equal or
    not, never remove each other's bytes. Ids are integers.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col)).alias("tag"),
        F.col(text_col).alias("text"),
    )
    runs = removed_runs(rows, hot, block_hot).withColumnRenamed("id", "rid").withColumnRenamed("tag", "rtag")
    joined = rows.join(runs, (F.col("id") == F.col("rid")) & (F.col("tag") == F.col("rtag")), "left")
    return joined.select("id", "text", "cuts").mapInArrow(_apply, REMOVED)
