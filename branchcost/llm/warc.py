"""WARC archives in Zstandard: writer and reader.

An archive is a dictionary in a leading skippable frame (magic 0x184D2A5D),
followed by one Zstandard frame per record, compressed with that dictionary.
Each archive is one row of bytes in Spark and one file on disk, written
through Spark's text writer (the value's bytes, then the line separator,
which is an empty skippable frame, so the file stays a valid archive) and
read with Spark's binary file reader; so archives live wherever Spark can
write and go through its commit protocol. An archive holds at most
`archive_bytes` of payload (a longer record is alone in its own), which
bounds the memory of a task on either side.

Payloads that occur several times are written once: of equal payloads the
record with the smallest id is the response, the others are revisits that
name it and carry no payload.

The reader takes archives of other writers too: versions 1.0 and 1.1, every
record type, repeated and folded header lines, HTTP messages (their body is
the payload), dictionaries that are compressed themselves, archives without
one, and any of the digests of `HASHES`. The `X-` headers, from which ids and
full payload lengths come, are then missing and give nulls.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchcost.llm.common import scratch_path, stage_table

# Fixed values of the format.
DICT_MAGIC = 0x184D2A5D
SKIP_MAGIC = 0x184D2A50  # to 0x184D2A5F
FRAME_MAGIC = 0xFD2FB528
SEPARATOR = struct.pack("<II", SKIP_MAGIC, 0).decode("ascii")
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", VERSION)
TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
ONCE = (*REQUIRED, "warc-payload-digest", "warc-block-digest", "x-payload-length", "x-page-id")
HASHES = {"md5": hashlib.md5, "sha1": hashlib.sha1, "sha256": hashlib.sha256, "sha512": hashlib.sha512}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

ARCHIVE_BYTES = 8 << 20
DICT_BYTES = 16 << 10
DICT_SAMPLES = 64
DICT_LIMIT = 64 << 20
LEVEL = 3

RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("uri", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to_id", T.StringType()),
        T.StructField("warc_date", T.StringType()),
    ]
)


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def record_urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(page_id, uri, payload: bytes, refers_to, revisit: bool) -> bytes:
    """Bytes of one WARC record; a revisit keeps digest and length, not the payload."""
    block = b"" if revisit else payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if uri is not None:  # header values are one line: other text is escaped
        head.append(("WARC-Target-URI", uri.encode("unicode_escape").decode("ascii")))
    if revisit:
        head.append(("WARC-Profile", PROFILE))
        head.append(("WARC-Refers-To", record_urn(refers_to)))
        if refers_to is not None:
            head.append(("X-Refers-To-Page-Id", str(refers_to)))
    head.append(("Content-Length", str(len(block))))
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-case name: of a repeated one the first, folded lines joined by a blank."""
    unfolded: list[bytes] = []
    for line in lines:
        if line[:1] in (b" ", b"\t") and unfolded:
            unfolded[-1] += b" " + line.strip(b" \t")
        else:
            unfolded.append(line)
    fields: dict[str, str] = {}
    for line in unfolded:
        name, colon, value = line.partition(b":")
        key = name.decode("utf-8", "replace").strip().lower()
        if not colon or not key or (key in ONCE and key in fields):
            raise WarcError(f"bad header line {line[:80]!r}")
        fields.setdefault(key, value.strip(b" \t").decode("utf-8", "replace"))
    return fields


def _fits(labelled: str, data: bytes) -> bool:
    """Whether `data` has the digest `algorithm:value` (base 32 or hex); an algorithm not in HASHES is not checked."""
    algorithm, _, value = labelled.rpartition(":")
    if (algorithm or "sha1").lower() not in HASHES:
        return True
    raw = HASHES[(algorithm or "sha1").lower()](data).digest()
    return value.lower() == raw.hex() or value.upper().rstrip("=") == base64.b32encode(raw).decode().rstrip("=")


def _uri(fields: dict[str, str]) -> str | None:
    uri = fields.get("warc-target-uri")
    if uri is None or "x-payload-length" not in fields:  # written elsewhere: not escaped
        return uri.strip("<>") if uri else uri
    return uri.encode("ascii").decode("unicode_escape")


def decode_record(data: bytes) -> tuple:
    """RECORD values of one record; raises WarcError when headers, lengths or digests are wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] not in VERSIONS:
        raise WarcError(f"no version line: {data[:40]!r}")
    fields = _fields(lines[1:])
    for key in REQUIRED:
        if key not in fields:
            raise WarcError(f"header {key} is missing")
    for key in ("content-length", "x-payload-length"):
        if not fields.get(key, "0").isdigit():
            raise WarcError("a length is not a number")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"content length {n}, but the record has {len(rest) - 4} bytes")
    kind, block = fields["warc-type"], rest[:n]
    if kind not in TYPES:
        raise WarcError(f"record type {kind}")
    if "warc-block-digest" in fields and not _fits(fields["warc-block-digest"], block):
        raise WarcError("block digest does not fit")
    payload: bytes | None = block
    if fields.get("content-type", "").lower().startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    labelled = fields.get("warc-payload-digest")
    stated = int(fields["x-payload-length"]) if "x-payload-length" in fields else None
    if kind == "revisit":
        if "warc-profile" not in fields or (stated is not None and (n or "warc-refers-to" not in fields)):
            raise WarcError("a revisit needs a profile, a record to refer to and no payload")
        payload = None
    elif (stated is not None and stated != len(payload)) or (
        "warc-segment-number" not in fields and labelled and not _fits(labelled, payload)
    ):
        raise WarcError("payload length or digest does not fit")
    if labelled is None:
        sha = None if payload is None else digest(payload)
    elif labelled.lower().startswith("sha1:") or ":" not in labelled:
        sha = labelled.rpartition(":")[2]
    else:
        sha = labelled
    page, ref = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    return (
        int(page) if page is not None else None,
        _uri(fields),
        kind,
        stated if payload is None else len(payload),
        sha,
        int(ref) if ref is not None else None,
        payload,
        fields["warc-record-id"],
        fields.get("warc-refers-to"),
        fields["warc-date"],
    )


def encode_archive(records: list[bytes]) -> bytes:
    """One archive; its dictionary is trained on the first `DICT_SAMPLES` records."""
    samples = [r[: 1 << 16] for r in records[:DICT_SAMPLES]]
    try:
        trained = zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples: their bytes serve as a raw dictionary
        trained = b"".join(samples)[-DICT_BYTES:]
        if trained[:4] == struct.pack("<I", FRAME_MAGIC):
            trained = b" " + trained
    if len(trained) < 8:
        trained = trained.ljust(8, b" ")
    packed = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained), write_checksum=True)
    frames = [packed.compress(r) for r in records]
    return struct.pack("<II", DICT_MAGIC, len(trained)) + trained + b"".join(frames)


def _dictionary(stored: bytes) -> bytes:
    """The dictionary of a leading frame, which may be a Zstandard frame itself."""
    if stored[:4] != struct.pack("<I", FRAME_MAGIC):
        return stored
    frame, plain = zstandard.ZstdDecompressor().decompressobj(), bytearray()
    try:
        for at in range(0, len(stored), 1 << 12):
            plain += frame.decompress(stored[at : at + (1 << 12)])
            if frame.eof or len(plain) > DICT_LIMIT:
                break
    except zstandard.ZstdError as e:
        raise WarcError(f"dictionary: {e}") from e
    if not frame.eof or len(plain) > DICT_LIMIT:
        raise WarcError(f"the dictionary is cut off or has more than {DICT_LIMIT} bytes")
    return bytes(plain)


def decode_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive: one frame each, decoded one at a time."""
    if len(data) < 8:
        raise WarcError("no frame at the start")
    if struct.unpack_from("<I", data)[0] == DICT_MAGIC:
        at = 8 + struct.unpack_from("<I", data, 4)[0]
        if at > len(data):
            raise WarcError("the dictionary frame is cut off")
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(_dictionary(data[8:at])))
    else:
        at, unpack = 0, zstandard.ZstdDecompressor()
    view = memoryview(data)
    while at < len(data):
        if len(data) - at < 8:
            raise WarcError("bytes after the last frame")
        magic, size = struct.unpack_from("<II", data, at)
        if SKIP_MAGIC <= magic <= SKIP_MAGIC + 15:
            at += 8 + size
            if at > len(data):
                raise WarcError("a skippable frame is cut off")
            continue
        if magic != FRAME_MAGIC:
            raise WarcError(f"no frame at byte {at}")
        one, parts, end, step = unpack.decompressobj(), [], at, 1 << 12
        try:
            while not one.eof:  # in growing pieces, so little is read past the frame
                if end >= len(data):
                    raise WarcError("the last frame is cut off")
                piece = view[end : end + step]
                parts.append(one.decompress(piece))
                end, step = end + len(piece), min(2 * step, 1 << 20)
        except zstandard.ZstdError as e:
            raise WarcError(f"frame at byte {at}: {e}") from e
        at = end - len(one.unused_data)
        yield b"".join(parts)


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, uri, html, revisit, refers_to): which record carries the payload.

    The first ids of repeated payloads are found on digests alone, with
    partial aggregation. They are then joined to the pages; both sides of
    that join are plain shuffles, so a payload shared by a third of all
    pages is split by the adaptive skew join. Rows that share both payload
    and id are all responses; a null id counts as larger than any other.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("uri"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("html"),
    )
    sha = F.sha1(F.col("html").cast("binary"))
    firsts = stage_table(
        rows.groupBy(sha.alias("sha"))
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha", "first_id"),
        "warc-firsts",
    )
    joined = rows.withColumn("key", sha).join(firsts, F.col("key") == F.col("sha"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return joined.select("id", "uri", "html", revisit.alias("revisit"), "first_id")


def write_archives(marked: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the rows of `mark_revisits` as archives below `path` (which must not exist)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records, size = [], 0
        for b in batches:
            for page_id, uri, html, revisit, first in zip(b["id"], b["uri"], b["html"], b["revisit"], b["first_id"]):
                page_id = None if pd.isna(page_id) else int(page_id)
                first = None if pd.isna(first) else int(first)
                record = encode_record(page_id, uri, html.encode(), first, bool(revisit))
                if records and size + len(record) > archive_bytes:
                    yield pd.DataFrame({"archive": [encode_archive(records)]})
                    records, size = [], 0
                records.append(record)
                size += len(record)
        if records:
            yield pd.DataFrame({"archive": [encode_archive(records)]})

    archives = marked.mapInPandas(pack, "archive binary")
    # one archive per file; a text value is written byte by byte
    archives.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", SEPARATOR).option(
        "maxRecordsPerFile", 1
    ).option("compression", "none").text(path)


def read_archives(spark: SparkSession, path: str, names: str = "part-*") -> DataFrame:
    """Records (RECORD) of all archives below `path` whose file names fit `names`; a broken archive fails the job.

    A record that is no page of this module's writer has a null id; payload
    and its length are null for revisits (the length, if unknown).
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["content"]:
                rows: list[tuple] = []
                held = 0
                for record in decode_archive(bytes(data)):
                    rows.append(decode_record(record))
                    held += len(record)
                    if held > ARCHIVE_BYTES:
                        yield _frame(rows)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(path).select("content")
    return files.mapInPandas(unpack, RECORD)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=RECORD.names, dtype=object)
    for c in ("id", "refers_to", "payload_bytes"):
        out[c] = pd.array([None if v is None else int(v) for v in out[c]], dtype="Int64")
    return out


def archive_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", path: str | None = None
) -> DataFrame:
    """Write a record per row to archives, read them back: (RECORD), one row per input row.

    A null payload is empty; a null URL has no target header; an empty
    table gives no records. Other columns are not read.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    marked = mark_revisits(pages, id_col, url_col, payload_col)
    write_archives(marked, path)
    return read_archives(spark, path)
