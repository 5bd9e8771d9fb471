"""WARC archives: a writer with revisit records, and a reader that salvages damaged archives.

Archives are byte strings of gzip members, one per record. They are stored as rows (``archive``,
``content``); archives from elsewhere can be read with Spark's ``binaryFile`` source and given to
the reader in the same form.

The reader walks an archive record by record. A record must decompress, begin with a version line,
carry the length that it states and match its digests. After a failed check the reader
searches for the next gzip member that begins with a version line, or the next version line in
plain archives, goes on from there and logs the bytes between as a gap.

A block digest covers the block, a payload digest the body of an HTTP message, or the block of any other record.
Digests are read in hexadecimal and base32; one of an unknown algorithm or form is not checked, nor is the
payload digest of a revisit or of a segment of a record. A header has at most ``HEADER_BYTES``. A body whose digest was taken with its transfer
coding undone is accepted too. A member may hold several records: each has the offset of the member, the
first its length and the others length 0. What is damaged within a member is a gap of length 0 there; the
records around it are kept.

Defined cases: a null html is an empty payload, a null url an empty target. Rows that share the
largest ``page_id`` of a payload are all responses; a null ``page_id`` is below all others. Repeated
rows give repeated records. Other columns are dropped. An empty table gives no archive.
"""

import base64
import binascii
import gzip
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_batches
from riskloom.session import materialize

#: Payloads below this are always written in full.
MIN_REVISIT_BYTES = 1000
#: Bytes of a member that are unpacked at a time, and bytes in which a header must end: both keep reading linear.
SLICE_BYTES, HEADER_BYTES = 64 << 10, 1 << 20
#: Pages come without a date, so all records state one.
NO_DATE = "1970-01-01T00:00:00Z"
# Fixed value: what a revisit of an equal payload is called.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 4 << 20
READ_SCHEMA = ("archive string, offset bigint, length bigint, kind string, reason string, page_id bigint, "
               "uri string, record_type string, refers_to bigint, payload_bytes bigint, "
               "payload_digest string, payload binary")
_NAMES = [part.split()[0] for part in READ_SCHEMA.split(", ")]
_VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
_MEMBER = b"\x1f\x8b\x08"


def write_record(page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One record, uncompressed. A revisit states digest and length of the payload it leaves out."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {NO_DATE}",
             f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url)}", "Content-Type: text/html; charset=utf-8",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {SAME_PAYLOAD}"]
        payload = b""
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _differs(stated: str, *contents: bytes) -> bool:
    """Whether a digest that can be checked fits none of the ``contents``."""
    name, colon, value = stated.partition(":")
    if not colon:
        name, value = "sha1", stated
    name = name.strip().lower().replace("-", "")
    if name not in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512"):
        return False
    value, size = value.strip(), hashlib.new(name).digest_size
    try:
        if len(value) == 2 * size:
            want = bytes.fromhex(value)
        else:
            value = value.rstrip("=").upper()
            want = base64.b32decode(value + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        return False
    return len(want) == size and all(hashlib.new(name, c).digest() != want for c in contents)


def _unchunked(body: bytes):
    """A body without its chunked transfer coding; None if it is not coded so."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,16}", size):
            return None
        n = int(size, 16)
        if not n:
            return b"".join(parts)
        parts.append(body[end + 2:end + 2 + n])
        at = end + 2 + n
        if body[at:at + 2] != b"\r\n":
            return None
        at += 2


def _payloads(fields, block: bytes):
    """What a payload digest may cover: the block, or of an HTTP message the body as sent and without its coding."""
    kind = fields.get("content-type", "").lower().replace(" ", "")
    if not kind.startswith("application/http"):
        return [block]
    head = re.search(rb"\r?\n\r?\n", block)
    body = block[head.end():] if head else b""
    coded = head and re.search(rb"(?im)^transfer-encoding:.*chunked", block[:head.start()])
    plain = _unchunked(body) if coded else None
    return [body] if plain is None else [body, plain]


def parse_record(raw: bytes, at: int = 0):
    """``(fields, payload, end)`` of the record at ``at``; ``ValueError`` says what is wrong."""
    if not _VERSION.match(raw, at):
        raise ValueError("no version line")
    head = raw.find(b"\r\n\r\n", at, at + HEADER_BYTES)
    if head < 0:
        raise ValueError("header does not end")
    fields = {}
    for line in re.sub(rb"\r\n[ \t]+", b" ", raw[at:head]).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without a colon")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError("no content length")
    end = head + 4 + int(fields["content-length"])
    if raw[end:end + 4] != b"\r\n\r\n":
        raise ValueError("record does not end where it should")
    payload = raw[head + 4:end]
    if _differs(fields.get("warc-block-digest", ""), payload):
        raise ValueError("block digest differs")
    whole = fields.get("warc-type") not in ("revisit", "continuation") and "warc-segment-number" not in fields
    if whole and _differs(fields.get("warc-payload-digest", ""), *_payloads(fields, payload)):
        raise ValueError("payload digest differs")
    return fields, payload, end + 4


def _member_at(raw: bytes, at: int):
    """``(records and gaps, end in the archive)`` of the compressed member or plain record at ``at``.

    They are ``(fields, payload)`` and ``(None, reason)``. A member without any sound record is an error.
    """
    if raw[at:at + 3] != _MEMBER:
        fields, payload, end = parse_record(raw, at)
        return [(fields, payload)], end
    member, view, fed, parts = zlib.decompressobj(31), memoryview(raw), at, []
    try:
        while not member.eof and fed < len(raw):
            parts.append(member.decompress(view[fed:fed + SLICE_BYTES]))
            fed = min(fed + SLICE_BYTES, len(raw))
    except zlib.error as error:
        raise ValueError(f"member is damaged: {str(error)[:60]}") from None
    if not member.eof:
        raise ValueError("member does not end")
    plain = b"".join(parts)
    found, sound, place, lost = [], False, 0, False
    while place < len(plain):
        try:
            fields, payload, place = parse_record(plain, place)
            found.append((fields, payload))
            sound, lost = True, False
        except ValueError as error:
            if not lost:
                found.append((None, str(error)))
            following = _VERSION.search(plain, place + 1)
            place, lost = (following.start() if following else len(plain)), True
    if not sound:
        raise ValueError(found[0][1] if found else "no version line")
    return found, fed - len(member.unused_data)


def _looks_like_start(raw: bytes, at: int) -> bool:
    if raw[at:at + 3] != _MEMBER:
        return True
    try:
        return bool(_VERSION.match(zlib.decompressobj(31).decompress(memoryview(raw)[at:at + 512], 16)))
    except zlib.error:
        return False


_START = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r\n")


def salvage(raw: bytes):
    """Yields ``("record", offset, length, fields, payload)`` and ``("gap", offset, length, reason, None)``."""
    at, lost, reason = 0, None, ""
    while at < len(raw):
        try:
            found, end = _member_at(raw, at)
        except ValueError as error:
            if lost is None:
                lost, reason = at, str(error)
            found = _START.search(raw, at + 1)
            while found and not _looks_like_start(raw, found.start()):
                found = _START.search(raw, found.start() + 1)
            at = found.start() if found else len(raw)
            continue
        if lost is not None:
            yield "gap", lost, at - lost, reason, None
            lost = None
        length = end - at
        for fields, payload in found:
            if fields is None:
                yield "gap", at, 0, payload, None
            else:
                yield "record", at, length, fields, payload
                length = 0
        at = end
    if lost is not None:
        yield "gap", lost, len(raw) - lost, reason, None


def write_archives(pages: DataFrame) -> DataFrame:
    """Stored archives of all pages: ``archive``, ``content``.

    For each repeated payload of some size the page with the largest id is found by a grouped
    maximum, so a payload shared by many pages is combined before the shuffle. The small table of
    repeated payloads is stored, and Spark splits a hot payload's rows in the join.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                        F.octet_length(html).cast("bigint").alias("size"))
    winners = materialize(
        rows.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest")
        .agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("winner").isNotNull()).select(
            F.col("digest").alias("_digest"), "winner"), "payloads")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner"))
    joined = rows.join(winners, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "html", "size", "digest", refers.alias("refers_to"))

    def run(batches):
        from pyspark import TaskContext
        part, number, members, size = TaskContext.get().partitionId(), 0, [], 0

        def archive():
            return pa.RecordBatch.from_arrays(
                [pa.array([f"pages-{part:05d}-{number:05d}.warc.gz"]), pa.array([b"".join(members)], pa.binary())],
                names=["archive", "content"])

        for batch in batches:
            for page_id, url, text, n, digest, refers_to in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                record = write_record(page_id, url, text.encode(), n, digest, refers_to)
                members.append(gzip.compress(record, 6, mtime=0))
                size += len(members[-1])
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    number, members, size = number + 1, [], 0
        if members:
            yield archive()

    return materialize(map_batches(joined, run, "archive string, content binary"), "archives")


def _page(text: str):
    number = text.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def read_archives(archives: DataFrame, payloads=True) -> DataFrame:
    """Records (``kind`` record) and quarantined bytes (``kind`` gap) of all archives, in columns of ``READ_SCHEMA``."""

    def rows(name, raw):
        for kind, offset, length, what, payload in salvage(raw):
            if kind == "gap":
                yield (name, offset, length, kind, what, *[None] * 7)
                continue
            digest = what.get("warc-payload-digest", "").removeprefix("sha1:")
            revisit = what.get("warc-type") == "revisit"
            stated = what.get("x-payload-length", "")
            size = int(stated) if revisit and stated.isdigit() else len(payload)
            yield (name, offset, length, kind, None, _page(what.get("warc-record-id", "")),
                   what.get("warc-target-uri"), what.get("warc-type"), _page(what.get("warc-refers-to", "")),
                   size, digest if revisit else hashlib.sha1(payload).hexdigest(),
                   payload if payloads else None)

    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
             pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def batch_of(found):
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                                          names=_NAMES)

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found, held = [], 0
                for row in rows(name, content.as_py() or b""):
                    found.append(row)
                    held += len(row[-1] or b"")
                    if len(found) >= 2000 or held >= 8 << 20:
                        yield batch_of(found)
                        found, held = [], 0
                if found:
                    yield batch_of(found)

    return map_batches(archives.select("archive", "content"), run, READ_SCHEMA)
