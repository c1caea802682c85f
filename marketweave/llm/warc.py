"""WARC archives: writing with revisit records, and a salvage reader.

Archives are written by Spark's text writer, so they go wherever Spark can write; each record is a gzip member of its own,
so that damage costs one record. An archive has at most ``PARTS_PER_FILE`` parts, of ``PART_BYTES`` of plain records or of one
larger record, and at most ``FILE_BYTES`` of gzip members, or one larger record alone. The reader takes archives from Spark's binaryFile source and passes on a few records at a time. When a
check fails, it looks for the next gzip member or version line that holds, takes up later records, and returns the bytes it
passed over as gaps.
"""

from __future__ import annotations

import contextlib
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, join_checked, settle, shared_dir

REVISIT_FROM = 1000
PART_BYTES, PARTS_PER_FILE, FILE_BYTES = 1 << 20, 32, 32 << 20
_ID = "urn:marketweave:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
_MEMBER = b"\x1f\x8b\x08"
#: A gzip member of no bytes. The text writer must end each row with something; this leaves the archive a valid gzip file.
_EMPTY = b"\x1f\x8b\x08\0\0\0\0\0\0\xff\x03\0\0\0\0\0\0\0\0\0"
_STEP = 1 << 16
_FIELD = re.compile(rb"(?:[!#-'*+.^_`|~0-9A-Za-z-]+:|[ \t])[^\x00-\x08\x0a-\x1f\x7f]*")


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty; null for revisits), n_bytes, digest (hex SHA-1), refers_to (null for responses).

    Of the pages with one payload of at least 1000 bytes, those with the largest page_id are responses and the others
    revisit it; a null page_id is never the largest. Digests of what occurs more than once are aggregated before the
    shuffle and joined back.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("n_bytes"), F.sha1(html).alias("digest"))
    long = rows.filter(F.col("n_bytes") >= REVISIT_FROM)
    owner = settle(long.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("owner")).filter("n > 1 and owner is not null").select("digest", "owner"), "payload-owners")
    other = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return join_checked(rows, owner, ["digest"], how="left").select("page_id", "url", F.when(~other, F.col("html")).alias("html"), "n_bytes", "digest", F.when(other, F.col("owner")).alias("refers_to"))


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the rows of ``with_revisits`` as gzip archives bounded by bytes, a member for each record (the writer names them .txt)."""
    line = "\r\n"
    revisit = F.col("refers_to").isNotNull()
    uri = F.regexp_replace(F.coalesce(F.nullif("url", F.lit("")), F.lit("about:blank")), r"[\x00-\x20]", "%20")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(line * 2))
    block = F.concat(http, F.coalesce("html", F.lit("")))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{line}WARC-Record-ID: <{_ID}"), name,
        F.lit(f">{line}WARC-Date: {date}{line}WARC-Target-URI: "), uri,
        F.lit(f"{line}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{line}WARC-Profile: {_PROFILE}{line}WARC-Refers-To: <{_ID}"), F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{line}Content-Type: application/http;msgtype=response{line}Content-Length: "), F.octet_length(block).cast("string"), F.lit(line * 2),
    )
    record = F.concat(head, block, F.lit("\r\n\r\n")).cast("binary").alias("value")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        part, size = [], 0
        for batch in batches:
            for x in column(batch, "value"):
                plain = x.as_buffer()
                if part and size + plain.size > PART_BYTES:
                    yield b"".join(part)
                    part, size = [], 0
                part.append(gzip.compress(plain, 6, mtime=0))
                size += plain.size
        if part:
            yield b"".join(part)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the writer closes a file by its number of parts: one that is full by its bytes gets empty parts up to that
        row = lambda x: pa.RecordBatch.from_arrays([pa.array(x, pa.binary())], ["value"])
        n = size = 0
        for part in parts(batches):
            if n and size + len(part) > FILE_BYTES:
                yield row([b""] * (PARTS_PER_FILE - n))
                n = size = 0
            yield row([part])
            n, size = n + 1, size + len(part)
            if n == PARTS_PER_FILE:
                n = size = 0

    # a cast to string leaves the bytes as they are, and so does the text writer
    rows = pages.select(record).mapInArrow(members, "value binary").select(F.col("value").cast("string"))
    rows.write.option("compression", "none").option("encoding", "ISO-8859-1").option("lineSep", _EMPTY.decode("latin-1")).option("maxRecordsPerFile", PARTS_PER_FILE).text(path)


def _inflate(content: bytes, at: int) -> tuple[bytes, int, str | None]:
    """Plain bytes of the gzip member at ``at``, where it ends, and what is wrong with it.

    A step that fails is taken again in halves, down to one byte and what came out of that, so all bytes before a break are kept.
    """
    d, parts, step, halving, view = zlib.decompressobj(31), [], 1 << 12, False, memoryview(content)
    while at < len(content) and not d.eof:
        before = d.copy()
        try:
            parts.append(d.decompress(view[at : at + step]))
            at = min(at + step, len(content))
            step = step if halving else min(2 * step, _STEP)
        except zlib.error as e:
            d, halving = before, True
            if step > 1:
                step //= 2
                continue
            some = view[at : at + 1]
            with contextlib.suppress(zlib.error):
                while got := d.decompress(some, 1):
                    parts.append(got)
                    some = d.unconsumed_tail
            return b"".join(parts), at, f"gzip member broken: {e}"
    return b"".join(parts), at - len(d.unused_data), None if d.eof else "gzip member cut short"


def _unzip(content: bytes) -> Iterator[tuple[int, bytes, tuple[int, int, str] | None]]:
    """(offset, plain bytes, gap or None) for each gzip member; a broken one gives what came before the break."""
    at = 0
    while at < len(content):
        if content[at : at + 3] != _MEMBER:
            to = content.find(_MEMBER, at + 1)
            to = len(content) if to < 0 else to
            yield at, b"", (at, to - at, "no gzip member")
            at = to
            continue
        plain, end, fault = _inflate(content, at)
        if fault:
            to = content.find(_MEMBER, at + 1)
            to = len(content) if to < 0 else to
            yield at, plain, (at, to - at, fault)
            at = to
        else:
            yield at, plain, None
            at = end


def _record(plain: bytes, at: int, broken: bool = False) -> tuple[int, dict[str, str], bytes] | str:
    """End, headers and payload of the record at ``at``, or what is wrong with it; bytes of a broken member may be spoiled, so headers must be well-formed there."""
    stop = plain.find(b"\r\n\r\n", at)
    if not _VERSION.match(plain, at) or stop < 0:
        return "no version line or header end"
    if _VERSION.search(plain, at + 1, stop):
        return "version line within the headers"
    if broken and not all(map(_FIELD.fullmatch, plain[at:stop].split(b"\r\n")[1:])):
        return "header fields spoiled"
    headers = {k.strip().lower().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in plain[at:stop].split(b"\r\n")[1:])}
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        return "no content length"
    end = stop + 4 + int(length)
    if plain[end : end + 4] != b"\r\n\r\n":
        return "record end not where the content length says"
    block = plain[stop + 4 : end]
    http, _, payload = block.partition(b"\r\n\r\n") if headers.get("content-type", "").startswith("application/http") else (b"", b"", block)
    headers["http-content-length"] = (re.search(rb"(?im)^content-length:\s*(\d+)", http) or [b"", b"%d" % len(payload)])[1].decode()
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and digest.startswith("sha1:") and len(digest) == 45 and hashlib.sha1(payload).hexdigest() != digest[5:].lower():
        return "payload digest differs"
    return end + 4, headers, payload


def scan(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes] | tuple[int, int, str]]:
    """Records (offset, headers, payload) and gaps (offset, length, reason) of one archive, as they come.

    Offsets are those in the archive's plain bytes; gaps of broken gzip members are in its stored bytes, and their reason begins with gzip or no gzip.
    """
    base = 0
    zipped = content[:3] == _MEMBER or (content and not _VERSION.match(content) and _MEMBER in content)
    for _, plain, gap in _unzip(content) if zipped else [(0, content, None)]:
        if gap:
            yield gap
        at = 0
        while at < len(plain):
            got = _record(plain, at, gap is not None)
            if isinstance(got, str):
                later = _VERSION.search(plain, at + 1)
                to = later.start() if later else len(plain)
                if plain[at:to].strip():
                    yield base + at, to - at, got
                at = to
            else:
                yield base + at, got[1], got[2]
                at = got[0]
        base += len(plain)


def salvage(content: bytes) -> tuple[list[tuple[int, dict[str, str], bytes]], list[tuple[int, int, str]]]:
    """All records and all gaps of one archive."""
    found = list(scan(content))
    return [x for x in found if isinstance(x[1], dict)], [x for x in found if not isinstance(x[1], dict)]


_READ = "path string, kind string, offset long, length long, reason string, record_type string, record_id string, refers_to string, url string, payload_bytes long, payload_digest string, payload binary"


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record (kind 'record') and per gap (kind 'gap': offset, length, reason) of all archives under ``path``.

    payload_bytes and payload_digest are those of the full payload: measured for responses, from the headers for revisits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in _READ.split(", "))])
        rows, size = [], 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows.clear()
            return out

        for batch in batches:
            for i in range(batch.num_rows):
                name = column(batch, "path")[i].as_py()
                for at, h, x in scan(column(batch, "content")[i].as_py() or b""):
                    if not isinstance(h, dict):
                        rows.append((name, "gap", at, h, x, *[None] * 7))
                        continue
                    whole = h.get("warc-type") != "revisit"
                    rows.append((name, "record", at, None, None, h.get("warc-type"), h.get("warc-record-id", "").strip("<>"), h.get("warc-refers-to", "").strip("<>") or None, h.get("warc-target-uri"), len(x) if whole else int(h["http-content-length"]), hashlib.sha1(x).hexdigest() if whole else h.get("warc-payload-digest", "").removeprefix("sha1:"), x if payloads else None))
                    size += len(x) if payloads else 0
                    if len(rows) >= 1000 or size >= PART_BYTES:
                        yield flush()
                        size = 0
        if rows:
            yield flush()

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back, and return page_id, payload_bytes, payload_digest, record_type, refers_to.

    Every row has its record; rows with one page_id have one each, and of equal payloads with the largest page_id twice both
    are responses. Payloads of any length are kept whole. A gap, or a record that does not come back, is an OSError. An empty
    table gives an empty one.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(with_revisits(pages), path)
    back = settle(read(spark, path, payloads=False), "warc-records")
    wanted, (found, gaps) = pages.count(), back.agg(F.count_if(F.col("kind") == "record"), F.count_if(F.col("kind") == "gap")).first()
    if gaps or found != wanted:
        raise OSError(f"{path}: {found} of {wanted} records came back, with {gaps} gaps")
    number = lambda c: F.nullif(F.regexp_replace(c, f"^{_ID}", ""), F.lit("")).cast("long")
    return back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
