"""Media columns: signature sniffing and carving.

An Aho-Corasick automaton finds the magic bytes of all formats in one pass over the stored bytes; a validator per format
then confirms the structure and tells the length. What is confirmed corrects the declared type and is carved out. All of
it is per row: no shuffle, and memory for one batch of rows.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, passes

BLOCK = 192
# Signatures of the formats and where in the file each stands.
SIGNATURES = {
    b"\x89PNG\r\n\x1a\n": "image/png",
    b"\xff\xd8\xff": "image/jpeg",
    b"GIF87a": "image/gif",
    b"GIF89a": "image/gif",
    b"BM": "image/bmp",
    b"RIFF": "riff",
    b"%PDF-": "application/pdf",
    b"\x1f\x8b\x08": "application/gzip",
}


def _png(b: bytes, at: int) -> int | None:
    p = at + 8
    while p + 12 <= len(b):
        (n,) = struct.unpack_from(">I", b, p)
        kind = b[p + 4 : p + 8]
        if p + 12 + n > len(b) or zlib.crc32(b[p + 4 : p + 8 + n]) != struct.unpack_from(">I", b, p + 8 + n)[0] or (p == at + 8) != (kind == b"IHDR"):
            return None
        p += 12 + n
        if kind == b"IEND":
            return p - at
    return None


def _jpeg(b: bytes, at: int) -> int | None:
    p = at + 2
    while p + 4 <= len(b):
        if b[p] != 0xFF:
            return None
        kind = b[p + 1]
        if kind == 0xD9:
            return p + 2 - at
        n = int.from_bytes(b[p + 2 : p + 4], "big")
        if n < 2 or p + 2 + n > len(b):
            return None
        p += 2 + n
        if kind == 0xDA:  # entropy-coded data up to the next marker that is neither stuffing nor a restart
            while p + 1 < len(b) and not (b[p] == 0xFF and b[p + 1] != 0 and not 0xD0 <= b[p + 1] <= 0xD7):
                p += 1
            if p + 1 < len(b) and b[p + 1] == 0xD9:
                return p + 2 - at
    return None


def _gif(b: bytes, at: int) -> int | None:
    def blocks(p: int) -> int:
        while p < len(b) and b[p]:
            p += 1 + b[p]
        return p + 1

    if at + 13 > len(b):
        return None
    p = at + 13 + (3 << (b[at + 10] & 7) + 1 if b[at + 10] & 0x80 else 0)
    while p < len(b):
        if b[p] == 0x3B:
            return p + 1 - at
        if b[p] == 0x21:
            p = blocks(p + 2)
        elif b[p] == 0x2C and p + 10 < len(b):
            p = blocks(p + 11 + (3 << (b[p + 9] & 7) + 1 if b[p + 9] & 0x80 else 0))
        else:
            return None
    return None


def _bmp(b: bytes, at: int) -> int | None:
    if at + 30 > len(b):
        return None
    size, zero, start, head = struct.unpack_from("<IIII", b, at + 2)
    planes, bits = struct.unpack_from("<HH", b, at + 26)
    good = head in (40, 52, 56, 108, 124) and zero == 0 and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and 14 + head <= start <= size <= len(b) - at
    return size if good else None


def _riff(b: bytes, at: int) -> int | None:
    if at + 20 > len(b) or b[at + 8 : at + 12] not in (b"WAVE", b"WEBP"):
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    p = at + 12
    if end > len(b):
        return None
    while p + 8 <= end:
        p += 8 + (n := struct.unpack_from("<I", b, p + 4)[0]) + (n & 1)
    return end - at if p == end else None


def _pdf(b: bytes, at: int) -> int | None:
    end = b.rfind(b"%%EOF", at)
    return end + 5 - at if end > at and b[at + 5 : at + 6].isdigit() and b.rfind(b"startxref", at, end) > at else None


def _gzip(b: bytes, at: int) -> int | None:
    try:
        d = zlib.decompressobj(31)
        for i in range(at, len(b), 1 << 16):
            part, d_in = b[i : i + (1 << 16)], d
            while part and not d.eof:
                d_in.decompress(part, 1 << 20)
                part = d_in.unconsumed_tail
            if d.eof:
                return i + min(1 << 16, len(b) - i) - len(d.unused_data) - at
    except zlib.error:
        pass
    return None


_VALID = {"image/png": _png, "image/jpeg": _jpeg, "image/gif": _gif, "image/bmp": _bmp, "riff": _riff, "application/pdf": _pdf, "application/gzip": _gzip}


@functools.cache
def _automaton():
    """One for each worker."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic, kind in SIGNATURES.items():
        found.add_word(magic.decode("latin-1"), (len(magic), kind))
    found.make_automaton()
    return found


def segments(content: bytes, automaton=None) -> list[tuple[int, int, str]]:
    """(offset, length, type) of every confirmed medium, left to right; what lies within one already found is part of it."""
    out, end = [], 0
    for last, (n, kind) in (automaton or _automaton()).iter(content.decode("latin-1")):
        at = last - n + 1
        if at >= end and (length := _VALID[kind](content, at)):
            kind = {b"WAVE": "audio/wav", b"WEBP": "image/webp"}[content[at + 8 : at + 12]] if kind == "riff" else kind
            out.append((at, length, kind))
            end = at + length
    return out


def sniff(df: DataFrame, content: str = "content", declared: str = "declared") -> DataFrame:
    """All rows of ``df`` with ``media_type`` and ``segments`` (array of offset, length, type).

    media_type: the type of a medium that begins at byte 0, else the declared one. Null or empty content has no segments
    and keeps its declared type. Columns with these two names are replaced.
    """

    @F.pandas_udf("media_type string, segments array<struct<offset:long,length:long,type:string>>")
    def find(contents, types):
        import pandas as pd

        automaton, out = _automaton(), []
        for c, t in zip(contents, types, strict=True):
            got = segments(bytes(c), automaton) if c else []
            out.append((got[0][2] if got and got[0][0] == 0 else t, [{"offset": a, "length": n, "type": k} for a, n, k in got]))
        return pd.DataFrame(out, columns=["media_type", "segments"])

    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("media_type", "segments")]
    return df.select(*rest, find(F.col(content), F.col(declared)).alias("_found")).select(*rest, "_found.*")


def wav(samples: bytes, rate: int = 8000) -> bytes:
    """One channel of unsigned 8-bit PCM."""
    pad = len(samples) & 1
    return b"RIFF" + struct.pack("<I", 36 + len(samples) + pad) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * pad


def wav_samples(content: bytes, at: int = 0) -> bytes:
    """Samples of the data chunk of a WAV that begins at ``at``."""
    end, p = at + 8 + struct.unpack_from("<I", content, at + 4)[0], at + 12
    while p + 8 <= end:
        n = struct.unpack_from("<I", content, p + 4)[0]
        if content[p : p + 4] == b"data":
            return content[p + 8 : p + 8 + n]
        p += 8 + n + (n & 1)
    raise ValueError("no data chunk")


def payload_of(text: bytes) -> bytes:
    """The text and blanks up to a positive multiple of 192 bytes."""
    return text + b" " * (max(BLOCK, -(-len(text) // BLOCK) * BLOCK) - len(text))


def store_texts(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, content (the text's payload as a WAV of 8-bit samples), declared ('application/octet-stream'). Null text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in passes(batches, "text"):
            raw = [x.encode() for x in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(map(len, raw), pa.int64()), pa.array([wav(payload_of(x)) for x in raw], pa.binary()), pa.array(["application/octet-stream"] * len(raw))], ["doc_id", "n_bytes", "content", "declared"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, content binary, declared string")


def _feature(kind: str, samples: bytes) -> str:
    x = np.frombuffer(samples, dtype=np.uint8).astype(np.int64)
    y = x - 128
    blocks = x.reshape(-1, BLOCK).sum(axis=1)
    return f"{kind};n={len(x)};sum={x.sum()};energy={(y * y).sum()};min={x.min()};max={x.max()};crossings={(np.diff(y >= 0)).sum()};steps={np.abs(np.diff(x)).sum()};loudest={int(blocks.argmax())}"


def features(stored: DataFrame) -> DataFrame:
    """Sniffs ``store_texts``' rows, carves the medium, reads its samples back and describes them: the columns of the query op3.

    Every row has its own result; equal texts have equal ones, null and empty ones that of 192 blanks. Of ties in loudness
    the first block counts. Texts of any length are stored whole. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, n, content, kind, found in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "n_bytes", "content", "media_type", "segments")), strict=True):
                at, length = found[0]["offset"], found[0]["length"]
                media = content[at : at + length]
                samples = wav_samples(media)
                out.append((doc, n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(media), hashlib.sha256(media).hexdigest(), _feature(kind, samples), kind))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES.values(), strict=True)], list(_TYPES))

    return sniff(stored).mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media_type string")


_TYPES = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "media_type": pa.string()}
