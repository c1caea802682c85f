"""Removal of repeated byte windows by a radix sort of suffixes that stops at the threshold depth.

A byte goes if a window of ``DEPTH`` bytes over it also begins in a document of smaller doc_id. Suffixes are sorted by
most-significant-digit passes, and only as deep as a window; what is left in one group after the last digit is exactly one
repeated window, and its least doc_id says which of its places go. After each pass, groups with one place or one document
are dropped.

The first digit of a window is its anchor: the bytes at its least hash among all its runs of ``GRAM`` bytes, which equal
windows share and neighbouring windows mostly share too, so a pass moves an anchor instead of some sixteen suffixes.
1. All anchors are dealt by hash; those in one document drop out, the others are told back to their documents.
2. What is left goes again, with the bytes of all the windows that have this anchor, and is sorted by the further digits.
   A share of it beyond ``MOST`` entries is passed on to a third pass, dealt by single windows, so memory stays bounded.
Before each pass a task combines what it holds, so that a group of near copies sends one entry a task; a task that receives
combines too whenever it holds many entries, so of equal windows it keeps those of the least document only. Exact copies
are found by digest first: every byte of the later ones goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, join_checked, passes, raw, settle
from .hashing import _BASE, _BYTE, _INVERSE, mix, powers

DEPTH, GRAM = 50, 20
SPREAD = DEPTH - GRAM + 1
CONTEXT = DEPTH + SPREAD - 1
#: Entries that a task combines before it sends them, and that one share of the second pass may have in memory.
CHUNK, MOST = 500_000, 400_000
#: Entries whose single windows are made, and combined, at a time.
SINGLES = 20_000
#: Bytes of text for each share that the anchors are dealt into, so that shares do not grow with the input.
SHARE_BYTES = 2 << 20
_LOW = np.uint64((1 << 48) - 1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ANCHOR = np.dtype([("h", "<u8"), ("doc", "<i8")])
_PLACE = np.dtype([("h", "<u8"), ("doc", "<i8"), ("row", "<i4"), ("pos", "<i4"), ("left", "u1"), ("size", "u1")])
_SPAN = np.dtype([("doc", "<i8"), ("row", "<i4"), ("start", "<i4"), ("end", "<i4")])


def pack(rows: np.ndarray, text: np.ndarray | None = None) -> bytes:
    """Byte planes of the records (they compress better), then the text rows."""
    return rows.view(np.uint8).reshape(len(rows), -1).T.tobytes() + (text.tobytes() if text is not None else b"")


def unpack(blob: bytes, dtype: np.dtype, width: int = 0) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // (dtype.itemsize + width)
    head = np.frombuffer(blob, dtype=np.uint8, count=n * dtype.itemsize).reshape(dtype.itemsize, n)
    return np.ascontiguousarray(head.T).reshape(-1).view(dtype), np.frombuffer(blob, dtype=np.uint8, offset=n * dtype.itemsize).reshape(n, width)


def _slide(x: np.ndarray, op: Callable, width: int) -> np.ndarray:
    """op over x[i : i + width] for every i that has them all."""
    span = 1
    while span * 2 <= width:
        x = op(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return op(x[:-rest], x[rest:]) if rest else x


def find_anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all anchors, hashes of all grams, and the least hash of the window at every place (0: no whole window)."""
    n = len(data)
    if n < DEPTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * powers(_BASE, n), out=sums[1:])
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers(_INVERSE, n)[: n - GRAM + 1])
    least = _slide(grams, np.minimum, SPREAD)  # for windows 0 .. n - DEPTH
    ends = at[1:][at[1:] > at[:-1]]
    for e in ends[:-1]:  # windows that would run over the end of a text
        least[max(0, e - DEPTH + 1) : e] = 0
    padded = np.zeros(len(least) + 2 * (SPREAD - 1), dtype=np.uint64)
    padded[SPREAD - 1 : SPREAD - 1 + len(least)] = least
    most = _slide(padded, np.maximum, SPREAD)  # over the windows that have the gram at each place
    return np.flatnonzero(most == grams), grams, least


def _batch(form: str, /, **columns) -> pa.RecordBatch:
    schema = _SCHEMAS[form]
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_SCHEMAS = {
    "dealt": pa.schema([("shard", pa.int32()), ("kind", pa.int8()), ("doc_id", pa.int64()), ("blob", pa.binary())]),
    "told": pa.schema([("doc_id", pa.int64()), ("blob", pa.binary())]),
    "spans": pa.schema([("doc_id", pa.int64()), ("row", pa.int32()), ("blob", pa.binary())]),
}
_DEALT, _TOLD, _SPANS = "shard int, kind byte, doc_id long, blob binary", "doc_id long, blob binary", "doc_id long, row int, blob binary"


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal keys in sorted rows."""
    if not len(keys[0]):
        return np.zeros(1, dtype=np.int64)
    new = np.zeros(len(keys[0]), dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), len(keys[0]))


def _shared(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of anchors sorted by (h, doc) without repeats: which are in more than one document, and the first row of each group."""
    bounds = _runs(rows["h"])
    size = np.diff(bounds)
    return np.repeat(size > 1, size), bounds[:-1]


def _tell(rows: np.ndarray, shard: Callable | None = None) -> pa.RecordBatch | None:
    """The anchors' hashes, one row per document."""
    if not len(rows):
        return None
    rows = rows[np.argsort(rows["doc"], kind="stable")]
    bounds = _runs(rows["doc"])
    docs, blobs = rows["doc"][bounds[:-1]], [rows["h"][a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return _batch("told", doc_id=docs, blob=blobs) if shard is None else _batch("dealt", shard=shard(docs), kind=np.ones(len(docs), np.int8), doc_id=docs, blob=blobs)


def _sorted_anchors(parts: list[np.ndarray]) -> np.ndarray:
    rows = np.concatenate([*parts, np.zeros(0, _ANCHOR)])
    rows = rows[np.lexsort((rows["doc"], rows["h"]))]
    return rows[_runs(rows["h"], rows["doc"])[:-1]]


def _deal(rows: np.ndarray, text: np.ndarray | None, shards: int, kind: int = 0) -> pa.RecordBatch | None:
    """Records by share of their hash, one row a share."""
    if not len(rows):
        return None
    share = (mix(rows["h"]) % np.uint64(shards)).astype(np.int32)
    order = np.argsort(share, kind="stable")
    bounds = _runs(share[order])
    blobs = [pack(rows[order[a:b]], None if text is None else text[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return _batch("dealt", shard=share[order][bounds[:-1]], kind=np.full(len(blobs), kind, np.int8), doc_id=pa.nulls(len(blobs), pa.int64()), blob=blobs)


def _send_anchors(shards: int):
    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = _sorted_anchors(parts)
        here, first = _shared(rows)
        by_doc = lambda docs: (mix(docs.view(np.uint64)) % np.uint64(shards)).astype(np.int32)
        yield from filter(None, [_tell(rows[here], by_doc), _deal(rows[first], None, shards)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch, texts in passes(batches, "text"):
            data, at = raw(texts)
            places, grams, _ = find_anchors(data, at)
            rows = np.zeros(len(places), _ANCHOR)
            rows["h"] = grams[places] & _LOW
            rows["doc"] = column(batch, "doc_id").to_numpy()[np.searchsorted(at, places, "right") - 1]
            parts.append(rows)
            held += len(rows)
            if held >= CHUNK:
                yield from flush(parts)
                parts, held = [], 0
        yield from flush(parts)

    return run


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int | None, bytes]]:
    for batch in batches:
        yield from zip(*(column(batch, c).to_pylist() for c in ("shard", "kind", "doc_id", "blob")), strict=True)


def _meet_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pass: told rows go on; anchors that two documents have are told to those that sent them."""
    parts, now, found, held = [], None, [], 0
    passed: list[tuple[int, bytes]] = []

    def close() -> int:
        rows = _sorted_anchors(parts)
        found.append(rows[_shared(rows)[0]])
        parts.clear()
        return len(found[-1])

    for shard, kind, doc, blob in _by_shard(batches):
        if kind:
            passed.append((doc, blob))
            if len(passed) >= 5000:
                yield _batch("told", doc_id=[d for d, _ in passed], blob=[b for _, b in passed])
                passed.clear()
            continue
        if shard != now:
            held += close()
            now = shard
            if held >= CHUNK:
                yield _tell(np.concatenate(found))
                found, held = [], 0
        parts.append(unpack(blob, _ANCHOR)[0])
    close()
    if passed:
        yield _batch("told", doc_id=[d for d, _ in passed], blob=[b for _, b in passed])
    if last := _tell(np.concatenate(found)):
        yield last


def _digits(text: np.ndarray) -> list[np.ndarray]:
    """The rows' bytes as 64-bit digits, most significant first."""
    width = -(-text.shape[1] // 8) * 8
    full = np.zeros((len(text), width), dtype=np.uint8)
    full[:, : text.shape[1]] = text
    return [np.ascontiguousarray(full[:, i : i + 8]).view(">u8").reshape(-1).astype(np.uint64) for i in range(0, width, 8)]


def _radix(keys: Callable[[int, np.ndarray], np.ndarray], digits: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are equal in all digits to a row of another document, in the order of their groups, and the groups' bounds.

    A pass per digit, most significant first; groups of one document are dropped after each.
    """
    at = np.arange(len(docs))
    group = np.zeros(len(docs), dtype=np.int64)
    for d in range(digits):
        key = keys(d, at)
        order = np.lexsort((key, group))
        at, group, key = at[order], group[order], key[order]
        bounds = _runs(group, key)
        if len(bounds) == 1:
            return at, bounds
        size, own = np.diff(bounds), docs[at]
        several = np.maximum.reduceat(own, bounds[:-1]) != np.minimum.reduceat(own, bounds[:-1])
        group = np.repeat(np.arange(len(size)), size)
        keep = np.repeat(several, size)
        at, group = at[keep], group[keep]
        if not len(at):
            break
    return at, _runs(group)


def _same_contexts(rows: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows stand for their group of equal contexts (those of its least document), and which have a smaller document there."""
    head = (rows["h"] << np.uint64(16)) | (rows["left"].astype(np.uint64) << np.uint64(8)) | rows["size"]
    digits = _digits(text)
    at, bounds = _radix(lambda d, i: head[i] if d == 0 else digits[d - 1][i], 1 + len(digits), rows["doc"])
    later = np.zeros(len(rows), dtype=bool)
    if len(at):
        least = np.minimum.reduceat(rows["doc"][at], bounds[:-1])
        later[at] = rows["doc"][at] > np.repeat(least, np.diff(bounds))
    return ~later, later


def _spans(rows: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    out = np.zeros(len(rows), _SPAN)
    out["doc"], out["row"], out["start"], out["end"] = rows["doc"], rows["row"], start, start + size
    return out


def _windows(rows: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every row the row and the offset in its context."""
    n = rows["size"].astype(np.int64) - DEPTH + 1
    return np.repeat(np.arange(len(rows)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _window_text(text: np.ndarray, row: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(text, DEPTH, axis=1)[row, offset]


def _sort_windows(rows: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Spans of all windows that a smaller document has as well."""
    row, offset = _windows(rows, text)
    docs = rows["doc"][row]
    first = (rows["h"][row] << np.uint64(8)) | (rows["left"][row].astype(np.int64) - offset + DEPTH).astype(np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(text, DEPTH, axis=1)

    def key(d: int, at: np.ndarray) -> np.ndarray:
        if d == 0:
            return first[at]
        part = view[row[at], offset[at], 8 * (d - 1) : 8 * d]
        return _digits(part)[0]

    at, bounds = _radix(key, 1 + -(-DEPTH // 8), docs)
    if not len(at):
        return np.zeros(0, _SPAN)
    least = np.minimum.reduceat(docs[at], bounds[:-1])
    at = at[docs[at] > np.repeat(least, np.diff(bounds))]
    return _spans(rows[row[at]], rows["pos"][row[at]] + offset[at], DEPTH)


def _span_rows(parts: list[np.ndarray]) -> pa.RecordBatch | None:
    """Merged spans, one row per document."""
    rows = np.concatenate([*parts, np.zeros(0, _SPAN)])
    if not len(rows):
        return None
    rows = rows[np.lexsort((rows["end"], rows["start"], rows["row"], rows["doc"]))]
    bounds = _runs(rows["doc"], rows["row"])
    blobs = [merge(np.stack([rows["start"][a:b], rows["end"][a:b]], axis=1)).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return _batch("spans", doc_id=rows["doc"][bounds[:-1]], row=rows["row"][bounds[:-1]], blob=blobs)


def merge(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of spans that overlap or touch; spans are sorted by start."""
    if not len(spans):
        return spans
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:] - 1, len(spans) - 1)]], axis=1).astype("<i4")


def _send_contexts(shards: int):
    """Second pass, sending: kind 0 contexts, kind 1 (with the doc_id) spans found within the task."""

    def flush(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows, text = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        stay, later = _same_contexts(rows, text)
        if later.any():
            yield _as_dealt(_spans(rows[later], rows["pos"][later], rows["size"][later].astype(np.int32)), shards)
        yield from filter(None, [_deal(rows[stay], text[stay], shards)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch, texts in passes(batches, "text"):
            data, at = raw(texts)
            places, grams, least = find_anchors(data, at)
            of = np.searchsorted(at, places, "right") - 1
            low = grams[places] & _LOW
            bounds = np.searchsorted(of, np.arange(len(texts) + 1))
            keep = np.zeros(len(places), dtype=bool)
            for i, (told, copy) in enumerate(zip(column(batch, "told").to_pylist(), column(batch, "copy").to_pylist(), strict=True)):
                if told and not copy and bounds[i + 1] > bounds[i]:
                    known = np.unique(np.frombuffer(b"".join(told), dtype="<u8"))
                    mine = low[bounds[i] : bounds[i + 1]]
                    keep[bounds[i] : bounds[i + 1]] = known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine
            places, of, low = places[keep], of[keep], low[keep]
            if not len(places):
                continue
            back = places[:, None] - np.arange(SPREAD - 1, -1, -1)  # windows that have the anchor, first to last
            inside = (back >= 0) & (back < len(least))
            has = inside & (least[np.clip(back, 0, len(least) - 1)] == grams[places][:, None])
            start = back[np.arange(len(places)), has.argmax(axis=1)]
            size = has.sum(axis=1) + DEPTH - 1
            rows = np.zeros(len(places), _PLACE)
            rows["h"], rows["doc"] = low, pc.fill_null(column(batch, "doc_id"), 0).to_numpy()[of]
            rows["row"] = column(batch, "row").to_numpy(zero_copy_only=False)[of]
            rows["pos"], rows["left"], rows["size"] = start - at[of], places - start, size
            padded = np.concatenate([data, np.zeros(CONTEXT, np.uint8)])
            text = padded[start[:, None] + np.arange(CONTEXT)]
            text[np.arange(CONTEXT) >= size[:, None]] = 0
            parts.append((rows, text))
            held += len(rows)
            if held >= CHUNK // 5:
                yield from flush(parts)
                parts, held = [], 0
        if parts:
            yield from flush(parts)

    return run


def _as_dealt(spans: np.ndarray, shards: int) -> pa.RecordBatch:
    told = _span_rows([spans])
    docs = told.column(0).to_numpy()
    blobs = [int(r).to_bytes(4, "little", signed=True) + b for r, b in zip(told.column(1).to_pylist(), told.column(2).to_pylist(), strict=True)]
    return _batch("dealt", shard=(mix(docs.view(np.uint64)) % np.uint64(shards)).astype(np.int32), kind=np.ones(len(docs), np.int8), doc_id=docs, blob=blobs)


def _combined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of the least document of each context, their text, and the spans of all others."""
    rows, text = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    stay, later = _same_contexts(rows, text)
    return rows[stay], text[stay], _spans(rows[later], rows["pos"][later], rows["size"][later].astype(np.int32))


def _meet_contexts(most: int, shards: int, last: bool = False):
    """Second pass, receiving. Spans come out as kind 1; single windows of shares beyond ``most`` entries as kind 0.

    Beyond ``most`` entries equal contexts are combined. If half of them or more are left the share is passed on; the last
    pass goes on with what is left, a window's least document, until that has doubled.
    """

    def solve(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
        rows, text, gone = _combined(parts)
        yield gone
        order = np.argsort(rows["h"], kind="stable")
        rows, text = rows[order], text[order]
        bounds = _runs(rows["h"])
        a = 0
        while a < len(rows):  # whole groups of one anchor, some ten thousand entries at a time
            b = int(bounds[max(np.searchsorted(bounds, a + 10_000, "right") - 1, np.searchsorted(bounds, a, "right"))])
            yield _sort_windows(rows[a:b], text[a:b])
            a = b

    def single(rows: np.ndarray, text: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(rows["h"], kind="stable")
        for a in range(0, len(rows), SINGLES):
            some = order[a : a + SINGLES]
            row, offset = _windows(rows[some], text[some])
            own = _window_text(text[some], row, offset)
            out = rows[some][row]
            out["pos"], out["size"] = out["pos"] + offset, DEPTH
            key = np.zeros(len(out), dtype=np.uint64)
            for d in _digits(own):
                key = mix(key ^ d)
            out["left"], out["h"] = 0, key & _LOW
            out, own, gone = _combined([(out, own)])
            if len(gone):
                yield _as_dealt(gone, shards)
            yield from filter(None, [_deal(out, np.pad(own, ((0, 0), (0, CONTEXT - DEPTH))), shards)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, now, held, over, room = [], None, 0, False, most
        spans: list[np.ndarray] = []
        ready = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal parts, held
            if parts and over:
                rows, text, gone = _combined(parts)
                spans.append(gone)
                yield from single(rows, text)
            elif parts:
                spans.extend(solve(parts))
            parts, held = [], 0
            if sum(map(len, spans)) >= CHUNK:
                yield _as_dealt(np.concatenate(spans), shards)
                spans.clear()

        for shard, kind, doc, blob in _by_shard(batches):
            if kind:
                own = np.frombuffer(blob, dtype="<i4", offset=4).reshape(-1, 2)
                s = np.zeros(len(own), _SPAN)
                s["doc"], s["row"], s["start"], s["end"] = doc, int.from_bytes(blob[:4], "little", signed=True), own[:, 0], own[:, 1]
                spans.append(s)
                ready += 1
                if ready % 20_000 == 0:
                    yield _as_dealt(np.concatenate(spans), shards)
                    spans.clear()
                continue
            if shard != now:
                yield from close()
                now, over, room = shard, False, most
            parts.append(unpack(blob, _PLACE, CONTEXT))
            held += len(parts[-1][0])
            if held > room:
                rows, text, gone = _combined(parts)
                spans.append(gone)
                parts, held = [(rows, text)], len(rows)
                if last:
                    room = max(most, 2 * held)
                elif over or 2 * held >= most:
                    over = True
                    yield from single(rows, text)
                    parts, held = [], 0
                if sum(map(len, spans)) >= CHUNK:
                    yield _as_dealt(np.concatenate(spans), shards)
                    spans.clear()
        yield from close()
        if spans and sum(map(len, spans)):
            yield _as_dealt(np.concatenate(spans), shards)

    return run


def repeated_spans(rows: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id and blobs (row, then starts and ends) of what to remove, for documents (doc_id, row, copy, text); copies take no part."""
    size = int(rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0])
    shards = max(256, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // SHARE_BYTES)
    dealt = lambda df: df.repartition("shard").sortWithinPartitions("shard")
    taking = rows.filter("doc_id is not null and not copy").select("doc_id", "text")
    told = dealt(taking.mapInArrow(_send_anchors(shards), _DEALT)).mapInArrow(_meet_anchors, _TOLD)
    by_doc = told.groupBy("doc_id").agg(F.collect_list("blob").alias("told")).withColumnRenamed("doc_id", "_doc")
    # a left join, as in remove_repeats, so that Spark moves the texts once for both
    joined = rows.join(by_doc, F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "row", "copy", "text", "told")
    met = dealt(joined.mapInArrow(_send_contexts(shards), _DEALT)).mapInArrow(_meet_contexts(most, shards), _DEALT)
    # single windows of large shares meet by their bytes: exact at any size; spans pass through
    return dealt(met).mapInArrow(_meet_contexts(most, shards, last=True), _DEALT).select("doc_id", "blob")


def remove_repeats(documents: DataFrame, most: int = MOST, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row, and kept (binary) if asked for.

    Null text is empty. Rows with one doc_id repeat nothing of each other; a null doc_id is neither smaller nor larger than
    any: nothing of it goes, and it makes nothing go. Of ties the smallest doc_id keeps its bytes. Texts of any length are
    taken whole, one at a time. Only doc_id and text are read. An empty table gives an empty one.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.hash(text).alias("row"), F.unhex(F.md5(text)).alias("digest"))
    owners = settle(plain.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner <> last").select("digest", "owner"), "copies")
    tagged = join_checked(plain, owners, ["digest"], how="left").select("doc_id", "row", F.coalesce(F.col("doc_id") > F.col("owner"), F.lit(False)).alias("copy"), "text")
    spans = repeated_spans(tagged, most)
    lists = spans.groupBy("doc_id").agg(F.collect_list("blob").alias("spans")).withColumnRenamed("doc_id", "_doc")
    joined = tagged.join(lists, F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "row", "copy", "text", "spans")
    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()} | ({"kept": pa.binary()} if with_text else {})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in passes(batches, "text"):
            out = []
            for doc, row, copy, x, blobs in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "row", "copy")), texts.to_pylist(), column(batch, "spans").to_pylist(), strict=True):
                data = x.encode()
                if copy and len(data) >= DEPTH:
                    gone = np.array([[0, len(data)]])
                else:
                    own = [np.frombuffer(b, dtype="<i4", offset=4).reshape(-1, 2) for b in blobs or [] if int.from_bytes(b[:4], "little", signed=True) == row]
                    gone = np.concatenate([*own, np.zeros((0, 2), "<i4")])
                    gone = merge(gone[np.lexsort((gone[:, 1], gone[:, 0]))])
                edges = [0, *gone.reshape(-1).tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((doc, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), *([kept] if with_text else [])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.values(), strict=True)], list(kinds))

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else ""))
