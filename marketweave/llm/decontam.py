"""Benchmark decontamination by an embedding of edit distance into Hamming distance.

Texts are normalised: lower case A-Z, and every run of ASCII bytes that are no letters or digits becomes one blank. From
an anchor a random walk reads one byte per step and moves on or stays by a random bit that depends on step and byte;
the bytes read are the embedding. Windows of small edit distance fall into step again and have small Hamming distance.
Several walks are made and of each several samples of steps are hashed; windows that share one hash with an item's window
are candidates. For a candidate the document's stretches of whole words of the item's size are compared by exact edit
distance (bit-parallel; first a count of shared 4-grams that any such stretch has), and the nearest is kept if that is at
most ``max_edits`` of the item's length. This is so for items of every length.

An item has several windows: an anchor is a word start that a hash of the next bytes selects, in documents and items alike,
and an item with few anchors selects more. A window has the largest of ``SIZES`` steps that an item has three times over, so
that several fit in. (One window over a whole item was tried by reckoning only: at 15 % edits its walk is out of step for
most of its length, and a sample of enough steps to tell items apart agrees once in many thousand times.) How many walks are
made follows from ``recall``, for each size of window on its own: copies of the items with ``max_edits`` random edits are
searched, and walks added until that share is found among items of each length (lengths are classed by doublings). Where
``PATIENCE`` further walks find nothing more, a warning tells the share that is found.

Items go to the tasks as one broadcast value; their number is checked, and larger sets are gone through in blocks, each a
pass over the documents. Documents are not shuffled; hits are few columns.
"""

from __future__ import annotations

import logging
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, passes, raw
from .hashing import LOWER, mix

#: Characters of all items in one block: what is broadcast is bounded by it.
BLOCK_CHARS = 4_000_000
SIZES = (1, 3, 8, 16, 40)
SAMPLES, SAMPLED = 3, 13
LEAST_ANCHORS = 4
RECALL = 0.95
#: Walks without gain after which no more are added.
PATIENCE = 4
#: Items of each class of length, by hash of their text, of which edited copies are searched to find the number of walks,
#: and the least number of copies.
TRIED, COPIES = 300, 100
#: Share of the steps of a candidate that must read the same bytes as the item's.
AGREE = 0.6
MAX_EDITS = 0.15

_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def normalise(data: np.ndarray, at: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes with ``gap`` zeros after each text, the texts' bounds there (start, end), and each byte's place in ``data``."""
    low = LOWER[data]
    plain = _PLAIN[low]
    low = np.where(plain, low, 32)
    keep = plain.copy()
    if len(data):
        after = np.zeros(len(data), dtype=bool)
        after[1:] = plain[:-1]
        starts = at[:-1][at[:-1] < len(data)]
        after[starts] = False
        keep |= after & ~plain  # the first of a run of others, if something stands before it in its text
    kept = np.concatenate(([0], np.cumsum(keep)))[at]
    n = kept[1:] - kept[:-1]
    begin = kept[:-1] + gap * np.arange(len(n))
    out = np.zeros(int(kept[-1]) + gap * len(n), dtype=np.uint8)
    where = np.flatnonzero(keep)
    target = np.arange(len(where)) + np.repeat(gap * np.arange(len(n)), n)
    out[target] = low[where]
    place = np.zeros(len(out), dtype=np.int64)
    place[target] = where
    return out, np.stack([begin, begin + n]), place


class Walks:
    def __init__(self, steps: int, walks: int):
        self.steps, self.walks = steps, walks
        self.move = np.zeros((walks, steps, 256), dtype=np.int64)
        self.sampled = np.zeros((walks, SAMPLES, steps), dtype=bool)
        for w in range(walks):
            random = np.random.Generator(np.random.PCG64([steps, w]))
            self.move[w] = random.integers(0, 2, (steps, 256))
            for s in range(SAMPLES):
                self.sampled[w, s, random.choice(steps, min(steps, SAMPLED, max(8, steps * 5 // 8)), replace=False)] = True
        self.times = np.uint64(0x9E3779B97F4A7C15)

    def keys(self, text: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        """For each walk and sample the hashes of the windows that begin at ``at``; ``text`` has ``steps`` bytes behind each."""
        for w in range(self.walks):
            place = at.copy()
            out = [np.full(len(at), 17 * w + s, dtype=np.uint64) for s in range(SAMPLES)]
            with np.errstate(over="ignore"):
                for j in range(self.steps):
                    c = text[place]
                    for s in range(SAMPLES):
                        if self.sampled[w, s, j]:
                            out[s] *= self.times
                            out[s] += c
                    place += self.move[w, j][c]
            yield from map(mix, out)

    def traces(self, walk: int, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The bytes that the windows at ``at`` read, a row each: the embeddings themselves."""
        place, out = at.copy(), np.zeros((len(at), self.steps), dtype=np.uint8)
        for j in range(self.steps):
            out[:, j] = text[place]
            place += self.move[walk, j][out[:, j]]
        return out


def selection() -> np.ndarray:
    """By a 16-bit hash of three bytes, whether a word that begins with them is an anchor: a third at first."""
    return np.arange(1 << 16) % 3 == 0


def anchors(text: np.ndarray, selected: np.ndarray) -> np.ndarray:
    """Word starts whose next three bytes are selected."""
    at, value = word_starts(text)
    return at[selected[value]]


def word_starts(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word starts, and the 16-bit hash of the three bytes from there."""
    start = np.zeros(len(text), dtype=bool)
    if len(text) > 3:
        start[0] = text[0] > 32
        start[1:] = (text[1:] > 32) & (text[:-1] <= 32)
        start[-3:] = False
    at = np.flatnonzero(start)
    value = (text[at].astype(np.uint64) << np.uint64(16)) + (text[at + 1].astype(np.uint64) << np.uint64(8)) + text[at + 2]
    return at, (mix(value) >> np.uint64(48)).astype(np.int64)


def _masks(pattern: bytes) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _distances(masks: dict[int, int], m: int, text: bytes, anywhere: bool) -> Iterator[int]:
    """For each end in ``text`` the edit distance of a pattern of ``m`` bytes to the stretch from the text's start to there, or from ``anywhere``."""
    full, top, edge = (1 << m) - 1, 1 << m - 1, 0 if anywhere else 1
    up, down, score = full, 0, m
    for c in text:
        eq = masks.get(c, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        h_up, h_down = down | (full & ~(x | up)), up & x
        score += 1 if h_up & top else -1 if h_down & top else 0
        h_up, h_down = h_up << 1 & full | edge, h_down << 1 & full
        y = eq | down
        up, down = h_down | (full & ~(y | h_up)), h_up & y
        yield score


def nearest(pattern: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """(edit distance, end in ``text``) of the stretch of ``text``, of any bytes, nearest to ``pattern``, or None if it is over ``most`` edits away."""
    distances = enumerate(_distances(_masks(pattern), len(pattern), text, True), 1)
    best = min(((edits, j) for j, edits in distances), default=(len(pattern), 0))
    best = min(best, (len(pattern), 0))
    return best if best[0] <= most else None


def words_near(pattern: bytes, text: bytes, most: int, opens: bool = True, closes: bool = True) -> tuple[int, int, int] | None:
    """(edit distance, end, start) of the nearest stretch of whole words, the first of equals, or None if none is within ``most`` edits.

    ``opens`` and ``closes`` tell whether a word may begin and end where ``text`` does.
    """
    m, n, best = len(pattern), len(text), None
    # read backwards: the least distance of all stretches that begin at a place
    least = [*_distances(_masks(pattern[::-1]), m, text[::-1], True)][::-1]
    starts = sorted((least[i], i) for i in range(n) if least[i] <= most and text[i] != 32 and (text[i - 1] == 32 if i else opens))
    masks = _masks(pattern) if starts else {}
    for bound, i in starts:
        if best is not None and bound > best[0]:
            break
        for j, edits in enumerate(_distances(masks, m, text[i : i + m + most], False), i + 1):
            if edits <= most and text[j - 1] != 32 and (text[j] == 32 if j < n else closes) and (best is None or (edits, j, i) < best):
                best = (edits, j, i)
    return best


def grams(text: np.ndarray) -> np.ndarray:
    """16-bit hashes of all 4-grams."""
    x = text.astype(np.uint32)
    with np.errstate(over="ignore"):
        return (((x[:-3] * np.uint32(0x01000193) + x[1:-2]) * np.uint32(0x01000193) + x[2:-1]) * np.uint32(0x01000193) + x[3:]) * np.uint32(0x9E3779B1) >> np.uint32(16)


class Group:
    """The windows of all items of one size of window: walks, whose window each is, where it begins, embeddings and hash tables."""

    def __init__(self, items: list[tuple[int, bytes]], chosen: list[int], steps: int, selected: np.ndarray, walks: int):
        self.steps, self.walks = steps, Walks(steps, walks)
        owner, place, starts, parts, base = [], [], [], [], 0
        for k in chosen:
            t = np.frombuffer(items[k][1] + b"\0" * (steps + 3), dtype=np.uint8)
            n = len(items[k][1]) - steps
            a = anchors(t, selected)
            a = np.union1d([0], a[a <= n])
            owner.append(np.full(len(a), k))
            place.append(a)
            starts.append(a + base)
            parts.append(t)
            base += len(t)
        self.owner, self.place = (np.concatenate(x).astype(np.int64) for x in (owner, place))
        text, at = np.concatenate(parts), np.concatenate(starts).astype(np.int64)
        self.embedded = [self.walks.traces(w, text, at) for w in range(walks)]
        self.tables = []
        for keys in self.walks.keys(text, at):
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << 20, dtype=bool)
            seen[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.tables.append((keys[order], order, seen))


class Items:
    """The items of one block with the hashes of their windows."""

    def __init__(self, rows: list[tuple[int, str]], max_edits: float = MAX_EDITS, recall: float = RECALL, walks: int | None = None):
        data = [np.frombuffer((t or "").encode(), dtype=np.uint8) for _, t in rows]
        at = np.concatenate(([0], np.cumsum([len(x) for x in data]))).astype(np.int64)
        text, bounds, _ = normalise(np.concatenate([*data, np.zeros(0, np.uint8)]), at, 0)
        pairs = [(i, text[a:b].tobytes().strip()) for (i, _), a, b in zip(rows, *bounds, strict=True)]
        self.items = [(i, t) for i, t in pairs if t]
        self.grams = [grams(np.frombuffer(t + b"\0" * 3, dtype=np.uint8)[: max(len(t), 4)]) for _, t in self.items]
        self.size_of = [max(s for s in SIZES if s <= len(t) and (s <= 8 or 3 * s <= len(t))) for _, t in self.items]
        self.steps = max(self.size_of, default=0)
        self.selected = selection()
        values = []
        for (_, t), steps in zip(self.items, self.size_of, strict=True):
            at, value = word_starts(np.frombuffer(t + b"\0\0\0", dtype=np.uint8))
            values.append(value[at + steps <= len(t)])
        often = np.bincount(np.concatenate([*values, np.zeros(0, np.int64)]), minlength=1 << 16)
        for value in values:  # an item with few anchors selects more, the rarest first, in all items and documents
            less = value[~self.selected[value]]
            lack = LEAST_ANCHORS - (len(value) - len(less))
            if lack > 0:
                self.selected[less[np.argsort(often[less], kind="stable")[:lack]]] = True
        #: Share found by class (steps, bits of the length), as measured.
        self.recall: dict[tuple[int, int], float] = {}
        chosen = {s: [k for k, x in enumerate(self.size_of) if x == s] for s in SIZES}
        self.groups = [self._group(s, own, max_edits, recall, walks) for s, own in chosen.items() if own]

    def _group(self, steps: int, own: list[int], max_edits: float, recall: float, walks: int | None) -> Group:
        if walks is not None:
            return Group(self.items, own, steps, self.selected, walks)
        classes = defaultdict(list)
        for k in sorted(own, key=lambda k: (zlib.crc32(self.items[k][1]), k)):
            classes[len(self.items[k][1]).bit_length()].append(k)
        tried = [(c, k) for c, of in classes.items() for k in of[:TRIED] * -(-COPIES // len(of[:TRIED]))]
        texts = [b"x " + spoiled(self.items[k][1], int(max_edits * len(self.items[k][1])), n) + b" x" for n, (_, k) in enumerate(tried)]
        data, at = np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        best, idle, walks = -1, 0, 0
        while True:
            walks += 1
            group = Group(self.items, own, steps, self.selected, walks)
            got = {(d, k) for d, k, *_ in _find(self, data, at, max_edits, [group])}
            found, of = defaultdict(int), defaultdict(int)
            for d, (c, k) in enumerate(tried):
                of[c] += 1
                found[c] += (d, k) in got
            self.recall.update({(steps, c): found[c] / of[c] for c in of})
            if all(found[c] >= recall * of[c] for c in of):
                return group
            total = sum(min(found[c], recall * of[c]) for c in of)
            best, idle = (total, 0) if total > best else (best, idle + 1)
            if idle == PATIENCE:
                logging.getLogger(__name__).warning("items found by %d walks of %d steps, by bits of length: %s", walks, steps, {c: round(found[c] / of[c], 3) for c in of})
                return group


def spoiled(text: bytes, n: int, seed: int) -> bytes:
    """``text`` with n random letters put in, taken out or exchanged."""
    random, out = np.random.Generator(np.random.PCG64(seed)), list(text)
    for place, letter, kind in zip(random.random(n), random.integers(97, 123, n), random.integers(0, 3, n), strict=True):
        i = int(place * len(out))
        out[i : i + 1] = [[], [letter, *out[i : i + 1]], [letter]][kind]
    return bytes(out)


def _likely(items: Items, text: np.ndarray, begin: np.ndarray, end: np.ndarray, candidates: np.ndarray, max_edits: float) -> Iterator[tuple[int, int, int, int]]:
    """(item, text, start, end) of the stretches around candidates (item, start) that have 4-grams enough of their item, in order."""
    size = np.array([len(t) for _, t in items.items], dtype=np.int64)
    k, s = candidates
    most = (max_edits * size).astype(np.int64)[k]
    d = np.maximum(np.searchsorted(begin, s + size[k] // 2, "right") - 1, 0)
    rows = np.stack([k, d, np.maximum(begin[d], s - most), np.minimum(end[d], s + size[k] + most)]) if len(k) else np.zeros((4, 0), np.int64)
    rows = np.unique(rows[:, rows[3] - rows[2] >= size[k] - most], axis=1)
    here, marks = grams(text) if len(text) > 3 else np.zeros(0, np.uint32), np.zeros(1 << 16, dtype=bool)
    seen = np.zeros(1 << 16, dtype=bool)
    bounds = np.flatnonzero(np.diff(rows[0], prepend=-1, append=-1)) if rows.shape[1] else np.zeros(1, np.int64)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own = int(rows[0, a])
        # an edit spoils four 4-grams of the item at most; the others are in the stretch, each at a place of its own
        least, width = int(size[own]) - 3 - 4 * int(max_edits * size[own]), int((rows[3, a:b] - rows[2, a:b]).max()) - 3
        marks[items.grams[own]] = True
        for lo in range(a, b, 1 << 12):
            some = rows[:, lo : min(b, lo + (1 << 12))]
            if least > 0:
                at = some[2][:, None] + np.arange(width)
                shared = (marks[here[np.minimum(at, len(here) - 1)]] & (at < some[3][:, None] - 3)).sum(axis=1)
                some = some[:, shared >= least]
            for row in zip(*some.tolist(), strict=True):
                window = here[row[2] : row[3] - 3]
                seen[window] = True
                enough = least <= 0 or int(seen[items.grams[own]].sum()) >= least  # repeated ones count once
                seen[window] = False
                if enough:
                    yield row
        marks[items.grams[own]] = False


def _find(items: Items, data: np.ndarray, at: np.ndarray, max_edits: float, groups: list[Group] | None = None) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, end) for each item near to a stretch of a text; start and end are bytes of the text."""
    text, (begin, end), place = normalise(data, at, items.steps + 3)
    candidates = [np.zeros((2, 0), dtype=np.int64)]
    for group in items.groups if groups is None else groups:
        # an item of one or two bytes ends within what selects an anchor; the text's own start too: an item's is a window
        is_start = np.zeros(len(text), dtype=bool)
        is_start[anchors(text, items.selected) if group.steps > 2 else word_starts(text)[0]] = True
        is_start[begin[end > begin]] = True
        all_starts = np.flatnonzero(is_start)
        for lo in range(0, len(all_starts), 1 << 14):
            starts = all_starts[lo : lo + (1 << 14)]
            for number, ((keys, order, seen), mine) in enumerate(zip(group.tables, group.walks.keys(text, starts), strict=True)):
                hit = np.flatnonzero(seen[(mine & np.uint64((1 << 20) - 1)).astype(np.int64)])
                first, last = np.searchsorted(keys, mine[hit], "left"), np.searchsorted(keys, mine[hit], "right")
                at_doc = np.repeat(starts[hit], last - first)
                at_item = order[np.repeat(first, last - first) + np.arange(len(at_doc)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)] if len(at_doc) else at_doc
                walk = number // SAMPLES
                near = (group.walks.traces(walk, text, at_doc) == group.embedded[walk][at_item]).mean(axis=1) >= AGREE
                candidates.append(np.stack([group.owner[at_item[near]], at_doc[near] - group.place[at_item[near]]]))
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for k, d, lo, hi in _likely(items, text, begin, end, np.concatenate(candidates, axis=1), max_edits):
        item, most = items.items[k][1], int(max_edits * len(items.items[k][1]))
        if found.get((d, k), (1,))[0] == 0:  # nothing is nearer
            continue
        if got := words_near(item, text[lo:hi].tobytes(), most, lo == begin[d] or text[lo - 1] == 32, hi == end[d] or text[hi] == 32):
            found[d, k] = min(found.get((d, k), (1 << 30, 0, 0)), (got[0], lo + got[2], lo + got[1]))
    for (d, k), (edits, a, b) in sorted(found.items()):
        start, stop = int(place[a]), int(place[b - 1]) + 1
        while start > at[d] and data[start] & 0xC0 == 0x80:  # whole characters
            start -= 1
        while stop < at[d + 1] and data[stop] & 0xC0 == 0x80:
            stop += 1
        yield d, k, edits, start - int(at[d]), stop - int(at[d])


def hits(documents: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, recall: float = RECALL) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, edits (int), item_chars (int), start, end (long; bytes of the text).

    Null or empty texts and items have no hits; items that are empty once normalised neither, and an empty table of either
    gives an empty one. Repeated rows give repeated rows; of equally near stretches the first is told. Texts of any length
    are searched whole. Items of any length are found as stretches of whole words, and by the same distance. ``recall``
    is the share of items with ``max_edits`` random edits that the walks are to find, among items of each length.
    """
    spark = documents.sparkSession
    sized = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null and text <> ''")
    chars = sized.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(chars) // BLOCK_CHARS))
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for k in range(blocks):
        rows = sized.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        items = spark.sparkContext.broadcast(Items([(r.item_id, r.text) for r in rows.orderBy("item_id", "text").toLocalIterator()], max_edits, recall))

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch, texts in passes(batches, "text"):
                docs, own = column(batch, "doc_id").to_pylist(), items.value
                got = [(docs[d], own.items[k][0], edits, len(own.items[k][1]), a, b) for d, k, edits, a, b in _find(own, *raw(texts), max_edits)]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.int64()] * 2, strict=True)], ["doc_id", "item_id", "edits", "item_chars", "start", "end"])

        part = chosen.mapInArrow(run, "doc_id long, item_id long, edits int, item_chars int, start long, end long")
        out = part if out is None else out.unionByName(part)
    return out
