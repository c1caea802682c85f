"""Sum-of-squares online packing of tokenised documents into windows of at most 4096 tokens.

Each task takes its documents as they come. A document's full windows go out at once; what is left over is placed in the
fill level h (0 is a new window) that makes the sum over levels of the squared number of windows filled so far least,
looked up in one array of counts by level; of equal ones the fullest. At the end of its input a task fills the windows
that are still open, which stay as they are placed, from the emptiest of them, and cuts the last rest, which fills no
window, into powers of two, which need no padding. No shuffle; a task holds the ids of its open windows only.

Token ids: the tokenizer's pattern never spans white space and words repeat, so ids are kept per word (bounded) and joined
as bytes. Texts with characters for which that, or white space itself, might be another thing to the tokenizer, or with a
special token's text, go to it whole.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, passes

WINDOW = 4096
END_ID = 2
#: Words kept by a worker, which outlives its task.
MOST_WORDS = 200_000
#: U+0130 is a letter whose lower case is two characters, the second a mark.
_ODD = re.compile(r"[^\t-\r -~¡-įı-ſ]|<\|")


class _Known(dict[str, bytes]):
    """Ids of words, made when a word is first asked for."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self.make(word)
        return ids


class WordTokenizer:
    """Ids, as little-endian 32-bit bytes, of the texts by a tokenizers file that drops white space and whose pre-tokens never span it."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        self.model = self.whole.model
        with open(file, encoding="utf-8") as f:
            steps = json.load(f)["pre_tokenizer"]["pretokenizers"]
        self.split = regex.compile(steps[0]["pattern"]["Regex"]).findall
        # byte level: bytes without a visible Latin-1 character are moved to U+0100 and up, in order
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.visible = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(seen)))}
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        self.known = _Known(self._word)
        self.parts: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        text = part if part.isascii() else part.encode().decode("latin-1").translate(self.visible)
        bytes_of = self.bytes_of
        self.parts[part] = ids = b"".join([bytes_of[t.id] for t in self.model.tokenize(text)])
        return ids

    def _word(self, word: str) -> bytes:
        parts = self.parts
        if word.isalpha():  # one run of letters
            return parts.get(word := word.lower()) or self._part(word)
        return b"".join([parts.get(p) or self._part(p) for p in self.split(word.lower())])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > MOST_WORDS:
            self.known.clear()
            self.parts.clear()
        ids_of = self.known.__getitem__  # one look at each word: those not known yet are made on the way
        whole = [_ODD.search(x) is not None for x in texts]
        odd = iter(self._ids([x for x, w in zip(texts, whole, strict=True) if w]))
        return [next(odd) if w else b"".join(map(ids_of, x.split())) for x, w in zip(texts, whole, strict=True)]


@functools.cache
def word_tokenizer(file: str) -> WordTokenizer:
    """One for each Python worker, so that later tasks know the words of earlier ones."""
    return WordTokenizer(file)


class Packer:
    """Pieces are (document, start, ids as bytes, tokens of the document)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.level = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list[tuple]]] = defaultdict(list)

    def choose(self, size: int) -> int:
        """The level whose use makes the sum of squares least; of equal ones the fullest."""
        n, last = self.level, self.window - size
        at = np.flatnonzero(n[1 : last + 1]) + 1
        change = 2 * (n[at + size] - n[at]) + 2  # one window less at h, one more at h + size
        if len(at) and at[-1] == last:
            change[-1] = 1 - 2 * n[last]  # a full window is in no level
        best = len(at) - 1 - int(change[::-1].argmin()) if len(at) else -1
        return int(at[best]) if best >= 0 and change[best] <= 2 * n[size] + 1 else 0

    def add(self, doc, ids: bytes) -> Iterator[list[tuple]]:
        """Windows that are full now."""
        total, w = len(ids) // 4, self.window
        full = total // w * w
        for start in range(0, full, w):
            yield [(doc, start, ids[4 * start : 4 * (start + w)], total)]
        size = total - full
        if size:
            h = self.choose(size)
            pieces = self.open[h].pop() if h else []
            pieces.append((doc, full, ids[4 * full :], total))
            if h:
                self.level[h] -= 1
            if h + size == w:
                yield pieces
            else:
                self.level[h + size] += 1
                self.open[h + size].append(pieces)

    def rest(self) -> Iterator[list[tuple]]:
        """What is open at the end. Windows stay as they are placed, fullest first, and are filled up from the emptiest ones; the last tokens, which fill none, go as powers of two."""
        windows = [w for h in sorted(self.open, reverse=True) for w in self.open[h]]
        fill = [h for h in sorted(self.open, reverse=True) for _ in self.open[h]]
        self.open.clear()
        self.level[:] = 0
        left, first, last = sum(fill), 0, len(windows) - 1
        while left >= self.window:
            room = self.window - fill[first]
            while room:  # there are enough tokens in the windows behind this one
                doc, start, ids, total = windows[last].pop()
                take = min(room, len(ids) // 4)
                cut = len(ids) - 4 * take
                windows[first].append((doc, start + cut // 4, ids[cut:], total))
                if cut:
                    windows[last].append((doc, start, ids[:cut], total))
                fill[last] -= take
                room -= take
                if not windows[last]:
                    last -= 1
            yield windows[first]
            left -= self.window
            first += 1
        pieces = [p for w in windows[first : last + 1] for p in w]
        while left:
            room, out = 1 << left.bit_length() - 1, []
            left -= room
            while room:
                doc, start, ids, total = pieces.pop()
                take = min(room, len(ids) // 4)
                out.append((doc, start, ids[: 4 * take], total))
                if 4 * take < len(ids):
                    pieces.append((doc, start + take, ids[4 * take :], total))
                room -= take
            yield out


_COLUMNS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}


def pack(documents: DataFrame, tokenizer_file: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (array<int>) if asked for.

    Null text is empty; every row, repeated ones and null doc_ids included, ends with id 2 and is packed. sequence_id is
    the task's number times 2**32 and a count. Texts of any length are taken whole, one at a time. An empty table gives an
    empty one. The same files in the same order give
    the same result, so a task that is run again does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = word_tokenizer(tokenizer_file), Packer(window)
        number = TaskContext.get().partitionId() << 32
        end, rows = np.array([END_ID], dtype="<u4").tobytes(), []

        def put(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, number, offset, *([np.frombuffer(ids, dtype="<i4")] if with_ids else [])))
                offset += len(ids) // 4
            number += 1

        def flush() -> pa.RecordBatch:
            kinds = _COLUMNS | ({"ids": pa.list_(pa.int32())} if with_ids else {})
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))
            rows.clear()
            return out

        for batch, texts in passes(batches, "text"):
            for doc, ids in zip(column(batch, "doc_id").to_pylist(), tokenizer.encode(texts.to_pylist()), strict=True):
                for pieces in packer.add(doc, ids + end):
                    put(pieces)
            if len(rows) >= 2000:
                yield flush()
        for pieces in packer.rest():
            put(pieces)
        if rows:
            yield flush()

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, ", ".join(f"{c} long" for c in _COLUMNS) + (", ids array<int>" if with_ids else ""))
