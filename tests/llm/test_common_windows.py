"""A window that very many documents share, each among other words, in the suffix passes."""

import numpy as np
import pyarrow as pa
from marketweave.llm import suffix_dedup as s

from test_operators import brute_windows, frame, rows_of

NOTICE = "this notice of fifty bytes or more is in all pages"


def pages(n):
    return [(i, f"{i * 7919 % 10_007} page {i} " + NOTICE + f" number {i * 31 % 997} ends {i}") for i in range(n)]


def test_window_in_many_documents_equals_brute_force(spark):
    rows = pages(600)
    for most in (64, 1000):
        assert rows_of(s.remove_repeats(frame(spark, rows), most)) == brute_windows(rows)


def singles(docs):
    """Rows of one window, as the last pass receives them, some a blob."""
    window = np.frombuffer(NOTICE.encode().ljust(s.CONTEXT, b"\0"), np.uint8)
    for lo in range(0, len(docs), 100):
        some = docs[lo : lo + 100]
        rows = np.zeros(len(some), s._PLACE)
        rows["h"], rows["doc"], rows["size"] = 5, some, s.DEPTH
        blob = s.pack(rows, np.tile(window, (len(some), 1)))
        yield s._batch("dealt", shard=[0], kind=np.zeros(1, np.int8), doc_id=pa.nulls(1, pa.int64()), blob=[blob])


def test_last_pass_holds_the_least_document_of_a_window(monkeypatch):
    docs, held = np.random.Generator(np.random.PCG64(3)).permutation(20_000), []
    plain = s._same_contexts
    monkeypatch.setattr(s, "_same_contexts", lambda rows, text: held.append(len(rows)) or plain(rows, text))
    out = [(d, b) for batch in s._meet_contexts(500, 8, last=True)(singles(docs)) for d, b in zip(batch["doc_id"].to_pylist(), batch["blob"].to_pylist(), strict=True)]
    assert sorted(d for d, _ in out) == list(range(1, 20_000))  # all but the least go
    assert max(held) <= 700


def test_second_pass_sends_a_window_once_a_slice():
    docs = np.arange(20_000)
    rows = np.zeros(len(docs), s._PLACE)
    rows["h"], rows["doc"], rows["size"] = 5, docs, s.DEPTH + 1
    text = np.zeros((len(docs), s.CONTEXT), np.uint8)
    text[:, : s.DEPTH] = np.frombuffer(NOTICE.encode(), np.uint8)
    text[:, s.DEPTH] = docs % 200 + 20  # the second window differs in its last byte
    batches = (s._batch("dealt", shard=[0], kind=np.zeros(1, np.int8), doc_id=pa.nulls(1, pa.int64()), blob=[s.pack(rows[a : a + 500], text[a : a + 500])]) for a in range(0, len(rows), 500))
    sent = 0
    for batch in s._meet_contexts(300, 8)(batches):
        for kind, blob in zip(batch["kind"].to_pylist(), batch["blob"].to_pylist(), strict=True):
            sent += 0 if kind else len(s.unpack(blob, s._PLACE, s.CONTEXT)[0])
    assert sent < 10_000  # of 40,000 windows: a common one and 200 others a slice
