"""Very long texts, repeated rows, nulls and ties in the operators by row, each against a plain recomputation."""

import hashlib
import zlib

import numpy as np
import pytest
from marketweave.llm import media, suffix_dedup, token_counts, toxicity

import public_tokenizers
from test_operators import brute_windows, frame, rows_of

LONG = " ".join(f"w{i % 9973}" for i in range(90_000))
ROWS = [(1, LONG), (1, LONG), (2, None), (3, ""), (None, "a b"), (None, "a b"), (4, "a b"), (5, "x" * 192), (6, "é" * 96)]


def test_media_features_by_definition(spark):
    got = {}
    for r in media.features(media.store_texts(frame(spark, ROWS))).collect():
        got.setdefault(r.doc_id, []).append(r)
    for doc, text in ROWS:
        plain = (text or "").encode()
        payload = plain + b" " * (-len(plain) % 192 if plain else 192)
        x = np.frombuffer(payload, np.uint8).astype(np.int64)
        y = x - 128
        loud = [sum(payload[i : i + 192]) for i in range(0, len(payload), 192)]
        feature = f"audio/wav;n={len(x)};sum={sum(payload)};energy={sum(int(v) ** 2 for v in y)};min={min(payload)};max={max(payload)};crossings={sum((a >= 0) != (b >= 0) for a, b in zip(y, y[1:]))};steps={sum(abs(int(a) - int(b)) for a, b in zip(payload, payload[1:]))};loudest={loud.index(max(loud))}"
        for r in got[doc]:
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(plain), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
            assert r.feature == feature and r.media_sha256 == hashlib.sha256(media.wav(payload)).hexdigest()
    assert sum(map(len, got.values())) == len(ROWS)


def test_token_counts_of_long_and_repeated_rows(spark):
    rows = rows_of(token_counts.count_tokens(frame(spark, ROWS), public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "n_chars", "n_pretokens", "n_distinct"))
    assert rows == sorted(((d, len(t or ""), len((t or "").split()), len(set((t or "").split()))) for d, t in ROWS), key=str)


def test_suffixes_of_long_and_repeated_rows(spark):
    rows = [*ROWS, (9, LONG[1000:70_000]), (10, "head " + LONG[5:400])]
    assert rows_of(suffix_dedup.remove_repeats(frame(spark, rows))) == brute_windows(rows)


def test_toxicity_of_long_and_repeated_rows(spark):
    sf = "/root/testdata/sf0.001"
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    df = frame(spark, ROWS)
    got = {}
    for r in df.select("doc_id", "text", toxicity.score_column(df, model).alias("score")).collect():
        got.setdefault(r.text or "", set()).add(r.score)
    assert all(len(s) == 1 and 0 <= min(s) <= 1 for s in got.values()) and len(got) == 5
    assert min(got[""]) == pytest.approx(1 / (1 + np.exp(-model.bias)), abs=1e-5)
