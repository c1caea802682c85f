"""Toxicity scores of texts whose insults may be disguised.

Noisy channel: a word with look-alike symbols, separators, spaced-out letters or stretched letters becomes a lattice in
which each character stands for itself, for a letter that it resembles, or for nothing, each at a price. Viterbi decoding
finds the path that is cheapest together with a character trigram model; the model is counted over all documents, one
fixed table of cells that tasks sum up before the shuffle. Words without such signs are a lattice of one path. All that is
decoded, of any length, is decoded a second time with a word break, at a price, before any character, so that it may give
several words; a plain word is so too if a break at one place at least makes it cheaper. The work is linear in the length.

Classifier: logistic regression over the presence of words and word beginnings of the restored text. Features are chosen
by the log-likelihood ratio over a bounded sample of labelled rows (``TRAIN_ROWS``, the smallest hashes of doc_id), and
fitted on the same rows. Rows whose crc32(doc_id) modulo 3 is 1 are held out: their labels are never read.

Scoring is per row: the fitted model is one broadcast value of at most ``FEATURES`` weights and the trigram table.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PASS_BYTES, column, passes

TRAIN_ROWS = 24_000
FEATURES = 3000
HASHED = 1 << 22
THRESHOLD = 0.7
MOST_WORDS = 150_000
#: Plain words that are priced at a time.
_TOGETHER = 50_000
_CLASSES = 64
# Letters that a symbol may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l"}
_PUNCTUATION = ".,;:?\"'`()[]{}<>#%&*^~=\\/_-!$@+|"
#: A sign at the beginning may be the word's first letter; at the end it ends a sentence.
_LEADING = "".join(c for c in _PUNCTUATION if c not in LOOKS_LIKE)
#: Prices of a word break: between single characters, at a separator, between letters of one word.
_RUN_BREAK, _SIGN_BREAK, _LETTER_BREAK = 0.5, 0.2, 3.0
_STRETCHED = re.compile(r"(.)\1\1")
_LETTERS = re.compile(r"[^\W\d_]+")


def _classes() -> np.ndarray:
    """Class of each code point under 0x250: 0 no letter, 1-26 a-z, 27-62 other letters."""
    out = np.zeros(0x250, dtype=np.int64)
    for c in range(0x250):
        low = chr(c).lower()
        if low.isalpha():
            o = ord(low[0])
            out[c] = o - 96 if 97 <= o <= 122 else 27 + o % 36
    return out


_CLASS = _classes()
_LISTED = _CLASS.tolist()


def _class(char: str) -> int:
    o = ord(char)
    return _LISTED[o] if o < 0x250 else (63 if char.isalpha() else 0)


class Speller:
    """The character model and the decoder."""

    def __init__(self, counts: np.ndarray):
        n = counts.reshape(_CLASSES, _CLASSES, _CLASSES).astype(np.float64)
        pair = n.sum(axis=0)
        uni = pair.sum(axis=0) + 1.0
        p1 = uni / uni.sum()
        p2 = (pair + 20 * p1) / (pair.sum(axis=1, keepdims=True) + 20)
        self.cost = -np.log((n + 5 * p2[None]) / (n.sum(axis=2, keepdims=True) + 5))
        self.flat = self.cost.ravel()
        self.prices = self.flat.tolist()

    @staticmethod
    def lattice(word: str) -> list[list[tuple[str, float]]]:
        out: list[list[tuple[str, float]]] = []
        for i, c in enumerate(word):
            if c.isalpha():
                ways = [(c, 0.0)]
                if i and word[i - 1] == c:
                    ways.append(("", 0.5))
            else:
                ways = [(x, 1.0) for x in LOOKS_LIKE.get(c, "")]
                ways.append(("", 2.5 if ways else 0.2))
                if i and word[i - 1] == c and len(ways) > 1:
                    ways[-1] = ("", 0.5)
            out.append(ways)
        return out

    def joined(self, word: str, gap: float) -> bool:
        """Whether ``word``, a spelling of letters only, is cheaper with a break of this price at some place."""
        return bool(self.joined_of([word], gap)[0])

    def joined_of(self, words: list[str], gap: float) -> np.ndarray:
        """``joined`` of many words, all places at once."""
        code = np.frombuffer(f"  {'  '.join(words)}  ".encode("utf-32-le"), dtype=np.uint32)
        c = np.where(code < 0x250, _CLASS[np.minimum(code, 0x24F)], 63)
        inside = code != 0x20
        at = np.flatnonzero(inside[1:] & inside[:-1]) + 1  # a break before each
        x, y, z, after = (c[at + k] for k in (-2, -1, 0, 1))
        price = lambda x, y, z: self.flat[(x * _CLASSES + y) * _CLASSES + z]
        cheaper = price(x, y, z) + price(y, z, after) > gap + price(x, y, 0) + price(y, 0, z) + price(0, z, after)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        first = np.cumsum(sizes + 2) - sizes
        out = np.zeros(len(words), dtype=bool)
        out[np.searchsorted(first, at[cheaper], "right") - 1] = True
        return out

    def decode(self, word: str, gap: float | None = None) -> str:
        """The cheapest restored spelling: letters only and, if ``gap`` prices them, blanks between words."""
        # a state: the last two classes; its text is a chain of (rest, letter)
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        price_of = self.prices
        for i, ways in enumerate(self.lattice(word)):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            if gap is not None and i:
                sign = not word[i].isalnum() and word[i] not in LOOKS_LIKE
                at = min(gap, _SIGN_BREAK) if sign else gap
                for (x, y), (cost, text) in list(states.items()):
                    if y:
                        new = cost + at + price_of[(x * _CLASSES + y) * _CLASSES]
                        if (y, 0) not in states or new < states[y, 0][0]:
                            states[y, 0] = (new, (text, " "))
            for (x, y), (cost, text) in states.items():
                for letter, price in ways:
                    if letter:
                        z = _class(letter)
                        to, new = (y, z), cost + price + price_of[(x * _CLASSES + y) * _CLASSES + z]
                    else:
                        to, new = (x, y), cost + price
                    if to not in after or new < after[to][0]:
                        after[to] = (new, (text, letter) if letter else text)
            states = after
        _, text = min(((cost + (price_of[(x * _CLASSES + y) * _CLASSES] if y else 0.0), text) for (x, y), (cost, text) in states.items()), key=lambda s: s[0])
        out = []
        while text is not None:
            text, letter = text
            out.append(letter)
        return "".join(reversed(out)).strip()


def count_characters(documents: DataFrame) -> np.ndarray:
    """Trigram counts of letter classes over all texts: 64**3 cells, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CLASSES**3, dtype=np.int64)
        for _, texts in passes(batches, "text"):
            code = np.frombuffer(("  ".join(texts.to_pylist())).encode("utf-32-le", "replace"), dtype=np.uint32)
            c = np.where(code < 0x250, _CLASS[np.minimum(code, 0x24F)], 63)
            if len(c) > 2:
                total += np.bincount((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:], minlength=_CLASSES**3)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    counts = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(_CLASSES**3, dtype=np.int64)
    out[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    return out


#: A word's features are hashes of "w" and the word, and of 4, 5 or 6 and so many of its letters: what their first character leaves.
_WHOLE, _BEGINNINGS = zlib.crc32(b"w"), [(n, zlib.crc32(str(n).encode())) for n in (4, 5, 6)]


def _hashes(word: str) -> list[int]:
    """Features of a word and of its beginnings."""
    data, n, crc32 = word.encode("utf-8", "surrogatepass"), len(word), zlib.crc32
    out = [crc32(data, _WHOLE) % HASHED]
    for k, first in _BEGINNINGS:
        if n <= k:
            break
        out.append(crc32(data[:k] if len(data) == n else word[:k].encode("utf-8", "surrogatepass"), first) % HASHED)
    return out


class Words:
    """From texts to their features; kept per distinct word, bounded. Words that are new in some texts are looked at together."""

    def __init__(self, speller: Speller, chosen: dict[int, int] | None = None):
        self.speller, self.chosen = speller, chosen
        self.known: dict[str, tuple[int, ...]] = {}
        self.single: dict[str, str] = {}  # known words of one character, without the signs around it

    def restore(self, word: str) -> list[str]:
        """Lower-case words that ``word`` stands for."""
        low = word.lower().lstrip(_LEADING).rstrip(_PUNCTUATION)
        if low.isalpha() and not _STRETCHED.search(low):
            return [low, *(self.speller.decode(low, _LETTER_BREAK).split() if self.speller.joined(low, _LETTER_BREAK) else [])]
        parts = _LETTERS.findall(low)
        if not parts:
            return []
        single = len(parts) > 2 and max(map(len, parts)) == 1
        if single or any(c in LOOKS_LIKE for c in low) or _STRETCHED.search(low):
            if single:  # as a run of characters that blanks part
                return self.restore_run("".join(c for c in low if c.isalnum() or c in LOOKS_LIKE))
            return [self.speller.decode(low), *(parts if len(parts) > 1 else []), *self.speller.decode(low, _LETTER_BREAK).split()]
        return parts

    def restore_run(self, run: str) -> list[str]:
        """Words that a run of single characters stands for: all as one, and as cut by the model."""
        if not _LETTERS.search(run):
            return []
        low = run.lower()
        return [self.speller.decode(low), *self.speller.decode(low, _RUN_BREAK).split()]

    def _features(self, key: str, restored: list[str]) -> tuple[int, ...]:
        all_of = _hashes(restored[0]) if len(restored) == 1 else [x for w in restored for x in _hashes(w)]
        chosen = self.chosen
        if chosen is not None:
            all_of = [chosen[x] for x in all_of if x in chosen]
        got = self.known[key] = tuple(sorted(set(all_of))) if len(all_of) > 1 else tuple(all_of)
        return got

    def _learn(self, new: list[str]) -> None:
        """Features of words that are not known."""
        plain, lows = [], []
        for w in new:
            low = w.lower()
            if not w.isalpha():
                core = w.lstrip(_LEADING).rstrip(_PUNCTUATION)
                if len(core) == 1:
                    self.single[w] = core
                low = low.lstrip(_LEADING).rstrip(_PUNCTUATION)
            if len(w) == 1:
                self.single[w] = w
            if low.isalpha() and not _STRETCHED.search(low):
                plain.append(w)
                lows.append(low)
            else:
                self._features(w, self.restore(w))
        if plain:
            for w, low, joined in zip(plain, lows, self.speller.joined_of(lows, _LETTER_BREAK).tolist(), strict=True):
                self._features(w, [low, *self.speller.decode(low, _LETTER_BREAK).split()] if joined else [low])

    def of_word(self, word: str) -> tuple[int, ...]:
        got = self.known.get(word)
        return self._features(word, self.restore(word)) if got is None else got

    def of_run(self, run: str) -> tuple[int, ...]:
        key = " " + run  # no word has a blank
        got = self.known.get(key)
        return self._features(key, self.restore_run(run)) if got is None else got

    def of_text(self, text: str) -> set[int]:
        return self.of_texts([text])[0]

    def of_texts(self, texts: list[str]) -> list[set[int]]:
        """Features of each text."""
        if len(self.known) > MOST_WORDS:
            self.known.clear()
            self.single.clear()
        split = [x.split() for x in texts]
        distinct = [set(x) for x in split]
        new = list(set().union(*distinct).difference(self.known))
        for i in range(0, len(new), _TOGETHER):
            self._learn(new[i : i + _TOGETHER])
        return [self._found(*x) for x in zip(split, distinct, strict=True)]

    def _found(self, words: list[str], distinct: set[str]) -> set[int]:
        found: set[int] = set().union(*map(self.known.__getitem__, distinct))
        single = self.single
        if single.keys().isdisjoint(distinct):
            return found
        run: list[str] = []
        for w in [*words, ""]:
            core = single.get(w)
            if core is not None:
                run.append(core)
            elif run:
                if len(run) > 1:  # two single characters or more may be a word, or several
                    found.update(self.of_run("".join(run)))
                run = []
        return found


def _portions(texts: Iterable[str | None], most: int = PASS_BYTES) -> Iterator[list[str]]:
    """Whole texts, null as empty, in lists of at most ``most`` characters (one text at least)."""
    part: list[str] = []
    size = 0
    for x in texts:
        x = x or ""
        if part and size + len(x) > most:
            yield part
            part, size = [], 0
        part.append(x)
        size += len(x)
    if part:
        yield part


class Model:
    def __init__(self, counts: np.ndarray, chosen: list[int], weights: np.ndarray, bias: float):
        self.counts, self.chosen, self.weights, self.bias = counts, chosen, weights, bias

    def scorer(self):
        words = Words(Speller(self.counts), {h: i for i, h in enumerate(self.chosen)})

        def scores(texts: Iterable[str | None]) -> list[float]:
            out = []
            for part in _portions(texts):
                sums = (self.bias + float(self.weights[sorted(at)].sum()) for at in words.of_texts(part))
                out += [round(1 / (1 + math.exp(-max(-30.0, min(30.0, x)))), 6) for x in sums]
            return out

        return scores


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _regression(rows: list[list[int]], y: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression by full-batch Adam steps."""
    at = np.array([f for r in rows for f in r], dtype=np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    rate = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = math.log(rate / (1 - rate))
    for step in range(1, 401):
        z = w[n] + np.bincount(of, weights=w[at], minlength=len(rows))
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.append(np.bincount(at, weights=err[of], minlength=n), err.sum()) / len(rows)
        g[:n] += 2e-5 * w[:n]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w[:n], float(w[n])


def fit(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model of ``labels.toxic``; without labels of both kinds its score is the share of label 1, or 0.

    A doc_id counts once: with its greatest label and its least text. Of features with one ratio the smaller hash is chosen.
    """
    spark = documents.sparkSession
    text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    sample = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).toArrow()
    label_of = dict(zip(sample["doc_id"].to_pylist(), sample["toxic"].to_pylist(), strict=True))
    counts = count_characters(text)
    shared = spark.sparkContext.broadcast((label_of, counts))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label_of, counts = shared.value
        words, n = Words(Speller(counts)), np.zeros((2, HASHED), dtype=np.int32)
        for batch, texts in passes(batches, "text"):
            for doc, found in zip(column(batch, "doc_id").to_pylist(), words.of_texts(texts.to_pylist()), strict=True):
                n[label_of[doc], list(found)] += 1
        at = np.flatnonzero(n.sum(axis=0))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[0, at]), pa.array(n[1, at])], ["feature", "clean", "toxic"])

    ids = spark.createDataFrame(pd.DataFrame({"doc_id": list(label_of)}, dtype="int64"), "doc_id long")
    train = text.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))  # at most train_rows rows
    n1 = sum(label_of.values())
    n0 = len(label_of) - n1
    if not n1 or not n0:
        rate = n1 / max(1, len(label_of))
        return Model(counts, [], np.zeros(0), math.log(max(rate, 1e-9) / max(1 - rate, 1e-9)))
    tallied = train.mapInArrow(tally, "feature int, clean int, toxic int").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter("clean + toxic >= 3")
    log = lambda n, e: n * F.ln(F.greatest(n, F.lit(0.5)) / e)
    share = (F.col("clean") + F.col("toxic")) / F.lit(float(n0 + n1))
    ratio = log(F.col("toxic"), share * n1) + log(F.col("clean"), share * n0)
    best = tallied.withColumn("ratio", ratio).filter("ratio > 4").orderBy(F.desc("ratio"), "feature").limit(FEATURES).toArrow()
    chosen = sorted(best["feature"].to_pylist())

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label_of, counts = shared.value
        words = Words(Speller(counts), {h: i for i, h in enumerate(chosen)})
        for batch, texts in passes(batches, "text"):
            docs = column(batch, "doc_id").to_pylist()
            rows = [sorted(x) for x in words.of_texts(texts.to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array([label_of[d] for d in docs], pa.int32()), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "toxic", "features"])

    rows = train.mapInArrow(present, "doc_id long, toxic int, features array<int>").toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return Model(counts, [], np.zeros(0), math.log(n1 / n0))
    weights, bias = _regression(rows["features"].to_pylist(), np.array(rows["toxic"].to_pylist(), dtype=np.float64), len(chosen))
    return Model(counts, chosen, weights, bias)


def score_column(documents: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each row's text as a column expression; null counts as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = shared.value.scorer()
        for texts in batches:
            yield pd.Series(of(texts), dtype="float64")

    return score(F.col(text).cast("string"))


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; equal texts have equal scores, null and empty ones the score of no evidence.

    Texts of any length are read whole; other columns are not read. An empty table gives an empty one.
    """
    model = fit(documents, labels)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score_column(documents, model).alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
