"""Phrase collocations of two to five words by stripes: each prefix keys a counter of the words that follow it.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words ``[^\\x20\\x09]+``; phrases lie
within pieces. All counts are by language (null: ``und``). The stripe of the empty prefix counts the words, and its total is n;
the stripe of a phrase of k words has the counts of the phrases of k + 1 words that begin with it.

A length is counted after the one below it: a phrase can have 100 occurrences only if both phrases that it has without its
last and its first word do, so tasks leave out all others. They know these by a Bloom filter of a bounded size; what it lets
through by mistake is counted and dropped, so results do not depend on it. A task adds up stripes of its own; the stripe of the
empty prefix, and those of the most frequent prefixes, are cut in slices by the next word. Stripes and slices are sent in
bundles, by a hash of both, with a line for each of its prefix, its words and their counts. Bundles of one hash meet and their
stripes are added word by word.

From the merged stripes come the extensions (entries of 100 or more), the frequencies of both parts of every cut (carried
along from prefix to extension, and from the phrase without its first word), and what subsumes a phrase: the largest entry of
its stripe and of the stripes in which it is the end. A phrase inside a longer one with as many occurrences is inside one that
is longer by one word with as many, so these two decide.

Null texts are empty. Repeated rows count as often as they are there. Texts of any length are taken whole, a megabyte of
several at a time. Ties go to the smallest cut, then to frequency, then to the phrase by bytes. An empty table gives no rows.
Other columns are ignored. A 64-bit hash stands for a phrase in a task's own sums and in the filter; stripes carry words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, column, join_checked, passes, raw, settle
from .hashing import LOWER, mix, prefix_sums, span

LEAST, LONGEST, FIRST = 100, 5, 2000
#: Slices of the stripe of the empty prefix. Of other prefixes so many of the most frequent are cut in slices: one for each so many occurrences, and at most.
SLICES, HOT, HOT_EACH, HOT_MOST = 256, 4096, 1 << 16, 1 << 12
#: Bundles of a language for each shuffle partition, and at least so many.
BUNDLES, LEAST_BUNDLES = 8, 256
#: Entries that a task holds before it sends its stripes, and bytes of bundles that are added up at a time (one bundle at least).
HELD, MERGED_BYTES = 700_000, 16 << 20
#: Bits of the filter: so many for each phrase, and at most (32 MB).
FILTER_BITS, MOST_BITS, PROBES = 16, 1 << 28, 4
#: Parts in which each language is ranked before the last round.
RANKED_IN = (4096, 64, 1)

_U = np.uint64
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[[32, 9]] = True
_STRIPES = "lang string, bundle int, prefixes string, words string, counts string"
_ENTRIES = "lang string, prefix string, word string, a long"


def _extend(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its prefix and that of its last word."""
    with np.errstate(over="ignore"):
        return mix(key * _U(0x9E3779B97F4A7C15) + word)


def _language(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def _ragged(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers start to end of all stretches, one after another."""
    size = end - start
    return np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[_ragged(start, end)]))])


class _Words:
    """Words of a pass over texts: hashes, pieces, the texts they are in, and their bytes with one space between."""

    def __init__(self, texts: pa.Array) -> None:
        data, at = raw(texts)
        data = LOWER[data]
        solid, n = ~_GAP[data], len(data)
        edge = np.zeros(n + 1, dtype=bool)
        edge[at] = True
        before = np.concatenate(([False], solid[:-1])) & ~edge[:n] if n else solid
        after = np.concatenate((solid[1:], [False])) & ~edge[1:] if n else solid
        start, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
        self.text = np.searchsorted(at, start, "right") - 1
        self.piece = np.cumsum(_BREAK[data])[start] + self.text if n else self.text
        self.hash = span(prefix_sums(data), start, end)
        spaced = np.full(int((end - start).sum()) + len(start), 32, dtype=np.uint8)
        self.end = np.cumsum(end - start + 1) - 1
        self.start = self.end - (end - start)
        spaced[_ragged(self.start, self.end)] = data[_ragged(start, end)]
        self.bytes = spaced

    def keys(self, languages: np.ndarray, most: int) -> list[np.ndarray]:
        """Hashes of the phrases of 1 to ``most`` words that begin at each word, as far as pieces go."""
        out, key = [], languages[self.text]
        for k in range(most):
            fits = max(0, len(self.hash) - k)
            same = self.piece[:fits] == self.piece[k : k + fits] if k else np.ones(fits, dtype=bool)
            if k:  # a phrase that leaves its piece has the hash 0, as have all longer ones there
                same &= out[-1][:fits] != 0
            out.append(np.where(same, _extend(key[:fits], self.hash[k : k + fits]), _U(0)))
            key = out[-1]
        return out


def _bits(keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Places of the bits of ``keys`` in a filter of ``size`` bits, a power of two."""
    other = mix(keys) | _U(1)
    for j in range(PROBES):
        with np.errstate(over="ignore"):
            yield (keys + _U(j) * other) & _U(size - 1)


class _Held:
    """Entries of a task's stripes: one for each phrase."""

    def __init__(self) -> None:
        self.key, self.count = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.columns: list[list[pa.Array]] = []
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, key: np.ndarray, count: np.ndarray, *columns: pa.Array) -> int:
        self.keys.append(key)
        self.counts.append(count)
        self.columns.append(list(columns))
        if sum(map(len, self.keys)) > HELD:
            self.merge()
        return sum(map(len, self.keys))

    def merge(self) -> None:
        key, first, place = np.unique(np.concatenate(self.keys), return_index=True, return_inverse=True)
        count = np.zeros(len(key), dtype=np.int64)
        np.add.at(count, place, np.concatenate(self.counts))
        self.keys, self.counts = [key], [count]
        self.columns = [[pa.chunked_array([x[i] for x in self.columns]).take(pa.array(first)).combine_chunks() for i in range(len(self.columns[0]))]]

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """All entries as bundles of stripes; empties what is held."""
        if not self.keys:
            return
        self.merge()
        (prefix_key, slices, bundle, lang, prefix, word), count = self.columns[0], self.counts[0]
        self.__init__()
        plain = lambda x: x.to_numpy(zero_copy_only=False)
        language = lang.dictionary_encode()
        p, s, b, code = plain(prefix_key), plain(slices), plain(bundle), plain(language.indices)
        order = np.lexsort((s, p, b, code))
        p, s, b, code = p[order], s[order], b[order], code[order]
        begins = lambda *xs: np.flatnonzero(np.concatenate(([True], np.any([x[1:] != x[:-1] for x in xs], axis=0))))
        first = begins(p, s, b, code)  # of a stripe, among entries
        row = begins(b[first], code[first])  # of a bundle, among stripes
        joined = lambda at, n, x, by: pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(at, n), type=pa.int32()), x.cast(pa.string())), by)
        take = pa.array(order)
        lines = [prefix.take(pa.array(order[first])), joined(first, len(p), word.take(take), " "), joined(first, len(p), pa.array(count[order]).cast(pa.string()), " ")]
        out = pa.RecordBatch.from_arrays([lang.take(pa.array(order[first[row]])).cast(pa.string()), pa.array(b[first[row]], type=pa.int32()), *[joined(row, len(first), x, "\n") for x in lines]], names=["lang", "bundle", "prefixes", "words", "counts"])
        for low in range(0, out.num_rows, 500):
            yield out.slice(low, 500)


def _mapper(k: int, bundles: int, known: object = None, hot: dict[int, int] | None = None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stripes of the prefixes of k words; ``known`` is a broadcast filter of the phrases of k words that are frequent (none for k = 0), ``hot`` tells the slices of those that have more than one."""
    hot_keys = np.array(sorted(hot or {}), dtype=np.uint64)
    hot_slices = np.array([(hot or {})[x] for x in hot_keys.tolist()], dtype=np.uint64)

    def slices_of(prefix: np.ndarray) -> np.ndarray:
        if not k:
            return np.full(len(prefix), SLICES, dtype=np.uint64)
        if not len(hot_keys):
            return np.ones(len(prefix), dtype=np.uint64)
        at = np.minimum(np.searchsorted(hot_keys, prefix), len(hot_keys) - 1)
        return np.where(hot_keys[at] == prefix, hot_slices[at], _U(1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = _Held(), {}
        filtered = np.frombuffer(known.value, dtype=np.uint8) if known is not None else None
        for batch, texts in passes(batches, "text"):
            words = _Words(texts)
            langs = column(batch, "lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            codes = langs.indices.to_numpy(zero_copy_only=False)
            hashes = np.array([seen.setdefault(x, _language(x)) for x in names], dtype=np.uint64)
            keys = words.keys(hashes[codes], k + 1)
            chosen = keys[k] != 0
            if k:
                frequent = keys[k - 1] != 0
                for place in _bits(keys[k - 1], 8 * len(filtered)):
                    frequent &= (filtered[(place >> _U(3)).astype(np.int64)] >> (place & _U(7)).astype(np.uint8) & 1).astype(bool)
                chosen &= frequent[: len(chosen)] & frequent[1 : len(chosen) + 1]
            here = np.flatnonzero(chosen)
            if not len(here):
                continue
            key, first, count = np.unique(keys[k][here], return_index=True, return_counts=True)
            at = here[first]
            prefix = _strings(words.bytes, words.start[at], words.end[at + k - 1] if k else words.start[at])
            word = _strings(words.bytes, words.start[at + k], words.end[at + k])
            of = words.text[at]
            before = keys[k - 1][at] if k else hashes[codes][of]
            lang = pa.array(names, type=pa.large_string()).take(pa.array(codes[of]))
            slices = words.hash[at + k] % slices_of(before)
            bundle = _extend(before, slices) % _U(bundles)
            if held.add(key, count.astype(np.int64), pa.array(before), pa.array(slices.astype(np.int32)), pa.array(bundle.astype(np.int32)), lang, prefix, word) > HELD:
                yield from held.stripes()
        yield from held.stripes()

    return run


def _phrase_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of whole phrases as the tasks have them."""
    for batch, texts in passes(batches, "phrase"):
        words = _Words(texts)
        langs = np.array([_language(x) for x in column(batch, "lang").to_pylist()], dtype=np.uint64)
        first = np.searchsorted(words.text, np.arange(len(texts)))
        size = np.bincount(words.text, minlength=len(texts))
        key = langs
        for j in range(int(size.max(initial=0))):
            key = np.where(size > j, _extend(key, words.hash[np.minimum(first + j, len(words.hash) - 1)]), key)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])


def _filter(phrases: DataFrame) -> object:
    """A broadcast filter of the phrases: bits set by tasks and put together by an aggregation, as many as the phrases ask for and ``MOST_BITS`` at most."""
    spark = phrases.sparkSession
    size = 1 << min(MOST_BITS.bit_length() - 1, max(16, (FILTER_BITS * phrases.count()).bit_length()))

    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _phrase_keys(batches):
            places = np.concatenate(list(_bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), size)))
            yield pa.RecordBatch.from_arrays([pa.array((places >> _U(6)).astype(np.int64)), pa.array((_U(1) << (places & _U(63))).view(np.int64))], names=["at", "bits"])

    rows = phrases.select("lang", "phrase").mapInArrow(bits, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(size // 64, dtype=np.int64)
    for batch in rows.toArrow().to_batches():
        out[batch.column("at").to_numpy()] = batch.column("bits").to_numpy()
    return spark.sparkContext.broadcast(out.tobytes())


def _added(bundles: pa.Table, least: int) -> pa.RecordBatch:
    """Entries of whole bundles, added word by word: those of ``least`` or more, and the total of each row's stripes with no word."""
    lines = [pc.split_pattern(bundles[c].combine_chunks(), "\n") for c in ("prefixes", "words", "counts")]
    stripes = pc.list_value_length(lines[0]).to_numpy(zero_copy_only=False)
    words, counts = pc.split_pattern(lines[1].flatten(), " "), pc.split_pattern(lines[2].flatten(), " ")
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    lang, prefix, word = bundles["lang"].combine_chunks().dictionary_encode(), lines[0].flatten().dictionary_encode(), words.flatten().dictionary_encode()
    code = lambda x: x.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = counts.flatten().cast(pa.int64()).to_numpy()
    of_stripe = np.repeat(code(lang), stripes)
    key = (np.repeat(of_stripe * len(prefix.dictionary) + code(prefix), size)) * len(word.dictionary) + code(word)
    key, place = np.unique(key, return_inverse=True)
    total = np.zeros(len(key), dtype=np.int64)
    np.add.at(total, place, n)
    often = np.flatnonzero(total >= least)
    key, total = key[often], total[often]
    whole = np.zeros(len(lang.dictionary), dtype=np.int64)
    np.add.at(whole, np.repeat(of_stripe, size), n)
    w, rest = key % len(word.dictionary), key // len(word.dictionary)
    some = lambda x, at, more: pa.concat_arrays([x.dictionary.take(pa.array(at)).cast(pa.string()), more])
    none, langs = pa.nulls(len(whole), pa.string()), lang.dictionary.cast(pa.string())
    return pa.RecordBatch.from_arrays([some(lang, rest // len(prefix.dictionary), langs), some(prefix, rest % len(prefix.dictionary), none), some(word, w, none), pa.array(np.concatenate((total, whole)))], names=["lang", "prefix", "word", "a"])


def _adder(least: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds up bundles that come sorted, some whole ones at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                held.append(batch.slice(low, 500))
                if sum(x.get_total_buffer_size() * x.num_rows // max(1, batch.num_rows) for x in held) < MERGED_BYTES:
                    continue
                table = pa.Table.from_batches(held)
                last = table.slice(table.num_rows - 1).to_pylist()[0]
                same = pc.and_(pc.equal(table["lang"], last["lang"]), pc.equal(table["bundle"], last["bundle"]))
                whole = pc.index(same, True).as_py()  # the last bundle may go on in the next batch
                if whole:
                    yield _added(table.slice(0, whole), least)
                    held = table.slice(whole).to_batches()
        if held:
            yield _added(pa.Table.from_batches(held), least)

    return run


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes of all tasks added word by word: lang, prefix, word, a of at least ``least``; rows without word have totals."""
    return stripes.repartition("lang", "bundle").sortWithinPartitions("lang", "bundle").mapInArrow(_adder(least), _ENTRIES)


def _hot(phrases: DataFrame) -> dict[int, int]:
    """Slices of the most frequent phrases by their hash, ``HOT`` at most; the others have one each, and at most 1 in ``HOT`` of all words behind them."""
    rows = phrases.filter(F.col("a") >= HOT_EACH).orderBy(F.desc("a")).limit(HOT).select("lang", "phrase", "a").toArrow()
    out: dict[int, int] = {}
    for batch in rows.to_batches():
        keys = np.concatenate([x.column(0).to_numpy(zero_copy_only=False) for x in _phrase_keys([batch])])
        out |= dict(zip(keys.view(np.uint64).tolist(), (min(HOT_MOST, 1 + a // HOT_EACH) for a in batch.column("a").to_pylist()), strict=True))
    return out


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in whole numbers of up to 38 digits."""
    whole = lambda x: x.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (whole(a) * whole(n)).cast("decimal(34,0)"), whole(left) * whole(right))


def phrases(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """n by language, and frequent phrases of 1 to 5 words: lang, phrase, a; ``lefts`` and ``rights``: counts of the parts before and behind each cut; prefix and suffix."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    bundles = max(LEAST_BUNDLES, BUNDLES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    words = settle(merged(rows.mapInArrow(_mapper(0, bundles), _STRIPES), LEAST), "stripes0")
    totals = settle(words.filter("word IS NULL").groupBy("lang").agg(F.sum("a").alias("n")), "stripe-totals")
    none = F.array().cast("array<bigint>")
    out = [settle(words.filter("word IS NOT NULL").select("lang", F.col("word").alias("phrase"), "a", none.alias("lefts"), none.alias("rights")), "phrases1")]
    for k in range(1, LONGEST):
        known = _filter(out[-1])
        found = settle(merged(rows.mapInArrow(_mapper(k, bundles, known, _hot(out[-1])), _STRIPES), LEAST).filter("word IS NOT NULL").select(
            "lang", F.concat_ws(" ", "prefix", "word").alias("phrase"), "a", "prefix", F.when(F.lit(k == 1), F.col("word")).otherwise(F.concat_ws(" ", F.expr("substring(prefix, locate(' ', prefix) + 1)"), "word")).alias("suffix")), f"stripes{k}")
        known.destroy()
        below = out[-1]
        left = settle(below.select("lang", F.col("phrase").alias("prefix"), F.concat("lefts", F.array("a")).alias("lefts")), f"lefts{k}")
        right = settle(below.select("lang", F.col("phrase").alias("suffix"), F.concat(F.array("a"), "rights").alias("rights")), f"rights{k}")
        out.append(settle(_joined(_joined(found, left, ["lang", "prefix"]), right, ["lang", "suffix"]), f"phrases{k + 1}"))
    return totals, out


def _joined(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Join with settled ``keys`` (texts and counts), broadcast if their measured bytes are few, by a shuffle beyond."""
    size = sum((F.octet_length(c) if t == "string" else 8 * F.size(c) for c, t in keys.dtypes), F.lit(64))
    few = keys.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0] <= BROADCAST_BYTES
    return rows.join(F.broadcast(keys) if few else keys, on)


def collocations(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first 2,000 phrases: see the module's text."""
    totals, by_size = phrases(docs)
    columns = ["lang", "phrase", "a", "lefts", "rights"]
    found = longer = None
    for x in by_size[1:]:
        found = x.select(*columns) if found is None else found.unionByName(x.select(*columns))
    for x in by_size[2:]:
        for c in ("prefix", "suffix"):
            part = x.select("lang", F.col(c).alias("phrase"), "a")
            longer = part if longer is None else longer.unionByName(part)
    most = settle(longer.groupBy("lang", "phrase").agg(F.max("a").alias("most")), "subsumed")
    kept = found.join(most, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (F.col("most") < F.col("a")))
    kept = join_checked(kept, totals, ["lang"])
    cuts = F.transform(F.sequence(F.lit(1), F.size("lefts")), lambda k: F.struct(_score(F.col("a"), F.col("n"), F.get("lefts", k - 1), F.get("rights", k - 1)).alias("score"), k.alias("k"), F.get("lefts", k - 1).alias("l"), F.get("rights", k - 1).alias("r")))
    rows = settle(kept.select("lang", "phrase", "a", "n", F.array_min(cuts).alias("cut")).select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score"), "collocations")
    for parts in RANKED_IN:  # a language's phrases never meet in one task but for the first of each part
        order = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        rows = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= FIRST)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
