"""Each operator against a brute-force form, an exact round trip or held-out accuracy on small inputs."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from marketweave.llm import decontam, hashing, jaccard, line_dedup, media, packing, sharding, suffix_dedup, token_counts, toxicity, warc

DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(DOCS).collect()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# -- sharding


def test_lookup_table_shares_and_stability():
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    counts = np.bincount(table)
    assert counts.sum() == 1009 and counts.max() - counts.min() <= 1
    less = sharding.lookup_table(names[:-1], 1009)
    stay = table != 6
    assert (np.array(names)[table[stay]] == np.array(names)[less[stay]]).mean() > 0.7
    # the same by the definition: each shard's preference list, turn by turn
    prefs = []
    for n in names:
        offset, skip = sharding._number(f"offset {n}") % 1009, sharding._number(f"skip {n}") % 1008 + 1
        prefs.append(iter([(offset + j * skip) % 1009 for j in range(1009)]))
    slots = {}
    while len(slots) < 1009:
        for k, p in enumerate(prefs):
            if len(slots) < 1009:
                slots[next(s for s in p if s not in slots)] = k
    assert table.tolist() == [slots[i] for i in range(1009)]
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 1009)
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)


def test_write_shards_splits_a_hot_key(spark, tmp_path):
    df = spark.createDataFrame([("hot", i) for i in range(500)] + [(None, 1)], "k string, v int")
    sharding.write_shards(df, str(tmp_path / "s"), "k", ["a", "b", "c"], size=101)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 501 and back.filter("k = 'hot'").select("shard").distinct().count() == 1


def test_placing_equals_looking_up_row_by_row(spark, tmp_path):
    """Every row by itself: its key's hash, then the table; the key may be called slot or shard, and other columns anything."""
    names, long = ["a", "b", "c"], "k" * 300_000
    table = sharding.lookup_table(names, 101)
    keys = [None, "", "x", "x", "y", long, *map(str, range(50))]
    for name in ("shard", "slot", "a.b"):
        df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"`{name}` string, v int")
        hashes = {r.v: r.h % 101 for r in df.select("v", F.xxhash64(F.coalesce(F.col(f"`{name}`"), F.lit(""))).alias("h")).collect()}
        got = {r.v: (r.slot, r.shard) for r in sharding.place(df, name, names, 101).collect()}
        assert got == {v: (h, names[table[h]]) for v, h in hashes.items()}
    odd = spark.createDataFrame([("x", {"a": 1}, "kept")], "k string, m map<string,int>, split string")
    sharding.write_shards(odd, str(tmp_path / "odd"), "k", names, size=101)
    assert [(r.split, r.m) for r in spark.read.parquet(str(tmp_path / "odd")).collect()] == [("kept", {"a": 1})]
    only = spark.createDataFrame([("x",)], "shard string")
    sharding.write_shards(only, str(tmp_path / "only"), "shard", names, size=101)
    assert spark.read.parquet(str(tmp_path / "only")).count() == 1


# -- line dedup


def brute_lines(rows, parts=lambda line: [line]):
    """Texts of which the repeated parts of lines are gone, with lines of which nothing is left."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first, kept = {}, []
    for i in order:
        d, t = rows[i]
        for k, x in enumerate(x for line in (t or "").split("\n") for x in parts(line)):
            first.setdefault(" ".join(x.lower().split()), (d, t, k))
    for d, t in rows:
        k, out, whole = 0, [], True
        for line in (t or "").split("\n"):
            stay = []
            for x in parts(line):
                if not x.strip() or first[" ".join(x.lower().split())] == (d, t, k):
                    stay.append(x)
                k += 1
            whole = whole and stay == parts(line)
            if stay:
                out.append("".join(stay))
        kept.append((d, t if whole else "\n".join(out)))
    return sorted(kept, key=str)


def brute_sentences(line, least=6):
    """Words one by one: a part ends behind a sentence's last word once it has enough words."""
    parts, now, n = [], "", 0
    for word in re.findall(r"\s*\S+\s*$|\s*\S+\s+", line) or [line]:
        now, n = now + word, n + 1
        if n >= least and re.search(r"[.!?\u2026\u3002]+[\"')\]\u00bb\u201d\u2019]*\s+$", now):
            parts.append(now)
            now, n = "", 0
    if now or not parts:
        parts.append(now)
        if len(parts) > 1 and n < least:
            parts[-2:] = ["".join(parts[-2:])]
    elif line == "":
        parts = [""]
    return parts


@pytest.mark.parametrize("unit, parts, chunk", [("line", lambda line: [line], 200_000), ("sentence", brute_sentences, 200_000), ("sentence", brute_sentences, 1)])
def test_line_dedup_equals_brute_force(spark, docs, monkeypatch, unit, parts, chunk):
    monkeypatch.setattr(line_dedup, "CHUNK", chunk)
    copied = "Here begins a passage of some words. It goes on for long enough to count! Short. And then this is its very end, at last."
    extra = [
        (5000, "one two three four\nA b  C d\na b c d\n\n"), (5001, "x\nA B C D"), (None, "a b c d\nlast one of these"), (5002, None), (5003, ""), (5003, ""), (5004, "\n\n"),
        (5005, f"Something else stands before it {copied} and behind it too"), (5006, f"Other words {copied}   \n  {copied.upper()}"), (5006, f"Other words {copied}   \n  {copied.upper()}"), (None, copied),
        (5007, "again and again. " * 30_000),
    ]
    rows = docs + extra
    out = line_dedup.remove_repeats(frame(spark, rows), unit=unit)
    assert rows_of(out.select("doc_id", "text")) == brute_lines(rows, parts)
    r = {x.doc_id: x for x in out.collect()}
    assert r[5000].removed_spans == "28-35" and r[5000].text == "one two three four\nA b  C d\n\n"
    if unit == "sentence":
        assert "count" not in r[5006].text and r[5006].text.endswith("HERE BEGINS A PASSAGE OF SOME WORDS. ") and r[5007].n_removed > 10_000
    texts = dict(rows)
    for x in out.filter("n_removed > 0 and doc_id is not null").collect():
        spans = [tuple(map(int, s.split("-"))) for s in x.removed_spans.split(",")]
        assert sum(b - a for a, b in spans) == x.removed_chars and all("\n" not in texts[x.doc_id][a:b] for a, b in spans)


def test_paragraphs(spark):
    rows = [(1, "a b c d\ne\n\nnew part of it\n"), (2, "x y z w v\n \nA B C D E")]
    got = dict(rows_of(line_dedup.remove_repeats(frame(spark, rows), unit="paragraph").select("doc_id", "text")))
    assert got == {1: rows[0][1], 2: "x y z w v"}


# -- media


def png(size=1):
    chunk = lambda k, b: len(b).to_bytes(4, "big") + k + b + zlib.crc32(k + b).to_bytes(4, "big")
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", b"\0" * 13) + chunk(b"IDAT", b"x" * size) + chunk(b"IEND", b"")


GIF = b"GIF89a\1\0\1\0\x80\0\0" + b"\0" * 6 + b"\x2c" + b"\0" * 9 + b"\2\2\x44\1\0;"
BMP = b"BM" + (58).to_bytes(4, "little") + b"\0" * 4 + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + b"\1\0\0\0\1\0\0\0\1\0\x18\0" + b"\0" * 24 + b"abcd"
JPEG = b"\xff\xd8\xff\xe0\0\4ab\xff\xda\0\4cd\1\xff\0\2\xff\xd9"
PDF = b"%PDF-1.4 stuff startxref 1 %%EOF"


def test_sniffing_and_carving(spark):
    gz = zlib.compressobj(wbits=31)
    gz = gz.compress(b"text" * 100) + gz.flush()
    kinds = {"image/png": png(), "image/gif": GIF, "image/bmp": BMP, "image/jpeg": JPEG, "application/pdf": PDF, "application/gzip": gz, "audio/wav": media.wav(b"12345678")}
    for kind, b in kinds.items():
        assert media.segments(b) == [(0, len(b), kind)], kind
        assert media.segments(b"junk BM RIFF" + b + b"tail") == [(12, len(b), kind)], kind
        assert media.segments(b[:-1]) == [] or kind in ("audio/wav",), kind
    spoiled = bytearray(png())
    spoiled[-14] ^= 1
    assert media.segments(bytes(spoiled)) == []
    df = spark.createDataFrame([(1, bytearray(b"xx" + GIF + png())), (2, bytearray(GIF)), (3, None), (4, bytearray())], "id int, content binary").withColumn("declared", F.lit("text/plain")).withColumn("segments", F.lit(1))
    got = {r.id: (r.media_type, [(s.offset, s.length, s.type) for s in r.segments]) for r in media.sniff(df).collect()}
    assert got == {1: ("text/plain", [(2, len(GIF), "image/gif"), (2 + len(GIF), len(png()), "image/png")]), 2: ("image/gif", [(0, len(GIF), "image/gif")]), 3: ("text/plain", []), 4: ("text/plain", [])}


def test_media_round_trip(spark, docs):
    rows = docs[:60] + [(9000, None), (9001, ""), (9002, "x" * 192), (9003, "é" * 100_000), (9001, ""), (None, "RIFF\x00\x00WAVEBM%PDF-")]
    got = rows_of(media.features(media.store_texts(frame(spark, rows))).drop("feature", "media_type"))
    want = []
    for d, t in rows:
        b = (t or "").encode()
        p = b + b" " * (-len(b) % 192 if b else 192)
        w = media.wav(p)
        want.append((d, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(w), hashlib.sha256(w).hexdigest()))
    assert got == sorted(want, key=str)


# -- token counts


def test_trie_counts_equal_plain_dynamic_programming(spark, docs):
    file = public_tokenizers.path("piece_bpe_32k.model")
    scores, byte = token_counts.unigram_scores(file)

    def count(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            best.append(max([(best[-1][0] + n * byte, best[-1][1] - n)] + [(best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in scores]))
        return -best[-1][1]

    rows = docs[:40] + [(7000, None), (7001, "  \n"), (7002, "日本語 😀 " + "ab" * 400), (None, "a a")]
    got = {(r.doc_id, r.n_chars): r.n_tokens for r in token_counts.count_tokens(frame(spark, rows), file).collect()}
    for d, t in rows:
        assert got[d, len(t or "")] == sum(count(token_counts.MARK + w) for w in (t or "").split())


def test_trie_starts_anew(monkeypatch):
    t = token_counts.PrefixTrie({"▁a": -1.0, "b": -1.0, "ab": -0.5, "▁": -2.0}, -9.0)
    want = {w: t.insert(w) for w in ("ab", "abab", "b", "ba")}
    monkeypatch.setattr(token_counts, "MOST_NODES", 3)
    t.clear()
    assert {w: t.insert(w) for w in want} == want


# -- Jaccard join


def brute_components(rows, percent=80):
    sets = []
    for _, t in rows:
        low = bytes(hashing.LOWER[np.frombuffer((t or "").encode(), np.uint8)])
        w = [x for x in __import__("re").split(rb"[\x20\x09-\x0d]+", low) if x]
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


def variants(n, edits, seed, words=60):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(words)] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("rounds, verify", [(3, 10), (1, 0), (1, 1000)])
def test_jaccard_join_equals_brute_force(spark, docs, monkeypatch, rounds, verify):
    """With few and many rounds with pivots, and prefixes of one and of many matches."""
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "VERIFY", verify)
    texts = variants(40, 2, 1) + variants(25, 4, 2) + ["a b", "A  b", "a", "", None, "one two three four five"] * 2
    rows = docs[:80] + [(6000 + i, t) for i, t in enumerate(texts)]
    assert rows_of(jaccard.near_duplicates(frame(spark, rows))) == [tuple(r) for r in sorted(brute_components(rows), key=str)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_join_at_the_threshold(spark, monkeypatch, seed):
    """Many sets of few shingles of few kinds, just above and below the threshold and of differing sizes."""
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    rnd, rows = random.Random(seed), []
    for i in range(300):
        start, n = rnd.randrange(40), rnd.randrange(5, 40)
        words = [f"w{start + j}" for j in range(n)]
        if rnd.random() < 0.5:
            words[rnd.randrange(n)] = f"w{rnd.randrange(90)}"
        rows.append((i, " ".join(words)))
    assert rows_of(jaccard.near_duplicates(frame(spark, rows))) == [tuple(r) for r in sorted(brute_components(rows), key=str)]


def test_jaccard_salted_buckets_and_pivots_of_many(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET", 5)
    monkeypatch.setattr(jaccard, "PER_PIVOT", 3)
    rows = [(i, t) for i, t in enumerate(variants(60, 2, 3))]
    assert rows_of(jaccard.near_duplicates(frame(spark, rows))) == [tuple(r) for r in sorted(brute_components(rows), key=str)]


def test_jaccard_rows_of_one_doc_id_link_together(spark):
    """Texts of one doc_id are one document; rows without a doc_id name nothing; repeated and very long rows are whole."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a), (7, a), (3, b), (5, b), (None, c), (9, c), (9, c), (None, "alone with no other text here"), (5, "")]
    got = {(d, n): k for d, n, k in rows_of(jaccard.near_duplicates(frame(spark, rows)))}
    assert got == {(5, 26): 3, (7, 26): 3, (3, 26): 3, (None, 26): 9, (9, 26): 9, (None, 2): None, (5, 0): 5}
    long = " ".join(f"w{i}" for i in range(60_000))
    assert rows_of(jaccard.near_duplicates(frame(spark, [(1, long), (2, long + " more"), (3, "w1 w2 w3 w4 w5 w6")]))) == [(1, 59996, 1), (2, 59997, 1), (3, 2, 3)]


# -- suffix dedup


def brute_windows(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49 if d is not None else 0):
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    out = []
    for d, t in rows:
        b, gone = (t or "").encode(), bytearray(len((t or "").encode()))
        for i in range(len(b) - 49 if d is not None else 0):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [suffix_dedup.MOST, 50])
def test_suffix_dedup_equals_brute_force(spark, docs, most):
    odd = ["a" * 300, "ab" * 200, "abc" * 50 + "x" * 100, "a" * 300, "a" * 49, "a" * 50, "", None, "é" * 60, "é" * 24 + "ab", "z" + "é" * 60]
    rows = docs[:120] + [(10_000 + i, t) for i, t in enumerate(odd)] + [(None, docs[3][1]), (5, docs[5][1]), (5, docs[7][1]), (20_000, (docs[3][1] or "")[:49]), (20_001, (docs[3][1] or "")[5:56])]
    assert rows_of(suffix_dedup.remove_repeats(frame(spark, rows), most)) == brute_windows(rows)


# -- toxicity


def test_decoder_restores_disguises():
    n = np.zeros(64**3, dtype=np.int64)
    for word in ["idiot"] * 50 + ["loser"] * 50 + ["this", "is", "clear", "text", "good", "look"] * 20:
        c = [0, 0, *map(toxicity._class, word), 0]
        for x, y, z in zip(c, c[1:], c[2:]):
            n[(x * 64 + y) * 64 + z] += 1
    words = toxicity.Words(toxicity.Speller(n))
    for disguised in ("1d10t", "i.d.i.o.t", "idiooooot", "!d!ot", "i-d-i-0-t"):
        assert words.restore(disguised)[0] == "idiot", disguised
    assert words.restore("l0$er,")[0] == "loser" and words.restore("good")[0] == "good"
    assert set(words.of_word("idiot")) <= words.of_text("i d i o t")


def test_decoder_is_the_cheapest_of_all_paths():
    """Viterbi against every path of small lattices, with and without word breaks."""
    rnd = random.Random(9)
    n = np.array([rnd.randrange(40) if rnd.random() < 0.4 else 0 for _ in range(64**3)], dtype=np.int64)
    speller = toxicity.Speller(n)
    price = lambda x, y, z: speller.prices[(x * 64 + y) * 64 + z]

    def all_paths(word, gap):
        """(cost, text) of every way to read the word."""
        states = [(0.0, "", (0, 0))]
        for i, ways in enumerate(speller.lattice(word)):
            if gap is not None and i:
                sign = not word[i].isalnum() and word[i] not in toxicity.LOOKS_LIKE
                at = min(gap, toxicity._SIGN_BREAK) if sign else gap
                states = states + [(c + at + price(x, y, 0), t + " ", (y, 0)) for c, t, (x, y) in states if y]
            states = [(c + p + price(x, y, toxicity._class(letter)), t + letter, (y, toxicity._class(letter))) if letter else (c + p, t, (x, y)) for c, t, (x, y) in states for letter, p in ways]
        return [(c + (price(x, y, 0) if y else 0.0), t.strip()) for c, t, (x, y) in states]

    for _ in range(150):
        word = "".join(rnd.choice("abeio1!|3.-oo$") for _ in range(rnd.randrange(1, 7)))
        for gap in (None, 0.5, 3.0):
            paths = all_paths(word, gap)
            best = min(c for c, _ in paths)
            assert speller.decode(word, gap) in {t for c, t in paths if c <= best + 1e-9}, (word, gap)


def test_many_rows_of_one_doc_id_are_one_example(spark):
    docs = spark.createDataFrame([(i, f"you idiot number {i}" if i % 2 else f"good day number {i}") for i in range(60)] * 3 + [(None, "x"), (7, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 2, "doc_id long, toxic int")
    once = toxicity.fit(docs.dropDuplicates(["doc_id", "text"]).filter("doc_id <> 7 or text is not null"), labels.distinct())
    many = toxicity.fit(docs.filter("doc_id <> 7 or text is not null"), labels)
    assert once.chosen == many.chosen and np.allclose(once.weights, many.weights)
    assert toxicity.score(docs, labels).count() == docs.count()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").toPandas()
    rank, y = got.score.rank().to_numpy(), got.toxic.to_numpy()
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.95 and got.predicted[y == 0].mean() < 0.01 and got.predicted[y == 1].mean() > 0.75


def test_held_out_labels_do_not_matter(spark):
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(toxicity.score(d, labels)) == rows_of(toxicity.score(d, flipped))
    none = toxicity.score(d.limit(5), labels.filter("false")).collect()
    assert len(none) == 5 and {r.predicted for r in none} == {0}


# -- WARC


def brute_pages(rows):
    owner = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            owner[b] = max(owner.get(b, p), p)
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        ref = owner.get(b) if len(b) >= 1000 and owner.get(b) != p else None
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if ref is not None else "response", ref))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    big = "é\r\n\r\nWARC/1.1\r\nx" * 200
    pages += [(9000 + i, f"http://a b/{i}\n", big) for i in range(5)] + [(9100, None, None), (9101, "", ""), (9102, "u", "short"), (9103, "u", "short"), (9004, "again", big), (None, "n", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).withColumn("digest", F.lit("clash"))
    assert rows_of(warc.round_trip(df)) == brute_pages(pages)
    assert warc.round_trip(df.filter("false")).count() == 0


def record(name, payload, digest=None):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    return b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <%s>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % (name, (digest or hashlib.sha1(payload).hexdigest()).encode(), len(block)) + block + b"\r\n\r\n"


def zipped(data):
    z = zlib.compressobj(wbits=31)
    return z.compress(data) + z.flush()


def test_salvage_of_plain_archives():
    a, b, c = record(b"a", b"one"), record(b"b", b"two"), record(b"c", b"three")
    found, gaps = warc.salvage(a + b + c)
    assert [h["warc-record-id"] for _, h, _ in found] == ["<a>", "<b>", "<c>"] and not gaps
    cut = a + b[:-30] + c
    found, gaps = warc.salvage(cut)
    assert [p for _, _, p in found] == [b"one", b"three"] and gaps == [(len(a), len(b) - 30, "version line within the headers")]
    found, gaps = warc.salvage(a + b[:-10] + c)
    assert [p for _, _, p in found] == [b"one", b"three"] and gaps == [(len(a), len(b) - 10, "record end not where the content length says")]
    found, gaps = warc.salvage(a + record(b"b", b"two", "0" * 40) + b"garbage" + c)
    assert [p for _, _, p in found] == [b"one", b"three"] and gaps[0][2] == "payload digest differs"
    assert warc.salvage(b"") == ([], [])


def test_damage_to_a_written_archive_costs_one_record(spark, tmp_path):
    """Bytes of an archive of this writer are spoiled: all pages but those hit come back, and the gap is told."""
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>page {i} " + "".join(chr(97 + (i * k * k) % 26) for k in range(900)) + "</p>") for i in range(250)], "page_id long, url string, html string").coalesce(1)
    warc.write(warc.with_revisits(pages), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*")
    for place in (0.25, 0.5, 0.999):
        data = bytearray(file.read_bytes())
        at = int(len(data) * place) - 20
        data[at : at + 20] = bytes(255 - x for x in data[at : at + 20])
        found, gaps = warc.salvage(bytes(data))
        assert len(found) >= 248 and gaps
        assert {h["warc-record-id"] for _, h, _ in found} <= {f"<{warc._ID}{i}>" for i in range(250)}


def test_archives_are_bounded_and_losses_raise(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PART_BYTES", 3000)
    monkeypatch.setattr(warc, "PARTS_PER_FILE", 2)
    rows = [(i, "u", f"{i} " * 500) for i in range(30)] + [(99, "big", "x" * 400_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write(warc.with_revisits(pages), str(tmp_path / "w"))
    sizes = [sum(len(p) for _, _, p in warc.salvage(f.read_bytes())[0]) for f in (tmp_path / "w").glob("part-*")]
    assert len(sizes) >= 7 and sum(s > 2 * 3000 for s in sizes) == 1
    assert rows_of(warc.round_trip(pages)) == brute_pages(rows)
    monkeypatch.setattr(warc, "read", lambda spark, path, payloads=True, old=warc.read: old(spark, path, payloads).filter("record_id not like '%:7'"))
    with pytest.raises(OSError, match="30 of 31"):
        warc.round_trip(pages)


def test_salvage_of_gzip_members():
    parts = [zipped(record(n, n * 300)) for n in (b"a", b"b", b"c")]
    broken = bytearray(parts[1])
    broken[len(broken) // 2] ^= 0xFF
    found, gaps = warc.salvage(parts[0] + bytes(broken) + parts[2])
    assert [p[:1] for _, _, p in found][0] == b"a" and [p[:1] for _, _, p in found][-1] == b"c" and any("gzip" in g[2] for g in gaps)
    assert sum(len(p) == 300 for _, _, p in found) == 2
    found, gaps = warc.salvage(parts[0] + parts[1][:-9])
    assert len(found) >= 1 and gaps[-1][2] == "gzip member cut short"


# -- decontamination


def edits(text, n, seed):
    rnd, t = random.Random(seed), list(text)
    for _ in range(n):
        i = rnd.randrange(len(t))
        kind = rnd.randrange(3)
        t[i : i + 1] = [] if kind == 0 else [t[i], "q"] if kind == 1 else ["z"]
    return "".join(t)


def test_decontamination_recall_and_precision(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    clean = [(d, t) for d, t in docs if t and not any(x in t for _, x in items)][:80]
    planted = [(1000 + i, f"{clean[i][1][:300]}\n{edits(t, n * len(t) // 100, i).upper() if i % 2 else edits(t, n * len(t) // 100, i)} {clean[i][1][:200]}", k) for i, (k, t) in enumerate(items) for n in [(0, 2, 5)[i % 3]]]
    rows = clean + [p[:2] for p in planted] + [(3000, None), (3001, "")]
    found = decontam.hits(frame(spark, rows), spark.createDataFrame(items + [(900, None), (901, ""), (902, "tiny words")], "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    want = {(d, k) for d, _, k in planted}
    assert len(pairs & want) >= 0.95 * len(want)
    assert {(d, k) for i, (d, _, k) in enumerate(planted) if i % 3 == 0} <= pairs
    texts = dict(rows)
    for r in found:  # exact verification of what is reported
        item = dict(items)[r.item_id]
        part = texts[r.doc_id].encode()[r.start : r.end].decode()
        norm = lambda s: decontam.normalise(*(lambda b: (np.frombuffer(b, np.uint8), np.array([0, len(b)])))(s.encode()), 0)[0].tobytes().strip()
        assert levenshtein(norm(item), norm(part)) <= max(r.edits + 1, 0.15 * r.item_chars)
        assert r.doc_id >= 1000


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("share, least", [(0, 1.0), (5, 0.97), (10, 0.95), (13, 0.92)])
def test_decontamination_recall_by_edits(spark, docs, share, least):
    """Planted items with that percentage of edits, of all lengths, one very short one spoiling none of the others."""
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()] + [(-1, "q")]
    clean = [t for _, t in docs if t and len(t) > 200][:50]
    planted = [(i, f"{clean[i % 50][:150]} {edits(t, share * len(t) // 100, 7 + i)} {clean[i % 50][-150:]}", k) for i, (k, t) in enumerate(items) if k >= 0]
    found = {(r.doc_id, r.item_id) for r in decontam.hits(frame(spark, [p[:2] for p in planted]), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(found & {(d, k) for d, _, k in planted}) >= least * len(planted)


def test_short_items_by_distance_and_whole_words(spark):
    items = [(1, "cat"), (2, "tiny words here"), (3, "a"), (4, "!!"), (5, "exactly twenty-three by")]
    rows = [(1, "the CAT sat"), (2, "concatenate"), (3, "see tiny wards here, now"), (4, "destiny words herein"), (5, "exactly twenty three b9"), (6, "only a word"), (7, "x" * 200_000 + " tiny words here " + "y" * 200_000), (7, "cat")]
    found = sorted((r.doc_id, r.item_id, r.edits, r.start, r.end) for r in decontam.hits(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect())
    assert found == [(1, 1, 0, 4, 7), (3, 2, 1, 4, 19), (5, 5, 1, 0, 23), (6, 3, 0, 5, 6), (7, 1, 0, 0, 3), (7, 2, 0, 200_001, 200_016)]


def test_nearest_is_exact():
    rnd = random.Random(4)
    for _ in range(60):
        p = bytes(rnd.choices(b"abc ", k=rnd.randrange(1, 12)))
        t = bytes(rnd.choices(b"abc ", k=rnd.randrange(0, 25)))
        want = min(levenshtein(p, t[i:j]) for i in range(len(t) + 1) for j in range(i, len(t) + 1))
        assert decontam.nearest(p, t, 99)[0] == want


def test_items_in_blocks(spark, docs, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = rows_of(decontam.hits(frame(spark, docs), bench))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 3000)
    assert rows_of(decontam.hits(frame(spark, docs), bench).select("doc_id", "item_id").distinct()) == sorted({(r[0], r[1]) for r in whole}, key=str)


# -- packing


def test_packing_invariants_and_ids(spark, docs):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    odd = ["", None, "İstanbul ΑΣ <|endoftext|> x", "日本 a b\x1cc don't we'll 12½", "word " * 9000, docs[0][1], docs[0][1]]
    rows = docs + [(8000 + i, t) for i, t in enumerate(odd)] + [(None, "no id")]
    out = packing.pack(frame(spark, rows), file).toPandas()
    whole = Tokenizer.from_file(file)
    for d, t in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        mine = out[out.doc_id.isna() if d is None else out.doc_id == d].sort_values("start")
        assert (mine.doc_tokens == len(ids)).all() and mine.length.sum() == len(ids)
        assert mine.start.tolist() == [0, *np.cumsum(mine.length)[:-1]]
        assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(mine.start, mine.length)] == mine.ids_crc32.tolist()
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 4096
    used = out.groupby("sequence_id").length.sum()
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in used)
    assert padding <= 0.01 * used.sum()


@pytest.mark.parametrize("seed, docs_of", [(1, 0), (2, 1), (3, 40), (4, 900), (5, 900)])
def test_open_windows_keep_what_was_placed(seed, docs_of):
    """At the end each full window begins with one placed by sum of squares; only what fills the gaps moves; no id is lost."""
    rnd = random.Random(seed)
    p, done, sizes = packing.Packer(256), [], []
    for d in range(docs_of):
        sizes.append(rnd.choice([1, 3, rnd.randrange(1, 200), rnd.randrange(1, 1200)]))
        done += p.add(d, np.arange(sizes[-1], dtype="<u4").tobytes())
    placed = {(w[0][0], w[0][1]): [x[:3] for x in w] for ws in p.open.values() for w in ws}
    open_tokens = sum(len(x[2]) // 4 for w in placed.values() for x in w)
    rest = list(p.rest())
    stayed = 0
    for w in rest:
        n = sum(len(x[2]) for x in w) // 4
        assert n == 256 or n & (n - 1) == 0
        if n == 256:
            own = placed[w[0][0], w[0][1]]
            assert [x[:3] for x in w][: len(own)] == own
            stayed += sum(len(x[2]) for x in own) // 4
    assert docs_of < 900 or stayed >= 0.6 * open_tokens
    got = {}
    for w in [*done, *rest]:
        assert sum(len(x[2]) for x in w) <= 4 * 256
        for d, start, ids, total in w:
            assert total == sizes[d]
            got.setdefault(d, {}).update(zip(range(start, start + len(ids) // 4), np.frombuffer(ids, "<u4").tolist(), strict=True))
    assert got == {d: {i: i for i in range(n)} for d, n in enumerate(sizes)}


def test_choice_is_the_least_sum_of_squares():
    rnd = random.Random(2)
    p = packing.Packer(40)
    for _ in range(400):
        size = rnd.randrange(1, 40)

        def cost(h):
            n = p.level.copy()
            if h:
                n[h] -= 1
            if h + size < 40:
                n[h + size] += 1
            return int((n[1:40] ** 2).sum())

        options = [0, *[h for h in range(1, 41 - size) if p.level[h]]]
        assert cost(p.choose(size)) == min(map(cost, options))
        list(p.add(0, b"\1\0\0\0" * size))
    assert sum(1 for _ in p.rest()) and not p.level.any()


# -- all operators: nulls, clashing names, empty tables


def test_empty_tables(spark, docs):
    none = frame(spark, docs[:1]).filter("false")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    file = public_tokenizers.path("word_bpe_49k.json")
    for df in (
        sharding.place(none, "doc_id", ["a", "b"], 101), line_dedup.remove_repeats(none), media.features(media.store_texts(none)), token_counts.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")),
        jaccard.near_duplicates(none), suffix_dedup.remove_repeats(none), toxicity.score(none, labels), decontam.hits(none, bench), decontam.hits(frame(spark, docs), bench.filter("false")), packing.pack(none, file),
    ):
        assert df.count() == 0


def test_clashing_columns_and_null_ids(spark, docs):
    clash = "slot shard n start end unit digest _key cls hashes node block counts score segments media_type content declared row copy told component a b token level offset n_removed removed_spans".split()
    df = frame(spark, docs[:20] + [(None, "some text of no document at all"), (None, None)]).withColumns({c: F.lit(c) for c in clash})
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    counts = collections.Counter(
        x.count()
        for x in (
            sharding.place(df, "doc_id", ["a", "b"], 101), line_dedup.remove_repeats(df), media.features(media.store_texts(df)), token_counts.count_tokens(df, public_tokenizers.path("piece_bpe_32k.model")),
            jaccard.near_duplicates(df), suffix_dedup.remove_repeats(df), toxicity.score(df, labels),
        )
    )
    assert counts == {22: 7}
    assert packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).select("doc_tokens").count() >= 22
    decontam.hits(df, bench.withColumn("doc_id", F.lit(1))).count()
