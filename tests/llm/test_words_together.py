"""Words that are new in some texts are looked at together, with the features that each has by itself."""

import random
import zlib

import numpy as np

from marketweave.llm import toxicity as T


def plain(words, text, chosen):
    """Features of a text by the definition, word by word."""
    restored = [x for w in set(text.split()) for x in words.restore(w)]
    run = []
    for w in [*text.split(), "end"]:
        core = w if len(w) == 1 else w if w[0].isalnum() and w[-1].isalnum() else w.lstrip(T._LEADING).rstrip(T._PUNCTUATION)
        if len(core) == 1:
            run.append(core)
        else:
            restored += words.restore_run("".join(run)) if len(run) > 1 else []
            run = []
    all_of = {zlib.crc32(x.encode("utf-8", "surrogatepass")) % T.HASHED for w in restored for x in ("w" + w, *(f"{n}{w[:n]}" for n in (4, 5, 6) if len(w) > n))}
    return all_of if chosen is None else {chosen[x] for x in all_of if x in chosen}


def texts():
    rnd = random.Random(5)
    words = ["a", "I", "é", '"b"', "(x", "-", "1", "idiot", "İDIOT", "1d10t!", "i.d.i.o.t", "loooser", "ΑΣ.", "\ud800x", "...", "9" * 30]
    words += ["".join(rnd.choices("abcdeéßж一AB.,!1", k=rnd.randint(1, 14))) for _ in range(400)]
    return ["", " \n", *(" ".join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(150)), "word " * 5000]


def test_features_are_those_of_each_word(monkeypatch):
    speller, rows = T.Speller(np.random.default_rng(3).integers(0, 50, T._CLASSES**3)), texts()
    everything = set().union(*(plain(T.Words(speller), x, None) for x in rows))
    for chosen in (None, {h: i for i, h in enumerate(sorted(everything)[::7])}):
        want = [plain(T.Words(speller), x, chosen) for x in rows]
        for most, together, kept in ((1, 50_000, 0), (10_000, 3, 100), (1 << 20, 50_000, 150_000)):
            monkeypatch.setattr(T, "_TOGETHER", together)
            monkeypatch.setattr(T, "MOST_WORDS", kept)
            words = T.Words(speller, chosen)
            assert [x for part in T._portions(rows, most) for x in words.of_texts(part)] == want
            assert [words.of_text(x) for x in rows] == want


def test_plain_words_are_priced_together(monkeypatch):
    calls, old = [], T.Speller.joined_of
    monkeypatch.setattr(T.Speller, "joined_of", lambda self, words, gap: calls.append(len(words)) or old(self, words, gap))
    letters = [chr(97 + i) for i in range(26)]
    rows = [" ".join(f"{a}st{b}" for b in letters) for a in letters]
    scores = T.Model(np.ones(T._CLASSES**3, dtype=np.int64), [], np.zeros(0), 0.0).scorer()(rows)
    assert scores == [0.5] * 26 and calls == [26 * 26]
