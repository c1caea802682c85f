import numpy as np

from marketweave.llm import toxicity


def words():
    n = np.zeros(64**3, dtype=np.int64)
    for word in ["idiot", "dumb", "shutup", "loser"] * 50 + ["this", "is", "you", "are", "an", "text", "good", "look", "a", "page"] * 40:
        c = [0, 0, *map(toxicity._class, word), 0]
        for x, y, z in zip(c, c[1:], c[2:]):
            n[(x * 64 + y) * 64 + z] += 1
        for first in "tuerseaopkdb":  # the last letter of the word before
            n[(toxicity._class(first) * 64 + 0) * 64 + c[2]] += 1
    return toxicity.Words(toxicity.Speller(n))


def test_spaced_words_with_signs_short_ones_and_several():
    w = words()
    for text, want in {
        "you are d u m b.": ["dumb"], "an i d i o t.": ["idiot"], 'an "i d i o t", this': ["idiot"], "s h u t u p i d i o t": ["shutup", "idiot"],
        "a i d i o t": ["idiot"], "f u": ["fu"], "1 d 1 0 t!": ["idiot"], "y o u a r e d u m b": ["dumb"],
    }.items():
        for x in want:
            assert set(w.of_word(x)) <= w.of_text(text), (text, x, w.restore_run("".join(text.split())))


def test_long_words_are_restored():
    w = words()
    assert w.restore("idi" + "o" * 60 + "t")[0] == "idiot"
    assert "idiot" in w.restore("this-text-is-good-look-at-this-page-you-are-an-1d10t")
    assert "idiot" in w.restore("page/you_are_an/1d10t")
    assert "idiot" in w.restore("you" * 1 + "u" * 40 + "idi0t")
    assert w.restore("o" * 200_000 + "k1" * 1000)  # linear in the length


def test_joined_words_of_any_length():
    w = words()
    for n in range(1, 60):  # plain letters, and with a look-alike in the first word
        filler = "agoodlookatthispage" * 3
        for head in (filler[:n], "1" + filler[1:n] if n > 1 else "a"):
            assert "idiot" in w.restore(head + "youareidiot"), (n, head, w.restore(head + "youareidiot"))
    lengths = {len(w.restore("1d10t" + "this" * k + "x" * m)) > 1 for k in range(7, 11) for m in range(4)}
    assert lengths == {True}  # 33 to 48 characters: breaks are tried in all
    assert w.restore("idiot") == ["idiot"] and not w.speller.joined("page", 3.0)
    assert w.restore("y.o.u.a.r.e.d.u.m.b") == w.restore_run("youaredumb")
