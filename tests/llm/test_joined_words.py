"""Whether a word is cheaper with a break is as a plain look at every place tells; letter classes are read from a list."""

import random

import numpy as np

from marketweave.llm import toxicity as T


def plain(speller, word, gap):
    price, n = speller.prices, T._CLASSES
    c = [0, 0, *map(T._class, word), 0]
    cost = lambda *x: price[(x[0] * n + x[1]) * n + x[2]]
    for i in range(3, len(word) + 2):
        x, y, z, after = c[i - 2 : i + 2]
        if cost(x, y, z) + cost(y, z, after) > gap + cost(x, y, 0) + price[y * n * n + z] + price[z * n + after]:
            return True
    return False


def test_joined():
    random.seed(3)
    speller = T.Speller(np.random.default_rng(3).integers(0, 50, T._CLASSES**3))
    words = ["", "a", "ab", *("".join(random.choices("abcdeéßж一", k=random.randint(1, 12))) for _ in range(300))]
    for gap in (-3.0, 0.5, 6.0):
        assert [speller.joined(w, gap) for w in words] == [plain(speller, w, gap) for w in words]
    assert all(type(x) is int for x in T._LISTED) and [T._class(chr(o)) for o in range(0x250)] == T._CLASS.tolist()
