"""Each word is looked up once and its ids are made once; ids are those of the tokenizer itself."""

import public_tokenizers

from marketweave.llm import packing


def test_words_are_made_once():
    made = []
    known = packing._Known(lambda w: made.append(w) or w.encode())
    assert b"".join(map(known.__getitem__, "a b a c b".split())) == b"abacb" and made == ["a", "b", "c"]


def test_ids(monkeypatch):
    tokenizer = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", "One two, two ONE.", "x一y <|odd|>", "café don't 12345", " \n\t"]
    want = tokenizer._ids(texts)
    assert tokenizer.encode(texts) == want
    monkeypatch.setattr(packing, "MOST_WORDS", 1)
    assert tokenizer.encode(texts[1:]) == want[1:]
